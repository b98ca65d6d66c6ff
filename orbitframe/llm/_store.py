"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_made: list = []
_own: dict[str, str] = {}
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir.

    Where that is unset a local session gets a temporary folder, and one on a cluster an error: no
    folder of one machine will do there.
    """
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        at = spark.sparkContext.applicationId
        found = _own[at] = _own.get(at) or "file://" + tempfile.mkdtemp(prefix="orbitframe-")
    return found.rstrip("/")


@contextmanager
def tidied(spark: SparkSession):
    """Shuffle files of what runs within go when it ends: the result is in the shared folder by then."""
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def materialise(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write df as Parquet under the shared folder and read it again: this cuts the lineage."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/orbitframe/{name}-{uuid.uuid4().hex}"
    with tidied(spark):
        df.write.option("compression", compression).parquet(path)
    _made.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def release(df: DataFrame) -> None:
    """Delete the files of a table that materialise() made, when nothing reads it any more."""
    files = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    for spark, path in [x for x in _made if any(f.rstrip("/").endswith(x[1].rsplit("/", 1)[1]) for f in files)]:
        _delete(spark, path)
        _made.remove((spark, path))


def _delete(spark: SparkSession, path: str) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(conf).delete(at, True)


@atexit.register
def _clean() -> None:
    for spark, path in _made:
        try:
            if spark.sparkContext._jsc is not None:
                _delete(spark, path)
        except Exception:  # noqa: BLE001  the session may be gone at exit
            return

