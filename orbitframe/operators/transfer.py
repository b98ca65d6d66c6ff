"""Getting files: what to fetch, fetching it safely, and what came of it.

A plan is a table with a row for each file and what to do about it.  Fetching runs in the executors,
a row at a time: into a hidden file beside the target, checked for size and checksum, and renamed
when it is right.  Running a row again finds the finished file, so a lost task repeats nothing.
"""

from __future__ import annotations

import os
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import BinaryIO

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orbitframe.functions import numbers as N
from orbitframe.functions import text as T
from orbitframe.operators import relational as R
from orbitframe.operators import state as S
from orbitframe.sources import files

RESULT = "status string, last_action string, local_actual_size long, local_mtime_ns long, error string"


class NotAllowed(Exception):
    """The source refuses the user."""


class Answer(OSError):
    """An HTTP answer that is an error; status None: there was none."""

    def __init__(self, status: int | None):
        super().__init__(f"HTTP {status}")
        self.status = status


def kind_of(error: BaseException) -> tuple[str, int | None]:
    """An error's kind, as state.retryable() has them, and its HTTP status."""
    if isinstance(error, NotAllowed):
        return "auth", None
    if isinstance(error, Answer):
        return "http", error.status
    if isinstance(error, TimeoutError):
        return "timeout", None
    if isinstance(error, ConnectionError):
        return "connection", None
    return ("io" if isinstance(error, OSError) else "other"), None


def may_pass(error: BaseException) -> bool:
    """state.retryable() for an error at hand."""
    kind, status = kind_of(error)
    short = kind == "io" and str(error).startswith(("size mismatch", "MD5 mismatch"))
    return kind in ("connection", "timeout") or (kind == "http" and (status is None or status == 429 or status >= 500)) or short


@dataclass(frozen=True)
class Source:
    """Where bytes come from: session() is made once for a task, open(session, url) gives a stream."""

    open: Callable[[object, str], BinaryIO]
    session: Callable[[], object] = lambda: None


def local_store(root: str, prefix: str) -> Source:
    """Files of a folder in the place of a store whose urls begin with prefix."""

    def get(_, url: str) -> BinaryIO:
        if not url.startswith(prefix):
            raise Answer(404)
        return open(os.path.join(root, url[len(prefix) :].lstrip("/")), "rb")

    return Source(get)


def fetch_one(source: Source, session, url: str, target: str, expected: int | None, md5: str | None, attempts: int, wait: float, any_error: bool) -> tuple:
    """Fetch a file; the values of RESULT.  any_error: errors of every kind are tried again."""
    folder, name = os.path.split(target)
    part = os.path.join(folder, f".{name}.part")
    for attempt in range(1, attempts + 1):
        try:
            os.makedirs(folder, exist_ok=True)
            with source.open(session, url) as f, open(part, "wb") as out:
                while piece := f.read(1 << 20):
                    out.write(piece)
            size = os.stat(part).st_size
            if expected and size != expected:
                raise OSError(f"size mismatch for {name}: expected {expected}, got {size}")
            if size <= 0:
                raise OSError(f"downloaded file is empty: {name}")
            if md5:
                got = files.file_md5(part)
                if got != md5:
                    raise OSError(f"MD5 mismatch for {name}: expected {md5}, got {got}")
            os.replace(part, target)
            s = os.stat(target)
            return "complete", "downloaded", s.st_size, s.st_mtime_ns, None
        except Exception as error:  # noqa: BLE001  whatever it is, it goes into the row
            if os.path.exists(part):
                os.unlink(part)
            if attempt == attempts or not (any_error or may_pass(error)):
                return "failed", "failed", None, None, str(error)
            time.sleep(wait * 2 ** (attempt - 1))
    raise ValueError("there must be an attempt")


def carried_out(plan: DataFrame, source: Source, attempts: int = 4, wait: float = 2.0, any_error: bool = False, parallel: int = 4) -> DataFrame:
    """The plan (url, target, expected_size, md5sum, action, local_actual_size, local_mtime_ns and others) with RESULT's columns.

    Rows whose action is skip are taken over as complete.  Writing the result is what fetches.
    """
    keep = [c for c in plan.columns if c not in ("action", "local_actual_size", "local_mtime_ns", "status", "last_action", "error")]
    schema = StructType([f for f in plan.schema.fields if f.name in keep])
    for field in StructType.fromDDL(RESULT).fields:
        schema.add(field)

    def run(it) -> Iterator:
        import pyarrow as pa

        session, have = None, False
        for b in it:
            rows = b.to_pylist()
            out = []
            for r in rows:
                if r["action"] == "skip":
                    out.append(("complete", "skipped", r["local_actual_size"], r["local_mtime_ns"], None))
                    continue
                if not have:
                    session, have = source.session(), True
                out.append(fetch_one(source, session, r["url"], r["target"], r["expected_size"], r["md5sum"], attempts, wait, any_error))
            kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string())
            cols = [b.column(b.schema.get_field_index(c)) for c in keep] + [pa.array([o[k] for o in out], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(cols, [f.name for f in schema.fields])

    return plan.repartition(parallel).mapInArrow(run, schema)


def with_files(rows: DataFrame, target: str = "target") -> DataFrame:
    """rows with local_actual_size and local_mtime_ns of their target files, null where there is none."""
    found = files.file_stats(rows.select(F.col(target).alias("path")).distinct()).select(F.col("path").alias(target), F.col("size").alias("local_actual_size"), F.col("mtime_ns").alias("local_mtime_ns"))
    return rows.drop("local_actual_size", "local_mtime_ns").join(found, target, "left")


def product_plan(manifest: DataFrame, folder: str, state: DataFrame | None) -> DataFrame:
    """A plan for whole products (url, granule, expected_size, sizeMB, md5sum), each url once.

    A checksum of a file is only read where its size doesn't rule it out and no recorded check stands.
    """
    rows = files.require(manifest, "url")
    for c, kind in (("granule", "string"), ("expected_size", "long"), ("sizeMB", "double"), ("md5sum", "string")):
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(None).cast(kind))
    rows = rows.select("url", "granule", "expected_size", "sizeMB", "md5sum").filter("url is not null")
    rows = R.first_per_key(rows, ["url"], ["granule", "expected_size", "sizeMB", "md5sum"])
    rows = rows.select("url", "granule", T.url_filename(F.col("url"), F.col("granule")).alias("filename"), N.expected_size(F.col("expected_size"), F.col("sizeMB")).alias("expected_size"), T.normal_md5(F.col("md5sum")).alias("md5sum"))
    rows = with_files(rows.withColumn("target", F.concat(F.lit(folder.rstrip("/") + "/"), "filename")))
    old = ("status", "filename", "local_actual_size", "local_mtime_ns", "fingerprint_version", "md5sum")
    if state is not None:
        known = state.select("url", *[F.col(c).alias("old_" + c) for c in old])
        rows = rows.join(known, "url", "left")
    else:
        rows = rows.withColumns({"old_" + c: F.lit(None).cast("long" if c in ("local_actual_size", "local_mtime_ns", "fingerprint_version") else "string") for c in old})
    same = (F.col("old_status") == "complete") & (F.col("old_filename") == F.col("filename")) & (F.col("old_local_actual_size") == F.col("local_actual_size")) & (T.normal_md5(F.col("old_md5sum")) == F.col("md5sum"))
    verified = F.coalesce(same, F.lit(False)) & S.fingerprint_matches(F.col("old_fingerprint_version"), F.col("old_local_mtime_ns"), F.col("local_mtime_ns"))
    rows = rows.withColumn("verified", verified)
    unsure = F.col("local_actual_size").isNotNull() & F.col("md5sum").isNotNull() & ~F.col("verified") & F.coalesce(F.col("expected_size") == F.col("local_actual_size"), F.lit(True))
    sums = files.file_stats(rows.filter(unsure).select(F.col("target").alias("path")).distinct(), checksum=True).select(F.col("path").alias("target"), F.col("md5").alias("file_md5"))
    rows = rows.join(sums, "target", "left")
    skip = S.product_skipped(F.col("local_actual_size"), F.col("expected_size"), F.col("md5sum"), F.col("verified"), F.col("file_md5"), F.col("old_status"), F.col("old_local_actual_size"))
    return rows.select("url", "filename", "target", "expected_size", "md5sum", "local_actual_size", "local_mtime_ns", F.when(skip, "skip").otherwise("download").alias("action"))


def product_state(done: DataFrame) -> DataFrame:
    """Rows of the declared state of downloads."""
    return S.state_row(done, F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss"))


def asset_plan(images: DataFrame, folder: str, bucket: str = "s3://eodata") -> DataFrame:
    """A plan for scenes' assets (the declared image table)."""
    rows = images.withColumns({
        "target": F.concat_ws("/", F.lit(folder.rstrip("/")), "safedir", "img_path_in_safedir"), "url": F.concat(F.lit(bucket), T.scene_root(F.col("s3_path")), F.lit("/"), F.col("img_path_in_safedir")),
        "expected_size": F.nullif("s3_expected_size", F.lit(0)), "md5sum": F.lit(None).cast("string"), "label": T.asset_label(F.col("band_name"), F.col("resolution_m")),
    })
    rows = with_files(rows)
    act = S.asset_action(F.col("local_actual_size"), F.col("expected_size"))
    return rows.withColumn("action", F.when(act == "skip", "skip").otherwise("download")).withColumn("resized", act == "redownload")


def scene_results(scenes: DataFrame, done: DataFrame, expected: list[tuple[str, int]], level1: Column | None) -> DataFrame:
    """For each scene (Name): succeeded, failed and skipped, labels in order, and ok.

    A band that was asked for and not found is MISSING:label, a metadata file too where level1 says
    which one (None: there are none), and a scene of which nothing was found is NO_ASSETS_FOUND.
    """
    labels = lambda action: F.sort_array(F.collect_set(F.when(F.col("last_action") == action, F.col("label"))))
    per = done.groupBy(F.col("safedir").alias("Name")).agg(*[labels(a).alias(n) for a, n in (("downloaded", "succeeded"), ("failed", "failed"), ("skipped", "skipped"))], F.collect_set("label").alias("found"))
    rows = scenes.select("Name").distinct().join(per, "Name", "left")
    empty = F.array().cast("array<string>")
    wanted = F.array(*[F.lit(f"{b}@{r}m" if r else b) for b, r in sorted(set(expected))]).cast("array<string>")
    if level1 is not None:
        plain = F.array(*[F.lit(b) for b in sorted({b for b, _ in expected})]).cast("array<string>")
        first = F.when(level1, "MTD_MSIL1C").otherwise("MTD_MSIL2A")
        wanted = F.concat(F.when(level1, plain).otherwise(wanted), F.array(first, F.lit("MTD_TL")))
    lacking = F.transform(F.array_except(wanted, F.coalesce("found", empty)), lambda x: F.concat(F.lit("MISSING:"), x))
    failed = F.when(F.col("found").isNull(), F.array(F.lit("NO_ASSETS_FOUND"))).otherwise(F.concat(F.col("failed"), lacking))
    rows = rows.select("Name", F.coalesce("succeeded", empty).alias("succeeded"), failed.alias("failed"), F.coalesce("skipped", empty).alias("skipped"))
    return rows.withColumn("ok", F.size("failed") == 0)


def totals(done: DataFrame) -> dict[str, int]:
    """How many files were downloaded, skipped and failed."""
    names = ("downloaded", "skipped", "failed")
    row = done.agg(*[F.count_if(F.col("last_action") == n).alias(n) for n in names]).first()
    return {n: row[n] for n in names}


def observed(done: DataFrame, seen) -> DataFrame:
    """done, with the counts of totals() in an Observation once it has been written: what callbacks on each file would add up to."""
    return done.observe(seen, *[F.count_if(F.col("last_action") == n).alias(n) for n in ("downloaded", "skipped", "failed")], F.count("*").alias("files"))
