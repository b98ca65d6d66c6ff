"""Keyed state kept up by micro-batches.

A state's rows are dealt to buckets by a hash of their key; a batch rewrites only the buckets that it
touches, and all of them change at once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from orbitframe.operators.relational import missing, upsert
from orbitframe.sources import sinks

BUCKETS = 64
BUCKET = "__bucket"


@dataclass(frozen=True)
class Roots:
    """Where things are kept: searches and what they found, shared by all outputs; and an output with its own state."""

    cache: str
    output: str

    @property
    def discovered(self) -> str:
        """The image table of all scenes that were looked into."""
        return f"{self.cache}/all_downloaded_images.parquet"

    def downloads(self, service: str) -> str:
        """The state of the files under this output."""
        return f"{self.output}/.orbitframe/{service}_downloads.parquet"


def merge_rows(batch: DataFrame, path: str, keys: list[str], order: list[str], buckets: int = BUCKETS) -> None:
    """Upsert a batch into the state at path; the same batch again changes nothing."""
    spark = batch.sparkSession
    new = batch.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    touched = sorted(str(r[0]) for r in new.select(BUCKET).distinct().collect())  # at most the number of buckets
    if not touched:
        return
    now = sinks.pointer(path)
    have = [b for b in touched if now and b in now["folders"]]
    old = sinks.read_table(spark, path, have) if have else batch.limit(0)
    merged = upsert(old, batch, keys, order).withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    sinks.replace_parts(merged.repartition(BUCKET), path, BUCKET, touched)


def keep_state(stream: DataFrame, state_path: str, checkpoint: str, keys: list[str], order: list[str]) -> StreamingQuery:
    """Upsert each micro-batch of all rows at hand into a state table, then stop.

    The table changes at once and a batch that runs again gives the same table, so a restart neither
    loses nor doubles rows.
    """
    return stream.writeStream.foreachBatch(lambda batch, _: merge_rows(batch, state_path, keys, order)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def pending(spark: SparkSession, products: DataFrame, state_path: str, keys: list[str]) -> DataFrame:
    """Products that the state does not have as complete."""
    if not sinks.table_exists(state_path):
        return products
    return missing(products, sinks.read_table(spark, state_path).filter(F.col("status") == "complete"), keys)
