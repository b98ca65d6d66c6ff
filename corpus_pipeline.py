"""A training corpus from the documents table: quality rules, line dedup, near-dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept; all but the last
return the columns of documents, whatever others docs has.  run() writes each stage's result as
Parquet in the shared folder and reads it again, so a lost executor costs one stage at most.

All stages treat a null text as an empty one, take long texts whole, and give an empty table for one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbitframe.llm import decontaminate, line_dedup, minhash_dedup, packing, quality_rules
from orbitframe.llm._store import materialise

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or whose posterior quality is under 0.5 go.

    Rows are judged one by one: repeated ones, and such without an id, like all others; empty texts fail.
    """
    return quality_rules.keep_good(docs.select(*COLUMNS))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go; a document of which only white space is left then goes too.

    Rows that are equal in id and text lose the same lines; rows without an id lose none.  n_chars
    is counted anew.
    """
    found = line_dedup.drop_lines(docs, extra=("lang", "source"))
    found = found.filter((F.col("n_removed") == 0) | F.regexp_like("kept", F.lit(r"[^\x20\x09-\x0D]")))
    return found.select("doc_id", F.col("kept").alias("text"), "lang", "source", F.length("kept").cast("long").alias("n_chars"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (similarity 0.8) one row stays: that of the smallest id, rows without one last.

    Rows count by themselves: of rows that are wholly equal one stays, and two texts under one id are
    two documents.  Empty texts are nobody's copies; all stay.
    """
    numbered = materialise(docs.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id()), "numbered")
    groups = minhash_dedup.near_duplicates(numbered.select(F.col("row").alias("doc_id"), "text"))
    groups = groups.select(F.col("doc_id").alias("row"), F.col("component_id").alias("component"))
    ids = numbered.select("row", F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row").alias("rank"))
    first = groups.join(ids.hint("merge"), "row").groupBy("component").agg(F.min("rank")["row"].alias("row"))
    return numbered.join(first.select("row").hint("merge"), "row", "left_semi").select(*COLUMNS)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; rows are judged one by one, by their text alone."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.contaminated(docs, items, extra=("text", "lang", "source", "n_chars"))
    return found.filter("not contaminated").select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all windows; every row is packed, repeated ones and such without an id too."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality rules", quality), ("line dedup", lines), ("near-dedup", near_duplicates), ("decontamination", benchmark), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


#: SQL can't express the fitted posteriors nor BM25 with a greedy fill; the tests use brute force.
ORACLE_SQL = None
