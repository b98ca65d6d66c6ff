"""Declared schemas of manifests and state tables, and how found files are brought into them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The tables' columns in their order.
SCENES = "Id string, Name string, S3Path string, ContentDate string, GeoFootprint string, query_id string"
MANIFEST = "granule string, url string, beamMode string, flightDirection string, polarization string, relativeOrbit long, startTime string, stopTime string, expected_size long, sizeMB double, md5sum string"
DOWNLOADS = "url string, filename string, expected_size long, local_actual_size long, local_mtime_ns long, fingerprint_version long, status string, last_action string, checked_at string, md5sum string, error string"
IMAGES = "safedir string, s3_path string, band_name string, resolution_m int, img_path_in_safedir string, s3_expected_size long, local_actual_size long, asset_type string, local_path string, download_status string"
IMAGE_KEY = ["safedir", "img_path_in_safedir"]


def fields(schema: str) -> list[tuple[str, str]]:
    return [tuple(x.split(" ", 1)) for x in schema.split(", ")]


def conform(df: DataFrame, schema: str) -> DataFrame:
    """df with just the declared columns, in order and cast; ones it lacks are null.

    All-null columns that a writer stored under another type, and stored row numbers, end here.
    """
    have = set(df.columns)

    def one(name: str, kind: str):
        if name not in have:
            return F.lit(None).cast(kind).alias(name)
        if kind == "string" and dict(df.dtypes)[name].startswith(("struct", "array", "map")):
            return F.to_json(name).alias(name)
        return F.col(name).cast(kind).alias(name)

    return df.select(*[one(n, k) for n, k in fields(schema)])


def require(df: DataFrame, *columns: str) -> DataFrame:
    """df if it has the columns, else an error that names those it lacks."""
    lacking = [c for c in columns if c not in df.columns]
    if lacking:
        raise ValueError(f"columns are missing: {lacking}")
    return df


def read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet table in a declared schema."""
    return conform(spark.read.parquet(path), schema)


def empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)
