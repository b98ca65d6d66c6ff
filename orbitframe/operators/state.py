"""Decision rules for files and their recorded state, and storage estimates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FINGERPRINT_VERSION = 1
#: Recorded times of version 0 went through a 64-bit float.
OLD_TOLERANCE_NS = 256


def asset_action(local: Column, expected: Column) -> Column:
    """What to do about an asset, from its file's size (null: no file) and the expected one (null or 0: unknown)."""
    known = F.coalesce(expected, F.lit(0)) > 0
    return (
        F.when(local.isNull(), "download")
        .when(known & (local == expected), "skip")
        .when(known, "redownload")
        .when(local > 0, "skip")
        .otherwise("download")
    )


def fingerprint_matches(version: Column, recorded_ns: Column, now_ns: Column) -> Column:
    exact = recorded_ns == now_ns
    near = F.coalesce(F.abs(recorded_ns - now_ns) <= OLD_TOLERANCE_NS, F.lit(False))
    return F.coalesce(F.when(F.coalesce(version == FINGERPRINT_VERSION, F.lit(False)), exact).otherwise(near), F.lit(False))


def product_skipped(local: Column, expected: Column, checksum: Column, verified: Column, file_checksum: Column, status: Column, recorded: Column) -> Column:
    """Whether a product's download is skipped.

    verified: its fingerprint matches a checked one; file_checksum: a fresh one of the file.
    """
    sound = checksum.isNull() | F.coalesce(verified, F.lit(False)) | F.coalesce(file_checksum == checksum, F.lit(False))
    same_size = F.coalesce(local == expected, F.lit(False))
    recorded_ok = F.coalesce((status == "complete") & (recorded == local), F.lit(False))
    unknown = expected.isNull()
    return local.isNotNull() & ((same_size & sound) | (unknown & checksum.isNotNull() & sound) | (unknown & checksum.isNull() & recorded_ok))


def retryable(kind: Column, status: Column, message: Column) -> Column:
    """Whether an error may pass: kinds auth, http, connection, timeout and io."""
    return (
        F.when(kind == "auth", False)
        .when(kind == "http", status.isNull() | (status == 429) | (status >= 500))
        .when(kind.isin("connection", "timeout"), True)
        .when(kind == "io", message.rlike("^(size mismatch|MD5 mismatch)"))
        .otherwise(False)
    )


def validation_error(name: Column, expected: Column, actual: Column, checksum: Column, file_checksum: Column) -> Column:
    """What is wrong with a downloaded file, null if nothing is."""
    size = F.concat(F.lit("size mismatch for "), name, F.lit(": expected "), expected.cast("string"), F.lit(", got "), actual.cast("string"))
    content = F.concat(F.lit("MD5 mismatch for "), name, F.lit(": expected "), checksum, F.lit(", got "), file_checksum)
    return F.when(expected.isNotNull() & (actual != expected), size).when(checksum.isNotNull() & (file_checksum != checksum), content)


def storage_by_scene(assets: DataFrame, scene: str, expected: str, local: str) -> DataFrame:
    """Each scene's footprint and additional bytes; assets of unknown size count for neither."""
    size = F.when(F.col(expected) > 0, F.col(expected).cast("long"))
    absent = ~F.coalesce(F.col(local) == F.col(expected), F.lit(False))
    return assets.groupBy(scene).agg(
        F.coalesce(F.sum(size), F.lit(0)).alias("footprint"), F.coalesce(F.sum(F.when(absent, size)), F.lit(0)).alias("additional")
    )


def projected(total: Column, seen: Column, of: Column) -> Column:
    """A total carried on from the scenes seen to all, halves to even."""
    return F.bround(total + total / seen * F.greatest(F.lit(0), of - seen)).cast("long")


def storage_projection(scenes: DataFrame, of: Column) -> DataFrame:
    """One row: scenes resolved, and the projected footprint and additional bytes of `of` scenes."""
    one = scenes.agg(F.count("*").alias("resolved"), F.sum("footprint").alias("f"), F.sum("additional").alias("a"))
    return one.select("resolved", projected(F.col("f"), F.col("resolved"), of).alias("footprint"), projected(F.col("a"), F.col("resolved"), of).alias("additional"))


def running_projection(scenes: DataFrame, group: str, order: list[str], of: Column, blocks: int = 64) -> DataFrame:
    """The projection after each scene, within a group, in the order given.

    The sums run in two steps, so that one group can be of any size: the first order column, a number
    or a time, is cut at quantiles; blocks' totals are summed up over the few blocks of a group, and
    rows within their block.
    """
    cuts = scenes.agg(F.percentile_approx(F.col(order[0]), [k / blocks for k in range(1, blocks)], 10_000)).first()[0] or []
    later = F.lit(0)
    for c in sorted(set(cuts)):
        later = later + (F.col(order[0]) > F.lit(c)).cast("int")
    rows = scenes.withColumn("__block", F.coalesce(later, F.lit(-1)))
    kinds = {"resolved": F.lit(1).cast("long"), "f": F.col("footprint"), "a": F.col("additional")}
    totals = rows.groupBy(group, "__block").agg(*[F.sum(c).alias("__" + k) for k, c in kinds.items()])
    earlier = Window.partitionBy(group).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(group, "__block", *[F.coalesce(F.sum("__" + k).over(earlier), F.lit(0)).alias("__" + k) for k in kinds])
    w = Window.partitionBy(group, "__block").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({k: F.sum(c).over(w) for k, c in kinds.items()})
    joined = rows.withColumn("__g", F.col(group)).drop(group).join(totals, [F.col("__g").eqNullSafe(F.col(group)), rows["__block"] == totals["__block"]]).drop("__g", "__block")
    joined = joined.withColumns({k: F.col(k) + F.col("__" + k) for k in kinds})
    out = joined.withColumns({"projected_footprint": projected(F.col("f"), F.col("resolved"), of), "projected_additional": projected(F.col("a"), F.col("resolved"), of)})
    return out.select(*scenes.columns, "resolved", "projected_footprint", "projected_additional")


def state_row(products: DataFrame, checked_at: Column) -> DataFrame:
    """The recorded state of products that have the columns it needs."""
    return products.select(
        "url", "filename", "expected_size", "local_actual_size", "local_mtime_ns", F.lit(FINGERPRINT_VERSION).alias("fingerprint_version"),
        "status", "last_action", checked_at.alias("checked_at"), "md5sum", "error",
    )
