"""Pixel functions on tiles: each embedding as 8 x 8 pixels."""

from pyspark.sql import functions as F

from orbitframe.functions import pixels as P
from orbitframe.plans.registry import query

PIXELS = "SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(abs(x::DOUBLE) * 10000) AS INTEGER)) AS px, list_transform(embedding, lambda x: CAST(floor(abs(x::DOUBLE) * 1000) AS INTEGER) % 14) AS scl FROM embeddings"
EACH = f"SELECT vec_id, label, i, px[i + 1] AS v, scl[i + 1] AS c FROM ({PIXELS}), (SELECT unnest(range(0, 64)) AS i)"


def tiles(t):
    whole = lambda f: F.transform("embedding", lambda x: F.floor(F.abs(x.cast("double")) * f).cast("int"))
    return t.embeddings.select("vec_id", "label", whole(10000).alias("px"), F.transform(whole(1000), lambda x: x % 14).alias("scl"))


def flat(df, *arrays):
    """One row for each pixel: vec_id, i, and each array's value."""
    zipped = F.arrays_zip(*[F.col(a) for a in arrays])
    return df.select("vec_id", F.posexplode(zipped).alias("i", "z")).select("vec_id", "i", *[F.col(f"z.{a}").alias(a) for a in arrays])


@query(f"SELECT vec_id, i::INTEGER AS i, CASE WHEN v = 65535 THEN v ELSE least(greatest(v - 1000, 0), 65534) END AS px FROM ({EACH})")
def pixel_offset(t):
    return flat(tiles(t).select("vec_id", P.subtract_offset(F.col("px"), F.lit(1000)).alias("px")), "px")


@query(f"SELECT vec_id, i::INTEGER AS i, CASE WHEN c = 0 OR c > 11 OR c IN (3, 8, 9) THEN 65535 ELSE v END AS px FROM ({EACH})")
def pixel_mask(t):
    return flat(tiles(t).select("vec_id", P.mask_by_class(F.col("px"), F.col("scl"), [3, 8, 9]).alias("px")), "px")


@query(f"SELECT vec_id, i::INTEGER AS i, CASE WHEN c = 0 OR c > 11 OR c IN (3, 8, 9) THEN 1 ELSE 0 END AS m FROM ({EACH})")
def binary_mask(t):
    return flat(tiles(t).select("vec_id", P.binary_mask(F.col("scl"), [3, 8, 9]).alias("m")), "m")


@query(f"SELECT vec_id, ((i // 8) // 3 * 3 + (i % 8) // 3)::INTEGER AS i, max(CASE WHEN c = 0 OR c > 11 OR c IN (3, 8, 9) THEN 1 ELSE 0 END) AS m FROM ({EACH}) GROUP BY 1, 2")
def resample_max(t):
    return flat(tiles(t).select("vec_id", P.coarsen_max(P.binary_mask(F.col("scl"), [3, 8, 9]), 8, 3).alias("m")), "m")


@query(f"SELECT vec_id, ((i // 8) // 2 * 4 + (i % 8) // 2)::INTEGER AS i, avg(v) AS px FROM ({EACH}) GROUP BY 1, 2")
def resample_avg(t):
    return flat(tiles(t).select("vec_id", P.coarsen_mean(F.col("px"), 8, 2).alias("px")), "px")


@query(f"SELECT e.vec_id, n.j::INTEGER AS i, e.v AS px FROM ({EACH}) e JOIN (SELECT unnest(range(0, 256)) AS j) n ON e.i = (n.j // 16) // 2 * 8 + (n.j % 16) // 2")
def resample_near(t):
    return flat(tiles(t).select("vec_id", P.nearest(F.col("px"), 8, 16).alias("px")), "px")


def masked(rows):
    """Tiles without their offset, and without the coarse cells that hold a masked pixel."""
    coarse = P.coarsen_max(P.binary_mask(F.col("scl"), [3]), 8, 2)
    out = rows.withColumn("coarse", coarse).select("vec_id", P.mask_by_flag(P.subtract_offset(F.col("px"), F.lit(500)), P.nearest(F.col("coarse"), 4, 8)).alias("px"))
    return flat(out, "px")


@query(f"""WITH o AS (SELECT vec_id, i, c, least(greatest(v - 500, 0), 65534) AS v FROM ({EACH})), m AS (SELECT vec_id, (i // 8) // 2 * 4 + (i % 8) // 2 AS j, max(CASE WHEN c = 0 OR c > 11 OR c = 3 THEN 1 ELSE 0 END) AS m FROM o GROUP BY 1, 2)
SELECT o.vec_id, o.i::INTEGER AS i, CASE WHEN m.m = 1 THEN 65535 ELSE o.v END AS px FROM o JOIN m ON o.vec_id = m.vec_id AND m.j = (o.i // 8) // 2 * 4 + (o.i % 8) // 2""")
def masked_band(t):
    return masked(tiles(t))
