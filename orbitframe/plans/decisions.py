"""Skip, retry and verification rules, and storage estimates."""

from pyspark.sql import functions as F

from orbitframe.functions import text as T
from orbitframe.operators import state as S
from orbitframe.plans.registry import query


@query("""WITH a AS (SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber % 4 <> 0 THEN (l_quantity * 10)::BIGINT END AS local,
CASE l_linenumber % 3 WHEN 0 THEN 0 WHEN 1 THEN (l_quantity * 10)::BIGINT ELSE 77 END AS expected FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN local IS NULL THEN 'download' WHEN expected > 0 AND local = expected THEN 'skip' WHEN expected > 0 THEN 'redownload'
WHEN local > 0 THEN 'skip' ELSE 'download' END AS action FROM a""")
def skip_asset(t):
    q, n = (F.col("l_quantity") * 10).cast("long"), F.col("l_linenumber")
    expected = F.when(n % 3 == 0, F.lit(0).cast("long")).when(n % 3 == 1, q).otherwise(77)
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", S.asset_action(F.when(n % 4 != 0, q), expected).alias("action"))


PRODUCTS = """SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey END AS local, CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 3 = 1 THEN o_custkey ELSE 5 END AS expected,
CASE WHEN o_orderkey % 2 = 0 THEN md5(o_orderpriority) END AS checksum, o_orderkey % 5 = 0 AS verified, CASE WHEN o_orderkey % 4 < 2 THEN md5(o_orderpriority) ELSE 'x' END AS file_checksum,
CASE WHEN o_orderstatus = 'F' THEN 'complete' ELSE 'failed' END AS status, o_custkey AS recorded FROM orders"""


def products(t):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    checksum = F.md5("o_orderpriority")
    return t.orders.select(
        "o_orderkey", F.when(k % 7 != 0, c).alias("local"), F.when(k % 3 == 1, c).when(k % 3 == 2, F.lit(5).cast("long")).alias("expected"),
        F.when(k % 2 == 0, checksum).alias("checksum"), (k % 5 == 0).alias("verified"), F.when(k % 4 < 2, checksum).otherwise("x").alias("file_checksum"),
        F.when(F.col("o_orderstatus") == "F", "complete").otherwise("failed").alias("status"), c.alias("recorded"),
    )


@query(f"""WITH p AS ({PRODUCTS}) SELECT o_orderkey, local IS NOT NULL AND ((coalesce(local = expected, false) AND (checksum IS NULL OR verified OR file_checksum = checksum))
OR (expected IS NULL AND checksum IS NOT NULL AND (verified OR file_checksum = checksum)) OR (expected IS NULL AND checksum IS NULL AND status = 'complete' AND recorded = local)) AS skipped FROM p""")
def skip_product(t):
    return products(t).select("o_orderkey", S.product_skipped(*[F.col(c) for c in ("local", "expected", "checksum", "verified", "file_checksum", "status", "recorded")]).alias("skipped"))


@query(f"""WITH p AS ({PRODUCTS}) SELECT o_orderkey, CASE WHEN expected IS NOT NULL AND local <> expected THEN 'size mismatch for f: expected ' || expected || ', got ' || local
WHEN checksum IS NOT NULL AND file_checksum <> checksum THEN 'MD5 mismatch for f: expected ' || checksum || ', got ' || file_checksum END AS error FROM p WHERE local IS NOT NULL""")
def validate_product(t):
    rows = products(t).filter("local is not null")
    return rows.select("o_orderkey", S.validation_error(F.lit("f"), F.col("expected"), F.col("local"), F.col("checksum"), F.col("file_checksum")).alias("error"))


@query("""WITH e AS (SELECT event_id, CASE event_type WHEN 'click' THEN 'auth' WHEN 'error' THEN 'http' WHEN 'purchase' THEN 'timeout' WHEN 'signup' THEN 'io' ELSE 'other' END AS kind,
CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 404 WHEN 2 THEN 429 WHEN 3 THEN 500 ELSE 200 END AS status, CASE event_id % 3 WHEN 0 THEN 'size mismatch for a' WHEN 1 THEN 'MD5 mismatch' ELSE 'disk full' END AS message FROM events)
SELECT event_id, CASE kind WHEN 'auth' THEN false WHEN 'http' THEN status IS NULL OR status = 429 OR status >= 500 WHEN 'timeout' THEN true
WHEN 'io' THEN message LIKE 'size mismatch%' OR message LIKE 'MD5 mismatch%' ELSE false END AS retry FROM e""")
def retry_class(t):
    e, i = F.col("event_type"), F.col("event_id")
    kind = F.when(e == "click", "auth").when(e == "error", "http").when(e == "purchase", "timeout").when(e == "signup", "io").otherwise("other")
    status = F.when(i % 5 == 1, 404).when(i % 5 == 2, 429).when(i % 5 == 3, 500).when(i % 5 == 4, 200)
    message = F.when(i % 3 == 0, "size mismatch for a").when(i % 3 == 1, "MD5 mismatch").otherwise("disk full")
    return t.events.select("event_id", S.retryable(kind, status, message).alias("retry"))


@query("""SELECT event_id, CASE WHEN event_id % 3 = 0 THEN event_id % 700 - 350 = 0 WHEN event_id % 11 = 0 THEN false ELSE abs(event_id % 700 - 350) <= 256 END AS same FROM events""")
def fingerprint(t):
    i = F.col("event_id")
    now = (F.unix_micros(F.col("ts").cast("timestamp")) * 1000).cast("long")
    old = F.when((i % 3 != 0) & (i % 11 == 0), F.lit(None).cast("long")).otherwise(now + i % 700 - 350)
    return t.events.select("event_id", S.fingerprint_matches(F.when(i % 3 == 0, 1), old, now).alias("same"))


ASSETS = "SELECT l_orderkey, l_suppkey, CASE WHEN l_linenumber = 7 THEN 0 ELSE (l_quantity * 100)::BIGINT END AS expected, CASE WHEN l_returnflag = 'A' THEN (l_quantity * 100)::BIGINT WHEN l_returnflag = 'N' THEN 1 END AS local FROM lineitem"
BY_SCENE = f"""SELECT l_orderkey, any_value(l_suppkey) AS s, coalesce(sum(expected) FILTER (WHERE expected > 0), 0)::BIGINT AS footprint,
coalesce(sum(expected) FILTER (WHERE expected > 0 AND NOT coalesce(local = expected, false)), 0)::BIGINT AS additional FROM ({ASSETS}) GROUP BY l_orderkey"""


def scenes(t):
    q = (F.col("l_quantity") * 100).cast("long")
    rows = t.lineitem.select(
        "l_orderkey", F.when(F.col("l_linenumber") == 7, F.lit(0).cast("long")).otherwise(q).alias("expected"),
        F.when(F.col("l_returnflag") == "A", q).when(F.col("l_returnflag") == "N", F.lit(1).cast("long")).alias("local"),
    )
    return S.storage_by_scene(rows, "l_orderkey", "expected", "local")


@query(f"SELECT l_orderkey, footprint, additional FROM ({BY_SCENE})")
def storage_by_scene(t):
    return scenes(t)


@query(f"""WITH s AS (SELECT count(*) AS n, sum(footprint) AS f, sum(additional) AS a FROM ({BY_SCENE}))
SELECT n AS resolved, round_even((f + f::DOUBLE / n * greatest(0, 20000 - n))::DOUBLE, 0)::BIGINT AS footprint, round_even((a + a::DOUBLE / n * greatest(0, 20000 - n))::DOUBLE, 0)::BIGINT AS additional FROM s""")
def storage_projection(t):
    return S.storage_projection(scenes(t), F.lit(20000))


@query(f"""WITH s AS (SELECT *, l_orderkey % 100 AS g FROM ({BY_SCENE})), r AS (SELECT l_orderkey, row_number() OVER w AS resolved, sum(footprint) OVER w AS f, sum(additional) OVER w AS a FROM s WINDOW w AS (PARTITION BY g ORDER BY l_orderkey))
SELECT l_orderkey, resolved, round_even((f + f::DOUBLE / resolved * greatest(0, 500 - resolved))::DOUBLE, 0)::BIGINT AS projected_footprint,
round_even((a + a::DOUBLE / resolved * greatest(0, 500 - resolved))::DOUBLE, 0)::BIGINT AS projected_additional FROM r""")
def storage_running(t):
    rows = scenes(t).withColumn("g", F.col("l_orderkey") % 100)
    return S.running_projection(rows, "g", ["l_orderkey"], F.lit(500)).select("l_orderkey", "resolved", "projected_footprint", "projected_additional")


@query(f"""WITH s AS (SELECT l_orderkey, footprint AS f, additional AS a FROM ({BY_SCENE}))
SELECT l_orderkey, CASE WHEN a > 5000 THEN '⚠ ' ELSE '' END || CASE WHEN l_orderkey % 20 < 10 THEN 'early sample ' || l_orderkey % 20 || '/10' ELSE 'estimate' END || ': dataset ~'
|| CASE WHEN f < 1024 THEN printf('%d B', f) WHEN f < 1048576 THEN printf('%.1f KiB', f / 1024.0) WHEN f < 1073741824 THEN printf('%.1f MiB', f / 1048576.0) ELSE printf('%.1f GiB', f / 1073741824.0) END
|| ' total, ~' || CASE WHEN a < 1024 THEN printf('%d B', a) WHEN a < 1048576 THEN printf('%.1f KiB', a / 1024.0) WHEN a < 1073741824 THEN printf('%.1f MiB', a / 1048576.0) ELSE printf('%.1f GiB', a / 1073741824.0) END
|| ' additional; 4.9 KiB free at start' AS text FROM s""")
def storage_text(t):
    return scenes(t).select("l_orderkey", T.storage_text(F.col("l_orderkey") % 20, F.lit(40), F.col("footprint"), F.col("additional"), F.lit(5000)).alias("text"))


@query("""SELECT 'http://x/' || o_orderkey AS url, o_orderkey || '.zip' AS filename, o_custkey AS expected_size, o_custkey AS local_actual_size, o_orderkey * 1000 AS local_mtime_ns, 1 AS fingerprint_version,
'complete' AS status, 'downloaded' AS last_action, '2024-01-01T00:00:00' AS checked_at, md5(o_orderpriority) AS md5sum, NULL AS error FROM orders""")
def state_row(t):
    rows = t.orders.select(
        F.concat(F.lit("http://x/"), "o_orderkey").alias("url"), F.concat("o_orderkey", F.lit(".zip")).alias("filename"), F.col("o_custkey").alias("expected_size"),
        F.col("o_custkey").alias("local_actual_size"), (F.col("o_orderkey") * 1000).alias("local_mtime_ns"), F.lit("complete").alias("status"),
        F.lit("downloaded").alias("last_action"), F.md5("o_orderpriority").alias("md5sum"), F.lit(None).cast("string").alias("error"),
    )
    return S.state_row(rows, F.lit("2024-01-01T00:00:00"))
