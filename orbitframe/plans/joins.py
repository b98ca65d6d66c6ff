"""Lookups, completeness and preference joins."""

from pyspark.sql import functions as F

from orbitframe.functions import numbers as N
from orbitframe.operators import relational as R
from orbitframe.plans.registry import query


@query("""SELECT c_custkey, coalesce(o_orderkey, -1) AS last_order FROM customer LEFT JOIN (SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS n FROM orders) WHERE n = 1) ON c_custkey = o_custkey""")
def lookup_last(t):
    orders = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    return R.lookup_last(t.customer.select("c_custkey"), orders, ["c_custkey"], ["o_orderkey"]).select("c_custkey", F.coalesce("o_orderkey", F.lit(-1)).alias("last_order"))


@query("""WITH n AS (SELECT o_custkey, count(*) AS k FROM orders GROUP BY 1) SELECT c_custkey, coalesce(k, 0) AS n FROM customer LEFT JOIN n ON c_custkey = o_custkey""")
def lookup_fill(t):
    n = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    return t.customer.select("c_custkey").join(n, "c_custkey", "left").withColumn("n", F.coalesce("n", F.lit(0)))


@query("""WITH f AS (SELECT o_custkey, min(o_orderkey) AS k FROM orders WHERE o_orderstatus = 'F' GROUP BY 1), o AS (SELECT o_custkey, min(o_orderkey) AS k FROM orders WHERE o_orderstatus = 'O' GROUP BY 1)
SELECT c_custkey, coalesce(f.k, o.k, -1) AS k FROM customer LEFT JOIN f ON c_custkey = f.o_custkey LEFT JOIN o ON c_custkey = o.o_custkey""")
def lookup_second(t):
    k = F.col("o_orderkey")
    both = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.coalesce(F.min(F.when(F.col("o_orderstatus") == "F", k)), F.min(F.when(F.col("o_orderstatus") == "O", k))).alias("k"))
    return t.customer.select("c_custkey").join(both, "c_custkey", "left").withColumn("k", F.coalesce("k", F.lit(-1)))  # both lookups read one table, so one pass does


TYPES = "(VALUES ('click'), ('error'), ('purchase'), ('signup'), ('view')) r(event_type)"


TYPE_LIST = ["click", "error", "purchase", "signup", "view"]


def required(t):
    return t.spark.createDataFrame([(x,) for x in TYPE_LIST], "event_type string")


@query(f"""SELECT user_id, count(*) AS n, string_agg('MISSING:' || event_type, ',' ORDER BY event_type) AS labels FROM
(SELECT DISTINCT user_id, r.event_type FROM events, {TYPES} EXCEPT SELECT user_id, event_type FROM events) GROUP BY user_id""")
def missing_assets(t):
    have = t.events.groupBy("user_id").agg(F.collect_set("event_type").alias("have"))
    want = F.array(*[F.lit(x) for x in ("click", "error", "purchase", "signup", "view")])
    lacking = F.array_except(want, F.col("have"))
    return have.select("user_id", F.size(lacking).cast("long").alias("n"), F.array_join(F.transform(F.array_sort(lacking), lambda x: F.concat(F.lit("MISSING:"), x)), ",").alias("labels")).filter("n > 0")


@query(f"""SELECT u.user_id, count(DISTINCT e.event_type) AS n_found, count(DISTINCT e.event_type) >= 5 AS complete FROM (SELECT DISTINCT user_id FROM events) u
LEFT JOIN (SELECT * FROM events WHERE event_type IN (SELECT event_type FROM {TYPES})) e USING (user_id) GROUP BY u.user_id""")
def fully_cached(t):
    return R.complete_by(t.events, "user_id", "event_type", TYPE_LIST)


@query(f"""SELECT c_custkey, count(DISTINCT e.event_type) AS n_found, count(DISTINCT e.event_type) >= 5 AS complete FROM customer
LEFT JOIN (SELECT * FROM events WHERE event_type IN (SELECT event_type FROM {TYPES})) e ON e.user_id = c_custkey GROUP BY c_custkey""")
def fully_present(t):
    """As fully_cached, with owners from a table of their own, where some have nothing."""
    found = t.events.select(F.col("user_id").alias("c_custkey"), "event_type")
    return R.fully_present(t.customer, required(t), found, "c_custkey", "event_type")


@query("""SELECT p_partkey, coalesce(CASE WHEN p_partkey % 3 > 0 THEN p_brand END, x.brand) AS brand FROM part LEFT JOIN
(SELECT l_partkey, max_by('supplier ' || l_suppkey, (l_shipdate, l_suppkey)) AS brand FROM lineitem GROUP BY 1) x ON l_partkey = p_partkey""")
def fill_second(t):
    """Nulls filled from the last row of the key in a second table."""
    left = t.part.select("p_partkey", F.when(F.col("p_partkey") % 3 > 0, F.col("p_brand")).alias("brand"))
    right = t.lineitem.select(F.col("l_partkey").alias("p_partkey"), "l_shipdate", "l_suppkey", F.concat(F.lit("supplier "), "l_suppkey").alias("brand"))
    return R.filled(left, right, ["p_partkey"], ["brand"], ["l_shipdate", "l_suppkey"])


@query("""SELECT user_id FROM events GROUP BY user_id HAVING count(DISTINCT event_type) < 5""")
def uncached(t):
    return fully_cached(t).filter("not complete").select("user_id")


@query("""SELECT p_partkey, p_size FROM part WHERE (p_brand, p_size) IN (('Brand#11', 10), ('Brand#12', 20), ('Brand#13', 30)) OR upper(p_type) = 'SMALL BRASS'""")
def requested_assets(t):
    want = t.spark.createDataFrame([("Brand#11", 10), ("Brand#12", 20), ("Brand#13", 30)], "p_brand string, p_size int")
    by_key = t.part.join(F.broadcast(want.withColumn("hit", F.lit(True))), ["p_brand", "p_size"], "left")  # what the user asked for
    return by_key.filter(F.coalesce("hit", F.lit(False)) | (F.upper("p_type") == "SMALL BRASS")).select("p_partkey", "p_size")


BAND_ROWS = ", ".join(f"('{b}', {r})" for b, rs in N.BAND_RESOLUTIONS.items() for r in rs)


@query(f"""WITH b(band, r) AS (VALUES {BAND_ROWS}), w(wanted) AS (VALUES (10), (20), (60))
SELECT band, wanted, CASE WHEN bool_or(r = wanted) THEN wanted ELSE coalesce(max(r) FILTER (WHERE r < wanted), min(r) FILTER (WHERE r > wanted)) END AS resolved, NOT bool_or(r = wanted) AS fallback FROM b, w GROUP BY band, wanted""")
def res_fallback(t):
    rows = t.spark.createDataFrame([(b, r) for b in N.BAND_RESOLUTIONS for r in (10, 20, 60)], "band string, wanted int")
    got = N.resolve(N.resolutions(F.col("band")), F.col("wanted"))
    return rows.select("band", "wanted", got.alias("resolved"), (got != F.col("wanted")).alias("fallback"))


@query("""WITH s AS (SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1)
SELECT o_orderkey, coalesce(event_id, -1) AS event_id, event_type FROM orders LEFT JOIN s ON o_custkey = user_id""")
def state_lookup(t):
    state = t.events.select(F.col("user_id").alias("o_custkey"), "ts", "event_id", "event_type")
    return R.lookup_last(t.orders.select("o_orderkey", "o_custkey"), state, ["o_custkey"], ["ts", "event_id"]).select("o_orderkey", F.coalesce("event_id", F.lit(-1)).alias("event_id"), "event_type")


@query("""WITH f AS (SELECT DISTINCT l_orderkey, sum(l_quantity) OVER (PARTITION BY l_orderkey)::BIGINT AS size FROM lineitem) SELECT o_orderkey, coalesce(size, -1) AS size, size IS NOT NULL AS present FROM orders LEFT JOIN f ON o_orderkey = l_orderkey""")
def stat_lookup(t):
    size = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(N.optional_long(F.sum("l_quantity")).alias("size"))
    return t.orders.select("o_orderkey").join(size, "o_orderkey", "left").select("o_orderkey", F.coalesce("size", F.lit(-1)).alias("size"), F.col("size").isNotNull().alias("present"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, coalesce(s_name, '') AS path FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey AND s_acctbal > 0""")
def path_lookup(t):
    s = t.supplier.filter("s_acctbal > 0").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").join(s, "l_suppkey", "left").select("l_orderkey", "l_linenumber", "l_partkey", F.coalesce("s_name", F.lit("")).alias("path"))


@query("""SELECT user_id, count(*) AS n FROM events e WHERE EXISTS (SELECT 1 FROM customer WHERE c_custkey = e.user_id AND c_acctbal > 0) GROUP BY user_id""")
def cached_groups(t):
    good = t.customer.filter("c_acctbal > 0").select(F.col("c_custkey").alias("user_id"))
    return t.events.join(good, "user_id", "left_semi").groupBy("user_id").agg(F.count("*").alias("n"))


@query("""SELECT year(o_orderdate) - 1995 AS window_id, count(*) AS n, count(*) >= 2000 AS full_window FROM orders GROUP BY 1""")
def window_pairs(t):
    n = t.orders.groupBy((F.year("o_orderdate") - 1995).alias("window_id")).agg(F.count("*").alias("n"))
    return n.withColumn("full_window", F.col("n") >= 2000)


@query("""SELECT p_brand, p_partkey FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY CASE p_size WHEN 20 THEN 0 WHEN 10 THEN 1 WHEN 40 THEN 2 ELSE 3 END, p_partkey) AS n FROM part) WHERE n = 1""")
def preferred_match(t):
    size = F.col("p_size")
    rank = F.when(size == 20, 0).when(size == 10, 1).when(size == 40, 2).otherwise(3)
    return R.preferred(t.part.select("p_brand").distinct(), t.part, ["p_brand"], "p_partkey", rank)


@query("""SELECT CAST(ts AS DATE)::VARCHAR AS day, event_type, max(value) AS value FROM (SELECT ts, event_type, value FROM events WHERE event_id % 3 <> 0 UNION ALL
SELECT ts, event_type, value FROM events WHERE event_id % 3 <> 1) WHERE event_type NOT IN ('error', 'signup') GROUP BY 1, 2""")
def cube_merge(t):
    cell = t.events.select(F.to_date("ts").cast("string").alias("day"), "event_type", "value", "event_id").filter(~F.col("event_type").isin("error", "signup"))
    one, two = cell.filter("event_id % 3 <> 0").drop("event_id"), cell.filter("event_id % 3 <> 1").drop("event_id")
    return one.unionByName(two).groupBy("day", "event_type").agg(F.max("value").alias("value"))


@query("""SELECT event_id, event_type, value FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-12' AND event_type IN ('click', 'view') AND value <= 60""")
def cube_filter(t):
    ts = lambda s: F.lit(s).cast("timestamp_ntz")
    return t.events.filter((F.col("ts") >= ts("2024-01-05")) & (F.col("ts") < ts("2024-01-12")) & F.col("event_type").isin("click", "view") & (F.col("value") <= 60)).select("event_id", "event_type", "value")
