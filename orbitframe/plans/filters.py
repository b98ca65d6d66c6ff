"""Seasons, windows, searches and first or last rows."""

from pyspark.sql import functions as F

from orbitframe.functions import dates as D
from orbitframe.functions import text as T
from orbitframe.operators import relational as R
from orbitframe.plans.registry import query
from orbitframe.sources import catalogue as C
from orbitframe.sources import files

LINE = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
ORDER_BY_ALL = ", ".join(LINE)


def day(c):
    return F.date_format(c, "yyyy-MM-dd")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, strftime(l_shipdate, '%Y-%m-%d') AS ship FROM lineitem
WHERE month(l_shipdate) * 100 + day(l_shipdate) BETWEEN 601 AND 831 AND year(l_shipdate) IN (1996, 1997)""")
def season_filter(t):
    d = F.col("l_shipdate")
    rows = t.lineitem.filter(D.in_windows(d, [1996, 1997], (6, 1), (8, 31)) & D.in_season(d, (6, 1), (8, 31)) & D.in_years(d, [1996, 1997]))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", day(d).alias("ship"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, strftime(l_shipdate, '%Y-%m-%d') AS ship FROM lineitem
WHERE month(l_shipdate) * 100 + day(l_shipdate) >= 1101 OR month(l_shipdate) * 100 + day(l_shipdate) <= 228""")
def season_wrap(t):
    return t.lineitem.filter(D.in_season(F.col("l_shipdate"), (11, 1), (2, 28))).select("l_orderkey", "l_linenumber", "l_partkey", day("l_shipdate").alias("ship"))


@query(f"""SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM (SELECT *, row_number() OVER
(PARTITION BY l_orderkey, l_linenumber ORDER BY {ORDER_BY_ALL}) AS n FROM lineitem
WHERE month(l_shipdate) * 100 + day(l_shipdate) BETWEEN 601 AND 831 AND year(l_shipdate) BETWEEN 1995 AND 1999) WHERE n = 1""")
def season_dedup(t):
    years, d = list(range(1995, 2000)), F.col("l_shipdate")
    rows = t.lineitem.filter(D.in_windows(d, years, (6, 1), (8, 31)))
    rows = R.first_per_key(rows, ["l_orderkey", "l_linenumber"], LINE)
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity").orderBy("l_orderkey", "l_linenumber")


@query("""SELECT y - 1995 AS window_id, count(*) AS n, sum(CAST(o_custkey AS BIGINT))::BIGINT AS keys FROM orders,
(VALUES (1995), (1996), (1997), (1998)) v(y) WHERE o_orderdate BETWEEN make_timestamp(y, 2, 1, 0, 0, 0)
AND make_timestamp(y, 2, CASE WHEN y % 4 = 0 THEN 29 ELSE 28 END, 23, 59, 59.999) GROUP BY y""")
def yearly_windows(t):
    years, d = [1995, 1996, 1997, 1998], F.col("o_orderdate")
    rows = t.orders.filter(D.in_windows(d, years, (2, 1), (2, 29))).withColumn("window_id", D.window_id(d, years, (2, 1), (2, 29)))
    return rows.groupBy("window_id").agg(F.count("*").alias("n"), F.sum("o_custkey").alias("keys"))


@query("""SELECT DISTINCT year(o_orderdate) AS year, strftime(least(make_date(year(o_orderdate), 2, 1) + 28, last_day(make_date(year(o_orderdate), 2, 1))), '%Y-%m-%d') AS clamped,
strftime(make_date(year(o_orderdate), 4, 30), '%Y-%m-%d') AS april FROM orders""")
def leap_clamp(t):
    y = t.orders.select(F.year("o_orderdate").alias("year")).distinct()
    return y.select("year", D.clamped_date(F.col("year"), F.lit(2), F.lit(29)).cast("string").alias("clamped"), D.clamped_date(F.col("year"), F.lit(4), F.lit(31)).cast("string").alias("april"))


@query("""SELECT y AS year, y || '-06-01T00:00:00Z' AS start, y || '-08-31T23:59:59Z' AS "end" FROM (SELECT unnest(range(2019, 2025)) AS y)""")
def season_ranges(t):
    one = t.spark.range(1).select(F.explode(D.season_ranges(F.lit(2019), F.lit(2024), (6, 1), (8, 31))).alias("r"))
    return one.select("r.*")


@query("""SELECT DISTINCT year(o_orderdate) AS year, month(o_orderdate) AS month, day(o_orderdate) AS day FROM orders""")
def date_parts(t):
    d = F.col("o_orderdate")
    return t.orders.select(F.year(d).alias("year"), F.month(d).alias("month"), F.dayofmonth(d).alias("day")).distinct()


@query(f"""SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice FROM (SELECT *, row_number() OVER
(PARTITION BY l_orderkey, l_linenumber ORDER BY {ORDER_BY_ALL}) AS n FROM lineitem) WHERE n = 1""")
def dedup_first(t):
    return R.first_per_key(t.lineitem, ["l_orderkey", "l_linenumber"], LINE).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")


@query(f"""SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice FROM (SELECT *, row_number() OVER
(PARTITION BY l_orderkey, l_linenumber ORDER BY {", ".join(c + " DESC" for c in LINE)}) AS n FROM lineitem) WHERE n = 1""")
def dedup_last(t):
    return R.last_per_key(t.lineitem, ["l_orderkey", "l_linenumber"], LINE).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")


@query("""WITH old AS (SELECT user_id, event_type, event_id, value, NULL AS note FROM events),
new AS (SELECT user_id, event_type, event_id, value * 2 AS value, 'new' AS note FROM events WHERE ts >= TIMESTAMP '2024-01-16'),
b AS (SELECT *, 0 AS f FROM old UNION ALL SELECT *, 1 FROM new)
SELECT user_id, event_type, event_id, round(value, 4) AS value, note FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY f DESC, event_id DESC) AS n FROM b) WHERE n = 1""")
def state_upsert(t):
    old = t.events.select("user_id", "event_type", "event_id", "value")
    new = t.events.filter(F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz")).select("user_id", "event_type", "event_id", (F.col("value") * 2).alias("value"), F.lit("new").alias("note"))
    return R.upsert(old, new, ["user_id", "event_type"], ["event_id"]).select("user_id", "event_type", "event_id", F.round("value", 4).alias("value"), "note")


@query("""WITH u AS (SELECT o_orderkey, o_custkey, 1 AS w FROM orders WHERE year(o_orderdate) = 1996
UNION ALL SELECT o_orderkey, o_custkey, 2 FROM orders WHERE year(o_orderdate) IN (1996, 1997))
SELECT o_orderkey, o_custkey, w FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY w, o_custkey) AS n FROM u) WHERE n = 1""")
def union_windows(t):
    y = F.year("o_orderdate")
    one = t.orders.filter(y == 1996).select("o_orderkey", "o_custkey", F.lit(1).alias("w"))
    two = t.orders.filter(y.isin(1996, 1997)).select("o_orderkey", "o_custkey", F.lit(2).alias("w"))
    return R.first_per_key(R.union_by_name(one, two), ["o_orderkey"], ["w", "o_custkey"]).orderBy(F.asc_nulls_last("o_orderkey"))


@query("""SELECT year, o_orderkey FROM (SELECT year(o_orderdate) AS year, o_orderkey, row_number() OVER (PARTITION BY year(o_orderdate) ORDER BY o_orderkey) AS n FROM orders) WHERE n <= 25""")
def window_limit(t):
    rows = t.orders.select(F.year("o_orderdate").alias("year"), "o_orderkey")
    return R.ranked(rows, ["year"], [F.asc("o_orderkey")], 25)


@query("""SELECT event_id, user_id, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 10""")
def topk_recent(t):
    return t.events.orderBy(F.desc("ts"), F.desc("event_id")).limit(10).select("event_id", "user_id", "event_type")


@query("""SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50 OFFSET 100""")
def page_slice(t):
    return t.orders.orderBy(F.desc("o_totalprice"), "o_orderkey").offset(100).limit(50).select("o_orderkey", "o_totalprice")


@query("""SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS n FROM events) WHERE n = 1""")
def first_match(t):
    return R.first_per_key(t.events.select("user_id", "event_type", "event_id", "ts"), ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


@query("""SELECT o_orderkey, o_custkey, o_orderstatus, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey
WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1996-12-31 23:59:59.999' AND upper(c_mktsegment) IN ('BUILDING', 'MACHINERY')
AND c_acctbal < 5000 AND o_orderstatus = 'F' AND c_nationkey <> 0""")
def catalog_search(t):
    both = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    want = C.Search(equal={"o_orderstatus": "F", "o_orderpriority": None}, one_of={"c_mktsegment": ["building", "Machinery"]}, below={"c_acctbal": 5000})
    found = C.search(both, [("1996-01-01T00:00:00", "1996-12-31T23:59:59.999")], want, "o_orderdate", "o_orderkey")
    return found.filter(~F.col("c_nationkey").eqNullSafe(0)).select("o_orderkey", "o_custkey", "o_orderstatus", "c_mktsegment")


@query("""SELECT p_partkey FROM part WHERE p_size = 10 AND p_brand = 'Brand#11' UNION ALL SELECT p_partkey FROM part WHERE p_size = 20 AND p_type LIKE '%STEEL%'""")
def burst_routing(t):
    plain = t.part.filter(R.equals_all({"p_size": 10, "p_brand": "Brand#11", "p_type": None}))
    return plain.select("p_partkey").unionByName(t.part.filter((F.col("p_size") == 20) & F.contains("p_type", F.lit("STEEL"))).select("p_partkey"))


@query("""SELECT o_orderkey, o_custkey, o_orderdate::VARCHAR AS day FROM orders WHERE o_orderkey = 4""")
def name_lookup(t):
    return R.find_one(t.orders.withColumn("day", F.col("o_orderdate").cast("string")), "o_orderkey", 4, ["o_orderkey", "o_custkey", "day"])


@query("""SELECT event_id, k FROM (SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) WHERE k IS NOT NULL""")
def geojson_flatten(t):
    return t.events.select("event_id", F.from_json("props", "k long")["k"].alias("k")).filter("k is not null")


@query("""SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN true WHEN doc_id % 5 = 1 THEN true ELSE trim(lang) = '' END AS missing FROM documents""")
def missing_pred(t):
    from orbitframe.functions.geometry import is_missing

    injected = F.when(F.col("doc_id") % 5 == 0, F.lit(None)).when(F.col("doc_id") % 5 == 1, F.lit("   ")).otherwise(F.col("lang"))
    return t.documents.select("doc_id", is_missing(injected).alias("missing"))


@query("""SELECT l_partkey, l_suppkey, l_quantity::BIGINT AS size FROM lineitem WHERE l_quantity > 25""")
def listing_parse(t):
    line = F.concat_ws("  ", F.lit("2024/01/01 00:00:00"), F.when(F.col("l_quantity") > 25, F.col("l_quantity").cast("long").cast("string")).otherwise("DIR"), F.concat(F.lit("s3://x/"), "l_partkey", F.lit("_"), "l_suppkey"))
    rows = t.lineitem.select(files.listing(line).alias("l")).filter("l is not null")
    name = F.split(T.base_name(F.col("l.path")), "_")
    return rows.select(F.get(name, F.lit(0)).cast("long").alias("l_partkey"), F.get(name, F.lit(1)).cast("long").alias("l_suppkey"), F.col("l.size").alias("size"))
