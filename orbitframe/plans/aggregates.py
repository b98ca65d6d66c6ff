"""Counts, groups, set operations and resulting texts."""

from pyspark.sql import functions as F

from orbitframe.operators import relational as R
from orbitframe.plans.registry import query
from orbitframe.sources import catalogue as C
from orbitframe.functions import text as T


@query("SELECT upper(event_type) AS event_type, count(*) AS n FROM events WHERE event_type IS NOT NULL GROUP BY 1")
def value_counts(t):
    return R.value_counts(t.events, "event_type")


@query("""SELECT user_id, event_type FROM (SELECT user_id, upper(event_type) AS event_type, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, upper(event_type)) AS n
FROM events GROUP BY user_id, upper(event_type)) WHERE n = 1""")
def predominant(t):
    return R.predominant(t.events, ["user_id"], "event_type")


@query("SELECT year(o_orderdate) AS year, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) >= 1000")
def truncated_windows(t):
    return C.truncated(t.orders.select(F.year("o_orderdate").alias("year")), "year", 1000)


@query("""SELECT count(DISTINCT o_custkey) AS customers, count(DISTINCT o_orderpriority) AS priorities, count(*) FILTER (WHERE o_orderstatus = 'F') AS finished, count(*) AS n FROM orders""")
def distinct_counts(t):
    return t.orders.agg(F.countDistinct("o_custkey").alias("customers"), F.countDistinct("o_orderpriority").alias("priorities"), F.count_if(F.col("o_orderstatus") == "F").alias("finished"), F.count("*").alias("n"))


@query("""SELECT l_orderkey, count(*) AS n_lines, count(*) FILTER (WHERE l_returnflag = 'R') AS n_returned, max(l_quantity) AS most FROM lineitem WHERE l_orderkey IS NOT NULL GROUP BY l_orderkey""")
def group_records(t):
    groups = t.lineitem.dropna(subset=["l_orderkey"]).groupBy("l_orderkey")
    return groups.agg(F.count("*").alias("n_lines"), F.count_if(F.col("l_returnflag") == "R").alias("n_returned"), F.max("l_quantity").alias("most"))


@query("""SELECT l_orderkey, string_agg(l_linenumber || ':' || l_returnflag || ':' || l_quantity::BIGINT, ',' ORDER BY l_linenumber, l_returnflag, l_quantity) AS records FROM lineitem WHERE l_orderkey IS NOT NULL GROUP BY l_orderkey""")
def record_lists(t):
    """Each order's own lines as a list."""
    one = F.struct("l_linenumber", "l_returnflag", F.col("l_quantity").alias("q"))
    lists = t.lineitem.dropna(subset=["l_orderkey"]).groupBy("l_orderkey").agg(F.sort_array(F.collect_list(one)).alias("r"))
    text = F.transform("r", lambda x: F.concat_ws(":", x["l_linenumber"].cast("string"), x["l_returnflag"], x["q"].cast("long").cast("string")))
    return lists.select("l_orderkey", F.array_join(text, ",").alias("records"))


@query("""SELECT event_type, count(*) AS n, count(*) FILTER (WHERE value > 50) AS high, bool_or(value > 99) AS any_top FROM events GROUP BY event_type""")
def count_by_action(t):
    return t.events.groupBy("event_type").agg(F.count("*").alias("n"), F.count_if(F.col("value") > 50).alias("high"), F.bool_or(F.col("value") > 99).alias("any_top"))


@query("""SELECT l_orderkey, a, n, r, a + n + r AS total, r = 0 AS ok FROM (SELECT l_orderkey, count(*) FILTER (WHERE l_returnflag = 'A') AS a, count(*) FILTER (WHERE l_returnflag = 'N') AS n,
count(*) FILTER (WHERE l_returnflag = 'R') AS r FROM lineitem GROUP BY l_orderkey)""")
def scene_totals(t):
    flag = lambda f: F.count_if(F.col("l_returnflag") == f)
    return t.lineitem.groupBy("l_orderkey").agg(flag("A").alias("a"), flag("N").alias("n"), flag("R").alias("r")).withColumns({"total": F.col("a") + F.col("n") + F.col("r"), "ok": F.col("r") == 0})


@query("SELECT DISTINCT p_brand, p_size FROM part ORDER BY 1, 2")
def distinct_sorted(t):
    return t.part.select("p_brand", "p_size").distinct().orderBy("p_brand", "p_size")


@query("""SELECT string_agg(event_type || '=' || n, ', ' ORDER BY event_type) AS counts FROM (SELECT event_type, count(*) AS n FROM events GROUP BY event_type)""")
def counts_text(t):
    n = t.events.groupBy("event_type").agg(F.count("*").alias("n"))
    one = F.struct("event_type", F.concat("event_type", F.lit("="), F.col("n").cast("string")).alias("s"))
    return n.agg(F.array_join(F.transform(F.sort_array(F.collect_list(one)), lambda x: x["s"]), ", ").alias("counts"))


@query("SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier")
def union_by_name(t):
    a = t.customer.select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    return R.union_by_name(a, t.supplier.select(F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")))


@query("""SELECT count(*) AS both_keys FROM (SELECT c_custkey FROM customer INTERSECT SELECT o_custkey FROM orders)""")
def key_overlap(t):
    return t.customer.select("c_custkey").intersect(t.orders.select("o_custkey")).agg(F.count("*").alias("both_keys"))


@query("""SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders""")
def key_difference(t):
    return t.customer.select("c_custkey").subtract(t.orders.select("o_custkey"))


@query("""WITH n AS (SELECT event_type, count(*) AS k FROM events GROUP BY 1) SELECT (SELECT sum(k) FROM n WHERE event_type = 'purchase')::BIGINT || '/' || sum(k)::BIGINT || ' scenes · ' ||
(SELECT sum(k) FROM n WHERE event_type = 'view')::BIGINT || ' downloaded · ' || (SELECT sum(k) FROM n WHERE event_type = 'error')::BIGINT || ' failed' AS status FROM n""")
def progress_text(t):
    k = lambda e: F.count_if(F.col("event_type") == e).cast("string")
    one = t.events.agg(k("purchase").alias("done"), F.count("*").cast("string").alias("total"), k("view").alias("got"), k("error").alias("failed"))
    return one.select(F.concat_ws(" · ", F.concat("done", F.lit("/"), "total", F.lit(" scenes")), F.concat("got", F.lit(" downloaded")), F.concat("failed", F.lit(" failed"))).alias("status"))


@query("""SELECT doc_id, len(list_distinct(list_filter(string_split_regex(trim(replace(source || ',' || lang || ' ' || lang, ',', ' ')), '\\s+'), lambda x: x <> '')))::BIGINT AS n,
len(list_filter(string_split_regex(trim(replace(source || ',' || lang || ' ' || lang, ',', ' ')), '\\s+'), lambda x: x <> ''))::BIGINT AS n_all FROM documents""")
def parse_list(t):
    parts = T.split_list(F.concat("source", F.lit(","), "lang", F.lit(" "), "lang"))
    return t.documents.select("doc_id", F.size(F.array_distinct(parts)).cast("long").alias("n"), F.size(parts).cast("long").alias("n_all"))
