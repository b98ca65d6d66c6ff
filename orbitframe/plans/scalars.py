"""Projections, strings, paths, sizes and dates over columns."""

from pyspark.sql import functions as F

from orbitframe.functions import numbers as N
from orbitframe.functions import text as T
from orbitframe.functions import vocab as V
from orbitframe.plans.registry import query

PART_NAME = "'S2A_MSIL2A_20' || lpad((p_partkey % 25)::VARCHAR, 2, '0') || '0' || (1 + p_partkey % 9)::VARCHAR || '15T101010_N0' || lpad((300 + p_size * 5)::VARCHAR, 3, '0') || '_R001.SAFE'"


def scene_name(t):
    """part with a made-up scene name for each row."""
    key = F.col("p_partkey")
    name = F.concat(
        F.lit("S2A_MSIL2A_20"), F.lpad((key % 25).cast("string"), 2, "0"), F.lit("0"), (1 + key % 9).cast("string"), F.lit("15T101010_N0"),
        F.lpad((300 + F.col("p_size") * 5).cast("string"), 3, "0"), F.lit("_R001.SAFE"),
    )
    return t.part.withColumn("name", name)


@query(f"""WITH n AS (SELECT p_partkey, p_size, {PART_NAME} AS name FROM part)
SELECT p_partkey, substr(name, 12, 4) || '-' || substr(name, 16, 2) || '-' || substr(name, 18, 2) AS plain,
CASE WHEN p_size % 2 = 0 THEN substr(name, 12, 4) || '-' || substr(name, 16, 2) || '-' || substr(name, 18, 2) END AS nested FROM n""")
def acq_date(t):
    rows = scene_name(t)
    nested = F.concat(F.lit("/data/"), F.when(F.col("p_size") % 2 == 0, F.col("name")).otherwise("none"), F.lit("/GRANULE/x/B02.jp2"))
    return rows.select("p_partkey", T.acquisition_date(F.col("name")).cast("string").alias("plain"), T.acquisition_date(nested).cast("string").alias("nested"))


@query(f"""SELECT p_partkey, '0' || (300 + p_size * 5)::VARCHAR AS baseline, CASE WHEN 300 + p_size * 5 >= 400 THEN 1000 ELSE 0 END AS dn_offset, 0 AS unknown FROM (SELECT *, {PART_NAME} AS name FROM part)""")
def pb_offset_code(t):
    return scene_name(t).select("p_partkey", T.baseline(F.col("name")).alias("baseline"), T.dn_offset(F.col("name")).alias("dn_offset"), T.dn_offset(F.lit("no_baseline.jp2")).alias("unknown"))


@query("""SELECT l_partkey, l_suppkey, l_linenumber, CASE l_linenumber % 5 WHEN 0 THEN 'a/' || l_partkey || '.jp2' WHEN 1 THEN 'a/' || l_partkey || '.jp2' WHEN 2 THEN 'GRANULE/' || l_partkey || '.jp2'
WHEN 3 THEN 'GRANULE/L2A_' || l_partkey || '/IMG_DATA/x.jp2' ELSE l_partkey || '.jp2' END AS path FROM lineitem""")
def path_normalise(t):
    scene = F.concat(F.lit("/eodata/S2/"), "l_suppkey", F.lit("/"))
    file = F.concat(F.col("l_partkey").cast("string"), F.lit(".jp2"))
    kind = F.col("l_linenumber") % 5
    listed = (
        F.when(kind == 0, F.concat(F.lit("s3://eodata/S2/"), "l_suppkey", F.lit("/a/"), file)).when(kind == 1, F.concat(F.lit("S2/"), "l_suppkey", F.lit("/a/"), file))
        .when(kind == 2, F.concat(F.lit("odd/GRANULE/"), file)).when(kind == 3, F.concat(F.lit("L2A_"), "l_partkey", F.lit("/IMG_DATA/x.jp2"))).otherwise(F.concat(F.lit("else/where/"), file))
    )
    return t.lineitem.select("l_partkey", "l_suppkey", "l_linenumber", T.asset_path(listed, scene).alias("path"))


@query("""WITH p AS (SELECT page_id, regexp_replace(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/+$', '') AS path FROM pages)
SELECT page_id, CASE WHEN path = '' THEN 'g' || page_id ELSE regexp_extract(path, '[^/]*$') END AS filename FROM p""")
def url_filename(t):
    return t.pages.select("page_id", T.url_filename(F.col("url"), F.concat(F.lit("x/g"), "page_id")).alias("filename"))


@query("""SELECT p_partkey, upper(p_name) AS up, lower(p_name) AS low, trim('  ' || p_brand || ' ') AS trimmed, 'S2/' || p_partkey AS root, p_type LIKE '%BRASS%' AS brass, 'T_SCL_20m.jp2' AS scl, '3,8,9' AS codes FROM part""")
def path_strings(t):
    root = T.scene_root(F.concat(F.lit("/eodata/S2/"), "p_partkey", F.lit("//")))
    return t.part.select(
        "p_partkey", F.upper("p_name").alias("up"), F.lower("p_name").alias("low"), F.trim(F.concat(F.lit("  "), "p_brand", F.lit(" "))).alias("trimmed"),
        F.regexp_replace(root, "^/", "").alias("root"), F.contains(F.upper("p_type"), F.lit("BRASS")).alias("brass"),
        T.classification_name(F.lit("T_B03_20m.jp2")).alias("scl"), T.class_codes(F.lit("9, 3;8 3")).alias("codes"),
    )


@query("""SELECT doc_id, nullif(lower(trim(CASE WHEN doc_id % 4 = 0 THEN '  ' ELSE ' ' || upper(md5(source)) || ' ' END)), '') AS checksum FROM documents""")
def md5_norm(t):
    given = F.when(F.col("doc_id") % 4 == 0, F.lit("  ")).otherwise(F.concat(F.lit(" "), F.upper(F.md5("source")), F.lit(" ")))
    return t.documents.select("doc_id", T.normal_md5(given).alias("checksum"))


@query("""SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN p_size::BIGINT ELSE round_even(p_retailprice * 1048576, 0)::BIGINT END AS expected,
round(CASE WHEN p_size % 3 = 0 THEN p_size / 1048576.0 ELSE p_retailprice END, 6) AS mb, CASE WHEN p_size % 4 = 0 THEN p_partkey ELSE p_size % 4 END::BIGINT AS orbit FROM part""")
def expected_size(t):
    size = F.when(F.col("p_size") % 3 == 0, F.col("p_size").cast("long"))
    return t.part.select(
        "p_partkey", N.expected_size(size, F.col("p_retailprice")).alias("expected"), F.round(N.size_mb(size, F.col("p_retailprice")), 6).alias("mb"),
        N.first_truthy((F.col("p_size") % 4).cast("long"), F.col("p_partkey")).alias("orbit"),
    )


@query("""SELECT p_partkey, CASE WHEN p_size % 3 <> 0 THEN p_brand || '@' || (p_size % 3 * 10) || 'm' ELSE p_brand END AS label, 'R' || p_size || 'm' AS folder FROM part""")
def asset_label(t):
    return t.part.select("p_partkey", T.asset_label(F.col("p_brand"), F.col("p_size") % 3 * 10).alias("label"), T.resolution_folder(F.col("p_size")).alias("folder"))


@query("""WITH s AS (SELECT o_orderkey, floor(o_totalprice * (o_orderkey % 5) * (o_orderkey % 5) * 1000)::BIGINT - 5 AS size FROM orders), v AS (SELECT *, greatest(size, 0)::DOUBLE AS v FROM s)
SELECT o_orderkey, size, CASE WHEN v < 1024 THEN printf('%d B', v::BIGINT) WHEN v < 1048576 THEN printf('%.1f KiB', v / 1024) WHEN v < 1073741824 THEN printf('%.1f MiB', v / 1048576)
ELSE printf('%.1f GiB', v / 1073741824) END AS text FROM v""")
def format_bytes(t):
    k = F.col("o_orderkey") % 5
    rows = t.orders.select("o_orderkey", (F.floor(F.col("o_totalprice") * k * k * 1000).cast("long") - 5).alias("size"))
    return rows.select("o_orderkey", "size", T.format_bytes(F.col("size")).alias("text"))


@query("""SELECT p_partkey AS key, p_name AS title, 'part' AS kind, NULL::VARCHAR AS size, p_size * 2 AS double_size, 'complete' AS status FROM part""")
def project_misc(t):
    rows = t.part.withColumnsRenamed({"p_partkey": "key", "p_name": "title"}).drop("p_brand", "p_type", "p_retailprice")
    return rows.withColumns({"kind": F.lit("part"), "size": F.lit(None).cast("string"), "double_size": F.col("p_size") * 2, "status": F.lit("complete")}).drop("p_size")


@query("""SELECT p_partkey, upper(p_brand) IN ('BRAND#11', 'BRAND#12') AS known, CASE p_size % 3 WHEN 0 THEN false ELSE true END AS mode_ok, 10 AS n_default FROM part""")
def vocab_check(t):
    mode = F.when(F.col("p_size") % 3 == 0, "XX").when(F.col("p_size") % 3 == 1, "iw").otherwise("")
    return t.part.select(
        "p_partkey", V.allowed(F.col("p_brand"), ["BRAND#11", "BRAND#12"]).alias("known"), V.allowed(mode, V.SENSOR_MODES[V.RADAR]).alias("mode_ok"),
        F.lit(len(V.DEFAULT_BANDS[V.OPTICAL])).alias("n_default"),
    )


@query("""SELECT n::INTEGER AS attempt, pow(2, n - 1) AS seconds, 0.5 * pow(2, n - 1) AS half FROM (SELECT unnest(range(1, 6)) AS n)""")
def backoff(t):
    rows = t.spark.range(1, 6).select(F.col("id").cast("int").alias("attempt"))
    return rows.select("attempt", N.backoff(F.col("attempt")).alias("seconds"), N.backoff(F.col("attempt"), 0.5).alias("half"))


@query("""SELECT DISTINCT printf('%02d-%02d', month(o_orderdate), day(o_orderdate)) AS month_day FROM orders""")
def month_day_text(t):
    d = F.col("o_orderdate")
    return t.orders.select(F.format_string("%02d-%02d", F.month(d), F.dayofmonth(d)).alias("month_day")).distinct()
