"""Grids, boxes, coverage and texts of geometries."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from orbitframe.functions import geometry as G
from orbitframe.functions import numbers as N
from orbitframe.operators import spatial as SP
from orbitframe.plans.registry import query

CELLS = "SELECT r::INTEGER AS \"row\", c::INTEGER AS col, -150 + c * 0.5 AS minx, 60 + r * 0.25 AS miny FROM (SELECT unnest(range(0, 42)) AS r), (SELECT unnest(range(0, 44)) AS c)"


def cells(t):
    return SP.grid(t.spark, (-150, 60, -128, 70.5), 0.5, 0.25)


@query(CELLS)
def grid_cells(t):
    return cells(t).select("row", "col", "minx", "miny")


@query(f"SELECT \"row\", col FROM ({CELLS}) WHERE minx <= -140 AND minx + 0.5 >= -141.3 AND miny <= 63 AND miny + 0.25 >= 62.1")
def grid_intersect(t):
    return SP.clipped(cells(t), ["POLYGON ((-140 62.1, -140 63, -141.3 63, -141.3 62.1, -140 62.1))"]).select("row", "col")


@query(f"SELECT \"row\", col FROM ({CELLS}) WHERE minx >= -141.3 AND minx + 0.5 <= -140 AND miny >= 62.1 AND miny + 0.25 <= 63")
def grid_within(t):
    return SP.clipped(cells(t), ["POLYGON ((-140 62.1, -140 63, -141.3 63, -141.3 62.1, -140 62.1))"], "within").select("row", "col")


@query("""SELECT i::INTEGER AS i, -10 + i * 0.7 AS x FROM (SELECT unnest(range(0, 15)) AS i)""")
def grid_index(t):
    one = t.spark.range(1).select(F.posexplode(N.half_open_range(F.lit(-10.0), F.lit(0.0), F.lit(0.7))).alias("i", "x"))
    return one


BOXES = "SELECT event_id, user_id, event_type, -150 + (value * 7919) % 22 AS x, 60 + (hour(ts) + value) % 10.5 AS y FROM events"


def boxes(t):
    v = F.col("value")
    rows = t.events.select("event_id", "user_id", "event_type", (F.lit(-150) + (v * 7919) % 22).alias("x"), (F.lit(60) + (F.hour("ts") + v) % 10.5).alias("y"))
    return rows.withColumns({"b_minx": F.col("x"), "b_miny": F.col("y"), "b_maxx": F.col("x") + 1.25, "b_maxy": F.col("y") + 0.6})


COVERED = f"""SELECT c."row", c.col, count(b.event_id) AS n FROM ({CELLS}) c LEFT JOIN ({BOXES}) b ON b.x <= c.minx + 0.5 AND b.x + 1.25 >= c.minx AND b.y <= c.miny + 0.25 AND b.y + 0.6 >= c.miny GROUP BY 1, 2"""


@query(COVERED)
def footprint_coverage(t):
    return SP.coverage(boxes(t), cells(t), (-150, 60), 0.5, 0.25, (42, 44)).select("row", "col", "n")


@query(f"SELECT count(*) FILTER (WHERE n = 0) AS uncovered, count(*) AS cells, 100.0 * count(*) FILTER (WHERE n = 0) / count(*) AS percent FROM ({COVERED})")
def coverage_pct(t):
    return SP.uncovered_share(SP.coverage(boxes(t), cells(t), (-150, 60), 0.5, 0.25, (42, 44)))


@query(f"SELECT min(x) AS minx, min(y) AS miny, max(x) AS maxx, max(y) AS maxy FROM ({BOXES})")
def spatial_bounds(t):
    return boxes(t).agg(F.min("x").alias("minx"), F.min("y").alias("miny"), F.max("x").alias("maxx"), F.max("y").alias("maxy"))


@query(f"SELECT event_type, min(x) AS minx, min(y) AS miny, max(x + 1.25) AS maxx, max(y + 0.6) AS maxy FROM ({BOXES}) GROUP BY event_type")
def dissolve_bounds(t):
    return boxes(t).groupBy("event_type").agg(F.min("b_minx").alias("minx"), F.min("b_miny").alias("miny"), F.max("b_maxx").alias("maxx"), F.max("b_maxy").alias("maxy"))


@query(f"SELECT event_id FROM ({BOXES}) WHERE x <= -140 AND x + 1.25 >= -142 AND y <= 66 AND y + 0.6 >= 64")
def catalog_search_bbox(t):
    own = {c: F.col("b_" + c) for c in ("minx", "miny", "maxx", "maxy")}
    want = {"minx": F.lit(-142.0), "miny": F.lit(64.0), "maxx": F.lit(-140.0), "maxy": F.lit(66.0)}
    return boxes(t).filter(G.boxes_meet(own, want)).select("event_id")


@query("""SELECT * FROM (VALUES ('1,2,3,4', 1.0, 2.0, 3.0, 4.0), ('-150 68, -149.5 68.5', -150.0, 68.0, -149.5, 68.5), ('3,2,1,4', NULL, NULL, NULL, NULL), ('1,2,x,4', NULL, NULL, NULL, NULL), ('1 2 3', NULL, NULL, NULL, NULL)) v(text, minx, miny, maxx, maxy)""")
def bbox_parse(t):
    rows = t.spark.createDataFrame([("1,2,3,4",), ("-150 68, -149.5 68.5",), ("3,2,1,4",), ("1,2,x,4",), ("1 2 3",)], "text string")
    b = G.parse_bbox(F.col("text"))
    return rows.select("text", *[b[c].alias(c) for c in ("minx", "miny", "maxx", "maxy")])


@query("""SELECT event_id, 'POINT (' || event_id || ' ' || event_id % 90 || '.5)' AS wkt, length('POINT (' || event_id || ' ' || event_id % 90 || '.5)') AS size FROM events""")
def points_wkt(t):
    w = G.point_wkt(F.col("event_id").cast("double"), F.col("event_id") % 90 + 0.5)
    return t.events.select("event_id", w.alias("wkt"), F.length(w).alias("size"))


SHAPE = "MULTIPOLYGON (((0 0, 10 0, 10 10, 5 4, 0 10, 0 0), (1 1, 2 1, 2 2, 1 2, 1 1)), ((20 20, 24 20, 24 24, 20 20)))"


def shapes(t):
    """Two-part shapes with a hole, one at the place of each nation."""
    k = F.col("n_nationkey").cast("double")
    ring = lambda *pts: F.array(*[F.struct((k + x).alias("x"), F.lit(float(y)).alias("y")) for x, y in pts])
    outer, hole, other = ring((0, 0), (10, 0), (10, 10), (5, 4), (0, 10), (0, 0)), ring((1, 1), (2, 1), (2, 2), (1, 2), (1, 1)), ring((20, 20), (24, 20), (24, 24), (20, 20))
    return t.nation.select("n_nationkey", F.array(F.array(outer, hole), F.array(other)).alias("polygons"))


@query("""SELECT n_nationkey, n_nationkey::DOUBLE AS minx, 0.0::DOUBLE AS miny, n_nationkey + 24.0::DOUBLE AS maxx, 24.0::DOUBLE AS maxy,
'MULTIPOLYGON (((' || n_nationkey || ' 0, ' || n_nationkey + 10 || ' 0, ' || n_nationkey + 10 || ' 10, ' || n_nationkey + 5 || ' 4, ' || n_nationkey || ' 10, ' || n_nationkey || ' 0)), ((' || n_nationkey + 20 || ' 20, ' || n_nationkey + 24 || ' 20, ' || n_nationkey + 24 || ' 24, ' || n_nationkey + 20 || ' 20)))' AS wkt FROM nation""")
def remove_holes(t):
    rows = shapes(t).select("n_nationkey", G.to_wkt(G.without_holes(F.col("polygons"))).alias("wkt"))
    again = rows.select("n_nationkey", "wkt", G.bounds(G.from_wkt(F.col("wkt"))).alias("b"))
    return again.select("n_nationkey", "b.*", "wkt")


TRIANGLES = f"""SELECT c."row", c.col, count(b.event_id) AS n FROM ({CELLS}) c LEFT JOIN ({BOXES}) b ON b.x <= c.minx + 0.5 AND b.x + 1.2503 >= c.minx AND b.y <= c.miny + 0.25 AND b.y + 0.6007 >= c.miny
AND (greatest(c.minx, b.x) - b.x) / 1.2503 + (greatest(c.miny, b.y) - b.y) / 0.6007 <= 1 GROUP BY 1, 2"""


@query(TRIANGLES)
def footprint_polygons(t):
    """As footprint_coverage, for the lower left halves of boxes."""
    corner = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    ring = F.array(corner("b_minx", "b_miny"), corner("b_maxx", "b_miny"), corner("b_minx", "b_maxy"), corner("b_minx", "b_miny"))
    halves = boxes(t).withColumns({"b_maxx": F.col("x") + 1.2503, "b_maxy": F.col("y") + 0.6007}).withColumn("polygons", F.array(F.array(ring)))
    return SP.coverage(halves, cells(t), (-150, 60), 0.5, 0.25, (42, 44), "polygons").select("row", "col", "n")


@query(f"SELECT \"row\", col FROM ({CELLS}) WHERE greatest(minx, -143) + greatest(miny, 63) <= -77 AND minx + 0.5 >= -143 AND miny + 0.25 >= 63")
def grid_area(t):
    """The cells that meet a triangle of two parts that share an edge."""
    parts = ["POLYGON ((-143 63, -141.5 63, -141.5 64.5, -143 66, -143 63))", "POLYGON ((-141.5 63, -140 63, -141.5 64.5, -141.5 63))"]
    return SP.clipped(cells(t), parts).select("row", "col")


@query("""SELECT n_regionkey, 'POLYGON ((0 0, ' || count(*) || ' 0, ' || count(*) || ' 1, 0 1, 0 0))' AS wkt FROM nation GROUP BY n_regionkey""")
def dissolve_union(t):
    """Unit squares side by side, one for each nation of a region, joined to one shape."""
    place = F.row_number().over(Window.partitionBy("n_regionkey").orderBy("n_nationkey")).cast("double")
    rows = t.nation.select("n_regionkey", G.box_wkt(place - 1, F.lit(0.0), place, F.lit(1.0)).alias("wkt"))
    return G.dissolve(rows, ["n_regionkey"], "wkt")


@query("""SELECT n_nationkey, 'MULTIPOLYGON (((' || n_nationkey || ' 0, ' || n_nationkey + 1 || ' 1, ' || n_nationkey || ' 2, ' || n_nationkey || ' 0)), ((' || n_nationkey + 1 || ' 1, ' || n_nationkey + 2 || ' 0, ' || n_nationkey + 2 || ' 2, ' || n_nationkey + 1 || ' 1)))' AS wkt FROM nation""")
def repair_shape(t):
    """A ring that crosses itself, one for each nation, becomes the two triangles it shows."""
    k = F.col("n_nationkey").cast("string")
    x = lambda n: (F.col("n_nationkey") + n).cast("string")
    bow = F.concat(F.lit("POLYGON (("), k, F.lit(" 0, "), x(2), F.lit(" 2, "), x(2), F.lit(" 0, "), k, F.lit(" 2, "), k, F.lit(" 0))"))
    return t.nation.select("n_nationkey", G.repaired(bow).alias("wkt"))


@query("""SELECT n_nationkey, 'POLYGON ((' || n_nationkey || ' 0, ' || n_nationkey + 10 || ' 0, ' || n_nationkey + 24 || ' 20, ' || n_nationkey + 24 || ' 24, ' || n_nationkey || ' 10, ' || n_nationkey || ' 0))' AS wkt FROM nation""")
def convex_hull(t):
    return shapes(t).select("n_nationkey", G.convex_hull(G.to_wkt(F.col("polygons"))).alias("wkt"))


@query("""SELECT n_nationkey, 'POLYGON ((' || n_nationkey + 24 || ' 0, ' || n_nationkey + 24 || ' 24, ' || n_nationkey || ' 24, ' || n_nationkey || ' 0, ' || n_nationkey + 24 || ' 0))' AS wkt FROM nation""")
def simplify_first_fit(t):
    """No tolerance makes these shapes fit 40 characters, nor do their hulls: what is left is the box."""
    return shapes(t).select("n_nationkey", G.simplified(G.to_wkt(F.col("polygons")), 40).alias("wkt"))


BATCHES = f"""WITH RECURSIVE n AS (SELECT *, row_number() OVER (ORDER BY "row", col) AS k, minx + 0.1 AS a, miny + 0.05 AS b, minx + 0.4 AS c, miny + 0.2 AS d FROM ({CELLS})),
s AS (SELECT k, a, b, regexp_replace(printf('%.10f', a), '[.]?0+$', '') AS ta, regexp_replace(printf('%.10f', b), '[.]?0+$', '') AS tb, regexp_replace(printf('%.10f', c), '[.]?0+$', '') AS tc, regexp_replace(printf('%.10f', d), '[.]?0+$', '') AS td FROM n),
p AS (SELECT k, a, b, '((' || ta || ' ' || tb || ', ' || tc || ' ' || tb || ', ' || tc || ' ' || td || ', ' || ta || ' ' || td || ', ' || ta || ' ' || tb || '))' AS part FROM s),
r AS (SELECT k, 0 AS batch, 1 AS held, length(part) AS total FROM p WHERE k = 1 UNION ALL
SELECT p.k, CASE WHEN 15 + r.total + length(p.part) + 2 * r.held > 400 THEN r.batch + 1 ELSE r.batch END, CASE WHEN 15 + r.total + length(p.part) + 2 * r.held > 400 THEN 1 ELSE r.held + 1 END,
CASE WHEN 15 + r.total + length(p.part) + 2 * r.held > 400 THEN length(p.part) ELSE r.total + length(p.part) END FROM r JOIN p ON p.k = r.k + 1)
SELECT batch::INTEGER AS batch, count(*)::INTEGER AS n, 'MULTIPOLYGON (' || string_agg(part, ', ' ORDER BY a, b) || ')' AS wkt FROM r JOIN p USING (k) GROUP BY batch"""


@query(BATCHES)
def batch_geometries(t):
    """A box in every cell, in order, in batches of at most 400 characters; the list is a user's, made on the driver."""
    show = lambda v: f"{v:.10f}"
    wkts = []
    for k in range(42 * 44):
        a, b = -150 + (k % 44) * 0.5, 60 + (k // 44) * 0.25
        x, y, z, w = show(a + 0.1), show(b + 0.05), show(a + 0.4), show(b + 0.2)
        wkts.append(f"POLYGON (({x} {y}, {z} {y}, {z} {w}, {x} {w}, {x} {y}))")
    made = [(i, len(b), SP.joint(b)) for i, b in enumerate(SP.batches_by_length(wkts, 400))]
    return t.spark.createDataFrame(made, "batch int, n int, wkt string")
