import random

import pytest
from pyspark.sql import functions as F

from orbitframe.functions import geometry as G
from orbitframe.operators import relational as R
from orbitframe.operators import spatial as SP
from orbitframe.operators import state as S


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_holds_for_an_empty_state(spark):
    new = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "url string, seq int, status string")
    assert rows(R.upsert(new.limit(0), new, ["url"], ["seq"])) == [("a", 2, "y"), ("b", 1, "z")]
    old = spark.createDataFrame([("a", 9, 5), ("c", 1, 6)], "url string, seq int, size int")
    assert rows(R.upsert(old, new, ["url"], ["seq"]).select("url", "seq", "status", F.coalesce("size", F.lit(0)))) == [("a", 2, "y", 0), ("b", 1, "z", 0), ("c", 1, None, 6)]


def test_predominant_ties_and_nulls(spark):
    df = spark.createDataFrame([(1, "descending"), (1, "Ascending"), (2, None), (3, "b"), (3, "B"), (3, "a")], "k int, v string")
    assert rows(R.predominant(df, ["k"], "v").select("k", F.coalesce("v", F.lit("-")))) == [(1, "ASCENDING"), (2, "-"), (3, "B")]


def test_completeness(spark):
    found = spark.createDataFrame([("s1", "a"), ("s1", "b"), ("s1", "b"), ("s2", "a"), ("s2", "x")], "s string, i string")
    required = spark.createDataFrame([("a",), ("b",)], "i string")
    owners = spark.createDataFrame([("s1",), ("s2",), ("s3",)], "s string")
    assert rows(R.fully_present(owners, required, found, "s", "i")) == [("s1", 2, True), ("s2", 1, False), ("s3", 0, False)]
    assert rows(R.missing(owners, found, ["s"])) == [("s3",)]


@pytest.mark.parametrize("local, expected, action", [(None, 5, "download"), (5, 5, "skip"), (4, 5, "redownload"), (4, None, "skip"), (4, 0, "skip"), (0, None, "download")])
def test_asset_actions(spark, local, expected, action):
    lit = lambda v: F.lit(v).cast("long")
    assert spark.range(1).select(S.asset_action(lit(local), lit(expected))).first()[0] == action


@pytest.mark.parametrize("version, old, now, same", [(1, 100, 100, True), (1, 100, 101, False), (None, 100, 356, True), (0, 100, 357, False), (None, None, 1, False), (1, None, 1, False)])
def test_fingerprints(spark, version, old, now, same):
    lit = lambda v: F.lit(v).cast("long")
    assert spark.range(1).select(S.fingerprint_matches(lit(version), lit(old), lit(now))).first()[0] is same


def test_storage_estimates(spark):
    assets = spark.createDataFrame([("a", 100, 100), ("a", 50, None), ("a", 25, 24), ("a", None, 9)], "s string, e long, l long")
    assert rows(S.storage_by_scene(assets, "s", "e", "l")) == [("a", 175, 75)]
    scenes = spark.createDataFrame([(1, 100, 80), (2, 300, 120)], "n int, footprint long, additional long").withColumn("g", F.lit(0))
    run = S.running_projection(scenes, "g", ["n"], F.lit(4)).select("resolved", "projected_footprint", "projected_additional")
    assert rows(run) == [(1, 400, 320), (2, 800, 400)]
    assert rows(S.storage_projection(scenes, F.lit(4))) == [(2, 800, 400)]


def test_grids(spark):
    g = SP.grid(spark, (0, 0, 1, 0.5), 0.4)
    assert g.count() == 6 and rows(g.agg(F.max("row"), F.max("col"))) == [(1, 2)]
    area = "POLYGON ((0 0, 1 0, 0 1, 0 0))"
    got = {(r.row, r.col) for r in SP.clipped(SP.grid(spark, (0, 0, 2, 2), 0.5), [area]).collect()}
    assert got == {(0, 0), (0, 1), (1, 0), (1, 1), (0, 2), (2, 0)}
    assert {(r.row, r.col) for r in SP.clipped(SP.grid(spark, (0, 0, 2, 2), 0.5), [area], "within").collect()} == {(0, 0)}
    for bad in (lambda: SP.grid(spark, (0, 0, 1, 1), 0), lambda: SP.grid(spark, (0, 0, 0, 1), 1), lambda: SP.clipped(g, [area], "x")):
        with pytest.raises(ValueError):
            bad()


def test_polygons_meet_the_cells_that_they_share_a_point_with(spark):
    rng, size = random.Random(7), (8, 10)
    shapes = ["POLYGON ((1 1, 7 1, 7 7, 1 7, 1 1), (1.9 1.9, 6.1 1.9, 6.1 6.1, 1.9 6.1, 1.9 1.9))", "POLYGON ((-5 -5, 30 -5, 30 30, -5 -5))", "POLYGON ((2.2 2.2, 2.3 2.2, 2.2 2.3, 2.2 2.2))"]
    shapes += ["MULTIPOLYGON (((0 0, 1 0, 0 1, 0 0)), ((4 4, 6 4, 4 6, 4 4)))", "POLYGON ((0 0, 9 0, 9 7, 8 7, 8 1, 0 1, 0 0))"]
    for _ in range(120):  # corners lie on the cells' edges and corners too
        shapes.append(G.ring_text([[G.hull([(rng.randrange(-2, 22) / 2, rng.randrange(-2, 18) / 2) for _ in range(rng.randrange(3, 7))])]]))
        star = [(rng.randrange(0, 40) / 4, rng.randrange(0, 32) / 4) for _ in range(rng.randrange(3, 8))]
        shapes.append(G.ring_text([[[*star, star[0]]]]))
    found = spark.createDataFrame(list(enumerate(shapes)), "k int, wkt string").withColumn("polygons", G.from_wkt(F.col("wkt"))).withColumn("b", G.bounds(F.col("polygons")))
    found = found.select("k", "polygons", *[F.col("b")[c].alias("b_" + c) for c in ("minx", "miny", "maxx", "maxy")])
    got = rows(SP.box_cells(found, SP.grid(spark, (0, 0, 10, 8), 1), (0, 0), 1, 1, size, "polygons").select("k", "row", "col"))
    cell = lambda r, c: f"POLYGON (({c} {r}, {c + 1} {r}, {c + 1} {r + 1}, {c} {r + 1}, {c} {r}))"
    assert got == [(k, r, c) for k, w in enumerate(shapes) for r in range(8) for c in range(10) if G.meet(w, cell(r, c))]


def test_a_point_and_a_missing_polygon_among_polygons(spark):
    some = [(1, [[[(2.5, 3.5)]]], 2.5, 3.5, 2.5, 3.5), (2, None, 0.0, 0.0, 4.0, 4.0), (3, [], 0.0, 0.0, 4.0, 4.0)]
    boxes = spark.createDataFrame(some, f"k int, polygons {G.POLYGONS}, b_minx double, b_miny double, b_maxx double, b_maxy double")
    assert rows(SP.box_cells(boxes, SP.grid(spark, (0, 0, 4, 4), 1), (0, 0), 1, 1, (4, 4), "polygons").select("k", "row", "col")) == [(1, 3, 2)]


def test_batches_by_length():
    box = [G.ring_text([[[(i, 0), (i + 1, 0), (i + 1, 1), (i, 0)]]]) for i in range(5)]
    out = SP.batches_by_length(box, len(SP.joint(box[:2])))
    assert [len(b) for b in out] == [2, 2, 1]
    assert [len(b) for b in SP.batches_by_length(box, 5)] == [1] * 5
