"""Searches, transfers, views and the command line, over tables and folders in place of live services."""

import hashlib
import json
import os

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from orbitframe.cli import main
from orbitframe.functions import geometry as G
from orbitframe.functions import overlay
from orbitframe.functions import pixels as P
from orbitframe.logs import logger
from orbitframe.operators import transfer as X
from orbitframe.sources import connectors, schemas, sinks, tiles, vector

SQUARE = "POLYGON ((0 0, 1 0, 1 1, 0 1, 0 0))"


def scene(i, **more):
    row = {
        "Id": f"id{i}", "Name": f"S2A_MSIL2A_{i}.SAFE", "S3Path": f"/eodata/S2/S2A_MSIL2A_{i}.SAFE", "ContentDate": f"2023-06-{i + 1:02d}T10:00:00.000Z", "GeoFootprint": SQUARE, "Collection": "SENTINEL-2",
        "productType": "S2MSI2A", "orbitDirection": "DESCENDING", "cloudCover": 10.0 * i, "relativeOrbitNumber": 5, "operationalMode": "INS-NOBS", "platformSerialIdentifier": "A",
    }
    return row | more


def scenes(spark, *rows):
    return spark.createDataFrame([{k: v for k, v in r.items()} for r in rows])


def test_optical_search(spark):
    far = "POLYGON ((50 50, 51 50, 51 51, 50 51, 50 50))"
    table = scenes(spark, scene(0), scene(1), scene(1), scene(2, GeoFootprint=far), scene(3, ContentDate="2024-06-01T00:00:00.000Z"), scene(4, platformSerialIdentifier="B"), scene(5, GeoFootprint=None))
    year = [("2023-01-01T00:00:00.000Z", "2023-12-31T23:59:59.999Z")]
    ids = lambda *a, **k: [r.Id for r in connectors.optical(table, *a, **k).collect()]
    assert ids(year, [SQUARE]) == ["id0", "id1", "id4"]
    assert ids(year, [SQUARE], cloud_below=10.0) == ["id0"]
    assert ids(year, [SQUARE], platform="A", rel_orbit=5, mode="INS-NOBS", product="S2MSI2A", orbit="DESCENDING") == ["id0", "id1"]
    assert ids(year, [SQUARE], attributes={"platformSerialIdentifier": "B"}) == ["id4"]
    bursts = table.withColumnsRenamed({"operationalMode": "OperationalMode", "platformSerialIdentifier": "PlatformSerialIdentifier"}).withColumns({"BurstId": F.length("Id"), "SwathIdentifier": F.right("Id", F.lit(1))})
    got = connectors.optical(bursts, year, [SQUARE, far], burst=True, swath="2", burst_id=3, mode="INS-NOBS", rel_orbit=5)
    assert [r.Id for r in got.collect()] == ["id2"]
    with pytest.raises(ValueError, match="bursts"):
        ids(year, [SQUARE], burst_id=4)
    with pytest.raises(ValueError, match="unknown"):
        ids(year, [SQUARE], nothing=4)


def product(i, **more):
    row = {
        "fileName": f"g{i}.zip", "url": f"https://x/g{i}.zip", "beamMode": "IW", "flightDirection": "ASCENDING", "polarization": "VV+VH", "pathNumber": 0, "relativeOrbit": 15, "startTime": f"2023-06-{i + 1:02d}T10:00:00Z",
        "stopTime": "x", "bytes": 1048576, "sizeMB": 9.0, "md5sum": None, "processingLevel": "GRD_HD", "wkt": SQUARE,
    }
    return row | more


PRODUCT = "fileName string, url string, beamMode string, flightDirection string, polarization string, pathNumber long, relativeOrbit long, startTime string, stopTime string, bytes long, sizeMB double, md5sum string, processingLevel string, wkt string"


def products(spark, *rows):
    names = [x.split(" ")[0] for x in PRODUCT.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], PRODUCT)


def test_radar_search(spark):
    table = products(spark, product(2), product(0, bytes=None), product(0, bytes=None), product(1, flightDirection="DESCENDING"), product(3, url=None), product(4, beamMode="EW"), product(5, processingLevel="SLC"), product(29, startTime="2023-07-01T00:00:00Z"))
    june = [("2023-06-01", "2023-06-30")]
    got = connectors.radar(table, june, [SQUARE], levels=["grd_hd"], polarization="vv+vh").collect()
    assert [(r.granule, r.sizeMB, r.expected_size, r.relativeOrbit) for r in got] == [("g0.zip", 9.0, None, 15), ("g1.zip", 1.0, 1048576, 15), ("g2.zip", 1.0, 1048576, 15)]
    assert connectors.radar(table, june, [SQUARE], direction="descending").count() == 1
    assert connectors.radar(table, june, [], rel_orbit=15, most=2).count() == 2
    rows, best, counts = connectors.one_direction(connectors.radar(table, june, [SQUARE], levels=["GRD_HD"]))
    assert (best, counts, rows.count()) == ("ASCENDING", {"ASCENDING": 2, "DESCENDING": 1}, 2)
    for bad in ({"beam": "XX"}, {"polarization": "YY"}, {"levels": ["ZZ"]}):
        with pytest.raises(ValueError):
            connectors.radar(table, june, [], **bad)
    with pytest.raises(ValueError):
        connectors.radar(table, [("2023-06-02", "2023-06-01")], [])


def test_feature_collections(spark):
    text = json.dumps({"features": [{"properties": {"fileName": "a", "bytes": 3}, "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}}]})
    row = connectors.flatten(spark.createDataFrame([(text,), ('{"features":[]}',)], "v string"), "v", "fileName:string,bytes:bigint").first()
    assert tuple(row) == ("a", 3, "POLYGON ((0 0, 1 0, 1 1, 0 0))")


def test_areas_in_batches():
    far = [f"POLYGON (({i} 0, {i + 0.5} 0, {i + 0.5} 0.5, {i} 0))" for i in range(9)]
    out = connectors.area_batches(far, 120)
    assert all(len(b) <= 120 for b in out) and sum(len(G.rings_of(b)) for b in out) == 9


# --- overlays -------------------------------------------------------------------------------------


def test_unions():
    assert G.union([SQUARE, "POLYGON ((1 0, 2 0, 2 1, 1 1, 1 0))"]) == "POLYGON ((0 0, 2 0, 2 1, 0 1, 0 0))"
    assert G.union([SQUARE, "POLYGON ((0.5 0.5, 2 0.5, 2 2, 0.5 2, 0.5 0.5))"]) == "POLYGON ((0 0, 1 0, 1 0.5, 2 0.5, 2 2, 0.5 2, 0.5 1, 0 1, 0 0))"
    frame = ["POLYGON ((0 0, 3 0, 3 1, 0 1, 0 0))", "POLYGON ((0 2, 3 2, 3 3, 0 3, 0 2))", "POLYGON ((0 0, 1 0, 1 3, 0 3, 0 0))", "POLYGON ((2 0, 3 0, 3 3, 2 3, 2 0))"]
    assert G.union(frame) == "POLYGON ((0 0, 3 0, 3 3, 0 3, 0 0), (1 1, 1 2, 2 2, 2 1, 1 1))"
    assert G.union([SQUARE, SQUARE, "POLYGON ((5 5, 6 5, 6 6, 5 5))"]) == "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 1, 0 0)), ((5 5, 6 5, 6 6, 5 5)))"
    assert G.union(["POLYGON ((0 0, 1 0, 0 0, 0 0))"]) is None


def test_unions_against_samples():
    """Random triangles: a point lies in the union just where it lies in one of them."""
    import numpy as np

    rng = np.random.default_rng(3)
    for n in (2, 5, 12):
        corners = [[tuple(map(float, p)) for p in rng.uniform(0, 4, (3, 2)).round(3)] for _ in range(n)]
        parts = [[[*c, c[0]]] for c in corners]
        joined = overlay.outline(parts)
        points = rng.uniform(0, 4, (4000, 2))
        assert (overlay.covered(points, parts) == overlay.covered(points, joined)).all()
        assert all(overlay.valid(p) for p in joined)


def test_repairs():
    assert G.union(["POLYGON ((0 0, 2 2, 2 0, 0 2, 0 0))"]) == "MULTIPOLYGON (((0 0, 1 1, 0 2, 0 0)), ((1 1, 2 0, 2 2, 1 1)))"
    assert not overlay.valid(G.rings_of("POLYGON ((0 0, 2 2, 2 0, 0 2, 0 0))")[0]) and overlay.valid(G.rings_of(SQUARE)[0])


def test_simplification_keeps_rings_apart():
    """A narrow bay whose thinning would cross the island in it."""
    bay = [(0, 0), (10, 0), (10, 5), (5.2, 5), (5, 0.3), (4.8, 5), (0, 5), (0, 0)]
    island = [(4.95, 0.1), (5.05, 0.1), (5, 0.2), (4.95, 0.1)]
    out = G.simpler([bay, island], 0.25)
    assert overlay.valid(out)


def test_area_tests_equal_the_plain_ones(spark):
    area = ["POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 2 1, 2 2, 1 2, 1 1))", "POLYGON ((4 0, 6 0, 6 2, 4 2, 4 0))"]
    joined, a = G.union(area), G.Area(area)
    boxes = [(x / 4, y / 4, x / 4 + w, y / 4 + w) for x in range(-4, 28, 3) for y in range(-4, 20, 3) for w in (0.25, 1.0)]
    df = spark.createDataFrame(boxes, "minx double, miny double, maxx double, maxy double")
    own = {c: F.col(c) for c in df.columns}
    wkt = G.box_wkt(*own.values())
    for r in df.select(wkt.alias("w"), G.box_meets_area(own, a).alias("m"), G.box_in_area(own, a).alias("i"), G.polygons_meet_area(G.from_wkt(wkt), a).alias("p")).collect():
        assert r.m == r.p == G.meet(r.w, joined), r.w
        assert r.i == G.lies_in(r.w, joined), r.w


def test_shapefiles_and_packages(spark, tmp_path):
    import sqlite3
    import struct

    holed = "POLYGON ((0 0, 0 3, 3 3, 3 0, 0 0), (1 1, 2 1, 2 2, 1 2, 1 1))"
    vector.write_shp([({"name": "a", "n": 1}, holed), ({"name": "b"}, "MULTIPOLYGON (((5 5, 5 6, 6 6, 5 5)), ((8 8, 8 9, 9 9, 8 8)))")], str(tmp_path / "a.shp"))
    rows = vector.read_vector(spark, str(tmp_path / "a.shp")).collect()
    assert [r.wkt for r in rows] == [holed, "MULTIPOLYGON (((5 5, 5 6, 6 6, 5 5)), ((8 8, 8 9, 9 9, 8 8)))"] and json.loads(rows[0].properties) == {"name": "a", "n": "1"}
    con = sqlite3.connect(tmp_path / "g.gpkg")
    con.execute("CREATE TABLE gpkg_geometry_columns (table_name TEXT, column_name TEXT)")
    con.execute("INSERT INTO gpkg_geometry_columns VALUES ('t', 'geom')")
    con.execute("CREATE TABLE t (fid INTEGER, name TEXT, geom BLOB)")
    wkb = struct.pack("<BII", 1, 3, 1) + struct.pack("<I8d", 4, 0, 0, 1, 0, 1, 1, 0, 0)
    con.execute("INSERT INTO t VALUES (1, 'x', ?)", (b"GP\0\3" + struct.pack("<i4d", 4326, 0, 1, 0, 1) + wkb,))
    con.commit()
    con.close()
    assert [(json.loads(r.properties), r.wkt) for r in vector.read_vector(spark, str(tmp_path / "g.gpkg")).collect()] == [({"fid": 1, "name": "x"}, "POLYGON ((0 0, 1 0, 1 1, 0 0))")]


# --- transfers ------------------------------------------------------------------------------------


def store_of(tmp_path, **named):
    folder = tmp_path / "store"
    folder.mkdir(exist_ok=True)
    for name, data in named.items():
        (folder / f"{name}.zip").write_bytes(data)
    return str(folder)


def test_products_are_fetched_once(spark, tmp_path):
    root, out = store_of(tmp_path, a=b"abc", b=b"defg", c=b"x"), str(tmp_path / "out")
    rows = [("a", 3, hashlib.md5(b"abc").hexdigest().upper()), ("b", 4, None), ("c", 9, None), ("d", None, None)]
    manifest = spark.createDataFrame([(f"https://x/{n}.zip", f"{n}.zip", s, None, m) for n, s, m in rows] + [("https://x/a.zip", "a.zip", 3, None, hashlib.md5(b"abc").hexdigest())], "url string, granule string, expected_size long, sizeMB double, md5sum string")
    source = X.local_store(root, "https://x/")
    seen = Observation()
    done = X.product_state(X.observed(X.carried_out(X.product_plan(manifest, out, None), source, 2, 0.0), seen)).persist()
    got = {r.filename: (r.status, r.last_action, r.error) for r in done.collect()}
    assert got["a.zip"] == ("complete", "downloaded", None) and got["b.zip"][0] == "complete"
    assert got["c.zip"] == ("failed", "failed", "size mismatch for c.zip: expected 9, got 1") and got["d.zip"][0] == "failed"
    assert seen.get == {"downloaded": 2, "skipped": 0, "failed": 2, "files": 4} and X.totals(done)["failed"] == 2
    assert sorted(os.listdir(out)) == ["a.zip", "b.zip"]  # no partial files
    state = schemas.conform(done, schemas.DOWNLOADS)
    again = {r.url[-5:]: r.action for r in X.product_plan(manifest, out, state).collect()}
    assert again == {"a.zip": "skip", "b.zip": "skip", "c.zip": "download", "d.zip": "download"}
    (tmp_path / "out" / "a.zip").write_bytes(b"abd")  # same size, other bytes
    assert {r.url[-5:]: r.action for r in X.product_plan(manifest, out, state).collect()}["a.zip"] == "download"


def test_errors_that_may_pass():
    kinds = [X.NotAllowed(), X.Answer(None), X.Answer(429), X.Answer(503), X.Answer(404), TimeoutError(), ConnectionError(), OSError("size mismatch for x"), OSError("MD5 mismatch for x"), OSError("disk"), ValueError()]
    assert [X.may_pass(e) for e in kinds] == [False, True, True, True, False, True, True, True, True, False, False]


def test_tries(tmp_path):
    calls = []

    def flaky(_, url):
        calls.append(url)
        if len(calls) < 3:
            raise ConnectionError("no")
        import io

        return io.BytesIO(b"abc")

    got = X.fetch_one(X.Source(flaky), None, "u", str(tmp_path / "f"), 3, None, 3, 0.0, False)
    assert got[:3] == ("complete", "downloaded", 3) and len(calls) == 3
    assert X.fetch_one(X.Source(lambda *_: open(os.devnull, "rb")), None, "u", str(tmp_path / "g"), None, None, 1, 0.0, True)[4].startswith("downloaded file is empty")


def test_scene_results(spark):
    names = spark.createDataFrame([("A_MSIL2A",), ("B_MSIL1C",), ("C",)], "Name string")
    done = spark.createDataFrame([("A_MSIL2A", "B02@10m", "downloaded"), ("A_MSIL2A", "MTD_MSIL2A", "skipped"), ("B_MSIL1C", "B02", "failed"), ("B_MSIL1C", "MTD_MSIL1C", "skipped"), ("B_MSIL1C", "MTD_TL", "skipped")], "safedir string, label string, last_action string")
    got = {r.Name: r for r in X.scene_results(names, done, [("B02", 10)], F.contains("Name", F.lit("L1C"))).collect()}
    assert got["A_MSIL2A"].succeeded == ["B02@10m"] and got["A_MSIL2A"].failed == ["MISSING:MTD_TL"] and not got["A_MSIL2A"].ok
    assert got["B_MSIL1C"].failed == ["B02"] and got["B_MSIL1C"].skipped == ["MTD_MSIL1C", "MTD_TL"]
    assert got["C"].failed == ["NO_ASSETS_FOUND"]
    radar = {r.Name: r.failed for r in X.scene_results(names, done, [("VV", 0)], None).collect()}
    assert radar["A_MSIL2A"] == ["MISSING:VV"]


# --- tiles ----------------------------------------------------------------------------------------


def test_views(spark, tmp_path):
    new, old = "/d/S2A_MSIL2A_N0500_X.SAFE/B03.jp2", "/d/S2A_MSIL2A_N0214_X.SAFE/B03.jp2"
    rows = spark.createDataFrame([(new, [1500, 65535, 3, 9], [8, 4, 0, 4]), (old, [1500, 65535, 3, 9], [4, 4, 4, 4])], "path string, px array<int>, scl array<int>")
    got = {r.path: (r.px, r.dn_offset) for r in spark.table(tiles.offset_view(rows, "v1")).collect()}
    assert got == {new: ([500, 65535, 0, 0], 1000), old: ([1500, 65535, 3, 9], 0)}
    assert spark.table(tiles.masked_view(rows, "v2", [8], 2, 2)).first().px == [65535, 65535, 65535, 9]
    coarse = rows.limit(1).withColumns({"px": F.array(F.lit(7))})
    assert spark.table(tiles.masked_view(coarse, "v3", [8], 1, 2)).first().px == [65535]
    fine = spark.createDataFrame([([1] * 16, [8, 4, 4, 4])], "px array<int>, scl array<int>")
    assert spark.table(tiles.masked_view(fine, "v4", [8], 4, 2)).first().px == [65535, 65535, 1, 1] * 2 + [1] * 8

    def half(px, by):
        return px // by

    half.arrays = True
    assert spark.table(tiles.derived_view(rows, "v5", half, ["px"], by=2)).first().px == [750, 32767, 1, 4]
    assert spark.table(tiles.derived_view(rows, "v6", lambda px, by: F.transform(px, lambda v: v + by), ["px"], by=1)).first().px[2] == 4
    tiles.write_tiles(spark.table("v1"), str(tmp_path / "t"))
    assert sinks.read_table(spark, str(tmp_path / "t")).count() == 2
    info = tiles.grid_info(spark.createDataFrame([(10.0, 50.0, 2.0, -2.0, 5, 4)], "xmin double, ymax double, xres double, yres double, xsize int, ysize int")).first()
    assert (info.xmax, info.ymin, info.yres) == (20.0, 42.0, 2.0)
    files = spark.createDataFrame([("s", "SCL", 60, "c"), ("s", "SCL", 20, "b"), ("s", "B02", 10, "x"), ("r", "SCL", 60, "z")], "safedir string, band string, resolution_m int, path string")
    assert {r.safedir: r.scl_path for r in tiles.class_tile(files, F.lit(10)).collect()} == {"s": "b", "r": "z"}
    assert P.NODATA == 65535


def test_logs(tmp_path):
    log = logger("t", str(tmp_path), True)
    log.info("hello")
    logger("t", str(tmp_path / "x" / "run"), False).warning("there")
    assert "hello" in next(tmp_path.glob("orbitframe_*.log")).read_text() and "there" in next((tmp_path / "x").glob("run_*.log")).read_text()


# --- the command line -----------------------------------------------------------------------------


@pytest.fixture
def run(spark, tmp_path, monkeypatch, capsys):
    monkeypatch.chdir(tmp_path)

    def call(*words):
        capsys.readouterr()
        code = main([str(w) for w in words], spark)
        got = capsys.readouterr()
        return code, got.out + got.err

    return call


def aoi(tmp_path, text=SQUARE):
    at = tmp_path / "aoi.geojson"
    ring = [[list(c) for c in r] for r in G.rings_of(text)[0]]
    at.write_text(json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {}, "geometry": {"type": "Polygon", "coordinates": ring}}]}))
    return at


def test_commands_for_areas(run, tmp_path):
    assert run("bbox2geojson", "--bbox", "0 0, 2 1", "--output", tmp_path / "b")[0] == 0 and (tmp_path / "b.geojson").exists()
    assert run("bbox2geojson", "--bbox", "2,0,0,1")[0] == 2 and run("bbox2geojson", "--bbox", "1,2,3")[0] == 2
    (tmp_path / "p.csv").write_text("name,lon,lat\na,1,2\n")
    assert run("csv2geojson", "--csv", tmp_path / "p.csv", "--output", tmp_path / "p.geojson")[0] == 0
    assert run("csv2geojson", "--csv", tmp_path / "p.csv", "--lon", "x")[0] == 2 and run("csv2geojson", "--csv", tmp_path / "none.csv")[0] == 2
    holed = "POLYGON ((0 0, 3 0, 3 3, 0 3, 0 0), (1.1 1.1, 1.9 1.1, 1.9 1.9, 1.1 1.9, 1.1 1.1))"
    at = aoi(tmp_path, holed)
    n = lambda *more: (run("grid", "--aoi", at, "--px", 0.25, "--output", tmp_path / "g.geojson", *more)[0], len(json.load(open(tmp_path / "g.geojson"))["features"]))
    assert n() == (0, 144) and n("--no-fill-holes") == (0, 140) and n("--no-fill-holes", "--clip", "within") == (0, 128) and n("--clip", "all") == (0, 144)
    assert run("grid", "--aoi", at, "--px", 0)[0] == 2 and run("grid", "--aoi", tmp_path / "none", "--px", 1)[0] == 2 and run("nothing")[0] == 2


def test_commands_for_radar(run, spark, tmp_path):
    table, at, cache = str(tmp_path / "cat"), aoi(tmp_path), str(tmp_path / "cache")
    a, b = b"abc", b"defg"
    root = store_of(tmp_path, g0=a, g1=b)
    products(spark, product(0, bytes=3, md5sum=hashlib.md5(a).hexdigest()), product(1, bytes=4, flightDirection="DESCENDING"), product(2, startTime="2022-06-03T00:00:00Z", bytes=None, sizeMB=None)).write.parquet(table)
    search = ("asf", "query", "--aoi", at, "--catalogue", table, "--cache-dir", cache, "--years", "2023, 2022", "--speriod", "06-01", "--eperiod", "Jun 30")
    code, text = run(*search)
    assert code == 0 and "Found 3 unique" in text
    assert run(*search, "--flight-direction", "predominant")[1].count("ASCENDING=2, DESCENDING=1; selected ASCENDING") == 1
    assert "selected ASCENDING" in run(*search, "--flight-direction", "predominant")[1]  # from the cache
    assert "WARNING" in run(*search, "--max-results", "1")[1]
    for bad in (("--years", "x"), ("--years", "10000"), ("--eperiod", "01-01"), ("--beam-mode", "Q"), ("--crs", "x")):
        assert run(*search, *bad)[0] == 2
    assert run(*search)[0] == 0
    (tmp_path / "netrc").write_text("machine urs.earthdata.nasa.gov login u password p\n")
    get = ("asf", "download", "--outdir", tmp_path / "out", "--config", tmp_path / "netrc", "--cache-dir", cache, "--store", root, "--prefix", "https://x/", "--wait", "0", "--retries", "0")
    code, text = run(*get)
    assert code == 1 and "2 downloaded, 0 skipped, 1 failed" in text and "Found 3 scenes: 3 ZIP files" in text
    assert "0 downloaded, 2 skipped, 1 failed" in run(*get)[1]
    state = sinks.read_table(spark, str(tmp_path / "out" / ".orbitframe" / "asf_downloads.parquet"))
    assert {r.filename: r.status for r in state.collect()} == {"g0.zip": "complete", "g1.zip": "complete", "g2.zip": "failed"}
    (tmp_path / "bad").write_text("")
    assert run(*get[:5], tmp_path / "bad", *get[6:])[0] == 2


def test_commands_for_optical(run, spark, tmp_path):
    table, at, cache = str(tmp_path / "cat"), aoi(tmp_path), str(tmp_path / "cache")
    scenes(spark, scene(0), scene(1), scene(2, cloudCover=90.0)).write.parquet(table)
    search = ("cdse", "query", "--aoi", at, "--crs", "EPSG:4326", "--catalogue", table, "--cache-dir", cache, "--years", "2023")
    assert "Found 3 unique scene(s)" in run(*search)[1] and "Found 1 unique" in run(*search, "--no-count", "--top", "1")[1]
    code, text = run(*search, "--cloud-thresh", "50", "--product", "S2MSI2A", "--rel-orbit-num", "5")
    assert code == 0 and "Found 2 unique" in text
    assert run(*search, "--product", "X")[0] == 2 and run(*search, "--cloud-thresh", "101")[0] == 2
    root, lines = tmp_path / "eodata", []
    for i in (0, 1):
        for name in (f"GRANULE/L2A_T_{i}/IMG_DATA/R20m/T_2023_B03_20m.jp2", f"GRANULE/L2A_T_{i}/IMG_DATA/R20m/T_2023_B04_20m.jp2", f"GRANULE/L2A_T_{i}/MTD_TL.xml", "MTD_MSIL2A.xml"):
            if i and "MTD_TL" in name:
                continue
            f = root / "S2" / f"S2A_MSIL2A_{i}.SAFE" / name
            f.parent.mkdir(parents=True, exist_ok=True)
            f.write_bytes(name.encode())
            lines.append(f"2023/06/01 00:00:00 {len(name)} s3://eodata/S2/S2A_MSIL2A_{i}.SAFE/{name}")
    (tmp_path / "listing.txt").write_text("\n".join(lines) + "\n")
    (tmp_path / "cfg").write_text("[default]\naccess_key=a\nsecret_key=b\nhost_base=c\n")
    get = ("cdse", "download", "--outdir", tmp_path / "out", "--config", tmp_path / "cfg", "--cache-dir", cache, "--store", root, "--listing", tmp_path / "listing.txt", "--wait", "0", "--bands", "B03 B04")
    code, text = run(*get)
    assert code == 1 and "7 downloaded, 0 skipped, 1 failed" in text and "Found 2 scenes: 2 requested images per scene" in text  # one scene lacks MTD_TL
    assert "0 downloaded, 7 skipped, 1 failed" in run(*get)[1]
    assert (tmp_path / "out" / "S2A_MSIL2A_0.SAFE" / "GRANULE" / "L2A_T_0" / "IMG_DATA" / "R20m" / "T_2023_B03_20m.jp2").exists()
    assert sinks.read_table(spark, str(tmp_path / "out" / ".orbitframe" / "cdse_downloads.parquet")).count() == 7
    for bad in (("--bands", "B99"), ("--bands", "B10"), ("--bands", " "), ("--mission", "S1"), ("--cache-dir", str(tmp_path / "none"))):
        assert run(*get, *bad)[0] == 2
    code, text = run("s2", "dn-offset", "--input-dir", tmp_path / "out", "--output-dir", tmp_path / "dn", "--years", "2023", "--speriod", "06-01", "--eperiod", "08-31", "--bands", "B05")
    assert code == 1 and "No files for B05" in text


def test_offsets_of_bands(run, spark, tmp_path):
    for base, day in (("N0500", "20230616"), ("N0214", "20200616")):
        f = tmp_path / "in" / f"S2A_MSIL2A_{day}T213529_{base}_R1.SAFE" / "R20m" / f"T06WVB_{day}T213529_B03_20m.jp2"
        f.parent.mkdir(parents=True)
        f.write_bytes(b"x")
    px = str(tmp_path / "px")
    spark.createDataFrame([(str(f), [1500])], "path string, px array<int>").write.parquet(px)
    code, text = run("s2", "dn-offset", "--input-dir", tmp_path / "in", "--output-dir", tmp_path / "dn", "--years", "2020 2023", "--speriod", "06-01", "--eperiod", "08-31", "--bands", "B03", "--tiles", px)
    assert code == 0 and "processed 2 bands" in text
    assert sorted(r.dn_offset for r in sinks.read_table(spark, str(tmp_path / "dn" / "dn_offset.parquet")).collect()) == [0, 1000]
    assert sinks.read_table(spark, str(tmp_path / "dn" / "tiles.parquet")).first().px == [1500]
