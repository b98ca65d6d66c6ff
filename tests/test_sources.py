import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, LessThan

from orbitframe.sources import catalogue as C
from orbitframe.sources import files, schemas, sinks, store
from orbitframe.streaming import state as ST


def test_manifests_written_by_other_tools(spark, tmp_path):
    import pandas as pd

    pd.DataFrame({"url": ["u"], "granule": [None], "relativeOrbit": [3], "extra": [1]}).to_parquet(tmp_path / "m.parquet", index=True)
    df = schemas.read(spark, str(tmp_path / "m.parquet"), schemas.MANIFEST)
    assert df.columns == [n for n, _ in schemas.fields(schemas.MANIFEST)]
    assert dict(df.dtypes)["granule"] == "string" and df.first().relativeOrbit == 3
    pd.DataFrame(columns=["Id", "Name"]).to_parquet(tmp_path / "e.parquet")
    assert schemas.read(spark, str(tmp_path / "e.parquet"), schemas.SCENES).count() == 0
    with pytest.raises(ValueError):
        schemas.require(df, "Id")


def test_points_and_polygons(spark, tmp_path):
    (tmp_path / "p.csv").write_text("name,lon,lat\na,-149.5,68.25\n")
    points = files.csv_points(spark, str(tmp_path / "p.csv"), "lon", "lat")
    assert points.columns == ["name", "wkt"] and points.first().wkt == "POINT (-149.5 68.25)"
    with pytest.raises(ValueError):
        files.csv_points(spark, str(tmp_path / "p.csv"), "x", "lat")
    box = files.bbox_table(spark, (-150, 68, -149.5, 68.5))
    at = sinks.write_geojson(box.select(F.lit(1).alias("id"), "wkt"), str(tmp_path / "o" / "box.json"))
    assert at.endswith("box.geojson") and json.load(open(at))["features"][0]["geometry"]["type"] == "Polygon"
    back = files.geojson(spark, at).first()
    assert back.wkt == box.first().wkt and back.bounds.minx == -150 and json.loads(back.properties) == {"id": 1}
    sinks.write_geojson(points, str(tmp_path / "p.geojson"))
    assert json.load(open(tmp_path / "p.geojson"))["features"][0]["geometry"]["coordinates"] == [-149.5, 68.25]
    with pytest.raises(ValueError):
        files.bbox_table(spark, (1, 0, 0, 1))
    with pytest.raises(Exception, match="longitude"):
        files.geometry_table(spark, ["POLYGON ((0 0, 900 0, 900 9, 0 0))"]).collect()
    assert files.url_table(spark, ["a", "b"]).count() == 2


def test_listings(spark, tmp_path):
    (tmp_path / "l.txt").write_text("2024/01/01 00:00:00 12  s3://eodata/S2/A.SAFE/GRANULE/g/IMG_DATA/R20m/T_B03_20m.jp2\nDIR x\n2024/01/01 00:00:00 7 MTD_MSIL2A.xml\n2024/01/01 00:00:00 x y\n")
    df = files.read_listing(spark, str(tmp_path / "l.txt"))
    assert df.count() == 2
    got = files.image_assets(df, F.lit("/eodata/S2/A.SAFE"), F.lit(False)).orderBy("size").collect()
    assert [(r.band_name, r.resolution_m, r.asset_type) for r in got] == [("MTD_MSIL2A", 0, "metadata"), ("B03", 20, "image")]
    names = ["T05WNS_20240101T000000_PVI.jp2", "T05WNS_20240101T000000_B10.jp2", "MTD_MSIL2A.xml", "MTD_MSIL1C.xml", "MTD_TL.xml"]
    first = spark.createDataFrame([(1, n) for n in names], "size long, path string")
    assert {r.band_name for r in files.image_assets(first, F.lit("/x"), F.lit(True)).collect()} == {"B10", "MTD_MSIL1C", "MTD_TL"}
    assert {r.band_name for r in files.image_assets(first, F.lit("/x"), F.lit(False)).collect()} == {"MTD_MSIL2A", "MTD_TL"}


def test_assets_asked_for(spark):
    rows = spark.createDataFrame([("B03", 20, "image"), ("B04", 20, "image"), ("B03", 10, "image"), ("MTD_TL", 0, "metadata")], "band_name string, resolution_m int, asset_type string")
    got = files.requested(rows, [("B03", 20)], F.lit(False))
    assert {(r.band_name, r.resolution_m) for r in got.collect()} == {("B03", 20), ("MTD_TL", 0)}
    assert {(r.band_name, r.resolution_m) for r in files.requested(rows.withColumn("resolution_m", F.lit(0)), [("B03", 20)], F.lit(True)).collect()} == {("B03", 0), ("MTD_TL", 0)}


def test_measurements(spark):
    """The first file by name of each polarisation, its place made relative to the scene."""
    rows = [("A", 5, "s1a-iw-grd-vv-2-002.tiff"), ("A", 4, "s1a-iw-grd-vv-1-001.tiff"), ("A", 3, "s3://x/A/measurement/s1a-iw-grd-vh-1.tiff"), ("A", 9, "s1a-iw-grd-hh-1.tiff"), ("A", 9, "s1a-vv.xml"), ("B", 1, "b-vv-1.tiff")]
    got = files.measurement_assets(spark.createDataFrame(rows, "safedir string, size long, path string"), ["VV", "VH"])
    assert sorted((r.safedir, r.band_name, r.img_path_in_safedir, r.size) for r in got.collect()) == [
        ("A", "VH", "measurement/s1a-iw-grd-vh-1.tiff", 3), ("A", "VV", "measurement/s1a-iw-grd-vv-1-001.tiff", 4), ("B", "VV", "measurement/b-vv-1.tiff", 1),
    ]
    made = files.asset_rows(got, F.lit("/eodata/S1/A/"))
    assert made.columns == [n for n, _ in schemas.fields(schemas.IMAGES)] and {r.s3_path for r in made.collect()} == {"/S1/A"}


def test_band_files(spark, tmp_path):
    for name in ("R20m/T06WVB_20200616T213529_B03_20m.jp2", "R10m/T06WVB_20200616T213529_B03_10m.jp2", "R10m/T06WVB_20200616T213529_B08_10m.jp2"):
        at = tmp_path / "S.SAFE" / name
        at.parent.mkdir(parents=True, exist_ok=True)
        at.write_bytes(b"x")
    found = files.bands_at(files.band_files(spark, str(tmp_path)), ["B03", "B08"], 20)
    assert sorted((r.band, r.resolution_m, str(r.acq_date)) for r in found.collect()) == [("B03", 20, "2020-06-16"), ("B08", 10, "2020-06-16")]


def test_file_properties(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"abc")
    os.utime(tmp_path / "a", ns=(1, 1_700_000_000_123_456_789))
    rows = {r.path: r for r in files.file_stats(files.url_table(spark, [str(tmp_path / "a"), str(tmp_path / "none")]).withColumnRenamed("url", "path"), checksum=True).collect()}
    a = rows[str(tmp_path / "a")]
    assert (a.size, a.mtime_ns, a.md5) == (3, 1_700_000_000_123_456_789, "900150983cd24fb0d6963f7d28e17f72")
    assert rows[str(tmp_path / "none")].size is None
    assert files.free_bytes(str(tmp_path / "x" / "y")) > 0


def test_settings(tmp_path):
    (tmp_path / "c").write_text("[default]\naccess_key=a\nsecret_key=b\nhost_base=c\n")
    assert files.store_settings(str(tmp_path / "c"))["host_base"] == "c"
    (tmp_path / "d").write_text("[default]\naccess_key=a\n")
    for bad in ("d", "none"):
        with pytest.raises(ValueError):
            files.store_settings(str(tmp_path / bad))
    (tmp_path / "n").write_text("machine h login u password p\n")
    assert files.login(str(tmp_path / "n"), "h") == ("u", "p") and files.login(str(tmp_path / "n"), "x") is None


def test_replacing_tables(spark, tmp_path):
    at = str(tmp_path / "t.parquet")
    sinks.replace_table(spark.range(3), at)
    before = sinks.read_table(spark, at)
    sinks.replace_table(before.filter("id > 0"), at, read_only=True)
    assert sinks.read_table(spark, at).count() == 2 and before.count() == 3  # who has begun to read can end
    sinks.replace_table(spark.range(1), at)
    assert sinks.read_table(spark, at).count() == 1 and len([p for p in os.listdir(at) if p.startswith("_v-")]) == 2
    sinks.replace_csv(spark.range(2), str(tmp_path / "c"))
    assert sinks.read_table(spark, str(tmp_path / "c")).count() == 2
    sinks.save_query(str(tmp_path / "q"), years=[2020], path=tmp_path)
    assert set(sinks.read_query(str(tmp_path / "q"))) == {"years", "path", "created"} and sinks.read_query(str(tmp_path / "none")) is None
    spark.range(4).write.parquet(str(tmp_path / "plain"))
    assert sinks.table_exists(str(tmp_path / "plain")) and not sinks.table_exists(str(tmp_path / "no")) and sinks.read_table(spark, str(tmp_path / "plain")).count() == 4


@pytest.mark.parametrize("step", ["write", "protect", "rename", "after"])
def test_a_failing_replacement_leaves_a_whole_table(spark, tmp_path, monkeypatch, step):
    """Whatever step fails, there is the old table, or the new one if the swap was done; and no rests but of the last one."""
    at, replace = str(tmp_path / "t"), os.replace
    sinks.replace_table(spark.range(3), at)
    new = spark.range(5) if step != "write" else spark.range(5).select(F.raise_error(F.lit("no")).cast("long").alias("id"))

    def fail(*_):
        raise OSError("no")

    def fail_after(a, b):
        replace(a, b)
        raise OSError("no")

    if step == "protect":
        monkeypatch.setattr(store.Local, "protect", fail)
    if step in ("rename", "after"):
        monkeypatch.setattr(store.os, "replace", fail if step == "rename" else fail_after)
    with pytest.raises(Exception, match="no"):
        sinks.replace_table(new, at, read_only=True)
    monkeypatch.undo()
    assert sinks.read_table(spark, at).count() == (5 if step == "after" else 3)
    if step != "after":
        assert len([p for p in os.listdir(at) if p.startswith("_v-")]) == 1
    sinks.replace_table(spark.range(7), at)
    assert sinks.read_table(spark, at).count() == 7


def test_other_file_systems(spark, tmp_path):
    """The way through Hadoop's interface, here with this machine's files."""
    at = store.Shared(spark, f"file://{tmp_path}/a/x.json")
    assert not at.exists()
    at.replace("one")
    at.replace("two")
    assert at.read() == "two" and at.exists() and at.changed() > 1e9
    folder = store.Shared(spark, f"file://{tmp_path}/a")
    assert [n for n in folder.names() if not n.startswith(".")] == ["x.json"]
    at.touch()
    folder.protect()
    parts = [folder.child(n) for n in ("p1", "p2", "p3")]
    for p, text in zip(parts, ("a,", "bc,", "")):
        p.replace(text)
    whole = folder.child("whole")
    whole.join(parts, "[", "]", 1)
    assert whole.read() == "[a,bc]"
    whole.join(parts[2:], "[", "]", 1)
    assert whole.read() == "[]"
    folder.delete()
    assert not folder.exists() and folder.names() == []


def test_an_empty_collection(spark, tmp_path):
    at = sinks.write_geojson(spark.createDataFrame([], "id int, wkt string"), str(tmp_path / "e.geojson"))
    assert json.load(open(at)) == {"type": "FeatureCollection", "features": []}
    many = spark.range(100, numPartitions=7).select("id", F.lit("POINT (1 2)").alias("wkt"))
    at = sinks.write_geojson(many, str(tmp_path / "m.geojson"))
    assert sorted(f["properties"]["id"] for f in json.load(open(at))["features"]) == list(range(100)) and len(os.listdir(tmp_path)) == 2


def test_cache_keys(tmp_path):
    assert sinks.cache_key({"b": 2, "a": 1}) == sinks.cache_key({"a": 1, "b": 2}) == hashlib.md5(b'{"a": 1, "b": 2}').hexdigest()
    for k in ("k1", "k2"):
        (sinks.cache_folder(str(tmp_path), k) / "m").write_text(k)
    os.utime(tmp_path / "k2" / "m", (1, 1))
    assert files.latest_cached(str(tmp_path), "m").endswith("k1/m") and files.latest_cached(str(tmp_path), "z") is None
    files.touch(str(tmp_path / "k2" / "m"))
    assert files.latest_cached(str(tmp_path), "m").endswith("k2/m")


def test_searches_are_cached_if_they_succeed(spark, tmp_path):
    calls = []

    def run():
        calls.append(1)
        return spark.createDataFrame([], "Id string")

    for _ in range(2):
        assert C.cached_search(spark, str(tmp_path), {"a": 1}, run).count() == 0
    assert len(calls) == 1
    assert files.cached(spark, str(tmp_path), "scenes.parquet").columns[-2:] == ["cache_key", "changed"]
    with pytest.raises(RuntimeError):
        C.cached_search(spark, str(tmp_path), {"a": 2}, lambda: (_ for _ in ()).throw(RuntimeError()))
    assert not sinks.table_exists(str(tmp_path / sinks.cache_key({"a": 2}) / "scenes.parquet"))
    C.cached_search(spark, str(tmp_path), {"a": 3}, lambda: spark.createDataFrame([("x",)], "Id string"))
    assert [(r.Id, r.cache_key) for r in files.cached(spark, str(tmp_path), "scenes.parquet").collect()] == [("x", sinks.cache_key({"a": 3}))]
    C.cached_search(spark, str(tmp_path), {"a": 1}, run)  # used last
    assert files.latest_cached(str(tmp_path), "scenes.parquet") == f"{tmp_path}/{sinks.cache_key({'a': 1})}/scenes.parquet"


def test_plan_and_source(spark):
    assert C.plan(spark, [("a", "b"), ("c", "d")], ["w1", "w2", "w3"]).count() == 6

    def fetch(task, skip, top):
        rows = [(f"{task.start}{task.area}-{i}", i, "IW" if i % 2 else "EW") for i in range(5)]
        for column, value in task.equal:
            rows = [r for r in rows if r[("id", "n", "mode").index(column)] == value]
        return rows[skip : skip + top]

    spark.dataSource.register(C.source("offline_catalogue", "id string, n int, mode string", fetch))
    df = spark.read.format("offline_catalogue").option("windows", "2020/2021,2022/2023").option("page", 2).load()
    assert df.count() == 10 and df.select("id").distinct().count() == 10
    areas = df.sparkSession.read.format("offline_catalogue").option("windows", "2020/2021").option("areas", '["w1", "w2", "w3"]').option("attributes", '{"mode": "IW"}').load()
    assert areas.count() == 6 and areas.rdd.getNumPartitions() == 3
    pushed = spark.read.format("offline_catalogue").option("windows", "2020/2021").option("filters", "mode").load().filter("mode = 'EW' and n > 1")
    assert [(r.n, r.mode) for r in pushed.collect()] == [(2, "EW"), (4, "EW")]
    reader = C._PushingReader({"windows": "a/b", "filters": "mode"}, fetch)
    left = list(reader.pushFilters([EqualTo(("mode",), "EW"), LessThan(("mode",), "F"), GreaterThan(("n",), 1)]))
    assert left == [GreaterThan(("n",), 1)] and reader.partitions() == [C.Task("a", "b", "", (("mode", "EW"),), (("mode", "F"),))]


def test_streamed_state(spark, tmp_path):
    source, state, check = (str(tmp_path / x) for x in ("in", "state", "check"))
    schema = "url string, seq long, status string"
    spark.createDataFrame([("a", 1, "failed"), ("b", 1, "complete")], schema).write.parquet(source)
    for _ in range(2):  # a second run finds nothing new
        ST.keep_state(spark.readStream.schema(schema).parquet(source), state, check, ["url"], ["seq"]).awaitTermination()
        assert sinks.read_table(spark, state).count() == 2
    spark.createDataFrame([("a", 2, "complete")], schema).write.mode("append").parquet(source)
    ST.keep_state(spark.readStream.schema(schema).parquet(source), state, check, ["url"], ["seq"]).awaitTermination()
    assert sorted(tuple(r) for r in sinks.read_table(spark, state).collect()) == [("a", 2, "complete"), ("b", 1, "complete")]
    wanted = spark.createDataFrame([("a",), ("c",)], "url string")
    assert [r.url for r in ST.pending(spark, wanted, str(tmp_path / "none"), ["url"]).orderBy("url").collect()] == ["a", "c"]
    assert [r.url for r in ST.pending(spark, wanted, state, ["url"]).collect()] == ["c"]


def test_a_batch_rewrites_what_it_touches(spark, tmp_path):
    state = str(tmp_path / "state")
    rows = spark.range(200).select(F.col("id").cast("string").alias("url"), F.lit(1).alias("seq"), F.lit("complete").alias("status"))
    ST.merge_rows(rows, state, ["url"], ["seq"])
    before = sinks.pointer(state)["folders"]
    ST.merge_rows(rows.limit(1).withColumns({"seq": F.lit(2), "note": F.lit("x")}), state, ["url"], ["seq"])
    after = sinks.pointer(state)["folders"]
    assert len(before) > 20 and sum(before[b] != after[b] for b in after) == 1
    now = sinks.read_table(spark, state)
    assert now.count() == 200 and now.filter("seq = 2 and note = 'x'").count() == 1
    ST.merge_rows(rows.limit(0), state, ["url"], ["seq"])
    assert sinks.pointer(state)["folders"] == after
    assert ST.Roots("c", "o").downloads("asf") == "o/.orbitframe/asf_downloads.parquet" and ST.Roots("c", "o").discovered.startswith("c/")
