import datetime as dt

import pytest
from pyspark.sql import functions as F

from orbitframe.functions import dates as D
from orbitframe.functions import geometry as G
from orbitframe.functions import numbers as N
from orbitframe.functions import pixels as P
from orbitframe.functions import text as T
from orbitframe.functions import vocab as V


def one(spark, column, **values):
    df = spark.range(1)
    for k, v in values.items():
        df = df.withColumn(k, F.lit(v))
    return df.select(column).first()[0]


@pytest.mark.parametrize("size, text", [(0, "0 B"), (-3, "0 B"), (1023, "1023 B"), (1536, "1.5 KiB"), (1280, "1.2 KiB"), (1 << 20, "1.0 MiB"), (5 << 50, "5.0 PiB")])
def test_byte_counts(spark, size, text):
    assert one(spark, T.format_bytes(F.lit(size).cast("long"))) == text


@pytest.mark.parametrize(
    "url, name",
    [
        ("https://h/a/b.zip?x=1#f", "b.zip"), ("https://h/a%20b.zip", "a b.zip"), ("https://h/a+b.zip", "a+b.zip"), ("https://h/a/b/", "b"),
        ("https://h/", "G.zip"), ("https://h", "G.zip"), ("https://h/x%zz", "x%zz"), ("https://h/..", None), ("/x/y.zip;v=1", "y.zip"),
    ],
)
def test_names_of_urls(spark, url, name):
    assert one(spark, T.url_filename(F.lit(url), F.lit("d/G.zip"))) == name


def test_lists_and_codes(spark):
    assert one(spark, T.split_list(F.lit("b02,B8A scl  AOT"))) == ["b02", "B8A", "scl", "AOT"]
    assert one(spark, T.split_list(F.lit("  "))) == []
    assert one(spark, T.class_codes(F.lit('"9, 3;10"'))) == "3,9,10"


def test_listed_paths(spark):
    p = lambda x: one(spark, T.asset_path(F.lit(x), F.lit("/eodata/S2/A.SAFE/")))
    assert p("s3://eodata/S2/A.SAFE/x/y.jp2") == p("eodata/S2/A.SAFE/x/y.jp2") == p("S2/A.SAFE/x/y.jp2") == "x/y.jp2"
    assert p("o/DATASTRIP/z") == "DATASTRIP/z" and p("L2A_T/IMG_DATA/R20m/a.jp2") == "GRANULE/L2A_T/IMG_DATA/R20m/a.jp2"
    assert p("L1C_T/MTD_TL.xml") == "GRANULE/L1C_T/MTD_TL.xml" and p("a/b/c.xml") == "c.xml"


def test_dates_in_names(spark):
    d = lambda x: one(spark, T.acquisition_date(F.lit(x)))
    assert d("/a/T06WVB_20200616T213529_B03_20m.jp2") == dt.date(2020, 6, 16)
    assert d("/S2B_20210101T000000_X.SAFE/S2A_MSIL2A_20200616T213529_N0400_R.SAFE/G/b.jp2") == dt.date(2020, 6, 16)
    assert d("/none/b.jp2") is None
    assert [one(spark, T.dn_offset(F.lit(x))) for x in ("a_N0399_b", "a_N0400_b", "a")] == [0, 1000, 0]


def test_seasons(spark):
    s = lambda d, a, b: one(spark, D.in_season(F.lit(d).cast("date"), a, b))
    assert s("2020-06-01", (6, 1), (8, 31)) and s("2020-08-31", (6, 1), (8, 31)) and not s("2020-09-01", (6, 1), (8, 31))
    assert s("2020-12-24", (11, 1), (2, 28)) and s("2020-02-28", (11, 1), (2, 28)) and not s("2020-02-29", (11, 1), (2, 28))
    assert one(spark, D.clamped_date(F.lit(2023), F.lit(2), F.lit(29))) == dt.date(2023, 2, 28)
    assert D.season_windows([2024, 2023], (2, 1), (2, 29)) == [("2023-02-01T00:00:00.000", "2023-02-28T23:59:59.999"), ("2024-02-01T00:00:00.000", "2024-02-29T23:59:59.999")]
    with pytest.raises(ValueError):
        D.season_windows([2024], (8, 1), (6, 1))


def test_typed_dates():
    assert D.parse_years("2020, 2019 2020") == [2019, 2020]
    assert D.parse_years(" ") == []
    assert [D.parse_month_day(x) for x in ("06-01", "6/1", "06 01", "Jun-01", "Jun 1", "June-1", "June 1")] == [(6, 1)] * 7
    for bad in ("02-29", "13-01", "x"):
        with pytest.raises(ValueError):
            D.parse_month_day(bad)
    with pytest.raises(ValueError):
        D.parse_years("0")


@pytest.mark.parametrize("band, wanted, got", [("B02", 10, 10), ("B05", 10, 20), ("B08", 20, 10), ("SCL", 10, 20), ("B01", 20, 60), ("B04", 60, 60), ("B10", 20, None)])
def test_resolutions(spark, band, wanted, got):
    assert one(spark, N.resolve(N.resolutions(F.lit(band)), F.lit(wanted))) == got


def test_sizes(spark):
    assert one(spark, N.expected_size(F.lit(None).cast("long"), F.lit(0.5 / N.MB))) == 0  # a half goes to even
    assert one(spark, N.expected_size(F.lit(None).cast("long"), F.lit(1.5 / N.MB))) == 2
    assert one(spark, N.expected_size(F.lit(7), F.lit(9.0))) == 7
    assert one(spark, N.optional_long(F.lit(float("nan")))) is None
    assert one(spark, N.half_open_range(F.lit(0.0), F.lit(1.0), F.lit(0.4))) == [0.0, 0.4, 0.8]
    assert one(spark, N.half_open_range(F.lit(1.0), F.lit(1.0), F.lit(0.4))) == []


def test_vocabularies(spark):
    assert V.checked_bands(V.OPTICAL, ["b02", "B8a"]) == ["B02", "B8A"]
    assert V.checked_of(V.PRODUCTS, V.RADAR, "grd", "product") == "GRD"
    assert V.checked_of(V.PRODUCTS, V.RADAR, "", "product") == ""
    for call in (lambda: V.checked_bands(V.RADAR, ["B02"]), lambda: V.checked_of(V.SENSOR_MODES, V.OPTICAL, "IW", "mode"), lambda: V.checked_of(V.PRODUCTS, "X", "GRD", "product")):
        with pytest.raises(ValueError):
            call()
    with pytest.raises(Exception, match="invalid band"):
        one(spark, V.required(F.lit("B99"), V.BANDS[V.OPTICAL], "band"))


def test_pixels(spark):
    a = lambda *v: F.array(*map(F.lit, v))
    assert one(spark, P.subtract_offset(a(5, 1000, 65535, 65534), F.lit(1000))) == [0, 0, 65535, 64534]
    assert one(spark, P.mask_by_class(a(1, 2, 3, 4), a(0, 4, 12, 8), [8])) == [65535, 2, 65535, 65535]
    assert one(spark, P.mask_by_flag(a(1, 2), a(0, 1))) == [1, 65535]
    assert one(spark, P.coarsen_max(a(1, 2, 3, 4, 5, 6, 7, 8, 9), 3, 2)) == [5, 6, 8, 9]
    assert one(spark, P.nearest(a(1, 2, 3, 4), 2, 4)) == [1, 1, 2, 2, 1, 1, 2, 2, 3, 3, 4, 4, 3, 3, 4, 4]


BOX = "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 2 1, 2 2, 1 2, 1 1))"


def test_polygon_texts(spark):
    w = lambda x: one(spark, G.to_wkt(G.from_any(F.lit(x))))
    assert w(BOX) == BOX
    assert w('{"type":"Polygon","coordinates":[[[0,0],[4,0],[4,4],[0,0]]]}') == "POLYGON ((0 0, 4 0, 4 4, 0 0))"
    assert w('{"type":"MultiPolygon","coordinates":[[[[0,0],[4,0],[4,4],[0,0]]],[[[9,9],[10,9],[9,10.5],[9,9]]]]}') == "MULTIPOLYGON (((0 0, 4 0, 4 4, 0 0)), ((9 9, 10 9, 9 10.5, 9 9)))"
    assert w("  ") is None and w("POINT (1 2)") is None
    assert one(spark, G.to_wkt(G.without_holes(G.from_wkt(F.lit(BOX))))) == "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0))"


def test_predicates():
    inner, hole, far, touch = "POLYGON ((2.5 2.5, 3 2.5, 3 3, 2.5 2.5))", "POLYGON ((1.2 1.2, 1.8 1.2, 1.8 1.8, 1.2 1.2))", "POLYGON ((9 9, 10 9, 9 10, 9 9))", "POLYGON ((4 4, 5 4, 5 5, 4 4))"
    assert G.meet(BOX, inner) and not G.meet(BOX, hole) and not G.meet(BOX, far) and G.meet(BOX, touch)
    assert G.lies_in(inner, BOX) and not G.lies_in(hole, BOX) and not G.lies_in(touch, BOX) and G.lies_in(BOX, BOX)
    assert not G.lies_in("POLYGON ((0.5 0.5, 3.5 0.5, 3.5 3.5, 0.5 3.5, 0.5 0.5))", BOX)


def test_shorter_shapes():
    import math

    ring = ", ".join(f"{math.cos(t / 100 * math.tau):.6f} {math.sin(t / 100 * math.tau):.6f}" for t in [*range(100), 0])
    circle = f"POLYGON (({ring}))"
    assert G.fitting(circle, 10_000) == circle
    assert len(G.fitting(circle, 700)) <= 700 and len(G.rings_of(G.fitting(circle, 700))[0][0]) > 5
    assert len(G.rings_of(G.fitting(circle, 90))[0][0]) == 5
    assert G.hull([(0, 0), (2, 0), (1, 1), (2, 2), (0, 2), (1, 0)]) == [(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)]


def test_projections(spark):
    import math

    (a, f), phi = G.WGS84, math.radians(72.5)  # forwards, by the textbook formulas
    e = math.sqrt(f * (2 - f))
    t = lambda p: math.tan(math.pi / 4 - p / 2) / ((1 - e * math.sin(p)) / (1 + e * math.sin(p))) ** (e / 2)
    m = lambda p: math.cos(p) / math.sqrt(1 - (e * math.sin(p)) ** 2)
    rho = a * m(math.radians(70)) * t(phi) / t(math.radians(70))
    lon, lat = G.to_lonlat(F.lit(rho * math.sin(math.radians(15))), F.lit(-rho * math.cos(math.radians(15))), 3413)
    assert (one(spark, lon), one(spark, lat)) == (pytest.approx(-30, abs=1e-7), pytest.approx(72.5, abs=1e-7))
    lon, lat = G.to_lonlat(F.lit(0.0), F.lit(0.0), 3338)
    assert (one(spark, lon), one(spark, lat)) == (pytest.approx(-154), pytest.approx(50, abs=1e-6))
    assert G.to_lonlat(1, 2, 4326) == (1, 2)
    with pytest.raises(ValueError):
        G.to_lonlat(F.lit(0.0), F.lit(0.0), 32601)
