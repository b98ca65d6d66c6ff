"""Polygons as nested arrays (polygons, rings, points with x and y), and WKT and GeoJSON texts.

Parsing, writing, bounds, hole removal and tests against a user's area are column expressions.
Hulls, simplification, unions and repairs have no built-in form; they run in Arrow batches.
"""

from __future__ import annotations

import json
import math
import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType

from orbitframe.functions import overlay

POLYGONS = "array<array<array<struct<x:double,y:double>>>>"
_COORDINATES = "array<array<array<array<double>>>>"


def _points(polygons: Column) -> Column:
    """Polygons from coordinates nested four deep."""
    return F.transform(polygons, lambda p: F.transform(p, lambda r: F.transform(r, lambda c: F.struct(F.get(c, F.lit(0)).alias("x"), F.get(c, F.lit(1)).alias("y")))))


def from_wkt(wkt: Column) -> Column:
    """Polygons of a POLYGON or MULTIPOLYGON text; null for anything else."""
    body = F.regexp_extract(wkt, r"(?is)^\s*(?:MULTI)?POLYGON\s*Z?\s*(\(.*\))\s*$", 1)
    pairs = F.regexp_replace(body, r"(-?[0-9.]+(?:[eE][-+]?[0-9]+)?)\s+(-?[0-9.]+(?:[eE][-+]?[0-9]+)?)(?:\s+-?[0-9.eE+-]+)?", "[$1,$2]")
    nested = F.translate(pairs, "()", "[]")
    nested = F.when(F.upper(wkt).contains("MULTIPOLYGON"), nested).otherwise(F.concat(F.lit("["), nested, F.lit("]")))
    return F.when(body != "", _points(F.from_json(nested, _COORDINATES)))


def from_geojson(text: Column) -> Column:
    """Polygons of a GeoJSON geometry, its coordinates three or four deep."""
    kind, body = F.get_json_object(text, "$.type"), F.get_json_object(text, "$.coordinates")
    deep = F.regexp_like(body, F.lit(r"^\s*\[\s*\[\s*\[\s*\["))
    body = F.when(deep, body).when(body.isNotNull(), F.concat(F.lit("["), body, F.lit("]")))
    return F.when(kind.isin("Polygon", "MultiPolygon"), _points(F.from_json(body, _COORDINATES)))


def is_missing(text: Column) -> Column:
    """Whether a footprint's text is null or blank."""
    return F.coalesce(F.trim(text) == "", F.lit(True))


def from_any(text: Column) -> Column:
    """Polygons of GeoJSON or WKT text; null for a missing or unreadable one."""
    return F.when(~is_missing(text), F.when(F.startswith(F.trim(text), F.lit("{")), from_geojson(text)).otherwise(from_wkt(text)))


def number(x: Column) -> Column:
    """A coordinate as text, without a fraction of zeros."""
    return F.regexp_replace(F.format_string("%.10f", x), r"\.?0+$", "")


def to_wkt(polygons: Column) -> Column:
    """POLYGON or MULTIPOLYGON text."""
    ring = lambda r: F.concat(F.lit("("), F.array_join(F.transform(r, lambda c: F.concat(number(c["x"]), F.lit(" "), number(c["y"]))), ", "), F.lit(")"))
    each = F.transform(polygons, lambda p: F.concat(F.lit("("), F.array_join(F.transform(p, ring), ", "), F.lit(")")))
    return F.when(F.size(polygons) == 1, F.concat(F.lit("POLYGON "), F.get(each, F.lit(0)))).otherwise(F.concat(F.lit("MULTIPOLYGON ("), F.array_join(each, ", "), F.lit(")")))


def bounds(polygons: Column) -> Column:
    """A struct of minx, miny, maxx and maxy."""
    points = F.flatten(F.flatten(polygons))
    x, y = F.transform(points, lambda c: c["x"]), F.transform(points, lambda c: c["y"])
    return F.struct(F.array_min(x).alias("minx"), F.array_min(y).alias("miny"), F.array_max(x).alias("maxx"), F.array_max(y).alias("maxy"))


def without_holes(polygons: Column) -> Column:
    """Only the outer ring of each polygon."""
    return F.transform(polygons, lambda p: F.slice(p, 1, 1))


def closed(polygons: Column) -> Column:
    """Rings that end where they begin."""
    return F.transform(polygons, lambda p: F.transform(p, lambda r: F.when(F.element_at(r, 1) == F.element_at(r, -1), r).otherwise(F.concat(r, F.slice(r, 1, 1)))))


def box_wkt(minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    """A box as WKT, counter-clockwise from the lower right corner."""
    a, b, c, d = (number(v) for v in (minx, miny, maxx, maxy))
    corner = lambda x, y: F.concat(x, F.lit(" "), y)
    return F.concat(F.lit("POLYGON (("), F.concat_ws(", ", corner(c, b), corner(c, d), corner(a, d), corner(a, b), corner(c, b)), F.lit("))"))


def point_wkt(x: Column, y: Column) -> Column:
    return F.concat(F.lit("POINT ("), number(x), F.lit(" "), number(y), F.lit(")"))


def parse_bbox(text: Column) -> Column:
    """minx, miny, maxx and maxy of four ordered numbers with commas or spaces; null for anything else."""
    parts = F.transform(F.filter(F.split(F.trim(F.replace(text, F.lit(","), F.lit(" "))), r"\s+"), lambda p: p != ""), lambda p: p.try_cast("double"))
    v = [F.get(parts, F.lit(k)) for k in range(4)]
    right = (F.size(parts) == 4) & (v[0] < v[2]) & (v[1] < v[3])
    return F.when(right, F.struct(*[c.alias(n) for c, n in zip(v, ("minx", "miny", "maxx", "maxy"))]))


def boxes_meet(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """Whether two boxes share a point, edges included."""
    return (a["minx"] <= b["maxx"]) & (a["maxx"] >= b["minx"]) & (a["miny"] <= b["maxy"]) & (a["maxy"] >= b["miny"])


def box_within(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """Whether box a lies in box b."""
    return (a["minx"] >= b["minx"]) & (a["maxx"] <= b["maxx"]) & (a["miny"] >= b["miny"]) & (a["maxy"] <= b["maxy"])


# --- exact predicates and shapes, on parsed texts -------------------------------------------------


def rings_of(wkt: str) -> list[list[list[tuple[float, float]]]]:
    """Polygons of a WKT text."""
    text = wkt.strip()
    body = text[text.index("(") :]
    if not text.upper().startswith("MULTI"):
        body = f"({body})"
    polygons, depth, ring = [], 0, ""
    for c in body:
        if c == "(":
            depth += 1
            if depth == 2:
                polygons.append([])
            ring = ""
        elif c == ")":
            if depth == 3:
                polygons[-1].append([tuple(float(v) for v in p.split()[:2]) for p in ring.split(",")])
            depth -= 1
        else:
            ring += c
    return polygons


def ring_text(polygons) -> str:
    show = lambda v: re.sub(r"\.?0+$", "", f"{v:.10f}")
    each = ["(" + ", ".join("(" + ", ".join(f"{show(x)} {show(y)}" for x, y in r) + ")" for r in p) + ")" for p in polygons]
    return f"POLYGON {each[0]}" if len(each) == 1 else "MULTIPOLYGON (" + ", ".join(each) + ")"


def hull(points: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """The convex hull as a closed ring, counter-clockwise (monotone chain)."""
    pts = sorted(set(points))
    if len(pts) < 3:
        return [*pts, pts[0]]

    def half(seq):
        out: list[tuple[float, float]] = []
        for p in seq:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(p)
        return out[:-1]

    ring = half(pts) + half(reversed(pts))
    return [*ring, ring[0]]


def thinned(ring: list[tuple[float, float]], tolerance: float) -> list[tuple[float, float]]:
    """A closed ring with the points left out that lie within the tolerance of its course (Douglas-Peucker)."""
    if len(ring) <= 4:
        return ring
    far = max(range(len(ring) - 1), key=lambda i: math.dist(ring[0], ring[i]))
    keep, todo = {0, far, len(ring) - 1}, [(0, far), (far, len(ring) - 1)]
    while todo:
        a, b = todo.pop()
        (ax, ay), (bx, by) = ring[a], ring[b]
        length = math.hypot(bx - ax, by - ay)

        def off(i):
            x, y = ring[i]
            return abs((bx - ax) * (ay - y) - (ax - x) * (by - ay)) / length if length else math.dist(ring[i], ring[a])

        if b - a > 1:
            worst = max(range(a + 1, b), key=off)
            if off(worst) > tolerance:
                keep.add(worst)
                todo += [(a, worst), (worst, b)]
    out = [ring[i] for i in sorted(keep)]
    return out if len(out) >= 4 else ring


def inside(p: tuple[float, float], polygon) -> int:
    """1 within a polygon, 0 on its edge, -1 outside."""
    odd = False
    for ring in polygon:
        for (ax, ay), (bx, by) in zip(ring, ring[1:]):
            turn = (bx - ax) * (p[1] - ay) - (by - ay) * (p[0] - ax)
            if turn == 0 and min(ax, bx) <= p[0] <= max(ax, bx) and min(ay, by) <= p[1] <= max(ay, by):
                return 0
            if (ay > p[1]) != (by > p[1]) and p[0] < (bx - ax) * (p[1] - ay) / (by - ay) + ax:
                odd = not odd
    return 1 if odd else -1


def _side(a, b, c) -> int:
    v = (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])
    return (v > 0) - (v < 0)


def _cross(a, b, c, d, proper: bool = False) -> bool:
    """Whether segments ab and cd meet; proper: in inner points only, at an angle."""
    s = _side(a, b, c), _side(a, b, d), _side(c, d, a), _side(c, d, b)
    if s[0] * s[1] < 0 and s[2] * s[3] < 0:
        return True
    if proper:
        return False
    on = lambda p, q, r: min(p[0], q[0]) <= r[0] <= max(p[0], q[0]) and min(p[1], q[1]) <= r[1] <= max(p[1], q[1])
    return any(t == 0 and on(*x) for t, x in zip(s, ((a, b, c), (a, b, d), (c, d, a), (c, d, b))))


def _edges(polygon):
    return [(a, b) for ring in polygon for a, b in zip(ring, ring[1:])]


def meet(one: str, two: str) -> bool:
    """Whether two polygon texts share a point."""
    for p in _parsed(one):
        for q in _parsed(two):
            if inside(p[0][0], q) >= 0 or inside(q[0][0], p) >= 0 or any(_cross(*e, *f) for e in _edges(p) for f in _edges(q)):
                return True
    return False


def lies_in(one: str, two: str) -> bool:
    """Whether polygon one lies in one of the polygons of two, whose parts that abut must have been joined."""

    def covered(p, q):
        middles = [((a[0] + b[0]) / 2, (a[1] + b[1]) / 2) for a, b in _edges(p)]
        if any(inside(v, q) < 0 for v in [*p[0], *middles]) or any(_cross(*e, *f, proper=True) for e in _edges(p) for f in _edges(q)):
            return False
        return all(inside(v, p) <= 0 for hole in q[1:] for v in hole)

    return all(any(covered(p, q) for q in _parsed(two)) for p in _parsed(one))


@lru_cache(maxsize=256)
def _parsed(wkt: str):
    return rings_of(wkt)


@F.pandas_udf(BooleanType())
def polygon_within(one: pd.Series, two: pd.Series) -> pd.Series:
    return pd.Series([None if a is None or b is None else lies_in(a, b) for a, b in zip(one, two)], dtype="object")


@F.pandas_udf(StringType())
def convex_hull(wkt: pd.Series) -> pd.Series:
    return pd.Series([None if w is None else ring_text([[hull([p for poly in rings_of(w) for r in poly for p in r])]]) for w in wkt], dtype="object")


@F.pandas_udf(StringType())
def repaired(wkt: pd.Series) -> pd.Series:
    """Valid polygons of what a text's polygons show, null if that has no area."""
    return pd.Series([None if w is None else union([w]) for w in wkt], dtype="object")


def union(wkts: list[str]) -> str | None:
    """Polygon texts joined to valid polygons that don't overlap; null if they have no area."""
    found = overlay.outline([p for w in wkts for p in rings_of(w)])
    return ring_text(found) if found else None


def dissolve(df: DataFrame, keys: list[str], wkt: str, salts: int = 32) -> DataFrame:
    """keys and the union of each key's polygons; a key's rows are joined in `salts` parts first."""
    import pyarrow as pa

    kinds = {f.name: f for f in df.schema.fields}
    schema = ", ".join(f"`{k}` {kinds[k].dataType.simpleString()}" for k in keys)

    def join(table: pa.Table) -> pa.Table:
        found = union([w for w in table.column("__wkt").to_pylist() if w is not None])
        return table.slice(0, 1).select(keys).append_column("__wkt", pa.array([found], pa.string()))

    rows = df.select(*keys, F.pmod(F.xxhash64(wkt), F.lit(salts)).alias("__salt"), F.col(wkt).alias("__wkt"))
    some = rows.groupBy(*keys, "__salt").applyInArrow(join, f"{schema}, __wkt string")
    return some.groupBy(*keys).applyInArrow(join, f"{schema}, __wkt string").withColumnRenamed("__wkt", wkt)


# --- exact tests as expressions -------------------------------------------------------------------

EDGE = "array<struct<ax:double,ay:double,bx:double,by:double>>"


class Area:
    """A user's area, one text or more joined to one: its edges and a corner of each part as constants."""

    def __init__(self, wkts: list[str]):
        self.polygons = overlay.outline([p for w in wkts for p in rings_of(w)])
        if not self.polygons:
            raise ValueError("the area is empty")
        edges = [dict(zip(("ax", "ay", "bx", "by"), (*a, *b))) for p in self.polygons for a, b in _edges(p)]
        self.edges = F.from_json(F.lit(json.dumps(edges)), EDGE)
        self.corners = F.from_json(F.lit(json.dumps([{"x": p[0][0][0], "y": p[0][0][1]} for p in self.polygons])), "array<struct<x:double,y:double>>")
        xs, ys = ([c[k] for p in self.polygons for c in p[0]] for k in (0, 1))
        self.bounds = (min(xs), min(ys), max(xs), max(ys))

    def near(self, box: dict[str, Column]) -> Column:
        return boxes_meet(box, dict(zip(("minx", "miny", "maxx", "maxy"), map(F.lit, self.bounds))))


def edges_of(polygons: Column) -> Column:
    """All edges of polygons, as structs of ax, ay, bx and by."""
    pair = lambda a, b: F.struct(a["x"].alias("ax"), a["y"].alias("ay"), b["x"].alias("bx"), b["y"].alias("by"))
    ring = lambda r: F.zip_with(F.slice(r, F.lit(1), F.size(r) - 1), F.slice(r, F.lit(2), F.size(r) - 1), pair)
    return F.flatten(F.transform(polygons, lambda p: F.flatten(F.transform(p, ring))))


def box_edges(box: dict[str, Column]) -> Column:
    a, b, c, d = (box[k] for k in ("minx", "miny", "maxx", "maxy"))
    sides = ((a, b, c, b), (c, b, c, d), (c, d, a, d), (a, d, a, b))
    return F.array(*[F.struct(*[v.alias(n) for v, n in zip(s, ("ax", "ay", "bx", "by"))]) for s in sides])


def point_in(x: Column, y: Column, edges: Column) -> Column:
    """Whether a point lies within rings, by the even-odd rule; a point on an edge may count or not."""
    crossed = lambda e: ((e["ay"] > y) != (e["by"] > y)) & (x < (e["bx"] - e["ax"]) * (y - e["ay"]) / F.nullif(e["by"] - e["ay"], F.lit(0.0)) + e["ax"])
    return F.size(F.filter(edges, lambda e: F.coalesce(crossed(e), F.lit(False)))) % 2 == 1


def _turn(e: Column, x: Column, y: Column) -> Column:
    return (e["bx"] - e["ax"]) * (y - e["ay"]) - (e["by"] - e["ay"]) * (x - e["ax"])


def edges_meet(e: Column, f: Column) -> Column:
    """Whether two edges share a point, ends included."""
    apart = F.lit(False)
    for k in ("x", "y"):
        apart = apart | (F.greatest(e["a" + k], e["b" + k]) < F.least(f["a" + k], f["b" + k])) | (F.greatest(f["a" + k], f["b" + k]) < F.least(e["a" + k], e["b" + k]))
    across = lambda p, q: F.signum(_turn(p, q["ax"], q["ay"])) * F.signum(_turn(p, q["bx"], q["by"])) <= 0
    return ~apart & across(e, f) & across(f, e)


def meets_area(edges: Column, corners: Column, area: Area) -> Column:
    """Whether polygons, given by their edges and a corner of each part, share a point with the area."""
    touching = F.exists(edges, lambda e: F.exists(area.edges, lambda f: edges_meet(e, f)))
    return touching | F.exists(corners, lambda c: point_in(c["x"], c["y"], area.edges)) | F.exists(area.corners, lambda c: point_in(c["x"], c["y"], edges))


def polygons_meet_area(polygons: Column, area: Area) -> Column:
    b = bounds(polygons)
    near = area.near({k: b[k] for k in ("minx", "miny", "maxx", "maxy")})
    corners = F.transform(polygons, lambda p: F.get(F.get(p, F.lit(0)), F.lit(0)))
    return F.coalesce(F.when(near, meets_area(edges_of(polygons), corners, area)), F.lit(False))


def box_meets_area(box: dict[str, Column], area: Area) -> Column:
    corner = F.array(F.struct(box["minx"].alias("x"), box["miny"].alias("y")))
    return F.coalesce(F.when(area.near(box), meets_area(box_edges(box), corner, area)), F.lit(False))


def box_in_area(box: dict[str, Column], area: Area) -> Column:
    """Whether a box lies in the area, edges included: its inside meets no edge, and its middle lies in the area."""
    a, b, c, d = (box[k] for k in ("minx", "miny", "maxx", "maxy"))

    def enters(e):
        over = (F.least(e["ax"], e["bx"]) < c) & (F.greatest(e["ax"], e["bx"]) > a) & (F.least(e["ay"], e["by"]) < d) & (F.greatest(e["ay"], e["by"]) > b)
        turns = [_turn(e, x, y) for x in (a, c) for y in (b, d)]
        return over & (F.least(*turns) < 0) & (F.greatest(*turns) > 0)

    held = ~F.exists(area.edges, enters) & point_in((a + c) / 2, (b + d) / 2, area.edges)
    return F.coalesce(F.when(area.near(box), held), F.lit(False))


def outline_of(polygons: Column) -> Column:
    """The edges of polygons, and outer rings of one point as edges from it to itself."""
    lone = F.filter(F.transform(polygons, lambda p: F.get(p, F.lit(0))), lambda r: F.size(r) == 1)
    return F.concat(edges_of(polygons), edges_of(F.transform(lone, lambda r: F.array(F.concat(r, r)))))


def edge_meets_box(e: Column, box: dict[str, Column]) -> Column:
    """Whether an edge shares a point with a box or its inside: their bounds meet, and the box isn't all on one side of the edge."""
    over = F.lit(True)
    for k in ("x", "y"):
        over = over & (F.least(e["a" + k], e["b" + k]) <= box["max" + k]) & (F.greatest(e["a" + k], e["b" + k]) >= box["min" + k])
    # a corner's turn is one of `up` less one of `across`: the least is at most 0, the greatest at least 0
    up = [(e["bx"] - e["ax"]) * (box[k] - e["ay"]) for k in ("miny", "maxy")]
    across = [(e["by"] - e["ay"]) * (box[k] - e["ax"]) for k in ("minx", "maxx")]
    return over & (F.least(*up) <= F.greatest(*across)) & (F.greatest(*up) >= F.least(*across))


def box_meets_polygons(box: dict[str, Column], outline: Column, bounds: dict[str, Column]) -> Column:
    """Whether a box shares a point with polygons that are columns too, given by their outline_of and bounds."""
    within = box_within(box, bounds) & point_in(box["minx"], box["miny"], outline)  # no edge meets the box
    return F.exists(outline, lambda e: edge_meets_box(e, box)) | within


# Tolerances in degrees, in the order in which they are tried.
TOLERANCES = (0.001, 0.0025, 0.005, 0.01, 0.02, 0.05)


def simpler(polygon, tolerance: float):
    """A polygon thinned by the tolerance, or by halves of it until no edges cross; in the end itself."""
    for _ in range(6):
        out = [thinned(r, tolerance) for r in polygon]
        if out == polygon or overlay.valid(out):
            return out
        tolerance /= 2
    return polygon


def fitting(wkt: str, most: int, tolerances: tuple[float, ...] = TOLERANCES) -> str:
    """The text itself if short enough, else its first fitting simplification, its hull, or its box."""
    if len(wkt) <= most:
        return wkt
    polygons = rings_of(wkt)
    for t in tolerances:
        text = ring_text([simpler(p, t) for p in polygons])
        if len(text) <= most:
            return text
    points = [c for p in polygons for r in p for c in r]
    text = ring_text([[hull(points)]])
    if len(text) <= most:
        return text
    xs, ys = [c[0] for c in points], [c[1] for c in points]
    return ring_text([[[(max(xs), min(ys)), (max(xs), max(ys)), (min(xs), max(ys)), (min(xs), min(ys)), (max(xs), min(ys))]]])


def simplified(wkt: Column, most: int = 20_000) -> Column:
    @F.pandas_udf(StringType())
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([None if w is None else fitting(w, most) for w in texts], dtype="object")

    return run(wkt)


# --- projected coordinates ------------------------------------------------------------------------

# The ellipsoids of EPSG:3413 (WGS 84) and EPSG:3338 (GRS 80).
WGS84 = (6378137.0, 1 / 298.257223563)
GRS80 = (6378137.0, 1 / 298.257222101)


def polar_to_lonlat(x: Column, y: Column) -> tuple[Column, Column]:
    """Longitude and latitude of EPSG:3413 (polar stereographic, true at 70 north, 45 west upwards)."""
    a, f = WGS84
    e2 = f * (2 - f)
    e = math.sqrt(e2)
    phi = math.radians(70)
    t = math.tan(math.pi / 4 - phi / 2) / ((1 - e * math.sin(phi)) / (1 + e * math.sin(phi))) ** (e / 2)
    m = math.cos(phi) / math.sqrt(1 - e2 * math.sin(phi) ** 2)
    chi = math.pi / 2 - 2 * F.atan(F.sqrt(x * x + y * y) * (t / (a * m)))
    lat = chi + (e2 / 2 + 5 * e2**2 / 24 + e2**3 / 12 + 13 * e2**4 / 360) * F.sin(2 * chi) + (7 * e2**2 / 48 + 29 * e2**3 / 240 + 811 * e2**4 / 11520) * F.sin(4 * chi) + (7 * e2**3 / 120 + 81 * e2**4 / 1120) * F.sin(6 * chi)
    lon = F.degrees(F.atan2(x, -y)) - 45
    return F.when(lon < -180, lon + 360).otherwise(lon), F.degrees(lat)


def albers_to_lonlat(x: Column, y: Column) -> tuple[Column, Column]:
    """Longitude and latitude of EPSG:3338 (Albers, parallels 55 and 65, origin 50 north 154 west)."""
    a, f = GRS80
    e2 = f * (2 - f)
    e = math.sqrt(e2)

    def q(phi):
        s = math.sin(phi)
        return (1 - e2) * (s / (1 - e2 * s * s) - math.log((1 - e * s) / (1 + e * s)) / (2 * e))

    def m(phi):
        return math.cos(phi) / math.sqrt(1 - e2 * math.sin(phi) ** 2)

    p1, p2, p0 = (math.radians(v) for v in (55, 65, 50))
    n = (m(p1) ** 2 - m(p2) ** 2) / (q(p2) - q(p1))
    c = m(p1) ** 2 + n * q(p1)
    rho0 = a * math.sqrt(c - n * q(p0)) / n
    rho2 = (x * x + (rho0 - y) * (rho0 - y)) / (a * a)
    beta = F.asin((c - rho2 * (n * n)) / n / q(math.pi / 2))
    lat = beta + (e2 / 3 + 31 * e2**2 / 180 + 517 * e2**3 / 5040) * F.sin(2 * beta) + (23 * e2**2 / 360 + 251 * e2**3 / 3780) * F.sin(4 * beta) + (761 * e2**3 / 45360) * F.sin(6 * beta)
    lon = F.degrees(F.atan2(x, rho0 - y) / n) - 154
    return F.when(lon < -180, lon + 360).otherwise(lon), F.degrees(lat)


def to_lonlat(x: Column, y: Column, srid: int) -> tuple[Column, Column]:
    """Longitude and latitude from a known projection; an error for any other."""
    if srid == 4326:
        return x, y
    if srid == 3413:
        return polar_to_lonlat(x, y)
    if srid == 3338:
        return albers_to_lonlat(x, y)
    raise ValueError(f"no formula for EPSG:{srid}")
