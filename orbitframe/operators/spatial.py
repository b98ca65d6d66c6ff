"""Regular grids and joins of boxes to their cells."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orbitframe.functions import geometry as G


def steps(a: float, b: float, d: float) -> int:
    return max(0, math.ceil((b - a) / d))


def grid(spark: SparkSession, box: tuple[float, float, float, float], dx: float, dy: float | None = None) -> DataFrame:
    """row, col, minx, miny, maxx and maxy of cells that cover a box, made on the executors."""
    dy = dx if dy is None else dy
    if dx <= 0 or dy <= 0:
        raise ValueError("a cell's size must be positive")
    minx, miny, maxx, maxy = map(float, box)
    rows, cols = steps(miny, maxy, dy), steps(minx, maxx, dx)
    if not rows * cols:
        raise ValueError("the area is empty")
    out = spark.range(rows * cols).select(F.floor(F.col("id") / cols).cast("int").alias("row"), (F.col("id") % cols).cast("int").alias("col"))
    out = out.withColumns({"minx": F.lit(minx) + F.col("col") * dx, "miny": F.lit(miny) + F.col("row") * dy})
    return out.withColumns({"maxx": F.col("minx") + dx, "maxy": F.col("miny") + dy})


def clipped(cells: DataFrame, areas: list[str], mode: str = "intersect") -> DataFrame:
    """The cells that meet (intersect) or lie in (within) the union of polygons given as WKT, or all.

    areas: the user's own area of interest, polygons handed over by the driver.  They are parsed and
    joined once; the tests are expressions, and only cells within the area's bounds get that far.
    """
    if mode == "all":
        return cells
    if mode not in ("intersect", "within"):
        raise ValueError(f"invalid clip mode: {mode}")
    area, box = G.Area(areas), {c: F.col(c) for c in ("minx", "miny", "maxx", "maxy")}
    return cells.filter(G.box_meets_area(box, area) if mode == "intersect" else G.box_in_area(box, area))


def area_grid(spark: SparkSession, areas: list[str], dx: float, dy: float | None = None, fill_holes: bool = True, mode: str = "all") -> DataFrame:
    """A grid over the joined and repaired areas, without their holes if wished, cut to them by `mode`."""
    dy = dx if dy is None else dy
    if not all(0.0001 <= d <= 180 for d in (dx, dy)):
        raise ValueError("a cell's size goes from 0.0001 to 180 degrees")
    polygons = G.Area(areas).polygons
    if fill_holes:
        polygons = [p[:1] for p in polygons]
    text = G.ring_text(polygons)
    xs, ys = ([c[k] for p in polygons for c in p[0]] for k in (0, 1))
    return clipped(grid(spark, (min(xs), min(ys), max(xs), max(ys)), dx, dy), [text], mode)


def cell_names(boxes: DataFrame, origin: tuple[float, float], dx: float, dy: float, size: tuple[int, int] | None = None) -> DataFrame:
    """boxes with __row and __col of each cell around them, one more on each side for rounding.

    size: the grid's rows and columns, beyond which there are no cells; rows come first and columns
    after, so a box over the whole grid never makes more than one list of its rows and one of columns.
    """

    def span(low: Column, high: Column, start: float, d: float, n: int | None) -> Column:
        a, b = F.floor((low - start) / d) - 1, F.floor((high - start) / d) + 1
        if n is not None:
            a, b = F.greatest(a, F.lit(0)), F.least(b, F.lit(n - 1))
        return F.explode(F.when(a <= b, F.sequence(a.cast("int"), b.cast("int"))))

    rows, cols = size or (None, None)
    named = boxes.withColumn("__row", span(F.col("b_miny"), F.col("b_maxy"), origin[1], dy, rows))
    return named.withColumn("__col", span(F.col("b_minx"), F.col("b_maxx"), origin[0], dx, cols))


def box_cells(boxes: DataFrame, cells: DataFrame, origin: tuple[float, float], dx: float, dy: float, size: tuple[int, int] | None = None, polygons: str | None = None) -> DataFrame:
    """Pairs of boxes and the grid cells that they meet, edges included.

    A box names the cells around it; an equi-join and an exact test follow, so no pair is compared
    that isn't near.  polygons: a column with the polygons that the boxes are the bounds of, which
    then decide.
    """
    if polygons:
        boxes = boxes.withColumn("__outline", G.outline_of(F.col(polygons)))  # once for a box, not for each of its cells
    named = cell_names(boxes, origin, dx, dy, size)
    a = {c: F.col("b_" + c) for c in ("minx", "miny", "maxx", "maxy")}
    b = {c: F.col(c) for c in ("minx", "miny", "maxx", "maxy")}
    met = G.boxes_meet(a, b)
    if polygons:
        met = met & G.box_meets_polygons(b, F.col("__outline"), a)  # in the join, where the boxes' test comes first
    return named.join(cells, (F.col("__row") == F.col("row")) & (F.col("__col") == F.col("col")) & met).drop("__row", "__col", "__outline")


def coverage(boxes: DataFrame, cells: DataFrame, origin: tuple[float, float], dx: float, dy: float, size: tuple[int, int] | None = None, polygons: str | None = None) -> DataFrame:
    """The cells, each with the number n of boxes (or of their polygons) that meet it."""
    n = box_cells(boxes, cells, origin, dx, dy, size, polygons).groupBy("row", "col").agg(F.count("*").alias("n"))
    return cells.join(n, ["row", "col"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def uncovered_share(covered: DataFrame) -> DataFrame:
    return covered.agg(F.count_if(F.col("n") == 0).alias("uncovered"), F.count("*").alias("cells"), (100.0 * F.count_if(F.col("n") == 0) / F.count("*")).alias("percent"))


def batches_by_length(wkts: list[str], most: int) -> list[list[str]]:
    """Texts in order, in batches whose union's text stays within `most` characters; a longer one is alone."""
    out, now, joined = [], [], None
    for w in wkts:
        both = G.union([joined, w] if now else [w])
        if now and len(both or "") > most:
            out.append(now)
            now, both = [], G.union([w])
        now, joined = [*now, w], both
        if len(joined or "") > most:
            out.append(now)
            now = []
    return out + [now] * bool(now)


def joint(wkts: list[str]) -> str | None:
    """Polygons as one text of their union."""
    return G.union(wkts)
