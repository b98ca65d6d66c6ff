"""Pixel functions over arrays of a tile's values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orbitframe.functions.columns import once

NODATA = 65535
TOP = 65534


def subtract_offset(pixels: Column, offset: Column, nodata: int = NODATA) -> Column:
    """Pixels less the offset, held in 0..65534; nodata stays."""
    return F.transform(pixels, lambda v: F.when(v == nodata, v).otherwise(F.when(offset == 0, v).otherwise(F.least(F.greatest(v - offset, F.lit(0)), F.lit(TOP)))))


def is_masked(code: Column, classes: list[int]) -> Column:
    """Whether a scene class is masked: 0, beyond 11, or listed."""
    return (code == 0) | (code > 11) | (code.isin(*classes) if classes else F.lit(False))


def mask_by_class(pixels: Column, codes: Column, classes: list[int], nodata: int = NODATA) -> Column:
    return F.zip_with(pixels, codes, lambda v, c: F.when(is_masked(c, classes), nodata).otherwise(v))


def mask_by_flag(pixels: Column, flags: Column, nodata: int = NODATA) -> Column:
    return F.zip_with(pixels, flags, lambda v, m: F.when(m != 0, nodata).otherwise(v))


def binary_mask(codes: Column, classes: list[int]) -> Column:
    """1 for a masked class and 0 for others."""
    return F.transform(codes, lambda c: is_masked(c, classes).cast("int"))


def blocks(pixels: Column, side: int, factor: int, combine) -> Column:
    """A square tile made coarser: combine(array of a block's values) for each block, in row order."""
    n = -(-side // factor)

    def one(i, pixels):
        top, left = F.floor(i / n) * factor, (i % n) * factor
        cells = F.sequence(F.lit(0), F.lit(factor * factor - 1))
        inside = F.filter(cells, lambda k: (top + F.floor(k / factor) < side) & (left + k % factor < side))
        return combine(F.transform(inside, lambda k: F.get(pixels, ((top + F.floor(k / factor)) * side + left + k % factor).cast("int"))))

    return once(pixels, lambda p: F.transform(F.sequence(F.lit(0), F.lit(n * n - 1)), lambda i: one(i, p)))


def coarsen_max(pixels: Column, side: int, factor: int) -> Column:
    return blocks(pixels, side, factor, F.array_max)


def coarsen_mean(pixels: Column, side: int, factor: int) -> Column:
    return blocks(pixels, side, factor, lambda a: F.aggregate(a, F.lit(0.0), lambda x, y: x + y) / F.size(a))


def nearest(pixels: Column, side: int, new_side: int) -> Column:
    """A square tile at another size, each new pixel taken from the old one at its place."""
    place = lambda i: (F.floor(F.floor(i / new_side) * side / new_side) * side + F.floor((i % new_side) * side / new_side)).cast("int")
    return once(pixels, lambda p: F.transform(F.sequence(F.lit(0), F.lit(new_side * new_side - 1)), lambda i: F.get(p, place(i))))
