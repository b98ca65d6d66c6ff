"""Raster tiles as rows, their place on the ground, and views that work pixels out when they are read.

A tile has its pixels in row order, xsize columns and ysize rows of them, and the affine numbers of
its grid: xmin, ymax, xres and yres.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orbitframe.functions import pixels as P
from orbitframe.functions import text as T
from orbitframe.sources import sinks


def grid_info(tiles: DataFrame) -> DataFrame:
    """tiles with the bounds of each: xmin, ymin, xmax and ymax; resolutions count without their sign."""
    x, y = F.abs("xres"), F.abs("yres")
    return tiles.withColumns({"xres": x, "yres": y, "xmax": F.col("xmin") + x * F.col("xsize"), "ymin": F.col("ymax") - y * F.col("ysize")})


def view(tiles: DataFrame, name: str) -> str:
    """Register tiles as a view: nothing is stored, its plan runs whenever it is read."""
    tiles.createOrReplaceTempView(name)
    return name


def offset_view(tiles: DataFrame, name: str, path: str = "path", nodata: int = P.NODATA) -> str:
    """A view of tiles without the offset that their path's processing baseline tells; 0 leaves pixels as they are."""
    offset = T.dn_offset(F.col(path))
    return view(tiles.withColumns({"dn_offset": offset, "px": P.subtract_offset(F.col("px"), offset, nodata)}), name)


def masked_view(tiles: DataFrame, name: str, classes: list[int], side: int, class_side: int, nodata: int = P.NODATA) -> str:
    """A view of square tiles (px) without the pixels of masked classes (scl, a tile of another size perhaps).

    Coarser tiles lose a pixel where any finer class pixel under it is masked; finer ones take the nearest class.
    """
    if class_side > side:
        flags = P.coarsen_max(P.binary_mask(F.col("scl"), classes), class_side, class_side // side)
        return view(tiles.withColumn("px", P.mask_by_flag(F.col("px"), flags, nodata)), name)
    codes = F.col("scl") if class_side == side else P.nearest(F.col("scl"), class_side, side)
    return view(tiles.withColumn("px", P.mask_by_class(F.col("px"), codes, classes, nodata)), name)


def derived_view(tiles: DataFrame, name: str, function: Callable, inputs: list[str], output: str = "px", **arguments) -> str:
    """A view whose output column is function(*inputs, **arguments), a function that the user gives.

    A function of columns is taken as it is; one of NumPy arrays (marked by `function.arrays = True`)
    runs on Arrow batches, a tile at a time.
    """
    if not getattr(function, "arrays", False):
        return view(tiles.withColumn(output, function(*[F.col(c) for c in inputs], **arguments)), name)

    @F.pandas_udf("array<int>")
    def run(*columns: pd.Series) -> pd.Series:
        return pd.Series([None if any(v is None for v in row) else np.asarray(function(*map(np.asarray, row), **arguments)).astype("int32") for row in zip(*columns)])

    return view(tiles.withColumn(output, run(*[F.col(c) for c in inputs])), name)


def write_tiles(tiles: DataFrame, path: str) -> None:
    """Store tiles, computed ones too, as a table that is replaced at once."""
    sinks.replace_table(tiles, path)


def class_tile(files: DataFrame, wanted: Column) -> DataFrame:
    """For each scene (safedir) the class file of the resolution wanted, else of the next: 20, 10, 60."""
    rank = F.when(F.col("resolution_m") == wanted, 0).when(F.col("resolution_m") == 20, 1).when(F.col("resolution_m") == 10, 2).otherwise(3)
    return files.filter("band = 'SCL'").groupBy("safedir").agg(F.min(F.struct(rank.alias("rank"), "path"))["path"].alias("scl_path"))
