"""Sizes, ranges and resolutions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The bands of the optical product and the resolutions in metres that each has.
BAND_RESOLUTIONS = {
    "B01": [60],
    "B02": [10, 20, 60],
    "B03": [10, 20, 60],
    "B04": [10, 20, 60],
    "B05": [20, 60],
    "B06": [20, 60],
    "B07": [20, 60],
    "B08": [10],
    "B8A": [20, 60],
    "B09": [60],
    "B11": [20, 60],
    "B12": [20, 60],
    "SCL": [20, 60],
    "TCI": [10, 20, 60],
    "AOT": [10, 20, 60],
    "WVP": [10, 20, 60],
}
MB = 1024 * 1024


def size_mb(size: Column, given: Column) -> Column:
    """Megabytes from exact bytes, else as given."""
    return F.coalesce(size / F.lit(float(MB)), given)


def expected_size(size: Column, mb: Column) -> Column:
    """Exact bytes, else from megabytes with halves to even."""
    return F.coalesce(size.cast("long"), F.bround(F.when(~F.isnan(mb), mb) * MB).cast("long"))


def optional_long(value: Column) -> Column:
    """A whole number, truncated; null for null and NaN."""
    return F.when(~F.isnan(value.cast("double")), value.cast("double")).cast("long")


def first_truthy(value: Column, other: Column) -> Column:
    """value unless it is null or 0, else other."""
    return F.coalesce(F.nullif(value, F.lit(0)), other)


def half_open_range(begin: Column, stop: Column, step: Column) -> Column:
    """begin, begin + step, ... below stop; none if stop is not above begin."""
    n = F.ceil((stop - begin) / step).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: begin + i * step)).otherwise(F.array().cast("array<double>"))


def resolutions(band: Column) -> Column:
    """The resolutions of a band, null if it is unknown."""
    out = F.lit(None).cast("array<int>")
    for name, values in BAND_RESOLUTIONS.items():
        out = F.when(band == name, F.array(*map(F.lit, values))).otherwise(out)
    return out


def resolve(available: Column, wanted: Column) -> Column:
    """The wanted resolution if available, else the closest finer one, else the closest coarser one."""
    finer = F.array_max(F.filter(available, lambda r: r < wanted))
    coarser = F.array_min(F.filter(available, lambda r: r > wanted))
    return F.when(F.array_contains(available, wanted), wanted).otherwise(F.coalesce(finer, coarser))


def backoff(attempt: Column, base: float = 1.0) -> Column:
    """Seconds to wait before attempt 1, 2, ...: base, 2 * base, 4 * base, ..."""
    return base * F.pow(F.lit(2.0), attempt - 1)
