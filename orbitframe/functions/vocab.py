"""Controlled vocabularies and their checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What each collection allows.
OPTICAL, RADAR = "SENTINEL-2", "SENTINEL-1"
BANDS = {
    OPTICAL: ["B02", "B03", "B04", "B05", "B06", "B07", "B08", "B8A", "B09", "B10", "B11", "B12"],
    RADAR: ["VV", "VH", "HH", "HV"],
}
DEFAULT_BANDS = {
    OPTICAL: ["B02", "B03", "B04", "B05", "B06", "B07", "B08", "B8A", "B11", "B12"],
    RADAR: ["VV", "VH"],
}
PRODUCTS = {OPTICAL: ["S2MSI1C", "S2MSI2A"], RADAR: ["GRD"]}
SERIAL_IDS = {OPTICAL: ["A", "B", "C"], RADAR: ["A", "B", "C"]}
SENSOR_MODES = {OPTICAL: ["INS-NOBS", "INS-RAW", "INS-VIC"], RADAR: ["SM", "IW", "EW", "WV"]}
ORBIT_DIRECTIONS = ["ASCENDING", "DESCENDING"]
BEAM_MODES = ["IW", "EW", "WV", "S1", "S2", "S3", "S4", "S5", "S6"]
POLARIZATIONS = ["VV+VH", "HH+HV", "VV", "HH", "DUAL VV", "DUAL VH", "DUAL HH", "DUAL HV"]
DATA_LEVELS = ["GRD_HD", "GRD_HS", "GRD_MD", "GRD_MS", "GRD_FD", "SLC", "RAW", "OCN"]
LEVELS = [*DATA_LEVELS, "METADATA_GRD_HD", "METADATA_GRD_HS", "METADATA_GRD_MD", "METADATA_GRD_MS", "METADATA_SLC", "METADATA_RAW", "METADATA_OCN"]
IMAGE_BANDS = ["B01", "B02", "B03", "B04", "B05", "B06", "B07", "B08", "B8A", "B09", "B10", "B11", "B12", "SCL", "TCI", "AOT", "WVP"]


def checked(value: str, allowed: list[str], what: str) -> str:
    """value in upper case if it is allowed, or empty; else an error that lists what is."""
    if value and value.upper() not in allowed:
        raise ValueError(f"invalid {what}: {value.upper()}; valid: {sorted(allowed)}")
    return value.upper()


def checked_bands(collection: str, bands: list[str]) -> list[str]:
    """Bands in upper case; an error names all that the collection lacks, a collection without a list allows any."""
    if collection not in BANDS:
        return bands
    wrong = [b.upper() for b in bands if b.upper() not in BANDS[collection]]
    if wrong:
        raise ValueError(f"invalid bands for {collection}: {wrong}; valid: {sorted(BANDS[collection])}")
    return [b.upper() for b in bands]


def checked_of(table: dict[str, list[str]], collection: str, value: str, what: str) -> str:
    """checked() against a collection's list."""
    if value and collection not in table:
        raise ValueError(f"unsupported collection for a {what}: {collection}")
    return checked(value, table.get(collection, []), what)


def allowed(value: Column, values: list[str]) -> Column:
    """Whether a value, in upper case, is listed; blank ones are."""
    return (F.coalesce(value, F.lit("")) == "") | F.upper(value).isin(*values)


def required(value: Column, values: list[str], what: str) -> Column:
    """The value in upper case; the query fails on one that isn't listed."""
    return F.when(allowed(value, values), F.upper(value)).otherwise(F.raise_error(F.concat(F.lit(f"invalid {what}: "), value)))
