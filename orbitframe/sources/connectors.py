"""The two services' searches, over a catalogue table that stands in for the live service.

Each gives the rows of its declared manifest.  Conditions become one filter of the scan: ranges of
time, equal attributes and limits are pushed, footprints are tested only where bounds meet.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orbitframe.functions import geometry as G
from orbitframe.functions import numbers as N
from orbitframe.functions import vocab as V
from orbitframe.operators import relational as R
from orbitframe.operators import spatial as SP
from orbitframe.sources import schemas

#: Characters of a batch of areas that a service takes.
AREA_CHARS = 6000
# Columns that a request for single bursts asks for in place of product attributes.
BURST = {
    "burst_id": "BurstId", "absolute_burst_id": "AbsoluteBurstId", "swath": "SwathIdentifier", "parent_name": "ParentProductName", "parent_type": "ParentProductType",
    "parent_id": "ParentProductId", "datatake": "DatatakeId", "rel_orbit": "RelativeOrbitNumber", "mode": "OperationalMode", "polarisations": "PolarisationChannels", "platform": "PlatformSerialIdentifier",
}
ATTRIBUTES = {"rel_orbit": "relativeOrbitNumber", "mode": "operationalMode", "platform": "platformSerialIdentifier"}


def area_batches(wkts: list[str], most: int = AREA_CHARS) -> list[str]:
    """Areas joined to texts of at most `most` characters each (a longer one is alone)."""
    return [t for t in map(SP.joint, SP.batches_by_length(wkts, most)) if t]


def inside_any(ts: Column, windows: list[tuple[str, str]]) -> Column:
    out = F.lit(False)
    for a, b in windows:
        out = out | ts.between(F.lit(a), F.lit(b))
    return out


def optical(catalogue: DataFrame, windows: list[tuple[str, str]], areas: list[str], *, product: str | None = None, orbit: str | None = None, cloud_below: float | None = None, attributes: dict[str, object] | None = None, burst: bool = False, collection: str | None = None, **more) -> DataFrame:
    """The optical service's scenes (SCENES without query_id), each Id once.

    windows: inclusive ISO instants, as ContentDate holds them.  more: keys of BURST.  The relative
    orbit, mode and platform are attributes in a catalogue of products, and columns of their own in
    one of bursts.
    """
    unknown = set(more) - set(BURST)
    if unknown:
        raise ValueError(f"unknown conditions: {sorted(unknown)}")
    equal = {"Collection": collection, "productType": product, "orbitDirection": orbit, **(attributes or {})}
    if burst:
        equal |= {BURST[k]: v for k, v in more.items()}
    else:
        equal |= {ATTRIBUTES[k]: v for k, v in more.items() if k in ATTRIBUTES}
        lost = {k for k, v in more.items() if v is not None} - set(ATTRIBUTES)
        if lost:
            raise ValueError(f"only searches for bursts know: {sorted(lost)}")
    keep = R.equals_all(equal) & inside_any(F.col("ContentDate"), windows) & F.col("Id").isNotNull()
    if cloud_below is not None:
        keep = keep & (F.col("cloudCover") < cloud_below)
    found = catalogue.filter(keep)
    if areas:
        found = found.filter(G.polygons_meet_area(G.from_any(F.col("GeoFootprint")), G.Area(areas)))
    names = [n for n, _ in schemas.fields(schemas.SCENES) if n != "query_id"]
    return R.first_per_key(schemas.conform(found, schemas.SCENES).select(*names), ["Id"], names[1:]).orderBy("Id")


def radar(catalogue: DataFrame, windows: list[tuple[str, str]], areas: list[str], *, levels: list[str] | None = None, beam: str = "IW", direction: str | None = None, polarization: str | None = None, rel_orbit: int | None = None, most: int | None = None) -> DataFrame:
    """The radar service's products (MANIFEST), each url once, by granule.

    catalogue: one row for each feature, with its properties as columns and its footprint as wkt.
    windows: inclusive days.  most: the number of products that a window gives at most.
    """
    for a, b in windows:
        if dt.date.fromisoformat(b[:10]) < dt.date.fromisoformat(a[:10]):
            raise ValueError("a window's end comes before its start")
    beam = V.checked(beam, V.BEAM_MODES, "beam mode")
    polarization = V.checked(polarization, V.POLARIZATIONS, "polarization") if polarization else None
    levels = [V.checked(x, V.LEVELS, "product level") for x in levels or []]
    day = F.substring("startTime", 1, 10)
    equal = {"beamMode": beam, "flightDirection": direction.upper() if direction else None, "polarization": polarization}
    keep = R.equals_all(equal) & inside_any(day, [(a[:10], b[:10]) for a, b in windows]) & F.col("url").isNotNull()
    if levels:
        keep = keep & F.upper("processingLevel").isin(*levels)
    if rel_orbit is not None:
        keep = keep & (N.first_truthy(F.col("pathNumber"), F.col("relativeOrbit")) == rel_orbit)
    found = catalogue.filter(keep)
    if areas:
        found = found.filter(G.polygons_meet_area(G.from_any(F.col("wkt")), G.Area(areas)))
    size = F.col("bytes").cast("long")
    found = found.select(
        F.col("fileName").alias("granule"), "url", "beamMode", "flightDirection", "polarization", N.first_truthy(F.col("pathNumber"), F.col("relativeOrbit")).cast("long").alias("relativeOrbit"),
        "startTime", "stopTime", size.alias("expected_size"), N.size_mb(size, F.col("sizeMB")).alias("sizeMB"), "md5sum",
    )
    rest = [c for c in found.columns if c != "url"]
    found = R.first_per_key(found, ["url"], rest)
    if most is not None:
        window = F.coalesce(*[F.when(F.substring("startTime", 1, 10).between(a[:10], b[:10]), F.lit(i)) for i, (a, b) in enumerate(windows)])
        found = R.ranked(found.withColumn("__window", window), ["__window"], [F.asc("startTime"), F.asc("url")], most)
    return found.select(*[n for n, _ in schemas.fields(schemas.MANIFEST)]).orderBy("granule", "url")


def flatten(features: DataFrame, column: str, properties: str) -> DataFrame:
    """A feature collection's features (JSON text in a column) as rows: the named properties, and the footprint as wkt."""
    kind = f"features array<struct<geometry:string,properties:struct<{properties}>>>"
    rows = features.select(F.explode(F.from_json(column, kind)["features"]).alias("f"))
    return rows.select("f.properties.*", G.to_wkt(G.from_geojson(F.col("f.geometry"))).alias("wkt"))


def one_direction(manifest: DataFrame) -> tuple[DataFrame, str | None, dict[str, int]]:
    """The products of the most common flight direction (the smallest of equally common ones), it, and all counts."""
    counts = {r.flightDirection: r.n for r in R.value_counts(manifest, "flightDirection").collect()}
    if not counts:
        return manifest, None, {}
    best = min(k for k, v in counts.items() if v == max(counts.values()))
    return manifest.filter(F.upper("flightDirection") == best), best, counts
