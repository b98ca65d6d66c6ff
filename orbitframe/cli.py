"""The command line: python -m orbitframe COMMAND.

Searches and downloads work on a catalogue table and a folder that stands in for the store; nothing
is asked of a live service.
"""

from __future__ import annotations

import argparse
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from orbitframe.functions import dates as D
from orbitframe.functions import geometry as G
from orbitframe.functions import numbers as N
from orbitframe.functions import pixels as P
from orbitframe.functions import text as T
from orbitframe.functions import vocab as V
from orbitframe.logs import logger
from orbitframe.operators import spatial as SP
from orbitframe.operators import transfer as X
from orbitframe.session import session
from orbitframe.sources import catalogue as C
from orbitframe.sources import connectors, files, schemas, sinks, tiles, vector
from orbitframe.streaming.state import Roots, merge_rows

DEFAULT_CACHE = {"asf": ".asf-cache", "cdse": ".cdse-cache"}


class Refused(Exception):
    """A wrong argument."""


def areas_of(spark: SparkSession, path: str, srid: int = 4326) -> list[str]:
    """The polygons of a user's file in longitude and latitude."""
    rows = vector.read_vector(spark, path).filter("wkt is not null").select("wkt")
    if srid != 4326:
        moved = F.transform(G.from_wkt(F.col("wkt")), lambda p: F.transform(p, lambda r: F.transform(r, lambda c: F.struct(*[v.alias(n) for v, n in zip(G.to_lonlat(c["x"], c["y"], srid), ("x", "y"))]))))
        rows = rows.select(G.to_wkt(moved).alias("wkt"))
    out = [r.wkt for r in rows.collect()]
    if not out:
        raise Refused(f"the area has no features: {path}")
    return out


def srid_of(text: str) -> int:
    try:
        return int(text.upper().removeprefix("EPSG:"))
    except ValueError:
        raise Refused(f"not a reference system: {text}") from None


def season(a) -> tuple[list[int], tuple[int, int], tuple[int, int]]:
    try:
        years, start, end = D.parse_years(a.years), D.parse_month_day(a.speriod), D.parse_month_day(a.eperiod)
    except ValueError as e:
        raise Refused(f"--years, --speriod or --eperiod: {e}") from None
    if not years:
        raise Refused("--years must hold a year at least")
    if end < start:
        raise Refused("--eperiod must not come before --speriod")
    return years, start, end


def bbox2geojson(a, spark) -> int:
    parts = [p for p in a.bbox.replace(",", " ").split() if p]
    try:
        box = tuple(map(float, parts))
        made = files.bbox_table(spark, box) if len(box) == 4 else None
    except ValueError as e:
        raise Refused(f"--bbox: {e}") from None
    if made is None:
        raise Refused("--bbox takes minx, miny, maxx and maxy")
    print(sinks.write_geojson(made.select("wkt"), a.output))
    return 0


def csv2geojson(a, spark) -> int:
    try:
        print(sinks.write_geojson(files.csv_points(spark, a.csv, a.lon, a.lat), a.output))
    except ValueError as e:
        raise Refused(str(e)) from None
    return 0


def grid(a, spark) -> int:
    dx, dy = (a.px * 2)[:2]
    try:
        cells = SP.area_grid(spark, areas_of(spark, a.aoi, srid_of(a.crs)), dx, dy, a.fill_holes, a.clip)
    except ValueError as e:
        raise Refused(str(e)) from None
    box = G.box_wkt(*[F.col(c) for c in ("minx", "miny", "maxx", "maxy")])
    print(sinks.write_geojson(cells.select("row", "col", "minx", "miny", box.alias("wkt")), a.output))
    return 0


def asf_query(a, spark) -> int:
    log = logger("asf_query", a.log, a.verbose)
    years, start, end = season(a)
    windows = [(x[:10], y[:10]) for x, y in D.season_windows(years, start, end)]
    area = G.union(areas_of(spark, a.aoi, srid_of(a.crs)))
    direction = None if a.flight_direction in ("BOTH", "PREDOMINANT") else a.flight_direction
    payload = {
        "provider": "ASF", "platform": V.RADAR, "aoi_wkt": area, "years": years, "speriod": "%02d-%02d" % start, "eperiod": "%02d-%02d" % end, "windows": windows, "product_levels": [a.product_levels],
        "beam_mode": a.beam_mode, "flight_direction": a.flight_direction, "polarization": a.polarization, "relative_orbit": a.relative_orbit, "max_results": a.max_results,
    }
    more: dict = {}

    def run():
        found = connectors.radar(spark.read.parquet(a.catalogue), windows, [area], levels=[a.product_levels], beam=a.beam_mode, direction=direction, polarization=a.polarization, rel_orbit=a.relative_orbit, most=a.max_results)
        if a.max_results is not None:
            day = F.substring("startTime", 1, 10)
            n = found.agg(*[F.count_if(day.between(x, y)).alias(str(i)) for i, (x, y) in enumerate(windows)]).first()
            more["possibly_truncated_windows"] = [{"start": x, "end": y, "returned": n[i], "max_results": a.max_results} for i, (x, y) in enumerate(windows) if n[i] >= a.max_results]
        if a.flight_direction == "PREDOMINANT":
            found, more["selected_direction"], more["direction_counts"] = connectors.one_direction(found)
        return found

    try:
        manifest = C.cached_search(spark, a.cache_dir, payload, run, "manifest.parquet", False, lambda df: {**more, "aoi": a.aoi, "crs": a.crs, "num_products": df.count()})
    except ValueError as e:
        raise Refused(str(e)) from None
    folder = f"{a.cache_dir}/{sinks.cache_key(payload)}"
    info = sinks.read_query(folder) or {}
    print(f"Cached query: {folder}/manifest.parquet")
    if info.get("selected_direction"):
        print("Flight direction counts: " + ", ".join(f"{k}={v}" for k, v in sorted(info["direction_counts"].items())) + f"; selected {info['selected_direction']}.")
    if info.get("possibly_truncated_windows"):
        cut = ", ".join(f"{w['start']} to {w['end']}" for w in info["possibly_truncated_windows"])
        print(f"WARNING: --max-results was reached for {cut}; the manifest may lack products.", file=sys.stderr)
        log.warning("--max-results was reached for %s", cut)
    print(f"Found {manifest.count()} unique product(s).")
    return 0


def last_run(outdir: str, service: str) -> str:
    """Where the rows of the last download are."""
    return f"{outdir}/.orbitframe/{service}_last_run.parquet"


def told(began: float, counts: dict[str, int], n: str, state: str) -> None:
    when = lambda t: time.strftime("%Y-%m-%d %H:%M:%S", time.localtime(t))
    now = time.time()
    print(f"Summary:\n  Download started: {when(began)}\n  Download ended:   {when(now)}\n  Elapsed time:     {now - began:.1f} seconds for {n}")
    print(f"  Results:          {counts['downloaded']} downloaded, {counts['skipped']} skipped, {counts['failed']} failed\n  Download status:  {state}")


def asf_download(a, spark) -> int:
    log = logger("asf_download", a.log, a.verbose)
    if not files.login(a.config, a.host):
        raise Refused(f"no login for {a.host} in {a.config}")
    manifest = a.query or files.latest_cached(a.cache_dir, "manifest.parquet")
    if manifest is None:
        raise Refused(f"no cached manifest in {a.cache_dir}: search first")
    print(f"Cached query: {manifest}")
    try:
        products = schemas.require(sinks.read_table(spark, manifest), "url").filter("url is not null")
    except ValueError as e:
        raise Refused(str(e)) from None
    n = products.select("url").distinct().count()
    print(f"Found {n} scenes: {n} ZIP file{'s' * (n != 1)}")
    if not n:
        return 0
    began, at = time.time(), Roots(a.cache_dir, a.outdir).downloads("asf")
    state = schemas.conform(sinks.read_table(spark, at), schemas.DOWNLOADS) if sinks.table_exists(at) else None
    todo = X.product_plan(products, a.outdir, state)
    done = X.product_state(X.carried_out(todo, X.local_store(a.store, a.prefix), a.retries + 1, a.wait, parallel=a.processes))
    sinks.replace_table(done, last_run(a.outdir, "asf"))  # this write is what fetches
    done = sinks.read_table(spark, last_run(a.outdir, "asf"))
    counts = X.totals(done)
    merge_rows(done, at, ["url"], ["checked_at"])
    told(began, counts, f"{n} files", at)
    if counts["failed"]:
        log.error("%d products failed", counts["failed"])
        print(f"Download completed with {counts['failed']} failed product(s).", file=sys.stderr)
    return int(counts["failed"] > 0)


def cdse_query(a, spark) -> int:
    logger("cdse_query", a.log, a.verbose)
    years, start, end = season(a)
    windows = [(x + "Z", y + "Z") for x, y in D.season_windows(years, start, end)]
    areas = areas_of(spark, a.aoi, srid_of(a.crs))
    try:
        product = V.checked_of(V.PRODUCTS, V.OPTICAL, a.product, "product") if a.product else None
        platform = V.checked_of(V.SERIAL_IDS, V.OPTICAL, a.platform_serial_id, "serial id") if a.platform_serial_id else None
        mode = V.checked_of(V.SENSOR_MODES, V.OPTICAL, a.ops_mode, "mode") if a.ops_mode else None
    except ValueError as e:
        raise Refused(str(e)) from None
    asked = {"product": product, "orbit": a.orbit, "cloud_below": a.cloud_thresh, "rel_orbit": a.rel_orbit_num, "mode": mode, "platform": platform}
    payload = {"collection": V.OPTICAL, "aoi_wkt": G.union(areas), "windows": windows, "years": years, **asked, "top": a.top, "count": a.count}

    def run():
        # each batch of areas is a search of its own, as the service takes texts of limited length
        found = None
        for batch in connectors.area_batches(areas):
            part = connectors.optical(spark.read.parquet(a.catalogue), windows, [batch], **asked)
            found = part if found is None else found.unionByName(part)
        if not a.count:
            found = found.orderBy("ContentDate", "Id").limit(a.top)  # one page
        from orbitframe.operators.relational import first_per_key

        return first_per_key(found, ["Id"], [c for c in found.columns if c != "Id"]).withColumn("query_id", F.lit(sinks.cache_key(payload)))

    scenes = C.cached_search(spark, a.cache_dir, payload, run, "scenes.parquet", True, lambda df: {"aoi": a.aoi, "num_scenes": df.count()})
    print(f"Cached query manifest: {a.cache_dir}/{sinks.cache_key(payload)}/scenes.parquet")
    print(f"Found {scenes.count()} unique scene(s).")
    return 0


def cdse_download(a, spark) -> int:
    log = logger("cdse_download", a.log, a.verbose)
    try:
        files.store_settings(a.config)
    except ValueError as e:
        raise Refused(str(e)) from None
    if a.mission.upper() != "S2":
        raise Refused("only --mission S2 can be downloaded")
    bands = list(dict.fromkeys(b.upper() for b in a.bands.replace(",", " ").split()))
    wrong = [b for b in bands if b not in V.IMAGE_BANDS]
    if not bands or wrong:
        raise Refused(f"--bands takes some of {', '.join(V.IMAGE_BANDS)}")
    lost = [b for b in bands if b not in N.BAND_RESOLUTIONS]
    if lost:
        raise Refused(f"no resolution is known for {', '.join(lost)}")
    query = a.query or files.latest_cached(a.cache_dir, "scenes.parquet")
    if query is None:
        raise Refused(f"no scenes.parquet in {a.cache_dir}")
    scenes = schemas.require(sinks.read_table(spark, query), "Name", "S3Path").select("Name", "S3Path").distinct()
    n = scenes.count()
    print(f"Cached query: {query}\nFound {n} scenes: {len(bands)} requested image{'s' * (len(bands) != 1)} per scene")
    began, roots = time.time(), Roots(a.cache_dir, a.outdir)
    wanted = [(b, resolved(b, a.res)) for b in bands]
    for b, r in wanted:
        if r != a.res:
            log.warning("%s: requested %dm, resolved to %dm", b, a.res, r)
    level1 = T.is_level_1c(F.col("safedir"))
    listed = files.read_listing(spark, a.listing)
    root = F.regexp_extract("path", r"([^/]+\.SAFE)/", 1)
    found = listed.withColumn("safedir", root).join(F.broadcast(scenes.withColumnRenamed("Name", "safedir")) if n < 100_000 else scenes.withColumnRenamed("Name", "safedir"), "safedir")
    found = files.requested(files.image_assets(found, F.col("S3Path"), level1), wanted, level1)
    images = files.asset_rows(found, F.col("S3Path"))
    done = X.carried_out(X.asset_plan(images, a.outdir), X.local_store(a.store, a.prefix), 3, a.wait, True, a.parallel_scenes * a.parallel_bands)
    sinks.replace_table(done, last_run(a.outdir, "cdse"))  # this write is what fetches
    done = sinks.read_table(spark, last_run(a.outdir, "cdse"))
    counts, results = X.totals(done), X.scene_results(scenes, done, wanted, T.is_level_1c(F.col("Name")))
    state = done.withColumns({"local_path": F.col("target"), "download_status": F.when(F.col("status") == "complete", "complete")})
    rows = schemas.conform(state, schemas.IMAGES)
    merge_rows(rows, roots.discovered, schemas.IMAGE_KEY, ["local_actual_size"])
    at = roots.downloads("cdse")
    merge_rows(rows.filter("download_status = 'complete'"), at, schemas.IMAGE_KEY, ["local_actual_size"])
    failed = results.agg(F.sum(F.size("failed"))).first()[0] or 0
    told(began, counts | {"failed": failed}, f"{n} scenes", at)
    for r in results.filter(~F.col("ok")).orderBy("Name").limit(10).collect():
        log.info("%s: %s", r.Name, r.failed)
    if failed:
        print(f"Download completed with {failed} failed required asset(s).", file=sys.stderr)
    return int(failed > 0)


def resolved(band: str, wanted: int) -> int:
    """numbers.resolve() for the driver."""
    have = N.BAND_RESOLUTIONS[band]
    finer, coarser = [r for r in have if r < wanted], [r for r in have if r > wanted]
    return wanted if wanted in have else max(finer) if finer else min(coarser)


def dn_offset(a, spark) -> int:
    logger("dn_offset", a.log, a.verbose)
    years, start, end = season(a)
    found = files.bands_at(files.band_files(spark, a.input_dir), a.bands, a.res)
    lacking = sorted(set(a.bands) - {r.band for r in found.select("band").distinct().collect()})
    if lacking:
        print(f"No files for {', '.join(lacking)} in {a.input_dir}", file=sys.stderr)
        return 1
    d = F.col("acq_date")
    rows = found.filter(d.isNotNull() & D.in_years(d, years) & D.in_season(d, start, end))
    rows = rows.select("band", F.col("path").alias("band_jp2_path"), "acq_date", "resolution_m", T.dn_offset(F.col("path")).alias("dn_offset"), F.lit(a.dst_nodata).alias("nodata"))
    at = f"{a.output_dir.rstrip('/')}/dn_offset.parquet"
    sinks.replace_table(rows, at)
    n = sinks.read_table(spark, at).count()
    if a.tiles:  # pixels at hand: a stored table of them, each with its offset taken off
        view = tiles.offset_view(spark.read.parquet(a.tiles), "offset_tiles", "path", a.dst_nodata)
        tiles.write_tiles(spark.table(view), f"{a.output_dir.rstrip('/')}/tiles.parquet")
    print(f"Successfully processed {n} bands: {at}")
    return 0


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="orbitframe", description=__doc__.split("\n")[0])
    top = out.add_subparsers(dest="command", required=True)

    def add(where, name, run, *arguments, **defaults):
        p = where.add_parser(name)
        for flag, options in arguments:
            p.add_argument(flag, **options)
        p.set_defaults(run=run, **defaults)

    need, text = {"required": True}, {"default": None}
    logs = [("--log", text), ("--verbose", {"action": "store_true"})]
    period = [("--years", need), ("--speriod", {"default": "01-01"}), ("--eperiod", {"default": "12-31"})]
    crs = ("--crs", {"default": "EPSG:4326"})
    whole = {"type": int, "default": None}
    upper = {"type": str.upper}
    add(top, "bbox2geojson", bbox2geojson, ("--bbox", need), ("--output", {"default": "bbox.geojson"}))
    add(top, "csv2geojson", csv2geojson, ("--csv", need), ("--lon", {"default": "lon"}), ("--lat", {"default": "lat"}), ("--output", {"default": "points.geojson"}))
    add(
        top, "grid", grid, ("--aoi", need), ("--px", {"required": True, "type": float, "nargs": "+"}), crs, ("--fill-holes", {"action": argparse.BooleanOptionalAction, "default": True}),
        ("--clip", {"choices": ["intersect", "within", "all"], "default": "intersect"}), ("--output", {"default": "grid.geojson"}),
    )
    asf = top.add_parser("asf").add_subparsers(dest="sub", required=True)
    add(
        asf, "query", asf_query, ("--aoi", need), *period, ("--catalogue", need), ("--product-levels", {**upper, "choices": V.DATA_LEVELS, "default": "GRD_HD"}), ("--beam-mode", {**upper, "choices": V.BEAM_MODES, "default": "IW"}),
        ("--flight-direction", {**upper, "choices": ["BOTH", "PREDOMINANT", *V.ORBIT_DIRECTIONS], "default": "BOTH"}), ("--polarization", {**upper, "choices": V.POLARIZATIONS, "default": "VV+VH"}),
        ("--relative-orbit", {**whole, "choices": range(1, 176), "metavar": "1-175"}), ("--max-results", whole), ("--cache-dir", {"default": DEFAULT_CACHE["asf"]}), crs, *logs,
    )
    store = [("--store", need), ("--prefix", need), ("--wait", {"type": float, "default": 2.0})]
    add(
        asf, "download", asf_download, ("--outdir", need), ("--config", need), ("--host", {"default": "urs.earthdata.nasa.gov"}), ("--query", text), ("--processes", {"type": int, "choices": range(1, 9), "default": 4, "metavar": "1-8"}),
        ("--retries", {"type": int, "default": 3}), ("--cache-dir", {"default": DEFAULT_CACHE["asf"]}), *store, *logs,
    )
    cdse = top.add_parser("cdse").add_subparsers(dest="sub", required=True)
    add(
        cdse, "query", cdse_query, ("--aoi", need), crs, *period, ("--catalogue", need), ("--product", text), ("--orbit", {**upper, "choices": V.ORBIT_DIRECTIONS, "default": None}), ("--cloud-thresh", {"type": percent, "default": None}),
        ("--rel-orbit-num", {**whole, "choices": range(1, 144), "metavar": "1-143"}), ("--ops-mode", text), ("--platform-serial-id", text), ("--top", {"type": int, "default": 1000}),
        ("--count", {"action": argparse.BooleanOptionalAction, "default": True}), ("--cache-dir", {"default": DEFAULT_CACHE["cdse"]}), *logs,
    )
    add(
        cdse, "download", cdse_download, ("--outdir", need), ("--bands", need), ("--res", {"type": int, "choices": [10, 20, 60], "default": 20}), ("--mission", {"default": "S2"}), ("--config", {"default": ".s5cfg"}), ("--query", text), ("--listing", need),
        ("--parallel-scenes", {"type": int, "default": 2}), ("--parallel-bands", {"type": int, "default": 4}), ("--cache-dir", {"default": DEFAULT_CACHE["cdse"]}), *[(f, {**o, "default": "s3://eodata"} if f == "--prefix" else o) for f, o in store if f != "--prefix"],
        ("--prefix", {"default": "s3://eodata"}), *logs,
    )
    s2 = top.add_parser("s2").add_subparsers(dest="sub", required=True)
    add(
        s2, "dn-offset", dn_offset, ("--input-dir", need), ("--output-dir", need), ("--years", need), ("--speriod", need), ("--eperiod", need), ("--bands", {"nargs": "+", "default": V.DEFAULT_BANDS[V.OPTICAL]}),
        ("--res", {"type": int, "choices": [10, 20, 60], "default": 20}), ("--dst-nodata", {"type": int, "default": P.NODATA}), ("--tiles", text), *logs,
    )
    return out


def percent(text: str) -> float:
    value = float(text)
    if not 0 <= value <= 100:
        raise argparse.ArgumentTypeError("from 0 to 100")
    return value


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """Run a command; 0 if all went well, 1 if something failed, 2 for wrong arguments."""
    try:
        a = parser().parse_args(arguments)
    except SystemExit as e:
        return int(e.code or 0)
    for name in ("aoi", "csv", "catalogue", "config"):
        at = getattr(a, name, None)
        if at and "://" not in at and not Path(at).exists():
            print(f"--{name}: no such file: {at}", file=sys.stderr)
            return 2
    try:
        return a.run(a, spark or session("orbitframe"))
    except Refused as e:
        print(str(e), file=sys.stderr)
        return 2
