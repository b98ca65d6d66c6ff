"""Strings, paths and URLs as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_list(text: Column) -> Column:
    """The parts of a list written with commas or white space; none if it is blank."""
    return F.filter(F.split(F.trim(F.replace(text, F.lit(","), F.lit(" "))), r"\s+"), lambda x: x != "")


def scene_root(path: Column) -> Column:
    """A scene's storage path without its store prefix and without slashes at the end."""
    return F.regexp_replace(F.regexp_replace(path, "^/eodata", ""), "/+$", "")


def base_name(path: Column) -> Column:
    return F.substring_index(F.regexp_replace(path, "/+$", ""), "/", -1)


def asset_path(listed: Column, scene: Column) -> Column:
    """A listed path relative to its scene: the known prefixes first, then known folders, then repair."""
    root = scene_root(scene)
    prefixes = [F.concat(F.lit("s3://eodata"), root, F.lit("/")), F.concat(F.lit("eodata"), root, F.lit("/")), F.concat(F.regexp_replace(root, "^/+", ""), F.lit("/"))]
    out = None
    for p in prefixes:
        rest = F.substr(listed, F.length(p) + 1)
        out = F.when(F.startswith(listed, p), rest) if out is None else out.when(F.startswith(listed, p), rest)
    for folder in ("GRANULE/", "DATASTRIP/", "AUX_DATA/", "HTML/"):
        out = out.when(F.contains(listed, F.lit(folder)), F.substr(listed, F.instr(listed, folder)))
    cut = listed.rlike("^(L1C_|L2A_)") & (F.contains(listed, F.lit("/IMG_DATA/")) | F.endswith(listed, F.lit("/MTD_TL.xml")))
    return out.when(cut, F.concat(F.lit("GRANULE/"), listed)).otherwise(base_name(listed))


def url_filename(url: Column, granule: Column) -> Column:
    """The decoded last part of a URL's path, else the granule's; null where that is no safe file name."""
    path = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    path = F.regexp_replace(path, ";[^/]*$", "")
    plain = F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path)
    name = base_name(plain)
    name = F.when(name == "", base_name(granule)).otherwise(name)
    return F.when(~name.isin("", ".", ".."), name)


def acquisition_date(path: Column) -> Column:
    """The date in a file's name, else in the nearest folder above it that ends in .SAFE."""
    mark = r"_([0-9]{8})T[0-9]{6}"
    folders = F.filter(F.reverse(F.split(path, "/")), lambda x: F.endswith(x, F.lit(".SAFE")) & x.rlike(mark))
    found = F.coalesce(F.nullif(F.regexp_extract(base_name(path), mark, 1), F.lit("")), F.regexp_extract(F.get(folders, F.lit(0)), mark, 1))
    return F.to_date(F.nullif(found, F.lit("")), "yyyyMMdd")


def baseline(path: Column) -> Column:
    """The processing baseline's four digits, or null."""
    return F.nullif(F.regexp_extract(path, r"_N(\d{4})_", 1), F.lit(""))


def dn_offset(path: Column) -> Column:
    """1000 from baseline 04.00 on, else 0."""
    return F.when(baseline(path).cast("int") >= 400, 1000).otherwise(0)


def is_level_1c(name: Column) -> Column:
    return F.contains(F.upper(name), F.lit("MSIL1C"))


def classification_name(band_file: Column) -> Column:
    """The name of the scene classification beside a band's file."""
    return F.regexp_replace(band_file, "_B(0[1-9]|1[0-2]|8A)_", "_SCL_")


def class_codes(text: Column) -> Column:
    """Codes in a text, sorted and distinct, as comma-separated text."""
    codes = F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(r"(\d+)"), F.lit(1)), lambda x: x.cast("int"))))
    return F.array_join(F.transform(codes, lambda x: x.cast("string")), ",")


def asset_label(band: Column, resolution: Column) -> Column:
    """``band@20m``, or the band alone where the resolution is 0."""
    return F.when(resolution != 0, F.concat(band, F.lit("@"), resolution.cast("string"), F.lit("m"))).otherwise(band)


def resolution_folder(resolution: Column) -> Column:
    return F.format_string("R%dm", resolution.cast("int"))


def format_bytes(size: Column) -> Column:
    """A byte count in IEC units with one decimal, halves to even."""
    value = F.greatest(size, F.lit(0)).cast("double")
    out = F.when(value < 1024, F.format_string("%d B", value.cast("long")))
    for k, unit in enumerate(("KiB", "MiB", "GiB", "TiB"), start=1):
        out = out.when(value < 1024.0 ** (k + 1), F.format_string(f"%.1f {unit}", F.bround(value / 1024.0**k, 1)))
    return out.otherwise(F.format_string("%.1f PiB", F.bround(value / 1024.0**5, 1)))


def storage_text(resolved: Column, total: Column, footprint: Column, additional: Column, free: Column) -> Column:
    """The storage estimate in words, with a warning sign if it does not fit."""
    sample = F.least(F.lit(10), total)
    kind = F.when(resolved < sample, F.concat(F.lit("early sample "), resolved.cast("string"), F.lit("/"), sample.cast("string"))).otherwise(F.lit("estimate"))
    text = F.concat(kind, F.lit(": dataset ~"), format_bytes(footprint), F.lit(" total, ~"), format_bytes(additional), F.lit(" additional"))
    room = F.concat(F.when(additional > free, F.lit("⚠ ")).otherwise(F.lit("")), text, F.lit("; "), format_bytes(free), F.lit(" free at start"))
    return F.when(free.isNull(), text).otherwise(room)


def normal_md5(checksum: Column) -> Column:
    """A checksum trimmed and in lower case; null if blank."""
    return F.nullif(F.lower(F.trim(checksum)), F.lit(""))
