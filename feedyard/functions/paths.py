"""Path normalisation."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from feedyard.functions.text import blank_to_null, strip

# URI schemes that count as external storage.
EXTERNAL_SCHEMES = ("s3", "s3a", "abfss", "wasbs", "gs")

_EXTERNAL = "^(" + "|".join(EXTERNAL_SCHEMES) + ")://"


def is_external(path: Column) -> Column:
    return F.lower(strip(path)).rlike(_EXTERNAL)


def base_name(path: Column) -> Column:
    """Last path segment."""
    return F.element_at(F.split(F.rtrim(path, F.lit("/")), "/"), -1)


def normalize_path(path: Column, source_dir: Column) -> Column:
    """Requested path or bare name to the form used in listings."""
    p = strip(path)
    return (
        F.when(p.startswith("dbfs:/") | is_external(p), p)
        .when(p.startswith("/Volumes/"), F.concat(F.lit("dbfs:"), p))
        .when(~p.contains("/"), F.concat(source_dir, F.lit("/"), p))
        .otherwise(p)
    )


def fingerprint_path(path: Column) -> Column:
    """Stable path form that goes into a fingerprint."""
    p = strip(F.coalesce(path, F.lit("")))
    return F.rtrim(F.when(p.startswith("/Volumes/"), F.concat(F.lit("dbfs:"), p)).otherwise(p), F.lit("/"))


def source_dir_prefix(source_dir: Column) -> Column:
    """Prefix that completes bare names: external URIs stay, all else gets the ``dbfs:`` scheme."""
    d = F.rtrim(strip(F.coalesce(source_dir, F.lit(""))), F.lit("/"))
    keep = (d == "") | d.startswith("dbfs:") | is_external(d)
    return F.when(keep, d).otherwise(F.concat(F.lit("dbfs:"), d))


def to_local_form(path: Column) -> Column:
    """URI form to the mounted form that file APIs open."""
    p = strip(path)
    return (
        F.when(p.startswith("dbfs:/Volumes/"), F.substr(p, F.lit(6)))
        .when(p.startswith("dbfs:/"), F.concat(F.lit("/dbfs/"), F.ltrim(F.substr(p, F.lit(7)), F.lit("/"))))
        .otherwise(p)
    )


def to_uri_form(path: Column) -> Column:
    """Mounted form back to the URI form."""
    p = strip(path)
    return (
        F.when(p.startswith("/Volumes/"), F.concat(F.lit("dbfs:"), p))
        .when(p.startswith("/dbfs/"), F.concat(F.lit("dbfs:/"), F.ltrim(F.substr(p, F.lit(7)), F.lit("/"))))
        .otherwise(p)
    )


def default_source_dir(root: str, volume: Column, subdir: Column) -> Column:
    return F.concat(F.lit(root.rstrip("/") + "/"), volume, F.lit("/"), subdir)


def source_dir(root: str, src_uri: Column, volume: Column, subdir: Column) -> Column:
    """``src_uri`` where it is set, else the default landing folder of the feed."""
    return F.coalesce(blank_to_null(src_uri), default_source_dir(root, volume, subdir))
