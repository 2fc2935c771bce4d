"""Which listed files a request asks for."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from feedyard.functions.fingerprints import packed, unpacked
from feedyard.functions.paths import normalize_path
from feedyard.functions.requests import DEFAULT_LOOKBACK_MINUTES
from feedyard.session import kept


def mtime_ts(mtime_ms: Column) -> Column:
    return F.timestamp_millis(mtime_ms)


def select_explicit(requests: DataFrame, source_dir: str = "source_dir") -> DataFrame:
    """Paths named by the request itself, normalised and distinct."""
    named = requests.select("feed_key", "request_id", source_dir, F.explode("request_paths").alias("_p"))
    return named.select(
        "feed_key", "request_id", normalize_path(F.col("_p"), F.col(source_dir)).alias("file_path")
    ).distinct()


def select_discovery(requests: DataFrame, listing: DataFrame, source_dir: str = "source_dir") -> DataFrame:
    """Named paths where there are any, else everything listed for the feed."""
    open_requests = requests.filter(F.col("request_paths").isNull()).select("feed_key", "request_id")
    everything = listing.select("feed_key", "file_path").join(open_requests, "feed_key")
    return select_explicit(requests, source_dir).unionByName(everything.select("feed_key", "request_id", "file_path"))


def by_file_date(parsed: DataFrame, date_from, date_to) -> DataFrame:
    """Parsed files dated within both bounds."""
    return parsed.filter(in_dates(_as_date(date_from), _as_date(date_to)))


def by_mtime(listing: DataFrame, ts_from, ts_to=None) -> DataFrame:
    """Files modified from ``ts_from`` on, up to and including ``ts_to`` where given."""
    when = mtime_ts(F.col("src_mtime_ms"))
    keep = when >= _as_ts(ts_from)
    if ts_to is not None:
        keep = keep & (when <= _as_ts(ts_to))
    return listing.filter(keep)


def in_dates(date_from: Column, date_to: Column) -> Column:
    return (F.col("parse_status") == "PARSED") & F.col("file_date").between(date_from, date_to)


def lookback(payload_minutes: Column, config_minutes: Column) -> Column:
    """Payload value, else feed value, else one day; zero counts as not given."""
    return F.coalesce(F.nullif(payload_minutes, F.lit(0)), F.nullif(config_minutes, F.lit(0)), F.lit(DEFAULT_LOOKBACK_MINUTES))


def incremental_by_date(parsed: DataFrame, now, minutes: Column | int) -> DataFrame:
    now, minutes = _as_ts(now), _as_minutes(minutes)
    return parsed.filter(in_dates(F.to_date(_minus(now, minutes)), F.to_date(now)))


def incremental_by_mtime(listing: DataFrame, now, minutes: Column | int) -> DataFrame:
    """No upper bound: files stamped after ``now`` are taken too."""
    return listing.filter(mtime_ts(F.col("src_mtime_ms")) >= _minus(_as_ts(now), _as_minutes(minutes)))


def select_paths(requests: DataFrame, parsed: DataFrame, config: DataFrame, now) -> DataFrame:
    """All request types at once: ``(feed_key, request_id, file_path)``, distinct.

    ``requests`` is the output of ``parse_request`` with ``request_id`` and ``source_dir``; faulty
    requests select nothing. The listing is read once: one equi-join on the feed, with the request's
    own window as a filter. Where configuration and files name sub keys, a file meets the window of its own.
    """
    return dealt_paths(requests, parsed, config, now).select("feed_key", "request_id", unpacked(F.col("_path")).alias("file_path"))


def dealt_paths(requests: DataFrame, parsed: DataFrame, config: DataFrame, now) -> DataFrame:
    """``(feed_key, request_id, _path)``: the paths of :func:`select_paths`, packed and shuffled by them, so that they need not be for :func:`waterfall.classify`."""
    now = _as_ts(now)
    apart = "feed_sub_key" in config.columns and "feed_sub_key" in parsed.columns
    own = F.coalesce("feed_sub_key", F.lit("")) if apart else F.lit("")
    feeds = config.select("feed_key", own.alias("_sub"), F.col("sched_selector_type").alias("_sel"), F.col("sched_lookback_minutes").alias("_look"))
    sound = requests.filter(F.col("request_error").isNull())
    names = F.col("request_type").isin("ADHOC", "DISCOVERY") & F.col("request_paths").isNotNull()
    scans = sound.filter(~names & (F.col("request_type") != "ADHOC")).join(feeds, "feed_key", "left")
    incremental = F.col("request_type") == "INCREMENTAL"
    selector = F.when(
        incremental, F.upper(F.coalesce(F.col("selector_type"), F.col("_sel"), F.lit("FILE_MODIFIED_TS")))
    ).otherwise(F.coalesce(F.col("selector_type"), F.lit("FILE_DATE")))
    since = _minus(now, lookback(F.col("lookback_minutes"), F.col("_look")))
    # written, so that their size is known: few rows meet the files where these are
    windows = kept(scans.select(
        "feed_key", "request_id", "_sub", (F.col("request_type") == "DISCOVERY").alias("_all"), (selector == "FILE_DATE").alias("_by_date"),
        F.when(incremental, F.to_date(since)).otherwise(F.col("date_from")).alias("_d0"),
        F.when(incremental, F.to_date(now)).otherwise(F.col("date_to")).alias("_d1"),
        F.when(incremental, since).otherwise(F.col("ts_from")).alias("_t0"),
        F.when(incremental, F.lit("9999-12-31 00:00:00").cast("timestamp")).otherwise(F.col("ts_to")).alias("_t1"),
    ))
    files = parsed.select("feed_key", "file_path", "parse_status", "file_date", "src_mtime_ms", own.alias("_own"))
    hits = files.join(windows, "feed_key").filter(F.coalesce(F.col("_sub") == F.col("_own"), F.lit(True))).filter(
        F.when(F.col("_all"), True).when(F.col("_by_date"), in_dates(F.col("_d0"), F.col("_d1")))
        .otherwise(mtime_ts(F.col("src_mtime_ms")).between(F.col("_t0"), F.col("_t1")))
    ).select("feed_key", "request_id", "file_path")
    paths = hits.unionByName(select_explicit(sound.filter(names)))
    return paths.select("feed_key", "request_id", packed(F.col("file_path"), b"\x03").alias("_path")).repartition("_path").distinct()


def _minus(ts: Column, minutes: Column) -> Column:
    return ts - F.make_dt_interval(mins=minutes)


def _as_minutes(value) -> Column:
    return value if isinstance(value, Column) else F.lit(int(value))


def _as_ts(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp")


def _as_date(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("date")
