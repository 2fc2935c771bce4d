"""Feed configuration: defaults, deduplication and sync."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from feedyard import schemas
from feedyard.functions.paths import source_dir
from feedyard.functions.text import blank_to_null, or_default, strip
from feedyard.operators.skew import lookup_join
from feedyard.operators.upsert import src, update_where, upsert

# Defaults of configuration columns, and the columns a minimal sync updates.
DEFAULTS = {
    "feed_sub_key": "DEFAULT", "ctl_active": "Y", "ctl_auto_trigger": "Y", "ctl_sync_config": "N",
    "src_subdir": "source", "ctl_demo_seed_policy": "AUTO", "dir_request": "request", "dir_temp": "temp",
    "dir_discovery": "discovery", "src_file_delimiter": "|", "src_file_has_header": "Y",
    "batch_max_files": "10", "batch_max_size_gb": "1.0", "sched_selector_type": "FILE_MODIFIED_TS",
    "sched_lookback_minutes": "1440", "sched_timezone": "UTC", "schema_read_policy": "FIRST_FILE",
}
MINIMAL_SYNC = ("uc_source_dir", "src_uri", "ctl_demo_seed_policy")
KEYS = ["feed_key", "feed_sub_key"]
SEED_POLICIES = ("AUTO", "COPY", "SKIP")
READ_POLICIES = ("FIRST_FILE", "SEED", "AUTO")


def fill_defaults(raw: DataFrame) -> DataFrame:
    """Typed configuration from raw text columns; rows without a feed key are skipped.

    Absent and blank cells take the default of their column, other blanks the empty text.
    """
    cells = []
    for name, kind in schemas.fields(schemas.CONFIG):
        text = blank_to_null(F.col(name)) if name in raw.columns else F.lit(None).cast("string")
        text = F.coalesce(text, F.lit(DEFAULTS.get(name, "")))
        if name.startswith("tgt_") and name.endswith(("_silver_table", "_gold_table", "_volume")):
            text = F.coalesce(F.nullif(text, F.lit("")), blank_to_null(F.col("tgt_bronze_table")), F.lit(""))
        cells.append((text if kind == "string" else text.try_cast(kind)).alias(name))
    extra = [c for c in raw.columns if c not in schemas.names(schemas.CONFIG)]
    return raw.filter(blank_to_null(F.col("feed_key")).isNotNull()).select(*cells, *extra)


def one_of(value: Column, allowed: tuple[str, ...], default: str) -> Column:
    text = F.upper(strip(F.coalesce(value, F.lit(default))))
    return F.when(text.isin(*allowed), text).otherwise(default)


def normalize(config: DataFrame) -> DataFrame:
    """Repair enumerations, fill targets and replace empty limits by their defaults."""
    bronze = F.col("tgt_bronze_table")
    target = {c: F.coalesce(F.nullif(F.col(c), F.lit("")), bronze) for c in ("tgt_silver_table", "tgt_gold_table", "tgt_volume")}
    return config.withColumns({
        **target,
        "ctl_demo_seed_policy": one_of(F.col("ctl_demo_seed_policy"), SEED_POLICIES, "AUTO"),
        "ctl_sync_config": one_of(F.col("ctl_sync_config"), ("Y", "N"), "N"),
        "schema_read_policy": one_of(F.col("schema_read_policy"), READ_POLICIES, "FIRST_FILE"),
        "src_uri": strip(F.coalesce("src_uri", F.lit(""))),
        "ctl_maintenance_hold_until": F.coalesce("ctl_maintenance_hold_until", F.lit("")),
        "sched_cron": F.coalesce("sched_cron", F.lit("")),
        "sched_timezone": F.coalesce(F.nullif("sched_timezone", F.lit("")), F.lit("UTC")),
        "sys_default_request_json": F.coalesce("sys_default_request_json", F.lit("")),
        "tgt_bronze_partition_cols": strip(F.coalesce("tgt_bronze_partition_cols", F.lit(""))),
        "batch_max_files": F.coalesce(F.nullif("batch_max_files", F.lit(0)), F.lit(10)),
        "batch_max_size_gb": F.coalesce(F.nullif("batch_max_size_gb", F.lit(0.0)), F.lit(1.0)),
        "sched_lookback_minutes": F.coalesce(F.nullif("sched_lookback_minutes", F.lit(0)), F.lit(1440)),
    })


def refresh_seed(policy: Column, default_enabled: bool, is_new: Column) -> Column:
    p = one_of(policy, SEED_POLICIES, "AUTO")
    return F.when(p == "COPY", True).when(p == "SKIP", False).otherwise(F.lit(default_enabled) & is_new)


def policy_violations(config: DataFrame, env: str, require_src_uri: bool) -> DataFrame:
    """Feeds an environment refuses: those without ``src_uri`` where it is required."""
    message = F.concat(F.lit(f"env={env} requires src_uri for feed_key="), "feed_key", F.lit("; set src_uri in config CSV/table for this feed"))
    return config.filter(F.lit(require_src_uri) & blank_to_null(F.col("src_uri")).isNull()).select("feed_key", "feed_sub_key", message.alias("violation"))


def active(config: DataFrame, feed_key: str | None = None) -> DataFrame:
    on = config.filter(F.col("ctl_active") == "Y")
    return on.filter(F.col("feed_key") == feed_key) if feed_key else on


def with_source_dir(config: DataFrame, root: str) -> DataFrame:
    return config.withColumn("uc_source_dir", source_dir(root, F.col("src_uri"), F.col("tgt_volume"), F.col("src_subdir")))


def deduplicate(rows: DataFrame) -> DataFrame:
    """The winning row per key as a map-side combined maximum."""
    rest = [c for c in rows.columns if c not in ("feed_key", "feed_sub_key")]
    key = [strip(F.col("feed_key")).alias("feed_key"), or_default(F.col("feed_sub_key"), "DEFAULT").alias("feed_sub_key")]
    # newest file wins; at the same time the file and row that come first do
    best = F.min_by(F.struct(*rest), F.struct(
        (-F.unix_micros("config_source_mtime")).alias("age"), "config_source_file", "row_no"))
    return rows.groupBy(*key).agg(best.alias("_w")).select("feed_key", "feed_sub_key", "_w.*")


def dropped(rows: DataFrame) -> DataFrame:
    """Every row that lost, with the file that beat it and the reason.

    Files count in order of their time: a later file beats the row kept so far, and within one
    time the first row stays. Only the first rows per key and time are put in order, so a key that
    fills most of the configuration costs no large window.
    """
    keyed = rows.withColumns({"_k": strip(F.col("feed_key")), "_s": or_default(F.col("feed_sub_key"), "DEFAULT")}).select(
        "_k", "_s", "config_source_mtime", "config_source_file", "row_no")
    heads = keyed.groupBy("_k", "_s", "config_source_mtime").agg(
        F.min(F.struct("config_source_file", "row_no")).alias("_head"), F.count(F.lit(1)).alias("_n"))
    by_time = Window.partitionBy("_k", "_s").orderBy("config_source_mtime")
    heads = heads.withColumn("_next", F.lead("_head.config_source_file").over(by_time))
    placed = lookup_join(keyed, heads, ["_k", "_s", "config_source_mtime"], "_n", spread_by=F.xxhash64("config_source_file", "row_no"))
    is_head = F.struct("config_source_file", "row_no") == F.col("_head")
    lost = placed.filter(~is_head | F.col("_next").isNotNull())
    first_file = F.col("_head.config_source_file")
    reason = (
        F.when(is_head, F.concat(F.lit("superseded by newer file "), "_next"))
        .when(F.col("config_source_file") == first_file, "duplicate in same file; earlier row kept")
        .otherwise("duplicate in older file; earlier row kept")
    )
    return lost.select(
        F.col("_k").alias("feed_key"), F.col("_s").alias("feed_sub_key"), F.col("config_source_file").alias("dropped_from"),
        F.when(is_head, F.col("_next")).otherwise(first_file).alias("winner_from"), "row_no", reason.alias("reason"))


def new_keys(incoming: DataFrame, existing: DataFrame) -> DataFrame:
    return incoming.join(existing.select(*KEYS), KEYS, "left_anti")


def merge_config(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Known feeds follow the incoming row: wholly when it says so, else only their source location."""
    whole = [c for c in schemas.names(schemas.CONFIG) + ["config_source_file", "uc_source_dir"] if c not in KEYS and c in existing.columns]
    everything = F.upper(F.trim(src("ctl_sync_config"))) == "Y"
    return upsert(existing, incoming, KEYS, [
        (everything, {c: src(c) for c in whole}),
        (F.lit(True), {c: src(c) for c in MINIMAL_SYNC}),
    ], insert=False)


def backfill_override(config: DataFrame, feed_key: str, request_json: str, cron: str) -> DataFrame:
    """Point one feed at a backfill request; the next full sync reverts it."""
    return update_where(config, F.col("feed_key") == feed_key,
                        {"sys_default_request_json": F.lit(request_json), "sched_cron": F.lit(cron)})
