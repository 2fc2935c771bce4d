"""Inventory state: discovery, load marks and adjudication."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from feedyard import schemas
from feedyard.functions.fingerprints import is_digest, packed, unpacked
from feedyard.functions.text import yn
from feedyard.operators.skew import HOT_ROWS, lookup_join
from feedyard.operators.upsert import src, update_where, upsert

# Columns a re-discovery must not touch, and the reasons of a verdict.
STATE_COLUMNS = ("load_status", "cnt_row_bronze", "flg_latest", "flg_superseded", "flg_legit_for_silver", "promote_status")
REASON_PARSE = "filename parse failed"
REASON_SUPERSEDED = "superseded by newer version"
REASON_NOT_LOADED = "latest but bronze not loaded"
REASON_ZERO_ROWS = "latest but zero rows loaded"
REASON_INCOMPLETE = "latest but delivery incomplete"
REASON_PARTS_NOT_LOADED = "latest but some parts not bronze loaded"
REASON_READY = "latest and ready for silver"
REASON_DQ = "latest but data quality not passed"
DQ_PROMOTABLE = ("NOT_EVALUATED", "PASSED", "WARNED")


def manifest_rows(eligible: DataFrame, parsed: DataFrame, now) -> DataFrame:
    """Discovery rows, with defaults, for the eligible paths that are listed."""
    # shuffled as the join below needs it, so that it is not shuffled again
    wanted = eligible.select("feed_key", "file_path", "request_id").repartition("feed_key", "file_path").distinct()
    texts = ["file_fingerprint"] if "file_fingerprint" in parsed.columns else []
    rows = parsed.withColumns({c: packed(F.col(c)) for c in texts}).join(wanted, ["feed_key", "file_path"]).withColumns({c: unpacked(F.col(c)) for c in texts})
    ok = F.col("parse_status") == "PARSED"
    defaults = {
        "load_status": F.when(ok, "DISCOVERED").otherwise("PARSE_FAILED"),
        "cnt_row_bronze": F.lit(None).cast("bigint"),
        "flg_latest": F.lit("N"), "flg_superseded": F.lit("N"), "flg_legit_for_silver": F.lit("N"),
        "promote_status": F.lit("NOT_READY"),
        "status_reason": F.coalesce("parse_reason", F.lit("discovered")),
        "ts_discovered": F.lit(now).cast("timestamp"),
    }
    have = set(rows.columns)
    return rows.withColumns(defaults).select([
        (F.col(n) if n in have or n in defaults else F.lit(None)).cast(t).alias(n) for n, t in schemas.fields(schemas.INVENTORY)
    ])


def merge_inventory(inventory: DataFrame, discovered: DataFrame) -> DataFrame:
    """Refresh known fingerprints, keeping their load and promotion state; add new ones."""
    refresh = {c: src(c) for c in discovered.columns if c not in STATE_COLUMNS and c != "file_fingerprint"}
    return upsert(inventory, discovered, ["file_fingerprint"], [(F.lit(True), refresh)])


def mark_loaded(inventory: DataFrame, loads: DataFrame) -> DataFrame:
    """Record row counts of loaded files; ``loads`` is one row per fingerprint."""
    sets = {
        "load_status": F.lit("LOADED_BRONZE"), "cnt_row_bronze": src("cnt_row_bronze"),
        "request_id": src("request_id"), "dispatch_run_id": src("dispatch_run_id"),
        "status_reason": F.lit("bronze load completed"),
    }
    return upsert(inventory, loads, ["file_fingerprint"], [(F.lit(True), sets)], insert=False)


def with_loads(inventory: DataFrame, loaded: DataFrame) -> DataFrame:
    """The inventory as the committed loads leave it: known files are marked, files that came by a stream are new rows.

    ``loaded`` is one row per fingerprint with inventory columns and ``dq_status``, as ``commits.loaded_files`` gives them. Files
    of no load have the status they had; ``dq_status`` is added where the inventory has none yet.
    """
    if "dq_status" not in inventory.columns:
        inventory = inventory.withColumn("dq_status", F.lit(None).cast("string"))
    marks = {
        "load_status": F.lit("LOADED_BRONZE"), "cnt_row_bronze": src("cnt_row_bronze"), "request_id": src("request_id"),
        "dispatch_run_id": src("dispatch_run_id"), "status_reason": F.lit("bronze load completed"), "dq_status": src("dq_status"),
    }
    failed = {"dq_status": src("dq_status"), "status_reason": src("status_reason")}
    rows = loaded.select("file_fingerprint", "dq_status", *[c for c in schemas.names(schemas.INVENTORY) if c != "file_fingerprint"])
    return upsert(inventory, rows, ["file_fingerprint"], [(src("load_status") == "LOADED_BRONZE", marks), (F.lit(True), failed)])


def loaded_ok() -> Column:
    return (F.col("load_status") == "LOADED_BRONZE") & (F.coalesce("cnt_row_bronze", F.lit(0)) > 0)


def part_winners(inventory: DataFrame) -> DataFrame:
    """The winning version per part: one row per ``part_group_key``.

    Highest rank, then latest discovery, then highest name, then fingerprint. Taken as a map-side
    combined maximum rather than a window, so a part with very many versions needs no large sort.
    """
    before = [F.coalesce("file_version_rank", F.lit(0)).alias("rank"),
              F.coalesce("ts_discovered", F.lit("1900-01-01").cast("timestamp")).alias("ts"), F.col("file_name")]
    behind = ["delivery_group_key", "file_part_seq", "file_part_tot", "loaded", "file_version_rank"]
    print_, parsed = F.col("file_fingerprint"), inventory.filter(F.col("parse_status") == "PARSED").withColumn("loaded", loaded_ok())

    def top(rows: Column, key: Column) -> Column:
        return F.max(F.when(rows, F.struct(*before, key.alias("file_fingerprint"), *behind)))

    # digests travel packed, which keeps their order; the best of them meets the best of all other fingerprints as text
    best = parsed.groupBy("part_group_key").agg(
        top(is_digest(print_), F.unhex(print_)).alias("d"), top(~is_digest(print_), print_).alias("o"),
        F.max("file_part_tot").alias("max_tot"), F.count(F.lit(1)).alias("versions"))
    text = F.lower(F.hex("d.file_fingerprint")).alias("file_fingerprint")
    digest = F.struct("d.rank", "d.ts", "d.file_name", text, *[f"d.{c}" for c in behind])
    winner = F.when(F.col("d").isNull(), F.col("o")).when(F.col("o").isNull(), digest).otherwise(F.greatest("o", digest))
    return best.withColumn("w", winner).select("part_group_key", "w.file_fingerprint", *[f"w.{c}" for c in behind], "max_tot", "versions")


def delivery_status(winners: DataFrame) -> DataFrame:
    """Expected, present and loaded parts per delivery.

    A part belongs to one delivery, since its key extends the delivery's. Parts are first reduced
    to one row per sequence number, so the distinct counts are plain sums.
    """
    per_seq = winners.groupBy("delivery_group_key", "file_part_seq").agg(
        F.max("max_tot").alias("tot"), F.bool_or("loaded").alias("loaded"), F.count(F.lit(1)).alias("parts")
    )
    numbered = F.col("file_part_seq").isNotNull()
    return per_seq.groupBy("delivery_group_key").agg(
        F.max("tot").alias("expected_part_count"),
        F.count_if(numbered).alias("latest_part_count"),
        F.count_if(numbered & F.col("loaded")).alias("loaded_part_count"),
        F.sum("parts").alias("cnt_part_groups"),
    )


def verdicts(inventory: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``(_print, _verdict)`` of the winning version of each part: 0, 1 where the delivery lacks parts, 2 where parts of it are not loaded.

    Three narrow aggregates; fingerprints are packed.
    """
    winners = part_winners(inventory)
    status = delivery_status(winners)
    # completeness is asked only of loaded winners that name a total, since others have a reason that comes before it; this narrow join is
    # the only one on a key that can be hot. Both branches name the largest total, as the status does: so all read one shuffle of the winners
    asks = F.coalesce(F.col("file_part_tot").isNotNull() & F.col("max_tot").isNotNull() & F.col("loaded"), F.lit(False))
    keyed = winners.select(packed(F.col("file_fingerprint"), b"\x03").alias("_print"), "delivery_group_key", asks.alias("_asks"))
    asked = keyed.filter("_asks").drop("_asks")
    checked = lookup_join(asked, status, ["delivery_group_key"], "cnt_part_groups", hot_rows, F.col("_print"))
    short = F.coalesce("latest_part_count", F.lit(0)) < F.coalesce("expected_part_count", F.lit(0))
    unloaded = F.coalesce("loaded_part_count", F.lit(0)) < F.coalesce("expected_part_count", F.lit(0))
    gap = F.when(short, 1).when(unloaded, 2).otherwise(0)
    return checked.select("_print", gap.alias("_verdict")).unionByName(keyed.filter("NOT _asks").select("_print", F.lit(0).alias("_verdict")))


def decide(inventory: DataFrame, given: DataFrame) -> DataFrame:
    """New snapshot of the inventory with the given verdicts, met in one join on the unique fingerprint, which travels packed.

    Where the inventory has a ``dq_status``, only files that passed or were not evaluated are promoted.
    """
    rows = inventory.withColumn("_print", packed(F.col("file_fingerprint"))).drop("file_fingerprint").join(given, "_print", "left").withColumn(
        "file_fingerprint", unpacked(F.col("_print")))
    parsed, won = F.coalesce(F.col("parse_status") == "PARSED", F.lit(False)), F.col("_verdict").isNotNull()
    loaded, filled = F.coalesce(F.col("load_status") == "LOADED_BRONZE", F.lit(True)), F.coalesce("cnt_row_bronze", F.lit(0)) > 0
    fit = F.coalesce("dq_status", F.lit("NOT_EVALUATED")).isin(*DQ_PROMOTABLE) if "dq_status" in inventory.columns else F.lit(True)
    # a conjunction without NULL: who asks for ready files only has it checked term by term on both sides, before they are shuffled
    ready = parsed & loaded & filled & fit & F.coalesce(F.col("_verdict") == 0, F.lit(False))
    reason = (
        F.when(~parsed, F.coalesce("parse_reason", F.lit(REASON_PARSE)))
        .when(~won, REASON_SUPERSEDED)
        .when(~loaded, REASON_NOT_LOADED)
        .when(~filled, REASON_ZERO_ROWS)
        .when(F.col("_verdict") == 1, REASON_INCOMPLETE)
        .when(F.col("_verdict") == 2, REASON_PARTS_NOT_LOADED)
        .when(~fit, REASON_DQ)
        .otherwise(REASON_READY)
    )
    return rows.withColumns({
        "flg_latest": yn(parsed & won),
        "flg_superseded": yn(parsed & ~won),
        "flg_legit_for_silver": yn(ready),
        "promote_status": F.when(ready, "READY_FOR_SILVER").otherwise("NOT_READY"),
        "status_reason": reason,
    }).select(*inventory.columns)


def adjudicate(inventory: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """New snapshot with the latest, superseded, legit, promotion and reason columns decided."""
    return decide(inventory, verdicts(inventory, hot_rows))


def finalize_summary(inventory: DataFrame) -> DataFrame:
    """All counts of the finalize stage per feed in one pass."""
    return inventory.groupBy("feed_key").agg(
        F.count(F.lit(1)).alias("inventory_row_count"),
        F.count_if(F.col("flg_latest") == "Y").alias("latest_file_count"),
        F.count_if(F.col("flg_superseded") == "Y").alias("superseded_file_count"),
        F.count_if(F.col("flg_legit_for_silver") == "Y").alias("legit_file_count"),
        F.count_if(F.col("promote_status") == "READY_FOR_SILVER").alias("ready_for_silver_count"),
        F.coalesce(F.sum("cnt_row_bronze"), F.lit(0)).alias("total_bronze_rows"),
    )


def manifest_summary(inventory: DataFrame) -> DataFrame:
    return inventory.groupBy("feed_key").agg(
        F.count(F.lit(1)).alias("inventory_row_count"),
        F.count_if(F.col("parse_status") == "PARSED").alias("parsed_file_count"),
        F.count_if(F.col("parse_status") == "PARSE_FAILED").alias("parse_failed_file_count"),
    )


def backfill_progress(inventory: DataFrame, date_from: str, date_to: str) -> DataFrame:
    return inventory.filter(F.col("file_date").between(F.lit(date_from).cast("date"), F.lit(date_to).cast("date"))).groupBy(
        "feed_key", "load_status").agg(F.count(F.lit(1)).alias("cnt_files"))


def reconcile(inventory: DataFrame, bronze_counts: DataFrame) -> DataFrame:
    """Files whose recorded load differs from what bronze holds, with the kind of difference."""
    claims = inventory.filter(F.col("load_status") == "LOADED_BRONZE").select(
        "file_fingerprint", F.coalesce("cnt_row_bronze", F.lit(0)).alias("cnt_claimed"))
    both = claims.join(bronze_counts.withColumnRenamed("src_file_fingerprint", "file_fingerprint"), "file_fingerprint", "full_outer")
    claimed, found = F.col("cnt_claimed"), F.coalesce("cnt_row_bronze", F.lit(0))
    kind = F.when(claimed.isNull(), "NOT_IN_INVENTORY").when((claimed > 0) & (found == 0), "MISSING_IN_BRONZE").when(
        claimed != found, "COUNT_MISMATCH")
    return both.select("file_fingerprint", "cnt_claimed", found.alias("cnt_found"), kind.alias("difference")).filter("difference IS NOT NULL")


def reset_feed(inventory: DataFrame, feed_key: str, sets: dict[str, Column]) -> DataFrame:
    return update_where(inventory, F.col("feed_key") == feed_key, sets)
