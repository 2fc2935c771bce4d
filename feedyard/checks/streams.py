"""Streams over files of the given tables, run until all input is taken."""
from __future__ import annotations

from unittest import mock

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from feedyard import schemas
from feedyard.checks import dropzone, views as v
from feedyard.checks.loading import _CUST, _ROWS, _feed
from feedyard.functions.fingerprints import enrich_listing
from feedyard.operators import bronze, commits, inventory, lineage, logs
from feedyard.session import stable, work_dir
from feedyard.sources.listing import list_files
from feedyard.streaming import flows, tracking

QUERIES, ORACLES = {}, {}


def query(sql_text: str | None = None):
    def keep(fn):
        QUERIES[fn.__name__] = fn
        if sql_text:
            ORACLES[fn.__name__] = sql_text
        return fn
    return keep


def _log_folder(spark, sf_dir):
    """The event log as files that arrive in order of time, one write per quarter of the span."""
    path = work_dir(spark, "eventlog")
    log = v.event_log(spark, sf_dir)
    span = log.agg(F.min(F.unix_seconds("ts_event")).alias("a"), F.max(F.unix_seconds("ts_event")).alias("b")).first()
    part = F.floor((F.unix_seconds("ts_event") - span["a"]) * 4 / (span["b"] - span["a"] + 1))
    for i in range(4):
        log.filter(part == i).write.mode("append").parquet(path)
    return path, log.schema


def _log_stream(spark, sf_dir, per_trigger=None):
    """A stream of the log; unless told otherwise each micro-batch takes a quarter of the files, however many they are."""
    path, schema = _log_folder(spark, sf_dir)
    per_trigger = per_trigger or -(-len(spark.read.parquet(path).inputFiles()) // 4)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(path)


@query(v.sql("", _ROWS, _CUST))
def stream_ingest(spark, sf_dir):
    bronze_path = work_dir(spark, "bronze")
    flows.ingest_arrivals(spark, _feed(), dropzone.dropped(spark, sf_dir), bronze_path, work_dir(spark, "logs"), work_dir(spark, "cp"), v.NOW)
    rows = bronze.read_bronze(spark, bronze_path)
    return rows.select("custkey", "name", "nation", "segment", F.col("`d.e`").alias("de"), "src_file_name")


@query(v.sql("", """SELECT 'customers_' || chunk || '.txt' AS file_name, 'LOADED_BRONZE' AS load_status, count(*) AS cnt, count(*) AS rows_held, 1 AS started, 1 AS ended, 1 AS loaded,
  CASE kind WHEN 2 THEN 'missing_in_file=segment' WHEN 1 THEN 'missing_in_file=nation,d.e' ELSE 'missing_in_file=d.e' END AS drift,
  CASE WHEN chunk % 2 = 0 THEN 'known' ELSE 'new' END AS vendor, 'custkey,name,nation,segment,d.e' AS column_list FROM v_cust GROUP BY chunk, kind""", _CUST))
def stream_lifecycle(spark, sf_dir):
    """Two micro-batches, the first of which dies after it wrote rows and logs and before its manifest, and is repeated.

    Every file has its rows once, one start, one end, one drift record and one inventory row; files of even number were in the inventory before.
    """
    folder = dropzone.dropped(spark, sf_dir)
    table, log, checkpoint = (work_dir(spark, k) for k in ("bronze", "logs", "cp"))
    listed = stable(enrich_listing(list_files(spark, folder)))
    half = -(-listed.count() // 2)

    def run():
        flows.ingest_arrivals(spark, _feed(), folder, table, log, checkpoint, v.NOW, per_batch=half, policy="SEED", seed=["custkey", "name", "nation", "segment", "d.e"])

    with mock.patch.object(commits, "publish", side_effect=RuntimeError("killed")):
        try:
            run()
        except StreamingQueryException:
            pass
    died = spark.read.parquet(f"{log}/job_log").count() == 1 and commits.manifests(spark, table) is None and bronze.read_bronze(spark, table).isEmpty()
    if not died:
        raise AssertionError("the first micro-batch was to die before its manifest")
    run()
    even = F.pmod(F.regexp_extract("file_name", r"_(\d+)\.", 1).cast("int"), F.lit(2)) == 0
    before = listed.filter(even).withColumns({"load_status": F.lit("DISCOVERED"), "vendor_code": F.lit("known")})
    have = set(before.columns)
    known = before.select([(F.col(n) if n in have else F.lit(None)).cast(t).alias(n) for n, t in schemas.fields(schemas.INVENTORY)])
    state = inventory.with_loads(known, commits.loaded_files(spark, table))
    events = logs.read_log(spark, f"{log}/file_log", table).groupBy("file_fingerprint").agg(*[
        F.count_if((F.col("stage_name") == stage) & (F.col("stage_status") == status)).cast("int").alias(name)
        for name, stage, status in (("started", "INGEST_CONTROL", "STARTED"), ("ended", "INGEST_CONTROL", "SUCCEEDED"), ("loaded", "BRONZE_LOAD", "SUCCEEDED"))])
    drifts = logs.read_log(spark, f"{log}/schema_change_log", table).groupBy("file_fingerprint").agg(F.array_join(F.collect_list("status_reason"), "/").alias("drift"))
    rows = bronze.read_bronze(spark, table).groupBy(F.col("src_file_fingerprint").alias("file_fingerprint")).agg(F.count(F.lit(1)).alias("rows_held"))
    out = state.join(events, "file_fingerprint", "left").join(drifts, "file_fingerprint", "left").join(rows, "file_fingerprint", "left")
    return out.select("file_name", "load_status", F.col("cnt_row_bronze").alias("cnt"), "rows_held", "started", "ended", "loaded", "drift",
                      F.when(F.col("vendor_code") == "known", "known").otherwise("new").alias("vendor"), F.lit(",".join(commits.known_columns(spark, table))).alias("column_list"))


@query(v.sql("event_log", "SELECT DISTINCT file_fingerprint FROM v_event_log WHERE file_fingerprint <> ''"))
def stream_dedup(spark, sf_dir):
    """With a window longer than the data each fingerprint comes through once, over all micro-batches."""
    out = work_dir(spark, "dedup")
    stream = _log_stream(spark, sf_dir).filter("file_fingerprint <> ''")
    flows.run_to_parquet(flows.drop_known_files(stream, within="60 days").select("file_fingerprint"), out, work_dir(spark, "cp"))
    return spark.read.parquet(out)


@query(v.sql("event_log", """SELECT identity FROM (SELECT identity, stage_status, ts_event, row_number() OVER (PARTITION BY identity ORDER BY ts_event DESC, event_id DESC) AS rn
  FROM (SELECT *, CASE WHEN file_fingerprint = '' THEN file_path ELSE file_fingerprint END AS identity FROM v_event_log WHERE stage_name = 'INGEST_CONTROL'))
WHERE rn = 1 AND stage_status = 'STARTED' AND ts_event >= (SELECT max(ts_event) FROM v_event_log WHERE stage_name = 'INGEST_CONTROL') - INTERVAL 48 HOUR"""))
def stream_blocked(spark, sf_dir):
    """The state of the stream itself, after four micro-batches."""
    checkpoint = work_dir(spark, "latest")
    tracking.track_latest(_log_stream(spark, sf_dir).filter("stage_name = 'INGEST_CONTROL'"), checkpoint)
    return tracking.current_blocked(spark, checkpoint)


_COUNTS = v.sql("event_log", "SELECT date_trunc('hour', ts_event) AS hour_start, stage_name, stage_status, count(*) AS cnt FROM v_event_log GROUP BY 1, 2, 3")


@query(_COUNTS)
def stream_stage_counts(spark, sf_dir):
    """All windows, closed and open, after the micro-batches; files arrive in order of time, so no event is late."""
    out, checkpoint = work_dir(spark, "counts"), work_dir(spark, "cp")
    tracking.count_stages(flows.stage_counts(_log_stream(spark, sf_dir, 1_000_000)), out, checkpoint)
    return tracking.counted_stages(spark, out, checkpoint)


@query(_COUNTS)
def stage_counts(spark, sf_dir):
    return lineage.stage_counts(v.event_log(spark, sf_dir))
