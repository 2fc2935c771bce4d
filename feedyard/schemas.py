"""Table schemas and fixed vocabularies."""
from __future__ import annotations

# Column names and types of every table, in table order.
BRONZE_TECHNICAL = (
    "feed_key string, request_id string, dispatch_run_id string, src_file_name string, "
    "src_file_path string, src_file_fingerprint string, ts_ingest timestamp"
)

CONFIG = (
    "feed_key string, feed_sub_key string, ctl_active string, ctl_auto_trigger string, ctl_sync_config string, "
    "ctl_maintenance_hold_until string, src_file_regex string, src_file_capture_spec string, src_subdir string, "
    "src_uri string, ctl_demo_seed_policy string, dir_request string, dir_temp string, dir_discovery string, "
    "src_file_delimiter string, src_file_has_header string, tgt_bronze_table string, tgt_silver_table string, "
    "tgt_gold_table string, tgt_volume string, batch_max_files int, batch_max_size_gb double, "
    "sched_selector_type string, sched_lookback_minutes int, sched_cron string, sched_timezone string, "
    "sys_default_request_json string, schema_read_policy string, notify_recipients string, "
    "tgt_bronze_partition_cols string"
)
CONFIG_PROVENANCE = "config_source_file string, uc_source_dir string, dispatch_run_id string"

INVENTORY = (
    "feed_key string, request_id string, dispatch_run_id string, feed_sub_key string, file_name string, "
    "file_path string, file_fingerprint string, file_size bigint, src_size bigint, src_mtime_ms bigint, "
    "vendor_code string, lob_code string, file_date date, file_part_seq int, file_part_tot int, "
    "file_version_label string, file_version_rank int, file_extension string, delivery_group_key string, "
    "part_group_key string, parse_status string, parse_reason string, ts_discovered timestamp, "
    "load_status string, cnt_row_bronze bigint, flg_latest string, flg_superseded string, "
    "flg_legit_for_silver string, promote_status string, status_reason string"
)

JOB_LOG = (
    "event_id string, request_id string, task_name string, task_status string, feed_key string, "
    "status_reason string, dispatch_run_id string, ts_event timestamp"
)
FILE_LOG = (
    "event_id string, request_id string, file_path string, file_fingerprint string, file_name string, "
    "feed_key string, stage_name string, stage_status string, vendor_code string, lob_code string, "
    "file_date date, file_part_seq int, file_part_tot int, file_version_label string, file_version_rank int, "
    "file_extension string, status_reason string, cnt_row_written bigint, dispatch_run_id string, ts_event timestamp"
)
SCHEMA_CHANGE_LOG = (
    "event_id string, request_id string, file_path string, file_fingerprint string, file_name string, "
    "feed_key string, target_table string, source_columns_csv string, target_columns_csv string, "
    "missing_in_file array<string>, new_in_file array<string>, change_detected string, status_reason string, "
    "dispatch_run_id string, ts_event timestamp"
)
REQUEST_LOG = (
    "request_id string, feed_key string, dispatch_run_id string, request_type string, request_payload_json string, "
    "request_status_struct struct<status_code:string,status_ts:timestamp>, arr_paths_requested array<string>, "
    "arr_paths_pattern_valid array<string>, arr_paths_pattern_invalid array<string>, arr_paths_exist array<string>, "
    "arr_paths_missing array<string>, arr_paths_blocked_recent array<string>, arr_paths_already_done array<string>, "
    "arr_paths_ready array<string>, arr_paths_in_inventory array<string>, arr_paths_not_in_inventory array<string>, "
    "arr_paths_final_eligible array<string>, arr_paths_final_rejected array<string>, "
    "arr_batch_inputs array<struct<batch_id:string,batch_file_paths_json:string,file_count:int,total_size_bytes:bigint>>, "
    "ts_created timestamp, ts_updated timestamp"
)
DISCOVERY_LOG = (
    "event_id string, request_id string, feed_key string, file_path string, file_fingerprint string, "
    "file_name string, request_payload_json string, status_reason string, dispatch_run_id string, ts_event timestamp"
)
NOTIFICATIONS = (
    "event_id string, severity string, category string, event_type string, feed_key string, "
    "dispatch_run_id string, request_id string, message string, details_json string, "
    "resolved_recipients string, ts_event timestamp"
)
DISPATCH_STATE = (
    "feed_key string, feed_sub_key string, last_dispatched_at timestamp, next_dispatched_at timestamp, "
    "dispatch_run_id string"
)
DQ_RULES = (
    "feed_key string, rule_name string, rule_tier int, depends_on string, rule_type string, rule_expression string, "
    "action_on_failure string, threshold_pct double, is_active string, config_source_file string, ts_synced timestamp"
)
DQ_RESULTS = (
    "event_id string, feed_key string, file_name string, file_fingerprint string, rule_name string, rule_tier int, "
    "rule_type string, rule_expression string, action_on_failure string, cnt_total bigint, cnt_pass bigint, "
    "cnt_fail bigint, pct_fail double, threshold_pct double, threshold_breached string, outcome string, "
    "skip_reason string, request_id string, dispatch_run_id string, ts_evaluated timestamp"
)
DQ_VIOLATIONS = (
    "violation_id string, quarantine_id string, feed_key string, file_name string, file_fingerprint string, "
    "src_row_number bigint, rule_name string, rule_tier int, rule_type string, rule_expression string, "
    "columns_violated string, column_values string, ts_evaluated timestamp"
)

TABLES = {
    "config": CONFIG + ", " + CONFIG_PROVENANCE,
    "inventory": INVENTORY,
    "job_log": JOB_LOG,
    "file_log": FILE_LOG,
    "schema_change_log": SCHEMA_CHANGE_LOG,
    "request_log": REQUEST_LOG,
    "discovery_log": DISCOVERY_LOG,
    "notifications": NOTIFICATIONS,
    "dispatch_state": DISPATCH_STATE,
    "dq_rules": DQ_RULES,
    "dq_results": DQ_RESULTS,
    "dq_violations": DQ_VIOLATIONS,
}

# Allowed severities, categories and event types of notifications.
SEVERITIES = ("INFO", "WARNING", "ERROR")
CATEGORIES = ("DISPATCHER", "INGESTION", "CONFIG", "SCHEMA", "PARSE")
EVENT_TYPES = (
    "DUPLICATE_CONFIG_RESOLVED", "EMPTY_CONFIG", "NO_ELIGIBLE_FILES", "SCHEMA_DRIFT_DETECTED",
    "SCHEMA_SEED_MISSING", "PARSE_FAILED", "TRIGGER_FAILED", "TRIGGER_SKIPPED", "JOB_RESOLVE_FAILED",
    "AUTO_TRIGGER_DISABLED", "ACTIVE_RUN_GUARD", "ENV_POLICY_VIOLATION",
)
DQ_EVENT_TYPES = ("DQ_THRESHOLD_BREACHED", "DQ_ROWS_DROPPED", "DQ_FILE_FAILED", "DQ_ROWS_QUARANTINED")


def fields(ddl: str) -> list[tuple[str, str]]:
    """Name and type pairs of a DDL text, splitting only at top-level commas."""
    out, depth, part = [], 0, ""
    for ch in ddl + ",":
        depth += (ch == "<") - (ch == ">")
        if ch == "," and depth == 0:
            name, kind = part.strip().split(" ", 1)
            out.append((name, kind))
            part = ""
        else:
            part += ch
    return out


def names(ddl: str) -> list[str]:
    return [n for n, _ in fields(ddl)]
