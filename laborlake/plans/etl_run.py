"""End-to-end run (X5): extract -> bronze -> validate -> silver -> gold, with run events.

``extract`` (S6) routes a source name to its reader:
  'kafka' -> topic messages (Kafka, or the JSON-lines twin) decoded to content events; messages that
             did not parse are landed as bronze dead letters, those without a key go on to the validation
  'api'   -> landed API pages flattened to labor-log records (feeds silver.labor_logs)
  'file'  -> a CSV file or folder of CSV files
Anything else raises ValueError.

Bronze keeps every run and has the same content types for all sources. Silver and gold hold the
current run and are overwritten. Intermediate frames are Parquet under the run's staging folder, removed
at the end; every one is computed once and read by all that need it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laborlake.functions.expressions import conform_content
from laborlake.operators import gold, quality, silver
from laborlake.operators.quality import ValidationError, failure_reason
from laborlake.plans.monitor import RunEvents, counted
from laborlake.schemas import BAD_ENCODING, RULE_COLUMNS
from laborlake.sinks.lake import Lake, write_csv
from laborlake.sinks.warehouse import insert, with_log_id
from laborlake.sources import files, pages, topic

SOURCES = ("kafka", "api", "file")


@dataclass
class SourceConfig:
    topic_path: str | None = None          # JSON-lines twin folder, or bootstrap servers for kafka
    topic_format: str = "text"             # "text" (twin) or "kafka"
    topic_name: str | None = None
    pages_path: str | None = None          # landed API pages (JSON lines)
    csv_path: str | None = None            # file or folder


def _decoded(spark: SparkSession, cfg: SourceConfig) -> DataFrame:
    return topic.decode_events(topic.read_topic(spark, cfg.topic_path, fmt=cfg.topic_format, topic=cfg.topic_name))


def extract(spark: SparkSession, source: str, cfg: SourceConfig) -> DataFrame:
    """Source name -> raw DataFrame."""
    if source == "kafka":
        return topic.split_dead_letters(_decoded(spark, cfg), null_key=False)[0]
    if source == "api":
        return pages.records_to_frame(pages.flatten_pages(pages.read_landed_pages(spark, cfg.pages_path)))
    if source == "file":
        path = cfg.csv_path
        read = files.ingest_csv_file if path.endswith(".csv") else files.ingest_folder
        return read(spark, path, arrival=True, flags=True)
    raise ValueError(f"Unsupported source: {source}")


def run_pipeline(spark: SparkSession, source: str | DataFrame, lake: Lake, cfg: SourceConfig | None = None,
                 strict: bool = True, pipeline: str = "content_etl", csv_export: str | None = None,
                 tables: str | None = None) -> dict:
    """Run one batch; returns {run_id, report, paths}. ``strict`` aborts on a failed validation.

    With ``strict=False`` the rows a failed check points at are not loaded: X2's
    null drop removes them from silver and the table rules quarantine the rest.
    ``tables``: prefix of the warehouse databases to load too (see ``create_tables``).
    """
    events = RunEvents(spark, pipeline, f"{lake.root}/ops/run_events")
    try:
        with events:
            if source == "api":
                return _run_labor_logs(extract(spark, source, cfg), lake, events, tables)
            return _run_content(spark, source, lake, cfg or SourceConfig(), strict, events, csv_export, tables)
    finally:
        lake.drop_stages(events.run_id)


def _to_bronze(spark: SparkSession, source: str | DataFrame, lake: Lake, cfg: SourceConfig, events: RunEvents) -> DataFrame:
    """Land the source's rows in bronze; the run's rows as landed."""
    if source == "kafka":
        text = F.when(topic.is_dead(null_key=False), F.col("value")).alias("value")  # only dead letters keep it
        decoded = _decoded(spark, cfg)
        decoded = lake.stage(decoded.withColumn("value", text), events.run_id, "decoded")
        raw, dead = topic.split_dead_letters(decoded, null_key=False)
        dead, n_dead = counted(dead, "dead_letters")
        lake.write_bronze(dead, "dead_letters", run_id=events.run_id, source_system="kafka")
        events.record("STAGE", "DeadLetters", "SUCCESS", n_dead.get["rows"])
    else:
        raw = source if isinstance(source, DataFrame) else extract(spark, source, cfg)
    lake.write_bronze(conform_content(raw), "content_events", run_id=events.run_id,
                      source_system=source if isinstance(source, str) else "frame")
    return lake.read_bronze("content_events", events.run_id)


def _run_content(spark: SparkSession, source: str | DataFrame, lake: Lake, cfg: SourceConfig, strict: bool,
                 events: RunEvents, csv_export: str | None, tables: str | None) -> dict:
    raw = _to_bronze(spark, source, lake, cfg, events)
    columns, broken = raw.drop("source_system", "ingested_at"), None
    if BAD_ENCODING in columns.columns:
        broken = silver.broken_rows(columns)
        columns = columns.where(~F.col(BAD_ENCODING))
    missing = [c for c in quality.REQUIRED_COLUMNS if c not in columns.columns]  # raw names: V1 comes before X2 renames
    if missing:  # V1 stops before any grouping
        grouped = None
        passed, report = quality.validate(columns)
    else:
        # One shuffle by content_id feeds both the report and the de-duplication.
        grouped, packed, cols = silver.group_raw(columns)
        grouped = lake.stage(grouped, events.run_id, "grouped")
        passed, report = quality.validate(columns, report=quality.report_from_per_key(grouped))
    events.record("STAGE", "Extract", "SUCCESS", report["total_rows"])
    events.record("VALIDATION", "Validate", "PASSED" if passed else "FAILED", report["duplicate_count"])
    for w in report["warnings"]:
        events.record("WARNING", "Validate", message=w)
    if not passed:
        events.record("ERROR", "Validate", "FAILED", message=failure_reason(report))
        if strict or grouped is None:
            raise ValidationError(failure_reason(report))
    first = silver.silver_from_grouped(grouped, packed, cols)
    repeated = lake.stage(quality.repeated_keys(first, "content_id"), events.run_id, "repeated_keys")
    tagged = quality.apply_rules(first, [*quality.content_rules(), quality.hours_type_rule()], key="content_id", repeated=repeated)
    if broken is not None:
        tagged = tagged.unionByName(quality.apply_rules(broken, [quality.utf8_rule()]), allowMissingColumns=True)
    tagged = lake.stage(tagged, events.run_id, "tagged")
    accepted, n_ok = counted(tagged.where(F.size("violations") == 0).drop("violations", *RULE_COLUMNS), "silver_rows")
    rejected, n_bad = counted(tagged.where(F.size("violations") > 0), "quarantined_rows")
    silver_path = lake.write_silver(accepted, "content_events_clean")
    lake.write_silver(rejected, "content_events_quarantine", partition_by=())
    rows = n_ok.get["rows"]
    events.record("STAGE", "Quarantine", "SUCCESS", n_bad.get["rows"])
    events.record("STAGE", "Transform", "SUCCESS", rows)
    s = lake.read_layer("silver", "content_events_clean")
    paths = {"bronze": lake.path("bronze", "content_events"), "silver": silver_path}
    # Silver is scanned once; the gold frames are aggregates of the few rows of its group state.
    state = lake.stage(gold.group_state(s), events.run_id, "group_state")
    for name, frame in gold.gold_frames(state).items():
        paths[name] = lake.write_gold(frame, name)
    if csv_export:  # K3: the silver rows as CSV with a header (a folder of part files)
        paths["csv"] = write_csv(s, csv_export)
    if tables is not None:
        ok, _ = quality.split_by_rules(silver.bronze_table_rows(raw), quality.bronze_rules())
        insert(spark, f"{tables}bronze.content_events_raw", ok)
        insert(spark, f"{tables}silver.content_events_clean", s, overwrite=True)
        insert(spark, f"{tables}gold.department_labor_summary", lake.read_layer("gold", "department_labor_summary"), overwrite=True)
        insert(spark, f"{tables}gold.category_summary", lake.read_layer("gold", "category_summary_table"), overwrite=True)
    events.record("STAGE", "Load", "SUCCESS", rows)
    events.record("END", status="SUCCESS", rows=rows)
    return {"run_id": events.run_id, "report": report, "paths": paths}


def _run_labor_logs(records: DataFrame, lake: Lake, events: RunEvents, tables: str | None) -> dict:
    landed, n_in = counted(records, "labor_records")
    keyed = with_log_id(landed)  # in files by now, so it may be read again
    repeated = lake.stage(quality.repeated_keys(keyed, "log_id"), events.run_id, "repeated_keys")
    tagged = quality.apply_rules(keyed, quality.labor_log_rules(), key="log_id", repeated=repeated)
    events.record("STAGE", "Extract", "SUCCESS", n_in.get["rows"])
    ok, n_ok = counted(tagged.where(F.size("violations") == 0).drop("violations"), "labor_rows")
    bad, n_bad = counted(tagged.where(F.size("violations") > 0), "labor_quarantine")
    path = lake.write_silver(ok.withColumn("processed_at", F.current_timestamp()), "labor_logs", partition_by=())
    lake.write_silver(bad, "labor_logs_quarantine", partition_by=())
    events.record("VALIDATION", "Validate", "PASSED", n_bad.get["rows"])
    if tables is not None:
        insert(records.sparkSession, f"{tables}silver.labor_logs", lake.read_layer("silver", "labor_logs"), overwrite=True)
    events.record("STAGE", "Load", "SUCCESS", n_ok.get["rows"])
    events.record("END", status="SUCCESS", rows=n_ok.get["rows"])
    return {"run_id": events.run_id, "report": None, "paths": {"labor_logs": path}}
