"""Registered queries: each ``(spark, sf_dir) -> DataFrame`` runs an operator on the whole driver tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laborlake.operators import gold, quality, reports, silver
from laborlake.schemas import API_PAGE_SIZE, HOURS_TEXT, REQUIRED_COLUMNS
from laborlake.session import fresh_path
from laborlake.sinks.lake import Lake, write_csv
from laborlake.sinks.warehouse import bucket_for_variance, create_tables, insert, with_log_id
from laborlake.sources import files, pages, tables, topic
from laborlake.streaming import ingest
from laborlake.plans import etl_run, monitor
from laborlake.plans.increments import Increments

Query = Callable[[SparkSession, str], DataFrame]


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.content_events(spark, sf_dir)


def _report(fn) -> Query:
    return lambda spark, sf_dir: fn(_silver(spark, sf_dir))


def report_hours_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.hours_variance(_silver(spark, sf_dir), tables.labor_records(spark, sf_dir))


def validation_report_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = tables.content_events_raw(spark, sf_dir)
    return _report_counts(quality.validation_report(raw))


def _report_counts(rep: DataFrame) -> DataFrame:
    counts = [F.col("null_counts")[c].alias(f"null_{c}") for c in REQUIRED_COLUMNS]
    return rep.select("total_rows", "duplicate_count", "invalid_labor", *counts, "passed",
                      F.size("warnings").alias("warning_count"))


# processed_at of a silver run is the run's clock; the registered form pins it to the
# event time so that two runs of the same query agree.
def silver_content_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = tables.content_events_raw(spark, sf_dir)
    return silver.build_silver(raw, processed_at=F.col("event_timestamp"))


def _x1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.transform_content_events(tables.content_events_raw(spark, sf_dir))


def spark_transform_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _x1(spark, sf_dir).drop("ingest_seq")


def x1_labor_by_department(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 over X1 of the raw events: the null-department group is kept (SQL semantics)."""
    return gold.aggregate_labor_by_department(_x1(spark, sf_dir))


def x1_department_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3 over X1 of the raw events: the null-department group is dropped (pandas semantics)."""
    return gold.department_summary(_x1(spark, sf_dir))


def constraint_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = silver_content_events(spark, sf_dir)
    _, bad = quality.split_by_rules(s, quality.content_rules(), key="content_id")
    return bad.select("content_id", "labor_hours", "labor_flag",
                      F.array_join(F.array_sort("violations"), ",").alias("violation"))


def constraint_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = silver_content_events(spark, sf_dir)
    ok, _ = quality.split_by_rules(s, quality.content_rules(), key="content_id")
    return ok


def gold_department_labor_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.department_labor_summary_table(_silver(spark, sf_dir)).drop("summary_date")


def gold_category_summary_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.category_summary_table(_silver(spark, sf_dir)).drop("summary_date")


def _warehouse(spark: SparkSession, *names: str) -> str:
    """The named tables (all five) in databases of their own; their prefix."""
    prefix = f"q{uuid.uuid4().hex[:12]}_"
    create_tables(spark, fresh_path(spark, "warehouse"), prefix, names or None)
    return prefix


def _table_report(name: str) -> Query:
    """The SQL text of a report over the warehouse tables, loaded from the driver tables."""
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        needs_logs = "{labor_logs}" in reports.REPORT_SQL[name]
        prefix = _warehouse(spark, "silver.content_events_clean", *["silver.labor_logs"] * needs_logs)
        insert(spark, f"{prefix}silver.content_events_clean", _silver(spark, sf_dir))
        if needs_logs:
            insert(spark, f"{prefix}silver.labor_logs", with_log_id(tables.labor_records(spark, sf_dir)))
        return reports.report_from_sql(spark, name, prefix)
    return q


def warehouse_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns that an insert leaves out have their defaults when read back."""
    names = ["silver.content_events_clean", "gold.department_labor_summary", "gold.category_summary"]
    prefix = _warehouse(spark, *names)
    ce = _silver(spark, sf_dir)
    frames = [ce.drop("pipeline_layer", "processed_at"), gold.department_labor_summary_table(ce).drop("summary_date"),
              gold.category_summary_table(ce).drop("summary_date")]
    for name, frame in zip(names, frames, strict=True):
        insert(spark, prefix + name, frame)
    given = [(F.col("pipeline_layer") == "silver") & (F.abs(F.unix_timestamp("processed_at") - F.unix_timestamp()) < 86400)]
    given += [F.abs(F.datediff("summary_date", F.current_date())) <= 1] * 2
    counts = [spark.table(prefix + n).agg(F.count(F.lit(1)).alias("row_count"), F.count_if(g).alias("with_defaults"))
              .select(F.lit(n).alias("name"), "row_count", "with_defaults") for n, g in zip(names, given, strict=True)]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


def variance_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R7 over tables bucketed alike: no shuffle under the join."""
    content, logged = bucket_for_variance(_silver(spark, sf_dir), tables.labor_records(spark, sf_dir),
                                          fresh_path(spark, "warehouse"), f"q{uuid.uuid4().hex[:12]}_")
    return reports.hours_variance_from_sums(content.hint("merge"), logged)


def _increments(spark: SparkSession, sf_dir: str) -> Increments:
    """The raw events in three batches, a key's deliveries in any of them and in any order."""
    held = Increments(spark, fresh_path(spark, "increments"), ["ingest_seq"])
    raw = tables.content_events_raw(spark, sf_dir)
    for b in range(3):
        held.add(raw.where(F.pmod(F.xxhash64("content_id", "ingest_seq"), F.lit(3)) == b), b)
    return held


def increments_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1, maxima included, after three batches."""
    return gold.labor_by_department_from_state(gold.state_from_support(_increments(spark, sf_dir).support()))


def increments_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V2-V6 over three batches, from their counters."""
    return _report_counts(_increments(spark, sf_dir).report())


# ---- sources ---------------------------------------------------------------------------------

LEGACY_A = ["content_id", "title", "category", "department", "labor_hours", "region"]
LEGACY_B = ["region", "labor_hours", "department", "category", "title", "content_id", "release_year"]


def csv_folder_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Content landed as two CSV file groups with different headers, read back by name."""
    ce = _silver(spark, sf_dir)
    folder = fresh_path(spark, "landing", "csv")
    finished = F.col("event_type") == "F"
    (ce.where(finished).select(*LEGACY_A)
     .write.option("header", True).csv(folder))
    (ce.where(~finished).withColumn("release_year", F.year("event_timestamp")).select(*LEGACY_B)
     .write.mode("append").option("header", True).csv(folder))
    return files.ingest_folder(spark, folder).drop("source_file", HOURS_TEXT)


def _landed_lines(spark: SparkSession, lines: DataFrame, header: str, parts: int = 8) -> str:
    """Raw text lines (``key``, ``value``) as files that begin with ``header`` each."""
    folder = fresh_path(spark, "landing", "lines")
    part = F.pmod(F.col("key"), F.lit(parts)).cast("int")
    heads = spark.range(parts).select(F.col("id").cast("int").alias("part"), F.lit(-1).cast("long").alias("key"), F.lit(header).alias("value"))
    rows = lines.select(part.alias("part"), "key", "value").unionByName(heads)
    rows.repartitionById(parts, F.col("part")).sortWithinPartitions("key").select("value").write.text(folder)
    return folder


def csv_quoted_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Doubled quotes, separators and line ends inside quotes."""
    o = tables.table(spark, sf_dir, "orders")
    note = F.when(F.col("o_orderkey") % 3 == 0, F.format_string('"line one\nline %d"', "o_orderkey")).otherwise(F.col("o_orderstatus"))
    line = F.concat_ws(",", F.col("o_orderkey").cast("string"), F.format_string('"He said ""%s"", ok"', "o_orderpriority"), note)
    folder = _landed_lines(spark, o.select(F.col("o_orderkey").alias("key"), line.alias("value")), "id,said,note")
    return files.read_csv(spark, folder, glob="*.txt").select("id", "said", "note")


def csv_bad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long rows and rows with a blank extra field go, short rows are padded, a quoted line end is data."""
    key = F.col("o_orderkey")
    k, kind = key.cast("string"), key % 5
    line = (F.when(kind == 0, F.concat(k, F.lit(",a,b,EXTRA"))).when(kind == 1, F.concat(k, F.lit(",a")))
            .when(kind == 2, F.concat(k, F.lit(",a,b,"))).when(kind == 3, F.concat(k, F.lit(',"a\na",b')))
            .otherwise(F.concat(k, F.lit(",a,b"))))
    lines = tables.table(spark, sf_dir, "orders").select(key.alias("key"), line.alias("value"))
    return files.read_csv(spark, _landed_lines(spark, lines, "id,x,y"), glob="*.txt").select("id", "x", "y")


def csv_blank_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that begin with blank lines, and blank lines between the rows."""
    o = tables.table(spark, sf_dir, "orders")
    gap = F.when(F.col("o_orderkey") % 3 == 0, F.lit("\n \n")).otherwise(F.lit(""))
    line = F.concat(F.col("o_orderkey").cast("string"), F.lit(","), F.col("o_orderpriority"), gap)
    folder = _landed_lines(spark, o.select(F.col("o_orderkey").alias("key"), line.alias("value")), "\n\t\nid,priority")
    return files.read_csv(spark, folder, glob="*.txt").select("id", "priority")


def csv_bad_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys whose bytes are no UTF-8 are marked; two of them that differ in such a byte only look the same."""
    o = tables.table(spark, sf_dir, "orders")
    # The text sink writes a string's bytes as they are.
    tail = F.when(F.col("o_orderkey") % 4 == 0, F.lit(bytes([0xFF]))).when(F.col("o_orderkey") % 4 == 1, F.lit(bytes([0xC3, 0x28]))).otherwise(
        F.lit("é".encode()))
    key = F.concat(F.encode(F.concat(F.lit("k"), F.floor(F.col("o_orderkey") / 4).cast("string")), "UTF-8"), tail)
    line = F.concat(key, F.encode(F.concat(F.lit(","), F.col("o_orderkey").cast("string")), "UTF-8")).cast("string")
    folder = _landed_lines(spark, o.select(F.col("o_orderkey").alias("key"), line.alias("value")), "key,id")
    return files.read_csv(spark, folder, glob="*.txt").select("key", "id", "bad_encoding")


def csv_large_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Large files (one per 150,000 orders) whose quoted fields hold line ends, each read by as many tasks as it has blocks."""
    o = tables.table(spark, sf_dir, "orders")
    note = F.concat(F.lit('"'), F.repeat(F.concat(F.col("o_orderpriority"), F.lit(', ""so""\n')), 12), F.col("o_orderstatus"), F.lit('"'))
    line = F.concat_ws(",", F.col("o_orderkey").cast("string"), note, F.lit('5" pipe'))
    files_of = max(1, o.count() // 150_000)
    folder = _landed_lines(spark, o.select(F.col("o_orderkey").alias("key"), line.alias("value")), "id,note,size", files_of)
    return files.read_csv(spark, folder, glob="*.txt").select("id", "note", "size")


EXPORTED = ["content_id", "title", "category", "region", "department", "labor_hours", "labor_flag"]


def csv_export_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3 + S5: silver with quotes, separators and line ends in its titles, exported and read back."""
    odd = F.concat(F.lit('He said "'), F.col("title"), F.when(F.col("event_type") == "F", F.lit('",\nok')).otherwise(F.lit('", ok')))
    path = write_csv(_silver(spark, sf_dir).withColumn("title", odd).select(*EXPORTED), fresh_path(spark, "export"))
    return files.ingest_folder(spark, path).select(*EXPORTED)


PAGES_PER_FILE = 2_500


def _write_pages(landed: DataFrame, path: str) -> str:
    """Write pages as JSON lines: compressed, as responses come, in files of bounded size, as each is read by one task."""
    landed.write.option("compression", "gzip").option("maxRecordsPerFile", PAGES_PER_FILE).json(path)
    return path


def _landed_pages(spark: SparkSession, sf_dir: str, change: Callable[[DataFrame], DataFrame] = lambda p: p) -> DataFrame:
    landed = pages.land_pages(tables.labor_records(spark, sf_dir, order=True), ["l_orderkey", "l_linenumber"])
    return pages.read_landed_pages(spark, _write_pages(change(landed), fresh_path(spark, "landing", "pages")))


def api_pages_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of the landed pages before the stop page."""
    return pages.flatten_pages(_landed_pages(spark, sf_dir))


def _middle(spark: SparkSession, sf_dir: str) -> int:
    """A page in the middle of the landed ones, for the stop rules to meet."""
    return max(2, tables.table(spark, sf_dir, "lineitem").count() // (2 * API_PAGE_SIZE))


def pages_stop_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page without results, in the middle."""
    void = F.when(F.col("page") == _middle(spark, sf_dir), F.slice("results", 1, 0)).otherwise(F.col("results"))
    return pages.flatten_pages(_landed_pages(spark, sf_dir, lambda p: p.withColumn("results", void)))


def pages_stop_falsy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page whose ``next`` is the empty text."""
    void = F.when(F.col("page") == _middle(spark, sf_dir) - 1, F.lit("")).otherwise(F.col("next"))
    return pages.flatten_pages(_landed_pages(spark, sf_dir, lambda p: p.withColumn("next", void)))


def pages_stop_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page that did not land."""
    return pages.flatten_pages(_landed_pages(spark, sf_dir, lambda p: p.where(F.col("page") != _middle(spark, sf_dir))))


def labor_logs_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 + K8: records -> silver.labor_logs rows accepted by the table rules (key excluded)."""
    recs = pages.records_to_frame(pages.flatten_pages(_landed_pages(spark, sf_dir)))
    ok, _ = quality.split_by_rules(with_log_id(recs), quality.labor_log_rules(), key="log_id")
    return ok.drop("log_id")


def labor_log_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8: every record has a key of its own, equal ones too, and the keys are 1 to n; a third of the records are one record."""
    recs = tables.labor_records(spark, sf_dir)
    again = recs.where(F.col("role") == "R").select(*[F.lit("hot").cast(f.dataType).alias(f.name) if f.name == "employee_id" else
                                                      F.lit(None).cast(f.dataType).alias(f.name) for f in recs.schema.fields])
    return with_log_id(recs.where(F.col("role") != "R").unionByName(again)).agg(
        F.count(F.lit(1)).alias("row_count"), F.countDistinct("log_id").alias("key_count"), F.min("log_id").alias("first_key"),
        F.max("log_id").alias("last_key"))


def labor_logs_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V7 on silver.labor_logs, with rows that break its rules (made from the line numbers)."""
    recs = tables.labor_records(spark, sf_dir, order=True)
    line = F.col("l_linenumber")
    broken = recs.select(
        F.when(line != 2, F.col("employee_id")).alias("employee_id"),
        F.when(line == 3, F.repeat(F.lit("d"), 101)).otherwise(F.col("department")).alias("department"), "project_id",
        F.when(line == 4, -F.col("hours_logged")).otherwise(F.col("hours_logged")).alias("hours_logged"), "week", "role")
    _, bad = quality.split_by_rules(with_log_id(broken), quality.labor_log_rules(), key="log_id")
    return bad.select("employee_id", "project_id", "hours_logged", F.array_join(F.array_sort("violations"), ",").alias("violation"))


def silver_roundtrip_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 + S7: silver written partitioned by region, read back."""
    lake = Lake(spark, fresh_path(spark, "lake"))
    lake.write_silver(_silver(spark, sf_dir), "content_events_clean")
    return lake.read_layer("silver", "content_events_clean")


def lake_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4/K5 + S8: bronze, silver and gold written, then the rows of every dataset that has files."""
    lake = Lake(spark, fresh_path(spark, "lake"))
    lake.write_bronze(tables.content_events_raw(spark, sf_dir), "content_events", source_system="topic")
    s = _silver(spark, sf_dir)
    lake.write_silver(s, "content_events_clean")
    for name, frame in gold.gold_layer(s).items():
        lake.write_gold(frame, name)
    held = lake.inventory().where("file_count > 0 and total_bytes > 0").select("layer", "dataset")
    return lake.row_counts().join(held, ["layer", "dataset"])


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = tables.content_events_raw(spark, sf_dir)
    return topic.encode_events(raw)


def topic_decode_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON messages of the raw events decoded with the fixed schema."""
    good, _ = topic.split_dead_letters(topic.decode_events(_messages(spark, sf_dir)))
    return good.drop(HOURS_TEXT)


def topic_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Foreign messages on the topic (the ``events`` JSON props) become dead letters."""
    foreign = tables.table(spark, sf_dir, "events").select(F.col("props").alias("value"))
    _, dead = topic.split_dead_letters(topic.decode_events(_messages(spark, sf_dir).unionByName(foreign)))
    return dead.select("value")


def _land(messages: DataFrame, path: str) -> str:
    """Write messages as text files of bounded size: compressed, as topics are kept, and so each read by one task."""
    (messages.write.mode("append").option("compression", "lz4").option("maxRecordsPerFile", tables.ROWS_PER_PART).text(path))
    return path


def _land_by_key(spark: SparkSession, sf_dir: str, path: str) -> str:
    """Land the raw events, all deliveries of a key in one file, in arrival order."""
    raw = tables.content_events_raw(spark, sf_dir).sortWithinPartitions("ingest_seq")
    topic.encode_events(raw).write.mode("append").option("compression", "lz4").text(path)
    return path


def _land_topic(spark: SparkSession, sf_dir: str) -> tuple[str, int]:
    """Land the topic twin: first deliveries, then (a later write) the re-deliveries.

    Returns the folder and the number of first-delivery files, so a stream can take
    them as one micro-batch ahead of the re-deliveries (arrival order of a topic).
    """
    path = fresh_path(spark, "landing", "topic")
    raw = tables.content_events_raw(spark, sf_dir)
    _land(topic.encode_events(raw.where(F.col("ingest_seq") == 0)), path)
    first_files = len(spark.read.text(path).inputFiles())
    _land(topic.encode_events(raw.where(F.col("ingest_seq") > 0)), path)
    return path, first_files


def _share_of_files(spark: SparkSession, path: str, share: float) -> int:
    """Files of a micro-batch, so that the number of batches does not grow with the topic."""
    return max(1, round(len(spark.read.text(path).inputFiles()) * share))


def topic_first_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + D2: all deliveries of a key lie in one file, the later ones with titles that sort before the first."""
    path = _land_by_key(spark, sf_dir, fresh_path(spark, "landing", "topic"))
    good, _ = topic.split_dead_letters(topic.decode_events(topic.read_topic(spark, path)))
    return silver.build_silver(good, processed_at=F.col("event_timestamp"))


def stream_bronze_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T-S1: the topic streamed into bronze (availableNow), silver rebuilt from bronze."""
    src, _ = _land_topic(spark, sf_dir)
    base = fresh_path(spark, "stream")
    q = ingest.start_bronze_ingest(topic.read_topic(spark, src, streaming=True), f"{base}/bronze", f"{base}/_chk_bronze")
    q.awaitTermination()
    return silver.build_silver(ingest.read_bronze(spark, f"{base}/bronze"), processed_at=F.col("event_timestamp"))


def stream_mixed_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T-S1: three micro-batches of files, each with first and repeated deliveries of its keys; silver from bronze."""
    src, base = _land_by_key(spark, sf_dir, fresh_path(spark, "landing", "topic")), fresh_path(spark, "stream")
    q = ingest.start_bronze_ingest(topic.read_topic(spark, src, streaming=True, max_files_per_trigger=_share_of_files(spark, src, 3 / 8)),
                                   f"{base}/bronze", f"{base}/_chk_bronze")
    q.awaitTermination()
    return silver.build_silver(ingest.read_bronze(spark, f"{base}/bronze"), processed_at=F.col("event_timestamp"))


def stream_silver_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T-S2..T-S4: streaming X1 with de-duplication inside the arrival watermark."""
    src, first_files = _land_topic(spark, sf_dir)
    base = fresh_path(spark, "stream")
    q = ingest.start_silver_stream(topic.read_topic(spark, src, streaming=True, max_files_per_trigger=first_files),
                                   f"{base}/silver", f"{base}/_chk_silver", redelivery_window="1 hour")
    q.awaitTermination()
    return spark.read.parquet(f"{base}/silver").drop("arrival_part", "arrival_block", "arrival_pos", "arrived_at")


def stream_exact_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T-S3: deliveries of a key in several micro-batches, the newest files first, so later batches correct earlier answers."""
    src, first_files = _land_topic(spark, sf_dir)
    base = fresh_path(spark, "stream")
    q = ingest.start_exact_silver(topic.read_topic(spark, src, streaming=True, max_files_per_trigger=first_files, latest_first=True),
                                  f"{base}/silver", f"{base}/_chk")
    q.awaitTermination()
    return ingest.read_exact_silver(spark, f"{base}/silver")


def stream_run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1 on a stream: rows and dead letters, recorded per micro-batch, over the whole topic."""
    src, base = _land_dirty_topic(spark, sf_dir), fresh_path(spark, "stream")
    q = ingest.start_bronze_ingest(topic.read_topic(spark, src, streaming=True, max_files_per_trigger=max(6, _share_of_files(spark, src, 1 / 4))), f"{base}/bronze", f"{base}/_chk",
                                   events_path=f"{base}/run_events", run_id="RUN_STREAM")
    q.awaitTermination()
    return spark.read.parquet(f"{base}/run_events").groupBy("stage", "status").agg(F.sum("rows").alias("rows"))


# ---- pipeline and run metrics ------------------------------------------------------------------

def run_department_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events through bronze, validation, silver and gold; the gold frame read back."""
    lake = Lake(spark, fresh_path(spark, "lake"))
    etl_run.run_pipeline(spark, tables.content_events_raw(spark, sf_dir), lake, strict=False)
    return lake.read_layer("gold", "department_summary")


def _run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = Lake(spark, fresh_path(spark, "lake"))
    out = etl_run.run_pipeline(spark, tables.content_events_raw(spark, sf_dir), lake, strict=False)
    return spark.read.parquet(f"{lake.root}/ops/run_events").where(F.col("run_id") == out["run_id"])


def run_event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1/M2: the run-event summary of one non-strict pipeline run (one row)."""
    return monitor.run_summary(_run_events(spark, sf_dir)).drop("run_id")


def run_stage_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1: rows and status of every stage of one non-strict run, from the typed event columns."""
    return _run_events(spark, sf_dir).where("event_type in ('STAGE', 'VALIDATION')").select("stage", "status", "rows")


def run_strict_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V8 and V1 in strict runs: critical nulls, and renamed headers, end the run with their reason; nothing is published."""
    lake, raw = Lake(spark, fresh_path(spark, "lake")), tables.content_events_raw(spark, sf_dir)
    for frame in (raw, raw.withColumnRenamed("content_id", "Content ID").withColumnRenamed("department", "Department")):
        try:
            etl_run.run_pipeline(spark, frame, lake, strict=True)
        except quality.ValidationError:
            continue
        raise AssertionError("the gate let the run pass")
    found = spark.read.parquet(f"{lake.root}/ops/run_events").where("event_type = 'ERROR'")
    return found.select("event_type", "stage", "status", "message", F.lit(len(lake.versions("silver", "content_events_clean"))).alias("published"))


def _land_dirty_topic(spark: SparkSession, sf_dir: str) -> str:
    """The raw events, orders with hours that are no whole number, messages without a key, and broken JSON."""
    path = fresh_path(spark, "landing", "dirty")
    orders, foreign = tables.table(spark, sf_dir, "orders"), tables.table(spark, sf_dir, "events")
    odd = '{"content_id": "%s%d", "title": "t", "category": "c", "region": "r", "department": "d", "labor_hours": %s}'
    words = orders.where("o_orderkey % 50 = 1").select(F.format_string(odd, F.lit("X"), "o_orderkey", F.lit('"ten"')).alias("value"))
    parts = orders.where("o_orderkey % 50 = 2").select(F.format_string(odd, F.lit("Y"), "o_orderkey", F.lit("100.5")).alias("value"))
    broken = foreign.select(F.format_string("{bad %d", "event_id").alias("value"))
    _land_by_key(spark, sf_dir, path)
    rows = words.unionByName(parts).unionByName(broken).unionByName(foreign.select(F.col("props").alias("value")))
    return _land(rows, path)


def _dirty_run(spark: SparkSession, sf_dir: str) -> Lake:
    lake = Lake(spark, fresh_path(spark, "lake"))
    cfg = etl_run.SourceConfig(topic_path=_land_dirty_topic(spark, sf_dir))
    etl_run.run_pipeline(spark, "kafka", lake, cfg, strict=False)
    return lake


def run_topic_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1b in a batch run: messages that did not parse are in bronze, and nowhere else."""
    return _dirty_run(spark, sf_dir).read_layer("bronze", "dead_letters").select("value")


def run_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + V3 in a batch run: messages that parsed without a key are bronze rows and fail the validation."""
    lake = _dirty_run(spark, sf_dir)
    failed = spark.read.parquet(f"{lake.root}/ops/run_events").where("event_type = 'VALIDATION'").select("status")
    nulls = lake.read_bronze("content_events").where("content_id is null").agg(F.count(F.lit(1)).alias("null_keys"))
    return nulls.select("null_keys", F.lit(failed.scalar()).alias("validation"))


def run_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V7 in a batch run: hours of zero or less, and hours that are no whole number, kept with their text."""
    bad = _dirty_run(spark, sf_dir).read_layer("silver", "content_events_quarantine")
    return bad.select("content_id", "labor_hours", HOURS_TEXT, F.array_join(F.array_sort("violations"), ",").alias("violation"))


def run_two_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4 + S6: a topic run, then a file run with a column more, on one lake; bronze holds both."""
    lake, ce = Lake(spark, fresh_path(spark, "lake")), _silver(spark, sf_dir)
    src, _ = _land_topic(spark, sf_dir)
    etl_run.run_pipeline(spark, "kafka", lake, etl_run.SourceConfig(topic_path=src), strict=False)
    path = write_csv(ce.withColumn("release_year", F.year("event_timestamp")).select(*LEGACY_B), fresh_path(spark, "landing", "csv"))
    etl_run.run_pipeline(spark, "file", lake, etl_run.SourceConfig(csv_path=path), strict=False)
    held = lake.read_bronze("content_events").groupBy("source_system").agg(
        F.count(F.lit(1)).alias("row_count"), F.countDistinct("content_id").alias("keys"), F.sum("labor_hours").alias("hours"),
        F.sum("release_year").alias("years"))
    return lake.stage(held, "summary", "sources")


def run_hours_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 + X5 + R7: a content run and an API run load the warehouse tables, the report scans them."""
    lake, prefix = Lake(spark, fresh_path(spark, "lake")), _warehouse(spark)
    etl_run.run_pipeline(spark, tables.content_events_raw(spark, sf_dir), lake, strict=False, tables=prefix)
    landed = pages.land_pages(tables.labor_records(spark, sf_dir, order=True), ["l_orderkey", "l_linenumber"])
    path = _write_pages(landed, fresh_path(spark, "landing", "pages"))
    etl_run.run_pipeline(spark, "api", lake, etl_run.SourceConfig(pages_path=path), tables=prefix)
    return reports.hours_variance(spark.table(f"{prefix}silver.content_events_clean"), spark.table(f"{prefix}silver.labor_logs"))


def warehouse_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the tables that a run loads."""
    prefix = _warehouse(spark)
    etl_run.run_pipeline(spark, tables.content_events_raw(spark, sf_dir), Lake(spark, fresh_path(spark, "lake")), strict=False, tables=prefix)
    names = ["bronze.content_events_raw", "silver.content_events_clean", "gold.department_labor_summary", "gold.category_summary"]
    counts = [spark.table(prefix + n).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("name"), "row_count") for n in names]
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).unionByName(counts[3])


def run_event_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2/A6 over a run-event log derived from ``events``: a user's events form one run."""
    ev = tables.table(spark, sf_dir, "events")
    log = ev.select(F.col("ts").cast("timestamp").alias("timestamp"),
                    F.format_string("RUN_%d", F.col("user_id")).alias("run_id"),
                    F.lit("content_etl").alias("pipeline"),
                    F.upper("event_type").alias("event_type"),
                    F.col("props").alias("message"))
    return monitor.run_summary(log)


QUERIES: dict[str, Query] = {
    "report_labor_by_department": _report(reports.labor_by_department),
    "report_category_region_volume": _report(reports.category_region_volume),
    "report_labor_flag_distribution": _report(reports.labor_flag_distribution),
    "report_monthly_throughput": _report(reports.monthly_throughput),
    "report_top_effort": _report(reports.top_effort),
    "report_above_avg_departments": _report(reports.above_average_departments),
    "report_hours_variance": report_hours_variance,
    "validation_report_counts": validation_report_counts,
    "silver_content_events": silver_content_events,
    "spark_transform_events": spark_transform_events,
    "gold_department_region": _report(gold.aggregate_labor_by_department),
    "gold_category": _report(gold.aggregate_by_category),
    "gold_department_summary": _report(gold.department_summary),
    "gold_category_summary": _report(gold.category_summary),
    "gold_department_total": _report(gold.department_total),
    "x1_labor_by_department": x1_labor_by_department,
    "x1_department_summary": x1_department_summary,
    "constraint_quarantine": constraint_quarantine,
    "constraint_accepted": constraint_accepted,
    "gold_department_labor_summary": gold_department_labor_summary,
    "gold_category_summary_table": gold_category_summary_table,
    "sql_report_labor_by_department": _table_report("labor_by_department"),
    "sql_report_category_region_volume": _table_report("category_region_volume"),
    "sql_report_labor_flag_distribution": _table_report("labor_flag_distribution"),
    "sql_report_monthly_throughput": _table_report("monthly_throughput"),
    "sql_report_top_effort": _table_report("top_effort"),
    "sql_report_above_avg_departments": _table_report("above_avg_departments"),
    "sql_report_hours_variance": _table_report("hours_variance"),
    "variance_bucketed": variance_bucketed,
    "increments_gold": increments_gold,
    "increments_report": increments_report,
    "warehouse_defaults": warehouse_defaults,
    "csv_folder_ingest": csv_folder_ingest,
    "csv_quoted_fields": csv_quoted_fields,
    "csv_bad_rows": csv_bad_rows,
    "csv_blank_lines": csv_blank_lines,
    "csv_bad_bytes": csv_bad_bytes,
    "csv_large_files": csv_large_files,
    "csv_export_roundtrip": csv_export_roundtrip,
    "api_pages_flatten": api_pages_flatten,
    "pages_stop_empty": pages_stop_empty,
    "pages_stop_falsy": pages_stop_falsy,
    "pages_stop_missing": pages_stop_missing,
    "labor_logs_table": labor_logs_table,
    "labor_log_keys": labor_log_keys,
    "labor_logs_quarantine": labor_logs_quarantine,
    "silver_roundtrip_by_region": silver_roundtrip_by_region,
    "lake_inventory": lake_inventory,
    "topic_decode_events": topic_decode_events,
    "topic_dead_letters": topic_dead_letters,
    "topic_first_delivery": topic_first_delivery,
    "stream_bronze_silver": stream_bronze_silver,
    "stream_mixed_batches": stream_mixed_batches,
    "stream_silver_dedup": stream_silver_dedup,
    "stream_exact_first": stream_exact_first,
    "stream_run_events": stream_run_events,
    "run_department_summary": run_department_summary,
    "run_event_counts": run_event_counts,
    "run_stage_rows": run_stage_rows,
    "run_strict_gate": run_strict_gate,
    "run_topic_dead_letters": run_topic_dead_letters,
    "run_null_keys": run_null_keys,
    "run_quarantine": run_quarantine,
    "run_two_sources": run_two_sources,
    "run_hours_variance": run_hours_variance,
    "warehouse_row_counts": warehouse_row_counts,
    "run_event_summary": run_event_summary,
}
