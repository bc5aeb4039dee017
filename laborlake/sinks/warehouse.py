"""Warehouse tables (bronze/silver/gold databases) as parquet data-source tables.

The DDL keeps the reference's columns, types and defaults. Parquet tables have
no PRIMARY KEY / CHECK / IDENTITY and accept nulls in NOT NULL columns, so the
rules live in ``operators.quality`` (accepted vs quarantined rows) and the
labor-log key is numbered before the insert (``with_log_id``). An overwrite fills a folder of its own and commits it by
the table's location, so a failing one leaves the old rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from laborlake.operators.reports import hours_by_project
from laborlake.session import drop_path, fresh_path, list_names, scratch_root, small_parts, small_splits

DDL = {
    "bronze.content_events_raw": """
        content_id STRING, title STRING, category VARCHAR(50), region VARCHAR(20),
        department VARCHAR(100), labor_hours INT, event_type VARCHAR(50), event_timestamp TIMESTAMP,
        source_system VARCHAR(50), ingested_at TIMESTAMP DEFAULT current_timestamp()""",
    "silver.content_events_clean": """
        content_id VARCHAR(50), title VARCHAR(255), category VARCHAR(50), region VARCHAR(20),
        department VARCHAR(100), labor_hours INT, labor_flag VARCHAR(10), event_type VARCHAR(50),
        event_timestamp TIMESTAMP, pipeline_layer VARCHAR(10) DEFAULT 'silver',
        pipeline_version VARCHAR(10), processed_at TIMESTAMP DEFAULT current_timestamp()""",
    "silver.labor_logs": """
        log_id BIGINT, employee_id VARCHAR(20), project_id VARCHAR(50), department VARCHAR(100),
        role VARCHAR(100), hours_logged DOUBLE, week VARCHAR(10),
        processed_at TIMESTAMP DEFAULT current_timestamp()""",
    "gold.department_labor_summary": """
        department VARCHAR(100), region VARCHAR(20), total_projects BIGINT, total_labor_hours BIGINT,
        avg_labor_hours DOUBLE, high_effort_count BIGINT, summary_date DATE DEFAULT current_date()""",
    "gold.category_summary": """
        category VARCHAR(50), total_titles BIGINT, total_labor_hours BIGINT, avg_labor_hours DOUBLE,
        summary_date DATE DEFAULT current_date()""",
}

_OPTIONS = "OPTIONS (compression 'zstd')"
_RUN = 10_000  # equal records numbered as one row; more are dealt out
_BUCKET, _SHUFFLED = 250_000, 64  # distinct records sorted by one task, as far as the shuffle has partitions; about so many bytes each
_TABLE_BUCKET = 1_000_000  # rows of a bucket of the tables bucketed alike

# VARCHAR lengths are checked before insert by operators.quality (CONTENT_LENGTHS,
# LABOR_LOG_LENGTHS): a longer value would fail the whole insert, a rule quarantines the row.


def create_tables(spark: SparkSession, location: str | None = None, prefix: str = "", only: Sequence[str] | None = None) -> dict[str, str]:
    """Create the databases (names after ``prefix``) and the tables (all five) under ``location``; returns table -> path."""
    location = (location or f"{scratch_root(spark)}/warehouse").rstrip("/")
    paths = {}
    for table, cols in DDL.items():
        if only is not None and table not in only:
            continue
        db, name = table.split(".")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {prefix}{db} LOCATION '{location}/{db}.db'")
        path = f"{location}/{db}.db/{name}"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {prefix}{table} ({cols}) USING parquet {_OPTIONS} LOCATION '{path}'")
        paths[prefix + table] = path
    return paths


def insert(spark: SparkSession, table: str, df: DataFrame, overwrite: bool = False) -> None:
    """INSERT by column name; columns the frame lacks take their DEFAULT.

    ``overwrite`` inserts into a new folder under the same columns and then moves the table's location there: one
    catalog change commits. The folder before it stays for plans that read it, older ones go.
    """
    cols = [c for c in df.columns if c in spark.table(table).columns]
    if not overwrite:
        return _insert_into(spark, table, df, cols)
    db, name = table.rsplit(".", 1)
    layer = next(t for t in DDL if table.endswith(t))
    old = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()["data_type"]
    base = old.rsplit("/", 1)[0] + "/" + name
    tag = uuid.uuid4().hex[:12]
    new, filled = f"{base}__{tag}", f"{db}.{name}__{tag}"
    spark.sql(f"CREATE TABLE {filled} ({DDL[layer]}) USING parquet {_OPTIONS} LOCATION '{new}'")
    try:
        _insert_into(spark, filled, df, cols)
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{new}'")
        spark.catalog.refreshTable(table)
    finally:
        spark.sql(f"DROP TABLE {filled}")  # its files are the table's now, or those of a failed write
    folder = base.rsplit("/", 1)[0]
    for other in list_names(spark, folder):
        if other.startswith(f"{name}__") and f"{folder}/{other}".split(":", 1)[-1] not in (old.split(":", 1)[-1], new.split(":", 1)[-1]):
            drop_path(spark, f"{folder}/{other}")
    return None


def _insert_into(spark: SparkSession, table: str, df: DataFrame, cols: list[str]) -> None:
    view = f"_ins_{uuid.uuid4().hex}"
    df.select(*cols).createOrReplaceTempView(view)
    try:
        col_list = ", ".join(f"`{c}`" for c in cols)
        spark.sql(f"INSERT INTO {table} ({col_list}) SELECT {col_list} FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def with_log_id(df: DataFrame) -> DataFrame:
    """Identity key of silver.labor_logs: dense numbers 1 to n, with one shuffle and without a task that sees all rows.

    Equal records are counted first (partially aggregated, so a record that a third of all rows repeat is one row per
    map task). The task that counts a record also sorts its records by hash group, gives each copy a place of its own and writes
    them, so the source is read once. The rows per group are summed up in one small window, and a place becomes a
    number by what was written before its group. A record with over ``_RUN`` copies has a place for the first; the
    others come after all places and are dealt out in runs of that many numbers. Which of two records comes first is not defined,
    but the same rows always get the same numbers.
    """
    spark, names = df.sparkSession, df.columns
    given = df.toDF(*[f"c{i}" for i in range(len(names))])
    keys = [F.col(c) for c in given.columns]
    few, one = F.col("n") <= _RUN, F.lit(1).cast("long")
    # The shuffle deals by the same hash, so a group is one task's, whatever partitions are merged.
    group = F.pmod(F.hash(*keys), F.lit(int(spark.conf.get("spark.sql.shuffle.partitions")))).alias("group")
    counts = given.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).select("*", group).sortWithinPartitions("group", *keys)
    copies = counts.select(*keys, "group", F.when(few, 0).otherwise(F.col("n") - 1).alias("more"),
                           F.explode(F.sequence(one, F.when(few, F.col("n")).otherwise(one))).alias("nth"))
    placed, path = copies.select(*keys, "group", "more", F.monotonically_increasing_id().alias("at")), fresh_path(spark, "staging", "log_ids")
    with small_splits(spark), small_parts(spark, _BUCKET * _SHUFFLED):
        placed.write.option("compression", "zstd").parquet(path)
    placed = spark.read.schema(placed.schema).parquet(path).withColumn("task", F.shiftright("at", 33))
    # A row per group: as many as the shuffle has partitions. (A source dealt by some of its columns is not shuffled: then per task and group.)
    order, everything = Window.orderBy("group", "task"), Window.partitionBy()
    sums = placed.groupBy("group", "task").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"), F.sum("more").alias("rest"))
    sums = sums.select("group", "task", (F.sum("rows").over(order) - F.col("rows") - F.col("first") + 1).alias("shift"),
                       (F.sum("rows").over(everything) + F.sum("rest").over(order) - F.col("rest")).alias("before"))
    placed = placed.join(F.broadcast(sums), ["group", "task"])
    firsts = placed.select(*keys, (F.col("at") + F.col("shift")).alias("log_id"))
    earlier = F.sum("more").over(Window.partitionBy("group", "task").orderBy("at")) - F.col("more")
    runs = placed.where("more > 0").withColumn("base", F.col("before") + earlier).select(
        *keys, "base", "more", F.explode(F.sequence(F.lit(0).cast("long"), F.col("more") - 1, F.lit(_RUN).cast("long"))).alias("run"))
    start, end = F.col("base") + F.col("run") + 1, F.col("base") + F.least(F.col("more"), F.col("run") + _RUN)
    dealt_out = runs.repartition("base", "run").select(*keys, F.explode(F.sequence(start, end)).alias("log_id"))
    return firsts.unionByName(dealt_out).toDF(*names, "log_id")


# ---- tables bucketed alike (J1, R7) ------------------------------------------------------------

def buckets_for(rows: int, rows_per_bucket: int = _TABLE_BUCKET) -> int:
    """A power of two, so that tables sized by different row counts still line up."""
    return 1 << max(0, (max(1, -(-rows // rows_per_bucket)) - 1).bit_length())


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str) -> DataFrame:
    """``df`` as a new table at ``path``, one sorted file per bucket of ``key``. The key must be (nearly) unique: a bucket is one task's."""
    (df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).format("parquet").option("path", path).saveAsTable(table))
    return df.sparkSession.table(table)


def bucket_for_variance(silver: DataFrame, labor_logs: DataFrame, location: str, prefix: str = "",
                        rows_per_bucket: int = _TABLE_BUCKET) -> tuple[DataFrame, DataFrame]:
    """Silver by content_id and the logged hours by project_id, bucketed alike: R7 over them joins without a shuffle.

    The logs themselves are not bucketed by project: one that holds a third of them would be one task's bucket. They are summed
    per project first, on the map side, so the bucketed table has a row per project.
    """
    spark = silver.sparkSession
    buckets = buckets_for(silver.count(), rows_per_bucket)
    location = location.rstrip("/")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {prefix}silver LOCATION '{location}/silver.db'")
    tables = [(silver, "content_events_by_id", "content_id"), (hours_by_project(labor_logs), "hours_by_project", "project_id")]
    made = [write_bucketed(df, f"{prefix}silver.{name}", key, buckets, f"{location}/silver.db/{name}") for df, name, key in tables]
    return made[0], made[1]
