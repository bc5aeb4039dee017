"""Adapters from the driver's star-schema tables to the content/labor domain.

``content_events``      clean silver-shaped events: orders x customer x nation x region
``content_events_raw``  the same events as they arrive on the topic (dirty text, null
                        departments, ISO timestamps) plus re-deliveries: every line item
                        re-delivers its order as a 'content_updated' event, so a key arrives several times
``labor_records``       labor-log API records: one per line item

All are lazy plans (``content_events_raw`` looks up row counts in the footers first); filters and projections of the callers reach the parquet scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from laborlake.functions.expressions import iso_week, labor_flag, strip_ws, upper_strip
from laborlake.schemas import PIPELINE_LAYER, PIPELINE_VERSION

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

ISO_TEXT = "yyyy-MM-dd'T'HH:mm:ss'Z'"

# Raw events of one partition, and the fewest partitions.
ROWS_PER_PART, LEAST_PARTS = 125_000, 8


# Schemas of the tables that the adapters read, so that a plan starts without a job that reads footers.
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ, "
              "o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
                "l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table (read-only input)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    return spark.read.schema(SCHEMAS[name]).parquet(path) if name in SCHEMAS else spark.read.parquet(path)


def _geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation x region (25 rows). No hint: the planner broadcasts it from its size
    statistics (autoBroadcastJoinThreshold), and AQE re-checks with runtime sizes."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "r_name")


def _order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the customer name/segment and region name (one row per order)."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    cust_geo = customer.join(_geo(spark, sf_dir), customer.c_nationkey == F.col("n_nationkey"))
    return orders.join(cust_geo, orders.o_custkey == cust_geo.c_custkey)


def _hours(price: str = "o_totalprice"):
    return F.floor(F.col(price) / 2500).cast(T.IntegerType())


def content_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean content events in the canonical 12-column silver layout."""
    f = _order_facts(spark, sf_dir)
    ts = F.col("o_orderdate").cast(T.TimestampType())
    return f.select(
        F.col("o_orderkey").cast(T.StringType()).alias("content_id"),
        F.col("c_name").alias("title"),
        upper_strip("c_mktsegment").alias("category"),
        upper_strip("r_name").alias("region"),
        strip_ws("o_orderpriority").alias("department"),
        _hours().alias("labor_hours"),
        labor_flag(_hours()).alias("labor_flag"),
        F.col("o_orderstatus").alias("event_type"),
        ts.alias("event_timestamp"),
        F.lit(PIPELINE_LAYER).alias("pipeline_layer"),
        F.lit(PIPELINE_VERSION).alias("pipeline_version"),
        ts.alias("processed_at"),
    )


def delivery_parts(spark: SparkSession, sf_dir: str) -> int:
    """Partitions (files) for the raw events, so that each holds about ``ROWS_PER_PART`` of them; from the tables' footers."""
    rows = table(spark, sf_dir, "orders").count() + table(spark, sf_dir, "lineitem").count()
    return max(LEAST_PARTS, -(-rows // ROWS_PER_PART))


def content_events_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic-shaped raw events with duplicates, nulls and padding; ``ingest_seq`` is arrival order.

    The deliveries (an order's own, and one for each of its line items) are put together
    as keys first and joined to the order's facts once. They are joined by the text of the key, which is the ``content_id``: what groups
    by it afterwards finds the rows placed and sorted, and no task sorts the wide rows again. All rows of a key are in one partition, and
    the partitions grow with the tables: sized by the narrow keys alone, as AQE would, a task's share of the wide rows grows.
    """
    key = F.col("o_orderkey").cast(T.StringType()).alias("content_id")
    first = table(spark, sf_dir, "orders").select(key, F.lit(0).cast("long").alias("ingest_seq"))
    again = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast(T.StringType()).alias("content_id"), F.col("l_linenumber").cast("long").alias("ingest_seq"))
    deliveries, facts = first.unionByName(again), _order_facts(spark, sf_dir).withColumn("content_id", key)
    parts = delivery_parts(spark, sf_dir)
    # Both sides grow with the data, so neither is broadcast, whatever their estimates.
    f = deliveries.repartition(parts, "content_id").join(facts.repartition(parts, "content_id").hint("merge"), "content_id")
    own = F.col("ingest_seq") == 0
    return f.select(
        "content_id",
        F.when(own, F.col("c_name")).otherwise(F.concat(F.lit("  "), F.col("c_name"), F.lit("  "))).alias("title"),
        F.lower("c_mktsegment").alias("category"),
        F.concat(F.lit(" "), F.lower("r_name"), F.lit(" ")).alias("region"),
        F.when(~own | (F.col("o_orderpriority") != "4-NOT SPECIFIED"), F.col("o_orderpriority")).alias("department"),
        _hours().alias("labor_hours"),
        F.date_format(F.col("o_orderdate") + F.make_interval(days=F.col("ingest_seq").cast("int")), ISO_TEXT).alias("timestamp"),
        F.when(own, F.col("o_orderstatus")).otherwise(F.lit("content_updated")).alias("event_type"),
        "ingest_seq",
    )


def labor_records(spark: SparkSession, sf_dir: str, order: bool = False) -> DataFrame:
    """Labor-log API records: project = order, employee = supplier, hours = quantity; with ``order``, their line items' keys."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_suppkey").cast(T.StringType()).alias("employee_id"),
        F.col("l_linestatus").alias("department"),
        F.col("l_orderkey").cast(T.StringType()).alias("project_id"),
        F.col("l_quantity").cast(T.DoubleType()).alias("hours_logged"),
        iso_week("l_shipdate").alias("week"),
        F.col("l_returnflag").alias("role"),
        *(["l_orderkey", "l_linenumber"] if order else []),
    )
