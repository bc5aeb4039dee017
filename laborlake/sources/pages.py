"""Landed API pages -> labor-log records.

The HTTP loop itself is outside Spark; each response page is landed as one JSON
object ``{page, results: [...], next}``. The reference's stop rules become one
small aggregate over page numbers:

  stop = min( first page whose results are empty/null,
              page + 1 after a page whose ``next`` is falsy (null or ""),
              first page number missing from the landing (a failed request) )

and the records are the ``results`` of pages ``1 .. stop-1`` in page order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from laborlake.schemas import API_PAGE_SIZE, LABOR_PAGE_SCHEMA, LABOR_RECORD_SCHEMA
from laborlake.session import fresh_path


BLOCK = 10_000  # page numbers counted as one row


def read_landed_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages landed as JSON lines with a fixed schema (no inference)."""
    return spark.read.schema(LABOR_PAGE_SCHEMA).json(path)


def stop_page(pages: DataFrame) -> DataFrame:
    """One-row frame with the first page number that is not read (``stop``)."""
    spark = pages.sparkSession
    page = F.col("page").cast(T.IntegerType())
    is_empty, is_last = F.coalesce(F.size("results"), F.lit(0)) <= 0, F.coalesce(F.col("next"), F.lit("")) == ""
    # A page's own stop, if it has one: itself when empty, the next one when it is the last.
    narrow = pages.select(page.alias("page"), F.when(is_empty, page).when(is_last, page + 1).alias("own")).where(F.col("page") >= 1)
    path = fresh_path(spark, "staging", "pages")  # two numbers per page: the landed JSON is parsed once for all rules
    narrow.write.parquet(path)
    narrow = spark.read.schema(narrow.schema).parquet(path)
    p = narrow.groupBy(F.floor((F.col("page") - 1) / BLOCK).cast("long").alias("block")).agg(
        F.min("own").alias("stop"), F.countDistinct("page").alias("n"))
    # Block k is full when it holds BLOCK pages; the first block that is not (or is not there) holds the first gap.
    full = p.where(F.col("n") == BLOCK).select("block")
    before = full.union(spark.range(1).select(F.lit(-1).cast("long").alias("block")))
    first = before.join(full.select((F.col("block") - 1).alias("block")), "block", "left_anti").agg(F.min("block") + 1).first()[0]
    start = first * BLOCK + 1
    held = narrow.where((F.col("page") >= start) & (F.col("page") < start + BLOCK)).agg(F.collect_set("page").alias("pages"))  # BLOCK numbers at most
    missing = F.array_min(F.array_except(F.sequence(F.lit(start), F.lit(start + BLOCK)).cast("array<int>"), F.col("pages")))
    return held.select(missing.alias("s")).union(p.select(F.col("stop").alias("s"))).agg(F.min("s").cast("int").alias("stop"))


def flatten_pages(pages: DataFrame) -> DataFrame:
    """The records of pages before ``stop``, one row per record, plus the page number."""
    stop = stop_page(pages).scalar()
    kept = pages.where((F.col("page") >= 1) & (F.col("page") < stop))
    return kept.select("page", F.inline(F.col("results")))


def records_to_frame(records: DataFrame) -> DataFrame:
    """S3: records with the fixed labor-record schema; keys a record lacks are null."""
    cols = {f.name: f.dataType for f in LABOR_RECORD_SCHEMA.fields}
    return records.select(*[(F.col(n) if n in records.columns else F.lit(None)).cast(t).alias(n)
                            for n, t in cols.items()])


def land_pages(records: DataFrame, order: list[str], page_size: int = API_PAGE_SIZE) -> DataFrame:
    """Shape records as API response pages (test fixture): ``page_size`` records a page, in the order of ``order``.

    Places come from counts per range of the first order column and a row number within each range, so no
    task holds more than one range. ``next`` is null on the last page.
    """
    fields = [F.col(f.name) for f in LABOR_RECORD_SCHEMA.fields]
    ranged = records.withColumn("_range", F.floor(F.col(order[0]) / 1000))
    # In two levels: the ranges within coarse blocks of 1,000 ranges, then the blocks, so no task sees all ranges.
    ranges = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).withColumn("_block", F.floor(F.col("_range") / 1000))
    def earlier(order: str, *keys: str):
        return Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)

    blocks = (ranges.groupBy("_block").agg(F.sum("_n").alias("_all"))
              .select("_block", F.coalesce(F.sum("_all").over(earlier("_block")), F.lit(0)).alias("_blocks")))
    before = (ranges.withColumn("_within", F.coalesce(F.sum("_n").over(earlier("_range", "_block")), F.lit(0))).join(blocks, "_block")
              .select("_range", (F.col("_blocks") + F.col("_within")).alias("_before")))
    within = F.row_number().over(Window.partitionBy("_range").orderBy(*order, *fields))
    placed = ranged.withColumn("_within", within).join(before, "_range").withColumn("_at", F.col("_before") + F.col("_within") - 1)
    page = (F.floor(F.col("_at") / page_size) + 1).cast("int")
    grouped = placed.groupBy(page.alias("page")).agg(F.sort_array(F.collect_list(F.struct("_at", F.struct(*fields).alias("r")))).alias("sorted"))
    total = records.agg(F.count(F.lit(1))).scalar()
    return grouped.select("page", F.col("sorted.r").alias("results"),
                          F.when(F.col("page") * page_size < total, F.format_string("?page=%d", F.col("page") + 1)).alias("next"))
