"""Exact de-duplication against a persistent digest index.

The index is a table bucketed and sorted by digest. A batch is first reduced to
one row per digest (partial aggregation, so a text that a third of all rows
share ships one row per map task). One sort-merge join against the index, whose side is read by bucket without a shuffle,
tells the digests that are held, with the row that was kept, from those that find no partner (the anti-join); only
the latter are appended. The index has a power of two of buckets of about ``ROWS_PER_BUCKET`` digests: the first batch sets their
number, and a batch that would fill them over four times as much moves the index into more of them first. A move writes a
table of its own, which takes over once it is whole.

Defined cases: a null text counts as empty; texts are equal when identical after
deleting ASCII white space; of equal texts the row with the most code points in
its original text stays, then the smallest doc_id (a null doc_id comes last), then the smallest hash of its original text.
Rows that repeat a doc_id and its text share one verdict. A text that an earlier
batch put into the index is never kept again. An empty batch appends nothing.
Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from laborlake.llm.common import ASCII_SPACE, attach, own_columns, read, staged
from laborlake.session import drop_path, fresh_path

ROWS_PER_BUCKET = 1_000_000


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), ASCII_SPACE, "")


class DigestIndex:
    """A catalog table of digests. ``table`` names it, ``path`` is its shared location, ``buckets`` the least number of buckets.

    After a move the table is ``<table>__<buckets>``; of several, as a move that did not end leaves them, the one with the most
    buckets holds.
    """

    def __init__(self, spark: SparkSession, table: str, path: str, buckets: int = 1, rows_per_bucket: int = ROWS_PER_BUCKET):
        self.spark, self.table, self.path = spark, table.lower(), path.rstrip("/")
        self.buckets, self.rows_per_bucket = buckets, rows_per_bucket

    def _tables(self) -> list[tuple[int, str]]:
        """(buckets, name) of the tables that are there; the last one holds."""
        named = re.compile(re.escape(self.table) + "(__[0-9]+)?")
        names = [t.name for t in self.spark.catalog.listTables(pattern=f"{self.table}*") if named.fullmatch(t.name.lower())]
        told = {n: self.spark.sql(f"DESCRIBE TABLE EXTENDED {n}").where("col_name = 'Num Buckets'").first()["data_type"] for n in names}
        return sorted((int(buckets), n) for n, buckets in told.items())

    def rows(self) -> DataFrame | None:
        """The index; None before the first batch."""
        held = self._tables()
        return self.spark.table(held[-1][1]) if held else None

    def _append(self, rows: DataFrame, buckets: int, name: str) -> None:
        """A new table is in the catalog only once it is written."""
        (rows.repartition(buckets, "text_sha256")
         .write.bucketBy(buckets, "text_sha256").sortBy("text_sha256").format("parquet")
         .option("path", f"{self.path}/{buckets}").mode("append").saveAsTable(name))

    def _room_for(self, more: int) -> tuple[int, str]:
        """The table that ``more`` new digests go to; they and the index move into more buckets first if it has too few."""
        held = self._tables()
        rows = self.spark.table(held[-1][1]).count() if held else 0
        fit = max(self.buckets, 1 << max(0, (max(1, -(-(rows + more) // self.rows_per_bucket)) - 1).bit_length()))
        if not held:
            return fit, self.table
        if fit <= 4 * held[-1][0]:
            return held[-1]
        drop_path(self.spark, f"{self.path}/{fit}")  # of a move that did not end
        self._append(self.spark.table(held[-1][1]), fit, f"{self.table}__{fit}")
        for old in held:
            self._drop(*old)
        return fit, f"{self.table}__{fit}"

    def _drop(self, buckets: int, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        drop_path(self.spark, f"{self.path}/{buckets}")

    def drop(self) -> None:
        """Remove the index; verdicts given before stay readable."""
        for held in self._tables():
            self._drop(*held)

    def add(self, docs: DataFrame, batch: int) -> DataFrame:
        """De-duplicate one batch and append what is new; a verdict for every row of the batch."""
        text = F.coalesce("text", F.lit(""))
        digests = staged(own_columns(docs, ["doc_id", "text"]).select(
            "doc_id",
            F.sha2(F.encode(normalised(F.col("text")), "UTF-8"), 256).alias("text_sha256"),
            F.char_length(text).alias("chars"), F.xxhash64(text).alias("original")), "digests")
        best = F.min(F.struct((-F.col("chars")).alias("n"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "original"))
        per_digest = (digests.groupBy("text_sha256").agg(best.alias("best"), F.count(F.lit(1)).alias("group_size"))
                      .select("text_sha256", F.col("best.doc_id").alias("best_id"), (-F.col("best.n")).alias("best_chars"),
                              F.col("best.original").alias("best_original"), "group_size"))
        index, mine = self.rows(), F.col("kept_in").isNull()
        none = self.spark.range(0).select(F.lit("").alias("text_sha256"), F.col("id").alias("keep_id"), F.col("id").alias("batch"))
        held = (none if index is None else index).select("text_sha256", F.col("keep_id").alias("held_id"), F.col("batch").alias("kept_in"))
        per_digest = per_digest.join(held.hint("merge"), "text_sha256", "left")
        found = staged(per_digest.select("text_sha256", "best_id", "best_chars", "best_original", "group_size", mine.alias("new"),
                                         F.when(mine, F.col("best_id")).otherwise(F.col("held_id")).alias("keep_id")), "found")
        new = found.where("new")
        buckets, name = self._room_for(new.count())
        self._append(new.select("text_sha256", "keep_id", F.col("best_chars").alias("keep_chars"),
                                F.lit(batch).cast("bigint").alias("batch"), F.col("group_size").alias("batch_rows")), buckets, name)
        verdicts = attach(digests, found, "text_sha256", "group_size")
        stays = F.col("doc_id").eqNullSafe(F.col("best_id")) & (F.col("chars") == F.col("best_chars")) & (F.col("original") == F.col("best_original"))
        return verdicts.select("doc_id", "keep_id", "group_size", (F.col("new") & stays).alias("kept"), "text_sha256")


def exact_dedup(docs: DataFrame) -> DataFrame:
    """All of ``docs`` as the first batch of a fresh index in the shared folder, which goes when the verdicts are made."""
    spark = docs.sparkSession
    index = DigestIndex(spark, f"digest_index_{uuid.uuid4().hex}", fresh_path(spark, "llm", "digest_index"))
    verdicts = index.add(docs, 0)
    index.drop()
    return verdicts


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read(spark, sf_dir, "documents"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256,
         length(coalesce(text, '')) AS n
  FROM documents
), g AS (
  SELECT text_sha256, first(doc_id ORDER BY n DESC, doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
"""
