"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laborlake.session import fresh_path

#: ASCII white space, as a character class and as a list for ``translate``.
ASCII_SPACE = " \t\n\x0b\x0c\r"
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there, any executor can read it."""
    spark = df.sparkSession
    path = fresh_path(spark, "llm", name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def own_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Only the named columns, by position of first match, so that extra or clashing columns do no harm."""
    lower = [c.lower() for c in df.columns]
    at = {n: lower.index(n.lower()) for n in names}
    renamed = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return renamed.select(*[F.col(f"c{i}").alias(n) for n, i in at.items()])


def unambiguous(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """All columns in their order, the first match of each of ``names`` under that name and the others under names of their own.

    For operators that return their input's rows: work on this and give the names back by ``toDF(*df.columns)``.
    """
    lower = [c.lower() for c in df.columns]
    found = {lower.index(n.lower()): n for n in names}
    return df.toDF(*[found.get(i, f"_own_{i}") for i in range(len(lower))])


def attach(rows: DataFrame, table: DataFrame, key: str, count: str, parts: int = 1000) -> DataFrame:
    """``rows`` left-joined to ``table`` on ``key``; ``table`` has one row per key with ``count``, the rows it has in ``rows``.

    Keys that hold over 1/``parts`` of all rows are at most ``parts`` in number, so they are
    broadcast; all other keys go through the shuffle join, where none of them is hot.
    """
    total = table.agg(F.coalesce(F.sum(count), F.lit(0))).first()[0]
    limit = max(1, total // parts)
    hot = table.where(F.col(count) > limit)
    cold = table.where(F.col(count) <= limit)
    hot_keys = F.broadcast(hot.select(F.col(key).alias("_hot")))
    tagged = rows.join(hot_keys, rows[key] == F.col("_hot"), "left")
    is_hot = F.col("_hot").isNotNull()
    first = tagged.where(is_hot).drop("_hot").join(F.broadcast(hot), key)
    rest = tagged.where(~is_hot).drop("_hot").join(cold, key, "left")
    return first.unionByName(rest)
