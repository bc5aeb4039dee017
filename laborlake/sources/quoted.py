"""CSV records from text lines, split over many tasks even where quoted fields hold line ends.

Spark's text source cuts a file at line ends, so a block may begin inside a quoted field. A quote opens
a field only at the field's start, and a doubled one inside stands for a quote, so a stray quote within a field changes nothing.

1. The lines of a block are put together to parts of at most ``2 ** _PART_BITS`` lines in the task that reads them (Arrow, no
   shuffle), and a part is one row from then on. What a part does to the quote state is a function of the state it begins in (outside or
   inside a quoted field): unchanged, swapped, or set. One regular expression per begin finds it, without a step per line.
2. A running window over the small table of parts gives the state in which each part begins, and the part where a
   record that reaches into it was opened.
3. Within a part one regular expression gives the records that lie in it. What a part holds of a record that reaches over its ends
   meets the other pieces in one aggregate, whose groups are single records.

The text is written once and not shuffled, but for the pieces of 3. All loops of the expressions are possessive: a text is read once
from its begin to its end, without a stack, however long it is.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from laborlake.session import fresh_path, small_splits

if TYPE_CHECKING:
    import pyarrow as pa

_PART_BITS = 13  # places of a block that make one part
_PART = ["path", "block", "part"]

# The rest of a quoted field after its opening quote; a field; the fields of a record; blank lines.
_BODY = r'[^"]*+(?:""[^"]*+)*+'
_CLOSED = rf'{_BODY}"[^,\n]*+'
_FIELD = rf'(?:"{_CLOSED}|(?!")[^,\n]*+)'
_FIELDS = rf'{_FIELD}(?:,{_FIELD})*+'
_BLANK = r'(?:[ \t\x0B\f\r]*+(?:\n|\z))*+'
# Texts that end inside a quoted field, having begun outside (with the record that is open then) and inside one.
_OPENS = rf'\A(?:{_FIELDS}\n)*+((?:{_FIELD},)*+"{_BODY})\z'
_STAYS = rf'\A(?:{_BODY}\z|{_CLOSED}[,\n](?:{_FIELD}[,\n])*+"{_BODY}\z)'
# The end of a record that an earlier part opened; records that end here, and whether there is one.
_HEAD = rf'\A({_CLOSED}(?:,{_FIELD})*+)\n'
_RECORD = rf'\G{_BLANK}(?!\z)({_FIELDS})(?:\n|\z)'
_WHOLE_FIRST = rf'\A{_BLANK}(?!\z){_FIELDS}\n'


def text_lines(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """(value, path, block, at) of every line; ``at`` orders the lines within a block.

    Without ``recursiveFileLookup`` a folder's listing holds its top-level files only, on any file system.
    """
    reader = spark.read.format("text")
    lines = (reader.option("pathGlobFilter", glob) if glob else reader).load(path)
    return lines.select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
                        F.monotonically_increasing_id().alias("at"))


def is_blank(line: Column) -> Column:
    return F.when(F.ascii(line) > 32, F.lit(False)).otherwise(~line.rlike(r"\S"))


def _may_open(text: Column) -> Column:
    """A quote at a field's start; cheaper than the expressions, and most texts have none."""
    return F.startswith(text, F.lit('"')) | F.contains(text, F.lit(',"')) | F.contains(text, F.lit('\n"'))


def open_after(text: Column, inside: bool) -> Column:
    """1 if the text (a line, or lines joined by line ends) ends inside a quoted field, having begun outside or inside one; else 0."""
    if inside:
        return F.when(F.contains(text, F.lit('"')), text.rlike(_STAYS).cast("int")).otherwise(1)
    return F.when(_may_open(text), text.rlike(_OPENS).cast("int")).otherwise(0)


def _open_record(text: Column) -> Column:
    """The record that is open at the end of a text that begins outside a quoted field; null if there is none."""
    return F.when(_may_open(text), F.nullif(F.regexp_extract(text, _OPENS, 1), F.lit("")))


def with_states(parts: DataFrame) -> DataFrame:
    """Adds what a part does that began outside (0) or inside (1): ``f0`` and ``f1``, the state after it, ``open0`` and ``open1``, the record
    that begins in it and does not end, and for the latter ``head``, the text up to the first end of a record, or ``through`` if there is none.

    Broken bytes stand as one character a byte (``broken``), since only separators, quotes and line ends are looked at.
    """
    text = F.col("value")
    broken = ~F.is_valid_utf8(text)
    parts = parts.withColumn("broken", broken).withColumn("value", F.when(broken, F.decode(text.cast("binary"), "ISO-8859-1")).otherwise(text))
    parts = parts.withColumn("full", ~is_blank(text)).withColumn("open0", _open_record(text))
    parts = parts.withColumn("head", F.when(F.contains(text, F.lit('"')), F.nullif(F.regexp_extract(text, _HEAD, 1), F.lit(""))))
    # A head is never empty: it holds the quote that closes the field.
    parts = parts.withColumn("open1", F.when(F.col("head").isNotNull(), _open_record(_after_head())))
    parts = parts.withColumn("through", F.when(F.col("head").isNull(), text))
    inside = F.when(F.col("head").isNotNull(), F.col("open1").isNotNull().cast("int")).otherwise(open_after(text, True))
    return parts.withColumn("f0", F.col("open0").isNotNull().cast("int")).withColumn("f1", inside)


def _after_head() -> Column:
    return F.substring(F.col("value"), F.length("head") + 2, F.length("value"))


def _joined(bits: int):
    """Arrow batches of lines -> of parts, cut where the file, the block or the part changes."""
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            path, block, at = batch.column("path"), batch.column("block"), batch.column("at")
            part = at.to_numpy() >> bits
            new = np.concatenate([[True], (part[1:] != part[:-1]) | (np.diff(block.to_numpy()) != 0) |
                                  pc.not_equal(path[1:], path[:-1]).to_numpy(zero_copy_only=False)])
            starts = np.flatnonzero(new)
            cuts = np.append(starts, n).astype(np.int32)
            lists, first = pa.ListArray.from_arrays(pa.array(cuts), batch.column("value")), pa.array(starts)
            yield pa.RecordBatch.from_arrays([path.take(first), block.take(first), at.take(first), pa.array(np.diff(cuts).astype(np.int64)),
                                              pc.binary_join(lists, b"\n")], names=["path", "block", "at", "n", "value"])
    return join


def staged_lines(lines: DataFrame) -> DataFrame:
    """The lines as parts, (path, block, at of the first, n lines, value) with their states, written once.

    Their places do not depend on how later reads are split. A batch of lines ends a part too, so a part may be shorter.
    """
    spark = lines.sparkSession
    packed = lines.select("path", "block", "at", F.col("value").cast("binary").alias("value")).mapInArrow(
        _joined(_PART_BITS), "path string, block bigint, at bigint, n bigint, value binary")
    out = with_states(packed.withColumn("value", F.col("value").cast("string")))
    path = fresh_path(spark, "staging", "csv_lines")
    with small_splits(spark):
        out.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(out.schema).parquet(path)


def _before(order: Column | str, *keys: str):
    return Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def _state_before(df: DataFrame, begin: Column, order: Column | str, *keys: str) -> DataFrame:
    """Adds ``start``: the state before each row, from ``begin`` and the functions (f0, f1) of the rows before it."""
    swap = ((F.col("f0") == 1) & (F.col("f1") == 0)).cast("long")
    upto = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    before = _before(order, *keys)
    df = df.withColumn("_swaps", F.sum(swap).over(upto))
    df = df.withColumn("_set", F.last(F.when(F.col("f0") == F.col("f1"), F.struct("f0", "_swaps")), ignorenulls=True).over(before))
    swaps = F.coalesce(F.lag("_swaps").over(Window.partitionBy(*keys).orderBy(order)), F.lit(0)) - F.coalesce(F.col("_set._swaps"), F.lit(0))
    return df.withColumn("start", ((F.coalesce(F.col("_set.f0"), begin) + swaps) % 2).cast("int")).drop("_swaps", "_set")


def _in_parts(lines: DataFrame) -> DataFrame:
    return lines.withColumn("part", F.col("at"))


def part_states(parts: DataFrame) -> DataFrame:
    """Per part, by its ``at``: the state it begins and ends in, the part that opened a record which reaches into it, whether all lines before are blank."""
    # One row per part; a file's parts are in one group.
    place = F.struct("block", "part")
    known = _state_before(parts.select(*_PART, "f0", "f1", F.col("head").isNotNull().alias("begins"), "full"), F.lit(0), place, "path")
    has = (F.col("start") == 0) | F.col("begins")
    before = _before(place, "path")
    return known.select(
        F.col("part").alias("at"), F.col("start").alias("part_start"),
        F.when(F.col("start") == 0, F.col("f0")).otherwise(F.col("f1")).alias("part_end"),
        F.last(F.when(has, F.col("part")), ignorenulls=True).over(before).alias("opened"),
        (~F.coalesce(F.bool_or("full").over(before), F.lit(False))).alias("leads"))


def quoted_records(lines: DataFrame) -> DataFrame:
    """(path, block, at, value, is_header) of every record that is not blank; ``lines`` as ``staged_lines`` gives them."""
    placed = lines.join(part_states(_in_parts(lines)), "at")
    inside = F.col("part_start") == 1

    def as_read(piece: Column) -> Column:
        return F.when(F.col("broken"), F.encode(piece, "ISO-8859-1").cast("string")).otherwise(piece)

    rest = F.when(~inside, F.col("value")).when(F.col("head").isNotNull(), _after_head())
    whole = placed.select("path", "block", "at", "broken", "leads", F.posexplode(F.regexp_extract_all(rest, F.lit(_RECORD), 1)).alias("nth", "piece"))
    whole = whole.select("path", "block", (F.col("at") + F.col("nth")).alias("at"), as_read(F.col("piece")).alias("value"),
                         (F.col("leads") & (F.col("nth") == 0)).alias("is_header"))

    # Pieces of a record that goes on in the next parts, by the part that opened it; its own part holds the first.
    def pieces(rows: DataFrame, record: str, last: Column, value: Column, header: Column) -> DataFrame:
        return rows.select("path", F.col(record).alias("record"), F.struct("block", last.alias("at"), as_read(value).alias("value")).alias("line"),
                           header.alias("is_header"))

    reached = pieces(placed.where(inside), "opened", F.col("at"), F.coalesce("head", "through"), F.lit(False))
    opened = F.when(inside, F.col("open1")).otherwise(F.col("open0"))
    first_here = F.col("leads") & ~F.col("value").rlike(_WHOLE_FIRST)
    begun = pieces(placed.where(opened.isNotNull()), "at", F.col("at") + F.col("n") - 1, opened, first_here)
    joined = reached.unionByName(begun).groupBy("path", "record").agg(
        F.array_sort(F.collect_list("line")).alias("lines"), F.bool_or("is_header").alias("is_header"))
    spanning = joined.select("path", F.col("lines")[0]["block"].alias("block"), F.col("lines")[0]["at"].alias("at"),
                             F.array_join(F.col("lines.value"), "\n").alias("value"), "is_header")
    return whole.unionByName(spanning)
