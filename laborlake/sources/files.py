"""CSV file and folder scans with fixed malformed-row rules.

Rules (pandas ``read_csv(on_bad_lines='skip')`` semantics):
  * the first line of each file that is not blank is its header (a repeated name is numbered: ``id``, ``id.1``); blank lines are skipped
  * fields may be quoted; a doubled quote stands for one, and separators and line ends inside quotes are data (as ``\\n``)
  * a row with more fields than the header is dropped (also when the extra field is blank)
  * a row with fewer fields is padded with nulls
  * empty fields are null; with ``na_tokens`` those strings are null too (default none, so a
    region "NA" survives)
  * a row with bytes that are no UTF-8 keeps its text with replacement signs and is marked (``bad_encoding``), so that keys which
    became equal by that are not taken for one; a run quarantines it
  * content columns have their fixed types (``conform_content``); the types of other columns are inferred over
    the data: all values integral -> BIGINT (STRING if any is too long for it), all numeric -> DOUBLE, else STRING

How: one pass over the text lines finds each file's header, whether a quoted field spans lines, and whether bytes are broken. Plain
files are read by Spark's CSV reader with the header's columns. Files with spanning fields or broken bytes
have their lines staged and put together as records (``quoted``), which ``from_csv`` parses under the same options, so one large
file is read by many tasks in any case. A row with another field count keeps its raw text in the corrupt-record column, and
it is dropped when that text has more fields than the header (counted outside quotes, so a blank extra field
counts). Kinds are unioned by name. The driver sees the distinct headers; only where files differ, also the paths by kind.
"""

from __future__ import annotations

import csv
import io
import logging
from collections.abc import Iterable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from laborlake.functions.expressions import conform_content, normalize_name
from laborlake.schemas import BAD_ENCODING, CONTENT_SCHEMA
from laborlake.session import fresh_path
from laborlake.sources.quoted import is_blank, open_after, quoted_records, staged_lines, text_lines

_CORRUPT = "_raw_line"
ARRIVAL = ["arrival_part", "arrival_block", "arrival_pos"]


def kinds_of(lines: DataFrame) -> DataFrame:
    """(path, header, header_open, plain) of each file of ``text_lines``; see ``file_kinds``."""
    state = open_after(F.col("value"), False) == 1
    placed = lines.select("value", "path", F.struct("block", "at").alias("place"), state.alias("open"), is_blank(F.col("value")).alias("blank"))
    first = F.min_by(F.when(~F.col("blank"), F.struct("value", "open")), F.when(~F.col("blank"), F.col("place")))
    # As a set, the marks make this an aggregate by hash; with texts in its buffers alone it would sort all lines by path first.
    odd = F.collect_set(F.when(F.col("open") | ~F.is_valid_utf8("value"), F.lit(True)))
    kinds = placed.groupBy("path").agg(first.alias("first"), (F.size(odd) == 0).alias("plain"))
    return kinds.select("path", F.make_valid_utf8(F.col("first.value")).alias("header"), F.col("first.open").alias("header_open"), "plain")


def file_kinds(spark: SparkSession, path: str, glob: str | None) -> DataFrame:
    """(path, header, plain) of each file: its first line that is not blank (null: none), and whether the CSV reader can take it.

    ``header_open``: the header itself spans lines.
    """
    kinds, out = kinds_of(text_lines(spark, path, glob)), fresh_path(spark, "staging", "csv_kinds")
    kinds.write.parquet(out)
    return spark.read.schema(kinds.schema).parquet(out)


def parse_header(line: str) -> list[str]:
    """Column names of a header line; the second ``id`` is ``id.1``, and so on."""
    names: list[str] = []
    for name in next(csv.reader(io.StringIO(line.lstrip("\ufeff")))) if line else []:
        n, own = 0, name
        while own in names:
            n += 1
            own = f"{name}.{n}"
        names.append(own)
    return names


def _field_count(line):
    """Fields of a raw CSV line: separators outside double-quoted sections, plus one."""
    bare = F.regexp_replace(line, r'"[^"]*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def _options(names: list[str]) -> tuple[T.StructType, dict[str, str]]:
    """Exactly the header's columns and the corrupt-record column.

    Rows with the header's field count parse normally; only short or long rows are "malformed" and keep their raw text.
    """
    schema = T.StructType([T.StructField(f"c{i}", T.StringType(), True) for i in range(len(names))] + [T.StructField(_CORRUPT, T.StringType(), True)])
    return schema, {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}


def _kept(names: list[str]) -> Column:
    """Rows with the header's fields or fewer."""
    return F.col(_CORRUPT).isNull() | (_field_count(F.col(_CORRUPT)) <= len(names))


def _fields(names: list[str]) -> list[Column]:
    return [F.col(f"c{i}").alias(n) for i, n in enumerate(names)]


def _read_plain(spark: SparkSession, paths: str | list[str], glob: str | None, names: list[str]) -> DataFrame:
    """Files that Spark's CSV reader splits at line ends."""
    schema, options = _options(names)
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    df = reader.schema(schema).options(**options).option("header", True).option("enforceSchema", True).option("columnPruning", False).csv(paths)
    # Spark rejects scans that read only the corrupt-record column (e.g. under count());
    # the always-true test on the first column keeps a data column in the scan.
    touch = F.length(F.coalesce(F.col("c0"), F.lit(""))) >= 0
    return df.where(_kept(names) & touch).select(
        *_fields(names), F.col("_metadata.file_name").alias("source_file"), F.lit(False).alias(BAD_ENCODING),
        F.col("_metadata.file_path").alias("arrival_part"), F.col("_metadata.file_block_start").alias("arrival_block"),
        F.monotonically_increasing_id().alias("arrival_pos"))


def _read_records(records: DataFrame, names: list[str]) -> DataFrame:
    """Records of files with spanning fields or broken bytes."""
    schema, options = _options(names)
    ddl = ", ".join(f"{f.name} STRING" for f in schema.fields)
    text = F.make_valid_utf8("value")
    parsed = records.where(~F.col("is_header")).select("path", "block", "at", (~F.is_valid_utf8("value")).alias(BAD_ENCODING),
                                                       F.inline(F.array(F.from_csv(text, ddl, options))))
    name = F.url_decode(F.replace(F.element_at(F.split("path", "/"), -1), F.lit("+"), F.lit("%2B")))
    return parsed.where(_kept(names)).select(*_fields(names), name.alias("source_file"), BAD_ENCODING, F.col("path").alias("arrival_part"),
                                             F.col("block").alias("arrival_block"), F.col("at").alias("arrival_pos"))


def _null_tokens(df: DataFrame, cols: list[str], na_tokens: Iterable[str]) -> DataFrame:
    tokens = list(na_tokens)

    def fix(c):
        x = F.col(f"`{c}`")
        cond = x == ""
        if tokens:
            cond = cond | x.isin(*tokens)
        return F.when(cond, F.lit(None).cast("string")).otherwise(x).alias(c)
    return df.select(*[fix(c) for c in cols], *[c for c in df.columns if c not in cols])


# Text forms accepted as numbers by the type inference (checked with a regex, so a
# non-numeric column never goes through a failing cast per value).
_INT_RE = r"^\s*[+-]?[0-9]+\s*$"
_NUM_RE = r"^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:nan|inf|infinity))\s*$"


def infer_types(df: DataFrame, cols: list[str]) -> DataFrame:
    """Cast string columns to BIGINT/DOUBLE when every non-null value is such a number (one aggregate job).

    Whole numbers of which any is too long for BIGINT stay text: as DOUBLE, different keys would become equal.
    """
    if not cols:
        return df
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(f"`{c}`")
        aggs.append(F.count_if(x.isNotNull() & ~x.rlike(_INT_RE)).alias(f"i{i}"))
        aggs.append(F.count_if(x.rlike(_INT_RE) & F.trim(x).try_cast("bigint").isNull()).alias(f"l{i}"))
        aggs.append(F.count_if(x.isNotNull() & ~x.rlike(_NUM_RE)).alias(f"d{i}"))
        aggs.append(F.count(x).alias(f"n{i}"))
    stats = df.agg(*aggs).first()
    out = []
    for i, c in enumerate(cols):
        x = F.col(f"`{c}`")
        if stats[f"l{i}"]:
            out.append(x)
        elif stats[f"n{i}"] and stats[f"i{i}"] == 0:
            out.append(F.trim(x).try_cast("bigint").alias(c))
        elif stats[f"n{i}"] and stats[f"d{i}"] == 0:
            out.append(F.trim(x).try_cast("double").alias(c))
        else:
            out.append(x)
    return df.select(*out, *[c for c in df.columns if c not in cols])


def _groups(spark: SparkSession, path: str, glob: str | None) -> list[DataFrame]:
    """One frame per kind of file: a header, read plainly or as records."""
    kinds = file_kinds(spark, path, glob).where("header is not null")
    distinct = kinds.select("header", "plain", "header_open").distinct().collect()
    whole = len(distinct) == 1 and kinds.count() == file_count(spark, path, glob)

    def paths(rows: DataFrame) -> str | list[str]:  # file names only, and only where the files differ
        return path if whole else sorted(unquote(r["path"]) for r in rows.select("path").collect())

    frames = []
    for header in sorted({r["header"] for r in distinct if r["plain"]}):
        names = parse_header(header)
        frames.append(_read_plain(spark, paths(kinds.where(F.col("plain") & (F.col("header") == header))), glob, names))
    odd = [r for r in distinct if not r["plain"]]
    if odd:
        lines = staged_lines(text_lines(spark, paths(kinds.where(~F.col("plain"))), glob))
        records = quoted_records(lines)
        own = kinds.select("path", "header").where(~F.col("plain"))
        if any(r["header_open"] for r in odd):  # the kinds hold its first line only
            own = records.where("is_header").select("path", F.make_valid_utf8("value").alias("header"))
        headers = sorted(r["header"] for r in own.select("header").distinct().collect())
        for header in headers:
            some = [r["path"] for r in own.where(F.col("header") == header).select("path").collect()] if len(headers) > 1 else None
            frames.append(_read_records(records if some is None else quoted_records(lines.where(F.col("path").isin(some))), parse_header(header)))
    return frames


def file_count(spark: SparkSession, path: str, glob: str | None) -> int:
    reader = spark.read.format("text")
    return len((reader.option("pathGlobFilter", glob) if glob else reader).load(path).inputFiles())


def read_csv(spark: SparkSession, path: str, glob: str | None = None, na_tokens: Iterable[str] = (),
             infer: bool = True) -> DataFrame | None:
    """Read a file or the matching files of a folder; one CSV scan per kind of file, unioned by name."""
    frames = _groups(spark, path, glob)
    if not frames:
        return None
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    cols = [c for c in out.columns if c not in ("source_file", BAD_ENCODING, *ARRIVAL)]
    out = conform_content(_null_tokens(out, cols, na_tokens))
    fixed = {f.name for f in CONTENT_SCHEMA.fields}
    return infer_types(out, [c for c in cols if normalize_name(c) not in fixed]) if infer else out


def _shown(df: DataFrame, arrival: bool, flags: bool) -> DataFrame:
    return df.drop(*([] if arrival else ARRIVAL), *([] if flags else [BAD_ENCODING]))


def ingest_csv_file(spark: SparkSession, path: str, arrival: bool = False, flags: bool = False, **kw) -> DataFrame:
    """One CSV file; a missing file raises (PATH_NOT_FOUND from Spark). ``flags`` adds ``bad_encoding``."""
    df = read_csv(spark, path, **kw)
    if df is None:
        return spark.createDataFrame([], T.StructType([]))
    return _shown(df.drop("source_file"), arrival, flags)


def ingest_folder(spark: SparkSession, folder: str, arrival: bool = False, flags: bool = False, **kw) -> DataFrame:
    """All top-level ``*.csv`` files (suffix case-sensitive), ``source_file`` = base name; none -> empty frame."""
    df = read_csv(spark, folder, glob="*.csv", **kw)
    if df is None:
        logging.getLogger(__name__).warning("No CSV files found in %s", folder)
        return spark.createDataFrame([], T.StructType([]))
    return _shown(df, arrival, flags)
