"""Pure Column expressions shared by the batch and the streaming plans.

All are built-in Catalyst expressions (whole-stage codegen, no Python per row).
"""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from laborlake.schemas import (
    CONTENT_SCHEMA, HIGH_THRESHOLD, HOURS_TEXT, MEDIUM_THRESHOLD, PIPELINE_LAYER, PIPELINE_VERSION, WHITESPACE,
)


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: str | Column) -> Column:
    """Python ``str.strip()``: remove leading/trailing ASCII whitespace (not only spaces)."""
    return F.btrim(col_of(c), F.lit(WHITESPACE))


def upper_strip(c: str | Column) -> Column:
    return F.upper(strip_ws(c))


def labor_flag(hours: str | Column = "labor_hours") -> Column:
    """HIGH above 100 hours, MEDIUM above 50, else LOW (null and negative hours are LOW)."""
    h = col_of(hours)
    return (F.when(h > HIGH_THRESHOLD, F.lit("HIGH"))
            .when(h > MEDIUM_THRESHOLD, F.lit("MEDIUM"))
            .otherwise(F.lit("LOW")))


def parse_event_time(c: str | Column = "timestamp") -> Column:
    """ISO-8601 text (``2024-01-10T09:00:00Z``) to TIMESTAMP; unparsable text gives null, not an error."""
    return F.try_to_timestamp(col_of(c))


def run_time_literal(ts: _dt.datetime | None = None) -> Column:
    """One run-level ``processed_at`` so every row of a run carries the same instant."""
    ts = ts or _dt.datetime.now(_dt.timezone.utc).replace(microsecond=0)
    return F.lit(ts).cast(T.TimestampType())


def silver_metadata(processed_at: Column | None = None) -> list[Column]:
    return [
        F.lit(PIPELINE_LAYER).alias("pipeline_layer"),
        F.lit(PIPELINE_VERSION).alias("pipeline_version"),
        (processed_at if processed_at is not None else run_time_literal()).alias("processed_at"),
    ]


def is_invalid_hours(c: str | Column = "labor_hours") -> Column:
    """``labor_hours <= 0``; null is not invalid (comparison with null is false)."""
    return F.coalesce(col_of(c) <= 0, F.lit(False))


_SPACE_RE = re.compile(" ")


def normalize_name(name: str) -> str:
    """Header normalization: strip, lower-case, spaces to underscores."""
    return _SPACE_RE.sub("_", name.strip().lower())


def normalize_columns(df: DataFrame) -> DataFrame:
    names = [normalize_name(c) for c in df.columns]
    dupes = sorted({n for n in names if names.count(n) > 1})
    if dupes:
        raise ValueError(f"column names collide after normalization: {dupes}")
    return df.toDF(*names)


def strip_string_columns(df: DataFrame) -> DataFrame:
    """Strip every string column in one projection."""
    cols = [strip_ws(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.StringType)
            else F.col(f"`{f.name}`") for f in df.schema.fields]
    return df.select(*cols)


def month_of(c: str | Column) -> Column:
    return F.date_format(col_of(c), "yyyy-MM")


def iso_week(c: str | Column) -> Column:
    """``2024-W10`` style ISO week label of a date/timestamp."""
    d = F.to_date(col_of(c))
    # ISO year = year of the Thursday in the same ISO week.
    thursday = F.date_add(d, 3 - ((F.dayofweek(d) + 5) % 7))
    # As format_string("%d-W%02d", year, week), also of null, without a formatter per row.
    year, week = F.year(thursday).cast("string"), F.lpad(F.weekofyear(d).cast("string"), 2, "0")
    return F.concat(F.coalesce(year, F.lit("null")), F.lit("-W"), F.coalesce(week, F.lit("null")))


def conform_content(df: DataFrame) -> DataFrame:
    """Content columns (by normalized name) with their fixed types; all other columns as they are.

    ``labor_hours`` becomes INT where it is a whole number. Any other non-null value is kept as text
    in ``labor_hours_text``, for the table rules; it is never cut or dropped.
    """
    fixed = {f.name: f.dataType for f in CONTENT_SCHEMA.fields}
    out: list[Column] = []
    spare = None
    for c in df.columns:
        name = normalize_name(c)
        x = F.col(f"`{c}`")
        if name == "labor_hours" and df.schema[c].dataType == fixed[name]:
            out.append(x)
            spare = F.lit(None).cast("string").alias(HOURS_TEXT)
        elif name == "labor_hours":
            text = strip_ws(x.cast("string"))
            plain, number = text.try_cast("int"), text.try_cast("double")  # the second only for what is no plain integer
            whole = (number == F.floor(number)) & (F.abs(number) < 2 ** 31)
            hours = F.when(plain.isNotNull(), plain).when(whole, number.cast("int"))
            out.append(hours.alias(c))
            spare = F.when(x.isNotNull() & plain.isNull() & ~F.coalesce(whole, F.lit(False)), x.cast("string")).alias(HOURS_TEXT)
        elif name in fixed:
            out.append(x.cast(fixed[name]).alias(c))
        elif name != HOURS_TEXT:
            out.append(x)
    if spare is not None and HOURS_TEXT in df.columns:  # conformed before
        spare = F.coalesce(F.col(HOURS_TEXT), spare).alias(HOURS_TEXT)
    return df.select(*out, *([spare] if spare is not None else []))
