"""Data-quality validation (one scan, one key-partitioned aggregate) and table rules.

``validation_report`` returns a one-row DataFrame:
  total_rows BIGINT, null_counts MAP<STRING,BIGINT>, missing_columns ARRAY<STRING>,
  duplicate_count BIGINT, invalid_labor BIGINT, unparsed_hours BIGINT, passed BOOLEAN, warnings ARRAY<STRING>

Rules (the reference's order): missing required columns fail and stop the other
checks; nulls in content_id/department fail; duplicates and labor_hours <= 0 only
warn (rows are kept).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from laborlake.functions.expressions import is_invalid_hours
from laborlake.schemas import (
    BAD_ENCODING, CRITICAL_COLUMNS, DUPLICATE_WARNING, HOURS_TEXT, INVALID_LABOR_WARNING, LABOR_FLAGS, REQUIRED_COLUMNS,
    UNPARSED_HOURS_WARNING,
)


class ValidationError(ValueError):
    """Raised by the pipeline gate when the validation report did not pass."""


def _null_col(c: str) -> str:
    return f"null_{c}"


def per_key_counters(required: Sequence[str] = REQUIRED_COLUMNS, columns: Sequence[str] = ()) -> list[Column]:
    """Aggregate expressions of one key group: rows, nulls per required column, invalid and unparsed hours."""
    unparsed = F.count(HOURS_TEXT) if HOURS_TEXT in columns else F.sum(F.lit(0).cast("long"))
    return [
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col(c).isNull()).alias(_null_col(c)) for c in required],
        F.count_if(is_invalid_hours("labor_hours")).alias("bad"),
        unparsed.alias("unparsed"),
    ]


def validation_counts(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS,
                      key: str = "content_id") -> DataFrame:
    """One row of counters: total_rows, duplicate_count, invalid_labor, null_<col> for each required col.

    Stage 1 groups by the key with map-side partial aggregation (a hot key
    costs one row per map task), stage 2 is a global sum over the key groups.
    """
    return totals_from_per_key(df.groupBy(F.col(key)).agg(*per_key_counters(required, df.columns)), required)


def totals_from_per_key(per_key: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """Global sums over per-key counters (``per_key_counters``)."""
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast(T.LongType()).alias("total_rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast(T.LongType()).alias("duplicate_count"),
        F.coalesce(F.sum("bad"), F.lit(0)).cast(T.LongType()).alias("invalid_labor"),
        F.coalesce(F.sum("unparsed"), F.lit(0)).cast(T.LongType()).alias("unparsed_hours"),
        *[F.coalesce(F.sum(_null_col(c)), F.lit(0)).cast(T.LongType()).alias(_null_col(c)) for c in required],
    )


def _report_from_counts(counts: DataFrame, required: Sequence[str]) -> DataFrame:
    critical = sum((F.col(_null_col(c)) for c in CRITICAL_COLUMNS if c in required), F.lit(0))
    warnings = F.filter(F.array(
        F.when(F.col("duplicate_count") > 0,
               F.replace(F.lit(DUPLICATE_WARNING), F.lit("{n}"), F.col("duplicate_count").cast("string"))),
        F.when(F.col("invalid_labor") > 0,
               F.replace(F.lit(INVALID_LABOR_WARNING), F.lit("{n}"), F.col("invalid_labor").cast("string"))),
        F.when(F.col("unparsed_hours") > 0,
               F.replace(F.lit(UNPARSED_HOURS_WARNING), F.lit("{n}"), F.col("unparsed_hours").cast("string"))),
    ), lambda w: w.isNotNull())
    null_map = F.create_map(*[x for c in required for x in (F.lit(c), F.col(_null_col(c)))])
    return counts.select(
        "total_rows",
        null_map.alias("null_counts"),
        F.array().cast(T.ArrayType(T.StringType())).alias("missing_columns"),
        "duplicate_count",
        "invalid_labor",
        "unparsed_hours",
        (critical == 0).alias("passed"),
        warnings.alias("warnings"),
    )


def report_from_per_key(per_key: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """The validation report from an already grouped frame (see ``silver.group_raw``)."""
    return _report_from_counts(totals_from_per_key(per_key, required), required)


def report_from_totals(totals: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """The validation report from rows of counters that add up, one a batch (``totals_from_per_key``, duplicates over all batches)."""
    names = ["total_rows", "duplicate_count", "invalid_labor", "unparsed_hours", *[_null_col(c) for c in required]]
    return _report_from_counts(totals.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast(T.LongType()).alias(c) for c in names]), required)


def validation_report(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """The one-row validation report (V1-V6)."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        # V1 fails early: only total_rows is filled, the other counters stay 0.
        return df.agg(F.count(F.lit(1)).alias("total_rows")).select(
            "total_rows",
            F.create_map().cast(T.MapType(T.StringType(), T.LongType())).alias("null_counts"),
            F.array(*[F.lit(c) for c in missing]).alias("missing_columns"),
            F.lit(0).cast(T.LongType()).alias("duplicate_count"),
            F.lit(0).cast(T.LongType()).alias("invalid_labor"),
            F.lit(0).cast(T.LongType()).alias("unparsed_hours"),
            F.lit(False).alias("passed"),
            F.array().cast(T.ArrayType(T.StringType())).alias("warnings"),
        )
    return _report_from_counts(validation_counts(df, required), required)


def validate(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS,
             report: DataFrame | None = None) -> tuple[bool, dict]:
    """``(passed, report)`` like the reference; the only driver collect is the one report row."""
    row = (report if report is not None else validation_report(df, required)).first()
    report = row.asDict(recursive=True)
    report["null_counts"] = dict(report["null_counts"] or {})
    report["missing_columns"] = list(report["missing_columns"] or [])
    report["warnings"] = list(report["warnings"] or [])
    return bool(report["passed"]), report


def failure_reason(report: dict) -> str:
    if report["missing_columns"]:
        return f"Validation failed. Missing columns: {report['missing_columns']}"
    crit = {c: report["null_counts"].get(c, 0) for c in CRITICAL_COLUMNS}
    return f"Validation failed. Critical null values: {crit}"


# ---- V7: table constraints of the warehouse DDL, enforced as a rule table -------------------

def _sql_check(expr: Column) -> Column:
    """SQL CHECK semantics: a row violates only when the predicate is FALSE (null passes)."""
    return expr.eqNullSafe(F.lit(False))


# VARCHAR(n) lengths of the warehouse DDL; a longer value would fail the whole insert.
CONTENT_LENGTHS = {"content_id": 50, "title": 255, "category": 50, "region": 20, "department": 100,
                   "labor_flag": 10, "event_type": 50, "pipeline_layer": 10, "pipeline_version": 10}
LABOR_LOG_LENGTHS = {"employee_id": 20, "project_id": 50, "department": 100, "role": 100, "week": 10}


def _length_rules(limits: dict[str, int]) -> list[tuple[str, Column]]:
    return [(f"{c}_length", _sql_check(F.char_length(F.col(c)) <= n)) for c, n in limits.items()]


def content_rules() -> list[tuple[str, Column]]:
    """(rule name, violation predicate) of silver.content_events_clean."""
    return [
        ("content_id_not_null", F.col("content_id").isNull()),
        ("title_not_null", F.col("title").isNull()),
        ("department_not_null", F.col("department").isNull()),
        ("labor_hours_positive", _sql_check(F.col("labor_hours") > 0)),
        ("labor_flag_in_set", _sql_check(F.col("labor_flag").isin(*LABOR_FLAGS))),
    ] + _length_rules(CONTENT_LENGTHS)


def hours_type_rule() -> tuple[str, Column]:
    """For frames that carry ``labor_hours_text`` (see ``conform_content``)."""
    return "labor_hours_type", F.col(HOURS_TEXT).isNotNull()


def utf8_rule() -> tuple[str, Column]:
    """For frames that carry ``bad_encoding`` (rows of files)."""
    return "utf8_text", F.col(BAD_ENCODING)


def bronze_rules() -> list[tuple[str, Column]]:
    """bronze.content_events_raw: the key is NOT NULL, and the lengths of its VARCHAR columns."""
    lengths = {c: CONTENT_LENGTHS[c] for c in ("content_id", "title", "category", "region", "department", "event_type")}
    return [("content_id_not_null", F.col("content_id").isNull())] + _length_rules(lengths)


def labor_log_rules() -> list[tuple[str, Column]]:
    return [
        ("employee_id_not_null", F.col("employee_id").isNull()),
        ("hours_logged_non_negative", _sql_check(F.col("hours_logged") >= 0)),
    ] + _length_rules(LABOR_LOG_LENGTHS)


def apply_rules(df: DataFrame, rules: list[tuple[str, Column]], key: str | None = None, repeated: DataFrame | None = None) -> DataFrame:
    """Tag each row with ``violations ARRAY<STRING>`` (empty = accepted).

    With ``key`` the primary-key rule is enforced too: every row of a key that
    occurs more than once is a violation (``primary_key_unique``), counted by a window
    over the key, with no second pass over ``df``. Both callers' keys are unique before
    the rule (one row per raw key; hash and ordinal of a log record), so only
    a few rows share a key here and none is hot. Where ``df`` lies in files, ``repeated``
    (``repeated_keys``, staged) takes the window's place: then no row but those keys is shuffled.
    """
    tags = [F.when(pred, F.lit(name)) for name, pred in rules]
    if key is not None:
        if repeated is None:
            df = df.withColumn("_same_key", F.count(F.lit(1)).over(Window.partitionBy(key)))
        else:
            twice = repeated.select(F.col(key).alias("_twice"), F.lit(2).alias("_same_key"))
            df = df.join(twice, F.col(key) == F.col("_twice"), "left")
        tags.append(F.when(F.col(key).isNotNull() & (F.col("_same_key") > 1), F.lit("primary_key_unique")))
    found = F.filter(F.array(*tags), lambda t: t.isNotNull())
    if tags:  # the lambda is slow, and few rows break a rule
        found = F.when(reduce(or_, [t.isNotNull() for t in tags]), found).otherwise(F.array().cast(T.ArrayType(T.StringType())))
    return df.withColumn("violations", found).drop("_same_key", "_twice")


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """The keys that more than one row has."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(key)


def split_by_rules(df: DataFrame, rules: list[tuple[str, Column]],
                   key: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(accepted rows without the tag column, quarantined rows with ``violations``)."""
    tagged = apply_rules(df, rules, key)
    accepted = tagged.where(F.size("violations") == 0).drop("violations")
    quarantined = tagged.where(F.size("violations") > 0)
    return accepted, quarantined
