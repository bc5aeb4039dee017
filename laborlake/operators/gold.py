"""Gold-layer aggregates over silver.

All are hash aggregates on low-cardinality keys: partial aggregation on the
map side, one small shuffle, final aggregation. ``drop_null_keys`` chooses the
pandas behaviour (null group dropped) or the SQL one (null group kept).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laborlake.functions.expressions import labor_flag
from laborlake.schemas import CRITICAL_COLUMNS


def _high(flag: str = "labor_flag"):
    return F.sum(F.when(F.col(flag) == "HIGH", 1).otherwise(0))


def _keys(df: DataFrame, keys: list[str], drop_null_keys: bool) -> DataFrame:
    if not drop_null_keys:
        return df
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return df.where(cond)


def aggregate_labor_by_department(df: DataFrame) -> DataFrame:
    """A1: by (department, region): sum, avg, count, max of labor_hours; total desc."""
    return (df.groupBy("department", "region")
            .agg(F.sum("labor_hours").alias("total_labor_hours"),
                 F.avg("labor_hours").alias("avg_labor_hours"),
                 F.count("content_id").alias("total_projects"),
                 F.max("labor_hours").alias("max_labor_hours"))
            .orderBy(F.desc("total_labor_hours")))


def aggregate_by_category(df: DataFrame) -> DataFrame:
    """A2: by category: count, sum, avg; total_titles desc."""
    return (df.groupBy("category")
            .agg(F.count("content_id").alias("total_titles"),
                 F.sum("labor_hours").alias("total_labor_hours"),
                 F.avg("labor_hours").alias("avg_labor_hours"))
            .orderBy(F.desc("total_titles")))


def department_summary(df: DataFrame, drop_null_keys: bool = True) -> DataFrame:
    """A3: by department: projects, hours, mean, HIGH count; numbers rounded to 2; sorted by key."""
    return (_keys(df, ["department"], drop_null_keys).groupBy("department")
            .agg(F.count("content_id").alias("total_projects"),
                 F.sum("labor_hours").alias("total_hours"),
                 F.round(F.avg("labor_hours"), 2).alias("avg_hours"),
                 _high().alias("high_effort"))
            .orderBy("department"))


def category_summary(df: DataFrame, drop_null_keys: bool = True) -> DataFrame:
    """A4: by category: titles, hours, mean rounded to 2; sorted by key."""
    return (_keys(df, ["category"], drop_null_keys).groupBy("category")
            .agg(F.count("content_id").alias("total_titles"),
                 F.sum("labor_hours").alias("total_hours"),
                 F.round(F.avg("labor_hours"), 2).alias("avg_hours"))
            .orderBy("category"))


def department_total(df: DataFrame, drop_null_keys: bool = True) -> DataFrame:
    """A5: total labor hours per department."""
    return (_keys(df, ["department"], drop_null_keys).groupBy("department")
            .agg(F.sum("labor_hours").alias("total_labor_hours")))


# ---- one pass for all gold frames -------------------------------------------------------------

def group_state(df: DataFrame) -> DataFrame:
    """Counts, sums and maxima per (department, region, category): all gold frames follow from it, and states add up.

    One scan and one partial aggregate; the rows are the groups, however large the silver table is.
    """
    return df.groupBy("department", "region", "category").agg(
        F.count("content_id").alias("ids"), F.count("labor_hours").alias("hours_known"), F.sum("labor_hours").alias("hours"),
        F.max("labor_hours").alias("most_hours"), _high().alias("high"))


GROUP = ["department", "region", "category"]


def support(df: DataFrame, sign: int = 1) -> DataFrame:
    """Rows per (department, region, category, labor_hours), counted ``sign`` each.

    Supports add up and can be taken back, a maximum among them: the largest hours that some row still has.
    """
    return df.groupBy(*GROUP, "labor_hours").agg((F.count("content_id") * sign).alias("n"))


def merge_support(parts: DataFrame) -> DataFrame:
    """The sum of supports; what no row holds any more goes."""
    return parts.groupBy(*GROUP, "labor_hours").agg(F.sum("n").alias("n")).where(F.col("n") != 0)


def state_from_support(held: DataFrame) -> DataFrame:
    """``group_state`` from a merged support."""
    known = F.when(F.col("labor_hours").isNotNull(), F.col("n"))
    return held.groupBy(*GROUP).agg(
        F.sum("n").alias("ids"), F.coalesce(F.sum(known), F.lit(0)).alias("hours_known"), F.sum(F.col("labor_hours") * F.col("n")).alias("hours"),
        F.max("labor_hours").alias("most_hours"), F.sum(F.when(labor_flag("labor_hours") == "HIGH", F.col("n")).otherwise(0)).alias("high"))


def _from_state(state: DataFrame, keys: list[str], names: dict[str, str], rounded: bool = False) -> DataFrame:
    """Aggregates of a coarser group; ``names``: ids, hours, mean, most or high -> column. Rows with a null first key go."""
    mean = F.try_divide(F.sum("hours"), F.sum("hours_known"))
    of = {"ids": F.sum("ids"), "hours": F.sum("hours"), "mean": F.round(mean, 2) if rounded else mean, "most": F.max("most_hours"), "high": F.sum("high")}
    return state.where(F.col(keys[0]).isNotNull()).groupBy(*keys).agg(*[of[k].alias(n) for k, n in names.items()])


def gold_frames(state: DataFrame) -> dict[str, DataFrame]:
    """The frames of ``gold_layer`` and the two warehouse tables, from ``group_state``."""
    total = {"ids": "total_projects", "hours": "total_labor_hours", "mean": "avg_labor_hours"}
    return {
        "department_summary": _from_state(state, ["department"], {"ids": "total_projects", "hours": "total_hours", "mean": "avg_hours",
                                                                  "high": "high_effort"}, True).orderBy("department"),
        "category_summary": _from_state(state, ["category"], {"ids": "total_titles", "hours": "total_hours", "mean": "avg_hours"},
                                        True).orderBy("category"),
        "department_labor_summary": _from_state(state, ["department", "region"], {**total, "high": "high_effort_count"})
        .withColumn("summary_date", F.current_date()),
        "category_summary_table": _from_state(state, ["category"], {**total, "ids": "total_titles"}).withColumn("summary_date", F.current_date()),
    }


def labor_by_department_from_state(state: DataFrame) -> DataFrame:
    """A1 for the departments that are known, from ``group_state``."""
    return _from_state(state, ["department", "region"], {"hours": "total_labor_hours", "mean": "avg_labor_hours", "ids": "total_projects",
                                                         "most": "max_labor_hours"})


def gold_layer(df: DataFrame) -> dict[str, DataFrame]:
    """The two pandas-path gold frames."""
    return {"department_summary": department_summary(df), "category_summary": category_summary(df)}


# ---- gold warehouse tables (K9, K10): the DDL's columns --------------------------------------

def department_labor_summary_table(df: DataFrame) -> DataFrame:
    """gold.department_labor_summary: department NOT NULL, so the null group is not emitted."""
    return (df.where(F.col(CRITICAL_COLUMNS[1]).isNotNull()).groupBy("department", "region")
            .agg(F.count("content_id").alias("total_projects"),
                 F.sum("labor_hours").alias("total_labor_hours"),
                 F.avg("labor_hours").alias("avg_labor_hours"),
                 _high().alias("high_effort_count"))
            .withColumn("summary_date", F.current_date()))


def category_summary_table(df: DataFrame) -> DataFrame:
    """gold.category_summary: category NOT NULL."""
    return (df.where(F.col("category").isNotNull()).groupBy("category")
            .agg(F.count("content_id").alias("total_titles"),
                 F.sum("labor_hours").alias("total_labor_hours"),
                 F.avg("labor_hours").alias("avg_labor_hours"))
            .withColumn("summary_date", F.current_date()))
