"""The seven warehouse reports over silver.content_events_clean.

DataFrame forms of the reports, and in ``REPORT_SQL`` the same as Spark SQL text over the ``silver`` tables of a warehouse
(``report_from_sql``); both give the same plans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from laborlake.functions.expressions import month_of


def labor_by_department(silver: DataFrame) -> DataFrame:
    """Per (department, region) count, sum, rounded avg, max and HIGH count."""
    return (silver.groupBy("department", "region")
            .agg(F.count("content_id").alias("total_projects"),
                 F.sum("labor_hours").alias("total_labor_hours"),
                 F.round(F.avg("labor_hours"), 2).alias("avg_labor_hours"),
                 F.max("labor_hours").alias("max_labor_hours"),
                 F.sum(F.when(F.col("labor_flag") == "HIGH", 1).otherwise(0)).alias("high_effort_projects"))
            .orderBy(F.desc("total_labor_hours")))


def category_region_volume(silver: DataFrame) -> DataFrame:
    """R2: per (category, region) titles and hours; category asc, titles desc."""
    return (silver.groupBy("category", "region")
            .agg(F.count("content_id").alias("total_titles"),
                 F.sum("labor_hours").alias("total_labor_hours"))
            .orderBy(F.asc("category"), F.desc("total_titles")))


def labor_flag_distribution(silver: DataFrame) -> DataFrame:
    """Rows per flag and share of all rows in percent (window over the <= 3 aggregated rows)."""
    counts = silver.groupBy("labor_flag").agg(F.count(F.lit(1)).alias("count"))
    share = F.round(F.lit(100.0).cast("double") * F.col("count") / F.sum("count").over(Window.partitionBy()), 2)
    return counts.select("labor_flag", "count", share.alias("percentage")).orderBy(F.desc("count"))


def monthly_throughput(silver: DataFrame) -> DataFrame:
    """Records and hours per processed month (yyyy-MM)."""
    return (silver.groupBy(month_of("processed_at").alias("month"))
            .agg(F.count("content_id").alias("records_processed"),
                 F.sum("labor_hours").alias("total_hours"))
            .orderBy("month"))


def top_effort(silver: DataFrame, k: int = 5) -> DataFrame:
    """Top-k by labor_hours (content_id breaks ties); planned as TakeOrderedAndProject."""
    return (silver.select("content_id", "title", "department", "labor_hours", "labor_flag", "region")
            .orderBy(F.desc("labor_hours"), F.asc("content_id"))
            .limit(k))


def above_average_departments(silver: DataFrame) -> DataFrame:
    """Departments whose mean labor_hours exceeds the global mean (scalar computed once)."""
    overall = silver.agg(F.avg("labor_hours")).scalar()  # uncorrelated scalar subquery
    return (silver.groupBy("department").agg(F.avg("labor_hours").alias("_a"))
            .where(F.col("_a") > overall)
            .select("department", F.round("_a", 2).alias("avg_hours"))
            .orderBy(F.desc("avg_hours")))


def hours_variance(silver: DataFrame, labor_logs: DataFrame) -> DataFrame:
    """Planned vs logged hours per content; unmatched content keeps null logged/variance.

    labor_logs is summed per project first (partial aggregation, one row per
    project), then joined; the join reuses the aggregate's hash partitioning.
    Equal to join-then-group while content_id is unique in silver (its PK).
    """
    return hours_variance_from_sums(silver, hours_by_project(labor_logs))


def hours_by_project(labor_logs: DataFrame) -> DataFrame:
    """Logged hours, one row per project (partial aggregation: a project that holds a third of all logs is a row per map task)."""
    return labor_logs.groupBy("project_id").agg(F.sum("hours_logged").alias("actual_logged_hours"))


def hours_variance_from_sums(silver: DataFrame, logged: DataFrame) -> DataFrame:
    """R7 from hours that are summed per project already; over tables bucketed alike the join needs no shuffle."""
    j = silver.join(logged, silver.content_id == logged.project_id, "left")
    return (j.select("content_id", "title", "department",
                     F.col("labor_hours").alias("event_labor_hours"),
                     "actual_logged_hours",
                     (F.col("labor_hours") - F.col("actual_logged_hours")).alias("variance"))
            .orderBy(F.desc("variance")))


def silver_preview(silver: DataFrame) -> DataFrame:
    """The processed-records projection shown after a run."""
    return silver.select("content_id", "title", "category", "department", "labor_hours", "labor_flag", "region")


REPORT_SQL = {
    "labor_by_department": """
SELECT department, region, count(content_id) AS total_projects, sum(labor_hours) AS total_labor_hours,
       round(avg(labor_hours), 2) AS avg_labor_hours, max(labor_hours) AS max_labor_hours,
       count_if(labor_flag = 'HIGH') AS high_effort_projects
FROM {content}
GROUP BY ALL ORDER BY total_labor_hours DESC""",
    "category_region_volume": """
SELECT category, region, count(content_id) AS total_titles, sum(labor_hours) AS total_labor_hours
FROM {content}
GROUP BY ALL ORDER BY category, total_titles DESC""",
    "labor_flag_distribution": """
WITH flags AS (SELECT labor_flag, count(*) AS count FROM {content} GROUP BY ALL)
SELECT labor_flag, count, round(100D * count / sum(count) OVER (), 2) AS percentage
FROM flags ORDER BY count DESC""",
    "monthly_throughput": """
SELECT date_format(processed_at, 'yyyy-MM') AS month, count(content_id) AS records_processed, sum(labor_hours) AS total_hours
FROM {content}
GROUP BY ALL ORDER BY month""",
    "top_effort": """
SELECT content_id, title, department, labor_hours, labor_flag, region
FROM {content} ORDER BY labor_hours DESC, content_id LIMIT 5""",
    "above_avg_departments": """
WITH means AS (SELECT department, avg(labor_hours) AS mean FROM {content} GROUP BY ALL)
SELECT department, round(mean, 2) AS avg_hours
FROM means WHERE mean > (SELECT avg(labor_hours) FROM {content}) ORDER BY avg_hours DESC""",
    "hours_variance": """
WITH logged AS (SELECT project_id, sum(hours_logged) AS actual_logged_hours FROM {labor_logs} GROUP BY ALL)
SELECT c.content_id, c.title, c.department, c.labor_hours AS event_labor_hours, l.actual_logged_hours,
       c.labor_hours - l.actual_logged_hours AS variance
FROM {content} c LEFT JOIN logged l ON c.content_id = l.project_id ORDER BY variance DESC""",
}


def report_from_sql(spark: SparkSession, name: str, prefix: str = "") -> DataFrame:
    """A report's SQL text over the tables of the warehouse whose databases begin with ``prefix``."""
    return spark.sql(REPORT_SQL[name].format(content=f"{prefix}silver.content_events_clean", labor_logs=f"{prefix}silver.labor_logs"))
