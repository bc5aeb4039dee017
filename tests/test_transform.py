import pytest
from pyspark.sql import functions as F

from laborlake.functions.expressions import labor_flag, parse_event_time
from laborlake.operators.quality import ValidationError
from laborlake.operators.silver import transform


@pytest.mark.parametrize("hours,flag", [(150, "HIGH"), (101, "HIGH"), (100, "MEDIUM"), (85, "MEDIUM"),
                                        (51, "MEDIUM"), (50, "LOW"), (45, "LOW"), (0, "LOW"), (-5, "LOW"),
                                        (None, "LOW")])
def test_flag_thresholds(spark, hours, flag):
    df = spark.createDataFrame([(hours,)], "h int")
    assert df.select(labor_flag("h").alias("f")).first().f == flag


def test_transform_metadata_and_rows(valid_df):
    out, report = transform(valid_df)
    rows = out.collect()
    assert len(rows) == 3
    assert {r.pipeline_layer for r in rows} == {"silver"}
    assert {r.pipeline_version for r in rows} == {"1.0.0"}
    assert all(r.processed_at is not None for r in rows)
    assert report["passed"] is True


def test_transform_flags(valid_df):
    out, _ = transform(valid_df)
    assert {r.content_id: r.labor_flag for r in out.collect()} == {"V1": "HIGH", "V2": "MEDIUM", "V3": "LOW"}


def test_transform_keeps_invalid_hours(df_with_issues):
    out, _ = transform(df_with_issues)
    assert out.where(F.col("labor_hours") <= 0).count() == 1


def test_transform_gate_names_null_cause(spark, valid_df):
    bad = valid_df.withColumn("department", F.when(F.col("content_id") == "V1", None).otherwise(F.col("department")))
    with pytest.raises(ValidationError, match="Critical null"):
        transform(bad)


def test_bad_timestamp_is_null(spark):
    df = spark.createDataFrame([("2024-01-15T10:30:00Z",), ("not a time",), (None,)], "t string")
    got = [r.ts for r in df.select(parse_event_time("t").alias("ts")).collect()]
    assert got[0] is not None and got[1] is None and got[2] is None
