from pyspark.sql import types as T

from laborlake.operators.quality import validate, validation_report


def test_valid_df_passes(valid_df):
    passed, report = validate(valid_df)
    assert passed is True
    assert report["missing_columns"] == []
    assert report["warnings"] == []


def test_missing_column_fails_and_stops(valid_df):
    passed, report = validate(valid_df.drop("department"))
    assert passed is False
    assert report["missing_columns"] == ["department"]
    assert report["total_rows"] == 3
    assert report["duplicate_count"] == 0 and report["invalid_labor"] == 0


def test_duplicates_and_invalid_hours_warn(df_with_issues):
    passed, report = validate(df_with_issues)
    assert passed is True
    assert report["total_rows"] == 3
    assert report["duplicate_count"] == 1
    assert report["invalid_labor"] == 1
    assert report["warnings"] == ["1 duplicate content_id(s) found", "1 row(s) with invalid labor_hours (<= 0)"]


def test_empty_input_passes_with_zero_rows(spark, valid_df):
    passed, report = validate(spark.createDataFrame([], valid_df.schema))
    assert passed is True
    assert report["total_rows"] == 0


def test_critical_nulls_fail(spark):
    df = spark.createDataFrame([("A", "t", "c", None, 5, "US"), (None, "t", "c", "D", 5, "US"),
                                (None, "t", "c", "D", 5, "US")],
                               "content_id string, title string, category string, department string, "
                               "labor_hours int, region string")
    passed, report = validate(df)
    assert passed is False
    assert report["null_counts"]["department"] == 1
    assert report["null_counts"]["content_id"] == 2
    # two null keys are one key: one duplicate
    assert report["duplicate_count"] == 1


def test_one_of_each_finding(spark):
    rows = [("a", "t", "c", "d", 9, "r"), ("a", "u", "c", "d", 9, "r"), ("b", "t", "c", "d", 0, "r"), ("c", "t", None, "d", None, "r")]
    passed, report = validate(spark.createDataFrame(rows, "content_id string, title string, category string, department string, "
                                                          "labor_hours int, region string"))
    assert (passed, report["total_rows"], report["duplicate_count"], report["invalid_labor"]) == (True, 4, 1, 1)
    assert len(report["warnings"]) == 2 and report["null_counts"]["category"] == 1


def test_report_schema(valid_df):
    rep = validation_report(valid_df)
    t = rep.schema["null_counts"].dataType
    assert (t.keyType, t.valueType) == (T.StringType(), T.LongType())
    assert rep.count() == 1
