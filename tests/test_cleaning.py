from laborlake.operators.silver import build_silver, clean, transform_content_events

SCHEMA = "content_id string, title string, category string, department string, labor_hours int, region string"


def _frame(spark, *rows, extra=""):
    return spark.createDataFrame(list(rows), SCHEMA + extra)


def test_one_row_per_key(spark):
    out = clean(_frame(spark, *[(k, "t", "c", "d", h, "r") for k, h in [("a", 1), ("a", 2), ("b", 3), ("a", 4)]]))
    assert sorted(r.content_id for r in out.collect()) == ["a", "b"]


def test_header_names_are_normalized(spark):
    odd = _frame(spark, ("a", "t", "c", "d", 1, "r")).toDF("Content ID ", "TITLE", "category", " Department", "Labor Hours", "region")
    assert clean(odd).columns == ["content_id", "title", "category", "department", "labor_hours", "region"]


def test_all_white_space_around_texts_goes(spark):
    out = clean(_frame(spark, ("a", " \t one\n", "\x0bc ", "d", 1, "r"), ("b", "two  words ", "c", " d", 1, "\rr")))
    assert sorted(tuple(r)[1:4] for r in out.collect()) == [("one", "c", "d"), ("two  words", "c", "d")]


def test_first_row_without_department_takes_its_key_with_it(spark):
    rows = [("a", "t", "c", None, 5, "r", 0), ("a", "t", "c", "d", 5, "r", 1), ("b", "t", "c", "d", 5, "r", 0)]
    assert [r.content_id for r in clean(_frame(spark, *rows, extra=", ingest_seq long")).collect()] == ["b"]


def test_padded_keys_stay_distinct_then_collapse(spark):
    out = clean(_frame(spark, (" a", "t", "c", "d", 5, "r"), ("a", "t", "c", "d", 6, "r")))
    assert [r.content_id for r in out.collect()] == ["a", "a"]


def test_arrival_decides_not_the_alphabet(spark):
    rows = [("a", "alpha", "c", "d", 5, "r", "p", 0, 7), ("a", "zeta", "c", "d", 5, "r", "p", 0, 3), ("a", "beta", "c", "d", 5, "r", "q", 0, 1)]
    extra = ", arrival_part string, arrival_block long, arrival_pos long"
    assert [r.title for r in clean(_frame(spark, *rows, extra=extra)).collect()] == ["zeta"]


def test_hours_that_are_no_whole_number_are_not_cut(spark):
    texts = ["7", " 8 ", "9.0", "100.5", "0.5", "ten", "", None, "99999999999"]
    df = spark.createDataFrame([(str(i), "t", "c", "d", h, "r") for i, h in enumerate(texts)], SCHEMA.replace("labor_hours int", "labor_hours string"))
    from laborlake.functions.expressions import conform_content
    got = {r.content_id: (r.labor_hours, r.labor_hours_text) for r in conform_content(conform_content(df)).collect()}
    assert got == {"0": (7, None), "1": (8, None), "2": (9, None), "3": (None, "100.5"), "4": (None, "0.5"), "5": (None, "ten"),
                   "6": (None, ""), "7": (None, None), "8": (None, "99999999999")}


def test_silver_has_canonical_columns(sample_events):
    out = build_silver(sample_events)
    assert out.columns == ["content_id", "title", "category", "region", "department", "labor_hours", "labor_flag",
                           "event_type", "event_timestamp", "pipeline_layer", "pipeline_version", "processed_at"]
    assert {r.category for r in out.collect()} == {"FEATURE", "SERIAL", "SHORT"}


def test_x1_parses_time_and_flags(sample_events):
    rows = {r.content_id: r for r in transform_content_events(sample_events).collect()}
    assert {k: r.labor_flag for k, r in rows.items()} == {"K-01": "MEDIUM", "K-02": "HIGH", "K-03": "LOW", "K-04": "HIGH", "K-05": "MEDIUM"}
    assert rows["K-04"].event_timestamp.isoformat().startswith("2024-01-09T23:59:59")
    assert "timestamp" not in transform_content_events(sample_events).columns
