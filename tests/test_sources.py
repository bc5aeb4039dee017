import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from laborlake.schemas import LABOR_PAGE_SCHEMA
from laborlake.sources.files import ingest_csv_file, ingest_folder
from laborlake.sources.pages import flatten_pages, records_to_frame
from laborlake.sources.topic import decode_events, split_dead_letters


@pytest.fixture
def tmpdir_():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


CSV_ROWS = 'id,region,h\n1,NA,5\n2,US,6,EXTRA\n3,EU\n4,,x\n5,"AP,AC",7\n6,US,,EXTRA\n7,US,8,\n8,US,8,,Z\n\n'


def test_csv_bad_rows(spark, tmpdir_):
    p = os.path.join(tmpdir_, "t.csv")
    open(p, "w").write(CSV_ROWS)
    df = ingest_csv_file(spark, p)
    assert df.count() == 4
    assert sorted(r.id for r in df.select("id").collect()) == [1, 3, 4, 5]
    rows = {r.id: r for r in df.collect()}
    assert rows[1].region == "NA"          # "NA" is not a null token by default
    assert rows[3].h is None               # short row padded
    assert rows[4].region is None          # empty field is null
    assert rows[5].region == "AP,AC"       # quoted separator
    assert dict(df.dtypes) == {"id": "bigint", "region": "string", "h": "string"}


def test_csv_na_tokens(spark, tmpdir_):
    p = os.path.join(tmpdir_, "t.csv")
    open(p, "w").write(CSV_ROWS)
    df = ingest_csv_file(spark, p, na_tokens=["NA"])
    assert df.where(F.col("id") == 1).first().region is None


def test_csv_missing_file_raises(spark, tmpdir_):
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        ingest_csv_file(spark, os.path.join(tmpdir_, "nope.csv"))


def test_folder_binds_by_name(spark, tmpdir_):
    os.makedirs(os.path.join(tmpdir_, "sub"))
    open(os.path.join(tmpdir_, "x.csv"), "w").write("a,b\n1,2\n3,4\n")
    open(os.path.join(tmpdir_, "y.csv"), "w").write("b,a\n5,6\n")
    open(os.path.join(tmpdir_, "z.CSV"), "w").write("a,b\n9,9\n")
    open(os.path.join(tmpdir_, "sub", "w.csv"), "w").write("a,b\n7,7\n")
    df = ingest_folder(spark, tmpdir_)
    assert sorted(tuple(r) for r in df.select("a", "b", "source_file").collect()) == [
        (1, 2, "x.csv"), (3, 4, "x.csv"), (6, 5, "y.csv")]


def test_quotes_and_line_ends(spark, tmpdir_):
    p = os.path.join(tmpdir_, "q.csv")
    open(p, "w").write('id,a,a\n1,"He said ""hi"", ok",x\n2,"one\ntwo","say ""no"""\n3,,""\n')
    rows = {r.id: tuple(r)[1:] for r in ingest_csv_file(spark, p).collect()}
    assert rows == {1: ('He said "hi", ok', "x"), 2: ("one\ntwo", 'say "no"'), 3: (None, None)}
    assert ingest_csv_file(spark, p).columns == ["id", "a", "a.1"]


def test_long_integers_stay_distinct(spark, tmpdir_):
    p = os.path.join(tmpdir_, "n.csv")
    open(p, "w").write("a,b,c\n1234567890123456789,99999999999999999999,1\n1234567890123456788,99999999999999999998,2.5\n")
    df = ingest_csv_file(spark, p)
    assert dict(df.dtypes) == {"a": "bigint", "b": "string", "c": "double"}
    assert df.select("a").distinct().count() == df.select("b").distinct().count() == 2


def test_folder_by_url_and_mixed_kinds(spark, tmpdir_):
    open(os.path.join(tmpdir_, "x.csv"), "w").write("content_id,k\n001,p\n")
    open(os.path.join(tmpdir_, "y.csv"), "w").write('content_id,k\n002,"q\n"\n')
    for folder in (tmpdir_, f"file://{tmpdir_}", f"file:{tmpdir_}/"):
        got = sorted((r.content_id, r.k.strip(), r.source_file) for r in ingest_folder(spark, folder).collect())
        assert got == [("001", "p", "x.csv"), ("002", "q", "y.csv")]


def test_folder_without_csv_is_empty(spark, tmpdir_):
    open(os.path.join(tmpdir_, "readme.txt"), "w").write("x")
    assert ingest_folder(spark, tmpdir_).count() == 0


def _page(n, k, nxt="?"):
    recs = [{"employee_id": f"E{n}{i}", "department": "D", "project_id": f"P{n}", "hours_logged": 1.0,
             "week": "2024-W10", "role": "R"} for i in range(k)]
    return {"page": n, "results": recs, "next": nxt}


def _pages(spark, pages):
    return spark.createDataFrame([(p["page"], p["results"], p["next"]) for p in pages], LABOR_PAGE_SCHEMA)


def test_pages_all(spark):
    df = _pages(spark, [_page(1, 2), _page(2, 3), _page(3, 1, None)])
    assert flatten_pages(df).count() == 6


def test_pages_stop_before_empty_page(spark):
    df = _pages(spark, [_page(1, 2), _page(2, 3), _page(3, 0), _page(4, 5, None)])
    assert flatten_pages(df).count() == 5


def test_pages_stop_after_falsy_next(spark):
    df = _pages(spark, [_page(1, 2), _page(2, 3, ""), _page(3, 4, None)])
    assert flatten_pages(df).count() == 5


def test_pages_stop_at_missing_page(spark):
    df = _pages(spark, [_page(1, 2), _page(3, 3), _page(4, 4, None)])
    assert flatten_pages(df).count() == 2
    assert flatten_pages(_pages(spark, [_page(2, 3, None)])).count() == 0


def test_records_missing_keys_are_null(spark):
    df = spark.read.json(spark.sparkContext.parallelize([json.dumps({"employee_id": "E1", "hours_logged": 3})]))
    out = records_to_frame(df).first()
    assert out.employee_id == "E1" and out.project_id is None and out.hours_logged == 3.0


def test_topic_decode_and_dead_letters(spark):
    good = json.dumps({"content_id": "A", "title": "t", "category": "c", "region": "US", "department": "D",
                       "labor_hours": 5, "timestamp": "2024-01-01T00:00:00Z", "event_type": "e"})
    missing = json.dumps({"content_id": "B", "title": "t"})
    msgs = spark.createDataFrame([(good,), ("{bad",), (None,), (missing,), ('{"k": 1}',)], "value string")
    ok, dead = split_dead_letters(decode_events(msgs))
    assert sorted(r.content_id for r in ok.collect()) == ["A", "B"]
    assert ok.where(F.col("content_id") == "B").first().labor_hours is None
    assert dead.count() == 3
    assert dead.where(F.col("value") == "{bad").first()["_corrupt_record"] == "{bad"


def test_topic_failfast_raises(spark):
    msgs = spark.createDataFrame([("{bad",)], "value string")
    with pytest.raises(Exception):
        decode_events(msgs, failfast=True).collect()
