from pyspark.sql import functions as F

from laborlake.functions.expressions import iso_week, normalize_name
from laborlake.operators.dedup import keep_first
from laborlake.sources.pages import land_pages, stop_page
from laborlake.sources import tables


def test_iso_week_year_boundaries(spark):
    df = spark.createDataFrame([("2024-12-30",), ("2021-01-03",), ("2024-03-05",)], "d string")
    got = [r.w for r in df.select(iso_week(F.to_date("d")).alias("w")).collect()]
    assert got == ["2025-W01", "2020-W53", "2024-W10"]


def test_normalize_name():
    assert normalize_name("  Labor Hours ") == "labor_hours"


def test_keep_first_null_keys_form_one_group(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), ("a", 5)], "k string, seq int")
    out = sorted((r.k or "", r.seq) for r in keep_first(df, ["k"], ["seq"]).collect())
    assert out == [("", 1), ("a", 5)]


def test_landed_pages_cover_every_record(spark):
    recs = tables.labor_records(spark, "/root/testdata/sf0.001", order=True)
    pages = land_pages(recs, ["l_orderkey", "l_linenumber"])
    assert pages.select(F.sum(F.size("results")), F.max(F.size("results"))).first()[:] == (recs.count(), 100)
    assert stop_page(pages).first().stop == pages.agg(F.max("page")).first()[0] + 1


def test_equal_log_records_get_keys_of_their_own(spark):
    from laborlake.sinks.warehouse import with_log_id
    one = spark.range(25_000).select(F.lit("e").alias("employee_id"), F.lit(None).cast("string").alias("role"))
    keyed = with_log_id(one.unionByName(spark.createDataFrame([("f", "r")], one.schema)))
    assert keyed.agg(F.count("log_id"), F.countDistinct("log_id")).first()[:] == (25_001, 25_001)
    assert keyed.select("employee_id", "role").exceptAll(one).count() == 1


def test_no_second_scan_for_the_key_rule(spark):
    from laborlake.operators import quality
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4), (None, 5)], "k string, v int")
    tagged = quality.apply_rules(df, [], key="k")
    assert {(r.k, r.v): r.violations for r in tagged.collect()} == {
        ("a", 1): ["primary_key_unique"], ("a", 2): ["primary_key_unique"], ("b", 3): [], (None, 4): [], (None, 5): []}
    assert "Join" not in tagged._jdf.queryExecution().executedPlan().toString()


def test_scratch_needs_a_shared_folder_on_a_cluster(monkeypatch):
    from types import SimpleNamespace

    import pytest

    from laborlake import session
    context = SimpleNamespace(applicationId="other", master="yarn", getConf=lambda: {}, getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError):
        session.scratch_root(SimpleNamespace(sparkContext=context))
