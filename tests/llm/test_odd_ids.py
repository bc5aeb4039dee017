import corpus_pipeline as P
import pytest

from laborlake.llm import simhash

TEXT = "Some words that are the same in each of these rows, in the same order."
OTHER = "A second text which has nothing at all in common with the first one here."
KINDS = "Score double, TEXT string, doc_id long, text string, lang string, source string, n_chars long, Doc_Id string, extra map<string,int>"
ROWS = [(None, TEXT), (None, TEXT), (5, OTHER), (5, OTHER), (5, TEXT + " More."), (7, OTHER), (8, None), (9, ""), (None, ""), (None, "alone, " * 9), (None, "alone, " * 9)]


@pytest.fixture(scope="module")
def odd_ids(spark):
    rows = [(0.5, "x", d, t, "en", "src0", len(t or ""), "y", {"k": 1}) for d, t in ROWS]
    return spark.createDataFrame(rows, KINDS.replace("TEXT string", "other_text string").replace("Doc_Id", "other_id")).toDF(
        "Score", "TEXT", "doc_id", "text", "lang", "source", "n_chars", "Doc_Id", "extra")


@pytest.fixture(scope="module")
def first_names(odd_ids):
    """The needed names come first, their clashing twins later."""
    return odd_ids.toDF(*[f"c{i}" for i in range(9)]).select("c2", "c3", "c4", "c5", "c6", "c0", "c1", "c7", "c8").toDF(
        "doc_id", "text", "lang", "source", "n_chars", "Score", "TEXT", "Doc_Id", "extra")


def test_one_row_of_each_component(first_names):
    kept = simhash.keep_first(first_names)
    assert kept.columns == first_names.columns
    rows = [(r[0], r[1]) for r in kept.collect()]
    prints = {t: simhash.simhash(t) for _, t in ROWS}
    groups = []
    for t in prints:
        joined = [g for g in groups if any((prints[t] ^ prints[u]).bit_count() <= 2 for u in g)]
        groups = [g for g in groups if g not in joined] + [sum(joined, [t])]
    assert len(rows) == len(groups)
    for g in groups:
        mine = sorted((d is None, d or 0) for d, t in ROWS if t in g)
        assert [(d is None, d or 0) for d, t in rows if t in g] == mine[:1]


def test_links_through_rows_without_an_id(spark):
    """A chain whose middle has no id still joins its ends; a component without any id has a null name."""
    prints = [(1, 0b1), (None, 0b111), (2, 0b11111), (None, 0b1111111 << 40)]
    rows = spark.createDataFrame(prints, "doc_id long, fp long")
    got = {r["fp"]: r["component_id"] for r in simhash.component_table(rows, 2).collect()}
    assert got == {0b1: 1, 0b111: 1, 0b11111: 1, 0b1111111 << 40: None}


def test_every_stage_takes_clashing_names(spark, first_names):
    sf = "/root/testdata/sf0.001"
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, first_names, sf)
        assert out.columns == first_names.columns, name
        assert {r[0] for r in out.collect()} <= {None, 5, 7, 8, 9}
    assert P.STAGES[-1][1](spark, first_names, sf).count() > 0
