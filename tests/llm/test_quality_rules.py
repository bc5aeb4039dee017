import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from laborlake.llm import quality_rules as Q


def by_hand(text):
    """The base counts by definition."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    held = {i + k for i, w in enumerate(windows) if sum(w == v for v in windows) > 1 for k in range(3)}
    lines = text.split("\n")
    again = sum(bool(re.search(r"[^\x20\x09-\x0D]", line)) and line in lines[:i] for i, line in enumerate(lines))
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(held),
            len(words) < 50 or 100 * len(held) > 50 * len(words))


def counted(text):
    words = Q.words_of(text)
    n, repeated = len(words.ids), Q.repeated_words(words)
    return n, words.chars, sum(map(text.count, Q.SYMBOLS)), Q.repeated_lines(text), repeated, n < 50 or 2 * repeated > n


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab #|\n\t\x0b\x85 é", max_size=60))
def test_counts_of_any_text(text):
    assert counted(text) == by_hand(text)


def test_base_counts_of_the_table(spark, documents, odd, empty):
    model = Q.Model(np.zeros(0), 1.0, 0.0)
    for frame in (documents, odd.where("length(text) < 1000 or text is null")):
        texts = [(r["doc_id"], *by_hand(r["text"])) for r in frame.collect() if len(r["text"] or "") < 20_000]
        got = [tuple(r)[:7] for r in Q.judge(frame, model).collect()]
        assert set(texts) <= set(got) and len(got) == frame.count()
    assert Q.judge(empty, model).count() == 0


def test_long_repetitive_text(spark, odd):
    got = {r["doc_id"]: r for r in Q.judge(odd, Q.Model(np.zeros(0), 1.0, 0.0)).collect()}
    assert (got[7]["n_words"], got[7]["n_repeat_words"], got[7]["base_failed"], got[7]["kept"]) == (60_000, 60_000, True, False)


@pytest.fixture(scope="module")
def judged(spark):
    return Q.query(spark, "/root/testdata/sf0.1")


def test_held_out_labels(spark, judged):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = judged.where(Q.held_out(judged["doc_id"])).join(labels, "doc_id").collect()
    good = [r for r in rows if r["quality"] == 1 and not r["base_failed"]]
    bad = [r for r in rows if r["quality"] == 0]
    assert sum(r["kept"] for r in good) >= 0.99 * len(good)
    assert sum(not r["kept"] for r in bad) >= 0.9 * len(bad)
    # Calibrated: mean probability and share of label 1 agree.
    assert abs(np.mean([r["probability"] for r in rows]) - np.mean([r["quality"] for r in rows])) < 0.03


def test_regression_against_plain_gradient_descent():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((60, 5))
    label = (x @ [2, -1, 0, 0.5, 0] + 0.3 * rng.standard_normal(60) > 0).astype(float)
    rows = [(np.arange(5), r) for r in x]
    got = Q.train(rows, label, ridge=1.0)
    w, b = np.zeros(5), 0.0
    for _ in range(20_000):
        slope = 1 / (1 + np.exp(-(x @ w + b))) - label
        w, b = w - 0.01 * (x.T @ slope + w), b - 0.01 * slope.sum()
    assert np.allclose(got[:5], w, atol=1e-4) and abs(got[-1] - b) < 1e-4 and not got[5:-1].any()


def test_calibration_meets_the_class_rates():
    margin = np.repeat([-2.0, 1.0], 500)
    label = np.concatenate([np.arange(500) < 50, np.arange(500) < 400]).astype(float)
    slope, offset = Q.calibrate(margin, label)
    p = 1 / (1 + np.exp(-(slope * np.array([-2.0, 1.0]) + offset)))
    assert np.allclose(p, [0.1, 0.8], atol=0.01)


def test_labels_of_one_kind_keep_everything(spark, odd):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (None, 0, 0)], "doc_id long, quality int, toxic int")
    assert {r["probability"] for r in Q.judge(odd, Q.fit(odd, labels)).collect()} == {1.0}
    mixed = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 10)], "doc_id long, quality int, QUALITY int")
    assert Q.judge(odd, Q.fit(odd, mixed)).count() == odd.count()


def test_equal_texts_are_judged_alike(spark, odd):
    by_id = {}
    for r in Q.judge(odd.withColumn("probability", odd["score"]), Q.Model(np.ones(Q.TERMS + 1, np.float32), 1.0, 0.0)).collect():
        by_id.setdefault(r["doc_id"], set()).add(r["probability"])
    assert by_id[1] == by_id[2]
