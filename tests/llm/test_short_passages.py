import random
import re

import pytest

from laborlake.llm import decontaminate as D


def _plain(text):
    return "".join(map(chr, D.normalise(text or "")[0]))


def _edits(passage, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(passage):
        new = [i + 1]
        for j, t in enumerate(text):
            new.append(min(row[j] + (p != t), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def _found(passage, text):
    """By definition: whole words without edits under 20 characters, else edits within 5 percent anywhere."""
    p, t = _plain(passage), _plain(text)
    if not p or not t:
        return False
    return f" {p} " in f" {t} " if len(p) < 20 else _edits(p, t) <= int(D.BUDGET * len(p))


WORDS = ["is", "it", "red", "why", "apple", "green", "planet", "orbits", "capital", "of", "france", "日本", "x1"]


@pytest.mark.parametrize("seed", range(4))
def test_short_passages_against_brute_force(seed):
    rng = random.Random(seed)
    passages = sorted({" ".join(rng.choices(WORDS, k=rng.randrange(1, 6)))[:29].strip() for _ in range(30)})
    index = D.Passages(list(range(len(passages))), [D.normalise(p)[0] for p in passages], D.Q, D.BUDGET)
    for _ in range(60):
        text = rng.choice([" ", ", ", "-"]).join(rng.choices(WORDS, k=rng.randrange(0, 25)))
        text = "".join(rng.choice("xyz") if rng.random() < 0.02 else c for c in text)
        hits = index.matches(text)
        assert {p for p, *_ in hits} == {i for i, p in enumerate(passages) if _found(p, text)}, text
        for p, a, b, e in hits:
            if not e:
                assert _plain(text[a:b]) == _plain(passages[p])


def test_items_of_5_12_and_25_characters(spark):
    items = [(1, "Why 7?"), (2, "Is ice cold?"), (3, "What do plants breathe in?"), (4, "?!"), (5, None)]
    assert [len(_plain(t)) for _, t in items[:3]] == [5, 11, 25]
    docs = [(1, "He asked: why 7, and left."), (2, "why 77 or why7"), (3, "Tell me, IS ICE   cold? Yes."), (4, "This ice cold"),
            (5, "So: what do plants breath in?!"), (6, "what do trees breathe in"), (7, "Why 7!"), (8, None), (9, "")]
    frame = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, TEXT string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in D.leaks(frame, bench).collect()}
    assert got == {(d, i) for d, t in docs for i, p in items if _found(p, t)} == {(1, 1), (7, 1), (3, 2), (5, 3)}
    assert {(r["doc_id"], r["item_id"]) for r in D.leaks(frame, bench, block_chars=10).collect()} == got
    # A passage without a q-gram ends a document only if it is all of it.
    for block in (1_000_000, 10):
        assert {r["doc_id"] for r in D.keep_clean(frame, bench, block_chars=block).collect()} == {1, 2, 4, 6, 8, 9}


def test_repeats_of_a_short_passage_do_not_overlap():
    index = D.Passages([1], [D.normalise("a a")[0]], D.Q, D.BUDGET)
    assert [(a, b) for _, a, b, _ in index.matches("a a a a a")] == [(0, 3), (4, 7)]
    index = D.Passages([1], [D.normalise("one two one")[0]], D.Q, D.BUDGET)
    text = "one two one two one two one"
    assert [text[a:b] for _, a, b, _ in index.matches(text)] == ["one two one", "one two one"]
    assert re.findall("one two one", text) == ["one two one"] * 2
