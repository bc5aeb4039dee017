import re

import pytest
import xxhash
from pyspark.sql import functions as F

from laborlake.llm import simhash


def _print_by_hand(text):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0d]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _components_by_hand(prints, distance):
    parent = {d: d for d in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(prints)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if (prints[a] ^ prints[b]).bit_count() <= distance:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {d: find(d) for d in ids}


def test_fingerprints(texts, odd):
    for text in [*texts.values(), *(r["text"] for r in odd.collect())]:
        if text is None or len(text) < 100_000:
            assert simhash.simhash(text) == _print_by_hand(text)
    monotone = "a b c " * 40_000  # over one chunk of shingles
    assert simhash.simhash(monotone) == _print_by_hand(monotone)


def test_whole_table(documents, texts):
    got = {r["doc_id"]: r for r in simhash.near_duplicates(documents).collect()}
    prints = {d: _print_by_hand(t) for d, t in texts.items()}
    assert {d: r["fp"] % (1 << 64) for d, r in got.items()} == prints
    assert {d: r["component_id"] for d, r in got.items()} == _components_by_hand(prints, 2)


@pytest.mark.parametrize(("distance", "list_size"), [(0, 128), (1, 2), (2, 2), (2, 128), (3, 2)])
def test_links_keep_every_component(spark, distance, list_size):
    """Chains, stars and dense balls of fingerprints, by pairs and by shared words."""
    words = {0: 0, 1: (1 << 64) - 1}
    for i in range(2, 40):
        words[i] = words[i - 2] ^ (1 << (i * 7 % 64)) ^ ((1 << (i * 11 % 64)) if i % 3 else 0)
    for i in range(40, 90):
        words[i] = 0xF0F0_0000_1234_5678 ^ (1 << (i % 50)) ^ (1 << (i * 3 % 64))
    prints = spark.createDataFrame([(d, w - (1 << 64) if w >> 63 else w) for d, w in words.items()], "doc_id long, fp long")
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    found = simhash.links(distinct, distance, list_size)
    first = {r["fp"]: r["first_id"] for r in distinct.collect()}
    edges = [(first[r["a"]], first[r["b"]]) for r in found.collect()]
    if edges:
        got = {r["node"]: r["component"] for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    else:
        got = {}
    want = _components_by_hand(words, distance)
    assert {d: got.get(first[w - (1 << 64) if w >> 63 else w], first[w - (1 << 64) if w >> 63 else w]) for d, w in words.items()} == want


def test_odd_rows(odd, empty):
    got = [(r["doc_id"], r["fp"], r["component_id"]) for r in simhash.near_duplicates(odd).collect()]
    by_id = {d: (f, c) for d, f, c in got}
    assert len(got) == 11 and by_id[1][1] == by_id[2][1] == 1
    assert by_id[3] == by_id[4] == by_id[5] == (0, 3)
    assert simhash.near_duplicates(empty).count() == 0
    kept = simhash.keep_first(odd)
    assert kept.columns == odd.columns
    assert {r["doc_id"] for r in kept.collect()} >= {None, 1, 3, 6, 7, 9} and kept.where("doc_id in (2, 4, 5)").count() == 0


def test_long_chain_is_one_component(spark):
    edges = spark.range(60).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = simhash.components(edges).collect()
    assert len(got) == 61 and {r["component"] for r in got} == {0}
