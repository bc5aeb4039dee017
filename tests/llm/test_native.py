"""Exact dedup, sharding, URL filters against brute force."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from laborlake.llm import exact_dedup, sharding, url_filter
from laborlake.llm.common import attach
from laborlake.session import fresh_path


def _dedup_by_hand(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub(r"[\x20\x09-\x0d]", "", text or "")].append((doc_id, text or ""))
    out = []
    for norm, members in groups.items():
        keep = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))[0]
        out += [(d, keep, len(members), d == keep, hashlib.sha256(norm.encode()).hexdigest()) for d, _ in members]
    return sorted(out, key=str)


def test_exact_dedup_odd_rows(odd, empty):
    got = sorted((tuple(r) for r in exact_dedup.exact_dedup(odd).collect()), key=str)
    assert got == _dedup_by_hand([(r["doc_id"], r["text"]) for r in odd.collect()])
    assert exact_dedup.exact_dedup(empty).count() == 0


def test_exact_dedup_whole_table(documents, texts):
    got = sorted((tuple(r) for r in exact_dedup.exact_dedup(documents).collect()), key=str)
    assert got == _dedup_by_hand(texts.items())


def test_index_persists_between_batches(spark):
    index = exact_dedup.DigestIndex(spark, "index_of_two_batches", fresh_path(spark, "test_index"), 4)
    first = spark.createDataFrame([(1, "a b"), (2, "ab"), (3, "c")], "doc_id long, text string")
    second = spark.createDataFrame([(4, "a  b longer no"), (5, "a\tb"), (6, "d"), (7, "d")], "doc_id long, text string")
    assert {r["doc_id"] for r in index.add(first, 0).where("kept").collect()} == {1, 3}
    found = {r["doc_id"]: (r["keep_id"], r["kept"]) for r in index.add(second, 1).collect()}
    assert found == {4: (4, True), 5: (1, False), 6: (6, True), 7: (6, False)}
    assert index.rows().count() == 4
    spark.sql("DROP TABLE index_of_two_batches")


def test_index_moves_into_more_buckets(spark):
    """Of one row a bucket, the index outgrows its buckets; the verdicts are those of all batches, and nothing is left behind."""
    path = fresh_path(spark, "test_index")
    index = exact_dedup.DigestIndex(spark, "index_that_grows", path, rows_per_bucket=1)
    kinds = "doc_id long, text string"
    sizes, kept = [], set()
    for b, ids in enumerate([range(2), range(1, 30), range(20, 60)]):
        found = index.add(spark.createDataFrame([(100 * b + i, f"t {i}") for i in ids], kinds), b).where("kept").collect()
        kept |= {r["text_sha256"] for r in found}
        sizes.append(index._tables()[-1][0])
    assert len(kept) == index.rows().count() == 60 and sizes == [2, 32, 32] and len(index._tables()) == 1
    assert index.rows().where("keep_id = 1").first()["batch"] == 0 and index.rows().where("keep_id = 101").count() == 0
    index.drop()
    assert index.rows() is None


def test_one_row_of_a_group_stays_where_a_doc_id_repeats(spark):
    docs = spark.createDataFrame([(5, "a b"), (5, "ab"), (None, "x"), (None, " x"), (7, "p  q"), (7, "p q "), (7, "p q ")], "doc_id long, text string")
    found = exact_dedup.exact_dedup(docs).collect()
    kept = defaultdict(int)
    for r in found:
        kept[r["text_sha256"]] += r["kept"]
    assert len(found) == 7 and sorted(kept.values())[:2] == [1, 1] and max(kept.values()) <= 2  # equal rows share a verdict
    assert not [n for n in spark.catalog.listTables() if n.name.startswith("digest_index_")]


def test_attach_splits_hot_keys(spark):
    rows = spark.range(300).select(F.when(F.col("id") < 100, 0).otherwise(F.col("id")).alias("k"), "id")
    table = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    got = attach(rows, table, "k", "n", parts=10)
    assert got.count() == 300 and got.where("k = 0 and n = 100").count() == 100 and got.where("n is null").count() == 0


def _capacity_by_hand(sizes, shards):
    def fits(capacity):
        used, total = 1, 0
        for s in sizes:
            if total + s > capacity:
                used, total = used + 1, 0
            total += s
        return used <= shards

    low, high = max(sizes), sum(sizes)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if fits(middle) else (middle + 1, high)
    return low


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_sharding(documents, texts, odd, empty, shards):
    for docs in (documents, odd):
        rows = sharding.minimax_shards(docs, shards).collect()
        source = [(r["doc_id"], (r["text"] or "").encode()) for r in docs.collect()]
        assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in rows) == sorted(
            (str(d), len(t) + 1, zlib.crc32(t)) for d, t in source)
        groups = defaultdict(int)
        for _, t in source:
            groups[hashlib.sha256(t).hexdigest()] += len(t) + 1
        most = _capacity_by_hand([groups[k] for k in sorted(groups)], shards)
        load, slots, homes = defaultdict(int), defaultdict(list), defaultdict(set)
        for r in rows:
            load[r["shard"]] += r["size"]
            slots[r["shard"]].append(r["slot"])
            homes[r["digest"]].add(r["shard"])
        assert max(load.values()) == most and max(load) < shards
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        assert all(len(h) == 1 for h in homes.values())
    assert sharding.minimax_shards(empty, shards).count() == 0


def test_sharding_salts_follow_the_rows(spark, monkeypatch):
    """A text that half of all rows share is numbered in many runs, and the slots have no gap."""
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("text"))
    monkeypatch.setattr(sharding, "ROWS_PER_TASK", 7)
    slots = defaultdict(list)
    for r in sharding.minimax_shards(docs, 3).collect():
        slots[r["shard"]].append(r["slot"])
    assert sum(map(len, slots.values())) == 400 and all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_sharding_reads_levels_below(spark, monkeypatch):
    """With one digit a level, many reads are needed and the cuts stay the same."""
    groups = spark.range(500).select(F.sha2(F.col("id").cast("string"), 256).alias("digest"), (F.col("id") % 37 + 1).alias("bytes"))
    whole = sharding.cuts(groups, 5)
    monkeypatch.setattr(sharding, "LEVEL", 1)
    assert sharding.cuts(groups, 5) == whole and len(whole) == 4


def _url_by_hand(url, rules, default):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = [(len(h) + len(p), len(h), v, h + p) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[2] if best else default


def test_url_filter(spark):
    rng = random.Random(4)
    labels, paths = ["com", "net", "a", "b", "ab", "www"], ["/", "/en/", "/en/x/", "/e", ""]
    rules = [(".".join(rng.choices(labels, k=rng.randint(1, 3))), rng.choice(paths[:4]), rng.choice(["allow", "block"]))
             for _ in range(40)]
    urls = [f"http://{'.'.join(rng.choices(labels, k=rng.randint(1, 4)))}{rng.choice(paths)}{rng.choice(['', '?q=/en/', '#x', 'y'])}"
            for _ in range(800)]
    urls += [None, "", "no scheme", "http://", "HTTP://A.COM/EN/", "x://com", "x://com/", "http://com:80/", "http://.com/", "http://a..com/",
             "http://a.com/en/://b.net/", "http://ü.com/en/", "http://com/" + "y" * 100_000] + urls[:50] * 3
    pages = spark.createDataFrame([(i, u, "k", "r") for i, u in enumerate(urls)], "page_id long, url string, key string, range string")
    table = url_filter.rule_table(spark, rules)
    for ranges in (1, 7):
        got = {r["page_id"]: tuple(r)[1:] for r in url_filter.url_filter(pages, table, "allow", ranges).collect()}
        assert len(got) == len(urls)
        wrong = [(u, got[i], _url_by_hand(u, rules, "allow")) for i, u in enumerate(urls) if got[i] != _url_by_hand(u, rules, "allow")]
        assert not wrong, wrong[:5]
    assert url_filter.url_filter(pages.limit(0), table).count() == 0
    assert set(url_filter.url_filter(pages, table.limit(0), "block").select("verdict").distinct().toPandas()["verdict"]) == {"block"}
