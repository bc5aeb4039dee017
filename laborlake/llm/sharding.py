"""Minimax contiguous sharding: the smallest shard capacity for which greedy cutting needs no more than n shards.

Atomic groups (equal texts) stand in the order of their text's digest. A group's
place is the running sum of sizes up to it. For a capacity, the greedy check jumps
from cut to cut: the next cut is the last group that ends within ``start +
capacity``. The smallest capacity for which the jumps reach the end in n shards is
found by binary search; the cuts of that capacity are n - 1 digests, so a document's
shard is a comparison with n - 1 literals and no document moves for it.

The driver holds sums of a fixed number of digest buckets, and of a bucket that a
cut falls into and its neighbours, sums of their parts, level by level (16 bits of the digest at a time) down to
single groups: each read is one aggregate with about 65,536 rows at most, whatever the input.

Slots: rows stand in their shard by (bucket, salt, digest, doc_id), numbered by a
window over each (bucket, salt) plus the count of the rows before it. The salt is a hash of
doc_id, and a bucket has one salt per ``ROWS_PER_TASK`` rows that it holds, so a text that a third of all rows share
is numbered by as many tasks as it needs, at any size.

Defined cases: size = UTF-8 bytes of the text plus 1; a null text has no bytes and counts as the empty
text; equal texts, whatever their doc_ids, share a shard; a group larger than all others together makes
the capacity its own size, and later shards may then be empty; rows that repeat a doc_id get
different slots; an empty table gives no rows. Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from laborlake.llm.common import own_columns, read, staged

LEVEL = 4  # hex digits of the digest that one level of sums resolves
BUCKET_DIGITS = 3
ROWS_PER_TASK = 1_000_000  # rows of a digest bucket that one salt stands for


class _Places:
    """Running sums over the digest order, read level by level where a cut needs them."""

    def __init__(self, groups: DataFrame):
        self.groups = groups
        self.nodes: dict[str, tuple[list[int], list[str], list[int]]] = {}
        self._read([""])
        self.total = self.nodes[""][0][-1] if self.nodes[""][0] else 0

    def _read(self, prefixes: list[str]) -> None:
        """Of neighbouring digest prefixes: running ends of their children, the children's prefixes, their group counts."""
        size = len(prefixes[0])
        under = self.groups.where(F.col("digest").between(prefixes[0], prefixes[-1] + "g")) if size else self.groups
        rows = under.groupBy(F.substring("digest", 1, size + LEVEL).alias("child")).agg(
            F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("n"), F.min("digest").alias("digest")).collect()
        found = {prefix: ([], [], []) for prefix in prefixes}
        for r in sorted(rows, key=lambda r: r["child"]):
            if r["child"][:size] not in found:
                continue  # between two of the prefixes: a single group, or read before
            ends, children, counts = found[r["child"][:size]]
            ends.append((ends[-1] if ends else 0) + r["bytes"])
            children.append(r["digest"] if r["n"] == 1 else r["child"])
            counts.append(r["n"])
        self.nodes |= found

    def _around(self, node: tuple[list[int], list[str], list[int]], at: int) -> list[str]:
        """The child at ``at`` and its neighbours, as far as their own children are few enough for one read."""
        _, children, counts = node
        low = high = at
        held = min(counts[at], 16 ** LEVEL)
        while True:
            before = held
            for i in (low - 1, high + 1):
                if 0 <= i < len(counts) and counts[i] > 1 and held + counts[i] <= 16 ** LEVEL:
                    held += counts[i]
                    low, high = min(low, i), max(high, i)
                elif 0 <= i < len(counts) and counts[i] == 1:
                    low, high = min(low, i), max(high, i)
                    held += 1
            if held == before or held > 16 ** LEVEL:
                return [children[i] for i in range(low, high + 1) if counts[i] > 1]

    def cut(self, limit: int) -> tuple[int, str | None]:
        """The largest group end that is at most ``limit``, and the digest of the first group past it."""
        base, prefix = 0, ""
        while True:
            ends, children, counts = self.nodes[prefix]
            i = bisect_right(ends, limit - base)
            if i == len(ends):
                return base + (ends[-1] if ends else 0), None
            start = base + (ends[i - 1] if i else 0)
            if counts[i] == 1:
                return start, children[i]
            if children[i] not in self.nodes:
                self._read([c for c in self._around(self.nodes[prefix], i) if c not in self.nodes])
            base, prefix = start, children[i]


def cuts(groups: DataFrame, shards: int) -> list[str]:
    """The first digests of shards 1, 2, ... for the smallest feasible capacity. ``groups``: digest, bytes."""
    places = _Places(groups)
    largest = groups.agg(F.max("bytes")).first()[0] or 0
    if not places.total:
        return []

    def greedy(capacity: int) -> list[str] | None:
        found, start = [], 0
        for _ in range(shards):
            start, digest = places.cut(start + capacity)
            if digest is None:
                return found
            found.append(digest)
        return None

    low = max(largest, -(-places.total // shards))
    high = low + largest  # every shard but the last is then filled beyond total / shards
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if greedy(middle) is not None else (middle + 1, high)
    return greedy(low)


def minimax_shards(docs: DataFrame, shards: int = 8) -> DataFrame:
    """(doc_id, size, text_crc32, digest, shard, slot) for every row of ``docs``."""
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    rows = staged(own_columns(docs, ["doc_id", "text"]).select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.sha2(text, 256).alias("digest")), "sized")
    groups = rows.groupBy("digest").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    # By digest, so that reading the children of a few prefixes opens few row groups.
    groups = staged(groups.repartitionByRange("digest").sortWithinPartitions("digest"), "groups")
    shard = F.lit(0)
    for digest in cuts(groups, shards):
        shard = shard + (F.col("digest") >= digest).cast("int")
    bucket = F.substring("digest", 1, BUCKET_DIGITS).alias("bucket")
    # At most 16 ** BUCKET_DIGITS rows, whatever the input.
    salts = F.broadcast(groups.groupBy(bucket).agg(F.ceil(F.sum("rows") / F.lit(ROWS_PER_TASK)).alias("salts")))
    rows = (rows.select("*", shard.alias("shard"), bucket).join(salts, "bucket")
            .withColumn("salt", F.pmod(F.xxhash64("doc_id"), "salts")))
    part = ["shard", "bucket", "salt"]
    before = Window.partitionBy("shard").orderBy("bucket", "salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (rows.groupBy(*part).agg(F.count(F.lit(1)).alias("n"))
               .select(*part, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")))
    within = F.row_number().over(Window.partitionBy(*part).orderBy("digest", "doc_id"))
    return (rows.withColumn("within", within.cast("long")).join(offsets, part)
            .select("doc_id", "size", "text_crc32", "digest", "shard",
                    (F.col("offset") + F.col("within") - 1).alias("slot")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minimax_shards(read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
