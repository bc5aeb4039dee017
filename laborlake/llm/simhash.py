"""SimHash near-duplicates through a byte-position inverted index with count filtering.

A fingerprint has eight positional bytes. Two fingerprints that differ in at most d
bits share at least 8 - d of them (the guaranteed minimum). Posting lists of one byte
would hold 1/256 of all documents, so the index posts blocks of positions: the eight
positions fall into d + 2 blocks, at least two blocks are shared whole, and each pair of blocks
is one posting key. The shared positional bytes of a pair from one list are counted from its xor; the minimum follows
from the bit distance that verifies the pair, so the count alone drops nothing that the distance would keep. Equal
fingerprints are one entry, so copies make no pairs.

A list of over ``LIST`` fingerprints emits no pairs: each of its fingerprints posts
the words within half the distance instead (65 for d = 2). Two fingerprints lie
within d bits exactly if they meet at such a word, and all that meet there are linked to the
smallest, so the work stays linear and no link is lost. A word's meeting is small: only
fingerprints within half the distance of it can post it.

Connected components come from alternating large-star and small-star steps over
the links; every step is a written table, and a hot centre is met by ``attach``.

Defined cases: a null text counts as empty; a text of 1 or 2 words is one shingle; one without
words has fingerprint zero and links like any other. Rows without a doc_id link like any other; the smallest doc_id that is
not null names a component, a component of such rows alone has a null name. Rows that repeat a doc_id get one row
each, with the component of their own text. An empty table gives no rows. Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from laborlake.llm.common import attach, own_columns, read, staged, unambiguous
from laborlake.llm.tasks import ship_by_value

ship_by_value(sys.modules[__name__])

SEED = 42
LIST = 128
CHUNK = 1 << 16  # shingles whose bits are unpacked at once


def simhash(text: str | None, width: int = 3) -> int:
    """The unsigned 64-bit fingerprint of one text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    n = max(1, len(words) - width + 1)
    first, last = starts[:n].tolist(), ends[-n:].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        part = [digest(joined[a:b], SEED) for a, b in zip(first[at:at + CHUNK], last[at:at + CHUNK], strict=True)]
        bits = np.unpackbits(np.array(part, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprint(text: Column, width: int) -> Column:
    """The fingerprint as a signed long."""

    @F.pandas_udf("long")
    def signed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            values = np.fromiter((simhash(t, width) for t in texts), np.uint64, len(texts))
            yield pd.Series(values.view(np.int64))

    return signed(text)


def _signed(word: int) -> int:
    return word - (1 << 64) if word >> 63 else word


def position_masks(distance: int) -> list[int]:
    """Masks of the posting keys: every pair of the ``distance + 2`` blocks of byte positions."""
    blocks = np.array_split(np.arange(8), distance + 2)
    whole = [sum(0xFF << (8 * int(p)) for p in block) for block in blocks]
    return [_signed(a | b) for a, b in combinations(whole, 2)]


def words_within(radius: int) -> list[int]:
    return [_signed(sum(1 << i for i in bits)) for r in range(radius + 1) for bits in combinations(range(64), r)]


def _shared_bytes(x: Column) -> Column:
    """Equal positional bytes of two fingerprints, from their xor."""
    same = [(F.shiftrightunsigned(x, 8 * i).bitwiseAND(F.lit(0xFF)) == 0).cast("int") for i in range(8)]
    return sum(same[1:], same[0])


def links(prints: DataFrame, distance: int, list_size: int = LIST) -> DataFrame:
    """(a, b) of distinct fingerprints ``fp`` whose links connect all within ``distance`` bits."""
    masks = F.array(*[F.lit(m) for m in position_masks(distance)])
    posted = staged(prints.select("fp", F.posexplode(masks).alias("positions", "mask")).select(
        "fp", F.struct("positions", F.col("fp").bitwiseAND(F.col("mask")).alias("bytes")).alias("key")), "postings")
    lists = staged(posted.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "lists")
    listed = staged(attach(posted, lists, "key", "n").where("n is not null"), "listed")

    short = listed.where(F.col("n") <= list_size)
    xor = F.col("a").bitwiseXOR(F.col("b"))
    pairs = (short.select("key", F.col("fp").alias("a")).join(short.select("key", F.col("fp").alias("b")), "key")
             .where((F.col("a") < F.col("b")) & (_shared_bytes(xor) >= 8 - distance) & (F.bit_count(xor) <= distance))
             .select("a", "b"))

    near, far = distance // 2, distance - distance // 2
    dense = listed.where(F.col("n") > list_size).select("fp").distinct()
    reach = F.array(*[F.struct(F.lit(w).alias("flip"), F.lit(i < len(words_within(near))).alias("inner"))
                      for i, w in enumerate(words_within(far))])
    met = (dense.select("fp", F.explode(reach).alias("w"))
           .select("fp", F.col("fp").bitwiseXOR(F.col("w.flip")).alias("word"), "w.inner"))
    centre = met.where("inner").groupBy("word").agg(F.min("fp").alias("a"))
    stars = met.join(centre, "word").where("a != fp").select("a", F.col("fp").alias("b"))
    return pairs.unionByName(stars).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b): the smallest node reachable."""
    edges = staged(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "edges")
    state = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _star(both).where("b > a")
        small = _star(staged(large.select(F.col("b").alias("a"), F.col("low").alias("b")).where("a != b").distinct(), "large"))
        own = small.select("a", "low").where("a != low").select(F.col("low").alias("a"), F.col("a").alias("b"))
        rest = small.where("b != low").select(F.col("low").alias("a"), "b")
        edges = staged(rest.unionByName(own).distinct(), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == state:
            break
        state = now
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(
        edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())


def _star(directed: DataFrame) -> DataFrame:
    """Every (a, b) with ``low``: the smallest of a and all its b."""
    low = staged(directed.groupBy("a").agg(F.least("a", F.min("b")).alias("low"), F.count(F.lit(1)).alias("n")), "low")
    return attach(directed, low, "a", "n")


def near_duplicates(docs: DataFrame, width: int = 3, distance: int = 2, list_size: int = LIST) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``."""
    if not 0 <= distance <= 3:
        raise ValueError("distance: 0 to 3 bits")
    rows = staged(own_columns(docs, ["doc_id", "text"]).select("doc_id", fingerprint(F.col("text"), width).alias("fp")), "fingerprints")
    return attach(rows, component_table(rows, distance, list_size), "fp", "n").select("doc_id", "fp", "component_id")


def component_table(rows: DataFrame, distance: int, list_size: int = LIST) -> DataFrame:
    """(fp, n, component, component_id) of the distinct fingerprints in ``rows`` (doc_id, fp): rows, smallest fingerprint and doc_id reachable."""
    prints = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n")), "distinct")
    # Nodes are fingerprints, as those of rows without an id have no other name.
    group = components(links(prints, distance, list_size))
    named = staged(prints.join(group, prints.fp == group.node, "left").select(
        "fp", "first_id", "n", F.coalesce("component", "fp").alias("component")), "nodes")
    ids = staged(named.groupBy("component").agg(F.min("first_id").alias("component_id"), F.count(F.lit(1)).alias("prints")), "names")
    return staged(attach(named, ids, "component", "prints").select("fp", "n", "component", "component_id"), "components")


def keep_first(docs: DataFrame, width: int = 3, distance: int = 2) -> DataFrame:
    """One row of ``docs`` per component: the smallest doc_id (rows without one come last), then the smallest hash of the text and of the row.

    Of rows that are equal in every column one stays.
    """
    named = unambiguous(docs, ["doc_id", "text"])
    # A map has no hash, its JSON text has.
    whole = F.xxhash64(*[F.to_json(F.struct(c)) if "map<" in kind else F.col(c) for c, kind in named.dtypes])
    rows = staged(named.select("doc_id", fingerprint(F.col("text"), width).alias("fp"), F.xxhash64("text").alias("text_hash"), whole.alias("row_hash")),
                  "fingerprints")
    placed = attach(rows, component_table(rows, distance), "fp", "n")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash", "row_hash")
    per_row = placed.groupBy("component", order.alias("row")).agg(F.count(F.lit(1)).alias("n"))
    per_row = staged(per_row, "rows")
    sizes = staged(per_row.groupBy("component").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("rows")), "firsts")
    judged = attach(per_row, sizes, "component", "rows")
    names = [F.col("row.doc_id").alias("id"), F.col("row.row_hash").alias("hash")]
    dropped = staged(judged.where(F.col("row") != F.col("first")).select(*names), "dropped")
    several = staged(judged.where((F.col("row") == F.col("first")) & (F.col("n") > 1)).select(*names), "several")

    def join(table: DataFrame, how: str) -> DataFrame:
        return named.join(table, F.col("doc_id").eqNullSafe(F.col("id")) & (whole == F.col("hash")), how)

    if several.isEmpty():
        return join(dropped, "left_anti").toDF(*docs.columns)
    # Rows that are equal in every column, of whatever type: any one of them.
    one = join(several, "left_semi").groupBy("doc_id", whole.alias("row_hash")).agg(F.any_value(F.struct(*named.columns)).alias("row"))
    return join(dropped.unionAll(several), "left_anti").unionAll(one.select("row.*")).toDF(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
