"""Token-ID output in training order, as fixed-stride binary shards.

The stream of all tokens is the documents in the order of a hash of (doc_id, text), ties by doc_id, each with an end mark; it
is cut into sequences of ``length`` tokens, the last one filled up with end marks. So sequences follow from the documents alone, not from how
their table is split. Each task tokenises its documents once and stages the tokens in compressed blocks. A window over (document, number of
tokens, block) gives every document its place in the stream; those places come back to the staged blocks by a join that the
blocks, a table bucketed by task, are not shuffled for. A keyed Feistel permutation, walked until it falls below the number of
sequences, gives each sequence its global slot. A shard is a range of ``per_shard`` slots, one partition each: the pieces of the
documents go there in rows that each task has gathered per shard, and every shard is written as one file of records of
``2 * length`` bytes (4 with a vocabulary over 65,536), little-endian, in slot order, closed by one newline byte.
The record of slot s is at ``s % per_shard * stride`` of the file in ``shard=<s // per_shard>``, so a reader
can resume at any slot. Shards are of 16 MB (of 1,024 tokens) up to some 4,000 of them, then of up to 128 MB (``shard_size``). The
files are written and read through Spark's own sources, on any file system that Spark knows. Staging is a file scan, so a lost
task is redone alike.

Defined cases: a null or empty text yields its end mark alone; special-token strings in a text are ordinary text; a
document of any length runs over as many sequences as it needs; rows that repeat a doc_id are tokenised each, and rows that repeat
its text too follow one another; an empty table writes no shard and gives no rows. Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import base64
import sys
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from laborlake.llm.common import own_columns, read, staged
from laborlake.llm.tasks import ship_by_value
from laborlake.session import drop_path, fresh_path

ship_by_value(sys.modules[__name__])

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Fixed value: the word pattern of the byte-level vocabularies, from their README's module.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LENGTH = 1024
PER_SHARD = 8192  # at least
BLOCK_TOKENS, BLOCK_ROWS = 1 << 20, 1 << 16  # staged as one row
BUCKET_BYTES = 1 << 25  # text in a bucket of the staged table
ROWS_PER_PART = 1_000_000
KEY = 0x5EED0F0A7E57
LEVEL = 9


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def mixed(x: np.ndarray, key: int) -> np.ndarray:
    """A 64-bit hash of each number under a key."""
    x = (x + np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slots(ordinals: np.ndarray, n: int, key: int = KEY, rounds: int = 6) -> np.ndarray:
    """A permutation of 0 .. n - 1: balanced Feistel over the next power of four, cycle-walking."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    out = ordinals.astype(np.uint64)
    walk = np.arange(len(out))
    while len(walk):
        left, right = out[walk] >> shift, out[walk] & mask
        for r in range(rounds):
            left, right = right, left ^ (mixed(right, (key + r * 0x632BE59BD9B4E019) % (1 << 64)) & mask)
        out[walk] = left << shift | right
        walk = walk[out[walk] >= n]
    return out.astype(np.int64)


def shard_size(n: int) -> int:
    """Sequences per shard for ``n`` of them: a power of two that grows with n, within bounds of a task's memory."""
    return min(max(PER_SHARD, 1 << (max(1, n // 4096) - 1).bit_length()), 8 * PER_SHARD)


def _tokenised(docs: DataFrame, ranks: dict[bytes, int], name: str, path: str) -> DataFrame:
    """The catalog table ``name``: staged blocks of documents as task, block, their doc_ids, text hashes and sizes, data."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(ranks)
    end, kind = len(ranks), "<u2" if len(ranks) < 1 << 16 else "<u4"
    names = ["task", "block", "doc_ids", "hashes", "sizes", "data"]
    kinds = [pa.int64(), pa.int64(), *[pa.list_(pa.int64())] * 3, pa.binary()]

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=shared.value, special_tokens={})
        pack = zstandard.ZstdCompressor(level=LEVEL)
        task, block, held = TaskContext.get().partitionId(), 0, 0
        ids, hashes, streams = [], [], []

        def row() -> pa.RecordBatch:
            values = [task, block, ids, hashes, [len(x) for x in streams], pack.compress(np.concatenate(streams).tobytes())]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds, strict=True)], names)

        for rows in batches:
            for doc_id, text_hash, text in zip(*[rows.column(c) for c in ("doc_id", "text_hash", "text")], strict=True):
                ids.append(doc_id.as_py())
                hashes.append(text_hash.as_py())
                streams.append(np.array([*coder.encode_ordinary(text.as_py() or ""), end], kind))
                held += len(streams[-1])
                if held >= BLOCK_TOKENS or len(ids) == BLOCK_ROWS:
                    yield row()
                    block, held, ids, hashes, streams = block + 1, 0, [], [], []
        if ids:
            yield row()

    rows = own_columns(docs, ["doc_id", "text"]).select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = 1 << min(16, max(0, (size // BUCKET_BYTES).bit_length()))
    (rows.mapInArrow(coded, "task long, block long, doc_ids array<bigint>, hashes array<bigint>, sizes array<bigint>, data binary")
     .write.bucketBy(buckets, "task").format("parquet").option("compression", "zstd").option("path", path).saveAsTable(name))
    return spark.table(name)


def _placed(blocks: DataFrame) -> DataFrame:
    """task, block, doc_id, text_hash, size, copies, start: where the (equal) documents of a block begin in the stream of all."""
    each = F.explode(F.arrays_zip("doc_ids", "hashes", "sizes")).alias("d")
    held = staged(blocks.select("task", "block", each).groupBy(
        "task", "block", F.col("d.doc_ids").alias("doc_id"), F.col("d.hashes").alias("text_hash"), F.col("d.sizes").alias("size"))
        .agg(F.count(F.lit(1)).alias("copies")), "places")
    parts = 1 << max(0, (held.count() // ROWS_PER_PART).bit_length())
    # Rows equal in these columns have equal tokens but for a collision, which changes their order at most; a block holds one row of them.
    order = F.xxhash64("doc_id", "text_hash")
    held = held.withColumn("part", F.pmod(order, F.lit(parts)))
    taken = F.col("copies") * F.col("size")
    totals = held.groupBy("part").agg(F.sum(taken).alias("all"))
    # One row per million documents: a small window.
    begins = totals.select("part", (F.sum("all").over(Window.partitionBy(F.lit(0)).orderBy("part")) - F.col("all")).alias("begin"))
    within = Window.partitionBy("part").orderBy(order, "doc_id", "text_hash", "size", "task", "block").rowsBetween(Window.unboundedPreceding, 0)
    local = held.withColumn("local", F.sum(taken).over(within) - taken)
    return staged(local.join(begins, "part").select("task", "block", "doc_id", "text_hash", "size", "copies",
                                                    (F.col("begin") + F.col("local")).alias("start")), "places")


def _pieces(start: np.ndarray, size: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The stretches of the stream cut at sequence ends: which stretch, sequence, place in it, tokens, offset in the stretch."""
    first = start // length
    counts = (start + size - 1) // length - first + 1
    of = np.repeat(np.arange(len(start)), counts)
    sequence = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts) + first[of]
    begin = np.maximum(sequence * length, start[of])
    tokens = np.minimum((sequence + 1) * length, (start + size)[of]) - begin
    return of, sequence, begin - sequence * length, tokens, begin - start[of]


def write_shards(docs: DataFrame, ranks: dict[bytes, int], path: str, length: int = LENGTH, per_shard: int | None = None,
                 key: int = KEY) -> DataFrame:
    """Write the shards of ``docs`` under ``path``; (slot, n_tokens, doc_ids) of every sequence. ``per_shard``: ``shard_size`` unless given."""
    spark = docs.sparkSession
    end, kind = len(ranks), "<u2" if len(ranks) < 1 << 16 else "<u4"
    name, staging = f"token_blocks_{uuid.uuid4().hex}", fresh_path(spark, "llm", "token_blocks")
    blocks = _tokenised(docs, ranks, name, staging)
    places = _placed(blocks)
    total = places.agg(F.sum(F.col("copies") * F.col("size"))).first()[0] or 0
    n = -(-total // length)
    per_shard = per_shard or shard_size(n)
    shards = max(1, -(-n // per_shard))
    gather = min(max(PER_SHARD, 4 * shards), 8 * PER_SHARD) * LENGTH

    def by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, unpack = zstandard.ZstdCompressor(level=LEVEL), zstandard.ZstdDecompressor()
        held: list[tuple[np.ndarray, ...]] = []
        gathered = 0

        def sent() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            slot, at, size, begin = (np.concatenate([h[i] for h in held]) for i in range(4))
            source, streams = np.repeat(np.arange(len(held)), [len(h[0]) for h in held]), [h[4] for h in held]
            held.clear()
            order = np.argsort(slot // per_shard, kind="stable")
            shard = (slot // per_shard)[order]
            cuts = np.flatnonzero(np.diff(shard, prepend=-1))
            for rows in np.split(order, cuts[1:]):
                taken = zip(source[rows].tolist(), begin[rows].tolist(), (begin + size)[rows].tolist(), strict=True)
                data = np.concatenate([streams[s][a:b] for s, a, b in taken])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(slot[rows[0]] // per_shard)], pa.int32()), *[pa.array([x[rows]], pa.list_(pa.int32()))
                     for x in (slot % per_shard, at, size)], pa.array([pack.compress(data.tobytes())], pa.binary())],
                    ["shard", "places", "ats", "sizes", "data"])

        for batch in batches:
            for row in batch.to_pylist():
                begin = {(d["doc_id"], d["text_hash"], d["size"]): d["start"] for d in row["starts"]}
                start = []
                for document in zip(row["doc_ids"], row["hashes"], row["sizes"], strict=True):
                    start.append(begin[document])
                    begin[document] += document[2]
                size = np.array(row["sizes"], np.int64)
                of, sequence, at, tokens, offset = _pieces(np.array(start, np.int64), size, length)
                held.append((slots(sequence, n, key), at, tokens, (np.cumsum(size) - size)[of] + offset,
                             np.frombuffer(unpack.decompress(row["data"]), kind)))
                gathered += int(size.sum())
                if gathered >= gather:
                    yield from sent()
                    gathered = 0
        yield from sent()

    def ordered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        whole: dict[int, np.ndarray] = {}
        for batch in batches:
            for shard, places, ats, sizes, data in zip(*[batch.column(c) for c in ("shard", "places", "ats", "sizes", "data")], strict=True):
                shard = shard.as_py()
                if shard not in whole:
                    whole[shard] = np.full(min(per_shard, n - shard * per_shard) * length, end, kind)
                place, at, size = (x.values.to_numpy().astype(np.int64) for x in (places, ats, sizes))
                tokens = np.frombuffer(unpack.decompress(data.as_py()), kind)
                whole[shard][np.repeat(place * length + at - np.cumsum(size) + size, size) + np.arange(len(tokens))] = tokens
        for shard, records in whole.items():
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([records.tobytes()], pa.binary())], ["shard", "data"])

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["slot", "start", "n_tokens", "doc_id"]
        for batch in batches:
            start, size, copies = (batch.column(c).to_numpy() for c in ("start", "size", "copies"))
            row = np.repeat(np.arange(len(start)), copies)
            start = start[row] + size[row] * (np.arange(len(row)) - np.repeat(np.cumsum(copies) - copies, copies))
            of, sequence, at, tokens, _ = _pieces(start, size[row], length)
            ids = batch.column("doc_id").take(pa.array(row[of]))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (slots(sequence, n, key), at, tokens)] + [ids], names)

    # The blocks are read by bucket, in the tasks' number; the block is compared within the join, as it is no bucket column.
    starts = places.groupBy("task", "block").agg(F.collect_list(F.struct("doc_id", "text_hash", "size", "start")).alias("starts"))
    starts = starts.select(F.col("task").alias("of_task"), F.col("block").alias("of_block"), "starts").hint("shuffle_hash")
    here = blocks.join(starts, (F.col("task") == F.col("of_task")) & (F.col("block") - F.col("of_block") == 0))
    sent = here.select("doc_ids", "hashes", "sizes", "starts", "data").mapInArrow(
        by_shard, "shard int, places array<int>, ats array<int>, sizes array<int>, data binary")
    files = sent.repartitionById(shards, F.col("shard")).mapInArrow(ordered, "shard int, data binary")
    # The text sink writes a string's bytes as they are: the shard, then one line end.
    files.select("shard", F.col("data").cast("string").alias("value")).write.partitionBy("shard").text(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    drop_path(spark, staging)

    parts = places.select("start", "size", "copies", "doc_id").mapInArrow(listed, "slot long, start long, n_tokens long, doc_id long")
    in_order = F.transform(F.sort_array(F.collect_list(F.struct("start", "doc_id"))), lambda x: x["doc_id"])
    return parts.groupBy("slot").agg(F.sum("n_tokens").cast("int").alias("n_tokens"), in_order.alias("doc_ids"))


def read_records(spark: SparkSession, path: str, length: int = LENGTH, per_shard: int = PER_SHARD, width: int = 2,
                 from_slot: int = 0) -> DataFrame:
    """(slot, shard, byte_offset, record) of the written shards, from a slot on; files before it are not opened."""
    stride = width * length
    files = spark.read.format("binaryFile").option("basePath", path).load(path).where(F.col("shard") >= from_slot // per_shard)
    shard, at = F.col("shard").cast("int"), F.col("place")
    slot = (F.col("shard").cast("long") * per_shard + at).cast("long")
    places = F.sequence(F.lit(0), (F.length("content") / stride).cast("int") - 1)
    return (files.select("shard", "content", F.explode(places).alias("place"))
            .select(slot.alias("slot"), shard.alias("shard"), (at.cast("long") * stride).alias("byte_offset"),
                    F.substring("content", at * stride + 1, F.lit(stride)).alias("record"))
            .where(F.col("slot") >= from_slot))


def query(spark: SparkSession, sf_dir: str, vocabulary: str = VOCABULARY) -> DataFrame:
    return ordered_output(read(spark, sf_dir, "documents"), vocabulary)


def ordered_output(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Shards in the shared folder, and a row per sequence: where its record is, its CRC-32 there, its documents."""
    spark = docs.sparkSession
    path = fresh_path(spark, "llm", "token_shards")
    listed = staged(write_shards(docs, load_ranks(vocabulary), path), "sequences")
    n = listed.count()
    if not n:
        return listed.select("slot", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("byte_offset"), "n_tokens",
                             F.lit(0).cast("long").alias("tokens_crc32"), "doc_ids").limit(0)
    written = read_records(spark, path, per_shard=shard_size(n)).select("slot", "shard", "byte_offset", F.crc32("record").alias("tokens_crc32"))
    return written.join(listed, "slot").select("slot", "shard", "byte_offset", "n_tokens", "tokens_crc32", "doc_ids")
