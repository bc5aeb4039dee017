"""Alignment of two tokenizers over the same text, in Arrow.

Per slice of documents both token lists are flattened with their parent indices; the byte lengths of the tokens are summed up
within each document, so every token has a document-end key (document << 32 | end offset). A full outer hash join
of the two key columns gives the cells between neighbouring ends: a cell lies in one token of each side, so the cells are
the overlapping token pairs (links), and ends that both sides have cut the tokens into groups.

Corpus-wide, the id pairs that a document holds linked are staged once, each with its number of links there.
``Table.group_by`` counts them per batch and Spark merges the partial counts. The counts return to the documents by a join:
pairs that hold over 1/``PARTS`` of all (document, pair) rows are at most ``PARTS``, so they are broadcast; the others
go through a shuffle join, where none of them is hot.

Defined cases: a null or empty text, and one that either side does not give back byte by byte after the space in
front, has no tokens: zeros and an empty digest. Special-token strings in a text are ordinary text. A text of any
length is a slice by itself. Rows that repeat a doc_id are documents of their own; ties for the highest count
all count; an empty table gives no rows. Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import hashlib
import json
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from laborlake.llm.common import own_columns, read, staged
from laborlake.llm.tasks import ship_by_value

ship_by_value(sys.modules[__name__])

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_BPE = "/opt/tokenizers/piece_bpe_32k.model"
#: Fixed value: the word pattern of the byte-level vocabularies, from their README's module.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SLICE = 1 << 20  # bytes of text that are aligned at once; a longer document is a slice of its own
PARTS = 200_000


# ---- the two tokenizers ------------------------------------------------------------------------

def load_byte_bpe(path: str) -> dict[bytes, int]:
    """Token bytes -> id of a byte-level BPE file whose ids follow the order of its merges, without its special tokens."""
    with open(path, encoding="utf-8") as file:
        held = json.load(file)
    # A byte stands for itself where Latin-1 shows it as a character, the others follow from U+0100 on.
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in shown}
    byte_of.update({chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)})
    special = {token["content"] for token in held["added_tokens"]}
    return {bytes(byte_of[c] for c in piece): i for piece, i in held["model"]["vocab"].items() if piece not in special}


def load_pieces(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


class ByteBpe:
    """Space and text by byte-level BPE; ``bytes``: each id's bytes."""

    def __init__(self, ranks: dict[bytes, int]):
        import tiktoken

        self.coder = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        held = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            held[i] = token
        self.bytes = pa.array(held, pa.binary())

    def encode(self, texts: list[str]) -> pa.ListArray:
        ids = [self.coder.encode_to_numpy(" " + text, disallowed_special=()) for text in texts]
        ends = np.cumsum([0, *map(len, ids)])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids) if ids else [], pa.int32()))


class PieceBpe:
    """Text by a SentencePiece model, which adds the space; ``bytes``: each id's bytes (none for control and unknown pieces)."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.coder = sentencepiece.SentencePieceProcessor(model_proto=model)
        held = []
        for i in range(self.coder.get_piece_size()):
            piece = self.coder.id_to_piece(i)
            if self.coder.is_byte(i):
                held.append(bytes([int(piece[3:5], 16)]))
            else:
                gone = self.coder.is_control(i) or self.coder.is_unknown(i)
                held.append(b"" if gone else piece.replace("▁", " ").encode())
        self.bytes = pa.array(held, pa.binary())

    def encode(self, texts: list[str]) -> pa.ListArray:
        return pa.array(self.coder.encode(texts, num_threads=1), pa.list_(pa.int32()))


# ---- alignment of a slice ------------------------------------------------------------------------

def _offsets(counts: np.ndarray) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())


def _returned(tokens: pa.ListArray, table: pa.Array, want: list[bytes]) -> np.ndarray:
    """Which documents the tokens' bytes give back."""
    spelt = pc.take(table, tokens.values)
    data = memoryview(spelt.buffers()[2] or b"").cast("B")
    ends = np.frombuffer(spelt.buffers()[1], np.int32)[:len(spelt) + 1][tokens.offsets.to_numpy()]
    return np.array([data[a:b] == w for a, b, w in zip(ends[:-1], ends[1:], want, strict=True)], bool)


def _ends(tokens: pa.ListArray, lengths: pa.Array, side: str) -> pa.Table:
    """Document-end key, id and place of every token."""
    parents = pc.cast(pc.list_parent_indices(tokens), pa.int64())
    summed = pc.cumulative_sum(pc.take(lengths, tokens.values))
    before = np.concatenate([[0], summed.to_numpy()])[tokens.offsets.to_numpy()[:-1]]
    within = pc.subtract(summed, pc.take(pa.array(before, pa.int64()), parents))
    key = pc.add(pc.shift_left(parents, pa.scalar(32, pa.int64())), within)
    return pa.table({"key": key, side: tokens.values, f"{side}_at": pa.array(np.arange(len(key)), pa.int64())})


def align(texts: list[str | None], a: ByteBpe, b: PieceBpe) -> pa.Table:
    """Alignment of each text: ``a_groups``, ``b_groups`` (token ids per group), ``a_links``, ``b_links`` (ids of the overlapping pairs)."""
    order = [i for i, text in enumerate(texts) if text]
    held = [texts[i] for i in order]
    tokens_a, tokens_b = a.encode(held), b.encode(held)
    want = [b" " + text.encode() for text in held]
    good = _returned(tokens_a, a.bytes, want) & _returned(tokens_b, b.bytes, want)
    if not good.all():
        keep = pa.array(np.flatnonzero(good), pa.int64())
        order = [order[i] for i in keep.to_pylist()]
        tokens_a, tokens_b = pc.take(tokens_a, keep), pc.take(tokens_b, keep)
    ends_a = _ends(tokens_a, pc.cast(pc.binary_length(a.bytes), pa.int64()), "a")
    ends_b = _ends(tokens_b, pc.cast(pc.binary_length(b.bytes), pa.int64()), "b")
    cells = ends_a.join(ends_b, "key", join_type="full outer", use_threads=False).combine_chunks()
    cells = cells.take(pc.sort_indices(cells["key"])).combine_chunks()
    parents = pc.shift_right(cells["key"], pa.scalar(32, pa.int64())).to_numpy()
    # A token reaches from the end before it to its own, so a cell without an end lies in the next token of that side.
    links = {side: pc.fill_null_backward(cells[side]).combine_chunks() for side in "ab"}
    common = pc.and_(pc.is_valid(cells["a"]), pc.is_valid(cells["b"]))
    cuts = cells.filter(common)
    n, places = len(texts), np.array(order, np.int64)
    per_text = np.zeros((2, n), np.int64)
    per_text[0, places] = np.bincount(parents[common.to_numpy(zero_copy_only=False)], minlength=len(order))
    per_text[1, places] = np.bincount(parents, minlength=len(order))
    out = {}
    for side, tokens in (("a", tokens_a), ("b", tokens_b)):
        bounds = pa.array(np.concatenate([[0], cuts[f"{side}_at"].to_numpy() + 1]), pa.int32())
        groups = pa.ListArray.from_arrays(bounds, tokens.values.slice(0, bounds[-1].as_py()))
        out[f"{side}_groups"] = pa.ListArray.from_arrays(_offsets(per_text[0]), groups)
        out[f"{side}_links"] = pa.ListArray.from_arrays(_offsets(per_text[1]), links[side])
    return pa.table(out)


def _slices(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    sizes = pc.fill_null(pc.binary_length(rows.column("text")), 0).to_numpy()
    at, size = 0, 0
    for i, n in enumerate(sizes):
        if i > at and size + n > SLICE:
            yield rows.slice(at, i - at)
            at, size = i, 0
        size += n
    if at < len(sizes):
        yield rows.slice(at)


_CODERS: dict[int, tuple[ByteBpe, PieceBpe]] = {}  # one pair per worker process and vocabularies


def _coders(ranks: dict[bytes, int], model: bytes) -> tuple[ByteBpe, PieceBpe]:
    key = hash((len(ranks), model))
    return _CODERS.get(key) or _CODERS.setdefault(key, (ByteBpe(ranks), PieceBpe(model)))


ALIGNED = "array<array<int>>"


def alignments(docs: DataFrame, ranks: dict[bytes, int], model: bytes) -> DataFrame:
    """(doc_id, a_groups, b_groups, a_links, b_links) of every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast((ranks, model))
    kinds = pa.schema([("doc_id", pa.int64()), *[(f"{s}_{k}", t) for k, t in (("groups", pa.list_(pa.list_(pa.int32()))), ("links", pa.list_(pa.int32())))
                                                 for s in "ab"]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _coders(*shared.value)
        for batch in batches:
            for rows in _slices(batch):
                found = align(rows.column("text").to_pylist(), a, b).combine_chunks()
                yield from found.add_column(0, "doc_id", rows.column("doc_id")).select(kinds.names).cast(kinds).to_batches()

    rows = own_columns(docs, ["doc_id", "text"]).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, f"doc_id long, a_groups {ALIGNED}, b_groups {ALIGNED}, a_links array<int>, b_links array<int>")


# ---- digests and corpus-wide counts --------------------------------------------------------------

_DIGEST = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), *[(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")],
                     ("groups_sha256", pa.string()), ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int32()))])


def digest(found: pa.Table) -> dict[str, pa.Array]:
    """Counts, group digest and distinct linked pairs of each alignment."""
    found = found.combine_chunks()
    columns = {c: found[c].combine_chunks() for c in found.column_names}
    n_groups = np.diff(columns["a_groups"].offsets.to_numpy())
    n_links = np.diff(columns["a_links"].offsets.to_numpy())
    spelt, counts = {}, {}
    for side in "ab":
        groups = columns[f"{side}_groups"]
        inner, ends = groups.values, groups.offsets.to_numpy()
        counts[side] = np.diff(inner.offsets.to_numpy()[ends])
        spelt[side] = pc.binary_join(pa.ListArray.from_arrays(inner.offsets, pc.cast(inner.values, pa.string())), ",")
    whole = pc.binary_join_element_wise(spelt["a"], spelt["b"], "|")
    texts = pc.binary_join(pa.ListArray.from_arrays(columns["a_groups"].offsets, whole), ";")
    shas = [hashlib.sha256(t.as_buffer()).hexdigest() if n else "" for t, n in zip(texts, n_groups, strict=True)]
    pair = pc.bit_wise_or(pc.shift_left(pc.cast(columns["a_links"].values, pa.int64()), pa.scalar(32, pa.int64())), pc.cast(columns["b_links"].values, pa.int64()))
    held = pa.table({"text": pc.list_parent_indices(columns["a_links"]), "pair": pair})
    held = held.group_by(["text", "pair"], use_threads=False).aggregate([([], "count_all")])
    held = held.take(pc.sort_indices(held["text"])).combine_chunks()
    per_text = _offsets(np.bincount(held["text"].to_numpy(), minlength=len(found)))
    return {"n_a": pa.array(counts["a"], pa.int64()), "n_b": pa.array(counts["b"], pa.int64()), "n_groups": pa.array(n_groups, pa.int64()),
            "n_links": pa.array(n_links, pa.int64()), "groups_sha256": pa.array(shas, pa.string()),
            "pairs": pa.ListArray.from_arrays(per_text, held["pair"].combine_chunks()),
            "times": pa.ListArray.from_arrays(per_text, pc.cast(held["count_all"].combine_chunks(), pa.int32()))}


def _digested(docs: DataFrame, ranks: dict[bytes, int], model: bytes) -> DataFrame:
    """Staged: a row number, the digest of the row's alignment, and its distinct linked pairs with their links."""
    shared = docs.sparkSession.sparkContext.broadcast((ranks, model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _coders(*shared.value)
        for batch in batches:
            for rows in _slices(batch):
                found = {"row": rows.column("row"), "doc_id": rows.column("doc_id"), **digest(align(rows.column("text").to_pylist(), a, b))}
                yield pa.RecordBatch.from_arrays([found[c] for c in _DIGEST.names], schema=_DIGEST)

    rows = own_columns(docs, ["doc_id", "text"]).select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return staged(rows.mapInArrow(run, "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
                                       "pairs array<bigint>, times array<int>"), "alignments")


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        held = pa.table({"pair": pc.list_flatten(batch.column("pairs"))})
        counted = held.group_by("pair", use_threads=False).aggregate([([], "count_all")]).rename_columns(["pair", "n"])
        yield from counted.cast(pa.schema([("pair", pa.int64()), ("n", pa.int64())])).combine_chunks().to_batches()


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, n, best): documents that hold the pair linked, and whether no other pair of its A id has more."""
    counts = rows.select("pairs").mapInArrow(_partial_counts, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    # An A id has at most as many pairs as B has pieces.
    most = F.max("n").over(Window.partitionBy(F.shiftright("pair", 32)))
    return counts.select("pair", "n", (F.col("n") == most).alias("best"))


def query(spark: SparkSession, sf_dir: str, a_path: str = BYTE_BPE, b_path: str = PIECE_BPE) -> DataFrame:
    return counted(read(spark, sf_dir, "documents"), load_byte_bpe(a_path), load_pieces(b_path))


def counted(docs: DataFrame, ranks: dict[bytes, int], model: bytes, parts: int = PARTS) -> DataFrame:
    """Digest of every row's alignment with the corpus-wide counts of its links."""
    rows = _digested(docs, ranks, model)
    counts = staged(pair_counts(rows), "pair_counts")
    limit = max(1, counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] // parts)
    hot = F.broadcast(counts.where(F.col("n") > limit))
    links = rows.select("row", F.inline(F.arrays_zip("pairs", "times"))).withColumnRenamed("pairs", "pair")
    cold = links.join(hot.select("pair"), "pair", "left_anti").join(counts.where(F.col("n") <= limit), "pair")
    digests = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    sums = [F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("times")).alias("count_sum")]
    parts_of = [rows.select("row", *digests, F.lit(0).cast("long").alias("n_best"), F.lit(0).cast("long").alias("count_sum"))]
    for held in (links.join(hot, "pair"), cold):
        parts_of.append(held.groupBy("row").agg(*sums))
    whole = parts_of[0].unionByName(parts_of[1], allowMissingColumns=True).unionByName(parts_of[2], allowMissingColumns=True)
    # One row per document has the digest, the others are null there.
    return (whole.groupBy("row").agg(*[F.max(c).alias(c) for c in digests], F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
            .select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"))
