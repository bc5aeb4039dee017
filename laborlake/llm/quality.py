"""Quality scores by nearest-neighbour voting in a latent-semantic space.

A document's terms are hashed byte trigrams, trigrams of character classes, and
repeats of the word before; their logged counts are weighted by inverse document
frequency. A singular value decomposition over a bounded sample of labelled
documents gives the latent space, and the sample's unit vectors there are
broadcast: at most ``sample`` x ``rank`` floats, whatever the input. Every document's whole
text is projected, its cosines with all sample vectors are computed exactly,
block by block, and the nearest vote with similarity to the power ``sharpness``.
Votes of the two labels are balanced by their shares of the sample.

Defined cases: a null text counts as empty; a document without any similarity to the sample (an empty
text among them) gets the sample's share of label 1; with no labelled document every score is 0.5.
Labels other than 0 and 1 are ignored, repeated labels of a document are averaged (half counts as 1);
of rows that repeat a labelled doc_id, the smallest text is learnt from.
The score depends on the text alone. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from laborlake.llm.common import own_columns, read, unambiguous
from laborlake.llm.tasks import ship_by_value

ship_by_value(sys.modules[__name__])

GRAMS, SHAPES = 2048, 4096  # hashed byte trigrams; trigrams of 16 character classes
TERMS = GRAMS + SHAPES + 1
BLOCK = 256  # documents that are projected and compared at once
THRESHOLD = 0.3


def _classes() -> np.ndarray:
    """Character class of each byte; bytes of non-ASCII characters count as lower-case letters."""
    table = np.full(256, 10, np.int64)
    table[128:] = 1
    for cls, chars in ((1, "abcdefghijklmnopqrstuvwxyz"), (2, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (3, "0123456789"),
                       (4, " "), (5, "\n\r"), (6, ".,"), (7, "!"), (8, "|"), (9, "$#&%*")):
        table[[ord(c) for c in chars]] = cls
    return table


_CLASS = _classes()


def term_counts(text: str | None) -> np.ndarray:
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    codes = np.frombuffer(raw, np.uint8).astype(np.int64)
    if len(codes) < 3:
        return np.zeros(TERMS, np.float32)
    grams = (codes[:-2] << 16 | codes[1:-1] << 8 | codes[2:]) * 2654435761 >> 16
    cls = _CLASS[codes]
    shapes = cls[:-2] << 8 | cls[1:-1] << 4 | cls[2:]
    repeats = sum(map(bytes.__eq__, words, words[1:]))
    return np.concatenate([np.bincount(grams % GRAMS, minlength=GRAMS), np.bincount(shapes, minlength=SHAPES),
                           [3 * repeats]]).astype(np.float32)


def _unit(rows: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norms, out=np.zeros_like(rows), where=norms > 1e-6)


@dataclass
class Model:
    """Term weights, the projection, and the labelled unit vectors."""

    idf: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    neighbours: int
    sharpness: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(texts), 0.5)
        share = float(self.labels.mean())
        weight = np.where(self.labels == 1, 1.0, share / (1 - share) if 0 < share < 1 else 1.0)
        out = np.empty(len(texts))
        k = min(self.neighbours, len(self.labels))
        for at in range(0, len(texts), BLOCK):
            counts = np.stack([term_counts(t) for t in texts[at:at + BLOCK]])
            points = _unit((np.log1p(counts) * self.idf) @ self.axes)
            cosines = points @ self.vectors.T
            near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
            votes = np.maximum(np.take_along_axis(cosines, near, 1), 0) ** self.sharpness * weight[near]
            total = votes.sum(1)
            ones = (votes * self.labels[near]).sum(1)
            out[at:at + BLOCK] = np.divide(ones, total, out=np.full(len(total), share), where=total > 0)
        return np.clip(out, 0.0, 1.0)


def singular_axes(rows: np.ndarray, rank: int, rounds: int = 12) -> np.ndarray:
    """The leading right singular vectors by subspace iteration, with some vectors to spare, from a fixed start."""
    spare = min(rank + 16, *rows.shape)
    span = np.random.default_rng(0).standard_normal((rows.shape[1], spare)).astype(np.float32)
    for _ in range(rounds):
        span = np.linalg.qr(rows.T @ (rows @ span))[0]
    _, _, right = np.linalg.svd(rows @ span, full_matrices=False)
    return (span @ right.T[:, :rank]).astype(np.float32)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample: int = 3000, rank: int = 32, neighbours: int = 15,
        sharpness: float = 4.0) -> Model:
    """The model from at most ``sample`` labelled rows that are not held out (those with the smallest id hashes)."""
    marked = (own_columns(labels, ["doc_id", "quality"]).where("quality in (0, 1) and doc_id is not null")
              .where(~held_out(F.col("doc_id"))).groupBy("doc_id")
              .agg((F.avg("quality") >= 0.5).cast("int").alias("label")))
    chosen = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = (own_columns(docs, ["doc_id", "text"]).join(F.broadcast(chosen), "doc_id")
             .groupBy("doc_id", "label").agg(F.min("text").alias("text")))

    def sparse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            counts = [term_counts(t) for t in rows["text"]]
            at = [np.flatnonzero(c).astype(np.uint16) for c in counts]
            yield pd.DataFrame({"doc_id": rows["doc_id"], "label": rows["label"],
                                "at": [a.tobytes() for a in at],
                                "counts": [c[a].tobytes() for c, a in zip(counts, at, strict=True)]})

    rows = texts.mapInPandas(sparse, "doc_id long, label int, at binary, counts binary").collect()
    rows.sort(key=lambda r: r["doc_id"])
    weighted = np.zeros((len(rows), TERMS), np.float32)  # filled, weighted and scaled in place: the driver holds one such array
    seen = np.zeros(TERMS, np.int64)
    for i, r in enumerate(rows):
        at = np.frombuffer(r["at"], np.uint16)
        weighted[i, at] = np.log1p(np.frombuffer(r["counts"], np.float32))
        seen[at] += 1
    idf = np.where(seen > 0, np.log((1 + len(rows)) / (1 + seen)) + 0.3, 0).astype(np.float32)
    for row in weighted:
        row *= idf
        row /= max(float(np.linalg.norm(row)), 1e-6)
    axes = singular_axes(weighted, min(rank, len(rows))) if rows else np.zeros((TERMS, 0), np.float32)
    return Model(idf, axes, _unit(weighted @ axes), np.array([r["label"] for r in rows], np.int64), neighbours, sharpness)


def score(text: Column, model: Model) -> Column:
    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(model.scores(texts.tolist()))

    return scores(text)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that are not rejected."""
    rows = unambiguous(docs, ["text"])
    return rows.where(score(rows["text"], fit(docs, labels)) >= threshold).toDF(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = own_columns(read(spark, sf_dir, "documents"), ["doc_id", "text"])
    model = fit(docs, read(spark, sf_dir, "labels"))
    return docs.withColumn("score", score(docs["text"], model)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
