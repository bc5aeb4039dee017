"""Quality rules: counted base rules, and a calibrated logistic regression over hashed n-grams.

The base rules count words, symbols, repeated lines and repeated word windows of the whole text. The verdict on the rest comes from
a logistic regression: hashed words and word pairs, and hashed character n-grams of one to three code points, as logged counts
of unit length in either half. It is trained by L-BFGS on a bounded sample of the labelled documents (at
most ``sample`` rows, the smallest id hashes of those that are not held out); a fold of the sample is set aside to calibrate the margin into a
probability (Platt). The weights, one float a bucket, go to the tasks, which score Arrow batches against two fixed thresholds:
below ``REJECT`` a document goes, below ``REVIEW`` it stays and is marked.

Defined cases: a null text counts as empty, has no words and fails the base rules; without a label of each kind in the sample
the regression keeps everything (probability 1). Labels other than 0 and 1 are ignored, repeated labels of a document are
averaged (half counts as 1); of rows that repeat a labelled doc_id, the smallest text is learnt from. Rows that repeat
a doc_id are judged each, and equal texts alike, whatever their other columns. An empty table gives no rows.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laborlake.llm.common import own_columns, read
from laborlake.llm.quality import held_out
from laborlake.llm.tasks import ship_by_value

ship_by_value(sys.modules[__name__])

WORDS, CHARS = 1 << 13, 1 << 14  # buckets of word n-grams and of character n-grams
TERMS = WORDS + CHARS
SAMPLE = 3000
CALIBRATION = 5  # every so many-th row of the sample calibrates
RIDGE = 0.02
REJECT, REVIEW = 0.3, 0.7
MIN_WORDS, MOST_REPEATED = 50, 50  # base rules: words at least, percent of words in repeated windows at most
SYMBOLS = "#*$%&|<>"
_SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ---- one text ------------------------------------------------------------------------------------

@dataclass
class Words:
    """The words of a text in order, as numbers of its distinct words."""

    ids: np.ndarray
    distinct: dict[str, int]
    chars: int


def words_of(text: str) -> Words:
    found = _WORD.findall(text)
    distinct = {w: i for i, w in enumerate(dict.fromkeys(found))}
    ids = np.fromiter(map(distinct.__getitem__, found), np.int64, len(found))
    return Words(ids, distinct, sum(map(len, found)))


def repeated_words(words: Words) -> int:
    """Words in 3-word windows that the text holds twice or more."""
    ids, n = words.ids, len(words.distinct)
    if len(ids) < 4:
        return 0
    pairs = np.unique(ids[:-1] * n + ids[1:], return_inverse=True)[1]  # below the text's length, so no product overflows
    _, which, times = np.unique(pairs[:-1] * n + ids[2:], return_inverse=True, return_counts=True)
    again = times[which] > 1
    held = np.zeros(len(ids), bool)
    for shift in range(3):
        held[shift:shift + len(again)] |= again
    return int(held.sum())


def repeated_lines(text: str) -> int:
    seen: set[str] = set()
    n = 0
    for line in text.split("\n"):
        if line in seen:
            n += 1
        elif line.strip(_SPACE):
            seen.add(line)
    return n


def features(text: str, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, values): logged counts, of unit length among the word buckets and among the character buckets."""
    hashes = np.array([zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words.distinct], np.uint64)[words.ids]
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    mix, shift = np.uint64(0x9E3779B97F4A7C15), np.uint64(40)

    def buckets(keys: np.ndarray, size: int) -> np.ndarray:
        return (keys * mix >> shift).astype(np.int64) % size

    grams = [buckets(hashes, WORDS), buckets(hashes[:-1] * np.uint64(31) + hashes[1:], WORDS)]
    keys = codes + np.uint64(1)
    for n in range(3):
        if n:
            keys = keys[:-1] * np.uint64(0x200003) + codes[n:] + np.uint64(1)
        grams.append(WORDS + buckets(keys, CHARS))
    counts = np.bincount(np.concatenate(grams), minlength=TERMS)
    at = np.flatnonzero(counts)
    values = np.log1p(counts[at]).astype(np.float32)
    half = int(np.searchsorted(at, WORDS))
    for part in (values[:half], values[half:]):
        if len(part):
            part /= np.linalg.norm(part)
    return at, values


# ---- the regression --------------------------------------------------------------------------------

def least(function, start: np.ndarray, rounds: int = 80, memory: int = 8) -> np.ndarray:
    """Minimiser of a smooth convex function (value, gradient) by L-BFGS with step halving."""
    x, (value, slope) = start, function(start)
    steps: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(rounds):
        if np.abs(slope).max() < 1e-6:
            break
        way, held = slope.copy(), []
        for s, y, r in reversed(steps):
            a = r * (s @ way)
            held.append(a)
            way -= a * y
        if steps:
            s, y, r = steps[-1]
            way /= r * (y @ y)
        for (s, y, r), a in zip(steps, reversed(held), strict=True):
            way += s * (a - r * (y @ way))
        size, down = 1.0, slope @ way
        while size > 1e-10:
            new, (new_value, new_slope) = x - size * way, function(x - size * way)
            if new_value <= value - 1e-4 * size * down:
                break
            size /= 2
        else:
            break
        s, y = new - x, new_slope - slope
        if s @ y > 1e-12:
            steps = [*steps[1 - memory:], (s, y, 1 / (s @ y))]
        x, value, slope = new, new_value, new_slope
    return x


def _logistic(margin: np.ndarray, label: np.ndarray) -> tuple[float, np.ndarray]:
    """Summed loss of 0/1 labels, and its derivative by the margin."""
    loss = np.logaddexp(0, margin) - label * margin
    return float(loss.sum()), 1 / (1 + np.exp(-np.clip(margin, -500, 500))) - label


def train(rows: list[tuple[np.ndarray, np.ndarray]], label: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    """Weights of the buckets and, last, the intercept."""
    starts = np.cumsum([0, *[len(at) for at, _ in rows]])
    at, values = (np.concatenate([r[i] for r in rows]) for i in (0, 1))
    row = np.repeat(np.arange(len(rows)), np.diff(starts))

    def function(w: np.ndarray) -> tuple[float, np.ndarray]:
        margin = np.bincount(row, values * w[at], len(rows)) + w[-1]
        loss, slope = _logistic(margin, label)
        gradient = np.append(np.bincount(at, values * slope[row], TERMS), slope.sum())
        inner = np.append(w[:-1], 0)
        return loss + ridge / 2 * float(inner @ inner), gradient + ridge * inner

    return least(function, np.zeros(TERMS + 1))


def calibrate(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Platt's slope and intercept, on targets smoothed by the class counts; the slope is never negative."""
    ones = label.sum()
    target = np.where(label == 1, (ones + 1) / (ones + 2), 1 / (len(label) - ones + 2))

    def function(p: np.ndarray) -> tuple[float, np.ndarray]:
        loss, slope = _logistic(p[0] * margin + p[1], target)
        return loss + 1e-6 * float(p @ p), np.array([slope @ margin, slope.sum()]) + 2e-6 * p

    slope, offset = least(function, np.array([1.0, 0.0]))
    return max(float(slope), 0.0), float(offset)


@dataclass
class Model:
    weights: np.ndarray  # None of them without both labels
    slope: float
    offset: float

    def probability(self, at: np.ndarray, values: np.ndarray) -> float:
        if not len(self.weights):
            return 1.0
        margin = float(values @ self.weights[at]) + self.weights[-1]
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -500, 500))))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """The model from at most ``sample`` labelled rows that are not held out."""
    marked = (own_columns(labels, ["doc_id", "quality"]).where("quality in (0, 1) and doc_id is not null")
              .where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("label")))
    chosen = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = (own_columns(docs, ["doc_id", "text"]).join(F.broadcast(chosen), "doc_id")
             .groupBy("doc_id", "label").agg(F.min(F.coalesce("text", F.lit(""))).alias("text")))

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            found = [features(t, words_of(t)) for t in rows.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), rows.column("label"), pa.array([at.astype("<u2").tobytes() for at, _ in found], pa.binary()),
                 pa.array([v.tobytes() for _, v in found], pa.binary())], ["doc_id", "label", "at", "held"])

    rows = texts.mapInArrow(sparse, "doc_id long, label int, at binary, held binary").collect()
    rows.sort(key=lambda r: (zlib.crc32(str(r["doc_id"]).encode()), r["doc_id"]))
    held = [(np.frombuffer(r["at"], "<u2").astype(np.int32), np.frombuffer(r["held"], np.float32)) for r in rows]
    label = np.array([r["label"] for r in rows], np.float64)
    apart = np.arange(len(rows)) % CALIBRATION == 0
    learnt = np.flatnonzero(~apart)
    if not len(rows) or not 0 < label[learnt].sum() < len(learnt):
        return Model(np.zeros(0), 1.0, 0.0)
    weights = train([held[i] for i in learnt], label[learnt])
    margins = np.array([float(v @ weights[at]) + weights[-1] for at, v in held])
    fold = apart if 0 < label[apart].sum() < apart.sum() else np.ones(len(rows), bool)
    slope, offset = calibrate(margins[fold], label[fold])
    return Model(weights.astype(np.float32), slope, offset)


JUDGED = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
          "probability double, verdict string, kept boolean")
_KINDS = pa.schema([("doc_id", pa.int64()), *[(c, pa.int64()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
                    ("base_failed", pa.bool_()), ("probability", pa.float64()), ("verdict", pa.string()), ("kept", pa.bool_())])


def judge(docs: DataFrame, model: Model) -> DataFrame:
    """Base counts, probability of label 1 and verdict (reject, review or keep) of every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judged(text: str) -> tuple:
        words = words_of(text)
        n, repeated = len(words.ids), repeated_words(words)
        failed = n < MIN_WORDS or 100 * repeated > MOST_REPEATED * n
        probability = shared.value.probability(*features(text, words))
        verdict = "reject" if failed or probability < REJECT else "review" if probability < REVIEW else "keep"
        return (n, words.chars, sum(map(text.count, SYMBOLS)), repeated_lines(text), repeated, failed, probability, verdict, verdict != "reject")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            found = [judged(t.as_py() or "") for t in rows.column("text")]
            if found:
                columns = [pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), list(_KINDS)[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), *columns], schema=_KINDS)

    return own_columns(docs, ["doc_id", "text"]).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, JUDGED)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return judge(docs, fit(docs, read(spark, sf_dir, "labels")))
