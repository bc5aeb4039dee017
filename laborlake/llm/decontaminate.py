"""Benchmark decontamination by the q-gram lemma over diagonal bands.

Document and passage are normalised alike (lower case; every run of characters that are not letters
or digits becomes one space). A passage of m characters with an edit budget of k
shares at least ``m + 1 - (k + 1) q`` of its q-grams with any region within k edits, on diagonals
(place in the document - place in the passage) that differ by at most k. All q-grams of
a document are hashed, matched against the passages' q-grams, and the shared places of a passage are counted
per band of diagonals; bands are twice as wide as their step, which exceeds k, so each run of
k + 1 diagonals lies within one of them. Bands that reach the bound are verified by an edit-distance
alignment of the whole passage within the band.

Short passages are sought too: from q characters on the same way, where those whose budget is no edit must begin and end at words;
under q characters, where there is no q-gram, as whole words in sequence. So short a passage is found in many
documents, therefore it makes a document leak (``keep_clean``) only if it is that document's whole normalised text.

Documents are never moved: passages go to them in blocks of at most ``block_chars`` characters. The driver holds one block at a
time: of a benchmark with several, each block's matches are written before the next block is read.

Defined cases: a null text counts as empty and matches nothing; a passage without letters or digits matches nothing;
those over ``piece_chars`` are cut into pieces of that length, each sought by itself (a last piece under ``min_chars`` joins
the one before); passages with equal normalised text share their matches; one without an item_id matches under a null one; a benchmark without passages matches nothing. Of overlapping
matches of one passage the one with the least edits, then the first, is reported. Places are code points of the original
text. Only ``doc_id``, ``text`` and ``item_id`` are read; a clashing column beside them does no harm.
"""

from __future__ import annotations

import sys
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from laborlake.llm.common import own_columns, read, staged, unambiguous
from laborlake.llm.tasks import ship_by_value

ship_by_value(sys.modules[__name__])

Q = 10
BUDGET = 0.05  # edits per passage character
MIN_CHARS = 30  # a last piece of a long passage has at least so many characters
PIECE_CHARS = 512
BLOCK_CHARS = 1_000_000
HITS = 2_000_000  # shared q-grams that are counted at once; a text with more is taken in overlapping stretches
FILTER_BITS = 23  # size of the table that most foreign q-grams fail first
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _letter_table() -> np.ndarray:
    """For each code point of the first plane, itself if a letter or digit, else 0."""
    return np.array([c if not 0xD800 <= c < 0xE000 and chr(c).isalnum() else 0 for c in range(0x10000)], np.uint32)


_LETTERS = _letter_table()


def normalise(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Normalised code points, and for each its place in ``text``."""
    lower = text.lower()
    if len(lower) != len(text):  # a character whose lower case is longer: keep places by lowering one by one
        lower = "".join(c.lower()[0] for c in text)
    codes = np.frombuffer(lower.encode("utf-32-le", "surrogatepass"), np.uint32)
    kept = np.where(codes < 0x10000, _LETTERS[np.minimum(codes, 0xFFFF)], codes)
    gap = kept == 0
    use = ~gap
    use[1:] |= use[:-1]  # the first of a run of gaps stands for it
    places = np.flatnonzero(use)
    out = np.where(gap, 32, kept)[places]
    first, last = int(len(out) > 0 and out[0] == 32), int(len(out) > 0 and out[-1] == 32)
    stop = max(first, len(out) - last)
    return out[first:stop], places[first:stop]


def gram_hashes(codes: np.ndarray, q: int) -> np.ndarray:
    """A hash of each q-gram: runs of 1, 2, 4, ... characters are hashed, and joined by the binary digits of q."""
    n = len(codes) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, done = np.zeros(n, np.uint64), 0
    run, size, factor = codes.astype(np.uint64), 1, int(_BASE)
    while True:
        if q & size:
            out *= np.uint64(factor)
            out += run[done:done + n]
            done += size
        if 2 * size > q:
            break
        run = run[:-size] * np.uint64(factor) + run[size:]
        factor, size = factor * factor % (1 << 64), 2 * size
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out


@dataclass
class Passages:
    """A block of passages with its sorted q-gram index."""

    items: list[int | None]
    codes: list[np.ndarray]
    q: int
    budget: float

    def __post_init__(self) -> None:
        short = [i for i, c in enumerate(self.codes) if len(c) < self.q]
        self.words: dict[str, list[int | None]] = {}  # passages without a q-gram, by their text
        for i in short:
            self.words.setdefault(_text(self.codes[i]), []).append(self.items[i])
        self.most_words = max((w.count(" ") + 1 for w in self.words), default=0)
        self.items = [x for x, c in zip(self.items, self.codes, strict=True) if len(c) >= self.q]
        self.codes = [c for c in self.codes if len(c) >= self.q]
        grams = [gram_hashes(c, self.q) for c in self.codes]
        hashes = np.concatenate([np.zeros(0, np.uint64), *grams])
        owner = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([np.zeros(0, np.int64), *[np.arange(len(g)) for g in grams]])
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.owner, self.place = hashes[order], owner[order], place[order]
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[(self.hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
        sizes = np.array([len(c) for c in self.codes], np.int64)
        self.edits = np.floor(self.budget * sizes).astype(np.int64)
        self.least = np.maximum(1, sizes + 1 - (self.edits + 1) * self.q)
        self.step = self.edits + 1

    def matches(self, text: str | None) -> list[tuple[int | None, int, int, int]]:
        """(item, start, end, edits) of the passages found in one text."""
        chosen: dict[int, list[tuple[int, int, int]]] = {}  # per passage, in text order; none overlaps another
        for p, edits, start, end in sorted((p, edits, start, end) for p, start, end, edits in self._verified(text)):
            mine = chosen.setdefault(p, [])
            i = bisect_left(mine, (start,))
            if not (i and mine[i - 1][1] > start or i < len(mine) and mine[i][0] < end):
                mine.insert(i, (start, end, edits))
        hits = [(self.items[p], *hit) for p, mine in chosen.items() for hit in mine]
        hits += self._word_matches(text)
        return sorted(hits, key=lambda h: (h[0] is None, h[0] or 0, *h[1:]))

    def occur_in(self, text: str | None) -> bool:
        """Whether any passage is found; the first one settles it."""
        if self.words and text and _text(normalise(text)[0]) in self.words:
            return True
        return next(self._verified(text), None) is not None

    def _word_matches(self, text: str | None) -> list[tuple[int | None, int, int, int]]:
        """(item, start, end, 0) of the passages under q characters, as whole words; none of a passage's matches overlap."""
        if not self.words or not text:
            return []
        codes, places = normalise(text)
        words = _text(codes).split(" ") if len(codes) else []
        starts = np.cumsum([0, *[len(w) + 1 for w in words]])
        hits, free = [], dict.fromkeys(self.words, 0)
        for i in range(len(words)):
            for n in range(1, min(self.most_words, len(words) - i) + 1):
                run = " ".join(words[i:i + n])
                if len(run) >= self.q:
                    break
                if run in free and free[run] <= i:
                    free[run] = i + n
                    begin, end = int(places[starts[i]]), int(places[starts[i + n] - 2]) + 1
                    hits += [(item, begin, end, 0) for item in self.words[run]]
        return hits

    def _verified(self, text: str | None) -> Iterator[tuple[int, int, int, int]]:
        """(passage, start, end, edits) of every band that holds its passage; bands may overlap."""
        if not text or not len(self.hashes):
            return
        codes, places = normalise(text)
        padded = np.concatenate([[32], codes, [32]])  # place i of the text is i + 1 here

        def at_words(begin: int, end: int) -> bool:
            return padded[begin] == 32 and padded[end + 1] == 32

        grams = gram_hashes(codes, self.q)
        at = np.flatnonzero(self.filter[(grams >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
        if not len(at):
            return
        low = np.searchsorted(self.hashes, grams[at], "left")
        n = np.searchsorted(self.hashes, grams[at], "right") - low
        plain = codes.tobytes()
        span = max(len(c) for c in self.codes) + 2 * int(self.step.max())  # text that one band can touch
        stops = [None] if n.sum() <= HITS else [*range(4 * span, len(grams), 4 * span), None]
        whole: dict[int, tuple[int, int]] = {}  # of a passage, the last match without edits that is reported
        start = None
        for stop in stops:
            near = np.ones(len(at), bool) if start is None else at >= start
            near &= True if stop is None else at < stop + span
            for p, first in self._bands(at[near], low[near], n[near], start, stop):
                if p in whole and whole[p][0] <= first and first + 2 * int(self.step[p]) - 1 < whole[p][1]:
                    continue  # whatever this band holds begins within that match, and would give way to it
                last = first + 2 * int(self.step[p]) - 1
                size = len(self.codes[p])
                if size < 2 * self.q and not self.edits[p]:  # short: at words, and any of the band's places may be one
                    begins = [b for b in every_unchanged(self.codes[p], plain, first, last) if at_words(b, b + size)]
                    yield from ((p, int(places[b]), int(places[b + size - 1]) + 1, 0) for b in begins)
                    continue
                begin = unchanged(self.codes[p], plain, first, last)
                hit = (0, begin, begin + size) if begin is not None else align(self.codes[p], codes, first, last, int(self.edits[p]))
                if hit:
                    edits, begin, end = hit
                    yield p, int(places[begin]), int(places[end - 1]) + 1, edits
                    if not edits and (p not in whole or begin >= whole[p][1]):
                        whole[p] = (begin, end)
            start = stop

    def _bands(self, at: np.ndarray, low: np.ndarray, n: np.ndarray, start: int | None, stop: int | None) -> Iterator[tuple[int, int]]:
        """(passage, first diagonal) of the bands from ``start`` to ``stop`` that reach the lemma's bound."""
        total = int(n.sum())
        if not total:
            return
        entry = np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(total)
        owner, place = self.owner[entry], self.place[entry]
        diagonal = np.repeat(at, n) - place
        band = np.floor_divide(diagonal, self.step[owner])
        # Band b covers the diagonals of steps b and b + 1.
        lowest, bands = int(band.min()) - 1, int(band.max() - band.min()) + 2
        group = owner * bands + band - lowest
        longest = int(self.place.max()) + 1
        shared = np.unique(np.concatenate([group, group - 1]) * longest + np.tile(place, 2)) // longest
        groups, counts = np.unique(shared, return_counts=True)
        for g in groups[counts >= self.least[groups // bands]]:
            p, first = int(g) // bands, (int(g) % bands + lowest) * int(self.step[int(g) // bands])
            if (start is None or first >= start) and (stop is None or first < stop):
                yield p, first


def unchanged(passage: np.ndarray, plain: bytes, first: int, last: int) -> int | None:
    """The first diagonal of ``first`` to ``last`` on which the passage stands without edits; ``plain``: the text's code points."""
    sought, width = passage.tobytes(), passage.itemsize
    low, high = max(0, first) * width, (last + len(passage)) * width
    at = plain.find(sought, low, max(low, high))
    while at % width and at >= 0:
        at = plain.find(sought, at + 1, high)
    return at // width if at >= 0 else None


def every_unchanged(passage: np.ndarray, plain: bytes, first: int, last: int) -> Iterator[int]:
    """All diagonals of ``first`` to ``last`` on which the passage stands without edits."""
    while (found := unchanged(passage, plain, first, last)) is not None:
        yield found
        first = found + 1


def _text(codes: np.ndarray) -> str:
    return codes.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")


def align(passage: np.ndarray, text: np.ndarray, first: int, last: int, budget: int) -> tuple[int, int, int] | None:
    """Least edits of the whole passage against a region of ``text`` on diagonals ``first`` to ``last``: (edits, start, end)."""
    m, width = len(passage), last - first + 1
    far = np.int64(1 << 40)
    offsets = np.arange(width, dtype=np.int64)
    padded = np.full(m + width, 0xFFFFFFFF, np.int64)  # text[first + i] for i in 0 .. m + width - 1
    lo, hi = max(0, first), min(len(text), first + m + width)
    if lo >= hi:
        return None
    padded[lo - first:hi - first] = text[lo:hi]
    # Column d at row i stands for text place first + i + d; cost * 2^20 + the place's start offset, so ties take the left-most start.
    unit = np.int64(1 << 24)
    place = first + offsets
    row = np.where((place >= 0) & (place <= len(text)), offsets, far)
    for i in range(m):
        diagonal = row + unit * (padded[i:i + width] != passage[i])
        above = np.concatenate([row[1:], [far]]) + unit  # the passage character is dropped
        row = np.minimum(diagonal, above)
        row = np.minimum.accumulate(row - unit * offsets) + unit * offsets  # text characters are inserted
        end = first + i + 1 + offsets
        row = np.where((end >= 0) & (end <= len(text)), row, far)
    j = int(np.argmin(row))
    edits = int(row[j] // unit)
    if edits > budget:
        return None
    start, end = first + int(row[j] % unit), first + m + j
    return (edits, start, end) if start < end else None


def _cut(codes: np.ndarray, piece_chars: int, min_chars: int) -> list[np.ndarray]:
    cuts = list(range(0, len(codes), piece_chars))
    if len(cuts) > 1 and len(codes) - cuts[-1] < min_chars:
        cuts.pop()
    return [codes[a:b] for a, b in zip(cuts, [*cuts[1:], len(codes)], strict=True)]


def passage_blocks(benchmark: DataFrame, q: int = Q, budget: float = BUDGET, min_chars: int = MIN_CHARS,
                   piece_chars: int = PIECE_CHARS, block_chars: int = BLOCK_CHARS) -> Iterator[Passages]:
    """The benchmark's passages in blocks of at most ``block_chars`` characters (or one passage)."""
    rows = own_columns(benchmark, ["item_id", "text"]).where("text is not null").select(
        F.col("item_id").cast("long").alias("item_id"), "text").orderBy("item_id", "text")
    items: list[int | None] = []
    codes: list[np.ndarray] = []
    size = 0
    for row in rows.toLocalIterator():
        text, _ = normalise(row["text"])
        if not len(text):
            continue
        if items and size + len(text) > block_chars:
            yield Passages(items, codes, q, budget)
            items, codes, size = [], [], 0
        for piece in _cut(text, piece_chars, min_chars):
            items.append(row["item_id"])
            codes.append(piece)
        size += len(text)
    if items:
        yield Passages(items, codes, q, budget)


def leaks(docs: DataFrame, benchmark: DataFrame, **settings: float) -> DataFrame:
    """(doc_id, item_id, start, end, edits) for every passage found in ``docs``."""
    spark = docs.sparkSession
    rows = own_columns(docs, ["doc_id", "text"]).withColumn("doc_id", F.col("doc_id").cast("long"))
    schema = "doc_id long, item_id long, start int, `end` int, edits int"

    def sought(passages: Passages) -> DataFrame:
        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [(d.as_py(), *hit) for d, t in zip(batch.column("doc_id"), batch.column("text"), strict=True)
                         for hit in passages.matches(t.as_py())]
                columns = list(zip(*found, strict=True)) if found else [()] * 5
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                                 ["doc_id", "item_id", "start", "end", "edits"])

        return rows.mapInArrow(search, schema)

    blocks = passage_blocks(benchmark, **settings)
    block, after = next(blocks, None), next(blocks, None)
    if block is None:
        return spark.createDataFrame([], schema)
    if after is None:
        return sought(block)
    written = []
    while block is not None:
        written.append(staged(sought(block), "leaks"))
        block, after = after, next(blocks, None)
    return reduce(DataFrame.unionByName, written)


def _holds(text: Column, passages: Passages) -> Column:
    @F.pandas_udf("boolean")
    def holds(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([passages.occur_in(t) for t in texts], dtype=bool)

    return holds(text)


def keep_clean(docs: DataFrame, benchmark: DataFrame, **settings: float) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark passage."""
    rows = unambiguous(docs, ["text"])
    blocks = passage_blocks(benchmark, **settings)
    block, after = next(blocks, None), next(blocks, None)
    while block is not None:
        rows = rows.where(~_holds(rows["text"], block))
        block, after = after, next(blocks, None)
        if block is not None:
            rows = staged(rows, "clean")
    return rows.toDF(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
