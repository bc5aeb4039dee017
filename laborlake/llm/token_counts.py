"""Token counts of a unigram vocabulary by a count-only Viterbi.

Aho-Corasick enumerates all vocabulary pieces that end at each character; dynamic
programming carries the best score and the number of tokens of the best path up to
each character, and no path. Tie rule, as in unigram tokenizers: candidates for an end
come by start from left to right and a later one must be strictly better, so of
equal scores the longest last piece stays; a character that is no piece by itself may also
be taken alone at ``least score - 10`` and then counts as its UTF-8 bytes (byte fallback).

Where no piece has the space mark after its first character, every best path breaks
before each space, and likewise around a character that no piece holds; such segments are counted once
per worker and remembered, in a table of bounded size.

Defined cases: a null or empty text has 0 tokens and score 0; other texts get the space
mark in front, and each space becomes one. Ties as above; repeated rows each count. A segment may be the
whole text, of any length. Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laborlake.llm.common import own_columns, read
from laborlake.llm.tasks import ship_by_value

ship_by_value(sys.modules[__name__])

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
PENALTY = 10.0
REMEMBERED = 400_000


def load_pieces(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a SentencePiece file, without its control, unknown and byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]


class UnigramCounter:
    def __init__(self, pieces: list[tuple[str, float]]):
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in pieces) - PENALTY
        known = set("".join(piece for piece, _ in pieces))
        alone = "" if "\n" in known else "\n"
        whole = any(SPACE in piece.lstrip(SPACE) for piece, _ in pieces)
        self.segments = None if whole else re.compile(f"{SPACE}+[^{SPACE}{alone}]*|[^{SPACE}{alone}]+" + f"|[{alone}]" * bool(alone))
        self.known: dict[str, tuple[int, float]] = {}

    def viterbi(self, text: str) -> tuple[int, float]:
        """(tokens, score) of the best path through one segment."""
        ending: list[list[tuple[int, float]]] = [[] for _ in text]
        for end, match in self.automaton.iter(text):
            ending[end].append(match)  # longest first
        scores, tokens = [0.0], [0]
        for i, matches in enumerate(ending):
            best, count, single = None, 0, False
            for length, score in matches:
                score += scores[i + 1 - length]
                if best is None or score > best:
                    best, count = score, tokens[i + 1 - length] + 1
                single = single or length == 1
            if not single and (best is None or scores[i] + self.unknown > best):
                best, count = scores[i] + self.unknown, tokens[i] + len(text[i].encode("utf-8", "surrogatepass"))
            scores.append(best)
            tokens.append(count)
        return tokens[-1], scores[-1]

    def count(self, text: str | None) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        marked = SPACE + text.replace(" ", SPACE)
        if self.segments is None:
            return self.viterbi(marked)
        n, total = 0, 0.0
        if len(self.known) > REMEMBERED:
            self.known.clear()
        for segment, times in Counter(self.segments.findall(marked)).items():
            found = self.known.get(segment)
            if found is None:
                found = self.viterbi(segment)
                if len(segment) < 64:
                    self.known[segment] = found
            n += times * found[0]
            total += times * found[1]
        return n, total


_COUNTERS: dict[int, UnigramCounter] = {}  # one per worker process and vocabulary


def token_counts(docs: DataFrame, pieces: list[tuple[str, float]]) -> DataFrame:
    """(doc_id, n_tokens, score) for every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(pieces)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = hash(tuple(shared.value))
        counter = _COUNTERS.get(key) or _COUNTERS.setdefault(key, UnigramCounter(shared.value))
        for rows in batches:
            found = [counter.count(t.as_py()) for t in rows.column("text")]
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array([n for n, _ in found], pa.int64()),
                 pa.array([s for _, s in found], pa.float64())], ["doc_id", "n_tokens", "score"])

    rows = own_columns(docs, ["doc_id", "text"]).withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.mapInArrow(count, "doc_id long, n_tokens long, score double")


def query(spark: SparkSession, sf_dir: str, path: str = MODEL_PATH) -> DataFrame:
    return token_counts(read(spark, sf_dir, "documents"), load_pieces(path))
