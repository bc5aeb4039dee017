"""Repair of conversations by alignment to an alternating grammar.

A conversation is legal when its role initials spell ``(s?(ua)+)?``. Faulty turns (blank, repeated, cut off) and
wrong roles are mended by the cheapest edits: Keep, Rerole, Delete, Insert. The turns are aligned to every
feasible length of the grammar string by the Wagner-Fischer recurrence. All strings share their ends (``...uaua``), so
one table of (turns left, letters left) holds every length; an ``s`` in front is one more column per
length. Only cells within a band are filled, which an incumbent cost allows (Ukkonen): a cell off the diagonal costs at least 2 a
letter too many, 3 a turn too many. The first incumbent is a plain repair (delete, then rerole in place); the band starts
narrow and doubles up to it. From each cheapest length the audit is traced back, and the ASCII-least one wins.

That table grows with the square of a conversation. Conversations of over ``TABLE_ROWS`` turns are aligned by the same recurrence
with its columns folded by the period of the grammar (before the start, after s, after u, after a): the same audit, linear in time.

Turns meet by a shuffle on conv_id and a sort within it, and are read as a stream: a task holds one conversation at a time. The
audit and the digest of a conversation are single sequential values, so one conversation is never split.

Defined cases: a null role or text is one space (an illegal role, a blank turn); null turns come first; turns with equal numbers
are ordered by role and text; rows without a conv_id are one conversation, of a null id; an empty role has no legal
neighbour; a conversation that lost all its rows keeps one row, without an edit; an empty table gives no rows. Only the four columns are read.
"""

from __future__ import annotations

import hashlib
import re
import sys
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laborlake.llm.common import own_columns, read
from laborlake.llm.tasks import ship_by_value

ship_by_value(sys.modules[__name__])

COLUMNS = ["conv_id", "turn", "role", "text"]
KEEP, REROLE, DELETE, INSERT, CUT = 0, 2, 3, 2, 1  # costs; CUT: a truncated turn that stays
TABLE_ROWS = 1000
FAR = 1 << 60
_BLANK = re.compile(r"[\x20\x09-\x0D]*\Z")
_SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
ROLES = {"u": "user", "a": "assistant"}
#: Folded columns 0 to 3 (start, after s, after u, after a): the letter that an insertion or a new role gives, and where it leads.
_NEXT = ("u", "u", "a", "u")
_TO = (2, 2, 3, 2)


# ---- alignment of one conversation -------------------------------------------------------------

def incumbent(initials: str, faults: str) -> int:
    """Cost of a plain repair: bad turns deleted, the others reroled where they stand, one insertion if that leaves an odd number."""
    rest = [(r, f) for r, f in zip(initials, faults, strict=True) if f not in "bd"]
    base = DELETE * (len(initials) - len(rest)) + sum(f == "t" for _, f in rest)
    if not rest:
        return base

    def alternating(letters: list[str]) -> int:
        wrong = sum(r != "ua"[i % 2] for i, r in enumerate(letters))
        return base + REROLE * wrong + INSERT * (len(letters) % 2)

    roles = [r for r, _ in rest]
    costs = [alternating(roles), DELETE * len(initials)]
    if roles[0] == "s" and len(roles) > 1:
        costs.append(alternating(roles[1:]))
    return min(costs)


class _Band:
    """Cells (i, m) of the table: cost of aligning the turns from i on to the last m letters of ``...uaua``."""

    def __init__(self, initials: str, faults: str, limit: int):
        n = self.n = len(initials)
        self.initials, self.faults = initials, faults
        wide, narrow = limit // INSERT, limit // DELETE
        self.low = [max(0, n - i - narrow) for i in range(n + 1)]
        self.rows: list[list[int]] = [[]] * (n + 1)
        self.rows[n] = [INSERT * m for m in range(wide + 1)]
        for i in range(n - 1, -1, -1):
            at, role, fault = self.low[i], initials[i], faults[i]
            below, low = self.rows[i + 1], self.low[i + 1]
            row, left = [], FAR
            for m in range(at, n - i + wide + 1):
                j = m - low
                best = below[j] + DELETE if 0 <= j < len(below) else FAR
                if m and 0 <= j - 1 < len(below) and fault not in "bd":
                    best = min(best, below[j - 1] + (KEEP if role == "au"[m % 2 == 0] else REROLE) + CUT * (fault == "t"))
                left = min(best, left + INSERT)
                row.append(left)
            self.rows[i] = row

    def cost(self, i: int, m: int) -> int:
        j = m - self.low[i]
        return self.rows[i][j] if 0 <= j < len(self.rows[i]) else FAR

    def with_system(self, m: int) -> list[int]:
        """Cost from each turn on for an ``s`` and then m letters; only a kept turn can be that ``s``."""
        out = [FAR] * (self.n + 1)
        for i in range(self.n - 1, -1, -1):
            out[i] = min(FAR, out[i + 1] + DELETE)
            if self.initials[i] == "s" and self.faults[i] not in "bd":
                out[i] = min(out[i], self.cost(i + 1, m) + CUT * (self.faults[i] == "t"))
        return out

    def lengths(self) -> list[int]:
        return list(range(self.low[0] + self.low[0] % 2, self.low[0] + len(self.rows[0]), 2))

    def audit(self, m: int, system: list[int] | None = None) -> str:
        """The ASCII-least cheapest edits to m letters, after an ``s`` if its costs are given."""
        i, edits = 0, []
        while system is not None:
            if system[i] == system[i + 1] + DELETE:
                edits.append("D")
            else:
                edits.append("K")
                system = None
            i += 1
        while i < self.n or m:
            now = self.cost(i, m)
            if i < self.n and now == self.cost(i + 1, m) + DELETE:
                edit = "D"
            elif m and now == self.cost(i, m - 1) + INSERT:
                edit = "I"
            else:
                edit = "K" if self.initials[i] == "au"[m % 2 == 0] else "R"
            edits.append(edit)
            i, m = i + (edit != "I"), m - (edit != "D")
        return "".join(edits)


@lru_cache(maxsize=20_000)
def aligned(initials: str, faults: str) -> tuple[int, str]:
    """(cost, audit) by banded Wagner-Fischer alignment to every feasible length.

    ``initials``: s, u, a or another letter per turn; ``faults``: b(lank), d(uplicate), t(runcated) or ``-`` per turn.
    """
    most = incumbent(initials, faults)
    limit = min(most, 8 + DELETE * sum(f in "bd" for f in faults) + faults.count("t"))
    while True:
        band = _Band(initials, faults, limit)
        found = [(band.cost(0, m), m, None) for m in band.lengths()]
        if "s" in initials:
            starts = [(m, band.with_system(m)) for m in range(2, len(initials) + limit // INSERT + 1, 2)]
            found += [(s[0], m, s) for m, s in starts]
        cost = min((c for c, _, _ in found), default=FAR)
        if cost <= limit:
            return cost, min(band.audit(m, s) for c, m, s in found if c == cost)
        limit = min(most, 2 * limit)


def folded(initials: str, faults: str) -> tuple[int, str]:
    """The same as ``aligned`` with the columns folded by the period of the grammar; for conversations of any length."""
    n = len(initials)
    # Costs from here to the end by column, and the ASCII-least edit that has it; one byte a turn and column is kept.
    value = [0, 2 * INSERT, INSERT, 0]
    choices = bytearray(4 * n)
    for i in range(n - 1, -1, -1):
        role, kind = initials[i], faults[i]
        best = [(v + DELETE, "D") for v in value]
        if kind not in "bd":
            for column in range(4):
                keep = role == _NEXT[column]
                best[column] = min(best[column], (value[_TO[column]] + CUT * (kind == "t") + (KEEP if keep else REROLE), "K" if keep else "R"))
            if role == "s":
                best[0] = min(best[0], (value[1] + CUT * (kind == "t"), "K"))
        # An insertion stays at this turn. Two lead from a user or assistant column back to it, so one step each is enough.
        before = [c for c, _ in best]
        for column in (2, 3):
            best[column] = min(best[column], (before[_TO[column]] + INSERT, "I"))
        for column in (0, 1):
            best[column] = min(best[column], (best[2][0] + INSERT, "I"))
        value = [c for c, _ in best]
        choices[4 * i:4 * i + 4] = "".join(e for _, e in best).encode()
    audit, column, i = [], 0, 0
    while i < n:
        edit = chr(choices[4 * i + column])
        audit.append(edit)
        if edit == "K" and column == 0 and initials[i] == "s":
            column = 1
        elif edit != "D":
            column = _TO[column]
        i += edit != "I"
    while column in (1, 2):
        audit.append("I")
        column = _TO[column]
    return value[0], "".join(audit)


# ---- conversations as streams of turns -----------------------------------------------------------

def fault(role: str, text: str, seen: set[bytes]) -> str:
    """First fault of a turn; notes the turn in ``seen``."""
    tail = text.rstrip(_SPACE)
    head = role.encode("utf-8", "surrogatepass")
    own = hashlib.sha256(b"%d:%b%b" % (len(head), head, text.encode("utf-8", "surrogatepass"))).digest()
    again = own in seen
    seen.add(own)
    return "b" if not tail else "d" if again else "-" if tail[-1] in ".!?" else "t"


EDITS = "conv_id long, at long, edit string, cost int, fault string, turn long, old_role string, role string, text string"
_EDIT_KINDS = pa.schema([("conv_id", pa.int64()), ("at", pa.int64()), ("edit", pa.string()), ("cost", pa.int32()), ("fault", pa.string()),
                         ("turn", pa.int64()), ("old_role", pa.string()), ("role", pa.string()), ("text", pa.string())])


def _edits(conv_id: int | None, turns: list[tuple]) -> Iterator[tuple]:
    """Edit rows of one conversation; ``turns``: (turn, role, text) in order."""
    if not turns:
        yield conv_id, 0, None, 0, None, None, None, None, None
        return
    seen: set[bytes] = set()
    initials = "".join(role[0] if role and role[0] in "sua" else "x" for _, role, _ in turns)
    faults = "".join(fault(role, text, seen) for _, role, text in turns)
    audit = (aligned if len(turns) <= TABLE_ROWS else folded)(initials, faults)[1]
    i, last = 0, ""
    for at, edit in enumerate(audit):
        letter = "a" if last == "u" else "u"
        if edit == "I":
            yield conv_id, at, edit, INSERT, None, None, None, ROLES[letter], ""
            last = letter
            continue
        turn, role, text = turns[i]
        kind = faults[i]
        if edit == "D":
            yield conv_id, at, edit, DELETE, kind, turn, role, None, text
        else:
            letter = initials[i] if edit == "K" else letter
            cost = (KEEP if edit == "K" else REROLE) + CUT * (kind == "t")
            yield conv_id, at, edit, cost, kind, turn, role, role if edit == "K" else ROLES[letter], text
            last = letter
        i += 1


def repaired(turns: DataFrame) -> DataFrame:
    """Edits of every conversation in ``turns`` (conv_id, turn, role, text, lost), in order within a partition.

    One row per edit: ``at`` its place, ``edit`` K, R, D or I, its ``cost``, the turn's first ``fault`` (b, d, t or -), the role
    before and after (null: deleted) and the text. The repaired conversation is the rows that are not deleted. Rows
    with ``lost`` only keep their conversation in the result.
    """
    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, out, size = None, [], [], 0

        def sent() -> pa.RecordBatch:
            columns = zip(*out, strict=True)
            batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _EDIT_KINDS, strict=True)], schema=_EDIT_KINDS)
            out.clear()
            return batch

        for batch in batches:
            for conv_id, turn, role, text, lost in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if now is None or now[0] != conv_id:
                    if now is not None:
                        for row in _edits(now[0], held):
                            out.append(row)
                            size += len(row[8] or "") + 64
                            if size > 4 << 20:
                                yield sent()
                                size = 0
                    now, held = (conv_id,), []
                if not lost:
                    held.append((turn, role, text))
        if now is not None:
            out.extend(_edits(now[0], held))
        if out:
            yield sent()

    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text", "lost")
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    return ordered.mapInArrow(repair, EDITS)


# ---- the registered query --------------------------------------------------------------------------

def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with planted faults, by the CRC-32 of ``conv_id:turn`` modulo 20."""
    rows = own_columns(conversations, COLUMNS)
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(F.encode(key, "UTF-8")) % 20
    role, text = F.coalesce(F.col("role").cast("string"), F.lit(" ")), F.coalesce(F.col("text").cast("string"), F.lit(" "))
    changed = F.when(kind.isin(0, 1), F.lit("")).when(kind == 2, F.translate(text, ".!?", "")).otherwise(text)
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"), changed.alias("text"),
                       (kind == 0).alias("lost"), F.explode(copies).alias("copy")).drop("copy")


DIGESTS = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")
_DIGEST_KINDS = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                           ("audit", pa.string()), ("repaired_sha256", pa.string())])


class _Digest:
    """Counts and digest of one conversation, from its edits in order; holds no text."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.turns, self.distinct = conv_id, None, 0
        self.faults = dict.fromkeys("bdt", 0)
        self.illegal = self.cost = 0
        self.last: str | None = None
        self.audit: list[str] = []
        self.sha, self.any = hashlib.sha256(), False

    def add(self, edit: str | None, cost: int, kind: str | None, turn: int | None, old: str | None, role: str | None, text: str | None) -> None:
        if edit is None:
            return
        self.audit.append(edit)
        self.cost += cost
        if edit != "I":
            if kind in self.faults:
                self.faults[kind] += 1
            if turn is not None:  # they come in order, so a number other than the last is new
                if self.turns is None or self.turns[1] != turn:
                    self.distinct += 1
                self.turns = (turn if self.turns is None else self.turns[0], turn)
            if self.last is not None and self.last + old[:1] not in ("su", "ua", "au"):
                self.illegal += 1
            self.last = old[:1]
        if edit != "D":
            self.sha.update(b"\n" * self.any + f"{role}:{text}".encode("utf-8", "surrogatepass"))
            self.any = True

    def row(self) -> tuple:
        gaps = self.turns[1] - self.turns[0] + 1 - self.distinct if self.turns else 0
        return (self.conv_id, gaps, *[self.faults[f] for f in "bdt"], self.illegal, self.cost, "".join(self.audit), self.sha.hexdigest())


def digests(edits: DataFrame) -> DataFrame:
    """One row per conversation from its edits, as ``repaired`` gives them (whole conversations, in order)."""
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Digest | None = None
        out: list[tuple] = []

        def sent() -> pa.RecordBatch:
            columns = zip(*out, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _DIGEST_KINDS, strict=True)], schema=_DIGEST_KINDS)

        for batch in batches:
            for conv_id, at, *edit in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if at == 0:
                    if now is not None:
                        out.append(now.row())
                    now = _Digest(conv_id)
                now.add(*edit)
            if out:
                yield sent()
                out.clear()
        if now is not None:
            out.append(now.row())
            yield sent()

    return edits.mapInArrow(digest, DIGESTS)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(repaired(damaged(read(spark, sf_dir, "conversations"))))
