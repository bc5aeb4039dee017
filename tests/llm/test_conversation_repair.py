import hashlib
import random
import zlib
from itertools import groupby

import pytest

from laborlake.llm import conversation_repair as C


def by_search(initials, faults):
    """Cheapest legal repair by trying all edits, cheapest and then ASCII-least first; no table."""
    import heapq

    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, audit, i, made = heapq.heappop(heap)
        last = made[-1:]
        if i == len(initials) and last in ("", "a"):
            return cost, audit
        if (i, last) in done:
            continue
        done.add((i, last))
        want = "a" if last == "u" else "u"
        heapq.heappush(heap, (cost + 2, audit + "I", i, made + want))
        if i < len(initials):
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, made))
            if faults[i] not in "bd":
                cut = faults[i] == "t"
                if initials[i] == want or initials[i] == "s" and not made:
                    heapq.heappush(heap, (cost + cut, audit + "K", i + 1, made + initials[i]))
                if initials[i] != want:
                    heapq.heappush(heap, (cost + 2 + cut, audit + "R", i + 1, made + want))


def by_exhaustion(initials, faults):
    """The least (cost, audit) over every edit sequence of bounded length."""
    import re

    found = []

    def go(i, made, cost, audit):
        if cost > 3 * len(initials) + 4:
            return
        if i == len(initials) and re.fullmatch("(s?(ua)+)?", made):
            found.append((cost, audit))
        if not re.fullmatch("(s?(ua)*u?)?", made):
            return
        for letter in "ua":
            go(i, made + letter, cost + 2, audit + "I")
        if i < len(initials):
            go(i + 1, made, cost + 3, audit + "D")
            if faults[i] not in "bd":
                cut = faults[i] == "t"
                go(i + 1, made + initials[i], cost + cut, audit + "K")
                for letter in "ua":
                    go(i + 1, made + letter, cost + 2 + cut, audit + "R")

    go(0, "", 0, "")
    return min(found)


def test_all_short_conversations_by_exhaustion():
    rng = random.Random(1)
    for n in range(4):
        for _ in range(60):
            roles = "".join(rng.choice("suax") for _ in range(n))
            faults = "".join(rng.choice("--bdt") for _ in range(n))
            want = by_exhaustion(roles, faults)
            assert by_search(roles, faults) == C.aligned(roles, faults) == C.folded(roles, faults) == want, (roles, faults)


def test_alignment_against_search():
    rng = random.Random(2)
    for _ in range(1500):
        n = rng.randrange(0, 14)
        roles = "".join(rng.choice(["sua"[min(i, 1) + i % 2], "suax"[rng.randrange(4)]][rng.random() < 0.3]) for i in range(n))
        faults = "".join(rng.choice("------bdt") for _ in range(n))
        assert C.aligned(roles, faults) == C.folded(roles, faults) == by_search(roles, faults), (roles, faults)


@pytest.mark.parametrize("n", [300, 420])
def test_long_conversations_align_as_folded(n):
    rng = random.Random(n)
    roles = "".join("ua"[i % 2] if rng.random() < 0.9 else rng.choice("suax") for i in range(n) if rng.random() > 0.05)
    faults = "".join(rng.choice("---------------bdt") for _ in roles)
    assert C.aligned(roles, faults) == C.folded(roles, faults)


def test_folded_is_linear():
    roles, faults = "ua" * 60_000 + "u", "-" * 120_001
    assert C.folded(roles, faults) == (2, "K" * 120_001 + "I")


def by_hand(rows):
    """The contract on plain Python rows (conv_id, turn, role, text)."""
    kept, ids = {}, {r[0] for r in rows}
    for conv_id, turn, role, text in rows:
        show = [" " if x is None else str(x) for x in (conv_id, turn)]
        kind = zlib.crc32(":".join(show).encode()) % 20
        role, text = [" " if x is None else x for x in (role, text)]
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        kept.setdefault(conv_id, []).extend([(turn, role, text)] * (2 if kind == 3 else 1))
    out = {}
    for conv_id in ids:
        turns = sorted(kept.get(conv_id, []), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        faults, seen = [], set()
        for _, role, text in turns:
            body = text.strip(" \t\n\x0b\x0c\r")
            faults.append("b" if not body else "d" if (role, text) in seen else "-" if body[-1] in ".!?" else "t")
            seen.add((role, text))
        starts = [role[:1] for _, role, _ in turns]
        numbers = {t for t, _, _ in turns if t is not None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        cost, audit = by_search([s if s in "sua" and s else "x" for s in starts], faults)
        lines, i, last = [], 0, ""
        for edit in audit:
            want = {"u": "assistant"}.get(last, "user")
            if edit == "I":
                lines.append(f"{want}:")
                last = want[0]
                continue
            if edit in "KR":
                role = turns[i][1] if edit == "K" else want
                lines.append(f"{role}:{turns[i][2]}")
                last = role[0]
            i += 1
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(starts, starts[1:]))
        out[conv_id] = (gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit,
                        hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def compared(spark, frame):
    got = C.digests(C.repaired(C.damaged(frame))).collect()
    assert len({r["conv_id"] for r in got}) == len(got)
    return {r["conv_id"]: tuple(r)[1:] for r in got}


def test_query_against_plain_python(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").collect()
    got = {r["conv_id"]: tuple(r)[1:] for r in C.query(spark, "/root/testdata/sf0.01").collect()}
    assert got == by_hand([tuple(r) for r in rows])


def test_odd_conversations(spark):
    rng = random.Random(3)
    roles = ["system", "user", "assistant", "tool", None, "", "admin"]
    texts = ["Yes.", "No", None, "", " \t", "Why?", "Yes.", "ünï.", "x" * 70_000]
    rows = [(rng.choice([None, *range(40)]), rng.choice([None, 0, 1, 2, 3, 7, -2]), rng.choice(roles), rng.choice(texts)) for _ in range(400)]
    rows += [(99, i, "ua"[i % 2].replace("u", "user").replace("a", "assistant") if i % 7 else "user", f"Turn {i}.") for i in range(1300)]
    rows += [(100, 0, "user", "Same.")] * 1200
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], "conv_id long, turn long, role string, text string, TURN int, edit int")
    assert compared(spark, frame) == by_hand(rows)


def test_empty_table(spark):
    assert C.digests(C.repaired(C.damaged(spark.createDataFrame([], "conv_id long, turn long, role string, text string")))).count() == 0


def test_edits_give_the_repaired_conversation(spark):
    import re

    rows = C.repaired(C.damaged(spark.read.parquet("/root/testdata/sf0.001/conversations.parquet"))).collect()
    for _, edits in groupby(sorted(rows, key=lambda r: (r["conv_id"], r["at"])), key=lambda r: r["conv_id"]):
        roles = "".join(e["role"][0] for e in edits if e["edit"] is not None and e["role"] is not None)
        assert re.fullmatch("(s?(ua)+)?", roles)
