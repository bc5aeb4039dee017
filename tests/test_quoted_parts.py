"""Lines travel as parts: a row for many lines, whatever is in them."""

import random
import tempfile

import pytest

from laborlake.sources import quoted
from laborlake.sources.files import kinds_of
from laborlake.sources.quoted import quoted_records, staged_lines, text_lines


@pytest.fixture
def tmp():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def _records(text):
    """Records of a CSV text of bytes, one byte at a time."""
    out, now, inside, at_start, i = [], b"", False, True, 0
    while i < len(text):
        c = text[i:i + 1]
        if inside and text[i:i + 2] == b'""':
            now, i = now + b'""', i + 2
            continue
        if not inside and c == b"\n":
            out.append(now)
            now, at_start = b"", True
        else:
            now += c
            inside = c != b'"' if inside else c == b'"' and at_start
            at_start = not inside and c == b","
        i += 1
    return [r for r in out + [now] if r.strip()]


def test_lines_are_staged_as_parts(spark, tmp):
    with open(f"{tmp}/one.csv", "w") as f:
        f.write("id,note\n" + "".join(f'{i},"{i}\n' + 'a, ""b""\n' * 20 + '"\n' for i in range(2000)))
    lines = staged_lines(text_lines(spark, f"{tmp}/one.csv"))
    assert lines.count() <= 2 + 2000 * 22 // 2 ** quoted._PART_BITS + 44001 // 10_000
    rows = quoted_records(lines)
    assert rows.count() == 2001 and rows.where("is_header").count() == 1
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Generate" in plan and "Python" not in plan  # a record per part and expression, no step per line


def test_file_kinds_do_not_sort_the_lines(spark, tmp):
    for name, text in (("a", 'id,x\n1,"a\nb"\n'), ("b", "\n \nid,x\n1,2\n"), ("c", 'id,"x\ny"\n'), ("d", " \n")):
        with open(f"{tmp}/{name}.csv", "w") as f:
            f.write(text)
    kinds = kinds_of(text_lines(spark, tmp, "*.csv"))
    plan = kinds._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" in plan and "SortAggregate" not in plan
    assert sorted((r.path[-5:], r.header, r.header_open, r.plain) for r in kinds.collect()) == [
        ("a.csv", "id,x", False, False), ("b.csv", "id,x", False, True), ("c.csv", 'id,"x', True, False), ("d.csv", None, None, True)]


@pytest.mark.parametrize("bits", [0, 1, 3])
def test_records_of_broken_bytes_over_short_parts(spark, tmp, monkeypatch, bits):
    monkeypatch.setattr(quoted, "_PART_BITS", bits)
    rng = random.Random(bits)
    parts = [b"a", b"", b'"x,y"', b'"one\ntwo"', b'"say ""hi"""', b'5" pipe', b'""', b'"\n\n"', b'"p""\n""q"', b"\xff", b'"\xe9\n\xc3"', b'"\xc3\n\xa9"', "é".encode(),
             b'"' + b"line\n" * 30 + b'"']
    lines = [b",".join(rng.choices(parts, k=rng.randrange(1, 4))) for _ in range(300)] + [b"", b" \t", b'x,"never closed', b"1", b'2""']
    for name, head in (("a", b"\n \nh1,h2\n"), ("b", b'"h\n1",h2\n'), ("c", b'\n"h1\n')):
        text = head + b"\n".join(rng.sample(lines[:-3], 200) + lines[-5:])
        with open(f"{tmp}/{name}.csv", "wb") as f:
            f.write(text)
        got = quoted_records(staged_lines(text_lines(spark, f"{tmp}/{name}.csv"))).selectExpr("block", "at", "cast(value as binary) as value", "is_header")
        rows = sorted((r["block"], r["at"], bytes(r["value"]), r["is_header"]) for r in got.collect())
        want = _records(text)
        assert [v for _, _, v, _ in rows] == want
        assert [h for _, _, _, h in rows] == [i == 0 for i in range(len(want))]
        assert len({(b, a) for b, a, _, _ in rows}) == len(rows)
