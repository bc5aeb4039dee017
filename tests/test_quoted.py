import os
import random
import tempfile

import pytest

from laborlake.plans.etl_run import SourceConfig, run_pipeline
from laborlake.sinks.lake import Lake
from laborlake.sources import quoted
from laborlake.sources.files import ingest_csv_file, ingest_folder
from laborlake.sources.quoted import quoted_records, staged_lines, text_lines


@pytest.fixture
def tmp():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture
def small_blocks(spark):
    """Files are cut into blocks of a few hundred bytes."""
    keys = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _records(text):
    """Records of a CSV text, one character at a time."""
    out, now, inside, at_start, i = [], "", False, True, 0
    while i < len(text):
        c = text[i]
        if inside:
            if c == '"' and text[i + 1:i + 2] == '"':
                now, i = now + '""', i + 2
                continue
            now += c
            inside = c != '"'
        elif c == "\n":
            out.append(now)
            now, at_start = "", True
            i += 1
            continue
        else:
            inside = c == '"' and at_start
            at_start = c == ","
            now += c
        i += 1
    return [r for r in out + [now] if r.strip()]


@pytest.mark.parametrize("seed", range(3))
def test_records_of_odd_files_cut_anywhere(spark, tmp, small_blocks, seed):
    rng = random.Random(seed)
    texts = {}
    for k in range(4):
        # plain fields, quoted ones with separators, line ends and doubled quotes, stray quotes, blank lines, a long quoted field
        parts = ["a", "bb", "", '"x,y"', '"one\ntwo"', '"say ""hi"""', '5" pipe', 'a"b"', '""', '"\n\n"', '"p""\n""q"', '"' + "line\n" * 200 + '"']
        weights = [8, 8, 3, 3, 3, 3, 2, 1, 2, 1, 1, 0.3]
        lines = [",".join(rng.choices(parts, weights, k=rng.randrange(1, 5))) for _ in range(400)]
        lines = [x if rng.random() > 0.05 else rng.choice(["", "  ", "\t"]) for x in lines]
        texts[f"f{k}.csv"] = "\n" * rng.randrange(3) + "h1,h2\n" + "\n".join(lines) + "\n" * rng.randrange(2)
        with open(os.path.join(tmp, f"f{k}.csv"), "w") as f:
            f.write(texts[f"f{k}.csv"])
    lines = text_lines(spark, tmp, "*.csv")
    assert lines.select("block").distinct().count() > 10
    rows = quoted_records(staged_lines(lines)).collect()
    for name, text in texts.items():
        own = sorted((r["block"], r["at"], r["value"], r["is_header"]) for r in rows if r["path"].endswith(name))
        want = _records(text)
        assert [v for _, _, v, _ in own] == want
        assert [h for _, _, _, h in own] == [i == 0 for i in range(len(want))]


@pytest.mark.parametrize("bits", [2, 5])
def test_a_block_of_many_lines_is_folded_in_parts(spark, tmp, monkeypatch, bits):
    monkeypatch.setattr(quoted, "_PART_BITS", bits)
    notes = {i: '"' + "line, \"\"so\"\"\n" * (i % 23) + f'{i}"' for i in range(300)}
    text = "id,note\n" + "".join(f"{i},{note}\n" for i, note in notes.items())
    with open(f"{tmp}/one.csv", "w") as f:
        f.write(text)
    lines = staged_lines(text_lines(spark, f"{tmp}/one.csv"))
    states = quoted.part_states(quoted._in_parts(lines))
    assert lines.select("block").distinct().count() == 1
    assert states.count() >= len(text.splitlines()) / 2 ** bits  # no list holds more lines than a part has
    rows = sorted((r["at"], r["value"], r["is_header"]) for r in quoted_records(lines).collect())
    assert [v for _, v, _ in rows] == _records(text)
    assert [h for _, _, h in rows] == [True] + [False] * 300


def test_one_large_file_is_read_by_many_tasks(spark, tmp, small_blocks):
    with open(f"{tmp}/big.csv", "w") as f:
        f.write("id,note\n" + "".join(f'{i},"line one\nline, ""{i}"""\n' for i in range(3000)))
    rows = ingest_csv_file(spark, f"{tmp}/big.csv")
    assert {r.id: r.note for r in rows.collect()} == {i: f'line one\nline, "{i}"' for i in range(3000)}
    assert text_lines(spark, f"{tmp}/big.csv").rdd.getNumPartitions() > 50


def test_blank_lines_before_the_header(spark, tmp):
    for name, text in (("a", "\nid,x\n1,a\n2,b\n"), ("b", "id,x\n3,c\n"), ("c", " \n\t\n\nid,x\n\n4,\"d\nd\"\n"), ("d", "\n \n"), ("e", "")):
        with open(f"{tmp}/{name}.csv", "w") as f:
            f.write(text)
    assert sorted((r.id, r.x, r.source_file) for r in ingest_folder(spark, tmp).collect()) == [
        (1, "a", "a.csv"), (2, "b", "a.csv"), (3, "c", "b.csv"), (4, "d\nd", "c.csv")]
    assert sorted(tuple(r) for r in ingest_csv_file(spark, f"{tmp}/a.csv").collect()) == [(1, "a"), (2, "b")]
    assert ingest_csv_file(spark, f"{tmp}/d.csv").columns == []


def test_header_that_spans_lines(spark, tmp):
    with open(f"{tmp}/x y+z.csv", "w") as f:
        f.write('id,"a\nb"\n1,p\n2,"q\nr"\n')
    with open(f"{tmp}/y.csv", "w") as f:
        f.write("id,c\n3,s\n")
    rows = ingest_folder(spark, tmp)
    assert rows.columns == ["id", "c", "source_file", "a\nb"] or set(rows.columns) == {"id", "c", "source_file", "a\nb"}
    assert sorted((r["id"], r["a\nb"], r["c"], r["source_file"]) for r in rows.collect()) == [
        (1, "p", None, "x y+z.csv"), (2, "q\nr", None, "x y+z.csv"), (3, None, "s", "y.csv")]


def test_broken_bytes_are_marked(spark, tmp):
    with open(f"{tmp}/x.csv", "wb") as f:
        f.write(b'id,x\na\xff,1\na\xfe,2\nok,3\n\xc3\xa9,4\nlong\xff,5,6\n"q\xe9\nr",7\n')
    rows = ingest_csv_file(spark, f"{tmp}/x.csv", flags=True).collect()
    assert sorted((r.id, r.x, r.bad_encoding) for r in rows) == [
        ("a�", 1, True), ("a�", 2, True), ("ok", 3, False), ("q�\nr", 7, True), ("é", 4, False)]


def test_broken_bytes_go_to_quarantine(spark, tmp):
    os.makedirs(f"{tmp}/in")
    with open(f"{tmp}/in/x.csv", "wb") as f:
        f.write(b"content_id,title,category,department,labor_hours,region\n"
                b"k\xff,t,c,D,5,us\nk\xfe,t,c,D,6,us\nk\xef\xbf\xbd,good,c,D,7,us\nm,t\xff,c,D,8,us\n")
    lake = Lake(spark, f"{tmp}/lake")
    out = run_pipeline(spark, "file", lake, SourceConfig(csv_path=f"{tmp}/in"))
    assert [(r.content_id, r.labor_hours) for r in lake.read_layer("silver", "content_events_clean").collect()] == [("k�", 7)]
    bad = lake.read_layer("silver", "content_events_quarantine").collect()
    assert sorted((r.labor_hours, r.violations) for r in bad) == [(5, ["utf8_text"]), (6, ["utf8_text"]), (8, ["utf8_text"])]
    assert out["report"]["duplicate_count"] == 0
    assert lake.read_bronze("content_events").count() == 4
