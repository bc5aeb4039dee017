"""HTML text, token counts, decontamination, token output, mixing."""

import html
import re

import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from laborlake.llm import decontaminate, html_text, mixing, token_counts, token_output

PAGES = "/root/testdata/sf0.01/pages.parquet"


def test_articles_of_the_page_table(spark):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(PAGES).collect()}
    got = {r["page_id"]: r["text"] for r in html_text.html_text(spark.read.parquet(PAGES)).collect()}
    for page, source in pages.items():
        inside = re.search(r"<article>(.*?)(</article>|$)", source, re.S).group(1)
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inside)]
        assert got[page] == "\n".join(b for b in blocks if b)


@pytest.mark.parametrize(("source", "text"), [
    (None, ""), ("", ""), ("  ", ""), ("<body><nav>x</nav></body>", ""), ("just text <b>bold", "just text bold"),
    ("<p>a<p>b</artic", "a\nb"), ("x &amp; &#8364;&nbsp; y", "x & € y"), ("<p>open <div>in", "open\nin"),
    ("<article><p>a &lt;b&gt;<br>c</p><p>Te.</p></article>" * 2, "a <b> c\nTe.\na <b> c\nTe."),
    ("<main><h2>T</h2><section><p>long enough text one</p></section><section><p>two</p></section></main><form>f<p>g</form>",
     "T\nlong enough text one\ntwo"),
    ('<body><header><h1>Site</h1></header><div class="menu"><a href=x>Home</a></div><div class="post"><h1>Title</h1><div><p>'
     'The long first paragraph of a story, with <a href=y>one link</a> in it.</p><ul><li>one</li><li>two</li></ul></div></div>'
     '<div class="comments"><p>Nice!</p></div><div id="cookie-notice">We use cookies</div><aside>more</aside></body>',
     "Title\nThe long first paragraph of a story, with one link in it.\none\ntwo"),
])
def test_pages_by_hand(source, text):
    assert html_text.main_text(source) == text


LONG_P = "<p>The first paragraph of the story, long enough to be one.</p>"
LONG_T = "The first paragraph of the story, long enough to be one."


@pytest.mark.parametrize(("source", "text"), [
    (f'<body><div class="content has-sidebar"><article>{LONG_P}</article></div><div class="sidebar"><p>More</p></div></body>', LONG_T),
    (f'<body><div id="sidebar"><nav><a href=x>Home</a></nav><article>{LONG_P}</article><div class="ad">Buy</div></div></body>', LONG_T),
    (f'<body><form action=x><input><div class="menu"><a href=x>Home</a></div><div><h1>Title</h1>{LONG_P}</div>'
     '<div class="site-footer">Imprint</div></form></body>', f"Title\n{LONG_T}"),
    (f'<body><div class="widget">{LONG_P}</div><div class="ad">Buy</div></body>', LONG_T),
    (f'<article><h1>Title</h1>{LONG_P}<section id="discussion"><h2>Discussion</h2><p>What it means.</p></section>'
     '<div class="comments-area"><p>Nice!</p></div></article>', f"Title\n{LONG_T}\nDiscussion\nWhat it means."),
    (f'<body><h1>Title</h1>{LONG_P}<div class="comments"><article>{"<p>A reader says so much more.</p>" * 9}</article></div></body>',
     f"Title\n{LONG_T}"),
    (f'<body><div class="post">{LONG_P}</div><div class="related"><article><p>Read this</p></article></div></body>', LONG_T),
])
def test_article_within_furniture(source, text):
    assert html_text.main_text(source) == text


def _divs(*texts, name="sec"):
    return "".join(f'<div class="{name}">{"".join(f"<p>{t}</p>" for t in group)}</div>' for group in texts)


FOUR = [f"Paragraph {w} of the first section, long enough to be text." for w in ("one", "two", "three", "four")]
SHORT = "Only one short line."


@pytest.mark.parametrize(("source", "text"), [
    (f"<body>{_divs(FOUR, [SHORT], FOUR[:2])}</body>", "\n".join([*FOUR, SHORT, *FOUR[:2]])),
    (f"<body>{_divs(FOUR, ['Ok.'])}</body>", "\n".join([*FOUR, "Ok."])),
    (f"<body><h1>Title</h1>{_divs(FOUR * 3, ['The end.'])}</body>", "\n".join(["Title", *FOUR * 3, "The end."])),
    (f"<article>{LONG_P}<p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> be so.</p></article>", f"{LONG_T}\nLet x=1 be so."),
    (f"<article>{LONG_P}<menu><li>first</li><li>second</li></menu></article>", f"{LONG_T}\nfirst\nsecond"),
    (f'<body>{_divs(FOUR)}<div class="cookiebar"><p>We bake.</p></div></body>', "\n".join(FOUR)),
    (f'<body>{_divs(FOUR)}<ol class="thread"><li>Ann: nice</li><li>Bob: no</li></ol></body>', "\n".join(FOUR)),
    (f'<body>{_divs(FOUR)}<div id="reader-remarks"><p>So true, what a fine story.</p></div></body>', "\n".join(FOUR)),
    (f'<body><menu><li><a href=x>Home</a></li></menu>{_divs(FOUR)}<div><a href=x>Next story</a> <a href=y>More</a></div>'
     "<div>© 2020 The Paper. All rights reserved.</div></body>", "\n".join(FOUR)),
])
def test_short_sections_and_unnamed_furniture(source, text):
    assert html_text.main_text(source) == text


def _densities_by_hand(node, body):
    """Density of a tree of (tag, items) by its definition, counted anew for each node; ``body``: (chars, link chars) of the page."""
    import math

    def size(t):
        return len("".join(t.split()))

    def count(n, linked):
        tag, items = n
        own = [0, 0, 0, 0]
        for x in items:
            if isinstance(x, str):
                own[0] += size(x)
                own[2] += size(x) * linked
            else:
                below = count(x, linked or x[0] == "a")
                own = [a + b for a, b in zip(own, below)]
                own[1] += 1
                own[3] += linked or x[0] == "a"
        return own

    chars, tags, link_chars, link_tags = count(node, node[0] == "a")
    if not chars:
        return 0.0
    base = math.log(chars * link_chars / max(1, chars - link_chars) + body[1] * chars / max(1, body[0]) + math.e)
    ratio = max(1.0, chars / max(1, link_chars) * max(1, tags) / max(1, link_tags))
    return chars / max(1, tags) * (math.log(ratio) / math.log(base) if base > 1 + 1e-9 else 1.0)


@settings(max_examples=60, deadline=None)
@given(st.recursive(st.sampled_from(["one two", "three", "a longer run of text", ""]),
                    lambda kids: st.tuples(st.sampled_from(["div", "p2", "a", "em"]), st.lists(kids, max_size=4)), max_leaves=20))
def test_densities_by_definition(tree):
    def built(n, parent):
        if isinstance(n, str):
            return n
        node = html_text.Node(n[0], {}, parent)
        node.items = [built(x, node) for x in n[1]]
        return node

    def pairs(n, node):
        yield n, node
        for x, y in zip([x for x in n[1] if not isinstance(x, str)], node.children()):
            yield from pairs(x, y)

    def no_nested_links(n, linked=False):
        return isinstance(n, str) or not (linked and n[0] == "a") and all(no_nested_links(x, linked or n[0] == "a") for x in n[1])

    tree = ("body", [tree])
    if not no_nested_links(tree):
        return
    root = built(tree, None)
    html_text._measure(html_text._walk(root), 0.25)
    for n, node in pairs(tree, root):
        assert abs(node.density - _densities_by_hand(n, (4, 1))) < 1e-9


def test_deep_and_long_pages():
    assert html_text.main_text("<div>" * 3000 + "deep text" + "</div>" * 3000) == "deep text"
    assert len(html_text.main_text("<article>" + "<p>word word</p>" * 20_000 + "</article>")) == 20_000 * 10 - 1


def test_odd_pages(spark):
    pages = spark.createDataFrame([(1, None, None, "t"), (1, "u", "<p>x</p>", "t"), (None, "u", "<p>x", None)],
                                  "page_id long, url string, html string, text string")
    assert sorted(html_text.html_text(pages).collect(), key=str) == sorted([(1, None, ""), (1, "u", "x"), (None, "u", "x")], key=str)
    assert html_text.html_text(pages.limit(0)).count() == 0


@pytest.fixture(scope="module")
def pieces():
    return token_counts.load_pieces(token_counts.MODEL_PATH)


def _reference(pieces):
    from tokenizers import Tokenizer, models

    rows = [("<unk>", 0.0), *pieces, *[(f"<0x{b:02X}>", 0.0) for b in range(256)]]
    return Tokenizer(models.Unigram(rows, 0, True))


def test_counts_match_a_unigram_tokenizer(pieces, texts, documents):
    tokenizer = _reference(pieces)
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(documents, pieces).collect()}
    for doc_id, text in texts.items():
        marked = token_counts.SPACE + text.replace(" ", token_counts.SPACE)
        assert got[doc_id] == len(tokenizer.encode(marked).ids)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.text("ab▁", min_size=1, max_size=4), st.integers(-6, 0)), min_size=1, max_size=12, unique_by=lambda p: p[0]),
       st.text("ab c\n", max_size=14))
def test_best_path_by_exhaustion(rows, text):
    """Of all paths, the best score; the tie rule picks the count."""
    counter = token_counts.UnigramCounter([(p, float(s)) for p, s in rows])
    marked = token_counts.SPACE + text.replace(" ", token_counts.SPACE)
    score = dict(rows)
    least = min(score.values()) - 10
    best, count = [0.0], [0]
    for end in range(1, len(marked) + 1):
        options = [(best[a] + score[marked[a:end]], a, count[a] + 1) for a in range(end) if marked[a:end] in score]
        if marked[end - 1] not in score:
            options.append((best[end - 1] + least, end - 1, count[end - 1] + len(marked[end - 1].encode())))
        top = max(s for s, *_ in options)
        best.append(top)
        count.append(next(n for s, _, n in options if s == top))
    assert counter.viterbi(marked) == (count[-1], best[-1])
    assert counter.count(text) == ((count[-1], best[-1]) if text else (0, 0.0))


def test_count_odd_rows(pieces, odd, empty):
    rows = token_counts.token_counts(odd, pieces).collect()
    assert len(rows) == 11 and [r["n_tokens"] for r in rows if r["doc_id"] in (3, 4)] == [0, 0]
    assert len({r["n_tokens"] for r in rows if r["doc_id"] in (1, 2)}) == 1
    assert token_counts.token_counts(empty, pieces).count() == 0


def _edits_by_hand(passage, text):
    """Least edits of the passage against any region of the text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(passage):
        new = [i + 1]
        for j, t in enumerate(text):
            new.append(min(row[j] + (p != t), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def _plain(text):
    return "".join(map(chr, decontaminate.normalise(text)[0]))


@settings(max_examples=80, deadline=None)
@given(st.randoms(use_true_random=False), st.integers(0, 9))
def test_every_region_in_budget_is_found(rng, edits):
    words = ["alpha", "beta", "gamma", "delta", "omega", "sigma", "kappa", "zeta"]
    passage = " ".join(rng.choices(words, k=rng.randint(8, 24)))
    changed = list(passage)
    for _ in range(edits):
        at = rng.randrange(len(changed))
        rng.choice([lambda: changed.pop(at), lambda: changed.insert(at, "x"), lambda: changed.__setitem__(at, "y")])()
    text = " ".join(rng.choices(words, k=10)) + "!! " + "".join(changed).upper() + "\n" + " ".join(rng.choices(words, k=10))
    index = decontaminate.Passages([5], [decontaminate.normalise(passage)[0]], decontaminate.Q, decontaminate.BUDGET)
    least = _edits_by_hand(_plain(passage), _plain(text))
    found = index.matches(text)
    assert bool(found) == (least <= int(decontaminate.BUDGET * len(_plain(passage))))
    if found:
        item, start, end, n = min(found, key=lambda m: m[3])
        assert item == 5 and n == least and _edits_by_hand(_plain(passage), _plain(text[start:end])) == n


def test_leaks_of_the_tables(spark, documents, texts):
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    items = {r["item_id"]: _plain(r["text"]) for r in benchmark.collect()}
    want = {(d, i) for d, t in texts.items() for i, p in items.items() if p in _plain(t)}
    for block in (1_000_000, 500):  # one pass, many passes
        got = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(documents, benchmark, block_chars=block).where("edits = 0").collect()}
        assert got == want and want
    kept = decontaminate.keep_clean(documents, benchmark)
    assert {r["doc_id"] for r in kept.collect()} == set(texts) - {d for d, _ in want}


def test_leak_odd_rows(spark, odd, empty):
    benchmark = spark.createDataFrame([(1, "one fine day the TEXT began; and " + "more words to fill it " * 3), (2, None), (3, ""), (4, "short"),
                                       (5, "the word " * 400)], "item_id long, text string")
    got = decontaminate.leaks(odd, benchmark).collect()
    assert {r["doc_id"] for r in got} == {7, 8} and {r["item_id"] for r in got} == {5}
    assert decontaminate.leaks(odd, benchmark.limit(0)).count() == 0 and decontaminate.leaks(empty, benchmark).count() == 0
    assert decontaminate.keep_clean(odd, benchmark.limit(0)).count() == 11
    assert decontaminate.keep_clean(odd, benchmark).columns == odd.columns


def test_passage_without_an_id():
    codes = [decontaminate.normalise(t)[0] for t in ("a passage that has no number of its own", "another passage, and this one has a number")]
    passages = decontaminate.Passages([None, 3], codes, decontaminate.Q, decontaminate.BUDGET)
    found = passages.matches("First: another passage, and this one has a number. Then a passage that has no number of its own!")
    assert [(i, e) for i, _, _, e in found] == [(3, 0), (None, 0)]


@pytest.mark.parametrize("n", [1, 2, 5, 16, 17, 1000, 4097])
def test_slots_are_a_permutation(n):
    got = token_output.slots(np.arange(n), n)
    assert sorted(got.tolist()) == list(range(n))
    assert n < 100 or got.tolist() != token_output.slots(np.arange(n), n, key=1).tolist()


def test_shards_round_trip(spark, documents, odd, texts, tmp_path):
    ranks = token_output.load_ranks(token_output.VOCABULARY)
    coder = tiktoken.Encoding("own", pat_str=token_output.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = documents.select("doc_id", "text").union(odd.select("doc_id", "text")).repartition(3)
    path = str(tmp_path / "shards")
    listed = {r["slot"]: r for r in token_output.write_shards(docs, ranks, path, length=64, per_shard=100).collect()}
    rows = token_output.read_records(spark, path, 64, 100).collect()
    assert sorted(r["slot"] for r in rows) == list(range(len(listed))) == sorted(listed)
    streams = {r["slot"]: np.frombuffer(bytes(r["record"]), "<u2") for r in rows}
    # Sequences that hold one document only, whole, decode to its text; all tokens together are those of all documents.
    tokens = np.sort(np.concatenate([streams[s][:listed[s]["n_tokens"]] for s in streams]))
    want = [t for r in docs.collect() for t in [*coder.encode_ordinary(r["text"] or ""), len(ranks)]]
    assert tokens.tolist() == sorted(want)
    assert {d for r in listed.values() for d in r["doc_ids"]} == {*texts, *(r["doc_id"] for r in odd.collect())}
    # A later start opens the same records; a file is records of one stride and a closing byte.
    late = {r["slot"]: bytes(r["record"]) for r in token_output.read_records(spark, path, 64, 100, from_slot=150).collect()}
    assert late == {s: streams[s].tobytes() for s in streams if s >= 150}
    file = next((tmp_path / "shards" / "shard=0").glob("part-*"))
    assert file.stat().st_size == 100 * 128 + 1
    at = next(r for r in rows if r["shard"] == 0 and r["byte_offset"] == 128 * 7)
    assert file.read_bytes()[at["byte_offset"]:at["byte_offset"] + 128] == bytes(at["record"])


def test_sequences_keep_the_order_of_a_document(spark, tmp_path):
    ranks = token_output.load_ranks(token_output.VOCABULARY)
    coder = tiktoken.Encoding("own", pat_str=token_output.PATTERN, mergeable_ranks=ranks, special_tokens={})
    text = "some words <|endoftext|> in a row, " * 50
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string").coalesce(1)
    path = str(tmp_path / "one")
    listed = token_output.write_shards(docs, ranks, path, length=32, per_shard=4)
    n = listed.count()
    slots = token_output.slots(np.arange(n), n)
    records = {r["slot"]: np.frombuffer(bytes(r["record"]), "<u2") for r in token_output.read_records(spark, path, 32, 4).collect()}
    stream = np.concatenate([records[s] for s in slots])[:sum(r["n_tokens"] for r in listed.collect())]
    assert stream[-1] == len(ranks) and coder.decode(stream[:-1].tolist()) == text


def test_output_of_an_empty_table(empty):
    assert token_output.ordered_output(empty).count() == 0


def _raked_by_hand(cells, targets, rounds=2000):
    total = sum(cells.values())
    weight = {c: v / total for c, v in cells.items()}
    for _ in range(rounds):
        for i in range(3):
            now = {}
            for c, w in weight.items():
                now[c[i]] = now.get(c[i], 0) + w
            weight = {c: w * targets[i][c[i]] / now[c[i]] for c, w in weight.items()}
    return weight


def test_raking_meets_all_margins():
    rng = np.random.default_rng(1)
    cells = {(s, g, t): int(rng.integers(50, 500)) for s in "abc" for g in "xy" for t in "pq"}
    targets = {"source": {"a": .5, "b": .3, "c": .2}, "lang": {"x": .6, "y": .4}, "topic": {"p": .45, "q": .55}}
    got = mixing.rake(list(cells), np.array(list(cells.values()), float), targets, 0.2)
    want = _raked_by_hand(cells, list(targets.values()))
    assert np.allclose(got, [want[c] for c in cells], atol=1e-7)


def test_mix_of_the_table(documents, texts):
    rows = mixing.mix(documents).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    coder = tiktoken.Encoding("own", pat_str=token_output.PATTERN, mergeable_ranks=token_output.load_ranks(token_output.VOCABULARY), special_tokens={})
    for r in rows:
        assert r["tokens"] == len(coder.encode_ordinary(texts[r["doc_id"]]))
        assert 0 <= r["probability"] <= 1
    held = {}
    for r in rows:
        held[r["source"], r["lang"], r["topic"]] = held.get((r["source"], r["lang"], r["topic"]), 0) + r["tokens"]
    weights = {(r["source"], r["lang"], r["topic"]): (r["weight"], r["probability"]) for r in rows}
    total = sum(held.values())
    for cell, (w, p) in weights.items():
        assert abs(p - min(1.0, w * mixing.BUDGET * total / held[cell])) < 1e-9
    kept = {r["doc_id"] for r in mixing.keep_sampled(documents).collect()}
    assert kept == {r["doc_id"] for r in rows if r["selected"]}
    assert 0.6 < sum(r["tokens"] for r in rows if r["selected"]) / total < 0.95


def test_mix_odd_rows(odd, empty):
    rows = mixing.mix(odd).collect()
    assert len(rows) == 11 and all(r["probability"] is not None for r in rows)
    assert {r["topic"] for r in rows if r["doc_id"] in (3, 4, 5)} == {"empty"}
    assert {r["doc_id"]: r["tokens"] > 0 for r in rows if r["doc_id"] in (3, 4, 5, 6, 9)} == {3: False, 4: False, 5: True, 6: True, 9: True}
    assert mixing.keep_sampled(odd).columns == odd.columns
    assert mixing.mix(empty).count() == 0 and mixing.keep_sampled(empty).count() == 0
    given_shares = {"source": {"a": 1.0}, "lang": 1.0, "topic": 1.0}
    assert all(r["source"] == "a" or not r["tokens"] for r in mixing.mix(odd, given_shares).where("selected").collect())


@pytest.mark.parametrize("table", ["odd", "documents"])
def test_raking_on_spark_equals_raking_on_the_driver(table, request):
    docs = request.getfixturevalue(table)
    targets = {"source": 0.5, "lang": {"en": 0.6, "de": 0.4}, "topic": 0.9}

    def rows(**limit):
        return sorted((str(r["doc_id"]), str(r["source"]), str(r["lang"]), r["topic"], r["selected"], round(r["probability"], 6))
                      for r in mixing.mix(docs, targets, rounds=2, **limit).collect())

    few = rows()
    assert rows(max_cells=2) == few
    kept = mixing.keep_sampled(docs, targets, max_cells=2, rounds=2)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == [r[0] for r in few if r[4]]


def _off_target(rows):
    """The largest distance of a category's share of the expected tokens from the registered target."""
    held, taken = {}, {}
    for r in rows:
        for m, p in mixing.TARGETS.items():
            held.setdefault(m, {}).setdefault(r[m], 0)
            held[m][r[m]] += r["tokens"]
            taken[m, r[m]] = taken.get((m, r[m]), 0) + r["tokens"] * r["probability"]
    whole = sum(r["tokens"] * r["probability"] for r in rows)
    return max(abs(taken[m, k] / whole - v ** mixing.TARGETS[m] / sum(x ** mixing.TARGETS[m] for x in by.values()))
               for m, by in held.items() for k, v in by.items())


@pytest.mark.parametrize("hot", [False, True])
def test_registered_mix_meets_its_targets(documents, hot):
    docs = documents.withColumn("source", F.when(F.col("doc_id") % 3 == 0, "hot").otherwise(F.col("source"))) if hot else documents
    rows = mixing.mix(docs).collect()
    assert _off_target(rows) < 1e-5 and max(r["margin_error"] for r in rows) <= mixing.MET
    (budget,) = {r["budget"] for r in rows}
    total = sum(r["tokens"] for r in rows)
    assert abs(sum(r["tokens"] * r["probability"] for r in rows) / total - budget) < 1e-5
    # No larger one does: a hundredth more leaves a margin open.
    cells = {}
    for r in rows:
        cells[r["source"], r["lang"], r["topic"]] = cells.get((r["source"], r["lang"], r["topic"]), 0) + r["tokens"]
    held = np.array(list(cells.values()), float)
    more = mixing.rake(list(cells), held, mixing.TARGETS, budget + 0.01, rounds=3000)
    assert budget < mixing.BUDGET and mixing.margin_error(mixing.margins_of(list(cells), held, mixing.TARGETS), more) > mixing.MET


def test_raking_several_budgets_on_spark_equals_the_driver(spark):
    """A hot source of few documents in German: the whole budget is out of reach, on Spark as on the driver."""
    sizes = {("hot", "en", "p"): 60, ("hot", "de", "p"): 6, ("b", "en", "p"): 20, ("b", "de", "p"): 14}
    table = spark.createDataFrame([(*c, n, 1) for c, n in sizes.items()], "source string, lang string, topic string, tokens long, n long")
    held = np.array(list(sizes.values()), float)
    margins = mixing.margins_of(list(sizes), held, mixing.TARGETS)
    budgets, rounds = [mixing.BUDGET, 0.5], 3
    found = mixing._attempts(table.coalesce(1), mixing.TARGETS, float(held.sum()), rounds)(budgets)
    assert found[0][0] > 0.02 and found[1][0] < 0.001  # in three rounds
    for (error, _, state), budget in zip(found, budgets, strict=True):
        weight = mixing.rake(list(sizes), held, mixing.TARGETS, budget, rounds)
        assert abs(error - mixing.margin_error(margins, weight)) < 1e-9
        got = {(r["source"], r["lang"], r["topic"]): r["weight"] for r in state.collect()}
        assert np.allclose([got[c] for c in sizes], weight, atol=1e-9)


def test_output_does_not_depend_on_the_split(spark, documents, odd, tmp_path):
    ranks = token_output.load_ranks(token_output.VOCABULARY)
    docs = documents.select("doc_id", "text").union(odd.select("doc_id", "text"))
    docs = docs.union(docs.where("doc_id < 40"))
    seen = []
    for parts in (1, 2, 7):
        path = str(tmp_path / f"split_{parts}")
        listed = token_output.write_shards(docs.repartition(parts), ranks, path, length=64, per_shard=100)
        seen.append((sorted(map(tuple, listed.collect())), sorted(map(tuple, token_output.read_records(spark, path, 64, 100).collect()))))
    assert seen[0] == seen[1] == seen[2]
    tokens = sum(r[1] for r in seen[0][0])
    assert len(seen[0][0]) == len(seen[0][1]) == -(-tokens // 64)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("token_blocks")]


def test_stretches_are_cut_at_sequence_ends():
    start, size = np.array([0, 3, 10, 11]), np.array([3, 7, 1, 30])
    of, sequence, at, tokens, offset = token_output._pieces(start, size, 8)
    got = [[(int(s) * 8 + int(a) + i, int(o) + i) for s, a, t, o in zip(sequence[of == d], at[of == d], tokens[of == d], offset[of == d], strict=True)
            for i in range(t)] for d in range(4)]
    assert got == [[(s + i, i) for i in range(n)] for s, n in zip(start, size, strict=True)]
    assert (at + tokens <= 8).all()


def test_shards_grow_with_the_output():
    assert [token_output.shard_size(n) for n in (0, 10_000, 1 << 24, 1 << 26, 1 << 28, 1 << 40)] == [8192, 8192, 8192, 16384, 65536, 65536]
