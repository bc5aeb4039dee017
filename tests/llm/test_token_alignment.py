import hashlib
from collections import Counter, defaultdict

import pytest
import sentencepiece
from tokenizers import Tokenizer

from laborlake.llm import token_alignment as T

A, B = T.load_byte_bpe(T.BYTE_BPE), T.load_pieces(T.PIECE_BPE)


@pytest.fixture(scope="module")
def coders():
    a = Tokenizer.from_file(T.BYTE_BPE)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=T.PIECE_BPE)


def by_hand(rows, coders):
    """(doc_id, text) rows -> sorted result rows, by comparing all token spans."""
    a, b = coders
    spelt = {i: t for t, i in A.items()}
    found, held = [], Counter()
    for doc_id, text in rows:
        spans, same = [], bool(text)
        if text:
            ids_a = a.encode(" " + text, add_special_tokens=False).ids
            ids_b = b.encode(text)
            pieces = [b.id_to_piece(i) for i in ids_b]
            bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids_b, pieces)]
            for ids, tokens in ((ids_a, [spelt[i] for i in ids_a]), (ids_b, bytes_b)):
                same = same and b"".join(tokens) == (" " + text).encode()
                at, own = 0, []
                for i, token in zip(ids, tokens):
                    own.append((i, at, at + len(token)))
                    at += len(token)
                spans.append(own)
        if not same:
            found.append((doc_id, 0, 0, 0, [], ""))
            continue
        links = []
        start = 0
        for i, x, y in spans[0]:
            while spans[1][start][2] <= x:
                start += 1
            k = start
            while k < len(spans[1]) and spans[1][k][1] < y:
                links.append((i, spans[1][k][0]))
                k += 1
        cuts = sorted({y for _, _, y in spans[0]} & {y for _, _, y in spans[1]})
        groups = []
        ends = [0, *cuts]
        for side in spans:
            k, own = 0, []
            for cut in cuts:
                ids = []
                while k < len(side) and side[k][2] <= cut:
                    ids.append(str(side[k][0]))
                    k += 1
                own.append(",".join(ids))
            groups.append(own)
        assert len(ends) == len(groups[0]) + 1
        line = ";".join(f"{x}|{y}" for x, y in zip(*groups))
        held.update(set(links))
        found.append((doc_id, len(spans[0]), len(spans[1]), len(cuts), links, hashlib.sha256(line.encode()).hexdigest()))
    most = defaultdict(int)
    for (i, _), n in held.items():
        most[i] = max(most[i], n)
    return sorted(((d, na, nb, g, len(links), sum(held[x] == most[x[0]] for x in links), sum(held[x] for x in links), sha)
                   for d, na, nb, g, links, sha in found), key=repr)


def collected(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_query_against_spans(spark, documents, coders):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    assert collected(T.query(spark, "/root/testdata/sf0.001")) == by_hand(rows, coders)


def test_cold_pairs_by_the_shuffle(spark, documents, coders):
    rows = [(r["doc_id"], r["text"]) for r in documents.limit(60).collect()]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for parts in (1, 50):
        assert collected(T.counted(frame, A, B, parts)) == by_hand(rows, coders)


def test_odd_texts(spark, odd, empty, coders):
    texts = ["<|endoftext|> <s> </s> <unk> <0x41>", "  two  spaces  ", "\n\n\t", "▁ mark", "\x00nul\x07", "ﬁ ligature ½", "é é", "日本語のテキスト",
             "\U0001f468‍\U0001f469‍\U0001f467", " ", "a", "<|endoftext|>", "x" * 50_000, "\u0085 　 "]
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()] + [(100 + i, t) for i, t in enumerate(texts)] + [(100, texts[0])]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, TEXT string, row int")
    want = by_hand(rows, coders)
    assert any(r[1] == 0 and r[0] == 103 for r in want)  # the mark itself comes back as a space
    assert collected(T.counted(frame, A, B)) == want
    assert T.counted(empty, A, B).count() == 0


def test_alignments_give_the_tokens_back(spark, documents, coders):
    for r in T.alignments(documents.limit(20), A, B).collect():
        text = documents.where(documents.doc_id == r["doc_id"]).first()["text"]
        assert [i for g in r["a_groups"] for i in g] == coders[0].encode(" " + text, add_special_tokens=False).ids
        assert [i for g in r["b_groups"] for i in g] == coders[1].encode(text)
        assert len(r["a_links"]) == len(r["b_links"])


def test_both_byte_encoders_agree(coders):
    """The rank encoder and the merge-list tokenizer of the same file, around one character of every block of 16."""
    own = T.ByteBpe(A)
    texts = ["a%sb %s 1%s\n%s\t%s%s x%sy's" % ((chr(c),) * 7) for c in range(0, 0x110000, 16) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(texts), 10_000):
        part = texts[at:at + 10_000]
        assert own.encode(part).to_pylist() == [e.ids for e in coders[0].encode_batch([" " + t for t in part], add_special_tokens=False)]
