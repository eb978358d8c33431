"""Alignment of two tokenizers: segments against whole texts, counts against brute force."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from conftest import DATA
from tidemark.llm import alignment
from tidemark.llm.alignment import PairCoder, Vocabularies, alignments, byte_letters, coalesced, overlaps, texts_aligned

A = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
LETTERS = byte_letters()


def whole(text):
    """(n_a, n_b, n_groups, n_links, sha, links) of a text, from its tokens one by one."""
    if not text:
        return 0, 0, 0, 0, "", []
    e = A.encode(" " + text, add_special_tokens=False)
    a = [(i, len(t)) for i, t in zip(e.ids, e.tokens)]
    b_ids = B.encode(text)
    b_bytes = [bytes([int(B.id_to_piece(i)[3:5], 16)]) if B.is_byte(i) else B.id_to_piece(i).replace("▁", " ").encode() for i in b_ids]
    want = (" " + text).encode()
    if b"".join(b_bytes) != want or bytes(LETTERS[c] for t in e.tokens for c in t) != want:
        return 0, 0, 0, 0, "", []
    spans = lambda ids, sizes: [(i, end - n, end) for i, n, end in zip(ids, sizes, np.cumsum(sizes).tolist())]
    a, b = spans(e.ids, [n for _, n in a]), spans(b_ids, [len(x) for x in b_bytes])
    cuts = sorted({x[2] for x in a} & {x[2] for x in b})
    groups = []
    for lo, hi in zip([0, *cuts], cuts):
        groups.append(",".join(str(i) for i, s, t in a if lo <= s < hi) + "|" + ",".join(str(i) for i, s, t in b if lo <= s < hi))
    links = [(i, j) for i, s, t in a for j, u, v in b if s < v and u < t]
    return len(a), len(b), len(groups), len(links), hashlib.sha256(";".join(groups).encode()).hexdigest(), links


def expected(rows):
    """Multiset of result rows of (doc_id, text) rows."""
    found = [whole(t) for _, t in rows]
    counts = Counter(p for f in found for p in set(f[5]))
    most = defaultdict(int)
    for (i, _), n in counts.items():
        most[i] = max(most[i], n)
    return Counter((d, *f[:4], sum(counts[p] == most[p[0]] for p in f[5]), sum(counts[p] for p in f[5]), f[4]) for (d, _), f in zip(rows, found))


ODD = ["a  b\nc ﬁ é x\n\ny\n z \n w", "  lead", "tail  ", " ", "  ", "\n", "\nx", " \nx", "▁ z", "a▁b c", "a  b", "a  b", "<|endoftext|> <s>x</s><unk> </s>",
       "中文 字符。 日本\n日本", "'s 't don't \r\n x\r y\t z", "🙂🙂 ok‍ 　 x", "a" * 100, "x \x85 y \x1c z", "\x00 a", "if (x) {\r\n  y();\r\n}", "1 2\n3", None, ""]


@given(st.lists(st.sampled_from([" ", "\n", "  ", "a", "the", "é", " ", "7", "'s", "<", ".", "日", "\t", "\r", "▁", " ", "Xy", "\x7f"]), max_size=25).map("".join))
@settings(max_examples=250, deadline=None)
def test_segments_give_the_tokens_of_whole_texts(text):
    n_a, n_b, n_groups, n_links, sha, pairs, times = texts_aligned(CODER, [text.encode()])[0]
    want = whole(text)
    assert (n_a, n_b, n_groups, n_links, sha) == want[:5]
    counts = Counter((i << alignment.B_BITS) + j for i, j in want[5])
    assert dict(zip(pairs.tolist(), times.tolist())) == counts


CODER = PairCoder(Vocabularies.read())


def test_cuts_and_whole_texts_agree(monkeypatch):
    monkeypatch.setattr(alignment, "PIECE", 8)
    monkeypatch.setattr(alignment, "REMEMBERED", 5)
    coder, plain = PairCoder(Vocabularies.read()), PairCoder(Vocabularies.read())
    assert coder.cuts
    plain.cuts = False
    texts = [t.encode() if t is not None else None for t in ODD] * 2
    for x, y in zip(texts_aligned(coder, texts), texts_aligned(plain, texts)):
        assert x[:5] == y[:5] and x[5].tolist() == y[5].tolist() and x[6].tolist() == y[6].tolist()


@given(st.lists(st.integers(1, 5), min_size=1, max_size=20), st.lists(st.integers(1, 5), min_size=1, max_size=20))
@settings(max_examples=100, deadline=None)
def test_groups_and_overlaps(a, b):
    """Also where the two sides do not cover the same bytes."""
    a_end, b_end = np.cumsum(a), np.cumsum(b)
    a_start, b_start = a_end - a, b_end - b
    i, j = overlaps(a_start, a_end, b_start, b_end)
    assert list(zip(i.tolist(), j.tolist())) == [(x, y) for x in range(len(a)) for y in range(len(b)) if a_start[x] < b_end[y] and b_start[y] < a_end[x]]
    g, h = coalesced(a_start, a_end, b_start, b_end)
    assert (g[i] == h[j]).all()
    cuts = set(a_end.tolist()) & set(b_end.tolist())
    assert np.diff(g).tolist() == [int(e in cuts or e >= b_end[-1]) for e in a_end[:-1].tolist()]


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    got = alignment.op12_alignment(spark, DATA).collect()
    assert Counter(map(tuple, got)) == expected([tuple(r) for r in docs])


@pytest.mark.parametrize("sent", [0, 7, 60])
def test_rare_pairs_meet_by_shuffle(spark, sent):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(3, "the rest of the text"), (3, "the rest of the text"), (None, "of the rest"), (9, "the text the text " * 50)]
    docs = spark.createDataFrame([(*r, 0, 1) for r in rows], "doc_id long, text string, n_a int, row int")
    assert Counter(map(tuple, alignments(docs, sent_pairs=sent).collect())) == expected(rows)


def test_empty_table(spark):
    assert alignments(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert [tuple(r) for r in alignments(spark.createDataFrame([(1, None)], "doc_id long, text string")).collect()] == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_long_text(spark):
    text = " ".join(f"word{i % 700} and" for i in range(150_000))
    n_a, n_b, n_groups, n_links, _, pairs, times = texts_aligned(CODER, [text.encode()])[0]
    assert len(text) > 1.5 * alignment.PIECE and n_a == len(A.encode(" " + text, add_special_tokens=False).ids) and n_b == len(B.encode(text))
    assert times.sum() == n_links and len(pairs) < 5000
