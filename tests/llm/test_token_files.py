"""Files of token ids: round trips, and ids equal to those of whole texts."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from conftest import DATA
from tidemark.llm import simple8b, token_files
from tidemark.sources.shared import new_folder


@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 50000), st.integers(0, 2 ** 64 - 1)), max_size=3000))
@settings(max_examples=60, deadline=None)
def test_simple8b_round_trip(values):
    v = np.array(values, np.uint64)
    words, first = simple8b.encode(v)
    assert (simple8b.decode(words, first, len(v)) == v).all()


def test_simple8b_packs_small_values():
    words, _ = simple8b.encode(np.ones(1024, np.uint64))
    assert len(words) == 18


TEXTS = ["Hello, World. It's 3.14 e.g. a.b, c", "", None, "É à la Carte. ÀÉ ẞ ß İstanbul ΣΑΣ.", "<|endoftext|> <|ENDOFTEXT|> a<|startoftext|>b", "x\x1cy z q\x0bw", "é e ́ KK ﬁ",
         "中文 字符。 日本", "a" * 3000, "... !!! --- 's 't don't DON'T we'll", "²½Ⅷ _under_ 10,000.50", "word. word, word.\nword.\tword", "🙂🙂 ok‍"]


def test_words_give_the_ids_of_whole_texts():
    path = token_files.vocabulary_path()
    whole = Tokenizer.from_file(path)
    coder = token_files.word_ids(path)
    for t in TEXTS:
        words = token_files.words_of_text((t or "").encode())
        ids, sizes = coder.of(words)
        assert ids.tolist() == whole.encode(t or "", add_special_tokens=False).ids, t
        assert sizes.sum() == len(ids)


def test_worker_forgets_and_learns_again(monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED", 3)
    coder = token_files.WordIds(lambda words: [[len(w)] * 2 for w in words])
    for words in ([b"a", b"bb", b"a"], [b"cccc", b"dd", b"eee"], [b"a", b"bb"]):
        assert coder.of(words)[0].tolist() == [x for w in words for x in (len(w), len(w))]


def expected(rows):
    whole, start, out = Tokenizer.from_file(token_files.vocabulary_path()), 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array(whole.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_query_equals_whole_texts(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    got = token_files.op1_token_files(spark, DATA).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == expected([(r.doc_id, r.text) for r in docs.collect()])


def test_files_hold_odd_rows(spark):
    rows = [(i * 7 % 13, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (5, "again"), (5, "again")]
    folder = new_folder(spark, "ids")
    token_files.write_token_files(spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, block int"), folder)
    got = token_files.read_token_files(spark, folder).orderBy("part", "chunk", "place").collect()
    assert [r.doc_id for r in got] == sorted([r[0] for r in rows], key=lambda d: (d is not None, d or 0))
    assert all(r.ids[-1] == 1 and len(r.ids) == r.n_tokens for r in got)


def test_empty_table(spark):
    folder = new_folder(spark, "ids")
    token_files.write_token_files(spark.createDataFrame([], "doc_id long, text string"), folder)
    assert token_files.read_token_files(spark, folder).count() == 0


def test_broken_file_is_an_error():
    with pytest.raises(ValueError):
        list(token_files.blocks_of(b"x" * 64))


def test_tied_ids_have_one_order(spark):
    """Whatever partitions the rows come in, and though most share an id or have none."""
    rows = [(None if i % 3 else 4, f"text {i} of many" * (i % 5)) for i in range(400)] + [(9, "last")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    seen = []
    for parts in (1, 7):
        folder = new_folder(spark, "ids")
        token_files.write_token_files(docs.orderBy("text" if parts == 1 else "doc_id").repartition(parts), folder)
        got = token_files.read_token_files(spark, folder, ids=False).orderBy("part", "chunk", "place").collect()
        seen.append([(r.doc_id, r.n_tokens, r.ids_crc32) for r in got])
    assert seen[0] == seen[1] and [d for d, _, _ in seen[0]] == sorted([d for d, _ in rows], key=lambda d: (d is not None, d or 0))
