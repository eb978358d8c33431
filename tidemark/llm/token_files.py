"""Files of token ids.

A file is a row of blocks. A block holds the ids of some documents: a header, the
documents' ids and lengths, the first word of each run, and the Simple-8b words; a line
feed ends it. Documents lie in ascending doc_id over all files.

Words of a text that recur are looked up: the tokenizer splits at white space and
joins nothing across it, so the ids of a text are those of its words one after
another. Every word is encoded by the tokenizers library, once per worker.
"""

from __future__ import annotations

import re
import struct
import sys
import unicodedata
import zlib
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.llm import simple8b
from tidemark.llm.binary_files import read_files, write_records
from tidemark.llm.tables import stored
from tidemark.llm.words import buffers
from tidemark.llm.workers import importable
from tidemark.sources.shared import new_folder

TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "word_bpe_49k.json"
END = 1
MAGIC = b"TIDS8B01"
HEADER = struct.Struct("<8sIIII")
ENDING = "\n"
#: Ids after which a block ends, and blocks per file.
BLOCK_IDS, BLOCKS = 1 << 18, 32
#: Words that a worker remembers; when there are more, it starts anew.
REMEMBERED = 1 << 20

_STOP = re.compile(rb"[.,](?<=[a-z].)(?=[ \n])")


def vocabulary_path(name: str = VOCABULARY, folder: str = TOKENIZERS) -> str:
    """A public vocabulary's path, on the machine that asks."""
    if folder not in sys.path:
        sys.path.append(folder)
    import public_tokenizers

    return public_tokenizers.path(name)


class WordIds:
    """Ids of words, remembered; `encode` gives a word's ids."""

    def __init__(self, encode_many: Callable[[list[str]], list[list[int]]]):
        self.encode_many = encode_many
        self._clear()

    def _clear(self) -> None:
        self.slots: dict[bytes, int] = {}
        self.start, self.length, self.ids, self.used = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64), np.zeros(1 << 18, np.uint32), 0

    def _learn(self, words: list[bytes]) -> None:
        lists = self.encode_many([w.decode("utf-8", "replace") for w in words])
        flat = np.fromiter((x for ids in lists for x in ids), np.uint32)
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        n = len(self.slots)
        while n + len(words) > len(self.start):
            self.start, self.length = np.concatenate((self.start, self.start * 0)), np.concatenate((self.length, self.length * 0))
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate((self.ids, self.ids * 0))
        self.ids[self.used:self.used + len(flat)] = flat
        self.start[n:n + len(words)] = self.used + np.cumsum(sizes) - sizes
        self.length[n:n + len(words)] = sizes
        self.used += len(flat)
        self.slots.update(zip(words, range(n, n + len(words))))

    def of(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, number of ids of each word)."""
        if len(self.slots) > REMEMBERED:
            self._clear()
        slots = np.fromiter(map(self.slots.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(slots < 0)
        if len(new):
            self._learn(list(dict.fromkeys(words[i] for i in new.tolist())))
            slots[new] = [self.slots[words[i]] for i in new.tolist()]
        size = self.length[slots]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        places = np.repeat(self.start[slots] - (ends - size), size) + np.arange(total)
        return self.ids[places], size


def words_of_text(text: bytes) -> list[bytes]:
    """The words of a text whose ids, one after another, are the text's. The vocabulary
    is in lower case, so A-Z are lowered, unless that could make a special token; a full
    stop or comma after a letter is a word of its own."""
    if b"<|" in text:
        return text.split()
    return _STOP.sub(rb" \g<0>", text.lower()).split()


_worker: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    if path not in _worker:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        _worker[path] = WordIds(lambda texts: encode_words(tokenizer, texts))
    return _worker[path]


#: Bytes as the vocabulary's characters: visible ones stand for themselves, the others for 256 and up.
_SEEN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_CHARACTERS = {b: b for b in _SEEN} | {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _SEEN)}


def encode_words(tokenizer, words: list[str]) -> list[list[int]]:
    """Ids of each word. A word of letters that the normalizer leaves as it is, is one
    piece, which goes to the tokenizer's model at once; others take the whole way."""
    out: list = [None] * len(words)
    model, rest = tokenizer.model, []
    for i, w in enumerate(words):
        if w.isascii() and w.isalpha() and w.islower():
            out[i] = [t.id for t in model.tokenize(w)]
        elif w.isalpha() and w == w.lower() and unicodedata.is_normalized("NFC", w):
            out[i] = [t.id for t in model.tokenize(w.encode().decode("latin-1").translate(BYTE_CHARACTERS))]
        else:
            rest.append(i)
    for i, e in zip(rest, tokenizer.encode_batch_fast([words[i] for i in rest], add_special_tokens=False)):
        out[i] = e.ids
    return out


def block_of(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> bytes:
    words, first = simple8b.encode(ids.astype(np.uint64))
    nulls = np.array([d is None for d in doc_ids], np.uint8)
    known = np.array([d or 0 for d in doc_ids], np.int64)
    return b"".join((HEADER.pack(MAGIC, len(doc_ids), len(ids), len(first), len(words)), known.tobytes(), nulls.tobytes(),
                     lengths.astype(np.uint32).tobytes(), first.astype(np.uint32).tobytes(), words.tobytes()))


def blocks_of(content: bytes) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray]]:
    """(doc ids, lengths, ids) of each block of a file."""
    at = 0
    while at < len(content):
        magic, docs, n, runs, words = HEADER.unpack_from(content, at)
        if magic != MAGIC:
            raise ValueError(f"no block of token ids at byte {at}")
        at += HEADER.size
        parts = []
        for kind, count in ((np.int64, docs), (np.uint8, docs), (np.uint32, docs), (np.uint32, runs), (np.uint64, words)):
            parts.append(np.frombuffer(content, kind, count, at))
            at += parts[-1].nbytes
        if content[at:at + 1] != ENDING.encode():
            raise ValueError(f"a block does not end at byte {at}")
        at += 1
        yield [None if null else d for d, null in zip(parts[0].tolist(), parts[1].tolist())], parts[2].astype(np.int64), simple8b.decode(parts[4], parts[3], n)


def write_token_files(docs: DataFrame, folder: str, path: str | None = None, end: int = END) -> None:
    """Writes the ids of every row of (doc_id, text), with `end` after each document, in
    ascending doc_id, nulls first; rows that share an id, or have none, go by a hash of the
    text, so that reruns agree. A null text is an empty one; it has the end only."""
    importable(docs.sparkSession)
    path = path or vocabulary_path()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = word_ids(path)
        held_docs: list[int | None] = []
        held: list[np.ndarray] = []
        total = 0

        def flush() -> pa.RecordBatch:
            nonlocal total
            out = block_of(held_docs, np.array([len(x) for x in held]), np.concatenate(held))
            held_docs.clear()
            held.clear()
            total = 0
            return pa.RecordBatch.from_arrays([pa.array([out], pa.binary())], names=["block"])

        def add(doc_ids: list[int | None], texts: list[list[bytes]]) -> None:
            nonlocal total
            ids, sizes = coder.of([w for t in texts for w in t])
            ends = np.concatenate(([0], np.cumsum(sizes)))[np.cumsum([0] + [len(t) for t in texts])]
            for d, a, b in zip(doc_ids, ends[:-1].tolist(), ends[1:].tolist()):
                held_docs.append(d)
                held.append(np.append(ids[a:b], np.uint32(end)))
                total += b - a + 1

        for batch in batches:
            data, offsets = buffers(batch.column("text"))
            bounds, doc_ids = offsets.tolist(), batch.column("doc_id").to_pylist()
            pending: list[list[bytes]] = []
            first = 0
            for i in range(len(doc_ids)):
                pending.append(words_of_text(data[bounds[i]:bounds[i + 1]].tobytes()))
                if bounds[i + 1] - bounds[first] > 1 << 19 or i + 1 == len(doc_ids):
                    add(doc_ids[first:i + 1], pending)
                    pending, first = [], i + 1
                    if total >= BLOCK_IDS:
                        yield flush()
        if held:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # equal and missing ids go by the text, and need not share a partition
    digest = F.xxhash64("text")
    ordered = rows.repartitionByRange(F.asc("doc_id"), digest).sortWithinPartitions(F.asc("doc_id"), digest, F.asc("text"))
    write_records(ordered.mapInArrow(encode, "block binary"), "block", folder, ENDING, per_file=BLOCKS)


def read_token_files(spark: SparkSession, folder: str, ids: bool = True) -> DataFrame:
    """(part, chunk, place, doc_id, before, n_tokens, ids_crc32[, ids]) of every document
    of the files, in their order; `before` counts the ids before it in its file."""
    importable(spark)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, chunk, content in zip(batch.column("part").to_pylist(), batch.column("chunk").to_pylist(), batch.column("content")):
                place, before = 0, 0
                for docs, lengths, values in blocks_of(content.as_buffer().to_pybytes()):
                    ends = np.cumsum(lengths)
                    raw = values.astype("<u4").tobytes()
                    bounds = np.concatenate(([0], ends)).tolist()
                    n = len(docs)
                    cols = [pa.array([part] * n, pa.int64()), pa.array([chunk] * n, pa.int64()), pa.array(range(place, place + n), pa.int64()), pa.array(docs, pa.int64()),
                            pa.array(before + ends - lengths, pa.int64()), pa.array(lengths, pa.int64()),
                            pa.array([zlib.crc32(memoryview(raw)[4 * a:4 * b]) for a, b in zip(bounds[:-1], bounds[1:])], pa.int64())]
                    if ids:
                        cols.append(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values.astype(np.int64))))
                    place, before = place + n, before + (bounds[-1] if n else 0)
                    yield pa.RecordBatch.from_arrays(cols, names=["part", "chunk", "place", "doc_id", "before", "n_tokens", "ids_crc32"] + ["ids"] * ids)

    schema = "part long, chunk long, place long, doc_id long, before long, n_tokens long, ids_crc32 long" + ", ids array<long>" * ids
    return read_files(spark.read, folder).mapInArrow(decode, schema)


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as read back from files of the ids of all documents."""
    folder = new_folder(spark, "token-files")
    write_token_files(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), f"{folder}/files")
    rows = stored(read_token_files(spark, f"{folder}/files", ids=False), f"{folder}/read")
    # one row per file
    files = rows.groupBy("part", "chunk").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("part", "chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("part", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("ids_before"))
    return rows.join(starts, ["part", "chunk"]).select("doc_id", (F.col("ids_before") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
