"""Language identification by a bidirectional gated recurrent network over bytes.

The network gives every byte of a text a probability per language, from what stands
before and after it; the mean over all bytes is the document's. It is trained on the
driver, on a bounded sample of labelled rows, and read by every task. Texts are read
whole, in windows side by side.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.recurrent import LANES, Adam, Bidirectional, gathered, windows_of
from tidemark.llm.samples import least_hashed, window_at
from tidemark.llm.words import chunks
from tidemark.llm.workers import importable

UNKNOWN = "und"
HIDDEN = 8
#: Labelled rows that training sees at most, and characters of the window of each.
TRAINING_ROWS, TRAINING_CHARS = 3000, 1500
STEPS, BATCH, TRAINING_WINDOW, RATE = 450, 256, 48, 0.02
#: Bytes per window when texts are read.
WINDOW = 128
#: A document whose score is below so many times the chance of a guess is in none of the
#: languages, for a filter.
LEAST_SCORE = 1.2


class LanguageModel:
    def __init__(self, languages: list[str], seed: int = 11):
        self.languages = languages
        self.net = Bidirectional(3, HIDDEN, len(languages), seed)

    def train(self, texts: list[bytes], labels: list[int], seed: int = 11) -> "LanguageModel":
        """Windows are drawn with every language equally often; some are cut short."""
        rng = np.random.default_rng(seed)
        by_label = [[t for t, own in zip(texts, labels) if own == k and t] for k in range(len(self.languages))]
        ready = [k for k in range(len(self.languages)) if by_label[k]]
        opt = Adam(self.net.parameters(), RATE)
        for step in range(STEPS if len(ready) > 1 else 0):
            target = rng.choice(ready, BATCH)
            own = [by_label[k][rng.integers(len(by_label[k]))] for k in target]
            data = np.frombuffer(b"".join(own), np.uint8)
            ends = np.cumsum([len(t) for t in own])
            starts = ends - [len(t) for t in own]
            at = starts + (rng.random(BATCH) * np.maximum(1, ends - starts - TRAINING_WINDOW)).astype(np.int64)
            short = rng.random(BATCH) < 0.2
            stops = np.where(short, np.minimum(ends, at + rng.integers(2, TRAINING_WINDOW, BATCH)), ends)
            symbols = gathered(data, at, stops, TRAINING_WINDOW)
            real = (np.arange(TRAINING_WINDOW)[:, None] < (stops - at)[None, :]).astype(np.float32)
            scores, kept = self.net.forward(symbols)
            p = np.exp(scores - scores.max(axis=2, keepdims=True))
            p /= p.sum(axis=2, keepdims=True)
            p[:, np.arange(BATCH), target] -= 1
            opt.step(self.net.backward(kept, p * (real / real.sum())[:, :, None]), 1 - step / STEPS)
        return self

    def positions(self, symbols: np.ndarray) -> np.ndarray:
        """Probabilities (time, windows, languages) of every byte."""
        p = self.net.scores(symbols)
        np.clip(p, -30, 30, out=p)
        np.exp(p, out=p)
        p /= p.sum(axis=2, keepdims=True)
        return p

    def labels(self, text: bytes) -> list[str]:
        """The language of every byte of a text, window by window."""
        data = np.frombuffer(text, np.uint8)
        _, first = windows_of(np.array([len(text)]), WINDOW, WINDOW)
        if not len(first):
            return []
        best = self.positions(gathered(data, first, np.full(len(first), len(text)), WINDOW)).argmax(axis=2).T.ravel()
        return [self.languages[k] for k in best[:len(text)]]

    def pooled(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """(texts, languages): mean probabilities of texts in a buffer; an empty text has zeros."""
        lengths = np.diff(offsets)
        total = np.zeros((len(lengths), len(self.languages)))
        text, first = windows_of(lengths, WINDOW, WINDOW)
        starts, ends = offsets[text] + first, offsets[text + 1]
        for a in range(0, len(text), LANES):
            s, e = starts[a:a + LANES], ends[a:a + LANES]
            size = int(min(WINDOW, (e - s).max()))
            p = self.positions(gathered(data, s, e, size))
            p *= (np.arange(size)[:, None] < (e - s)[None, :])[:, :, None]
            np.add.at(total, text[a:a + LANES], p.sum(axis=0))
        return total / np.maximum(lengths, 1)[:, None]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def trained(rows: DataFrame, limit: int = TRAINING_ROWS) -> LanguageModel | None:
    """A model of `limit` rows of (doc_id, text, lang) at most, chosen by a hash of the id
    and text, and of a window anywhere in each; none without labels. The sample is the
    same on every run."""
    hashed = rows.filter("lang is not null and length(text) > 0").withColumn("h", F.xxhash64("doc_id", "text"))
    known = hashed.select("lang", window_at("text", TRAINING_CHARS, F.xxhash64("h")).alias("text"), "h")
    sample = least_hashed(known, limit, "lang", "text")
    languages = sorted({r.lang for r in sample})
    if not languages:
        return None
    return LanguageModel(languages).train([r.text.encode() for r in sample], [languages.index(r.lang) for r in sample])


def identified(docs: DataFrame, model: LanguageModel | None, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """Every row of `docs` with lang_pred and score, under these or other `names`, which
    replace columns of the same name. Null texts and texts without a letter
    are `und` with score 0, and so is everything without a model. The columns of `docs`
    stay; nothing but the text decides."""
    importable(docs.sparkSession)
    own = [f for f in docs.schema.fields if f.name not in names]
    text = F.col("text").cast("string")
    ready = docs.select(*[F.col(f"`{f.name}`") for f in own], F.when(text.rlike(r"\p{L}"), text).alias("__read"))
    if model is None:
        return ready.drop("__read").withColumn(names[0], F.lit(UNKNOWN)).withColumn(names[1], F.lit(0.0))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_model = sent.value
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            empty = np.asarray(texts.is_null())
            found = [own_model.pooled(data, offsets) for _, data, offsets in chunks(texts)]
            p = np.concatenate(found) if found else np.zeros((0, len(own_model.languages)))
            best = p.argmax(axis=1)
            predicted = [UNKNOWN if e else own_model.languages[k] for e, k in zip(empty.tolist(), best.tolist())]
            score = np.where(empty, 0.0, np.minimum(p[np.arange(len(p)), best], 1.0))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(predicted, pa.string()), pa.array(score, pa.float64())], names=[*batch.schema.names[:-1], *names])

    schema = type(docs.schema)([*own]).add(names[0], "string").add(names[1], "double")
    return ready.mapInArrow(read, schema)


def in_a_language(docs: DataFrame) -> DataFrame:
    """Rows of `docs` (documents) that are in one of the languages learned from those of
    them that are not held out. Rejected are null texts, texts without a letter, and those
    whose best language has a score below LEAST_SCORE times that of a guess; without any
    label all are."""
    model = trained(docs.filter(~held_out(F.col("doc_id"))))
    least = LEAST_SCORE / len(model.languages) if model else 1.0
    names = ("__language", "__language_score")
    return identified(docs, model, names).filter((F.col(names[0]) != UNKNOWN) & (F.col(names[1]) >= least)).drop(*names)


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    model = trained(docs.filter(~held_out(F.col("doc_id"))))
    read = identified(docs.select("doc_id", "text").withColumn("held_out", held_out(F.col("doc_id"))), model)
    return read.select("doc_id", "held_out", "lang_pred", "score")
