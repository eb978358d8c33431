"""Quality rules on repetition, by suffix arrays over the words of a text.

The words of a chunk of texts are sorted as suffixes once. The longest-common-prefix
interval of a suffix holds the longest substring that starts there and occurs elsewhere in
the same text; where it is no tail of the one a word earlier, it is a maximal repeated
substring. The union of their spans is the repeated part of a text. Rules limit the
repeated share, in words and in characters, and the longest repeat.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.suffixes import covered, longest_repeats, maximal
from tidemark.llm.words import SPACES, chunks, mix, running_hashes, span_hashes
from tidemark.llm.workers import importable


@dataclass(frozen=True)
class Limits:
    """Bounds of the rules; a text is kept on a bound."""

    #: Words of a repeat that counts.
    least_repeat: int = 5
    least_words: int = 10
    #: Percent of the words, and of their characters, that lie in repeats.
    repeated_words: int = 20
    repeated_chars: int = 25
    #: Words of the longest repeat.
    longest_repeat: int = 50


SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True


@dataclass
class Repeats:
    """Words of a chunk of texts and the repeats among them, one array place per word."""

    data: np.ndarray
    offsets: np.ndarray  # bytes of each text
    starts: np.ndarray  # of each word, bytes
    ends: np.ndarray
    bounds: np.ndarray  # words of each text
    length: np.ndarray  # words of the longest repeat from here on, 0 if too short
    begins: np.ndarray  # first word of the text

    def spans(self) -> tuple[np.ndarray, np.ndarray]:
        """(first word, words) of every occurrence of a maximal repeated substring."""
        at = maximal(self.length, self.begins)
        return at, self.length[at]


def _inner_edges(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of `inside` bytes; texts do not share a run."""
    edge = np.zeros(len(inside) + 1, bool)
    edge[offsets] = True
    before, after = np.zeros(len(inside), bool), np.zeros(len(inside), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    return np.flatnonzero(inside & (~before | edge[:-1])), np.flatnonzero(inside & (~after | edge[1:])) + 1


def repeats_of(data: np.ndarray, offsets: np.ndarray, least: int, sums: np.ndarray | None = None) -> Repeats:
    """Repeats within each text of a chunk. Words are equal if all their bytes are."""
    starts, ends = _inner_edges(~SPACES[data], offsets)
    bounds = np.searchsorted(starts, offsets)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
    sums = running_hashes(data) if sums is None else sums
    codes = mix(span_hashes(sums, starts, ends) + mix(row.astype(np.uint64) + np.uint64(1)))
    length = longest_repeats(codes, bounds[1:][row], least)
    return Repeats(data, offsets, starts, ends, bounds, length, bounds[:-1][row])


def _sums_by(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[bounds[1:]] - total[bounds[:-1]]


def _duplicate_lines(data: np.ndarray, offsets: np.ndarray, word_starts: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Lines with a word that equal an earlier one of their text, per text."""
    rows = len(offsets) - 1
    breaks = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate((offsets[:-1], breaks + 1)))
    # the line of a text that begins after the break that ends another text is that text's own
    row = np.searchsorted(offsets[1:], starts, "right")
    inside = row < rows
    starts, row = starts[inside], row[inside]
    # a break as a text's last byte ends its last line: what follows begins the next text
    starts, place = np.unique(starts, return_index=True)
    row = row[place]
    next_break = np.append(breaks, len(data))[np.searchsorted(breaks, starts)]
    ends = np.minimum(next_break, offsets[1:][row])
    worded = np.searchsorted(word_starts, ends) > np.searchsorted(word_starts, starts)
    starts, ends, row = starts[worded], ends[worded], row[worded]
    keys = mix(span_hashes(sums, starts, ends) + mix(row.astype(np.uint64) + np.uint64(1)))
    _, first = np.unique(keys, return_index=True)
    return np.bincount(row, minlength=rows) - np.bincount(row[first], minlength=rows)


#: Columns that `measured` adds, with their types.
MEASURES = {"n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long", "base_failed": "boolean",
            "kept": "boolean", "n_repeat_chars": "long", "longest_repeat": "long", "n_maximal": "long"}


def _measures(data: np.ndarray, offsets: np.ndarray, limits: Limits) -> dict[str, np.ndarray]:
    sums = running_hashes(data)
    found = repeats_of(data, offsets, limits.least_repeat, sums)
    first, length = found.spans()
    repeated = covered(first, length, len(found.starts))
    points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    chars = points[found.ends] - points[found.starts]
    n_words, word_chars = np.diff(found.bounds), _sums_by(chars, found.bounds)
    n_repeat_words, n_repeat_chars = _sums_by(repeated, found.bounds), _sums_by(chars * repeated, found.bounds)
    longest = np.zeros(len(offsets) - 1, np.int64)
    row = np.searchsorted(found.bounds[1:], first, "right")
    np.maximum.at(longest, row, length)
    base_failed = (n_words < limits.least_words) | (100 * n_repeat_words > limits.repeated_words * n_words)
    kept = ~base_failed & (100 * n_repeat_chars <= limits.repeated_chars * word_chars) & (longest <= limits.longest_repeat)
    return {"n_words": n_words, "word_chars": word_chars, "n_symbols": _sums_by(SYMBOLS[data], offsets),
            "n_dup_lines": _duplicate_lines(data, offsets, found.starts, sums), "n_repeat_words": n_repeat_words, "base_failed": base_failed,
            "kept": kept, "n_repeat_chars": n_repeat_chars, "longest_repeat": longest, "n_maximal": np.bincount(row, minlength=len(longest))}


def measured(docs: DataFrame, text: str = "text", limits: Limits = Limits()) -> DataFrame:
    """Every row of `docs` with the columns of `MEASURES`, which replace columns of the
    same name; other columns stay as they are.

    Words are runs of bytes other than ASCII white space. `n_repeat_words` and
    `n_repeat_chars` are words, and code points of words, in the union of the maximal
    repeated substrings of `limits.least_repeat` words or more; occurrences may overlap, and
    the first one counts. `longest_repeat` is the longest in words, 0 without any,
    `n_maximal` the number of their occurrences. `n_dup_lines` counts lines (cut at \\n)
    with a word that equal an earlier line of the text byte for byte.

    A null or empty text, or one without words, has zeros, fails and is not kept. Whole
    texts are read, of any length: memory is about 120 bytes per byte of the longest text or
    of a megabyte of short ones. Repeated rows and ties give equal rows; an empty table
    gives an empty one.
    """
    importable(docs.sparkSession)
    own = [f for f in docs.schema.fields if f.name not in MEASURES]
    ready = docs.select(*[docs[f"`{f.name}`"] for f in own], docs[f"`{text}`"].cast("string").alias("__text"))
    names = [*[f.name for f in own], *MEASURES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first_row, data, offsets in chunks(batch.column(batch.num_columns - 1)):
                rows = len(offsets) - 1
                found = _measures(data, offsets, limits)
                yield pa.RecordBatch.from_arrays([*[c.slice(first_row, rows) for c in batch.columns[:-1]], *[pa.array(found[m]) for m in MEASURES]], names=names)

    schema = type(docs.schema)([*own])
    for name, kind in MEASURES.items():
        schema = schema.add(name, kind)
    return ready.mapInArrow(run, schema)


def repeated_spans(docs: DataFrame, text: str = "text", least: int = 5) -> DataFrame:
    """(doc_id, first_word, n_words, start, end): every occurrence of a maximal repeated
    substring, in words from 0 and in bytes of the UTF-8 text, end exclusive. Texts without
    a repeat, null and empty ones have no row; rows that repeat a doc_id each have theirs."""
    importable(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first_row, data, offsets in chunks(batch.column(1)):
                found = repeats_of(data, offsets, least)
                at, length = found.spans()
                row = np.searchsorted(found.bounds[1:], at, "right")
                base = offsets[:-1][row]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row + first_row)), pa.array(at - found.begins[at]), pa.array(length),
                     pa.array(found.starts[at] - base), pa.array(found.ends[at + length - 1] - base)], names=["doc_id", "first_word", "n_words", "start", "end"])

    return docs.select(docs["doc_id"].cast("long"), docs[f"`{text}`"].cast("string")).mapInArrow(run, "doc_id long, first_word long, n_words long, start long, end long")


def op11_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repetition in all documents, and the verdict."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return measured(docs).select("doc_id", *MEASURES).drop("n_maximal")


#: A repeat of n words is a run of n - 4 equal 5-word windows at one distance.
SQL = r"""
with docs as (select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
     words as (select r, unnest(ws) as w, unnest(range(len(ws))) as i from (select r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as ws from docs)),
     windows as (select r, i, string_agg(w, ' ') over five as g, count(*) over five as size
                 from words window five as (partition by r order by i rows between current row and 4 following)),
     again as (select r, i, g from windows where size = 5 qualify count(*) over (partition by r, g) > 1),
     placed as (select distinct r, i + o as i from again, (select unnest(range(5)) as o)),
     repeated as (select r, count(*) as n, sum(length(w)) as chars from placed join words using (r, i) group by r),
     pairs as (select a.r, a.i, b.i - a.i as d from again a join again b on a.r = b.r and a.g = b.g and a.i < b.i),
     runs as (select r, count(*) + 4 as n from (select r, d, i - row_number() over (partition by r, d order by i) as island from pairs) group by r, d, island),
     longest as (select r, max(n) as n from runs group by r),
     sizes as (select r, count(*) as n, sum(length(w)) as chars from words group by r),
     lines as (select r, count(*) - count(distinct l) as n from (select r, unnest(string_split(text, chr(10))) as l from docs)
               where regexp_matches(l, '[^\x20\x09-\x0D]') group by r),
     counted as (select doc_id, coalesce(s.n, 0)::bigint as n_words, coalesce(s.chars, 0)::bigint as word_chars,
                        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols, coalesce(l.n, 0)::bigint as n_dup_lines,
                        coalesce(p.n, 0)::bigint as n_repeat_words, coalesce(p.chars, 0)::bigint as n_repeat_chars, coalesce(m.n, 0)::bigint as longest_repeat
                 from docs left join sizes s using (r) left join lines l using (r) left join repeated p using (r) left join longest m using (r))
select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
       not (n_words < 10 or 100 * n_repeat_words > 20 * n_words) and 100 * n_repeat_chars <= 25 * word_chars and longest_repeat <= 50 as kept
from counted
"""
