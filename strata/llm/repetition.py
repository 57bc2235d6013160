"""Quality rules by repetition coverage.

Rolling hashes of runs of 3, 5, 7 and 10 words are computed in numpy over a
whole slice of documents.  For each length the characters of words inside a
run that stands twice or more in its document are counted (once each); so are
the characters of lines that repeat an earlier line.  Shares of these in the
document's word characters, and symbols per word, decide the verdict.

Results: a null or empty text has no words and fails the base rule; repeated
rows each give their own row; a null id stays null.  Texts are judged whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import common as C

RUNS = (3, 5, 7, 10)
# Largest shares (percent of word characters) inside repeated runs of so many words, and repeated lines: the limits
# of Rae et al. 2021 (Gopher, MassiveText, table A1) for duplicate n-grams and the character share of duplicate lines.
# They name none for repeated runs of three; those are limited by the base rule.
MOST_SHARE = {5: 15, 7: 13, 10: 10}
MOST_LINES = 20
# Symbols per 100 words.
MOST_SYMBOLS = 20

SYMBOL = np.zeros(256, dtype=bool)
SYMBOL[list(b"#*$%&|<>")] = True

COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
           "dup_line_chars", *(f"dup_chars_{n}" for n in RUNS)]


def _again(doc: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Which entries' (doc, key) stands at least twice."""
    if not len(key):
        return np.zeros(0, dtype=bool)
    own = C.mix(key ^ (doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    ordered = np.sort(own)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return np.zeros(len(key), dtype=bool)
    at = np.minimum(np.searchsorted(twice, own), len(twice) - 1)
    return twice[at] == own


def _cover(starts: np.ndarray, n: int, size: int) -> np.ndarray:
    """Marks the places s .. s+n-1 of each start."""
    change = np.zeros(size + 1, dtype=np.int64)
    change[starts] += 1
    np.subtract.at(change, starts + n, 1)
    return np.cumsum(change[:-1]) > 0


def measure(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The measures of each document of a flat buffer."""
    docs = len(offsets) - 1
    words = C.Words(data, offsets)
    h = words.hashes()
    # a code point starts at every byte that is not a continuation byte
    points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    chars = points[words.end] - points[words.start]

    def by_doc(values: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(values)))
        return total[words.first[1:]] - total[words.first[:-1]]

    out = {"n_words": words.count.astype(np.int64), "word_chars": by_doc(chars)}
    symbols = np.concatenate(([0], np.cumsum(SYMBOL[data])))
    out["n_symbols"] = symbols[offsets[1:]] - symbols[offsets[:-1]]
    for n in RUNS:
        starts = np.flatnonzero(C.window_starts(words, n))
        key = C.grams(h, n)[starts] if len(starts) else np.zeros(0, np.uint64)
        inside = _cover(starts[_again(words.doc[starts], key)], n, len(words))
        if n == 3:
            out["n_repeat_words"] = by_doc(inside)
        out[f"dup_chars_{n}"] = by_doc(np.where(inside, chars, 0))
    out["n_dup_lines"], out["dup_line_chars"] = _lines(data, offsets, words, chars)
    assert all(len(v) == docs for v in out.values())
    return {c: out[c] for c in COLUMNS}


def _lines(data, offsets, words, chars):
    """Per document: lines with a word equal to an earlier line of it, and the word characters in them."""
    docs = len(offsets) - 1
    # a line is a span between \n or document ends; lines are hashed whole, spaces included
    newline = np.flatnonzero(data == 0x0A)
    line_start = np.unique(np.concatenate((offsets[:-1], newline + 1)))
    line_start = line_start[line_start < len(data)]
    if not len(line_start) or not len(words):
        return np.zeros(docs, np.int64), np.zeros(docs, np.int64)
    line_end = np.concatenate((line_start[1:], [len(data)]))
    line_end = np.where(data[line_end - 1] == 0x0A, line_end - 1, line_end)
    line_of_word = np.searchsorted(line_start, words.start, side="right") - 1
    used, first_word, n_words = np.unique(line_of_word, return_index=True, return_counts=True)
    start, end = line_start[used], line_end[used]
    key = np.empty(len(used), dtype=np.uint64)
    at = 0
    while at < len(used):
        to = max(at + 1, int(np.searchsorted(end, start[at] + (4 << 20))))
        key[at:to] = C._hash_spans(data, start[at:to], end[at:to])
        at = to
    doc = words.doc[first_word]
    own = C.mix(key ^ (doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    _, first = np.unique(own, return_index=True)
    later = np.ones(len(own), dtype=bool)
    later[first] = False
    total = np.concatenate(([0], np.cumsum(chars)))
    in_line = total[first_word + n_words] - total[first_word]
    return (np.bincount(doc[later], minlength=docs).astype(np.int64),
            np.bincount(doc[later], weights=in_line[later], minlength=docs).astype(np.int64))


def measure_repetition(df: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """Every column of ``df`` with the measures (``COLUMNS``, their names after ``prefix``) added."""
    names = [prefix + c for c in COLUMNS]
    df = C.without(df, names)
    schema = ", ".join([C.types_of(df)] + [f"`{n}` long" for n in names])
    place = df.columns.index(text)

    def run(batches):
        for batch in batches:
            for part in C.slices([batch], batch.schema.names[place]):
                found = measure(*C.flat(part.column(place)))
                yield pa.RecordBatch.from_arrays(
                    part.columns + [pa.array(v, type=pa.int64()) for v in found.values()],
                    names=part.schema.names + names)

    return df.mapInArrow(run, schema)


def base_failed(prefix: str = ""):
    """Fewer than 50 words, or more than half of the words in repeated runs of three."""
    c = lambda name: F.col(prefix + name)
    return (c("n_words") < 50) | (100 * c("n_repeat_words") > 50 * c("n_words"))


def method_failed(prefix: str = ""):
    c = lambda name: F.col(prefix + name)
    failed = (100 * c("dup_line_chars") > MOST_LINES * c("word_chars")) \
        | (100 * c("n_symbols") > MOST_SYMBOLS * c("n_words"))
    for n, most in MOST_SHARE.items():
        failed = failed | (100 * c(f"dup_chars_{n}") > most * c("word_chars"))
    return failed
