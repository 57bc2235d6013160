"""Substring dedup by level-wise doubling.

Windows of ``WINDOW`` words that occur elsewhere are found level by level: runs
of 9 words at sampled places, those that repeat extended to 18 around the same
places, windows still in question at full length (two runs of 18 that overlap).
A run that is alone drops its windows; what is left at the last level repeats.
Equality at the last level is that of 96 hash bits over all words, and texts
equal as wholes (96 bits of a digest) count as one: all but one of them stay
out of the levels.

Results: null and empty texts, and those of fewer words, lose nothing.  A text
that occurs again loses all its words if it has a window.  Repeated rows are
documents of their own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strata.llm import common as C
from strata.llm.blocks import Blocks, distinct
from strata.llm.repeats import FULL, MIDDLE, Search, Sizes

WINDOW = 35
NEVER = 1 << 40                       # no key is told to be frequent
WORD_BYTES = 6.0                      # only the number of tasks depends on it


def remove_repeats(df: DataFrame, text: str = "text", window: int = WINDOW, prefix: str = "") -> DataFrame:
    """Every column of ``df``, with ``n_words``, ``n_removed`` and ``kept``: the words left, joined by one space."""
    added = [prefix + c for c in ("n_words", "n_removed", "kept")]
    df = C.without(df, added)
    half = (window + 1) // 2
    sizes = Sizes(window, (half + 1) // 2, half)
    place = df.columns.index(text)

    def view(rows):
        data, offsets = C.flat(rows.column(place))
        words = C.Words(data, offsets)
        return data, offsets, words.hashes(), words.stop, words.doc

    def full_keys(windows):
        h, starts = windows.h, windows.starts()
        if not len(starts):
            return starts, np.zeros(0, np.uint64), np.zeros(0, np.uint32)
        second = C.grams(C.mix(h ^ np.uint64(0xA5A5A5A5A5A5A5A5)), window)[starts]
        return starts, C.grams(h, window)[starts], (second >> np.uint64(32)).astype(np.uint32)

    blocks = Blocks(df, text)
    search = Search(view, sizes)
    search.first_rounds(blocks, WORD_BYTES, NEVER)

    def full(rows, known):
        _, _, _, windows, _ = search.windows(rows, known, MIDDLE)
        return {FULL: distinct(*full_keys(windows)[1:])[:3]}

    blocks.ask(full, int(blocks.n_bytes / WORD_BYTES / 4), NEVER, "full-answers")

    def apply(block, rows, known):
        data, offsets, again, windows, _ = search.windows(rows, known, MIDDLE)
        words = C.Words(data, offsets)
        starts, key, second = full_keys(windows)
        key, _, _, where = distinct(key, second)
        starts = starts[known.bits(FULL, 3, len(key))[0][where]] if len(key) else starts
        change = np.zeros(len(words) + 1, dtype=np.int64)
        np.add.at(change, starts, 1)
        np.subtract.at(change, starts + window, 1)
        gone = np.cumsum(change[:-1]) > 0
        gone |= (again & (words.count >= window))[words.doc]
        total = np.concatenate(([0], np.cumsum(gone)))
        removed = total[words.first[1:]] - total[words.first[:-1]]
        raw, kept = data.tobytes(), []
        for d in range(len(removed)):
            own = slice(words.first[d], words.first[d + 1])
            left = ~gone[own]
            kept.append(b" ".join([raw[a:b] for a, b in zip(words.start[own][left].tolist(), words.end[own][left].tolist())])
                        .decode())
        yield pa.RecordBatch.from_arrays(
            rows.columns + [pa.array(words.count.astype(np.int64)), pa.array(removed.astype(np.int64)), pa.array(kept, pa.string())],
            names=rows.schema.names + added)

    return blocks.each(apply, C.types_of(df) + ", `{}` long, `{}` long, `{}` string".format(*added))
