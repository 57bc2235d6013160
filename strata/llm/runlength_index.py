"""Repeated bytes by a run-length index: a run-compressed Burrows-Wheeler transform with sampled run ends.

Which byte windows may repeat is found by questions about runs of 50 and 100
bytes around sampled places (``repeats``).  What is left of a document goes, as
fragments of a few hundred bytes, to the bucket of its 100-byte run.  There the
distinct fragments are indexed:

* their suffixes are sorted by doubling, which gives the transform;
* only the ends of its runs are sampled: the text positions there, and the length
  that neighbours across a run's end have in common.  Inside a run neighbours
  are preceded by the same byte, so their common length is one less than that of
  the positions before them and needs no sample;
* streaming over the text in order, the furthest that any sample at or before a
  position reaches is the matching statistic of that position: the longest
  match that its suffix has anywhere else;
* windows no longer than that occur elsewhere.

A 100-byte run that occurs more than ``FREQUENT`` times would make one bucket
too large; its windows are asked about one by one instead (96 hash bits over
all their bytes), with the same result.

Results: null and empty texts lose nothing.  A text that occurs again loses all
its bytes if it has a window; of such texts one is searched for parts that occur
in others.  Repeated rows are documents of their own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strata.llm import common as C
from strata.llm.blocks import ANSWER, Blocks, distinct
from strata.llm.repeats import FULL, MIDDLE, PART, Search, Sizes

WINDOW = 200
FREQUENT = 3000
BUCKET_BYTES = 600_000
SYMBOLS = 7                            # of nine bits each, in the first sort key


# ------------------------------------------------------------------ the index

class RunLengthIndex:
    """Index of short byte strings; ``repeats(window)`` marks the windows that occur at least twice in them."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        n = len(data)
        self.data, self.offsets = data, offsets
        self.end = np.repeat(offsets[1:], np.diff(offsets))
        self.ranks: list[tuple[int, np.ndarray]] = []
        order = self._sort(n)
        # the byte before each suffix; where a string begins, one that equals no other
        before = np.empty(n, dtype=np.int64)
        before[1:] = data[:-1]
        before[offsets[:-1][np.diff(offsets) > 0]] = -1
        last = before[order]
        run = np.flatnonzero((last[1:] != last[:-1]) | (last[1:] < 0))
        #: sampled run ends: the positions on both sides, and how much they have in common
        self.above, self.below = order[run], order[run + 1]
        self.common = self._common(self.above, self.below)

    def _sort(self, n: int) -> np.ndarray:
        """The suffixes in order (each ends with its string; equal ones by position)."""
        at = np.arange(n, dtype=np.int64)
        left = self.end - at
        key = np.zeros(n, dtype=np.uint64)
        padded = np.concatenate((self.data, np.zeros(SYMBOLS, np.uint8))).astype(np.uint64) + np.uint64(1)
        for i in range(SYMBOLS):
            key = (key << np.uint64(9)) | np.where(left > i, padded[i:i + n], np.uint64(0))
        order = np.argsort(key, kind="stable")
        rank = self._dense(order, key)
        length = SYMBOLS
        self.ranks.append((length, rank))
        longest = int(left.max()) if n else 0
        while length < longest:
            follow = np.zeros(n, dtype=np.int64)
            inside = left > length
            follow[inside] = rank[at[inside] + length] + 1
            if n < 1 << 21:
                packed = (rank.astype(np.uint64) << np.uint64(42)) | (follow.astype(np.uint64) << np.uint64(21)) \
                    | at.astype(np.uint64)
                packed.sort()
                order = (packed & np.uint64((1 << 21) - 1)).astype(np.int64)
                both = packed >> np.uint64(21)
                new = np.concatenate(([0], both[1:] != both[:-1]))
                rank = np.empty(n, dtype=np.int64)
                rank[order] = np.cumsum(new)
            else:
                order = np.lexsort((follow, rank))
                new = np.concatenate(([0], (rank[order][1:] != rank[order][:-1]) | (follow[order][1:] != follow[order][:-1])))
                rank = np.empty(n, dtype=np.int64)
                rank[order] = np.cumsum(new)
            length *= 2
            if length < longest:
                self.ranks.append((length, rank))
        return order

    @staticmethod
    def _dense(order: np.ndarray, key: np.ndarray) -> np.ndarray:
        rank = np.empty(len(key), dtype=np.int64)
        ordered = key[order]
        rank[order] = np.cumsum(np.concatenate(([0], ordered[1:] != ordered[:-1]))) if len(key) else 0
        return rank

    def _common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many bytes the suffixes at ``a`` and ``b`` have in common, by ranks of halving lengths."""
        most = np.minimum(self.end[a] - a, self.end[b] - b)
        length = np.zeros(len(a), dtype=np.int64)
        for step, rank in reversed(self.ranks):
            # a rank equal for ``step`` bytes says so for all of them only where both strings go on that far
            on = length + step <= most
            x, y = np.where(on, a + length, 0), np.where(on, b + length, 0)
            length += np.where(on & (rank[x] == rank[y]), step, 0)
        for _ in range(SYMBOLS - 1):
            on = length < most
            x, y = np.where(on, a + length, 0), np.where(on, b + length, 0)
            on &= self.data[x] == self.data[y]
            length += on
        return length

    def statistics(self) -> np.ndarray:
        """For each position the length of the longest match that its suffix has anywhere else."""
        n = len(self.data)
        reach = np.zeros(n, dtype=np.int64)
        np.maximum.at(reach, self.above, self.above + self.common)
        np.maximum.at(reach, self.below, self.below + self.common)
        return np.maximum(np.maximum.accumulate(reach) - np.arange(n), 0) if n else reach

    def repeats(self, window: int) -> np.ndarray:
        return self.statistics() >= window


# ------------------------------------------------------------------ documents

def _fragments(data: np.ndarray, windows, window: int):
    """(key, text, how often) of the different fragments, ordered by key, and each range's place among them.

    A fragment is the text of a range of windows; its key is that of the middle run that they share.
    """
    keys, place = windows.keys(windows.sizes.middle)
    key = keys[place] if len(place) else np.zeros(0, np.uint64)
    raw = data.tobytes()
    index: dict[bytes, int] = {}
    lead: list[int] = []
    number = np.empty(len(key), dtype=np.int64)
    order = np.argsort(key, kind="stable")
    for i in order.tolist():
        n = index.setdefault(raw[windows.lo[i]:windows.hi[i] - 1 + window], len(index))
        if n == len(lead):
            lead.append(i)
        number[i] = n
    return key[lead], list(index), np.bincount(number, minlength=len(index)), number


def remove_repeats(df: DataFrame, text: str = "text", window: int = WINDOW, prefix: str = "") -> DataFrame:
    """Every column of ``df``, with ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept`` (the bytes left)."""
    added = [prefix + c for c in ("n_bytes", "n_removed", "n_spans", "kept")]
    df = C.without(df, added)
    sizes = Sizes(window, window // 4, window // 2)
    place = df.columns.index(text)

    def view(rows):
        data, offsets = C.flat(rows.column(place))
        size = np.diff(offsets)
        return data, offsets, C._BYTE[data], np.repeat(offsets[1:], size), np.repeat(np.arange(len(size)), size)

    def full_keys(windows, frequent):
        own = windows.kept(frequent)
        starts = own.starts()
        if not len(starts):
            return starts, np.zeros(0, np.uint64), np.zeros(0, np.uint32)
        # only what these windows cover is hashed, put side by side
        change = np.zeros(len(own.h) + 1, dtype=np.int32)
        np.add.at(change, own.lo, 1)
        np.subtract.at(change, own.hi - 1 + window, 1)
        covered = np.cumsum(change[:-1]) > 0
        h, at = own.h[covered], (np.cumsum(covered) - 1)[starts]
        second = C.grams(C.mix(h ^ np.uint64(0xA5A5A5A5A5A5A5A5)), window)[at]
        return starts, C.grams(h, window)[at], (second >> np.uint64(32)).astype(np.uint32)

    blocks = Blocks(df, text)
    search = Search(view, sizes)
    search.first_rounds(blocks, 1.0, FREQUENT)

    # windows of frequent runs, one by one
    def full(rows, known):
        _, _, _, windows, frequent = search.windows(rows, known, MIDDLE)
        _, key, second = full_keys(windows, frequent)
        return {FULL: distinct(key, second)[:3]}

    blocks.ask(full, blocks.n_bytes // 16, 1 << 40, "full-answers")

    # all others as fragments, by the run that they share
    bits = max(4, int(np.ceil(np.log2(max(1, blocks.n_bytes / 2 / BUCKET_BYTES)))))

    def fragments(block, rows, known):
        data, _, _, windows, frequent = search.windows(rows, known, MIDDLE)
        key, texts, times, _ = _fragments(data, windows.kept(~frequent), window)
        bucket = (key >> np.uint64(64 - bits)).astype(np.int64)
        for b in np.unique(bucket).tolist():
            own = np.flatnonzero(bucket == b).tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([b], pa.int32()), pa.array([block]), pa.array([[texts[i] for i in own]], pa.list_(pa.binary())),
                 pa.array([(times[own] > 1).tolist()], pa.list_(pa.bool_()))], names=["bucket", "block", "texts", "twice"])

    sent = blocks.each(fragments, "bucket int, block long, texts array<binary>, twice array<boolean>")

    def index(table: pa.Table) -> pa.Table:
        texts = [x for own in table["texts"].to_pylist() for x in own]
        twice = np.array([x for own in table["twice"].to_pylist() for x in own], dtype=bool)
        number: dict[bytes, int] = {}
        at = np.fromiter((number.setdefault(x, len(number)) for x in texts), np.int64, len(texts))
        everywhere = np.bincount(at, weights=1 + twice, minlength=len(number)) > 1
        offsets = np.concatenate(([0], np.cumsum([len(x) for x in number])))
        found = RunLengthIndex(np.frombuffer(b"".join(number), np.uint8), offsets).repeats(window)
        marks = [found[a:b - window + 1] | e for a, b, e in zip(offsets, offsets[1:], everywhere)]
        said, n, i = [], [], 0
        for size in [len(own) for own in table["texts"].to_pylist()]:
            own = np.concatenate([marks[k] for k in at[i:i + size].tolist()])
            said.append(np.packbits(own).tobytes())
            n.append(len(own))
            i += size
        rows = len(said)
        return pa.table({"block": table["block"], "kind": pa.array([PART] * rows, pa.int32()), "bucket": table["bucket"],
                         "n": pa.array(n, pa.int32()), "said": pa.array(said, pa.binary())})

    blocks.told(sent.groupBy("bucket").applyInArrow(index, ANSWER), "part-answers")

    def apply(block, rows, known):
        data, offsets, again, windows, frequent = search.windows(rows, known, MIDDLE)
        alone, key, second = full_keys(windows, frequent)
        asked, _, _, where = distinct(key, second)
        hit = alone[known.bits(FULL, 3, len(asked))[0][where]] if len(asked) else alone
        rare = windows.kept(~frequent)
        _, texts, _, at = _fragments(data, rare, window)
        size = np.array([len(t) - window + 1 for t in texts], dtype=np.int64)
        lead = np.cumsum(size) - size
        marks = known.bits(PART, 1, int(size.sum()))[0]
        own = rare.hi - rare.lo
        flat = np.repeat(lead[at] if len(at) else own, own) + np.arange(int(own.sum())) - np.repeat(np.cumsum(own) - own, own)
        starts = rare.starts()
        change = np.zeros(len(data) + 1, dtype=np.int64)
        for found in (hit, starts[marks[flat]]):
            np.add.at(change, found, 1)
            np.subtract.at(change, found + window, 1)
        gone = np.cumsum(change[:-1]) > 0
        size = np.diff(offsets)
        gone |= np.repeat(again & (size >= window), size)
        total = np.concatenate(([0], np.cumsum(gone)))
        begins = gone.copy()
        begins[1:] &= ~gone[:-1]
        begins[offsets[:-1][size > 0]] = gone[offsets[:-1][size > 0]]
        spans = np.concatenate(([0], np.cumsum(begins)))
        left = data[~gone].tobytes()
        cut = offsets - total[offsets]
        yield pa.RecordBatch.from_arrays(
            rows.columns + [pa.array(size.astype(np.int64)), pa.array(total[offsets[1:]] - total[offsets[:-1]]),
                            pa.array(spans[offsets[1:]] - spans[offsets[:-1]]),
                            pa.array([left[a:b] for a, b in zip(cut, cut[1:])], pa.binary())],
            names=rows.schema.names + added)

    return blocks.each(apply, C.types_of(df) + ", `{}` long, `{}` long, `{}` long, `{}` binary".format(*added))
