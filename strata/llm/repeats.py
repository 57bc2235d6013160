"""Which windows of a block may occur elsewhere: keys of ever longer runs around sampled anchors.

A window of ``window`` symbols takes as its anchor the run of ``core`` symbols
with the smallest hash in it (leftmost of equal ones); windows with equal
symbols take anchors at equal places.  Runs of ``core``, then of ``middle``
symbols around an anchor are asked about, and windows whose runs are alone are
dropped.  Symbols are words or bytes.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np

from strata.llm import common as C
from strata.llm.blocks import Answers, Blocks, Keys, distinct

WHOLE, CORE, MIDDLE, FULL, PART = range(5)      # kinds of questions

_U, _W = np.uint64, np.uint32


@dataclass(frozen=True)
class Sizes:
    window: int
    core: int
    middle: int

    def __post_init__(self):
        if not (self.core < self.middle < self.window and 2 * self.middle <= self.window + self.core + 1):
            raise ValueError("middle runs must fit into every window, on one side of its anchor or the other")


def order_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """32 bits for every run of ``n`` symbols, in which the smallest is looked for."""
    out, size, steps = (h >> _U(32)).astype(np.uint32), 1, []
    while n > 1:
        steps.append(n)
        n = (n + 1) // 2
    for k, target in enumerate(reversed(steps)):
        m = len(h) - target + 1
        if m <= 0:
            return out[:0]
        out = out[:m] * _W(0x9E3779B1 + 2 * k) + out[target - size:target - size + m]
        size = target
    out ^= out >> _W(15)
    out *= _W(0x2C1B3C6D)
    out ^= out >> _W(13)
    return out


def run_keys(h: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of the runs of ``n`` symbols at ``starts``."""
    out = np.empty(len(starts), dtype=np.uint64)
    powers, within = C.powers(n + 1)[1:][::-1], np.arange(n)
    step = max(1, (1 << 20) // n)
    for at in range(0, len(starts), step):
        out[at:at + step] = (h[starts[at:at + step, None] + within] * powers).sum(axis=1, dtype=np.uint64)
    return C.mix(out + _U(n))


class Windows:
    """Ranges of window starts ``lo:hi`` that share a run of symbols at ``run``."""

    def __init__(self, h: np.ndarray, sizes: Sizes, run: np.ndarray, lo: np.ndarray, hi: np.ndarray):
        self.h, self.sizes, self.run, self.lo, self.hi = h, sizes, run, lo, hi

    @classmethod
    def sampled(cls, h: np.ndarray, stop: np.ndarray, sizes: Sizes) -> Windows:
        """All windows by their anchors; ``stop`` is, for every symbol, the end of its document."""
        w, n = sizes.window, len(h) - sizes.window + 1
        none = np.zeros(0, np.int64)
        if n <= 0:
            return cls(h, sizes, none, none, none)
        least = order_hashes(h, sizes.core).astype(np.uint64) << _U(32)
        least |= np.arange(len(least), dtype=np.uint64)
        span, reach = w - sizes.core + 1, 1
        while 2 * reach <= span:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        least = np.minimum(least[:n], least[span - reach:][:n])
        starts = np.flatnonzero(np.arange(n) + w <= stop[:n])
        anchors = (least[starts] & _U(0xFFFFFFFF)).astype(np.int64)
        if not len(starts):
            return cls(h, sizes, none, none, none)
        # windows with one anchor follow one another
        lead = np.flatnonzero(np.concatenate(([True], anchors[1:] != anchors[:-1])))
        last = np.concatenate((lead[1:], [len(starts)])) - 1
        return cls(h, sizes, anchors[lead], starts[lead], starts[last] + 1)

    def packed(self) -> bytes:
        return np.concatenate((self.run, self.lo, self.hi)).astype(np.int32).tobytes()

    @classmethod
    def unpacked(cls, h: np.ndarray, sizes: Sizes, data: bytes) -> Windows:
        run, lo, hi = np.frombuffer(data, np.int32).astype(np.int64).reshape(3, -1)
        return cls(h, sizes, run, lo, hi)

    def kept(self, which: np.ndarray) -> Windows:
        return Windows(self.h, self.sizes, self.run[which], self.lo[which], self.hi[which])

    def widened(self) -> Windows:
        """The same windows by runs of ``middle`` symbols: left of the anchor where that fits, else right of it."""
        more = self.sizes.middle - self.sizes.core
        cut = np.clip(self.run - more + 1, self.lo, self.hi)
        both = Windows(self.h, self.sizes, np.concatenate((self.run - more, self.run)),
                       np.concatenate((self.lo, cut)), np.concatenate((cut, self.hi)))
        return both.kept(both.lo < both.hi)

    def keys(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(keys of the different runs of ``n`` symbols, the place of each range's run among them)."""
        at, place = np.unique(self.run, return_inverse=True)
        return run_keys(self.h, at, n), place

    def starts(self) -> np.ndarray:
        size = self.hi - self.lo
        return np.repeat(self.lo, size) + np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)


def whole_keys(texts: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """96 bits of each text's digest."""
    data = texts.tobytes()
    found = [hashlib.blake2b(data[a:b], digest_size=12).digest() for a, b in zip(offsets[:-1], offsets[1:])]
    both = np.frombuffer(b"".join(found), dtype=np.dtype([("a", "<u8"), ("b", "<u4")]))
    return both["a"].copy(), both["b"].copy()


class Search:
    """The rounds over a block's rows; ``view(rows)`` gives (data, offsets, hashes, stop, document) of them."""

    def __init__(self, view, sizes: Sizes):
        self.view, self.sizes = view, sizes

    def whole(self, known: Answers, data, offsets):
        """(keys as asked, documents that occur again, documents to look into)."""
        a, b = whole_keys(data, offsets)
        key, second, times, place = distinct(a, b)
        if WHOLE not in known.known:
            return (key, second, times), None, None
        repeated, first, _ = known.bits(WHOLE, 3, len(key))
        _, lead = np.unique(place, return_index=True)
        leads = np.zeros(len(place), dtype=bool)
        leads[lead] = True
        return (key, second, times), repeated[place], first[place] & leads

    def windows(self, rows, known: Answers, upto: int):
        """The windows left after the rounds up to kind ``upto``, with what the block holds."""
        data, offsets, h, stop, doc = self.view(rows)
        _, again, look = self.whole(known, data, offsets)
        windows = Windows.unpacked(h, self.sizes, known.kept)
        repeated, place = self._told(known, CORE, windows, self.sizes.core)
        windows = windows.kept(repeated[0][place] & look[doc[windows.lo]]).widened()
        often = np.zeros(len(windows.lo), dtype=bool)
        if upto >= MIDDLE:
            told, place = self._told(known, MIDDLE, windows, self.sizes.middle)
            left = told[0][place]
            often, windows = told[2][place][left], windows.kept(left)
        return data, offsets, again, windows, often

    @staticmethod
    def _told(known: Answers, kind: int, windows: Windows, n: int):
        keys, place = windows.keys(n)
        key, _, _, where = distinct(keys)
        return known.bits(kind, 3, len(key)), where[place]

    def first_rounds(self, blocks: Blocks, symbol_bytes: float, frequent: int) -> None:
        """Asks about whole texts and core runs, then about middle runs."""
        def core(rows, known) -> Keys:
            data, offsets, h, stop, _ = self.view(rows)
            asked, _, _ = self.whole(known, data, offsets)
            windows = Windows.sampled(h, stop, self.sizes)
            known.keep(windows.packed())
            return {WHOLE: asked, CORE: distinct(windows.keys(self.sizes.core)[0])[:3]}

        def middle(rows, known) -> Keys:
            _, _, _, windows, _ = self.windows(rows, known, CORE)
            return {MIDDLE: distinct(windows.keys(self.sizes.middle)[0])[:3]}

        symbols = blocks.n_bytes / symbol_bytes
        density = 2 / (self.sizes.window - self.sizes.core + 2)
        blocks.ask(core, int(symbols * density), frequent, "core-answers")
        blocks.ask(middle, int(symbols * density), frequent, "middle-answers")
