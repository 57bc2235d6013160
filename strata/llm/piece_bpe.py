"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

The words of many documents are encoded together: one flat numpy array of
symbols with the word of each.  In a round every adjacent pair gets the rank of
its merge, each word takes the least rank among its pairs, the pairs of that
rank are merged from the left (overlapping ones skipped), and the arrays are
compacted; words without a pair leave.  Rounds go on until no word is left.

That equals the library's order (best score first, leftmost first) where a
merge can't yield a pair of better or equal rank, which is found for each rank
when the model is loaded; of other ranks a word merges one pair a round, the
leftmost.  Pieces that share one score (runs of spaces) are merged one by one
from the left.  Words
are cut before a space that follows another character, where no piece of the
model reaches across (checked, too).

Results: null and empty text give no ids and decode to the empty text.  Every
other text decodes as the library's ``decode(ids)`` does.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import common as C
from strata.llm.word_table import WordTable

SPACE = "▁"
WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_NONE = np.int64(1 << 40)


class PieceModel:
    """Pieces, merges and byte pieces of a model file (BPE, identity normaliser, byte fallback)."""

    def __init__(self, path: str):
        import sentencepiece

        lib = sentencepiece.SentencePieceProcessor(model_file=path)
        size = lib.get_piece_size()
        pieces = [lib.id_to_piece(i) for i in range(size)]
        special = [lib.is_control(i) or lib.is_unknown(i) for i in range(size)]
        byte = [lib.is_byte(i) for i in range(size)]
        self.unknown = lib.unk_id()
        self.byte_id = np.zeros(256, dtype=np.int64)
        for i in range(size):
            if byte[i]:
                self.byte_id[int(pieces[i][3:5], 16)] = i
        if lib.normalize("a ａ  ") != f"{SPACE}a{SPACE}ａ{SPACE}{SPACE}" or sum(byte) != 256:
            raise ValueError("only models with an identity normaliser and byte fallback")
        normal = {p: i for i, p in enumerate(pieces) if not special[i] and not byte[i]}
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in normal):
            raise ValueError("a piece reaches across words")

        # symbols: the pieces, then single characters that are no piece of their own
        symbol = dict(normal)
        for p in normal:
            for ch in p:
                symbol.setdefault(ch, size + len(symbol))
        self.symbol = symbol
        self.n_symbols = max(symbol.values()) + 1
        score = {p: lib.get_score(i) for p, i in normal.items()}
        order = {s: r for r, s in enumerate(sorted(set(score.values()), reverse=True))}
        rank = {p: order[s] for p, s in score.items()}
        merges = [(symbol[p[:k]] * self.n_symbols + symbol[p[k:]], rank[p], symbol[p])
                  for p in normal for k in range(1, len(p)) if p[:k] in symbol and p[k:] in symbol]
        merges.sort()
        self.key = np.array([m[0] for m in merges], dtype=np.int64)
        self.rank = np.array([m[1] for m in merges], dtype=np.int64)
        self.result = np.array([m[2] for m in merges], dtype=np.int64)
        self.merge = {m[0]: (m[1], m[2]) for m in merges}
        times = np.bincount([rank[p] for p in normal])
        shared = [r for r in set(self.rank.tolist()) if times[r] > 1]
        #: ranks from here on are shared by several pieces; they are the worst ones
        self.tied = min(shared, default=1 << 39)
        if any(r >= self.tied and r not in shared for r in set(self.rank.tolist())):
            raise ValueError("scores that pieces share must be the worst")
        #: by rank: whether no merge with its piece on a side is better, so that all its pairs can merge at once
        best = np.full(len(order) + 1, _NONE)
        for p in normal:
            for k in range(1, len(p)):
                if p[:k] in symbol and p[k:] in symbol:
                    for side in (p[:k], p[k:]):
                        if side in rank:
                            best[rank[side]] = min(best[rank[side]], rank[p])
        self.together = best[:-1] > np.arange(len(order))

        # decoding: the bytes of each id
        text = [b"" if special[i] else bytes([int(p[3:5], 16)]) if byte[i] else p.replace(SPACE, " ").encode()
                for i, p in enumerate(pieces)]
        text[self.unknown] = " ⁇ ".encode()
        self.piece_bytes = np.frombuffer(b"".join(text), dtype=np.uint8)
        self.piece_size = np.array([len(t) for t in text], dtype=np.int64)
        self.piece_start = np.cumsum(self.piece_size) - self.piece_size
        self.special = np.array([s and i != self.unknown for i, s in enumerate(special)])
        self.leads_with_space = np.array([p.startswith(SPACE) and not byte[i] for i, p in enumerate(pieces)])

    # ------------------------------------------------------------------ encoding
    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(the ids of all words in a row, how many each word has)."""
        get = self.symbol.get
        flat = [get(ch, -1 - ord(ch)) for w in words for ch in w]      # unknown: minus its code point
        word = np.repeat(np.arange(len(words)), [len(w) for w in words])
        symbols, word = self._merge(np.array(flat, dtype=np.int64), word)
        ids, word = self._as_ids(symbols, word)
        return ids, np.bincount(word, minlength=len(words)).astype(np.int64)

    def _merge(self, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(sym):
            rank, result = self._pairs(sym, word)
            first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            size = np.diff(np.concatenate((first, [len(sym)])))
            least = np.minimum.reduceat(rank, first)
            over = least >= min(self.tied, _NONE)
            if over.any():
                leave = np.repeat(over, size)
                for k in np.flatnonzero(over & (least < _NONE)):
                    # only tied ranks are left in this word
                    part = np.array(self._from_left(sym[first[k]:first[k] + size[k]].tolist()), dtype=np.int64)
                    done.append((part, np.full(len(part), word[first[k]])))
                end = np.repeat(over & (least == _NONE), size)
                done.append((sym[end], word[end]))
                sym, word, rank, result = (x[~leave] for x in (sym, word, rank, result))
                size, least = size[~over], least[~over]
            best = rank == np.repeat(least, size)
            if len(sym):
                best &= rank < _NONE
                places = np.flatnonzero(best)
                # of a run of overlapping pairs every other one, from the left
                fresh = np.concatenate(([True], places[1:] != places[:-1] + 1)) if len(places) else places
                run = np.cumsum(fresh) - 1
                lead = places[np.flatnonzero(fresh)][run] if len(places) else places
                places = places[(places - lead) % 2 == 0]
                # a rank whose merge may give a better pair: only the leftmost pair of the word
                _, only = np.unique(word[places], return_index=True)
                leftmost = np.zeros(len(places), dtype=bool)
                leftmost[only] = True
                places = places[leftmost | self.together[rank[places]]]
                sym[places] = result[places]
                stay = np.ones(len(sym), dtype=bool)
                stay[places + 1] = False
                sym, word = sym[stay], word[stay]
        if not done:
            return sym, word
        sym, word = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(word, kind="stable")
        return sym[order], word[order]

    def _pairs(self, sym, word):
        """The rank and result of the pair that begins at each symbol."""
        rank = np.full(len(sym), _NONE, dtype=np.int64)
        result = np.zeros(len(sym), dtype=np.int64)
        left = np.flatnonzero((word[1:] == word[:-1]) & (sym[1:] >= 0) & (sym[:-1] >= 0))
        key = sym[left] * self.n_symbols + sym[left + 1]
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        hit = self.key[at] == key
        rank[left[hit]] = self.rank[at[hit]]
        result[left[hit]] = self.result[at[hit]]
        return rank, result

    def _from_left(self, sym: list[int]) -> list[int]:
        """Merges the leftmost pair again and again; all pairs have one and the same rank."""
        out: list[int] = []
        for s in sym:
            while out and out[-1] >= 0 and s >= 0 and (m := self.merge.get(out[-1] * self.n_symbols + s)):
                out.pop()
                s = m[1]
            out.append(s)
        return out

    def _as_ids(self, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols without an id become their UTF-8 bytes' ids."""
        odd = (sym < 0) | (sym >= len(self.piece_size))
        if not odd.any():
            return sym, word
        chars = {s: c for c, s in self.symbol.items() if len(c) == 1 and s >= len(self.piece_size)}
        spelled = {s: self.byte_id[list((chr(-1 - s) if s < 0 else chars[s]).encode())]
                   for s in set(sym[odd].tolist())}
        size = np.ones(len(sym), dtype=np.int64)
        size[odd] = [len(spelled[s]) for s in sym[odd].tolist()]
        out = np.repeat(sym, size)
        out[np.repeat(odd, size)] = np.concatenate([spelled[s] for s in sym[odd].tolist()])
        return out, np.repeat(word, size)

    # ------------------------------------------------------------------ decoding
    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """The text of each run ids[offsets[d]:offsets[d+1]]."""
        size = self.piece_size[ids].copy()
        start = self.piece_start[ids].copy()
        # the space that encoding put before the text: of the first piece that isn't a control piece
        for d in np.flatnonzero(np.diff(offsets) > 0):
            i = offsets[d]
            while i < offsets[d + 1] and self.special[ids[i]]:
                i += 1
            if i < offsets[d + 1] and self.leads_with_space[ids[i]]:
                start[i] += 1
                size[i] -= 1
        lead = np.concatenate(([0], np.cumsum(size)))
        data = self.piece_bytes[np.repeat(start - lead[:-1], size) + np.arange(lead[-1])].tobytes()
        cut = lead[offsets]
        parted = {}                                    # control pieces part runs of byte pieces
        for i in np.flatnonzero(self.special[ids]).tolist():
            parted.setdefault(int(np.searchsorted(offsets, i, side="right")) - 1, []).append(int(lead[i]))
        out = []
        for d in range(len(offsets) - 1):
            at = [int(cut[d]), *parted.get(d, ()), int(cut[d + 1])]
            out.append("".join(_text(data[a:b]) for a, b in zip(at, at[1:])))
        return out


def _text(data: bytes) -> str:
    """UTF-8 text; each byte that belongs to no character is U+FFFD."""
    out = []
    while True:
        try:
            out.append(data.decode())
            return "".join(out)
        except UnicodeDecodeError as e:
            out += [data[:e.start].decode(), "�"]
            data = data[e.start + 1:]


_models: dict[str, tuple[PieceModel, WordTable]] = {}


def load(path: str) -> tuple[PieceModel, WordTable]:
    if path not in _models:
        model = PieceModel(path)
        _models[path] = model, WordTable(model.encode_words)
    return _models[path]


def encode_texts(texts: list[str | None], path: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts in a row, offsets)."""
    _, table = load(path)
    words, count = [], []
    for text in texts:
        own = WORD.findall(SPACE + text.replace(" ", SPACE)) if text else []
        words += own
        count.append(len(own))
    ids, size = table.ids(words)
    lead = np.concatenate(([0], np.cumsum(size)))
    return ids, lead[np.concatenate(([0], np.cumsum(count)))]


def encode(df: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """Every column of ``df`` but the text, and the text's ids."""
    rest = C.without(df.drop(text), [out])
    n, own = len(rest.columns), C.free_name(rest)

    def run(batches):
        for batch in batches:
            for part in C.slices([batch], own):
                ids, offsets = encode_texts(part.column(n).to_pylist(), path)
                added = pa.ListArray.from_arrays(pa.array(offsets, type=pa.int32()), pa.array(ids, type=pa.int32()))
                yield pa.RecordBatch.from_arrays(part.columns[:n] + [added], names=part.schema.names[:n] + [out])

    types = ", ".join(filter(None, [C.types_of(rest), f"`{out}` array<int>"]))
    return df.select(*rest.columns, F.col(text).alias(own)).mapInArrow(run, types)


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Every column of ``df`` and the text of its ids (null: empty)."""
    df = C.without(df, [out])
    place = df.columns.index(ids)

    def run(batches):
        model, _ = load(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                column = part.column(place)
                offsets = np.concatenate(([0], np.cumsum(np.array(
                    column.value_lengths().fill_null(0), dtype=np.int64))))
                values = column.flatten().to_numpy(zero_copy_only=False)
                texts = model.decode(values.astype(np.int64), offsets)
                yield pa.RecordBatch.from_arrays(part.columns + [pa.array(texts, type=pa.string())],
                                                 names=part.schema.names + [out])

    return df.mapInArrow(run, f"{C.types_of(df)}, `{out}` string")
