"""Alignment of two tokenizers over the bytes of each text.

A text (with a space before it) is cut where token ends of both tokenizers meet;
between two such cuts lies a group of tokens of each.  A byte range of a text
yields a fragment: the tokens that end in it, as an open prefix (up to the first
cut in the range), closed groups, and an open suffix.  Fragments compose: the
left one's suffix and the right one's prefix become a group, or stay open where
a side has no cut.  That is associative, so the fragments of a long text are
made by different tasks and reduced as a tree of ``FAN`` at a time, in which only open
ends move; closed groups stay where they are.

A range's tokens are those of the whole words that overlap it.  Neither
tokenizer joins a space to what stands before it unless that is white space, so
a word here ends before a space that follows another character than white
space, and its tokens don't depend on its neighbours.  The words that recur are
aligned once a worker (a memo, not a limit).  A word of over ``MARGIN`` bytes is
never cut: a text without any such space is encoded in one task.

Results: null and empty texts, and those whose joined token bytes differ from
the text's for either tokenizer, have no tokens: zeros and an empty digest.
Repeated rows are aligned each on its own and all count; a null id stays null.
An empty table gives an empty result.  Columns that are not named are not read.
"""

from __future__ import annotations

import hashlib
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import common as C
from strata.llm import salted
from strata.llm.components import written

CHUNK = 1 << 18
MARGIN = 1 << 12
FAN = 8
MEMO = 400_000
MEMO_TOKENS = 8_000_000


# ---------------------------------------------------------------- words

def word_starts(data: np.ndarray) -> np.ndarray:
    """Places of spaces that follow another character than white space."""
    at = np.flatnonzero(data[1:] == 0x20) + 1
    p1 = data[at - 1]
    sure = (p1 > 0x20) & (p1 < 0x7F)
    odd = np.flatnonzero(p1 >= 0x80)
    if len(odd):
        b1, b2, b3 = p1[odd], data[np.maximum(at[odd] - 2, 0)], data[np.maximum(at[odd] - 3, 0)]
        # white space beyond ASCII: U+0085 A0 1680 180E 2000-200A 2028 2029 202F 205F 3000
        white = (b2 == 0xC2) & np.isin(b1, (0x85, 0xA0))
        white |= (b3 == 0xE1) & (((b2 == 0x9A) & (b1 == 0x80)) | ((b2 == 0xA0) & (b1 == 0x8E)))
        white |= (b3 == 0xE2) & (((b2 == 0x80) & ((b1 <= 0x8A) | np.isin(b1, (0xA8, 0xA9, 0xAF)))) | ((b2 == 0x81) & (b1 == 0x9F)))
        white |= (b3 == 0xE3) & (b2 == 0x80) & (b1 == 0x80)
        sure[odd] = ~white
    return at[sure]


def ranges(text: bytes, chunk: int = CHUNK, margin: int = MARGIN) -> list[tuple[int, int, int, int]]:
    """(first word's start, last word's end, start, end) of the byte ranges of a text.

    Ranges end near multiples of ``chunk``, between characters, anywhere in a word of up to ``margin`` bytes.
    """
    def around(p: int) -> tuple[int, int]:
        """Start and end of the word that holds the boundary ``p``; the start is -1 where it is too long."""
        low, high = max(0, p - margin), min(len(text), p + margin)
        while True:
            begin = max(0, low - 4)
            starts = word_starts(np.frombuffer(text, np.uint8, high - begin, begin)) + begin
            starts = starts[starts >= low]
            left, right = starts[starts <= p], starts[starts > p]
            if len(right) or high == len(text):
                return int(left[-1]) if len(left) else 0 if low == 0 else -1, int(right[0]) if len(right) else len(text)
            high = min(len(text), high + chunk)

    cuts = [(0, 0, 0)]
    p = chunk
    while p < len(text):
        while text[p] & 0xC0 == 0x80:
            p -= 1
        start, end = around(p)
        if start < 0 or end - start > margin:
            p, start = end, end                            # a long word is left whole
        if p > cuts[-1][2] and p < len(text):
            cuts.append((start, start if start == p else end, p))
        p = max(p, cuts[-1][2]) + chunk
    ends = cuts[1:] + [(0, len(text), len(text))]
    return [(a[0], b[1], a[2], b[2]) for a, b in zip(cuts, ends)]


# ---------------------------------------------------------------- aligned words

class Aligner:
    """Tokens and groups of words, by two tokenizer files (byte-level BPE of tokenizers, sentencepiece)."""

    def __init__(self, a_path: str, b_path: str):
        import os

        import sentencepiece
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        byte = _byte_of_letter()
        letters = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(letters.values()) + 1)
        for token, i in letters.items():
            if all(ch in byte for ch in token):
                self.a_bytes[i] = bytes(byte[ch] for ch in token)
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in ((i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))]
        self.a_size = np.array([len(x) for x in self.a_bytes], dtype=np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], dtype=np.int64)
        self._clear()

    def _clear(self) -> None:
        self.index: dict[bytes, int] = {}
        self.text: list[str | None] = []                     # of the groups; None: the bytes differ
        self.n = 0
        # a, b: tokens; ga, gb: how many tokens of a group
        self.start = {k: np.zeros(1 << 12, dtype=np.int64) for k in ("a", "b", "g")}
        self.size = {k: np.zeros(1 << 12, dtype=np.int32) for k in ("a", "b", "g")}
        self.used = dict.fromkeys(("a", "b", "g"), 0)
        self.flat = {k: np.zeros(1 << 14, dtype=np.int32) for k in ("a", "b", "ga", "gb")}

    def look_up(self, words: list[bytes]) -> np.ndarray:
        """The numbers of words that begin with a space; valid until the next call."""
        if self.n > MEMO or self.used["a"] > MEMO_TOKENS:
            self._clear()
        at = np.fromiter(map(self.index.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        missing = np.flatnonzero(at < 0)
        if len(missing):
            absent = [words[i] for i in missing.tolist()]
            self._add(list(dict.fromkeys(absent)))
            at[missing] = np.fromiter(map(self.index.__getitem__, absent), dtype=np.int64, count=len(absent))
        return at

    def _add(self, words: list[bytes]) -> None:
        texts = [w.decode() for w in words]
        a = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        # the library puts a space before each text but the empty one
        b = [own or [self.b.piece_to_id("▁")] for own in self.b.encode([t[1:] for t in texts], num_threads=1)]
        for k, w in enumerate(words):
            if b"".join(map(self.a_bytes.__getitem__, a[k])) != w or b"".join(map(self.b_bytes.__getitem__, b[k])) != w:
                a[k] = b[k] = []
        size = {"a": np.array([len(x) for x in a], dtype=np.int64), "b": np.array([len(x) for x in b], dtype=np.int64)}
        fa, fb = (np.fromiter((i for x in y for i in x), dtype=np.int64, count=int(size[k].sum()))
                  for k, y in (("a", a), ("b", b)))
        ea, eb = np.cumsum(self.a_size[fa]), np.cumsum(self.b_size[fb])          # equal in all where each word is
        met = np.intersect1d(ea, eb, assume_unique=True)
        ga = np.diff(np.searchsorted(ea, met) + 1, prepend=0)
        gb = np.diff(np.searchsorted(eb, met) + 1, prepend=0)
        word_end = np.concatenate(([0], ea))[np.cumsum(size["a"])]
        last = np.searchsorted(met, word_end, side="right")
        size["g"] = np.diff(last, prepend=0)

        n = self.n + len(words)
        if n > len(self.start["a"]):
            for table in (self.start, self.size):
                for k in table:
                    table[k] = np.concatenate((table[k], np.zeros(max(n, len(table[k])), table[k].dtype)))
        for k, parts in (("a", {"a": fa}), ("b", {"b": fb}), ("g", {"ga": ga, "gb": gb})):
            self.size[k][self.n:n] = size[k]
            self.start[k][self.n:n] = self.used[k] + np.cumsum(size[k]) - size[k]
            used = self.used[k] + int(size[k].sum())
            for name, values in parts.items():
                if used > len(self.flat[name]):
                    self.flat[name] = np.concatenate((self.flat[name], np.zeros(max(used, len(self.flat[name])), np.int32)))
                self.flat[name][self.used[k]:used] = values
            self.used[k] = used
        said = group_texts(fa, fb, ga, gb)
        lead = 0
        for count, word in zip(size["g"].tolist(), words):
            self.text.append(";".join(said[lead:lead + count]) if count or not word else None)
            lead += count
        self.index.update(zip(words, range(self.n, n)))
        self.n = n

    def gather(self, name: str, at: np.ndarray) -> np.ndarray:
        """``a``, ``b``, ``ga`` or ``gb`` of the words numbered ``at``, in a row."""
        k = name[0]
        size = self.size[k][at].astype(np.int64)
        lead = np.cumsum(size) - size
        return self.flat[name][np.repeat(self.start[k][at] - lead, size) + np.arange(int(size.sum()))]


def _byte_of_letter() -> dict[str, int]:
    """The letters of byte-level BPE: printable Latin-1 stands for itself, other bytes for U+0100 and on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [x for x in range(256) if x not in set(plain)]
    return {chr(x): x for x in plain} | {chr(256 + k): x for k, x in enumerate(other)}


def group_texts(a, b, ga, gb) -> list[str]:
    """``a1,a2|b1`` of each group."""
    a, b = list(map(str, a.tolist())), list(map(str, b.tolist()))
    out, i, j = [], 0, 0
    for x, y in zip(ga.tolist(), gb.tolist()):
        out.append((a[i] if x == 1 else ",".join(a[i:i + x])) + "|" + (b[j] if y == 1 else ",".join(b[j:j + y])))
        i += x
        j += y
    return out


def links(a, b, ga, gb) -> np.ndarray:
    """The pairs of tokens that end together, one per group: a's id times 2**32 and b's."""
    return (a[np.cumsum(ga) - 1].astype(np.int64) << 32) | b[np.cumsum(gb) - 1]


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    if (a_path, b_path) not in _aligners:
        _aligners[a_path, b_path] = Aligner(a_path, b_path)
    return _aligners[a_path, b_path]


# ---------------------------------------------------------------- fragments

#: a, b, ga, gb: the tokens of a fragment and how many of them each closed group has, the open prefix
#: counted as the first; tokens beyond are the open suffix.  ``links`` are places in the block's ``pairs``.
FRAGMENT = ("seq int, chunks int, block long, ok boolean, n_a long, n_b long, n_groups long, groups_sha256 string, "
            "links array<int>, a array<int>, b array<int>, ga array<int>, gb array<int>, "
            "pairs array<long>, times array<long>")


def _cutter(chunk: int, margin: int):
    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                text = batch.column(2)[k].as_py()
                found = ranges(text, chunk, margin)
                for seq, (first, last, lo, hi) in enumerate(found):
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(k, 1), batch.column(1).slice(k, 1), pa.array([seq], pa.int32()),
                         pa.array([len(found)], pa.int32()), pa.array([lo - first], pa.int32()),
                         pa.array([hi - lo], pa.int32()), pa.array([text[first:last]], pa.binary())],
                        names=["row", "id", "seq", "chunks", "skip", "take", "body"])

    return run


def _lists(parts: list[np.ndarray | None], kind: pa.DataType) -> pa.Array:
    size = np.array([0 if p is None else len(p) for p in parts], dtype=np.int64)
    flat = np.concatenate([p for p in parts if p is not None] or [np.zeros(0, np.int64)])
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(size))), pa.int32()), pa.array(flat, kind),
                                    mask=pa.array([p is None for p in parts]))


def _fragmenter(a_path: str, b_path: str, tokens: bool):
    """Fragments of ranges (row, id, seq, chunks, skip, take, body); a whole text is one range.

    A block is a run of whole texts, or one range of a longer one; its first row has the counts of its pairs.
    """
    def run(batches):
        found = aligner(a_path, b_path)
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in C.slices([batch], "body"):
                chunks = part.column(3).to_numpy()
                whole = np.flatnonzero(chunks == 1)
                for rows in ([whole] if len(whole) else []) + [np.array([k]) for k in np.flatnonzero(chunks > 1)]:
                    yield _block(found, part.take(pa.array(rows)), number, tokens)
                    number += 1

    return run


def _block(found: Aligner, part: pa.RecordBatch, number: int, tokens: bool) -> pa.RecordBatch:
    data, offsets = C.flat(part.column(6))
    n = part.num_rows
    long = part.column(3)[0].as_py() > 1
    starts = np.unique(np.concatenate((word_starts(data) if len(data) else np.zeros(0, np.int64), offsets[:-1])))
    starts = starts[starts < len(data)]
    ends = np.append(starts[1:], len(data))
    raw = data.tobytes()
    at = found.look_up([raw[i:j] for i, j in zip(starts.tolist(), ends.tolist())])
    first = np.searchsorted(starts, offsets)                                   # words of a text
    texts = found.text
    groups = [texts[i] for i in at.tolist()]
    fine = np.array([g is not None for g in groups], dtype=bool)
    bad = np.concatenate(([0], np.cumsum(~fine)))
    ok = (bad[first[1:]] == bad[first[:-1]]) & (np.diff(offsets) > 0)
    keep = np.repeat(ok, np.diff(first))
    counted = {k: np.concatenate(([0], np.cumsum(found.size[k][at] * keep)))[first] for k in ("a", "b", "g")}
    at = at[keep]
    a, b, ga, gb = (found.gather(k, at) for k in ("a", "b", "ga", "gb"))
    digest: list[str | None] = [None] * n
    if long and ok[0]:
        # of the words at the ends, only the tokens that end in the range
        skip, take = part.column(4)[0].as_py(), part.column(5)[0].as_py()
        ea, eb = np.cumsum(found.a_size[a]), np.cumsum(found.b_size[b])
        met = ea[np.cumsum(ga) - 1]
        inside = lambda x: (x > skip) & (x <= skip + take)
        met = met[inside(met)]
        a, b, ea, eb = a[inside(ea)], b[inside(eb)], ea[inside(ea)], eb[inside(eb)]
        ga = np.diff(np.searchsorted(ea, met) + 1, prepend=0)
        gb = np.diff(np.searchsorted(eb, met) + 1, prepend=0)
        counted = {k: np.array([0, len(x)]) for k, x in (("a", a), ("b", b), ("g", ga))}
    elif not long:
        digest = [hashlib.sha256(";".join(groups[i:j]).encode()).hexdigest() if o else ""
                  for i, j, o in zip(first[:-1].tolist(), first[1:].tolist(), ok.tolist())]
    pairs, place, times = np.unique(links(a, b, ga, gb), return_inverse=True, return_counts=True)
    cut = lambda x, k: [x[i:j] for i, j in zip(counted[k][:-1].tolist(), counted[k][1:].tolist())]
    held = lambda x, k: cut(x, k) if long or tokens else [None] * n
    once = lambda x: [x] + [None] * (n - 1)
    size = lambda k: pa.array(np.diff(counted[k]), pa.int64())
    return pa.RecordBatch.from_arrays(
        [part.column(0), part.column(1), part.column(2), part.column(3), pa.array(np.full(n, number), pa.int64()),
         pa.array(ok), size("a"), size("b"), size("g"), pa.array(digest, pa.string()),
         _lists(cut(place, "g"), pa.int32()), _lists(held(a, "a"), pa.int32()), _lists(held(b, "b"), pa.int32()),
         _lists(held(ga, "g"), pa.int32()), _lists(held(gb, "g"), pa.int32()),
         _lists(once(pairs), pa.int64()), _lists(once(times), pa.int64())],
        names=["row", "id", *(x.split()[0] for x in FRAGMENT.split(", "))])


def fragments(df: DataFrame, a_path: str, b_path: str, id: str = "doc_id", text: str = "text", tokens: bool = True,
              chunk: int = CHUNK, margin: int = MARGIN) -> DataFrame:
    """(row, id, ``FRAGMENT``): a fragment per byte range of every text, written.

    Texts of up to ``chunk`` bytes are one range, aligned where they are read; the ranges of others are dealt
    out to all tasks.  ``tokens`` keeps the tokens and groups of the former, too.
    """
    kind = df.schema[id].dataType.simpleString()
    body = F.when(F.col(f"`{text}`") != "", F.concat(F.lit(" "), F.col(f"`{text}`"))).otherwise("").cast("binary")
    body = F.coalesce(body, F.lit(b""))
    docs = df.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id}`").alias("id"), body.alias("body"))
    size = F.octet_length("body")
    ranged = f"row long, id {kind}, seq int, chunks int, skip int, take int, body binary"
    # of texts that are cut, a few at a time are in memory
    long = docs.filter(size > chunk).mapInArrow(_cutter(chunk, margin), ranged).repartition("row", "seq")
    short = docs.filter(size <= chunk).select(
        "row", "id", F.lit(0).alias("seq"), F.lit(1).alias("chunks"), F.lit(0).alias("skip"), size.alias("take"), "body")
    fragment = _fragmenter(a_path, b_path, tokens)
    schema = f"row long, id {kind}, {FRAGMENT}"
    return written(short.mapInArrow(fragment, schema).unionByName(long.mapInArrow(fragment, schema)), "fragments")


# ---------------------------------------------------------------- composition

OPEN = "row long, seq int, cut int, pa array<int>, pb array<int>, sa array<int>, sb array<int>"
SEAM = ", seam_a array<int>, seam_b array<int>"


def compose(left: dict, right: dict) -> tuple[dict, tuple | None]:
    """(the open ends of two neighbouring fragments as one, the group that closes between them: (cut, a, b)).

    ``cut`` is the fragment that holds the first cut, or null; pa, pb are the tokens up to it, sa, sb those after the last.
    """
    if left["cut"] is None:
        return right | {"pa": left["pa"] + right["pa"], "pb": left["pb"] + right["pb"]}, None
    if right["cut"] is None:
        return left | {"sa": left["sa"] + right["pa"], "sb": left["sb"] + right["pb"]}, None
    seam = right["cut"], left["sa"] + right["pa"], left["sb"] + right["pb"]
    return left | {"sa": right["sa"], "sb": right["sb"]}, seam


def _reduce(t: pa.Table) -> pa.Table:
    rows = sorted(t.select(["row", "seq", "cut", "pa", "pb", "sa", "sb"]).to_pylist(), key=lambda r: r["seq"])
    now, out = rows[0], []
    for r in rows[1:]:
        now, seam = compose(now, r)
        if seam:
            out.append({"row": r["row"], "seq": seam[0], "seam_a": seam[1], "seam_b": seam[2]})
    out.append(now | {"row": rows[0]["row"], "seq": rows[0]["seq"] // FAN})
    return pa.Table.from_pylist(out, schema=_REDUCED)


_INTS = pa.list_(pa.int32())
_REDUCED = pa.schema([("row", pa.int64()), ("seq", pa.int32()), ("cut", pa.int32())]
                     + [(c, _INTS) for c in ("pa", "pb", "sa", "sb", "seam_a", "seam_b")])


def _ends(batches):
    """The open ends of fragments."""
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            ends = {"row": r["row"], "seq": r["seq"], "cut": r["seq"] if r["ga"] else None}
            for p, s, tokens, group in (("pa", "sa", r["a"], r["ga"]), ("pb", "sb", r["b"], r["gb"])):
                ends |= {p: tokens[:group[0]], s: tokens[sum(group):]} if group else {p: tokens, s: []}
            out.append(ends)
        yield pa.RecordBatch.from_pylist(out, schema=pa.schema(list(_REDUCED)[:7]))


def seams(long: DataFrame) -> DataFrame:
    """(row, seq, seam_a, seam_b): the whole first group of every fragment that has a cut, from all before it.

    ``long``: the fragments of texts of several ranges.  Tree reduction: each round composes ``FAN`` neighbours.
    """
    most = long.agg(F.max("chunks")).first()[0] or 1
    ends = written(long.select("row", "seq", "a", "b", "ga", "gb").mapInArrow(_ends, OPEN), "open-ends")
    closed = []
    while most > 1:
        ends = written(ends.groupBy("row", F.floor(F.col("seq") / FAN).alias("of")).applyInArrow(_reduce, OPEN + SEAM), "open-ends")
        closed.append(ends.filter("seam_a is not null").select("row", "seq", "seam_a", "seam_b"))
        ends = ends.filter("seam_a is null").drop("seam_a", "seam_b")
        most = -(-most // FAN)
    # the text's start is a cut
    found = ends.filter("cut is not null").select(
        "row", F.col("cut").alias("seq"), F.col("pa").alias("seam_a"), F.col("pb").alias("seam_b"))
    for c in closed:
        found = found.unionByName(c)
    return found


def _digests(batches):
    """A text's digest from its fragments, which come one after the other: (row, groups_sha256)."""
    row, state, first = None, None, True
    for batch in batches:
        done = []
        for k in range(batch.num_rows):
            r = {c: batch.column(c)[k] for c in batch.schema.names}
            if r["row"].as_py() != row:
                if row is not None:
                    done.append((row, state.hexdigest()))
                row, state, first = r["row"].as_py(), hashlib.sha256(), True
            a, b, ga, gb = (np.array(r[c].values) for c in ("a", "b", "ga", "gb"))
            if len(ga):
                own = group_texts(a, b, ga, gb)
                own[0] = f"{','.join(map(str, r['seam_a'].as_py()))}|{','.join(map(str, r['seam_b'].as_py()))}"
                state.update((("" if first else ";") + ";".join(own)).encode())
                first = False
        if done:
            yield _digested(done)
    if row is not None:
        yield _digested([(row, state.hexdigest())])


def _digested(done) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r for r, _ in done], pa.int64()), pa.array([d for _, d in done], pa.string())],
                                      names=["row", "groups_sha256"])


# ---------------------------------------------------------------- link counts

def _scorer(own: list[str], kind: pa.Schema):
    """Per fragment of a block: the links that are their B id's best, and the sum of the links' counts."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        place = right["place"].to_numpy()
        count = np.zeros(len(place), dtype=np.int64)
        best = np.zeros(len(place), dtype=np.int64)
        count[place], best[place] = right["count"].to_numpy(), right["best"].to_numpy(zero_copy_only=False)
        column = left["links"].combine_chunks()
        size = np.concatenate(([0], np.cumsum(np.array(column.value_lengths().fill_null(0), dtype=np.int64))))
        at = column.flatten().to_numpy(zero_copy_only=False)
        known = size if len(count) else size * 0           # a block of texts that don't count has no answers
        at = at[:known[-1]]
        total = lambda x: np.diff(np.concatenate(([0], np.cumsum(x[at])))[known]) if len(at) else np.zeros(left.num_rows, np.int64)
        return left.select(own).append_column("n_best", pa.array(total(best), pa.int64())).append_column(
            "count_sum", pa.array(total(count), pa.int64())).cast(kind)

    return run


def align(df: DataFrame, a_path: str, b_path: str, id: str = "doc_id", text: str = "text",
          chunk: int = CHUNK, margin: int = MARGIN) -> DataFrame:
    """A row per row of ``df``: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    found = fragments(df, a_path, b_path, id, text, False, chunk, margin)
    long = found.filter("chunks > 1")
    # a text of several ranges counts if all of them do
    void = written(long.groupBy("row").agg(F.min("ok").alias("ok")).filter("not ok").select("row"), "void")

    counted = found.filter("pairs is not null").select("row", "chunks", "block", "pairs", "times")
    counted = counted.filter("chunks = 1").unionByName(
        counted.filter("chunks > 1").join(void, "row", "left_anti").select(counted.columns))
    pairs = counted.select("block", F.posexplode(F.arrays_zip("pairs", "times")).alias("place", "x")).select(
        "block", "place", F.col("x.pairs").alias("pair"), F.col("x.times").alias("n"))
    pairs = salted.with_salt(pairs, F.col("block"))
    totals = pairs.groupBy("pair", salted.SALT).agg(F.sum("n").alias("n")).groupBy("pair").agg(
        F.sum("n").alias("count"), F.collect_list(salted.SALT).alias("salts"))
    totals = written(totals.withColumn("b", F.col("pair").bitwiseAND(0xFFFFFFFF)), "pair-counts")
    top = totals.groupBy("b").agg(F.max("count").alias("top"))                 # at most one row per id of B
    totals = totals.join(top, "b").select("pair", "count", (F.col("count") == F.col("top")).cast("int").alias("best"),
                                          F.explode("salts").alias(salted.SALT))
    answers = pairs.join(totals, ["pair", salted.SALT]).select(
        F.col("block").alias("of"), "place", "count", "best")

    own = ["row", "id", "chunks", "ok", "n_a", "n_b", "n_groups", "groups_sha256"]
    types = dict(found.dtypes)
    kind = ", ".join(f"{c} {types[c]}" for c in own) + ", n_best long, count_sum long"
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    scored = found.select("block", "links", *own).groupBy("block").cogroup(answers.groupBy("of")).applyInArrow(
        _scorer(own, to_arrow_schema(StructType.fromDDL(kind))), kind)
    scored = written(scored, "scored")

    sums = ["n_a", "n_b", "n_groups", "n_best", "count_sum"]
    whole = scored.filter("chunks = 1").select("id", *sums, "groups_sha256")
    long = long.join(void, "row", "left_anti")
    parts = long.select("row", "seq", "a", "b", "ga", "gb").join(seams(long), ["row", "seq"], "left")
    digests = parts.repartition("row").sortWithinPartitions("row", "seq").mapInArrow(_digests, "row long, groups_sha256 string")
    pieces = scored.filter("chunks > 1").groupBy("row", "id").agg(*(F.sum(c).alias(c) for c in sums))
    pieces = pieces.join(digests, "row", "left").select(
        "id", *(F.when(F.col("groups_sha256").isNull(), 0).otherwise(F.col(c)).alias(c) for c in sums),
        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
    return whole.unionByName(pieces).select(
        F.col("id").alias(id), "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), "n_best", "count_sum", "groups_sha256")
