"""Near-duplicate groups: MinHash bands, odd sketches, and confirmation on full shingle sets.

1. Every text's set of shingles (runs of ``SHINGLE`` words; the whole sequence if
   shorter) gives ``BANDS`` x ``ROWS`` MinHash samples, an odd sketch and a digest.
   Sample i with value v flips bit hash(i, v) of the sketch's ``BITS`` bits, so that
   bits set twice vanish and the XOR of two sketches holds the samples that differ:
   from its population count follows how many, and so the similarity.
2. Texts with one digest are one set; its smallest id stands for it from here on.
3. Sets that share a band are candidates.  In ``STARS`` rounds, each over its share
   of the bands, a set is compared with two members of each of its bands unless it
   is linked to what they are linked to; that joins most of a group of copies, of
   any size, by two comparisons per member and band.  Sets that share a band and aren't joined
   then are compared with all others of the band, in blocks, by larger sketches: first
   a block gives the pairs of a forest that joins its sets by the most similar pairs,
   which leaves what is joined by any chain of copies as one; then, of sets that are
   apart still, a block gives its remaining pairs if they are few, and if not its
   sets are sent there and compared in place, giving a spanning forest of the links.
   So the rows that are made grow with the sets of a block, not with its pairs.
4. The sketches drop candidates whose estimate is so low that a similarity at the
   threshold is out of the question (``Sketch.most``); all others are confirmed or
   dropped by their full sets.

At a similarity of 0.8 a pair shares no band with probability
(1 - 0.8**ROWS)**BANDS, 2e-6 here.

Results: empty and null texts have no shingles and link with nothing.  Rows that
repeat an id with equal shingles are one document; if their shingles differ, each is linked
by its own.  A component's id is the smallest id in it.  A null id takes part in no link.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm import common as C
from strata.llm import salted
from strata.llm.components import components, written
from strata.llm.embedding_dedup import _roots
from strata.operators.bloom import flagged

SHINGLE = 4
SHARE = 80                       # percent of the union that two linked sets have in common, at least
ROWS, BANDS = 4, 25
STARS = 3
BLOCK = 1024                     # members of a band that are compared as one block

_rng = np.random.default_rng(104729)
_MULTIPLY = _rng.integers(1, 2**63, 1024, dtype=np.uint64) | np.uint64(1)
_ADD = _rng.integers(0, 2**63, 1024, dtype=np.uint64)


@dataclass(frozen=True)
class Sketch:
    """An odd sketch of ``samples`` MinHash samples in ``bits`` bits."""
    samples: int
    bits: int

    @property
    def most(self) -> int:
        """The largest XOR population count that is kept: six standard deviations above a pair at the threshold.

        Sets that differ in d samples are 2d coin flips apart, and each bit differs with (1 - exp(-4 d / bits)) / 2;
        d varies, and so do the bits.
        """
        apart = self.samples * (1 - SHARE / 100)
        same = np.exp(-4 * apart / self.bits)
        expected = self.bits * (1 - same) / 2
        by_samples = (2 * same) ** 2 * apart * SHARE / 100
        by_bits = expected * (1 + same) / 2
        return int(expected + 6 * (by_samples + by_bits) ** 0.5)


SMALL, LARGE = Sketch(ROWS * BANDS, 512), Sketch(1024, 2048)


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of each text's shingles, ascending and distinct within it; offsets)."""
    words = C.Words(C.ASCII_LOWER[data], offsets)
    h = words.hashes()
    runs = C.grams(h, SHINGLE)
    out, size = [], np.zeros(len(offsets) - 1, dtype=np.int64)
    for d in range(len(offsets) - 1):
        a, b = words.first[d], words.first[d + 1]
        if b - a >= SHINGLE:
            own = np.unique(runs[a:b - SHINGLE + 1])
        elif b > a:
            # the whole short sequence as one shingle; its length is part of it
            own = C.mix(C.grams(h[a:b], int(b - a)) + np.uint64(b - a))
        else:
            continue
        out.append(own)
        size[d] = len(own)
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), np.concatenate(([0], np.cumsum(size)))


def signatures(values: np.ndarray, offsets: np.ndarray, sketch: Sketch) -> tuple[np.ndarray, np.ndarray]:
    """(MinHash samples, odd sketches as bytes) of each set; rows of empty sets are zero."""
    n, k = len(offsets) - 1, sketch.samples
    samples = np.zeros((n, k), dtype=np.uint64)
    full = np.flatnonzero(np.diff(offsets) > 0)
    if len(full):
        for i in range(k):
            samples[full, i] = np.minimum.reduceat(values * _MULTIPLY[i] + _ADD[i], offsets[full])
    place = C.mix(samples + _ADD[k - 1::-1][:k][None, :]) % np.uint64(sketch.bits)
    parity = np.zeros((n, sketch.bits), dtype=np.uint8)
    np.bitwise_xor.at(parity, (np.arange(n)[:, None], place.astype(np.int64)), 1)
    parity[np.diff(offsets) == 0] = 0
    return samples, np.packbits(parity, axis=1)


def _digests(values: np.ndarray, offsets: np.ndarray) -> list[bytes | None]:
    import hashlib

    return [hashlib.blake2b(values[a:b].tobytes(), digest_size=16).digest() if b > a else None
            for a, b in zip(offsets[:-1], offsets[1:])]


_SKETCHED = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("text_sha", pa.binary()), ("n_shingles", pa.int64()), ("digest", pa.binary()),
                       ("sketch", pa.binary()), ("bands", pa.list_(pa.int64()))])


def sketch(docs: DataFrame) -> DataFrame:
    """doc_id, row number, text_sha, n_shingles, digest, sketch and band keys of each row (doc_id, text)."""
    def run(batches):
        for batch in batches:
            for part in C.slices([batch], "text"):
                values, offsets = shingles(*C.flat(part.column(1)))
                samples, parity = signatures(values, offsets, SMALL)
                grouped = samples.reshape(len(samples), BANDS, ROWS)
                key = C.mix(np.arange(BANDS, dtype=np.uint64)[None, :] + np.uint64(1))
                key = np.broadcast_to(key, grouped.shape[:2]).copy()
                for r in range(ROWS):
                    key = C.mix(key * np.uint64(0xD6E8FEB86659FD93) + grouped[:, :, r])
                keys = key.view(np.int64)
                size = np.diff(offsets)
                yield C.batch_of(_SKETCHED, doc_id=part.column(0), row=part.column(2), text_sha=part.column(3),
                                 n_shingles=size, digest=_digests(values, offsets), sketch=[p.tobytes() for p in parity],
                                 bands=[k.tolist() if n else [] for k, n in zip(keys, size)])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"),
                         F.monotonically_increasing_id().alias("row"), text_sha("text").alias("text_sha"))
    return source.mapInArrow(run, "doc_id long, row long, text_sha binary, n_shingles long, digest binary, "
                                  "sketch binary, bands array<long>")


def text_sha(text: str) -> Column:
    """What tells texts apart; null for a null text."""
    return F.unhex(F.sha2(F.col(text), 256))


def _maybe(df: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """``df`` without most of the rows whose ``key`` isn't in ``wanted``, so that a join after it moves little else."""
    return flagged(df, wanted, key, "__maybe").filter("__maybe").drop("__maybe")


def full_sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """id, members and large sketch of the sets in written ``ids`` (id, doc_id, text_sha); only their texts move, once."""
    def run(batches):
        for batch in batches:
            for part in C.slices([batch], "text"):
                values, offsets = shingles(*C.flat(part.column(1)))
                _, parity = signatures(values, offsets, LARGE)
                cut = pa.array(offsets * 8, type=pa.int64())
                sets = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1,
                                             [None, cut.buffers()[1], pa.py_buffer(values.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), sets.cast(pa.binary()), pa.array([p.tobytes() for p in parity])],
                    names=["id", "members", "sketch"])

    texts = _maybe(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ids, "doc_id")
    # rows that repeat an id and its text are one; the join needs no other exchange of the texts
    once = texts.withColumn("text_sha", text_sha("text")).groupBy("doc_id", "text_sha").agg(
        F.first(F.col("text").cast("binary")).alias("text"))
    return once.join(ids, ["doc_id", "text_sha"]).select("id", "text").mapInArrow(run, "id long, members binary, sketch binary")


def _paired(pairs: DataFrame, values: DataFrame, column: str) -> DataFrame:
    """a, b and ``column`` of both, of pairs (a, b)."""
    one = values.select(F.col("id").alias("a"), F.col(column).alias("x"))
    two = values.select(F.col("id").alias("b"), F.col(column).alias("y"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y")


def _alike(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of pairs (a, b) those that their small sketches don't rule out."""
    def keep(batches):
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint64).reshape(-1, SMALL.bits // 64)
                        for c in (2, 3))
                yield batch.select([0, 1]).filter(pa.array(np.bitwise_count(a ^ b).sum(axis=1) <= SMALL.most))

    return _paired(pairs, sets, "sketch").mapInArrow(keep, "a long, b long")


def confirm(pairs: DataFrame, sets: DataFrame, share: int = SHARE) -> DataFrame:
    """Of written, distinct pairs (a, b) those whose full sets (id, members) reach the share."""
    used = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    sets = _maybe(sets.select("id", "members"), used, "id")

    def check(batches):
        for batch in batches:
            good = np.zeros(batch.num_rows, dtype=bool)
            (one, first), (two, second) = C.flat(batch.column(2)), C.flat(batch.column(3))     # views: nothing is copied
            for i in range(batch.num_rows):
                x, y = one[first[i]:first[i + 1]].view(np.uint64), two[second[i]:second[i + 1]].view(np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                good[i] = 100 * both >= share * (len(x) + len(y) - both) and both > 0
            yield batch.select([0, 1]).filter(pa.array(good))

    return _paired(pairs, sets, "members").mapInArrow(check, "a long, b long")


def _labelled(member: DataFrame, label: DataFrame | None) -> DataFrame:
    """key, id, label of the members of bands."""
    if label is None:
        return member.select("key", "id", F.col("id").alias("label"))
    both = member.select("key", "id").join(label, "id", "left")
    return written(both.select("key", "id", F.coalesce("component", "id").alias("label")), "labelled")


def _mixed(labelled: DataFrame, *more: Column) -> DataFrame:
    """key and ``more`` aggregates of the bands that hold several labels."""
    return labelled.groupBy("key").agg(F.min("label").alias("l"), F.max("label").alias("h"), *more).filter("l < h").drop("l", "h")


def _least_linked(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id that each linked id is linked to, or itself."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("a")).alias("component"))


def _star(labelled: DataFrame, number: int) -> DataFrame:
    """Pairs (a, b) of each member with two members of its band that it isn't joined to."""
    own = F.struct(F.xxhash64(F.lit(number), "id").alias("h"), "id", "label") if number else F.struct("id", "label")
    ends = _mixed(labelled, F.min(own).alias("low"), F.max(own).alias("high"))
    return (labelled.join(ends, "key").select("id", "label", F.explode(F.array("low", "high")).alias("to"))
            .filter("label <> to.label")
            .select(F.least("id", "to.id").alias("a"), F.greatest("id", "to.id").alias("b")).distinct())


def _apart(labelled: DataFrame) -> DataFrame:
    """The members of bands that hold several labels still, and n, their band's members."""
    return labelled.join(_mixed(labelled, F.count("*").alias("n")), "key")


def _dealt(members: DataFrame, sketches: DataFrame) -> DataFrame:
    """Members (key, id, label, n) of bands in pairs of blocks: key, i, j, own (the member's block), id, label, sketch.

    A band's members are dealt to blocks of about ``BLOCK``; each pair of blocks is a group of its own, so that no
    task needs more than two blocks.
    """
    dealt = members.withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")).withColumn(
        "own", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    dealt = dealt.join(sketches, "id")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return dealt.withColumn("other", other).select(
        "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "id", "label", "sketch")


def _grouped(dealt: DataFrame, fn, schema: str) -> DataFrame:
    """``fn`` over the rows of each (key, i, j), one group in memory at a time; it gives a record batch."""
    names = dealt.columns

    def run(batches):
        kept, now = [], None
        for batch in batches:
            keys = [batch.column(c).to_numpy() for c in range(3)]
            cut = np.flatnonzero(np.any([np.diff(k) != 0 for k in keys], axis=0)) + 1 if batch.num_rows else []
            for a, b in zip([0, *cut], [*cut, batch.num_rows]):
                if a == b:
                    continue
                key = tuple(int(k[a]) for k in keys)
                if key != now and kept:
                    yield fn(pa.Table.from_batches(kept).combine_chunks())
                    kept = []
                now = key
                kept.append(batch.slice(int(a), int(b - a)))
        if kept:
            yield fn(pa.Table.from_batches(kept).combine_chunks())

    return dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").select(*names).mapInArrow(run, schema)


def _candidates(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ids, a, b, distance): the group's pairs of other labels that their large sketches don't rule out."""
    own, ids, labels = (t[c].to_numpy() for c in ("own", "id", "label"))
    bits = np.frombuffer(b"".join(t["sketch"].to_pylist()), np.uint64).reshape(len(ids), -1)
    i, j = t["i"][0].as_py(), t["j"][0].as_py()
    left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
    found = [(np.zeros(0, np.int64),) * 3]
    for at in left.tolist():
        to = right[right > at] if i == j else right
        to = to[labels[to] != labels[at]]
        apart = np.bitwise_count(bits[to] ^ bits[at]).sum(axis=1, dtype=np.int64)
        near = apart <= LARGE.most
        found.append((np.full(int(near.sum()), at), to[near], apart[near]))
    return ids, *(np.concatenate(x) for x in zip(*found))


def _forest(t: pa.Table) -> pa.RecordBatch:
    """Pairs that join the group's labels wherever candidates do, by the most similar ones (rounds of Boruvka)."""
    ids, a, b, apart = _candidates(t)
    _, comp = np.unique(t["label"].to_numpy(), return_inverse=True)
    n = int(comp.max()) + 1
    rank = np.empty(len(a), dtype=np.int64)
    rank[np.lexsort((b, a, apart))] = np.arange(len(a))
    out, now = [], np.arange(n)
    while True:
        x, y = now[comp[a]], now[comp[b]]
        open_ = np.flatnonzero(x != y)
        if not len(open_):
            break
        best = np.full(n, len(a))
        np.minimum.at(best, x[open_], rank[open_])
        np.minimum.at(best, y[open_], rank[open_])
        by_rank = np.empty(len(a), dtype=np.int64)
        by_rank[rank] = np.arange(len(a))
        chosen = by_rank[np.unique(best[best < len(a)])]
        out.append(chosen)
        now = _roots(n, x[chosen], y[chosen])[now]
    at = np.concatenate(out or [np.zeros(0, np.int64)])
    p, q = ids[a[at]], ids[b[at]]
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(p, q)), pa.array(np.maximum(p, q))], names=["a", "b"])


#: a group's pairs are emitted while they are no more than so many times its members
FEW = 4


def _rest(few: int):
    """The group's pairs (a, b) if they are few; else its members that have one (a, with a null b), and the group."""
    def run(t: pa.Table) -> pa.RecordBatch:
        ids, a, b, _ = _candidates(t)
        if len(a) <= few * len(ids):
            p, q, own = np.minimum(ids[a], ids[b]), np.maximum(ids[a], ids[b]), np.zeros(len(a), np.int32)
            none = np.zeros(len(a), bool)
        else:
            at = np.unique(np.concatenate((a, b)))
            p, q, own = ids[at], ids[at], t["own"].to_numpy()[at].astype(np.int32)
            none = np.ones(len(at), bool)
        same = lambda c, kind: pa.array(np.full(len(p), t[c][0].as_py()), kind)
        return pa.RecordBatch.from_arrays(
            [pa.array(p), pa.array(q, mask=none), same("key", pa.int64()), same("i", pa.int32()), same("j", pa.int32()),
             pa.array(own)], names=["a", "b", "key", "i", "j", "own"])

    return run


def _in_place(share: int):
    """Links within a group by full sets: a spanning forest of them."""
    def run(t: pa.Table) -> pa.RecordBatch:
        ids, own = t["id"].to_numpy(), t["own"].to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in t["members"].to_pylist()]
        size = np.array([len(x) for x in sets], dtype=np.int64)
        owner = np.repeat(np.arange(len(sets), dtype=np.int32), size)
        flat = np.concatenate(sets)
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
        first = np.flatnonzero(np.concatenate(([True], flat[1:] != flat[:-1])))
        times = np.diff(np.concatenate((first, [len(flat)])))
        column = np.repeat(np.arange(len(first)), times)
        shared = np.repeat(times > 1, times)                       # a shingle of one member adds to no pair
        owner, column = owner[shared], np.unique(column[shared], return_inverse=True)[1]
        both = np.zeros((len(sets), len(sets)), dtype=np.float32)   # counts below 2**24 are exact
        lead = np.searchsorted(column, np.arange(0, (int(column[-1]) if len(column) else -1) + 1 + STEP, STEP))
        for a, b in zip(lead[:-1], lead[1:]):
            if a < b:
                holds = np.zeros((len(sets), STEP), dtype=np.float32)
                holds[owner[a:b], column[a:b] - column[a] // STEP * STEP] = 1
                both += holds @ holds.T
        i, j = t["i"][0].as_py(), t["j"][0].as_py()
        whole = both.astype(np.int64)
        linked = (100 * whole >= share * (size[:, None] + size[None, :] - whole)) & (whole > 0)
        x, y = np.nonzero(np.triu(linked, 1))
        meet = ((own[x] == i) & (own[y] == j)) | ((own[x] == j) & (own[y] == i))
        root = _roots(len(ids), x[meet], y[meet])
        child = np.flatnonzero(root != np.arange(len(ids)))
        return pa.RecordBatch.from_arrays([pa.array(ids[root[child]]), pa.array(ids[child])], names=["a", "b"])

    return run


STEP = 4096


def near_groups(docs: DataFrame, few: int = FEW) -> DataFrame:
    """doc_id, n_shingles, component_id, text_sha and first of each row of ``docs`` (doc_id, text).

    ``first`` marks the rows that stand for their component: those of its smallest id, of one text if that id has several.
    Rows that link with nothing are all first, repeated ones too.
    """
    rows = written(sketch(docs), "sketched")
    full = salted.with_salt(rows.filter("n_shingles > 0 and doc_id is not null"), F.col("row"))
    # equal sets are one; ``least`` is its smallest id and the text that stands for it
    groups = written(salted.totals(
        full, ["digest"], [F.min("row").alias("id"), F.min(F.struct("doc_id", "text_sha")).alias("least")],
        [F.min("id").alias("id"), F.min("least").alias("least")]), "sets-by-digest")
    distinct = groups.select("id", "digest", "least").distinct()
    sets = written(full.join(distinct.select("id"), full["row"] == distinct["id"]).select("id", "doc_id", "text_sha", "sketch", "bands"),
                   "distinct-sets")
    banded = sets.select("id", F.posexplode("bands").alias("band", "key"))
    shared = banded.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high")).filter("low < high").select("key")
    member = written(banded.join(shared, "key").select("key", "band", "id"), "band-members")
    in_bands = written(sets.select("id", "doc_id", "text_sha").join(member.select("id").distinct(), "id", "left_semi"), "sets-in-bands")
    full_set = written(full_sets(docs, in_bands), "full-sets")
    links = tried = label = None
    for number in range(STARS):
        own = member.filter(F.col("band") % STARS == number)
        pairs = _star(_labelled(own, label), number)
        pairs = written(_alike(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"), sets), "star-pairs")
        tried = pairs if tried is None else tried.unionByName(pairs)
        more = written(confirm(pairs, full_set), "links")
        links = more if links is None else links.unionByName(more)
        label = _least_linked(links)
    # bands that hold several labels still: a forest of the most similar pairs, then what is left
    sketches = full_set.select("id", "sketch")
    pairs = _grouped(_dealt(_apart(_labelled(member, label)), sketches), _forest, "a long, b long").distinct()
    pairs = written(pairs.join(tried, ["a", "b"], "left_anti"), "forest-pairs")
    tried = tried.unionByName(pairs)
    label = components(links.unionByName(confirm(pairs, full_set)))
    rest = written(_grouped(_dealt(_apart(_labelled(member, label)), sketches), _rest(few),
                            "a long, b long, key long, i int, j int, own int"), "rest")
    few = confirm(written(rest.filter("b is not null").select("a", "b").distinct().join(tried, ["a", "b"], "left_anti"),
                          "last-pairs"), full_set)
    many = rest.filter("b is null").select("key", "i", "j", "own", F.col("a").alias("id"))
    many = many.join(_maybe(full_set.select("id", "members"), many, "id"), "id").select("key", "i", "j", "own", "id", "members")
    many = _grouped(many, _in_place(SHARE), "a long, b long")
    known = label.select(F.col("id").alias("a"), F.col("component").alias("b"))
    final = components(known.unionByName(few).unionByName(many))

    found = distinct.select("id", "least").join(final, "id", "left").select(
        "id", "least", F.coalesce("component", "id").alias("component"))
    found = salted.with_salt(written(found, "components"), F.col("id"))
    least = salted.totals(found, ["component"], [F.min("least").alias("top")], [F.min("top").alias("top")])
    found = found.join(least, ["component", salted.SALT]).select("id", "top")
    found = groups.select("digest", salted.SALT, "id").join(found, "id").drop("id")
    linked = full.select("doc_id", "n_shingles", "text_sha", "digest", salted.SALT).join(found, ["digest", salted.SALT]).select(
        "doc_id", "n_shingles", F.col("top.doc_id").alias("component_id"), "text_sha",
        ((F.col("doc_id") == F.col("top.doc_id")) & (F.col("text_sha") == F.col("top.text_sha"))).alias("first"))
    return linked.unionByName(rows.filter("n_shingles = 0 or doc_id is null").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "text_sha", F.lit(True).alias("first")))
