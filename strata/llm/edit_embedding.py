"""Document fingerprints by a randomised edit embedding.

A shared random walk reads a text: at step j it stands on some character,
writes it down, and moves on if the random bit of (j, character) says so.  All
texts use the same bits, so texts with a few edits fall into step again soon
after each edit, and their edit distance shows as Hamming distance between what
they wrote.  Many walks run side by side in numpy, a step at a time.

The fingerprint samples what was written at ``SAMPLES`` steps.  Which steps,
follows from the number of steps alone: sample k has a fixed ascending
sequence of steps (each next one where a running minimum of random numbers
would fall, so that the last one of a walk is uniform over it), and the last
that the walk made counts.  Walks of alike length thus sample the same steps.
Each sample is four bits, a hash of step and character.  Likeness is the share
of equal samples, less what chance gives.

Near documents: bands of sampled fingerprint positions give candidates, and
likeness of at least ``near`` of two fingerprints links them.  In ``STARS``
rounds, each over its share of the bands, a fingerprint is compared with two
members of each of its bands; members of a band that aren't joined then are
compared with all others of the band, in blocks.  ``near_id`` is the smallest
id of the component.

Results: null and empty text have the fingerprint of no steps (all zero);
equal texts have equal fingerprints.  Walks read whole texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm import common as C
from strata.llm import near_dedup
from strata.llm.components import components, written
from strata.session import scratch_path

SAMPLES = 128
WAVE = 8 << 20            # characters that walk together
BLOCK = 2048              # steps whose random bits are drawn together
BANDS, BAND_SAMPLES = 16, 8
STARS = 4
BLOCK_MEMBERS = 4096      # members of a band that are compared as one block
SEED = 7919

_records: list[np.ndarray] | None = None
_bits: dict[int, np.ndarray] = {}


def sample_steps() -> tuple[np.ndarray, np.ndarray]:
    """(steps, samples) of all sample sequences up to 2**40 steps, ascending by step."""
    global _records
    if _records is None:
        rng = np.random.default_rng(SEED)
        found = []
        for k in range(SAMPLES):
            step = 0
            while step < 1 << 40:
                found.append((step, k))
                step = int((step + 1) / rng.random()) if step < 1 << 50 else step
        found.sort()
        _records = [np.array([f[0] for f in found]), np.array([f[1] for f in found])]
    return _records[0], _records[1]


def moves(block: int) -> np.ndarray:
    """Bits of the steps of one block, by step and character class; class 255 ends a text and never moves."""
    out = _bits.get(block)
    if out is None:
        out = np.random.default_rng([SEED, block]).integers(0, 2, (BLOCK, 256), dtype=np.int64)
        out[:, 255] = 0
        if len(_bits) < 64:
            _bits[block] = out
    return out


def classes(text: str) -> np.ndarray:
    """A class of 0..254 for each code point."""
    points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    return ((points ^ (points >> 7) * np.uint32(37)) % np.uint32(255)).astype(np.uint8)


def embed(texts: list[np.ndarray]) -> np.ndarray:
    """Samples (values 0..15) of each text given as classes; one row per text."""
    out = np.zeros((len(texts), SAMPLES), dtype=np.uint8)
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    at = 0
    while at < len(order):
        total, to = 0, at
        while to < len(order) and (to == at or total + len(texts[order[to]]) < WAVE):
            total += len(texts[order[to]]) + 1
            to += 1
        _walk(texts, order[at:to], out)
        at = to
    return out


def _walk(texts: list[np.ndarray], rows: list[int], out: np.ndarray) -> None:
    size = np.array([len(texts[r]) for r in rows])
    end = np.cumsum(size + 1) - 1
    flat = np.full(int(end[-1]) + 1, 255, dtype=np.uint8)
    for r, e, n in zip(rows, end, size):
        flat[e - n:e] = texts[r]
    live = np.flatnonzero(size > 0)
    rows_of = np.array(rows)
    place = (end - size)[live]
    steps, samples = sample_steps()
    step = record = 0
    while len(live):
        bits = moves(step // BLOCK)
        here, move = np.empty(len(live), np.uint8), np.empty(len(live), np.int64)
        for j in range(BLOCK):
            np.take(flat, place, out=here)
            if steps[record] == step + j:
                going = here != 255
                who, seen = rows_of[live[going]], here[going]
                while steps[record] == step + j:
                    k = int(samples[record])
                    out[who, k] = (C.mix(seen.astype(np.uint64) + np.uint64((step + j) * 256)) >> np.uint64(60))
                    record += 1
            np.take(bits[j], here, out=move, mode="clip")
            place += move
        step += BLOCK
        going = flat[place] != 255
        live, place = live[going], place[going]


def as_text(samples: np.ndarray) -> list[str]:
    """Lower-case hexadecimal, one digit per sample."""
    packed = (samples[:, 0::2] << 4 | samples[:, 1::2]).astype(np.uint8)
    return [row.tobytes().hex() for row in packed]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """0 to 1, of samples row by row."""
    same = (a == b).mean(axis=1)
    return np.clip((same - 1 / 16) / (15 / 16), 0.0, 1.0)


def fingerprint(df: DataFrame, keep: list[str], text: str = "text", out: str = "fingerprint") -> DataFrame:
    """Columns ``keep`` with each text's fingerprint."""
    keep = C.without(df.select(*keep), [out]).columns
    fields = C.types_of(df.select(*keep))
    n, own = len(keep), C.free_name(df)

    def run(batches):
        for batch in batches:
            for part in C.slices([batch], own, WAVE):
                marks = embed([classes(t or "") for t in part.column(n).to_pylist()])
                yield pa.RecordBatch.from_arrays(part.columns[:n] + [pa.array(as_text(marks))], names=[*keep, out])

    return df.select(*keep, F.col(text).alias(own)).mapInArrow(run, f"{fields}, `{out}` string")


# ------------------------------------------------------------------ a document, its edit and its neighbour

def edited(text: str, next_text: str) -> str:
    """The last half of the code points (rounded down) gives way to the first as many of the next text."""
    half = len(text) // 2
    return text[:len(text) - half] + next_text[:half]


_RESULT = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
    ("part", pa.int32()), ("edge", pa.string()), ("text", pa.string())])
_RESULT_TYPES = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                 "near_edited double, near_next double, part int, edge string, text string")


def _compare(ids: list, texts: list[str], following: list[str], next_marks: np.ndarray | None = None,
             marks: np.ndarray | None = None) -> dict[str, list]:
    import hashlib

    n = len(ids)
    changed = [edited(a, b) for a, b in zip(texts, following)]
    todo = [classes(t) for t in changed]
    if marks is None:
        todo += [classes(t) for t in texts] + [classes(t) for t in following]
    found = embed(todo)
    if marks is None:
        marks, next_marks = found[n:2 * n], found[2 * n:]
    new = found[:n]
    return {"doc_id": ids, "n_chars": [len(t) for t in texts],
            "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in changed],
            "fingerprint": as_text(marks), "edited_fingerprint": as_text(new),
            "near_edited": likeness(marks, new).tolist(), "near_next": likeness(marks, next_marks).tolist()}


def _batch(found: dict[str, list], **more) -> pa.RecordBatch:
    n = len(next(iter({**found, **more}.values())))
    columns = {**found, **more}
    return pa.RecordBatch.from_arrays(
        [pa.array(columns.get(f.name, [None] * n), type=f.type) for f in _RESULT], schema=_RESULT)


def compare_neighbours(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document with its fingerprint, that of its edit by the next document, and both likenesses.

    Documents follow one another by descending id (null ids last, equal ids by
    text hash) and the first follows the last.  They are sorted by range; a task
    sees each document and the next, and only the first and last document of
    every task are matched up afterwards.
    """
    spark = df.sparkSession
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text")]
    source = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        first = held = None
        for batch in batches:
            for piece in C.slices([batch], "text", WAVE // 2):
                ids, texts = piece.column(0).to_pylist(), piece.column(1).to_pylist()
                marks = embed([classes(t) for t in texts])
                if first is None:
                    first = (ids[0], texts[0])
                else:
                    ids, texts, marks = [held[0], *ids], [held[1], *texts], np.concatenate((held[2], marks))
                held = (ids[-1], texts[-1], marks[-1:])
                if len(ids) > 1:
                    yield _batch(_compare(ids[:-1], texts[:-1], texts[1:], marks[1:], marks[:-1]))
        if first is not None:
            yield _batch({}, doc_id=[first[0], held[0]], part=[part, part], edge=["first", "last"],
                         text=[first[1], held[1]])

    path = scratch_path(spark, "neighbours")
    (source.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, _RESULT_TYPES)
     .write.parquet(path))
    done = spark.read.schema(T.StructType.fromDDL(_RESULT_TYPES)).parquet(path)

    # the order of the tasks that had rows: as many rows as tasks, without texts
    edges = done.filter("edge is not null")
    parts = [r.part for r in edges.filter("edge = 'first'").select("part").sort("part").collect()]
    following = {p: parts[(i + 1) % len(parts)] for i, p in enumerate(parts)}
    after = spark.createDataFrame(list(following.items()) or [(-1, -1)], "part int, next_part int")
    last = edges.filter("edge = 'last'").select("doc_id", "text", "part").join(F.broadcast(after), "part")
    nexts = edges.filter("edge = 'first'").select(F.col("part").alias("next_part"), F.col("text").alias("next_text"))

    def finish(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                ids, texts, nexts = (batch.column(c).slice(i, 1).to_pylist() for c in range(3))
                yield _batch(_compare(ids, texts, nexts))

    matched = last.join(nexts, "next_part").select("doc_id", "text", "next_text").mapInArrow(finish, _RESULT_TYPES)
    columns = _RESULT.names[:7]
    return done.filter("edge is null").select(*columns).unionByName(matched.select(*columns))


# ------------------------------------------------------------------ banding and verification

def band_places() -> list[list[int]]:
    rng = np.random.default_rng(SEED + 1)
    return [sorted(rng.choice(SAMPLES, BAND_SAMPLES, replace=False).tolist()) for _ in range(BANDS)]


def near_documents(marks: DataFrame, near: float = 0.8) -> DataFrame:
    """(fingerprint, near_id) of each fingerprint: the smallest id of its component.

    ``marks`` has doc_id and fingerprint.  Equal fingerprints are one, with their
    smallest id.  Two that share a band and are alike by at least ``near`` are
    linked; every such pair is compared, unless it is in one component already.
    """
    spark = marks.sparkSession
    one = marks.groupBy("fingerprint").agg(F.min("doc_id").alias("id"))
    one = written(one.withColumn("node", F.monotonically_increasing_id()), "fingerprints")
    values = one.select(F.col("node").alias("id"), F.unhex("fingerprint").alias("mark"))
    links = spark.createDataFrame([], "a long, b long")
    label = spark.createDataFrame([], "id long, component long")
    for number in range(STARS):
        pairs = _star(_banded(one, label, range(number, BANDS, STARS)), number)
        links = links.unionByName(written(_alike(near_dedup._paired(pairs, values, "mark"), near), "links"))
        label = written(near_dedup._least_linked(links), "star-labels")
    # bands that hold several components still: their members are compared across
    label = written(components(links), "star-components")
    left = written(_mixed(_banded(one, label, range(BANDS))), "mixed-members")
    more = written(_across(left.join(values.withColumnRenamed("id", "node"), "node"), near), "across")
    final = written(components(links.unionByName(more)), "components")
    known = one.join(final.withColumnRenamed("id", "node"), "node", "left").select(
        "fingerprint", "id", F.coalesce("component", "node").alias("component"))
    least = known.groupBy("component").agg(F.min("id").alias("near_id"))
    return known.join(least, "component").select("fingerprint", "near_id")


def _banded(one: DataFrame, label: DataFrame, bands: range) -> DataFrame:
    """key, node, label of each fingerprint in each of ``bands``; a key is the band and its samples."""
    places = band_places()
    key = lambda b: F.conv(F.concat(*[F.substring("fingerprint", p + 1, 1) for p in places[b]]), 16, 10)
    keys = F.array(*[key(b).cast("long") + F.lit(b << 4 * BAND_SAMPLES) for b in bands])
    return (one.join(label.withColumnRenamed("id", "node"), "node", "left")
            .select("node", F.coalesce("component", "node").alias("label"), F.explode(keys).alias("key")))


def _mixed(member: DataFrame) -> DataFrame:
    """The members of bands that hold several labels, with the band's size."""
    several = member.groupBy("key").agg(F.min("label").alias("l"), F.max("label").alias("h"), F.count("*").alias("n"))
    return member.join(written(several.filter("l < h").select("key", "n"), "mixed-bands"), "key")


def _star(member: DataFrame, number: int) -> DataFrame:
    """Pairs (a, b) of each member with two members of its band that have other labels."""
    own = F.struct(F.xxhash64(F.lit(number), "node").alias("h"), "node", "label")
    ends = member.groupBy("key").agg(F.min(own).alias("low"), F.max(own).alias("high")).filter("low.node <> high.node")
    return (member.join(written(ends, "star-centres"), "key")
            .select("node", "label", F.explode(F.array("low", "high")).alias("to")).filter("label <> to.label")
            .select(F.least("node", "to.node").alias("a"), F.greatest("node", "to.node").alias("b")).distinct())


def _unpacked(marks: list[bytes]) -> np.ndarray:
    packed = np.frombuffer(b"".join(marks), dtype=np.uint8).reshape(-1, SAMPLES // 2)
    out = np.empty((len(packed), SAMPLES), dtype=np.uint8)
    out[:, 0::2], out[:, 1::2] = packed >> 4, packed & 15
    return out


def _alike(pairs: DataFrame, near: float) -> DataFrame:
    """Of pairs (a, b, x, y) those whose fingerprints x and y are alike."""
    def verify(batches):
        for batch in batches:
            if batch.num_rows:
                x, y = (_unpacked(batch.column(c).to_pylist()) for c in (2, 3))
                yield batch.select([0, 1]).filter(pa.array(likeness(x, y) >= near))

    return pairs.mapInArrow(verify, "a long, b long")


def join_unlike(nodes: np.ndarray, labels: np.ndarray, marks: np.ndarray, left: np.ndarray, right: np.ndarray,
                near: float) -> tuple[list[int], list[int]]:
    """Links (a, b) that join all labels with a pair of ``left`` x ``right`` that is alike, one link for each join."""
    labels = labels.copy()
    a, b = [], []
    for at in left.tolist():
        to = right[labels[right] != labels[at]]
        to = to[likeness(marks[to], marks[at][None]) >= near]
        joined, first = np.unique(labels[to], return_index=True)
        if len(joined):
            a += [int(nodes[at])] * len(joined)
            b += nodes[to[first]].tolist()
            labels[np.isin(labels, joined)] = labels[at]
    return a, b


def _across(members: DataFrame, near: float) -> DataFrame:
    """Links (a, b) between labels of one band, from all pairs of its members.

    ``members`` has key, node, label, n, mark.  A band's members are dealt to blocks of about ``BLOCK_MEMBERS``;
    each pair of blocks is a group of its own, so that no task needs more than two blocks at a time.
    """
    blocks = F.ceil(F.col("n") / BLOCK_MEMBERS).cast("int")
    dealt = members.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = dealt.withColumn("other", other).select(
        "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "label", "mark")

    def links(key, rows):
        own, nodes, labels = (np.array([r[c] for r in rows], dtype=np.int64) for c in (3, 4, 5))
        left, right = np.flatnonzero(own == key[1]), np.flatnonzero(own == key[2])
        a, b = join_unlike(nodes, labels, _unpacked([r[6] for r in rows]), left, right, near)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    def run(batches):
        """Rows come sorted by group; one group is held at a time."""
        now, rows = None, []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in range(7))):
                if row[:3] != now:
                    if rows:
                        yield links(now, rows)
                    now, rows = row[:3], []
                rows.append(row)
        if rows:
            yield links(now, rows)

    return (dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
            .mapInArrow(run, "a long, b long").distinct())
