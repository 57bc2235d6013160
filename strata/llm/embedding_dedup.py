"""Near-duplicate embeddings by randomised-rotation binary codes.

A vector's code is the signs of its coordinates after random rotations.  Stored
with it are the correction factor (the inner product of the code, as a vector,
with the rotated unit vector) and the error it implies: the inner product of a
rotated query with the code, divided by the factor, is an unbiased estimate of
the cosine, and for a pair at the threshold it is off by more than the error
with probability 2e-9.  Only pairs whose estimate comes that close to the
threshold are computed exactly, in double precision.

Which vectors meet: equal vectors are one node first.  Nodes of one label (and
length) meet in blocks; a label with more than ``WHOLE`` nodes is first parted by bands
of sign bits, so many that a pair at the threshold shares none with probability
``MISS`` at most.  A bucket with more than ``BLOCK`` members is split into parts
by hash, every two of which meet in a task of their own, so no task holds more
than two parts.  A pair counts in the first band that it shares; each block
gives its members' link counts and the edges of a spanning forest, never pairs.
The number of links is exact, so a family of m different vectors that are all
alike costs m * m / 2 estimates, in numpy.

Results: vectors that are null, empty, zero or hold null or non-finite
components, or whose label is null, link with nothing.  So do vectors of
different lengths.  Equal vectors of a label are linked.  Every row counts,
repeated ones too: each is linked with the others.  Rows with a null id count
as links, but a component's id is its smallest that is not null.  An empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import common as C
from strata.llm import salted
from strata.llm.components import components, written

SEED = 20240518
MISS = 1e-6
DEVIATIONS = 6.0
CODE_BITS = 128
BLOCK = 2048
WHOLE = 16384
#: labels whose sizes are known to every task; smaller ones are taken for as large as the next
KNOWN_LABELS = 1000

_rotations: dict[tuple[int, int], np.ndarray] = {}


def rotation(dim: int, bits: int) -> np.ndarray:
    """Random rotations one below the other: (rows, dim), at least ``bits`` rows and a multiple of ``dim``."""
    times = max(1, -(-bits // dim))
    if (dim, times) not in _rotations:
        rng = np.random.default_rng([SEED, dim])
        own = []
        for _ in range(times):
            q, r = np.linalg.qr(rng.standard_normal((dim, dim)))
            own.append((q * np.sign(np.diag(r))).T)
        _rotations[dim, times] = np.concatenate(own)
    return _rotations[dim, times]


def bands(members: int, threshold: float, whole: int = WHOLE, block: int = BLOCK) -> tuple[int, int]:
    """(bits of a band, number of bands) for a label with ``members`` vectors."""
    if members <= whole:
        return 0, 1
    bits = max(4, math.ceil(math.log2(members / block)))
    share = (1 - math.acos(threshold) / math.pi) ** bits       # of pairs at the threshold agree in a band
    return bits, math.ceil(math.log(MISS) / math.log1p(-share))


def units(vectors: np.ndarray) -> np.ndarray:
    """Vectors as double-precision unit vectors."""
    v = vectors.astype(np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)               # no square overflows
    return v / np.sqrt(np.einsum("ij,ij->i", v, v))[:, None]


def encode(unit: np.ndarray, bits: int = CODE_BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(signs, correction factor, error) of unit vectors."""
    dim = unit.shape[1]
    turned = unit @ rotation(dim, bits).T
    factor = np.abs(turned).reshape(len(unit), -1, dim).sum(axis=2) / math.sqrt(dim)       # one per rotation
    error = DEVIATIONS * np.sqrt(np.maximum(0, 1 - factor ** 2).sum(axis=1) / max(1, dim - 1)) / factor.sum(axis=1)
    return turned >= 0, factor.sum(axis=1), error


def estimates(queries: np.ndarray, signs: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """Unbiased estimates of the inner products of unit vectors with coded ones: (queries, coded)."""
    dim = queries.shape[1]
    turned = (queries @ rotation(dim, signs.shape[1]).T).astype(np.float32)
    code = np.where(signs, np.float32(1), np.float32(-1))
    return (turned @ code.T) / (factor * math.sqrt(dim)).astype(np.float32)


def lower_limit(threshold: float, error: np.ndarray) -> np.ndarray:
    """An estimate below this is of a pair below the threshold."""
    return threshold - math.sqrt(1 - threshold ** 2) * error


NODE = "node long, label string, dim int, wide int, vec binary, code binary, factor double, error double, n long"


def _prepare(batches):
    """(row, id, label, key, dim, wide, vec) of rows; key and vec are null where a row links with nothing."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index("embedding"))
        wide = column.type.value_type.bit_width // 8
        values = column.values.to_numpy(zero_copy_only=False)          # a null component is NaN
        offsets = column.offsets.to_numpy()
        some = np.array(column.is_valid())
        labels = batch.column(batch.schema.get_field_index("label")).to_pylist()
        key, dim, vec = [], [], []
        for k, label in enumerate(labels):
            own = values[offsets[k]:offsets[k + 1]]
            if not some[k] or label is None or not len(own) or not np.isfinite(own).all() or not own.any():
                key.append(None), dim.append(0), vec.append(None)
            else:
                body = own.tobytes()
                key.append(hashlib.blake2b(body, digest_size=16, key=hashlib.sha256(label.encode()).digest()).digest())
                dim.append(len(own)), vec.append(body)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(2), pa.array(key, pa.binary()), pa.array(dim, pa.int32()),
             pa.array(np.full(len(key), wide), pa.int32()), pa.array(vec, pa.binary())],
            names=["row", "id", "label", "key", "dim", "wide", "vec"])


def _matrix(vec: pa.Array, dim: int, wide: int) -> np.ndarray:
    return C.flat(vec)[0].view(np.float32 if wide == 4 else np.float64).reshape(-1, dim)


def _coder(bits_of: dict[str, tuple[int, int]], others: tuple[int, int]):
    """Adds code, factor, error and the band keys (an array) to nodes."""
    def run(batches):
        for batch in batches:
            t = pa.Table.from_batches([batch])
            for (dim, wide) in sorted({(d, w) for d, w in zip(t["dim"].to_pylist(), t["wide"].to_pylist())}):
                own = t.filter(pc.and_(pc.equal(t["dim"], dim), pc.equal(t["wide"], wide)))
                unit = units(_matrix(own["vec"].combine_chunks(), dim, wide))
                signs, factor, error = encode(unit)
                plans = [bits_of.get(x, others) for x in own["label"].to_pylist()]
                keys: list = [[0]] * len(unit)
                for bits, count in set(plans) - {(0, 1)}:
                    at = np.array([k for k, p in enumerate(plans) if p == (bits, count)])
                    # other rotations than the codes', so that bands and estimates miss independently
                    turned = unit[at] @ rotation(dim, CODE_BITS + dim + bits * count)[-bits * count:].T >= 0
                    found = turned.reshape(len(at), count, bits) @ (1 << np.arange(bits))
                    for k, f in zip(at.tolist(), found.tolist()):
                        keys[k] = f
                packed = np.packbits(signs, axis=1)
                yield from own.select(["node", "label", "dim", "wide", "vec"]).append_column(
                    "code", pa.array([p.tobytes() for p in packed], pa.binary())).append_column(
                    "factor", pa.array(factor)).append_column("error", pa.array(error)).append_column(
                    "n", own["n"]).append_column("keys", pa.array(keys, pa.list_(pa.int32()))).to_batches()

    return run


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest place reachable from each of ``n`` by the links (a, b)."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], least)
        np.minimum.at(new, root[b], least)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


LINK = "a long, b long, n long"


def _linker(threshold: float):
    """Links within a block, or between its two parts: link counts (b null) and spanning edges."""
    def run(t: pa.Table) -> pa.Table:
        first = {c: t[c][0].as_py() for c in ("dim", "wide", "lo", "hi", "band")}
        node, n, part = (t[c].to_numpy() for c in ("node", "n", "part"))
        unit = units(_matrix(t["vec"].combine_chunks(), first["dim"], first["wide"]))
        code = np.frombuffer(b"".join(t["code"].to_pylist()), dtype=np.uint8).reshape(len(node), -1)
        bits = rotation(first["dim"], CODE_BITS).shape[0]
        signs = np.unpackbits(code, axis=1, count=bits).astype(bool)
        factor = t["factor"].to_numpy()
        limit = lower_limit(threshold, t["error"].to_numpy()).astype(np.float32)
        keys = t["keys"].combine_chunks().flatten().to_numpy().reshape(len(node), -1)[:, :first["band"]]
        inner = first["lo"] == first["hi"]
        ask = np.arange(len(node)) if inner else np.flatnonzero(part == first["lo"])
        told = ask if inner else np.flatnonzero(part == first["hi"])
        gained = np.zeros(len(node), dtype=np.int64)
        left, right = [], []
        for at in range(0, len(ask), 512):
            q = ask[at:at + 512]
            close = estimates(unit[q], signs[told], factor[told]) >= limit[told]
            i, j = np.nonzero(close)
            i, j = q[i], told[j]
            if inner:
                i, j = i[i < j], j[i < j]
            for k in range(0, len(i), 1 << 16):
                a, b = i[k:k + (1 << 16)], j[k:k + (1 << 16)]
                sure = np.einsum("ij,ij->i", unit[a], unit[b]) >= threshold
                a, b = a[sure], b[sure]
                new = ~(keys[a] == keys[b]).any(axis=1)
                a, b = a[new], b[new]
                gained += np.bincount(a, n[b], len(node)).astype(np.int64) + np.bincount(b, n[a], len(node)).astype(np.int64)
                left.append(a), right.append(b)
        a, b = (np.concatenate(x or [np.zeros(0, np.int64)]) for x in (left, right))
        root = _roots(len(node), a, b)
        linked, child = np.flatnonzero(gained), np.flatnonzero(root != np.arange(len(node)))
        return pa.table({
            "a": pa.array(np.concatenate((node[linked], node[child]))),
            "b": pa.array(np.concatenate((np.zeros(len(linked), np.int64), node[root[child]])),
                          mask=np.concatenate((np.ones(len(linked), bool), np.zeros(len(child), bool)))),
            "n": pa.array(np.concatenate((gained[linked], np.zeros(len(child), np.int64))))})

    return run


def _bits_per_label(nodes: DataFrame, threshold: float, whole: int, block: int):
    sizes = nodes.groupBy("label", "dim").agg(F.count("*").alias("n")).groupBy("label").agg(F.max("n").alias("n"))
    large = sizes.filter(F.col("n") > whole).orderBy(F.desc("n"), "label").limit(KNOWN_LABELS + 1).collect()
    known = {r.label: bands(r.n, threshold, whole, block) for r in large[:KNOWN_LABELS]}
    rest = large[KNOWN_LABELS].n if len(large) > KNOWN_LABELS else 0
    return known, bands(rest, threshold, whole, block)


def link_vectors(df: DataFrame, threshold: float = 0.93, id: str = "vec_id", vector: str = "embedding",
                 label: str = "label", whole: int = WHOLE, block: int = BLOCK) -> DataFrame:
    """(id, label, n_links, component_id) of every row; ``vector`` is an array of float or double."""
    if not 0 < threshold < 1:
        raise ValueError("the threshold must lie between 0 and 1")
    kind = df.schema[id].dataType.simpleString()
    rows = df.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id}`").alias("id"),
                     F.col(f"`{label}`").cast("string").alias("label"), F.col(f"`{vector}`").alias("embedding"))
    rows = written(rows.mapInArrow(
        _prepare, f"row long, id {kind}, label string, key binary, dim int, wide int, vec binary"), "vectors")
    able = salted.with_salt(rows.filter("key is not null").select("row", "id", "key"), F.col("row"))
    groups = written(salted.totals(
        able, ["key"], [F.min("row").alias("node"), F.count("*").alias("n"), F.min("id").alias("least")],
        [F.min("node").alias("node"), F.sum("n").alias("n"), F.min("least").alias("least")]), "equal-vectors")
    unique = groups.select("node", "n", "least").distinct()

    nodes = rows.select(F.col("row").alias("node"), "label", "dim", "wide", "vec").join(unique.select("node", "n"), "node")
    nodes = written(nodes, "nodes")
    nodes = written(nodes.mapInArrow(_coder(*_bits_per_label(nodes, threshold, whole, block)),
                                     NODE + ", keys array<int>"), "codes")

    # how many parts each bucket needs; a bucket of one is left out
    bucket = ["label", "dim", "band", "bandkey"]
    met = salted.with_salt(nodes.select("node", "label", "dim", F.posexplode("keys").alias("band", "bandkey")), F.col("node"))
    parts = salted.totals(met, bucket, [F.count("*").alias("m")], [F.sum("m").alias("m")], keep=F.col("m") > 1)
    met = met.join(parts, bucket + [salted.SALT]).select(
        "node", "band", "bandkey", F.ceil(F.col("m") / block).cast("int").alias("parts"))
    own = F.pmod(F.xxhash64("node", F.lit(SEED)), F.col("parts")).cast("int")
    met = met.withColumn("part", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    met = met.select("node", "band", "bandkey", "part", F.least("part", "other").alias("lo"),
                     F.greatest("part", "other").alias("hi")).join(nodes, "node")
    links = written(met.groupBy(*bucket, "lo", "hi").applyInArrow(_linker(threshold), LINK), "links")

    counts = links.filter("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("links"))
    joined = components(links.filter("b is not null").select("a", "b"))
    found = unique.join(counts, "node", "left").join(
        joined.select(F.col("id").alias("node"), "component").distinct(), "node", "left").select(
        "node", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "node").alias("component"), "least")
    found = salted.with_salt(written(found, "components"), F.col("node"))
    smallest = salted.totals(found, ["component"], [F.min("least").alias("component_id")],
                             [F.min("component_id").alias("component_id")])
    found = found.join(smallest, ["component", salted.SALT]).select("node", "n_links", "component_id")
    found = groups.select("key", salted.SALT, "node").join(found, "node").drop("node")
    labels = rows.select("row", "id", "label", "key")
    able = salted.with_salt(labels.filter("key is not null"), F.col("row")).join(found, ["key", salted.SALT]).select(
        F.col("id").alias(id), "label", F.col("n_links").cast("long"), "component_id")
    return able.unionByName(labels.filter("key is null").select(
        F.col("id").alias(id), "label", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id")))
