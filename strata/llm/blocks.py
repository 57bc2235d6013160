"""Questions about keys across all documents, asked block by block.

Documents are kept in blocks: a row is one block, about ``BLOCK_BYTES`` of text
with all columns, packed as a compressed Arrow stream.  In each round every
block asks about a sorted set of distinct keys, cut into buckets by key range,
and every bucket's task answers, key by key: does it occur more than once in
all blocks, is this the first block that has it, is it frequent.

What a block works out in the first round and needs again (where its samples
lie) it keeps as an answer to itself.

A key goes once per block, however often the block has it, so a key that half
of all rows share costs as many entries as there are blocks.  A block's answers
are a few bits per key.  Blocks are written first, so that a lost task finds
the same blocks again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from strata.llm import common as C
from strata.llm.components import written
from strata.session import at_scope_end

BLOCK_BYTES = 1 << 20
LEVEL = 5                             # of compression: a block lies on disk more than once
KEYS_A_BUCKET = 250_000

Keys = dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]     # kind -> (keys, second keys, how often each)


class Blocks:
    """The blocks of a table, kept on the executors' disks, where later rounds read them without moving them again.

    A lost executor's blocks are read again from the shared folder.  Results are lazy, so what is kept goes with
    the session or with ``spark.catalog.clearCache()``.
    """

    def __init__(self, df: DataFrame, text: str = "text"):
        def run(batches):
            from pyspark import TaskContext

            number = TaskContext.get().partitionId() << 33
            for part in C.slices(batches, text, BLOCK_BYTES):
                sink = pa.BufferOutputStream()
                part = pa.RecordBatch.from_arrays(part.columns, schema=part.schema)
                with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", LEVEL))) as out:
                    out.write_batch(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number]), pa.array([C.flat(part.column(part.schema.get_field_index(text)))[0].size]),
                     pa.array([sink.getvalue().to_pybytes()], type=pa.binary())], names=["block", "n_bytes", "rows"])
                number += 1

        stored = written(df.mapInArrow(run, "block long, n_bytes long, rows binary"), "blocks")
        self.n_bytes = stored.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
        self.table = stored.select("block", "rows").repartition("block").persist(StorageLevel.DISK_ONLY)
        at_scope_end(self.table.unpersist)
        self.answers: DataFrame | None = None

    def each(self, fn: Callable[[int, pa.RecordBatch, Answers], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
        """``fn`` over every block's number, rows and the answers that it has so far."""
        if self.answers is None:
            def first(batches):
                for batch in batches:
                    for block, rows in zip(batch.column(0).to_pylist(), batch.column(1)):
                        yield from fn(block, unpack(rows), Answers({}))

            return self.table.mapInArrow(first, schema)

        arrow = to_arrow_schema(T.StructType.fromDDL(schema))

        def both(left: pa.Table, right: pa.Table) -> pa.Table:
            known: dict[int, list] = {}
            for kind, *rest in zip(*(right[c].to_pylist() for c in ("kind", "bucket", "n", "said"))):
                known.setdefault(kind, []).append(rest)
            found = [x for block, rows in zip(left["block"].to_pylist(), left["rows"])
                     for x in fn(block, unpack(rows), Answers(known))]
            return pa.Table.from_batches([x.cast(arrow) for x in found], schema=arrow)

        return (self.table.groupBy("block").cogroup(self.answers.groupBy("block"))
                .applyInArrow(both, schema))

    def told(self, answers: DataFrame, name: str) -> None:
        """Adds a round's answers (``ANSWER``)."""
        answers = written(answers, name)
        self.answers = answers if self.answers is None else self.answers.unionByName(answers)

    def ask(self, keys: Callable[[pa.RecordBatch, Answers], Keys], expected: int, frequent: int, name: str) -> None:
        """Every block's keys, answered.  ``expected`` of them in all, roughly: it sets the number of buckets."""
        bits = max(4, int(np.ceil(np.log2(max(1, expected / KEYS_A_BUCKET)))))

        def question(block, rows, known):
            out = []
            for kind, (key, second, times) in keys(rows, known).items():
                cut = np.searchsorted(key, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
                at = np.concatenate(([0], cut, [len(key)]))
                for bucket in np.flatnonzero(np.diff(at)).tolist():
                    a, b = at[bucket], at[bucket + 1]
                    out.append((kind, bucket, block, key[a:b].tobytes(), second[a:b].astype(np.uint32).tobytes(),
                                np.minimum(times[a:b], 255).astype(np.uint8).tobytes()))
            if known.kept_now is not None:
                out.append((KEPT, 0, block, known.kept_now, b"", b""))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*out), _ASKED)],
                                                 schema=_ASKED)

        asked = self.each(question, "kind int, bucket int, block long, keys binary, seconds binary, times binary")
        if self.answers is None:
            # the first round also hands each block what it found, for later rounds
            asked = written(asked, f"{name}-asked")
            self.told(asked.filter(F.col("kind") == KEPT).select(
                "block", "kind", "bucket", F.lit(0).alias("n"), F.col("keys").alias("said")), f"{name}-kept")
            asked = asked.filter(F.col("kind") != KEPT)

        def answer(table: pa.Table) -> pa.Table:
            block = np.array(table["block"])
            order = np.argsort(block, kind="stable")
            key, second, times = (np.concatenate([np.frombuffer(x, t) for x in map(table[c].to_pylist().__getitem__, order)])
                                  for c, t in (("keys", np.uint64), ("seconds", np.uint32), ("times", np.uint8)))
            size = np.array([len(x) for x in map(table["times"].to_pylist().__getitem__, order)])
            by = np.lexsort((second, key))
            new = np.ones(len(key), dtype=bool)
            new[1:] = (key[by[1:]] != key[by[:-1]]) | (second[by[1:]] != second[by[:-1]])
            lead = np.flatnonzero(new)
            total = np.add.reduceat(times[by].astype(np.int64), lead)
            group = np.cumsum(new) - 1
            planes = np.zeros((3, len(key)), dtype=bool)
            planes[0, by] = (total > 1)[group]
            planes[1, by] = new                  # lexsort is stable and blocks ascend: the first is the lowest
            planes[2, by] = (total > frequent)[group]
            cut = np.concatenate(([0], np.cumsum(size)))
            said = [b"".join(np.packbits(p[a:b]).tobytes() for p in planes) for a, b in zip(cut, cut[1:])]
            return pa.table({
                "block": pa.array(block[order]), "kind": pa.array([table["kind"][0].as_py()] * len(said), pa.int32()),
                "bucket": pa.array([table["bucket"][0].as_py()] * len(said), pa.int32()),
                "n": pa.array(size.astype(np.int32)), "said": pa.array(said, pa.binary())})

        self.told(asked.groupBy("kind", "bucket").applyInArrow(answer, ANSWER), name)

KEPT = -1
ANSWER = "block long, kind int, bucket int, n int, said binary"
_ASKED = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()),
                    ("seconds", pa.binary()), ("times", pa.binary())])


class Answers:
    """What a block was told, by kind: [bucket, number of keys, bits]."""

    def __init__(self, known: dict[int, list]):
        self.known, self.kept_now = known, None

    def keep(self, data: bytes) -> None:
        """In the first round: what later rounds find as ``kept``."""
        self.kept_now = data

    @property
    def kept(self) -> bytes:
        return self.known[KEPT][0][2]

    def bits(self, kind: int, planes: int, n: int) -> np.ndarray:
        """``planes`` bits for each of the block's ``n`` keys of this kind, in the keys' order."""
        out = np.zeros((planes, n), dtype=bool)
        at = 0
        for _, size, said in sorted(self.known.get(kind, ())):
            each = len(said) // planes
            for p in range(planes):
                out[p, at:at + size] = np.unpackbits(np.frombuffer(said, np.uint8, each, p * each), count=size)
            at += size
        if at != n:
            raise ValueError("the answers don't fit the questions")
        return out


def unpack(rows: pa.Scalar) -> pa.RecordBatch:
    with pa.ipc.open_stream(rows.as_buffer()) as stream:
        return stream.read_next_batch()


def distinct(key: np.ndarray, second: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(keys ascending, their seconds, how often each, the place of every entry's key)."""
    if second is None:
        out, place, times = np.unique(key, return_inverse=True, return_counts=True)
        return out, np.zeros(len(out), np.uint32), times, place
    by = np.lexsort((second, key))
    new = np.ones(len(key), dtype=bool)
    new[1:] = (key[by[1:]] != key[by[:-1]]) | (second[by[1:]] != second[by[:-1]])
    lead = np.flatnonzero(new)
    place = np.empty(len(key), dtype=np.int64)
    place[by] = np.cumsum(new) - 1
    times = np.diff(np.concatenate((lead, [len(key)])))
    return key[by[lead]], second[by[lead]], times, place
