"""Packing by power-of-two decomposition.

A document of n tokens is cut into pieces whose lengths are the powers of two
of n, longest first (as many whole sequences as fit, then the binary digits of
the rest).  A piece is a sequence of its own, so none crosses documents and
none is padded; sequences of one length form a bucket, numbered together.

Results: a null or empty text is its end token alone.  Repeated rows are packed
each on their own; a null id stays null.  Texts are never cut short.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import common as C
from strata.llm.word_table import WordTable
from strata.session import scratch_path

SEQUENCE = 4096
END_ID = 2
STOPS = ",.;:!?"

_tables: dict[str, tuple[WordTable, WordTable]] = {}       # of chunks, and of their stems


def load(path: str) -> WordTable:
    """The ids of chunks without spaces and line ends, by the tokenizers library.

    The tokenizer drops white space and parts an ASCII letter or digit from a stop, so a chunk that has one
    before its last stops is its stem's ids and theirs.  A run of lower-case ASCII letters is one word to it, and the last
    token of a word ends with ``</w>``: many such runs go to the library as one text, the rest one by one.
    """
    if path not in _tables:
        from tokenizers import Tokenizer

        lib = Tokenizer.from_file(path)
        closes = np.zeros(lib.get_vocab_size() + 1, dtype=bool)
        for token, i in lib.get_vocab().items():
            closes[i] = token.endswith("</w>")

        def encode_parts(parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
            simple = [p.isascii() and p.islower() and p.isalpha() for p in parts]
            plain = [p for p, s in zip(parts, simple) if s]
            found = lib.encode_batch_fast([" ".join(plain[i:i + 2000]) for i in range(0, len(plain), 2000)],
                                          add_special_tokens=False)
            own = np.concatenate([np.array(e.ids, dtype=np.int32) for e in found] or [np.zeros(0, np.int32)])
            rest = [e.ids for e in lib.encode_batch_fast([p for p, s in zip(parts, simple) if not s],
                                                         add_special_tokens=False)]
            size = np.zeros(len(parts), dtype=np.int64)
            simple = np.array(simple, dtype=bool)
            size[simple] = np.diff(np.concatenate(([0], np.flatnonzero(closes[own]) + 1)))
            size[~simple] = [len(ids) for ids in rest]
            flat = np.empty(int(size.sum()), dtype=np.int32)
            which = np.repeat(simple, size)
            flat[which] = own
            flat[~which] = [i for ids in rest for i in ids]
            return flat, size

        stems = WordTable(encode_parts)

        def encode(chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
            parts = []
            for chunk in chunks:
                stem = chunk.rstrip(STOPS)
                # other letters may end in a mark once normalised, which a stop would join
                if stem and stem[-1].isascii() and stem[-1].isalnum():
                    parts += (stem, chunk[len(stem):])
                else:
                    parts += (chunk, "")
            flat, size = stems.ids(parts)
            return flat, size[0::2] + size[1::2]

        _tables[path] = WordTable(encode), stems
    return _tables[path][0]


def forget(path: str) -> None:
    """Empties the tables; the tokenizer stays."""
    for table in _tables.get(path, ()):
        table.clear()


def tokenize(texts: list[str | None], path: str, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts in a row, each followed by the end id; offsets)."""
    chunks, count = [], []
    for text in texts:
        if text and "<|" not in text:        # upper case may spell what is a special token in lower case
            text = text.encode().lower().decode()
        own = text.replace("\n", " ").split(" ") if text else []
        chunks += own
        count.append(len(own))
    ids, size = load(path).ids(chunks)
    lead = np.concatenate(([0], np.cumsum(size)))
    ends = lead[np.cumsum(count)] if count else np.zeros(0, np.int64)
    out = np.insert(ids, ends, end_id)
    return out, np.concatenate(([0], ends + np.arange(1, len(count) + 1)))


def binary_pieces(n: np.ndarray, sequence: int = SEQUENCE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, length) of the pieces of documents with ``n`` tokens, ordered by document and start."""
    if sequence & (sequence - 1):
        raise ValueError("the sequence length must be a power of two")
    whole = n // sequence
    doc = np.repeat(np.arange(len(n)), whole)
    at = np.arange(int(whole.sum())) - np.repeat(np.cumsum(whole) - whole, whole)
    parts = [(doc, at * sequence, np.full(len(doc), sequence))]
    bit = sequence >> 1
    while bit:
        own = np.flatnonzero(n & bit)
        parts.append((own, n[own] & -(bit << 1), np.full(len(own), bit)))
        bit >>= 1
    doc, start, length = (np.concatenate(x).astype(np.int64) for x in zip(*parts))
    order = np.lexsort((start, doc))
    return doc[order], start[order], length[order]


PIECE = "start long, length long, doc_tokens long, ids binary"


def decompose(df: DataFrame, tokenizer: str, text: str = "text", sequence: int = SEQUENCE,
              end_id: int = END_ID, keep_words: bool = True) -> DataFrame:
    """A row per piece: every column of ``df`` but the text, and ``PIECE`` (ids: little-endian unsigned 32-bit).

    A worker keeps its tables for the tasks that follow; without ``keep_words`` a task empties them at its end, which
    takes more time and leaves the memory to what else the executors run.
    """
    rest = C.without(df.drop(text), ["start", "length", "doc_tokens", "ids"])
    n_kept, own = len(rest.columns), C.free_name(rest)

    def pieces(batches):
        for batch in batches:
            for part in C.slices([batch], own):
                ids, offsets = tokenize(part.column(n_kept).to_pylist(), tokenizer, end_id)
                n = np.diff(offsets)
                doc, start, length = binary_pieces(n, sequence)
                at = (offsets[doc] + start) * 4
                # pieces of a document follow one another, so their ids are the buffer's, cut at their ends
                cut = pa.array(np.concatenate((at, [len(ids) * 4])), type=pa.int64())
                body = pa.Array.from_buffers(pa.large_binary(), len(doc),
                                             [None, cut.buffers()[1], pa.py_buffer(ids.astype("<u4").tobytes())])
                columns = [c.take(pa.array(doc)) for c in part.columns[:n_kept]]
                yield pa.RecordBatch.from_arrays(
                    columns + [pa.array(start), pa.array(length), pa.array(n[doc]), body.cast(pa.binary())],
                    names=part.schema.names[:n_kept] + ["start", "length", "doc_tokens", "ids"])

    def run(batches):
        try:
            yield from pieces(batches)
        finally:
            if not keep_words:
                forget(tokenizer)

    types = ", ".join(filter(None, [C.types_of(rest), PIECE]))
    return df.select(*rest.columns, F.col(text).alias(own)).mapInArrow(run, types)


def number(pieces: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``sequence_id`` (unique, ascending by length, then by ``order``) and ``offset``.

    The pieces are written once, dealt by range of (length, order) and sorted, and
    numbered where they lie; the numbered table is written, so that a lost task
    can't give other numbers.  Numbers ascend but have gaps between partitions.
    """
    spark = pieces.sparkSession
    plain = scratch_path(spark, "pieces")
    pieces.write.parquet(plain)
    done = scratch_path(spark, "sequences")
    (spark.read.parquet(plain).repartitionByRange("length", *order).sortWithinPartitions("length", *order)
     .withColumn("sequence_id", F.monotonically_increasing_id())
     .withColumn("offset", F.lit(0).cast("long")).write.parquet(done))
    return spark.read.parquet(done)
