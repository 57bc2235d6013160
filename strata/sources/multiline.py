"""Multi-line CSV read by many tasks (S4): files are cut into byte ranges, quote parity tells where records lie.

Spark reads a CSV file with line breaks inside quotes in one task, whatever its
size.  Here a file is read as lines, which can be cut anywhere:

1. the quotes of each byte range are counted (one partial aggregate, a row per
   range); the sum over the ranges before tells whether a range starts inside a
   quoted field (a window over a file's ranges);
2. every task puts the lines of its ranges together to records, knowing only
   that bit: a line ends a record if the quotes so far are even.  What a range
   holds of records that reach beyond it are pieces, at most two of a range;
3. only the pieces are shuffled, put in order and joined to records;
4. records are parsed where they are by Spark's own CSV expression.

The quote parity decides, so quotes inside a field must be doubled and fields
with quotes, separators or line breaks quoted (RFC 4180).  A file is read
three times, by as many tasks as it has ranges: for the counts (when the frame
is made), for whole records and for pieces.  A record must fit in a task's memory; one quote without its partner
makes the rest of its file one record, as in any reader.

Results equal ``spark.read.csv(multiLine=True, escape='"')``: the first line end
of a file says whether its lines end in ``\\r\\n``, which then becomes ``\\n`` in
quotes, too; blank lines are skipped and the header dropped once per file.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata.operators.star import bytes_of
from strata.session import scratch_path
from strata.sources.files import CSV_GLOB, read_csv

MAX_BROADCAST_BYTES = 32 << 20

_PIECE = "file string, block long, part int, text string, ends boolean, first boolean, opens boolean"


def _lines(spark: SparkSession, path, glob: str | None, recursive: bool) -> DataFrame:
    reader = spark.read.option("lineSep", "\n")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    return reader.text(path if isinstance(path, str) else list(path)).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), "value", quotes.alias("quotes"))


def range_parity(lines: DataFrame) -> DataFrame:
    """(file, block, inside, crlf): whether a byte range starts inside a quoted field; how its file's lines end."""
    counts = lines.groupBy("file", "block").agg(
        F.sum("quotes").alias("n"), F.min_by(F.col("value").endswith("\r"), "at").alias("crlf"))
    ranges = Window.partitionBy("file").orderBy("block")
    before = F.sum("n").over(ranges.rowsBetween(Window.unboundedPreceding, -1))
    return counts.select("file", "block", (F.coalesce(before, F.lit(0)) % 2 == 1).alias("inside"),
                         F.first("crlf").over(ranges.rowsBetween(Window.unboundedPreceding, 0)).alias("crlf"))


class _Range:
    """The lines of one byte range, as they come: records that lie in it whole, and the pieces at its ends."""

    def __init__(self, file: str, block: int, inside: bool):
        self.key = file, block
        self.open = [] if inside else None          # lines of the record that is not at its end yet
        self.head = inside                          # that record began before the range
        self.odd = inside
        self.first = block == 0

    def add(self, values: list[str], quotes: np.ndarray) -> list[tuple]:
        odd = (np.cumsum(quotes) + self.odd) % 2 == 1
        ends = np.flatnonzero(~odd)
        out, at = [], 0
        for end in ends.tolist():
            text = values[at] if end == at else "\n".join(values[at:end + 1])
            if self.open is not None:
                text = "\n".join([*self.open, text])
            if self.head:
                out.append((*self.key, 0, text, True, False, False))
            else:
                out.append((*self.key, None, text, True, self.first, False))
                self.first = False
            self.open, self.head, at = None, False, end + 1
        if at < len(values):
            self.open = (self.open or []) + values[at:]
        self.odd = bool(odd[-1]) if len(odd) else self.odd
        return out

    def rest(self) -> list[tuple]:
        if self.open is None:
            return []
        text = "\n".join(self.open)
        if self.head:
            return [(*self.key, 0, text, False, False, False)]
        return [(*self.key, 1, text, False, self.first, True)]


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``_PIECE`` rows; ``part`` is null for whole records, else the piece's place in its range."""
    now: _Range | None = None
    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("part", pa.int32()), ("text", pa.string()),
                        ("ends", pa.bool_()), ("first", pa.bool_()), ("opens", pa.bool_())])

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)

    for batch in batches:
        out = []
        file, block = batch.column(0), np.asarray(batch.column(1))
        # a range's rows follow one another; files change where blocks or names do
        names = file.dictionary_encode().indices.to_numpy()
        cut = np.flatnonzero((np.diff(block) != 0) | (np.diff(names) != 0)) + 1
        values, quotes = batch.column(2).to_pylist(), np.asarray(batch.column(3))
        for a, b in zip([0, *cut.tolist()], [*cut.tolist(), batch.num_rows]):
            if a == b:
                continue
            key = file[a].as_py(), int(block[a])
            if now is None or now.key != key:
                out += now.rest() if now else []
                now = _Range(*key, batch.column(4)[a].as_py())
            out += now.add(values[a:b], quotes[a:b])
        if out:
            yield batch_of(out)
    if now and now.rest():
        yield batch_of(now.rest())


def records(spark: SparkSession, path: str | Sequence[str], glob: str | None = CSV_GLOB, recursive: bool = True,
            max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """(file, first, record): the records of CSV files as text; ``first`` marks the first of its file."""
    lines = _lines(spark, path, glob, recursive)
    ranges = scratch_path(spark, "csv-ranges")
    range_parity(lines).write.parquet(ranges)
    parity = spark.read.parquet(ranges)
    if bytes_of(parity) <= max_broadcast_bytes:          # a row per byte range
        known = lines.join(F.broadcast(parity), ["file", "block"], "left")
    else:
        known = lines.join(parity, ["file", "block"], "left").repartition("file", "block").sortWithinPartitions("file", "block", "at")
    # ranges depend on the session's cores; should they change between the two passes, the job must fail
    inside = F.when(F.col("inside").isNull(), F.raise_error(F.lit("byte ranges changed during the read; read again"))) \
        .otherwise(F.col("inside"))
    line = F.when(F.col("crlf"), F.regexp_replace("value", "\r$", "")).otherwise(F.col("value")).alias("value")
    found = known.select("file", "block", line, "quotes", inside.cast("boolean").alias("inside")).mapInArrow(_pieces, _PIECE)

    whole = found.filter("part is null").select("file", "first", F.col("text").alias("record"))
    # pieces in order; a record starts at a piece that opens one
    order = Window.partitionBy("file").orderBy("block", "part")
    cut = found.filter("part is not null").withColumn("no", F.sum(F.col("opens").cast("int")).over(order))
    joined = cut.groupBy("file", "no").agg(
        F.sort_array(F.collect_list(F.struct("block", "part", "text"))).alias("pieces"), F.max("first").alias("first"))
    return whole.unionByName(joined.select("file", "first", F.array_join("pieces.text", "\n").alias("record")))


def read_multiline_csv(spark: SparkSession, path: str | Sequence[str], schema: StructType | str | None = None, *,
                       header: bool = True, glob: str | None = CSV_GLOB, recursive: bool = True,
                       source_col: str | None = None, options: dict | None = None,
                       max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Multi-line CSV scan (S4) without the one-task limit of Spark's reader.

    ``schema`` None reads every column as text, named by the first file's header.  ``source_col`` adds the
    file of each row.  ``options`` are those of Spark's CSV reader.
    """
    if schema is None:
        names = read_csv(spark, path, header=header, multiline=True, glob=glob, recursive=recursive,
                         extra_options=options).columns      # reads one record
        schema = StructType([StructField(n, StringType()) for n in names])
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    found = records(spark, path, glob, recursive, max_broadcast_bytes)
    if header:
        found = found.filter(~F.col("first"))
    found = found.select("file", F.regexp_replace("record", "^\\uFEFF", "").alias("record")).filter("record <> ''")
    parsed = F.from_csv("record", _ddl(schema),
                        {"escape": '"', "multiLine": "true", "mode": "PERMISSIVE"} | (options or {}))
    own = [F.col(f"row.`{f.name}`").alias(f.name) for f in schema]
    return found.select(parsed.alias("row"), "file").select(*own, *([F.col("file").alias(source_col)] if source_col else []))


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
