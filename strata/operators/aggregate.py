"""Grouped summaries, HAVING, top-k, global rank and table counts.

Every aggregate is a ``groupBy().agg()`` (partial + final hash aggregation:
a hot group is pre-summed in each map task).  Top-k is ``orderBy().limit(k)``
which Spark executes as ``TakeOrderedAndProject``: each task keeps k rows,
only k x tasks rows reach the final merge.  A unique tie-break is always
appended so the cut is deterministic (K16).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.scalar import bytes_to_mb
from strata.session import scratch_path

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def summarize(df: DataFrame, by: Sequence[str], aggs: Mapping[str, Column],
              having: Column | None = None) -> DataFrame:
    """``groupBy(by).agg(aggs)`` with an optional HAVING predicate."""
    out = df.groupBy(*by).agg(*[expr.alias(name) for name, expr in aggs.items()])
    return out.filter(having) if having is not None else out


def top_k(df: DataFrame, k: int, order_by: Sequence[ColumnOrName],
          tie_break: Sequence[ColumnOrName] = (),
          columns: Sequence[ColumnOrName] | None = None) -> DataFrame:
    """First ``k`` rows under ``order_by`` then ``tie_break``."""
    out = df.orderBy(*[_c(o) for o in order_by], *[_c(t) for t in tie_break]).limit(k)
    return out.select(*[_c(c) for c in columns]) if columns is not None else out


def rank_rows(df: DataFrame, order_by: Sequence[ColumnOrName], rank_col: str = "rank") -> DataFrame:
    """Global sort with the place of each row, from 1 (O2, O3); ``order_by`` is a total order.

    Rows are dealt by range and sorted where they land; a partition's rows
    follow those of the partitions before it, whose sizes are one row per
    partition.  No task holds more than its range.
    """
    part, row = "__strata_part", "__strata_row"
    order = [_c(o) for o in order_by]
    path = scratch_path(df.sparkSession, "ranked")
    (df.repartitionByRange(*order).sortWithinPartitions(*order)
     .withColumn(row, F.monotonically_increasing_id()).write.parquet(path))
    placed = (df.sparkSession.read.parquet(path)
              .withColumn(part, F.shiftright(row, 33)).withColumn(row, F.col(row).bitwiseAND((1 << 33) - 1)))
    sizes = placed.groupBy(part).agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select(part, (F.sum("n").over(Window.orderBy(part)) - F.col("n")).alias("__strata_before"))
    return (placed.join(F.broadcast(before), part)      # a row per partition
            .withColumn(rank_col, F.col("__strata_before") + F.col(row) + 1)
            .drop(part, row, "__strata_before"))


def size_summary(entries: DataFrame, by: str, size_col: str = "length") -> DataFrame:
    """Entries, bytes, empty entries and MB per group."""
    return (entries.groupBy(by)
            .agg(F.count(F.lit(1)).alias("n_files"), F.sum(size_col).cast("long").alias("total_bytes"),
                 F.count(F.when(F.col(size_col) == 0, 1)).alias("empty_files"))
            .withColumn("total_mb", bytes_to_mb("total_bytes")))


def table_counts(tables: Mapping[str, DataFrame], total_label: str = "TOTAL",
                 name_col: str = "table_name", count_col: str = "row_count") -> DataFrame:
    """Row count per table plus a grand total, as one DataFrame.

    Each table contributes ``count(*)`` (a Parquet count reads no column
    data); the per-table rows are unioned and a ``rollup`` adds the total in
    the same pass.
    """
    if not tables:
        raise ValueError("table_counts needs at least one table")
    parts = [t.agg(F.count(F.lit(1)).alias(count_col)).select(
        F.lit(name).alias(name_col), F.col(count_col)) for name, t in tables.items()]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    rolled = union.rollup(name_col).agg(F.sum(count_col).alias(count_col))
    return rolled.select(F.coalesce(F.col(name_col), F.lit(total_label)).alias(name_col),
                         F.col(count_col).cast("long").alias(count_col))
