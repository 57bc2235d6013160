"""Layouts that later reads gain from: bucketed tables (J2, J3) and files clustered on two columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int, path: str) -> DataFrame:
    """Write ``df`` as a catalog table whose rows are dealt to ``buckets`` by a hash of ``keys`` and sorted by them.

    Joins and groups on ``keys`` between tables of equal ``buckets`` need no exchange.  One file per bucket: choose as many
    buckets as files of some hundred MB.  Rows are hashed by key, so a key with a large share of the rows makes a large file.
    """
    keys = list(keys)
    (df.repartition(buckets, *keys).write.format("parquet").mode("overwrite").option("path", path)
     .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table))
    return df.sparkSession.table(table)


def drop_tables(spark: SparkSession, *tables: str) -> None:
    for t in tables:
        spark.sql(f"DROP TABLE IF EXISTS `{t}`")


def cell(col: str, bounds: Sequence[float]) -> Column:
    """Into which of the ranges between ascending ``bounds`` a value falls; null and NaN are in the last."""
    value = F.col(col).cast("double")
    at = F.size(F.filter(F.array(*[F.lit(float(b)) for b in bounds]), lambda b: b <= value))
    return F.when(value.isNull(), F.lit(len(bounds))).otherwise(at)


def interleave(a: Column, b: Column, bits: int) -> Column:
    """The bits of two numbers in turn: near in both columns is near on the curve."""
    out = F.lit(0)
    for k in range(bits):
        for n, c in enumerate((a, b)):
            bit = F.call_function("shiftright", c, F.lit(k)).bitwiseAND(1)
            out = out.bitwiseOR(F.call_function("shiftleft", bit, F.lit(2 * k + n)))
    return out


def write_clustered(df: DataFrame, path: str, first: str, second: str, bits: int = 5, files: int | None = None) -> None:
    """Write Parquet in the order of a space-filling curve over two numeric columns or timestamps.

    Each column is cut at its quantiles into ``2 ** bits`` ranges (a bounded aggregate), so that skewed values spread,
    too.  Row groups then hold a small rectangle of both columns, and their statistics prune reads on either.
    """
    n = 1 << bits
    shares = F.array(*[F.lit(k / n) for k in range(1, n)])
    found = df.agg(*[F.percentile_approx(F.col(c).cast("double"), shares, 100 * n).alias(c) for c in (first, second)]).first()
    cells = [cell(c, sorted(set(found[c] or []))) for c in (first, second)]
    curve = interleave(*cells, bits + 1)
    out = df.withColumn("__curve", curve)
    out = out.repartitionByRange(files, "__curve", first, second) if files else out.repartitionByRange("__curve", first, second)
    out.sortWithinPartitions("__curve", first, second).drop("__curve").write.mode("overwrite").parquet(path)
