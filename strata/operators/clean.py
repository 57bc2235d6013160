"""Cleaning operators: filters, null fill, deterministic de-duplication.

All are narrow transformations except ``dedupe``, which shuffles once on its
keys.  ``dedupe`` keeps the first row of each key under a caller-given total
order, written as ``row_number() == 1`` so that Spark plans a partial
``WindowGroupLimit`` *before* the shuffle: a key holding a third of the rows
is cut down to one row per map task before it is moved.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.scalar import is_positive

ColumnOrName = Column | str


def _cols(cs: Iterable[ColumnOrName]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


# ---------------------------------------------------------------- filters

def require_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep rows where every listed column is non-null (F1, F2)."""
    cond = None
    for c in cols:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return df if cond is None else df.filter(cond)


def require_positive(df: DataFrame, col: ColumnOrName) -> DataFrame:
    """Keep rows whose value is > 0 and not NaN; null fails too."""
    c = F.col(col) if isinstance(col, str) else col
    return df.filter(is_positive(c))


def exclude_value(df: DataFrame, col: str, sentinel) -> DataFrame:
    """Drop a sentinel value with SQL semantics: ``col != v`` also drops nulls."""
    return df.filter(F.col(col) != F.lit(sentinel))


def in_range(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """Closed range ``lo <= col <= hi``; null is dropped."""
    return df.filter(F.col(col).between(lo, hi))


def fill_nulls(df: DataFrame, value, cols: Sequence[str]) -> DataFrame:
    """Replace nulls by a constant in the listed columns."""
    return df.na.fill(value, list(cols))


# ---------------------------------------------------------------- de-duplication

def dedupe(df: DataFrame, keys: Sequence[str],
           order_by: Sequence[ColumnOrName] | None = None) -> DataFrame:
    """One row per key.

    ``order_by`` gives the total order; the first row wins.  Without it the
    kept row is arbitrary (``dropDuplicates``), which is what a plain
    reference run does, and only the key set is reproducible.
    """
    keys = list(keys)
    if order_by is None:
        return df.dropDuplicates(keys)
    if not order_by:
        raise ValueError("order_by is empty; pass None for an arbitrary row per key")
    w = Window.partitionBy(*keys).orderBy(*_cols(order_by))
    rn = "__strata_rn"
    return df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) == 1).drop(rn)


def total_order(df: DataFrame, first: Sequence[ColumnOrName] = ()) -> list[Column]:
    """``first`` followed by every remaining column ascending: a total order
    whenever whole rows are unique."""
    named = {c for c in first if isinstance(c, str)}
    rest = [F.col(c).asc_nulls_first() for c in df.columns if c not in named]
    return _cols(first) + rest
