"""Data-quality rules and readiness checks.

A rule fails only when its predicate is *false*; null passes, as a SQL CHECK
does.  Likewise a uniqueness rule ignores rows with a null key part, as SQL
UNIQUE treats nulls as distinct (a NOT NULL rule covers the nulls).  Row rules are evaluated together in one projection / one aggregation
pass.  Uniqueness rules are a ``groupBy(keys).count()`` (partial aggregation,
skew-safe), never a window over the key.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.star import HOT_FRACTION, HOT_ROWS, skew_join


@dataclass(frozen=True)
class Rule:
    """A named rule: either a row predicate or a set of unique keys."""

    name: str
    predicate: Column | None = None
    unique_keys: tuple[str, ...] = field(default_factory=tuple)

    def __post_init__(self):
        if (self.predicate is None) == (not self.unique_keys):
            raise ValueError("a rule has exactly one of predicate / unique_keys")


# ---------------------------------------------------------------- rule builders

def unique(name: str, *keys: str) -> Rule:
    """The key (or combination) identifies one row."""
    return Rule(name, unique_keys=tuple(keys))


def not_null(name: str, col: str) -> Rule:
    """C2."""
    return Rule(name, F.col(col).isNotNull())


def positive(name: str, col: str) -> Rule:
    """Strictly positive (NaN fails)."""
    return Rule(name, (F.col(col) > 0) & ~F.isnan(F.col(col)))


def non_negative(name: str, col: str) -> Rule:
    """C8."""
    return Rule(name, F.col(col) >= 0)


def between(name: str, col: str, lo, hi) -> Rule:
    """Closed range."""
    return Rule(name, F.col(col).between(lo, hi))


def strictly_between(name: str, col: str, lo, hi) -> Rule:
    """Open range."""
    return Rule(name, (F.col(col) > lo) & (F.col(col) < hi))


def max_length(name: str, col: str, n: int) -> Rule:
    """VARCHAR(n)."""
    return Rule(name, F.length(F.col(col)) <= n)


# ---------------------------------------------------------------- evaluation

def _non_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    cond = None
    for k in keys:
        cond = F.col(k).isNotNull() if cond is None else cond & F.col(k).isNotNull()
    return df.filter(cond)


def _fails(rule: Rule) -> Column:
    return ~F.coalesce(rule.predicate, F.lit(True))


def check_constraints(df: DataFrame, rules: Sequence[Rule], flag_col: str = "failed_rules",
                      hot_fraction: float = HOT_FRACTION, hot_rows: int = HOT_ROWS) -> tuple[DataFrame, DataFrame]:
    """Split ``df`` into (valid rows, violating rows with the failed rule names).

    Duplicate keys are flagged by joining the rows to the set of duplicated
    keys; a key duplicated very often is flagged where its rows lie
    (``skew_join``).
    """
    row_rules = [r for r in rules if r.predicate is not None]
    flagged = df
    dup_flags = []
    for i, r in enumerate(r for r in rules if r.unique_keys):
        keys = list(r.unique_keys)
        flag = f"__strata_dup{i}"
        dups = (_non_null_keys(df, keys).groupBy(*keys).count().filter(F.col("count") > 1)
                .select(*keys, F.lit(True).alias(flag)))
        flagged = skew_join(flagged, dups, keys, "left", hot_fraction, hot_rows, right_unique=True, measured=df)
        dup_flags.append((r.name, flag))
    names = [F.when(_fails(r), F.lit(r.name)) for r in row_rules]
    names += [F.when(F.col(flag), F.lit(name)) for name, flag in dup_flags]
    arr = F.filter(F.array(*names), lambda x: x.isNotNull()) if names else F.array()
    flagged = flagged.withColumn(flag_col, arr).drop(*[f for _, f in dup_flags])
    valid = flagged.filter(F.size(flag_col) == 0).drop(flag_col)
    bad = flagged.filter(F.size(flag_col) > 0)
    return valid, bad


def row_rule_metrics(rules: Sequence[Rule]) -> dict[str, Column]:
    """``{rule name: count of violating rows}`` aggregates for the row rules.

    Plain aggregates, so they can ride along in another job (an
    ``Observation`` on a write) instead of a pass of their own.
    """
    return {r.name: F.sum(F.when(_fails(r), 1).otherwise(0)).cast("long")
            for r in rules if r.predicate is not None}


def violation_report(df: DataFrame, rules: Sequence[Rule], table: str | None = None,
                     rule_col: str = "rule", count_col: str = "violations") -> DataFrame:
    """One row per rule with the number of violating rows.

    Row rules: one aggregation pass for all of them.  Unique rules: rows that
    sit in a key group of size > 1.
    """
    parts = []
    row_rules = [r for r in rules if r.predicate is not None]
    if row_rules:
        sums = [F.sum(F.when(_fails(r), 1).otherwise(0)).cast("long").alias(f"r{i}")
                for i, r in enumerate(row_rules)]
        rows = F.array(*[F.struct(F.lit(r.name).alias(rule_col), F.col(f"r{i}").alias(count_col))
                         for i, r in enumerate(row_rules)])
        parts.append(df.agg(*sums).select(F.inline(rows)))
    for r in rules:
        if not r.unique_keys:
            continue
        dup_rows = (_non_null_keys(df, r.unique_keys).groupBy(*r.unique_keys).count()
                    .filter(F.col("count") > 1)
                    .agg(F.coalesce(F.sum("count"), F.lit(0)).cast("long").alias(count_col)))
        parts.append(dup_rows.select(F.lit(r.name).alias(rule_col), F.col(count_col)))
    if not parts:
        out = df.sparkSession.createDataFrame([], f"{rule_col} string, {count_col} long")
    else:
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
    out = out.select(F.col(rule_col), F.coalesce(F.col(count_col), F.lit(0)).cast("long")
                     .alias(count_col))
    if table is not None:
        out = out.select(F.lit(table).alias("table_name"), "*")
    return out


# ---------------------------------------------------------------- readiness

def presence_report(listing: DataFrame, required: Sequence[str], name_col: str,
                    match: str = "equals", size_col: str | None = None) -> DataFrame:
    """For each required item: is it present, how many entries match, how many are empty.

    ``required`` is a short caller-given list (configuration, not data), so each
    item becomes one predicate and the whole listing is scanned once in a
    single aggregation: no join, no nested loop.  ``match`` is ``equals``,
    ``contains`` (the reference's substring test, F10) or ``endswith``.
    """
    if not required:
        raise ValueError("required must not be empty")
    col = F.col(name_col)
    preds = {"equals": lambda r: col == F.lit(r),
             "contains": lambda r: col.contains(r),
             "endswith": lambda r: col.endswith(r)}
    if match not in preds:
        raise ValueError(f"match must be one of {sorted(preds)}")
    aggs = []
    for i, r in enumerate(required):
        hit = preds[match](r)
        aggs.append(F.count(F.when(hit, 1)).alias(f"n{i}"))
        if size_col is not None:
            aggs.append(F.count(F.when(hit & (F.col(size_col) == 0), 1)).alias(f"e{i}"))
    structs = []
    for i, r in enumerate(required):
        empty = F.col(f"e{i}") if size_col is not None else F.lit(0)
        structs.append(F.struct(F.lit(r).alias("item"),
                                F.col(f"n{i}").cast("long").alias("matches"),
                                empty.cast("long").alias("empty_matches")))
    out = listing.agg(*aggs).select(F.inline(F.array(*structs)))
    return out.withColumn("present", F.col("matches") > 0)

