"""Star-schema operators: latest value per key, activity totals, dimension joins
(N1, F6, J1-J7, A1, A12).

Scale notes
-----------
* ``latest_per_key`` is a ranking window filtered to rank 1, which Spark
  turns into a partial ``WindowGroupLimit`` below the shuffle; a hot key only
  moves its top rows, never its whole history.  Hot keys whose rows may all
  tie are kept out of the window.
* ``activity_stats`` is a plain ``groupBy().agg()`` with partial (map-side)
  aggregation, so a hot key is summed before it is shuffled.
* ``lookup_join`` leaves the strategy to Spark's size check (broadcast
  under the threshold, sort-merge above it, AQE re-plans on real sizes); an
  explicit broadcast is given only after the dimension's size in bytes was
  measured and found within a caller-given bound.
* Joins whose left side may hold a hot key go through ``skew_join``: hot keys
  are counted first and joined where their rows lie, without a shuffle.
* ``enrich`` collapses a one-to-many right side to one row per key *before*
  joining, so the join cannot fan out.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from strata.functions.scalar import ratio

ColumnOrName = Column | str

# A key is hot if it holds more than this share of a frame's rows, and more rows than one task takes easily.
HOT_FRACTION = 0.01
HOT_ROWS = 1_000_000

def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- latest per key

def latest_per_key(df: DataFrame, keys: Sequence[str], order_col: str,
                   ties: str = "all", tie_break: Sequence[ColumnOrName] = (),
                   hot_fraction: float = HOT_FRACTION, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rows holding the latest ``order_col`` per key.

    ``ties='all'`` keeps every row on the latest value (``rank() == 1``, the
    reference's behaviour); ``ties='first'`` keeps one, chosen by
    ``tie_break`` (``row_number() == 1``).  Null order values sort last, so a
    null wins only for a key that has nothing else.

    Either way it is one window whose partial limit cuts a key before the
    shuffle.  With ``ties='all'`` a key may keep very many rows, all of which
    would meet in one task: keys that are measured to be hot (``hot_keys``)
    are compared with their latest value where their rows lie.
    """
    if ties == "all":
        return _latest_all(df, list(keys), order_col, hot_fraction, hot_rows)
    if ties != "first":
        raise ValueError(f"ties must be 'all' or 'first', not {ties!r}")
    if not tie_break:
        raise ValueError("ties='first' needs a tie_break order")
    w = Window.partitionBy(*keys).orderBy(F.col(order_col).desc_nulls_last(), *[_c(t) for t in tie_break])
    rk = "__strata_rank"
    return df.withColumn(rk, F.row_number().over(w)).filter(F.col(rk) == 1).drop(rk)


def _latest_all(df: DataFrame, keys: list[str], order_col: str,
                hot_fraction: float, hot_rows: int) -> DataFrame:
    rk = "__strata_rank"
    w = Window.partitionBy(*keys).orderBy(F.col(order_col).desc_nulls_last())
    found = hot_keys(df, keys, hot_fraction, hot_rows, nulls=True)
    if not found:
        return df.withColumn(rk, F.rank().over(w)).filter(F.col(rk) == 1).drop(rk)
    # a null key part is a value of its own here, as in a window
    names = [f"__strata_k{i}" for i in range(len(keys))]
    same = _all([F.col(f"`{k}`").eqNullSafe(F.col(n)) for k, n in zip(keys, names)])
    hot = F.broadcast(df.sparkSession.createDataFrame(found, df.select(*keys).schema).toDF(*names))
    cold = df.join(hot, same, "left_anti")
    cold = cold.withColumn(rk, F.rank().over(w)).filter(F.col(rk) == 1).drop(rk)
    mx = "__strata_max"
    top = df.join(hot, same, "inner").groupBy(*names).agg(F.max(order_col).alias(mx))     # a row per hot key
    kept = df.join(F.broadcast(top), same & F.col(order_col).eqNullSafe(F.col(mx)), "left_semi")
    return kept.unionByName(cold)


def latest_by_max_join(df: DataFrame, keys: Sequence[str], order_col: str,
                       hot_fraction: float = HOT_FRACTION, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Documented alternative (A12 + J5): group max, then join back on (keys, max).

    Equal to ``latest_per_key(ties='all')`` when dates are non-null; a key whose
    only date is null is lost here (null never equals null).
    """
    right = df.groupBy(*keys).agg(F.max(order_col).alias(order_col))
    return skew_join(df, right, list(keys) + [order_col], "left_semi", hot_fraction, hot_rows,
                     right_unique=True)


# ---------------------------------------------------------------- activity totals (A1)

def activity_stats(df: DataFrame, key: str, sums: Mapping[str, ColumnOrName],
                   count_col: str, count_name: str,
                   ratio_name: str | None = None,
                   ratio_numerators: Sequence[str] = (),
                   ratio_scale: int = 2) -> DataFrame:
    """Per-key totals: ``sum`` of each measure and ``count(count_col)``.

    Optionally adds ``ratio_name = round(sum(numerators) / count, scale)``,
    null when the count is 0 (K7, K8).
    """
    aggs = [F.sum(_c(v)).alias(k) for k, v in sums.items()]
    aggs.append(F.count(count_col).alias(count_name))
    out = df.groupBy(key).agg(*aggs)
    if ratio_name:
        out = out.withColumn(ratio_name, ratio(list(ratio_numerators), count_name, ratio_scale))
    return out


# ---------------------------------------------------------------- joins

def bytes_of(df: DataFrame) -> int:
    """Size of a frame's rows as JSON text, an upper estimate of what a broadcast holds: one aggregate."""
    size = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))) + F.lit(16)
    return int(df.agg(F.coalesce(F.sum(size.cast("long")), F.lit(0))).first()[0])


def lookup_join(df: DataFrame, dim: DataFrame, on, how: str = "left",
                max_broadcast_bytes: int | None = None,
                hot_fraction: float = HOT_FRACTION, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Join a lookup dimension.

    With ``max_broadcast_bytes`` the dimension's size is measured (one aggregate
    over it) and the hint is given only if it is within the bound.  Otherwise,
    and beyond the bound, a join on column names goes through ``skew_join``, so
    that a key with a large share of the rows stays where it is; a join on a
    condition is left to Spark (threshold, AQE).
    """
    if max_broadcast_bytes is not None and bytes_of(dim) <= max_broadcast_bytes:
        return df.join(F.broadcast(dim), on, how)
    if isinstance(on, str) or (isinstance(on, (list, tuple)) and all(isinstance(k, str) for k in on)):
        return skew_join(df, dim, [on] if isinstance(on, str) else list(on), how, hot_fraction, hot_rows)
    return df.join(dim, on, how)


def enrich(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
           order_by: Sequence[ColumnOrName], how: str = "left",
           columns: Sequence[ColumnOrName] | None = None,
           hot_fraction: float = HOT_FRACTION, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Left-join a one-to-many side after collapsing it to one row per key.

    ``order_by`` picks the surviving right row (first wins), so the result has
    exactly one row per left row and does not depend on scheduling.  A hot key
    on the left is joined where its rows lie (``skew_join``).
    """
    w = Window.partitionBy(right_key).orderBy(*[_c(o) for o in order_by])
    rn = "__strata_rn"
    one = right.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) == 1).drop(rn)
    joined = skew_join(left, one.withColumn(left_key, F.col(right_key)), [left_key], how,
                       hot_fraction, hot_rows, right_unique=True)
    if columns is None:
        return joined.drop(right_key) if right_key != left_key else joined
    return joined.select(*[_c(c) for c in columns])


def _estimated_bytes(df: DataFrame) -> int:
    """Spark's own estimate of a frame's size, from its plan; no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def hot_keys(df: DataFrame, keys: Sequence[str], hot_fraction: float = HOT_FRACTION,
             hot_rows: int = HOT_ROWS, nulls: bool = False) -> list:
    """Keys holding more than ``hot_fraction`` of the rows and more than ``hot_rows``, the largest first.

    At most ``1 / hot_fraction`` rows come to the driver.  A frame that Spark estimates at
    no more than 8 bytes for each of ``hot_rows`` isn't measured; others cost one partial aggregate,
    which observes its total.  With ``nulls`` a null key part counts as a value, else such rows aren't measured.
    """
    if _estimated_bytes(df) <= 8 * hot_rows:
        return []
    rows = df if nulls else df.filter(_all([F.col(f"`{k}`").isNotNull() for k in keys]))
    n, seen = "__strata_n", Observation()
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(n)).observe(seen, F.sum(n).alias("total"))
    top = counts.filter(F.col(n) > hot_rows).orderBy(F.desc(n)).limit(max(1, int(1 / hot_fraction))).collect()
    total = seen.get["total"] if top else 0
    return [tuple(r[k] for k in keys) for r in top if r[n] > total * hot_fraction]


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


_SKEW_HOWS = ("inner", "left", "left_outer", "left_semi", "left_anti")


def skew_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner",
              hot_fraction: float = HOT_FRACTION, hot_rows: int = HOT_ROWS,
              max_hot_right_bytes: int = 64 << 20, buckets: int = 64,
              right_unique: bool = False, measured: DataFrame | None = None) -> DataFrame:
    """Equi-join that keeps hot keys out of the shuffle (split, salting as fallback).

    1. keys holding more than ``hot_fraction`` of the left rows (and more than
       ``hot_rows``) are counted by a partial aggregate; there are at most
       ``1 / hot_fraction``.  Without any this is an ordinary join;
    2. the right rows of those keys -- at most as many as keys if
       ``right_unique``, else measured against ``max_hot_right_bytes`` -- are
       broadcast, and the hot keys' left rows are joined map-side, where they
       already are: no shuffle, however many rows or exact copies a key has;
    3. every other left row takes an ordinary shuffle join with ``right``;
       left rows with a null key match nothing and skip it;
    4. if the right side of the hot keys is too big to broadcast, the join
       falls back to ``salted_join``.

    Allowed for ``inner``, ``left``, ``left_semi`` and ``left_anti``.

    Cost: one aggregate over ``left`` unless Spark estimates it to be small
    (``hot_keys``), and ``left`` is read twice if hot keys exist.  ``measured``
    is a cheaper frame with the same keys to measure instead, such as the one
    that ``left`` was derived from.  When ``left`` is expensive to derive,
    write it to a table first.
    """
    if how not in _SKEW_HOWS:
        raise ValueError(f"skew_join does not support how={how!r}")
    keys = list(keys)
    found = hot_keys(left if measured is None else measured, keys, hot_fraction, hot_rows)
    if not found:
        return left.join(right, keys, how)
    schema = left.select(*keys).schema
    hot = F.broadcast(left.sparkSession.createDataFrame(found, schema))
    right_hot = right.join(hot, keys, "left_semi")
    if not right_unique and bytes_of(right_hot) > max_hot_right_bytes:
        return salted_join(left, right, keys, how, hot_fraction, hot_rows, buckets)
    some_null = ~_all([F.col(k).isNotNull() for k in keys])
    cold = left.filter(~some_null).join(hot, keys, "left_anti").join(right, keys, how)
    out = left.join(hot, keys, "left_semi").join(F.broadcast(right_hot), keys, how).unionByName(cold)
    if how in ("left", "left_outer", "left_anti"):
        out = out.unionByName(left.filter(some_null), allowMissingColumns=True)
    return out


def salted_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner",
                hot_fraction: float = HOT_FRACTION, hot_rows: int = HOT_ROWS,
                buckets: int = 64) -> DataFrame:
    """Equi-join whose hot keys are spread over ``buckets`` tasks (skew salting).

    For joins where ``left`` may hold a key with a large share of its rows
    and ``right`` is small per key (a max per key, a duplicate flag, a
    dimension row).  It works without AQE's skew-join splitting:

    1. keys holding more than ``hot_fraction`` of the left rows are found
       with a partial-aggregate count; there are at most ``1 / hot_fraction``
       of them, a proven bound, so that key set is broadcast;
    2. left rows of a hot key get a salt from a hash of the whole row, every
       other row salt 0;
    3. right rows of a hot key are repeated once per salt (``buckets`` copies
       of a bounded number of keys), every other row once with salt 0;
    4. the join runs on (keys, salt).

    Allowed for ``inner``, ``left``, ``left_semi`` and ``left_anti``, where
    repeating right rows cannot change the result.  The salt is a hash of the
    row, so a retried task puts every row in the same bucket again; exact
    duplicate rows share a bucket, which is why ``skew_join`` splits hot keys
    off first and uses salting only as its fallback.
    """
    if how not in _SKEW_HOWS:
        raise ValueError(f"salted_join does not support how={how!r}")
    keys = list(keys)
    found = hot_keys(left, keys, hot_fraction, hot_rows)       # at most 1 / hot_fraction rows
    schema = left.select(*keys).schema
    hot = F.broadcast(left.sparkSession.createDataFrame(found, schema).withColumn("__strata_hot", F.lit(True)))
    salt = "__strata_salt"
    lrow = F.xxhash64(*[F.col(c) for c in left.columns])
    l = (left.join(hot, keys, "left")
         .withColumn(salt, F.when(F.col("__strata_hot"), F.pmod(lrow, F.lit(buckets)))
                     .otherwise(F.lit(0)))
         .drop("__strata_hot"))
    r = (right.join(hot, keys, "left")
         .withColumn(salt, F.explode(F.when(F.col("__strata_hot"),
                                            F.sequence(F.lit(0), F.lit(buckets - 1)))
                                     .otherwise(F.array(F.lit(0)))))
         .drop("__strata_hot"))
    return l.join(r, keys + [salt], how).drop(salt)


def missing_keys(required: DataFrame, existing: DataFrame, on: str | Sequence[str],
                 hot_fraction: float = HOT_FRACTION, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rows of ``required`` without a match in ``existing`` (J6, J7): anti-join.

    The existing side is reduced to its distinct keys first: the partial
    aggregate collapses a hot key inside each map task, so the anti-join's
    shuffle carries one row per key and task, not every duplicate.  A hot key
    among the required rows is tested where its rows lie (``skew_join``).
    """
    keys = [on] if isinstance(on, str) else list(on)
    return skew_join(required, existing.select(*keys).distinct(), keys, "left_anti",
                     hot_fraction, hot_rows, right_unique=True)
