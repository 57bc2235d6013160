"""State that is merged with each batch instead of computed again.

* Latest row per key: the state holds one row per key; a batch is reduced to
  one row per key map-side, and the better of the two stays.  Late and repeated
  rows change nothing they should not.
* Totals: the state holds sums and counts per group.  Rows that go are added
  with the sign -1, replaced ones with both signs, so totals follow deletes and
  updates exactly; sums are decimals, which take back what they added.

``update_state`` keeps a state as a partition-wise published table: its rows
are dealt by a hash of the key over ``buckets`` partitions, and a batch reads and
rewrites the partitions that hold its keys and no others.  The number of the last
batch is published with the state, so a batch that is sent again is not merged again.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.clean import ColumnOrName, dedupe
from strata.sinks.partitions import live_tag, publish_partitions, read_partitions

SIGN = "sign"
ROWS = "n_rows"
BUCKET = "bucket"


def merge_latest(state: DataFrame | None, batch: DataFrame, keys: Sequence[str],
                 order_by: Sequence[ColumnOrName]) -> DataFrame:
    """One row per key, the first by ``order_by`` (a total order) of state and batch."""
    return dedupe(batch if state is None else state.unionByName(batch), keys, order_by)


def changes(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What turns ``before`` into ``after`` (same columns, unique ``keys``): rows with a ``sign``.

    -1: a row that is gone or was replaced, 1: a new one or its replacement.  One full outer join; a null
    key part is a value.
    """
    names = before.columns
    rest = [c for c in names if c not in keys]
    old = before.select(*keys, F.struct(*rest, F.lit(True).alias("there")).alias("old"))
    new = after.select(*[F.col(k).alias(f"__{k}") for k in keys], F.struct(*rest, F.lit(True).alias("there")).alias("new"))
    on = None
    for k in keys:
        same = F.col(k).eqNullSafe(F.col(f"__{k}"))
        on = same if on is None else on & same
    both = old.join(new, on, "full").filter(~F.col("old").eqNullSafe(F.col("new")))

    def side(at: str, key: Callable[[str], str], sign: int) -> Column:
        values = [F.col(key(c)).alias(c) if c in keys else F.col(f"{at}.`{c}`").alias(c) for c in names]
        return F.when(F.col(at).isNotNull(), F.struct(*values, F.lit(sign).alias(SIGN)))

    found = both.select(F.explode(F.array_compact(F.array(
        side("old", lambda c: c, -1), side("new", lambda c: f"__{c}", 1)))).alias("row"))
    return found.select("row.*")


def totals_state(df: DataFrame, keys: Sequence[str], sums: Mapping[str, ColumnOrName],
                 counts: Mapping[str, ColumnOrName] | None = None) -> DataFrame:
    """Sums, counts of non-null values and ``n_rows`` per group, of rows with a ``sign`` or of plain ones.

    Fractional measures are summed as decimal(38,6), so that a retraction leaves nothing behind.
    """
    sign = F.col(SIGN) if SIGN in df.columns else F.lit(1)
    kinds = dict(df.select(*[(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in sums.items()]).dtypes)

    def exact(name: str, c: ColumnOrName) -> Column:
        c = F.col(c) if isinstance(c, str) else c
        return c.cast("decimal(28,6)") if kinds[name] in ("float", "double") or kinds[name].startswith("decimal") else c.cast("long")

    aggs = [F.coalesce(F.sum(exact(k, v) * sign), F.lit(0)).alias(k) for k, v in sums.items()]
    aggs += [F.coalesce(F.sum(F.when((F.col(v) if isinstance(v, str) else v).isNotNull(), sign)), F.lit(0)).alias(k)
             for k, v in (counts or {}).items()]
    out = df.groupBy(*keys).agg(*aggs, F.sum(sign.cast("long")).alias(ROWS))
    return out.select(*keys, *[F.col(k).cast("long" if kinds[k] not in ("float", "double") and not kinds[k].startswith("decimal")
                                             else "decimal(38,6)").alias(k) for k in sums],
                      *[F.col(k).cast("long").alias(k) for k in (counts or {})], F.col(ROWS).cast("long").alias(ROWS))


def merge_totals(state: DataFrame | None, delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """State and delta added up; groups without rows are gone."""
    if state is not None:
        kinds = {f.name: f.dataType for f in delta.schema}
        delta = state.unionByName(delta).groupBy(*keys).agg(
            *[F.sum(c).cast(kinds[c]).alias(c) for c in delta.columns if c not in keys])
    return delta.filter(F.col(ROWS) != 0)


def update_state(spark: SparkSession, target: str, batch_no: int, batch: DataFrame, keys: Sequence[str],
                 merge: Callable[[DataFrame | None, DataFrame], DataFrame], buckets: int = 64) -> bool:
    """Merge a batch (rows like the state's) into the state at ``target``; False if it is in already.

    Batches have ascending numbers.  ``merge`` gets the state's rows (None at first) and the batch's, both with
    their ``bucket``, of some buckets of keys; it must treat each key by itself.
    """
    last = live_tag(spark, target)
    if last is not None and batch_no <= int(last):
        return False
    batch = batch.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    touched = [str(r[0]) for r in batch.select(BUCKET).distinct().collect()]          # at most ``buckets`` rows
    if last is None and not touched:
        return False
    state = None if last is None else read_partitions(spark, target, touched)
    publish_partitions(merge(state, batch), target, BUCKET, drop=touched, tag=str(batch_no))
    return True


def update_latest(spark: SparkSession, target: str, batch_no: int, batch: DataFrame, keys: Sequence[str],
                  order_by: Sequence[ColumnOrName], buckets: int = 64) -> bool:
    """Merge a batch of rows into the latest-row state at ``target`` (N1, D2); ``order_by`` is a total order."""
    return update_state(spark, target, batch_no, batch, keys,
                        lambda state, new: merge_latest(state, new, keys, order_by), buckets)


def update_totals(spark: SparkSession, target: str, batch_no: int, delta: DataFrame, keys: Sequence[str],
                  buckets: int = 64) -> bool:
    """Add a batch's ``totals_state`` to the totals at ``target`` (A1, A2)."""
    return update_state(spark, target, batch_no, delta, keys,
                        lambda state, new: merge_totals(state, new, [*keys, BUCKET]), buckets)


def read_state(spark: SparkSession, target: str) -> DataFrame:
    """The rows of a state, without the bucket."""
    return read_partitions(spark, target).drop(BUCKET)
