"""Interaction of filters: what each removes after every prefix of every order.

Each filter has a table of the ids that fail it (a folder per filter).  What a
prefix leaves does not depend on the order within it, so the prefixes are the
subsets of the filters, built level by level: the left-semi join of a prefix's
survivors with a filter's table is what the filter removes next, the left-anti
join the survivors of the longer prefix.  Rows that fail nothing survive every
prefix; they are counted, and only the others take part in the joins.

The joins run on row numbers, which are unique, so no key is hot.  All that is
read off later (redundant rows, sole failures, Shapley sums) follows from the
counts per (part, prefix, filter).

Results: null texts are empty.  A row counts as often as it occurs; rows with a
null id are rows as any other, have no labels and are never copies of a smaller
id.  A null part is the empty string.  An empty table has no parts and gives no
rows.  Very long texts are measured whole.  Columns of ``df`` other than those
named are not read, so their names can't clash.
"""

from __future__ import annotations

from collections.abc import Mapping
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm import salted
from strata.llm.components import written
from strata.session import scratch_path

#: orders grow as the factorial of the filters, prefixes as a power of two
MOST_FILTERS = 8
COPIES = "copies"


def failures(df: DataFrame, filters: Mapping[str, Column | str], id: str, text: str, part: str) -> DataFrame:
    """(row, id, part, failed): a row's failed filters by number; written.

    A filter is a Boolean column over ``df`` (true: the row fails), or ``COPIES``: a row fails if its text
    (null: empty) also belongs to a row of a smaller id.
    """
    copies = [n for n, f in enumerate(filters.values()) if isinstance(f, str)]
    if any(isinstance(f, str) and f != COPIES for f in filters.values()) or len(copies) > 1:
        raise ValueError(f"a filter is a column or, once, {COPIES!r}")
    own = [F.when(f, F.lit(n)) for n, f in enumerate(filters.values()) if not isinstance(f, str)]
    found = df.select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{id}`").alias("id"),
        F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
        F.array_compact(F.array(*own)).cast("array<int>").alias("failed"),
        F.sha2(F.coalesce(F.col(f"`{text}`"), F.lit("")), 256).alias("key"))
    found = written(found, "measured")
    if not copies:
        return found.drop("key")
    rows = salted.with_salt(found.filter("id is not null"), F.col("row"))
    least = salted.totals(rows, ["key"],
                          [F.min("id").alias("least"), F.max("id").alias("most")],
                          [F.min("least").alias("least"), F.max("most").alias("most")],
                          keep=F.col("least") < F.col("most")).drop("most")
    again = rows.join(least, ["key", salted.SALT]).filter("id > least").select("row", F.lit(copies[0]).alias("copy"))
    return written(found.join(again, "row", "left").select(
        "row", "id", "part",
        F.when(F.col("copy").isNull(), F.col("failed")).otherwise(F.array_append("failed", F.col("copy"))).alias("failed")),
        "failures")


def audit(df: DataFrame, filters: Mapping[str, Column | str], labels: Mapping[str, DataFrame], id: str = "doc_id",
          text: str = "text", part: str = "source") -> DataFrame:
    """A row per (part, order of the filters, step).

    ``labels`` maps a name to the ids (first column) of rows whose loss is counted as ``<name>_lost``.
    Columns: part, filter_order (names joined by nothing), step from 1, and longs: ``kept`` after the step,
    ``removed`` by it, ``redundant`` (fail its filter, removed earlier), ``unique_fails`` (fail its filter
    only), the losses, and ``shapley`` (its filter's removals summed over all orders).
    """
    n, names = len(filters), list(filters)
    if not 1 <= n <= MOST_FILTERS:
        raise ValueError(f"1 to {MOST_FILTERS} filters")
    found = failures(df, filters, id, text, part)
    lost = [f"{name}_lost" for name in labels]
    parts = found.groupBy("part").agg(F.count("*").alias("n"), F.count_if(F.size("failed") == 0).alias("clean"))

    # one id table per filter, and the rows that are in any of them with their labels
    tables = scratch_path(df.sparkSession, "failing-ids")
    found.select("row", F.explode("failed").alias("filter")).write.partitionBy("filter").parquet(tables)
    failing = df.sparkSession.read.schema("row long, filter int").parquet(tables)
    rows = found.filter(F.size("failed") > 0).select("row", "id", "part")
    for name, ids in zip(lost, labels.values()):
        marked = ids.select(F.col(ids.columns[0]).alias("id"), F.lit(1).alias(name)).distinct()
        rows = rows.join(marked, "id", "left")
    rows = rows.select(F.lit(0).alias("prefix"), "row", "part", *(F.coalesce(c, F.lit(0)).alias(c) for c in lost))

    removed, alive = [], []
    survivors = written(rows, "survivors")
    for _ in range(n):
        alive.append(survivors.groupBy("part", "prefix").agg(F.count("*").alias("left")))
        others = F.filter(F.sequence(F.lit(0), F.lit(n - 1)),
                          lambda f: F.expr("prefix").bitwiseAND(_bit(f)) == 0)
        next_ = survivors.withColumn("filter", F.explode(others))
        removed.append(next_.join(failing, ["filter", "row"], "left_semi").groupBy("part", "prefix", "filter").agg(
            F.count("*").alias("removed"), *(F.sum(c).alias(c) for c in lost)))
        longer = next_.filter(F.col("prefix") < _bit(F.col("filter")))         # each subset is made once
        survivors = written(longer.join(failing, ["filter", "row"], "left_anti").select(
            F.col("prefix").bitwiseOR(_bit(F.col("filter"))).alias("prefix"), "row", "part", *lost), "survivors")

    # of a part: at most 2**n survivor counts and n * 2**(n-1) removals
    alive = _union(alive).groupBy("part").agg(
        F.map_from_entries(F.collect_list(F.struct("prefix", "left"))).alias("alive"))
    removed = _union(removed)
    place = F.col("prefix") * n + F.col("filter")
    orders = F.element_at(F.array(*[F.lit(factorial(k) * factorial(n - 1 - k)) for k in range(n)]),
                          F.bit_count("prefix") + 1)
    shares = removed.groupBy("part", "filter").agg(F.sum(F.col("removed") * orders).alias("share")) \
        .groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("filter", "share"))).alias("shares"))
    removed = removed.groupBy("part").agg(F.map_from_entries(F.collect_list(
        F.struct(place, F.struct("removed", *lost)))).alias("cells"))
    table = parts.join(alive, "part", "left").join(removed, "part", "left").join(shares, "part", "left")

    number = {name: str(k) for k, name in enumerate(names)}
    texts = ["".join(number[x] for x in order) for order in permutations(names)]
    table = table.withColumn("order", F.explode(F.split(F.lit(",".join(texts)), ","))) \
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(n))))
    digit = lambda at: F.substring("order", at, 1).cast("int")
    table = table.withColumn("filter", digit(F.col("step"))).withColumn("prefix", F.aggregate(
        F.filter(F.sequence(F.lit(1), F.lit(n)), lambda k: k < F.col("step")), F.lit(0),
        lambda mask, k: mask.bitwiseOR(_bit(digit(k)))))
    cell = lambda prefix, c: F.coalesce(F.col("cells")[prefix * n + F.col("filter")][c], F.lit(0)).cast("long")
    rest = F.lit((1 << n) - 1) - _bit(F.col("filter"))
    own = F.col("prefix")
    return table.select(
        "part",
        F.array_join(F.transform(F.split("order", ""), lambda d: F.element_at(
            F.array(*map(F.lit, names)), d.cast("int") + 1)), "").alias("filter_order"),
        "step",
        (F.col("clean") + F.coalesce(F.col("alive")[own.bitwiseOR(_bit(F.col("filter")))], F.lit(0))).alias("kept"),
        cell(own, "removed").alias("removed"),
        (cell(F.lit(0), "removed") - cell(own, "removed")).alias("redundant"),
        cell(rest, "removed").alias("unique_fails"),
        *(cell(own, c).alias(c) for c in lost),
        F.coalesce(F.col("shares")[F.col("filter")], F.lit(0)).cast("long").alias("shapley"))


def _bit(f: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1), f)


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def base_filters(text: str = "text") -> dict[str, Column | str]:
    """A: under 50 words.  B: under 65 % of the words are distinct.  C: over 5 % of the characters are A-Z.
    D: holds a symbol of ``#$%&*|``.  E: a copy of a smaller id's text.  Words are runs of anything but
    0x20 and 0x09-0x0D.
    """
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    words = F.array_remove(F.split(t, "[\\x20\\x09-\\x0D]+"), "")
    capitals = F.length(t) - F.length(F.translate(t, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {
        "A": F.size(words) < 50,
        "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * 65,
        "C": capitals * 100 > F.length(t) * 5,
        "D": t.rlike("[#$%&*|]"),
        "E": COPIES,
    }
