"""Connected components of an edge table by alternating star contraction in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from strata.session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: a cut of the lineage that any executor can read."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(id, component) of every id in ``edges`` (a, b); component is the smallest id reachable.

    Each round links every id's larger neighbours to its smallest neighbour (large star), then its smaller
    neighbours and itself to the smallest of them (small star), until the edges don't change; they then lead
    from each id straight to its component's smallest.
    """
    now, state = _counted(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct(),
                          "edges")
    for _ in range(most_rounds):
        before = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u > v")
        small = large.join(large.groupBy("u").agg(F.min("v").alias("m")), "u")
        # the row of u's smallest neighbour leads u there, and the others their neighbours
        now, state = _counted(small.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
                                           F.col("m").alias("v")).distinct(), "stars")
        if state == before:
            return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
                now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
    raise RuntimeError("components did not settle")


def _counted(edges: DataFrame, name: str) -> tuple[DataFrame, dict]:
    """``edges`` written, and their count and the sum of their hashes, taken while they are written."""
    seen = Observation()
    out = written(edges.observe(seen, F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")), name)
    return out, seen.get
