"""Writers (W1, W2, W3, W9): Parquet/CSV overwrite with the row count observed in the same pass.

The reference counted every written frame twice more after writing, each
count re-running the whole lineage.  Here the count is an ``Observation``
collected by the write job itself.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def _observed(df: DataFrame, metrics: Mapping[str, Column] | None = None
              ) -> tuple[DataFrame, Observation]:
    obs = Observation(f"strata_write_{uuid.uuid4().hex[:8]}")
    extra = [c.alias(f"m_{i}") for i, c in enumerate((metrics or {}).values())]
    return df.observe(obs, F.count(F.lit(1)).alias("rows"), *extra), obs


def write_parquet_observed(df: DataFrame, path: str, metrics: Mapping[str, Column],
                           mode: str = "overwrite") -> tuple[int, dict[str, object]]:
    """Write Parquet; return the row count and extra aggregate ``metrics``, all
    computed by the write job itself (no second pass)."""
    observed, obs = _observed(df, metrics)
    observed.write.mode(mode).parquet(path)
    got = obs.get
    return int(got["rows"]), {k: got[f"m_{i}"] for i, k in enumerate(metrics)}


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] | None = None,
                  mode: str = "overwrite") -> int:
    """Write Parquet and return the number of rows written.

    With ``partition_by`` the rows are rebalanced on the partition columns
    first: AQE splits a value too big for one task and merges small ones, so a
    value has about as many files as its size asks for, not one per task.
    """
    observed, obs = _observed(df.hint("rebalance", *partition_by) if partition_by else df)
    writer = observed.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return int(obs.get["rows"])


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = True,
              escape: str = '"') -> int:
    """Write CSV with a header and doubled-quote escaping; returns rows written."""
    observed, obs = _observed(df)
    observed.write.mode(mode).option("header", str(header).lower()) \
        .option("escape", escape).option("quoteAll", "false").csv(path)
    return int(obs.get["rows"])


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict,
               mode: str = "overwrite") -> int:
    """JDBC table write (W3), optional sink; needs the driver jar on the classpath."""
    observed, obs = _observed(df)
    observed.write.mode(mode).jdbc(url, table, properties=properties)
    return int(obs.get["rows"])
