"""Readers (S1-S8, S11): CSV with a declared schema, Parquet, partitioned Parquet.

Paths are URIs of any Hadoop filesystem the session is configured for
(``s3a://``, ``hdfs://``, ``file:``); endpoints and credentials are the
caller's Hadoop configuration, never library code (S8).

Schemas are declared (``StructType`` or DDL string); inference is opt-in
because it costs a separate full pass over the input.  ``multiline`` is opt-in,
too: a file read that way cannot be split, so one task reads it whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

CSV_GLOB = "*.[cC][sS][vV]"   # .csv and .CSV, as the reference's case-insensitive suffix test


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: StructType | str | None = None,
             *, header: bool = True, multiline: bool = False, escape: str = '"',
             infer_schema: bool = False, glob: str | None = CSV_GLOB,
             recursive: bool = True, repartition: int | None = None,
             extra_options: dict | None = None) -> DataFrame:
    """CSV scan (S1-S5, S11).

    ``schema`` None with ``infer_schema`` False reads every column as string
    (bronze style).  ``glob``/``recursive`` reproduce the reference's
    "every file ending in .csv under this folder" discovery.
    """
    reader = spark.read.option("header", str(header).lower()) \
        .option("multiLine", str(multiline).lower()) \
        .option("escape", escape) \
        .option("mode", "PERMISSIVE")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if schema is not None:
        reader = reader.schema(schema)
    elif infer_schema:
        reader = reader.option("inferSchema", "true")
    for k, v in (extra_options or {}).items():
        reader = reader.option(k, v)
    df = reader.csv(list(path) if not isinstance(path, str) else path)
    return df.repartition(repartition) if repartition else df


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet scan (S6, S7); partition columns are discovered from ``k=v`` folders.

    Selecting ``columns`` here (or anywhere later) prunes the scan's
    ReadSchema; filters on partition columns become PartitionFilters.
    """
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """``<root>/<name>.parquet`` -- the layout of the driver tables."""
    return read_parquet(spark, f"{root.rstrip('/')}/{name}.parquet")
