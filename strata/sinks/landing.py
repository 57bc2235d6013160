"""Landing of raw files not yet loaded (W10, W11) that keeps malformed lines and counts them per file.

Which files were loaded is remembered by the streaming file source's log
(``strata.streaming.ingest``), which grows with files, not rows; no list of
paths passes through the driver's code, and nothing of the target is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata.streaming.ingest import ingest_new_files


def land_new_files(spark: SparkSession, landing: str, target: str, schema: StructType | str,
                   checkpoint: str | None = None, source_col: str = "_source_file",
                   options: dict | None = None, corrupt_col: str | None = None) -> int:
    """Append rows of not-yet-landed CSV files under ``landing``, at any depth, to Parquet ``target``.

    Returns the number of rows added.  The log lies in ``checkpoint`` (beside
    the target by default).  With ``corrupt_col`` a malformed line does not fail
    the load: its raw text is kept in that column (fields null) and
    ``landing_errors`` counts such lines per file, like the reference's per-file
    error count.
    """
    opts = {"recursiveFileLookup": "true", **(options or {})}
    if corrupt_col:
        schema = _with_corrupt_col(spark, schema, corrupt_col)
        opts["columnNameOfCorruptRecord"] = corrupt_col
    return ingest_new_files(spark, landing, target, checkpoint or f"{target.rstrip('/')}_log", schema,
                            options=opts, source_col=source_col)


def _with_corrupt_col(spark: SparkSession, schema: StructType | str, name: str) -> StructType:
    st = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    if name in st.fieldNames():
        return st
    return StructType(st.fields + [StructField(name, StringType(), True)])


def landing_errors(spark: SparkSession, target: str, corrupt_col: str = "_corrupt_record",
                   source_col: str = "_source_file") -> DataFrame:
    """Malformed lines per landed file (0 for clean files)."""
    df = spark.read.parquet(target)
    return df.groupBy(source_col).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(F.col(corrupt_col)).alias("malformed"))

