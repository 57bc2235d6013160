"""File manifest as a scan (S10): path, size and time of the files under a folder.

Spark's ``binaryFile`` source with its content column pruned away: the scan's
read schema holds path, length and modification time only, no byte of a file
is read, and many folders are listed by tasks.  The result is a frame, so
sizes per prefix (A11), required names (F10, J7) and what is already loaded
(W11) are ordinary operators on it.  Spark's scans leave out files without a
byte; a required name is asked for by ``plans.pipeline.bronze_readiness``, which sees those.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def manifest(spark: SparkSession, path: str | Sequence[str], glob: str | None = None, recursive: bool = True) -> DataFrame:
    """(path, length, modified) of every file with content under ``path``, hidden ones left out."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.load(path if isinstance(path, str) else list(path)).select(
        "path", "length", F.col("modificationTime").alias("modified"))


def below(found: DataFrame, root: str, col: str = "path") -> DataFrame:
    """Adds ``folder`` and ``name``: where a file lies below ``root``, and what it is called."""
    rest = F.regexp_replace(F.col(col), f"^.*\\Q{root.rstrip('/').split(':', 1)[-1]}\\E/", "")
    return found.withColumn("folder", F.regexp_extract(rest, "^(.*)/[^/]*$", 1)).withColumn(
        "name", F.substring_index(rest, "/", -1))
