"""Incremental landing of raw files (W10, W11) as a Structured Streaming job.

The reference uploaded every file of a folder and, in its notebook, skipped
the ones already present.  The Spark-native form of "load only the files not
loaded yet" is the streaming file source: its checkpoint remembers which
files were processed, ``trigger(availableNow=True)`` processes everything
new and stops, and the file sink commits each batch exactly once (its
``_spark_metadata`` log).  Re-running after a crash or on an unchanged
folder adds nothing; a lost executor only re-runs its tasks.

Rows keep their source file (``_metadata.file_path``) so every row can be
traced back to its raw file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.sources.files import CSV_GLOB


def landing_stream(spark: SparkSession, landing: str, schema: StructType | str,
                   fmt: str = "csv", glob: str | None = CSV_GLOB,
                   options: dict | None = None, source_col: str = "_source_file",
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming read of a landing folder with a declared schema."""
    reader = spark.readStream.schema(schema).format(fmt)
    opts = {"header": "true", "escape": '"'} if fmt == "csv" else {}
    opts.update(options or {})
    if glob:
        opts["pathGlobFilter"] = glob
    if max_files_per_trigger:
        opts["maxFilesPerTrigger"] = str(max_files_per_trigger)
    df = reader.options(**opts).load(landing)
    return df.withColumn(source_col, F.col("_metadata.file_path"))


def ingest_new_files(spark: SparkSession, landing: str, target: str, checkpoint: str,
                     schema: StructType | str, fmt: str = "csv", glob: str | None = CSV_GLOB,
                     options: dict | None = None, source_col: str = "_source_file",
                     max_files_per_trigger: int | None = None) -> int:
    """Append every not-yet-ingested file under ``landing`` to the Parquet ``target``.

    Returns the number of rows added by this run (0 when nothing is new), however many batches it takes:
    the reports are gathered while it runs, since Spark keeps the last hundred only.
    ``checkpoint`` must live in shared storage next to ``target``.
    """
    df = landing_stream(spark, landing, schema, fmt, glob, options, source_col,
                        max_files_per_trigger)
    # every batch reports its own row count
    query = (df.observe("landed", F.count(F.lit(1)).alias("rows")).writeStream.format("parquet")
             .option("checkpointLocation", checkpoint)
             .outputMode("append")
             .trigger(availableNow=True)
             .start(target))
    done: dict[int, int] = {}
    ended = False
    while not ended:
        ended = bool(query.awaitTermination(POLL_SECONDS))
        done |= {p.batchId: p.observedMetrics["landed"]["rows"] for p in query.recentProgress
                 if "landed" in p.observedMetrics}
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    if done and len(done) < max(done) - min(done) + 1:
        raise RuntimeError("all rows are landed, but reports of some batches were missed; count the target")
    return sum(done.values())


POLL_SECONDS = 0.5      # a hundred batches take longer
