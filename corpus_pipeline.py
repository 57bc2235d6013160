"""From ``documents`` to packed sequences: quality rules, near-dedup, substring dedup, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's docs.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import common, near_dedup, queries, repetition, substring_dedup
from strata.llm.components import written
from strata.operators.bloom import flagged
from strata.session import scratch_path, scratch_scope

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    common.on_workers(spark)
    mark = "__quality_"
    found = repetition.measure_repetition(docs, "text", mark)
    return found.filter(~(repetition.base_failed(mark) | repetition.method_failed(mark))).select(*COLUMNS)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: its smallest id's.

    Rows that repeat an id and its text are one document; an id's other texts are documents of their own.
    Documents with a null id or without words stay, all of them.
    """
    common.on_workers(spark)
    groups = near_dedup.near_groups(docs).filter("doc_id is not null and n_shingles > 0")
    texts = groups.groupBy(F.col("doc_id").alias("__id"), "text_sha").agg(F.count("*").alias("n"), F.max("first").alias("first"))
    texts = written(texts.filter("not first or n > 1").drop("n"), "not-once")
    # rows of other ids stay where they are
    marked = flagged(docs.select(*COLUMNS, F.col("doc_id").cast("long").alias("__id")), texts, "__id", "__maybe")
    maybe = marked.filter("__maybe").withColumn("text_sha", near_dedup.text_sha("text")).join(texts, ["__id", "text_sha"], "left")
    return marked.filter("not __maybe").unionByName(maybe.filter("first is null").select(*marked.columns)).unionByName(
        maybe.filter("first").dropDuplicates(["__id", "text_sha"]).select(*marked.columns)).select(*COLUMNS)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of windows that occur elsewhere; one that loses all its words goes.

    A document that loses nothing keeps its text as it is; of others the words left are joined by spaces.
    """
    common.on_workers(spark)
    mark = "__repeats_"
    found = substring_dedup.remove_repeats(docs.select(*COLUMNS), prefix=mark)
    lost = F.col(mark + "n_removed") > 0
    found = found.filter(~(lost & (F.col(mark + "kept") == "")))
    return found.withColumn("text", F.when(lost, F.col(mark + "kept")).otherwise(F.col("text"))).withColumn(
        "n_chars", F.when(lost, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The binary pieces of the documents that are left.

    Executors have run the other stages before, and workers are used again: none keeps words for later.
    """
    common.on_workers(spark)
    return queries.packed(docs, keep_words=False)


_left: dict[str, list] = {}      # by application: what removes the last stage's scratch tables


def _alone(stage):
    """``stage`` whose scratch tables go when the next stage starts: its output is written then."""
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        app = spark.sparkContext.applicationId
        for end in _left.pop(app, ()):
            end()
        with scratch_scope() as ends:
            out = stage(spark, docs, sf_dir)
        _left[app] = ends
        return out

    return run


STAGES = [(name, _alone(stage)) for name, stage in (
    ("quality rules", quality), ("near dedup", near), ("substring dedup", substrings), ("packing", pack))]

# Near-dedup's components and the tokenizer's ids are beyond SQL; tests/llm holds the
# result against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, "pipeline", name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
