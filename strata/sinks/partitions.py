"""Partition-wise publishing (W1, W2, W7): a new version rewrites the partitions that changed and names the others.

    <target>/data/version=<v>/<column>=<value>/   what a version wrote, never modified
    <target>/_manifests/<v>                       per partition value: the version that holds it
    <target>/_commits/<number>                    names a version; the greatest number is live

A version is its manifest.  Publishing writes the changed partitions, checks
the staged copy (rows and content, ``publish.content_sum``), writes the
manifest (the live one's entries, changed and dropped ones replaced) and takes
the next commit number.  The manifest builds on one commit, so the number after it is the only
one it may take: if another writer has that, the publish fails and can be
repeated.  A crash before the commit leaves the live version as it is.  Readers
see one version: the paths of its manifest and no others.

The manifest has an entry per partition and passes through the driver, as
Spark's own listing of partitions does; it holds no rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sinks.publish import Published, PublishError, _marker, _numbers, content_sum
from strata.sources import fs

VERSION = "version"


def _live(spark: SparkSession, target: str) -> tuple[int, str | None]:
    """(greatest commit number, the version that is live)."""
    numbers = _numbers(spark, target)
    for n in reversed(numbers):
        text = fs.read_text(spark, _marker(target, n))
        if text:
            return numbers[-1], text
    return (numbers[-1] if numbers else 0), None


def _manifest(spark: SparkSession, target: str, version: str | None) -> dict:
    if version is None:
        return {"column": None, "schema": None, "tag": None, "parts": {}}
    return json.loads(fs.read_text(spark, f"{target}/_manifests/{version}"))


def live_tag(spark: SparkSession, target: str) -> str | None:
    """The tag that the live version was published with (such as the number of the last batch in it)."""
    target = target.rstrip("/")
    return _manifest(spark, target, _live(spark, target)[1])["tag"]


def publish_partitions(df: DataFrame, target: str, column: str, drop: Sequence[str] = (), tag: str | None = None) -> Published:
    """Publish a version in which the partitions of ``df`` replace those of their values.

    ``column`` must be a string, integer or date; its value null is a partition, too.  ``drop`` names
    partition values (as folders spell them) that go, unless ``df`` brings them.  A frame without rows is
    allowed where partitions are dropped or something is published already.
    """
    spark = df.sparkSession
    target = target.rstrip("/")
    number, before = _live(spark, target)
    old = _manifest(spark, target, before)
    if old["column"] not in (None, column):
        raise PublishError(f"{target}: partitioned by {old['column']}, not {column}")
    version = uuid.uuid4().hex
    staged = f"{target}/data/{VERSION}={version}"
    schema = df.select(*[c for c in df.columns if c != column], column).schema
    try:
        rows = _stage(df, staged, column, schema)
        parts = {name.split("=", 1)[1]: version for name in fs.list_names(spark, staged) if name.startswith(f"{column}=")}
        kept = {v: at for v, at in old["parts"].items() if v not in parts and v not in set(drop)}
        if not kept and not parts and before is None:
            raise PublishError(f"{target}: a version without a partition; nothing published")
        text = json.dumps({"column": column, "schema": schema.json(), "tag": tag, "parts": kept | parts}, sort_keys=True)
        if not fs.create_marker(spark, f"{target}/_manifests/{version}", text):
            raise PublishError(f"{target}: manifest of {version} exists")
        if not fs.create_marker(spark, _marker(target, number + 1), version):
            raise PublishError(f"{target}: another writer committed {number + 1}; publish again on top of it")
    except BaseException:
        fs.delete(spark, staged)
        fs.delete(spark, f"{target}/_manifests/{version}")
        raise
    return Published(target, version, rows, (), number + 1)


def _stage(df: DataFrame, staged: str, column: str, schema) -> int:
    from strata.sinks.files import _observed

    df = df.select(*schema.fieldNames())
    observed, seen = _observed(df.hint("rebalance", column), {"content": content_sum(df)})
    observed.write.partitionBy(column).parquet(staged)
    got = seen.get
    copy = df.sparkSession.read.schema(schema).parquet(staged)
    stored = copy.agg(F.count(F.lit(1)).alias("n"), content_sum(copy).alias("content")).first()
    if (stored.n, stored.content) != (got["rows"], got["m_0"]):
        raise PublishError(f"{staged}: wrote {got['rows']} rows, content {got['m_0']}; the copy has {stored.n}, {stored.content}")
    return int(got["rows"])


def read_partitions(spark: SparkSession, target: str, values: Sequence[str] | None = None) -> DataFrame:
    """The live version; with ``values`` only those partitions (as folders spell them), missing ones ignored."""
    from pyspark.sql.types import StructType

    target = target.rstrip("/")
    _, version = _live(spark, target)
    if version is None:
        raise PublishError(f"nothing published at {target}")
    found = _manifest(spark, target, version)
    schema = StructType.fromJson(json.loads(found["schema"]))
    column, parts = found["column"], found["parts"]
    paths = [f"{target}/data/{VERSION}={parts[v]}/{column}={v}" for v in (parts if values is None else dict.fromkeys(values)) if v in parts]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{target}/data").parquet(*paths).select(*schema.fieldNames())


def partition_values(spark: SparkSession, target: str) -> dict[str, str]:
    """Per partition value of the live version: the version that wrote it."""
    target = target.rstrip("/")
    return dict(_manifest(spark, target, _live(spark, target)[1])["parts"])


def vacuum_partitions(spark: SparkSession, target: str, keep: int = 2) -> int:
    """Delete the files that none of the ``keep`` newest versions names; returns the folders deleted.

    Run it when no publish to ``target`` is in progress.
    """
    target = target.rstrip("/")
    named = {n: fs.read_text(spark, _marker(target, n)) for n in _numbers(spark, target)}
    stay = [n for n in sorted(named) if named[n]][-max(keep, 1):]
    manifests = {named[n]: _manifest(spark, target, named[n]) for n in stay}
    used = {(v, f"{m['column']}={value}") for m in manifests.values() for value, v in m["parts"].items()}
    gone = 0
    for folder in fs.list_names(spark, f"{target}/data"):
        version = folder.split("=", 1)[1]
        inside = [x for x in fs.list_names(spark, f"{target}/data/{folder}") if "=" in x]
        dead = [x for x in inside if (version, x) not in used]
        if len(dead) == len(inside):
            fs.delete(spark, f"{target}/data/{folder}")
        else:
            for x in dead:
                fs.delete(spark, f"{target}/data/{folder}/{x}")
        gone += len(dead)
    for version in fs.list_names(spark, f"{target}/_manifests"):
        if version not in manifests:
            fs.delete(spark, f"{target}/_manifests/{version}", recursive=False)
    for n in named:
        if n not in stay and n != max(named):
            fs.delete(spark, _marker(target, n), recursive=False)
    return gone
