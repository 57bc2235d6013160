"""Validated publishing (W4-W8): stage, check, switch, re-check.

The reference staged a table, then dropped the live one and renamed the
staged one inside a database transaction.  With plain files the same
guarantees come from immutable versions plus one numbered commit marker:

    <target>/_versions/<version>/   the data, written once, never modified
    <target>/_commits/<number>      names a version; the greatest number is live

1. the frame is written to a new version folder; the row count is observed
   in the same job (W5, W6, W9);
2. an empty result raises before anything becomes visible (W5);
3. the staged folder is re-read: its count and the sum of its rows' hashes
   must equal those observed in the write (W8);
4. the marker with the next free number is created with ``overwrite=false``
   -- the one atomic step (W7).  Of two writers that try the same number one
   gets it and the other takes the next, so commits are ordered by when they
   happen, not by clocks, and a slow writer that commits last is live.  A
   failure anywhere before leaves the previous version live and removes what
   was staged;
5. the marker is read again and must name the new version (W8).

The claim needs a store whose create-if-absent is atomic: HDFS, ABFS and local
disks are; on S3 only with conditional writes turned on in the connector.  A
marker without content is one whose writer died; readers pass it over.

Readers resolve the newest marker once per query (``read_published``), so a
reader never sees a half-written version.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from strata.sinks.files import write_parquet_observed
from strata.sources import fs
from strata.sources.files import read_parquet


_CONTENT = "content of the rows"        # a metric beside the rules'


class PublishError(RuntimeError):
    pass


@dataclass(frozen=True)
class Published:
    target: str
    version: str
    rows: int
    # (rule, violating rows) for every rule checked on the staged copy
    violations: tuple[tuple[str, int], ...] = ()
    number: int = 0

    @property
    def path(self) -> str:
        return f"{self.target}/_versions/{self.version}"


def content_sum(df: DataFrame) -> Column:
    """Sum of the rows' 64-bit hashes, exact and without regard to their order: what a frame holds.

    Maps can't be hashed and are left out, in structs and arrays, too.
    """
    def has_map(t) -> bool:
        return isinstance(t, MapType) or any(has_map(x) for x in (
            [f.dataType for f in t.fields] if hasattr(t, "fields") else [t.elementType] if hasattr(t, "elementType") else []))

    cols = [F.col(f"`{f.name}`") for f in df.schema if not has_map(f.dataType)]
    return F.coalesce(F.sum((F.xxhash64(*cols) if cols else F.lit(0)).cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)")


def _numbers(spark: SparkSession, target: str) -> list[int]:
    """Commit numbers taken so far, ascending."""
    return sorted(int(n) for n in fs.list_names(spark, f"{target}/_commits") if n.isdigit())


def _marker(target: str, number: int) -> str:
    return f"{target}/_commits/{number:012d}"


def current_version(spark: SparkSession, target: str) -> str | None:
    """Name of the live version, or None."""
    target = target.rstrip("/")
    for number in reversed(_numbers(spark, target)):
        version = fs.read_text(spark, _marker(target, number))
        if version:
            return version
    return None


def _commit(spark: SparkSession, target: str, version: str) -> int:
    """Take the next free commit number for ``version``."""
    number = max(_numbers(spark, target), default=0) + 1
    while not fs.create_marker(spark, _marker(target, number), version):
        number += 1
    return number


def read_published(spark: SparkSession, target: str) -> DataFrame:
    """The live version of a published table: how analysts read gold."""
    target = target.rstrip("/")
    version = current_version(spark, target)
    if version is None:
        raise PublishError(f"nothing published at {target}")
    return read_parquet(spark, f"{target}/_versions/{version}")


def publish(df: DataFrame, target: str, min_rows: int = 1, rules=None,
            enforce_rules: bool = True) -> Published:
    """Stage ``df`` as a new version of ``target`` and make it live if it checks out.

    ``rules`` (``strata.operators.quality.Rule`` list) are counted on the
    staged copy -- read back, not recomputed -- in one pass.  With
    ``enforce_rules`` any violation refuses the version, as a database CHECK
    refuses an insert; otherwise the counts are returned in
    ``Published.violations``.  Whatever fails before the commit, the staged
    folder is removed and the previous version stays live.
    """
    spark = df.sparkSession
    target = target.rstrip("/")
    version = uuid.uuid4().hex
    staged = f"{target}/_versions/{version}"
    try:
        rows, counts = _stage(df, target, staged, min_rows, list(rules or []), enforce_rules)
        number = _commit(spark, target, version)              # the switch
    except BaseException:
        fs.delete(spark, staged)
        raise
    if fs.read_text(spark, _marker(target, number)) != version:
        raise PublishError(f"{target}: commit {number} does not name {version}")
    return Published(target, version, rows, counts, number)


def _stage(df: DataFrame, target: str, staged: str, min_rows: int, rules: list,
           enforce_rules: bool) -> tuple[int, tuple[tuple[str, int], ...]]:
    """Write and check a version; (rows, violations per rule)."""
    from strata.operators.quality import row_rule_metrics, violation_report

    spark = df.sparkSession
    # row count, content and row-rule violations come out of the write job itself
    observed, metrics = write_parquet_observed(df, staged, row_rule_metrics(rules) | {_CONTENT: content_sum(df)})
    if observed < min_rows:
        raise PublishError(f"{target}: {observed} rows staged, at least {min_rows} required; "
                           "nothing published")
    copy = read_parquet(spark, staged)
    stored = copy.agg(F.count(F.lit(1)).alias("n"), content_sum(copy).alias("content")).first()
    if stored.n != observed:
        raise PublishError(f"{target}: wrote {observed} rows but staged copy has {stored.n}")
    if stored.content != metrics[_CONTENT]:
        raise PublishError(f"{target}: the staged copy has other rows than were written")
    if not rules:
        return observed, ()
    # key rules need a grouping: one pass over the staged copy, a row per rule back
    key_rules = [r for r in rules if r.unique_keys]
    keyed = {r["rule"]: int(r["violations"]) for r in violation_report(
        read_parquet(spark, staged), key_rules).collect()} if key_rules else {}
    counts = tuple((r.name, int(metrics.get(r.name) or 0) if r.predicate is not None
                    else keyed[r.name]) for r in rules)
    broken = [c for c in counts if c[1] > 0]
    if broken and enforce_rules:
        raise PublishError(f"{target}: rules violated {broken}; nothing published")
    return observed, counts


def vacuum(spark: SparkSession, target: str, keep: int = 2) -> list[str]:
    """Delete all but the ``keep`` newest committed versions and any uncommitted ones.

    Run it when no publish to ``target`` is in progress: a version being
    staged is uncommitted and would be removed.  Readers that resolved an
    older version before the vacuum may fail on it afterwards.
    """
    target = target.rstrip("/")
    named = {n: fs.read_text(spark, _marker(target, n)) for n in _numbers(spark, target)}
    committed = [n for n in sorted(named) if named[n]]
    stay = set(committed[-keep:]) if keep > 0 else set()
    live = {named[n] for n in stay}
    removed = []
    for name in fs.list_names(spark, f"{target}/_versions"):
        if name not in live:
            fs.delete(spark, f"{target}/_versions/{name}", recursive=True)
            removed.append(name)
    # the greatest number stays taken even if its version goes, so that numbers never come back
    for n in named:
        if n not in stay and n != max(named):
            fs.delete(spark, _marker(target, n), recursive=False)
    return removed
