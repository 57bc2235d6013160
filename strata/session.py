"""Session helpers: a local session for tests/bench and the shared scratch root.

Library code never creates a session; it receives one.  Scratch output
(staged tables, CSV round-trips, streaming checkpoints) always goes under the
folder the cluster names in ``spark.checkpoint.dir``, because a machine-local
temporary folder is invisible to other executors and lost with them.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "strata", extra_conf: dict | None = None) -> SparkSession:
    """Session for tests and the bench; a cluster job brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("STRATA_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint root, setting a local one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is.  Only when nothing is configured (tests, the bench on one machine) is a
    fresh local folder created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get(_CHECKPOINT_KEY, None) \
        or sc.getConf().get(_CHECKPOINT_KEY, None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not sc.master.startswith("local"):
        # a driver-local folder is invisible to executors and lost with the driver
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster "
                           "(scratch tables, staged versions and streaming checkpoints go there)")
    local = tempfile.mkdtemp(prefix="strata-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


_scope: ContextVar[list[Callable[[], object]] | None] = ContextVar("strata_scratch", default=None)


@contextmanager
def scratch_scope() -> Iterator[list[Callable[[], object]]]:
    """Collects what removes the scratch folders taken, and frames kept, inside: call each once their results are consumed."""
    ends: list[Callable[[], object]] = []
    token = _scope.set(ends)
    try:
        yield ends
    finally:
        _scope.reset(token)


def at_scope_end(end: Callable[[], object]) -> None:
    """Adds to the scope, if there is one."""
    ends = _scope.get()
    if ends is not None:
        ends.append(end)


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique folder path under the shared checkpoint root."""
    from strata.sources.fs import delete

    root = ensure_checkpoint_dir(spark).rstrip("/")
    leaf = "-".join(p for p in parts if p) or "scratch"
    path = f"{root}/strata/{spark.sparkContext.applicationId}/{leaf}-{uuid.uuid4().hex[:12]}"
    at_scope_end(lambda: delete(spark, path))
    return path


def clear_scratch(spark: SparkSession) -> bool:
    """Delete this application's scratch folders under the checkpoint root; those of others stay.

    Queries that write scratch output (CSV round-trips, partitioned copies,
    staged pipeline runs) return lazy DataFrames over it, so they cannot clean
    up after themselves; call this once their results have been consumed.
    """
    from strata.sources.fs import delete

    return delete(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/strata/{spark.sparkContext.applicationId}")


def cluster_conf(input_bytes: int, total_cores: int, executor_memory_bytes: int,
                 cores_per_executor: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Settings that keep shuffle partitions inside executor memory, for the caller's builder.

    * initial shuffle partitions: enough that the largest shuffle (taken as the
      input size) splits into ``target_partition_bytes`` pieces, and at least
      three waves of tasks over the cores, so AQE has room to coalesce;
    * AQE advisory size = the target, and skew split on for partitions 5x the
      median and over 4x the target;
    * scan splits of at most the target, so no map task reads more than its share.

    The target is capped at 1/8 of the memory one task gets (executor memory /
    cores per executor), leaving room for sort buffers and hash tables.
    """
    per_task = max(1, executor_memory_bytes // max(1, cores_per_executor))
    target = max(16 << 20, min(target_partition_bytes, per_task // 8))
    partitions = max(3 * total_cores, -(-input_bytes // target))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target),
        "spark.sql.files.maxPartitionBytes": str(target),
    }
