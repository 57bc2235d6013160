"""Incremental state, partition-wise publishing, file manifest, Bloom anti-join and layouts."""

import glob
import random
from decimal import Decimal

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from strata.operators import incremental as I
from strata.operators.bloom import flagged, key_filter, maybe_in, missing_keys_filtered
from strata.operators.star import missing_keys
from strata.plans.explain import plan_text
from strata.sinks import partitions as P
from strata.sinks import publish as W
from strata.sinks.layout import drop_tables, write_bucketed, write_clustered
from strata.sources import fs
from strata.sources.manifest import below, manifest

SCHEMA = "k int, d date, v double"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_latest_state_equals_full_run(spark, tmp_path):
    """Batches with late, repeated and null rows; a batch sent again changes nothing."""
    rng = random.Random(1)
    rows = [(rng.choice([None, *range(40)]), f"2024-01-{rng.randint(1, 28):02d}" if rng.random() < 0.9 else None, float(n)) for n in range(400)]
    df = spark.createDataFrame(rows, "k int, d string, v double").withColumn("d", F.to_date("d"))
    order = [F.col("d").desc_nulls_last(), F.col("v").asc()]
    target, parts = str(tmp_path / "state"), [df.filter("v < 150"), df.filter("v >= 100 AND v < 300"), df.filter("v >= 300 AND v < 300"), df.filter("v >= 250")]
    for n, batch in enumerate(parts, 1):
        assert I.update_latest(spark, target, n, batch, ["k"], order, buckets=8)
        assert not I.update_latest(spark, target, n, batch, ["k"], order, buckets=8)
    assert rows_of(I.read_state(spark, target)) == rows_of(I.merge_latest(None, df, ["k"], order))


def test_a_batch_rewrites_its_buckets_only(spark, tmp_path):
    target = str(tmp_path / "state")
    df = spark.range(1000).select(F.col("id").alias("k"), F.lit(1).alias("d"))
    I.update_latest(spark, target, 1, df, ["k"], [F.col("d").desc()], buckets=16)
    before = P.partition_values(spark, target)
    I.update_latest(spark, target, 2, df.filter("k = 7").withColumn("d", F.lit(2)), ["k"], [F.col("d").desc()], buckets=16)
    after = P.partition_values(spark, target)
    assert len(before) == 16 and sum(after[b] != before[b] for b in before) == 1
    assert I.read_state(spark, target).filter("d = 2").count() == 1 and I.read_state(spark, target).count() == 1000


def test_totals_follow_deletes_and_updates(spark, tmp_path):
    rng = random.Random(2)
    old = [(i, rng.choice([None, "a", "b", "c"]), rng.choice([None, 0.1, 0.2, 1e6])) for i in range(300)]
    new = [(i, g if rng.random() < 0.7 else "b", v if rng.random() < 0.7 else 0.3) for i, g, v in old if rng.random() < 0.8 and g != "c"]
    new += [(1000 + i, "d", 1.5) for i in range(5)] + [(None, "n", 1.0)]
    before, after = (spark.createDataFrame(x, "id long, g string, v double") for x in (old, new))
    state = lambda x: I.totals_state(x, ["g"], {"total": "v", "ids": "id"}, {"n": "v"})
    target = str(tmp_path / "totals")
    I.update_totals(spark, target, 1, state(before), ["g"])
    I.update_totals(spark, target, 2, state(I.changes(before, after, ["id"])), ["g"])
    full = {r.g: (r.total, r.ids, r.n, r.n_rows) for r in state(after).collect()}
    got = {r.g: (r.total, r.ids, r.n, r.n_rows) for r in I.read_state(spark, target).collect()}
    assert got == full and "c" not in got and isinstance(got["d"][0], Decimal)
    assert rows_of(I.changes(after, after, ["id"])) == []


def test_partition_publish(spark, tmp_path):
    target = str(tmp_path / "t")
    df = spark.range(100).select("id", (F.col("id") % 5).cast("string").alias("p")).withColumn(
        "p", F.when(F.col("p") == "4", None).otherwise(F.col("p")))
    first = P.publish_partitions(df, target, "p")
    assert first.rows == 100 and rows_of(P.read_partitions(spark, target)) == rows_of(df)
    second = P.publish_partitions(df.filter("p = '1'").withColumn("id", F.col("id") + 1000), target, "p", drop=["2"])
    values = P.partition_values(spark, target)
    assert {v for p, v in values.items() if p != "1"} == {first.version} and values["1"] == second.version
    files = glob.glob(f"{target}/data/version={second.version}/*/*.parquet")
    assert files and all("/p=1/" in f for f in files)
    assert P.read_partitions(spark, target).filter("p is null").count() == 20
    assert P.read_partitions(spark, target, ["1"]).agg(F.min("id")).first()[0] == 1001
    assert P.read_partitions(spark, target, ["2"]).count() == 0
    P.vacuum_partitions(spark, target, keep=1)
    assert P.read_partitions(spark, target).count() == 80
    assert not glob.glob(f"{target}/data/version={first.version}/p=1")
    with pytest.raises(W.PublishError):
        P.publish_partitions(df, target, "id")


def test_crash_before_commit_leaves_the_live_version(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "t")
    df = spark.range(10).select("id", F.lit(1).alias("p"))
    P.publish_partitions(df, target, "p")
    real = fs.create_marker
    monkeypatch.setattr(fs, "create_marker", lambda s, path, text="": (_ for _ in ()).throw(OSError("lost")) if "_commits" in path else real(s, path, text))
    with pytest.raises(OSError):
        P.publish_partitions(df.withColumn("id", F.col("id") + 5), target, "p")
    monkeypatch.setattr(fs, "create_marker", real)
    assert P.read_partitions(spark, target).agg(F.sum("id")).first()[0] == 45
    # a writer that took the same commit number first
    monkeypatch.setattr(fs, "create_marker", lambda s, path, text="": False if "_commits" in path else real(s, path, text))
    with pytest.raises(W.PublishError, match="another writer"):
        P.publish_partitions(df, target, "p")
    monkeypatch.setattr(fs, "create_marker", real)
    assert len(fs.list_names(spark, f"{target}/data")) == 1


def test_changed_copy_with_equal_count_is_refused(spark, tmp_path, monkeypatch):
    """The staged copy is compared by content."""
    target = str(tmp_path / "t")
    df = spark.range(100).select("id", F.col("id").cast("string").alias("s"), F.array("id").alias("a"))
    W.publish(df, target)
    real = W.read_parquet
    monkeypatch.setattr(W, "read_parquet", lambda spark, path: real(spark, path).withColumn("s", F.lit("x")))
    with pytest.raises(W.PublishError, match="other rows"):
        W.publish(df, target)
    monkeypatch.setattr(W, "read_parquet", real)
    assert rows_of(W.read_published(spark, target)) == rows_of(df)
    sums = [x.agg(W.content_sum(x)).first()[0] for x in (df, df.orderBy(F.desc("id")).repartition(7), df.limit(0), df.withColumn("m", F.create_map("id", "s")))]
    assert sums[0] == sums[1] == sums[3] != sums[2] == 0


def test_manifest_reads_no_content(spark, tmp_path):
    spark.range(50).select(F.col("id").cast("string").alias("value"), (F.col("id") % 3).alias("p")).write.partitionBy("p").text(str(tmp_path / "x"))
    (tmp_path / "x" / "UPPER.TXT").write_text("abc")
    found = manifest(spark, str(tmp_path / "x"), "*.[tT][xX][tT]")
    assert "ReadSchema: struct<path:string,modificationTime:timestamp,length:bigint>" in plan_text(found)
    got = {(r.folder, r.name.rsplit(".", 1)[1]): r.n for r in below(found, str(tmp_path / "x")).groupBy("folder", "name").agg(F.sum("length").alias("n")).collect()}
    assert got["", "TXT"] == 3 and {f for f, _ in got} == {"", "p=0", "p=1", "p=2"}
    assert found.agg(F.sum("length")).first()[0] == sum(len(str(i)) + 1 for i in range(50)) + 3


@pytest.mark.parametrize("bits_per_key", [1, 10])
def test_filtered_anti_join(spark, bits_per_key):
    """Equal to the plain anti-join for any rate of false positives; nulls never match."""
    have = spark.range(0, 3000, 3).select(F.when(F.col("id") > 0, F.col("id")).alias("k"), F.lit("x").alias("z"))
    need = spark.range(4000).select(F.when(F.col("id") % 100 != 1, F.col("id")).alias("k"), F.col("id").alias("v"), F.lit("x").alias("z"))
    for keys in (["k"], ["k", "z"]):
        assert rows_of(missing_keys_filtered(need, have, keys, bits_per_key)) == rows_of(missing_keys(need, have, keys).select(need.columns))
    assert rows_of(missing_keys_filtered(need, have, "k", max_filter_bytes=0)) == rows_of(missing_keys(need, have, "k").select(need.columns))
    bits = 32768
    flagged = maybe_in(need.filter("k > 0"), key_filter(have, ["k"], bits), ["k"], bits, "maybe")
    found = flagged.groupBy((F.col("k") % 3 == 0).alias("there"), (F.col("k") < 3000).alias("low")).agg(F.avg(F.col("maybe").cast("int")).alias("r")).collect()
    rate = {(r.there, r.low): r.r for r in found}
    assert rate[True, True] > 0.999 and rate[False, True] < 0.03 and rate[False, False] < 0.03


def test_bucketed_join_has_no_exchange(spark, tmp_path):
    a = write_bucketed(spark.range(1000).select("id", (F.col("id") * 2).alias("x")), "t_bucket_a", ["id"], 4, str(tmp_path / "a"))
    b = write_bucketed(spark.range(500, 1500).select("id", F.lit(1).alias("y")), "t_bucket_b", ["id"], 4, str(tmp_path / "b"))
    try:
        joined = a.hint("merge").join(b.groupBy("id").agg(F.sum("y").alias("y")), "id", "left")
        assert "Exchange" not in plan_text(joined) and "SortMergeJoin" in plan_text(joined)
        assert joined.filter("y = 1").count() == 500 and joined.count() == 1000
    finally:
        drop_tables(spark, "t_bucket_a", "t_bucket_b")


def groups_read(path, col, lo, hi):
    """Row groups whose statistics let a range of a column pass, and all."""
    hit = all_ = 0
    for f in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        at = {meta.schema.column(i).name: i for i in range(meta.num_columns)}[col]
        for g in range(meta.num_row_groups):
            s = meta.row_group(g).column(at).statistics
            all_ += 1
            hit += s.min <= hi and s.max >= lo
    return hit, all_


def test_clustering_prunes_on_both_columns(spark, tmp_path):
    df = spark.range(64_000).select((F.hash("id") % 1000).alias("a"), (F.hash(F.col("id") + 7) % 1000).alias("b")).cache()
    df.repartition(64).write.parquet(str(tmp_path / "plain"))
    write_clustered(df, str(tmp_path / "curve"), "a", "b", files=64)
    assert rows_of(spark.read.parquet(str(tmp_path / "curve"))) == rows_of(df)
    for c in ("a", "b"):
        plain, curve = (groups_read(tmp_path / x, c, 100, 110) for x in ("plain", "curve"))
        assert plain[0] == plain[1] and curve[0] <= curve[1] / 4, (plain, curve)
    df.unpersist()


def test_join_driven_pruning(spark, tmp_path):
    spark.range(1000).select("id", (F.col("id") % 10).alias("y")).write.partitionBy("y").parquet(str(tmp_path / "f"))
    spark.range(10).select(F.col("id").alias("year"), F.col("id").alias("place")).write.parquet(str(tmp_path / "d"))
    facts, dim = spark.read.parquet(str(tmp_path / "f")), spark.read.parquet(str(tmp_path / "d")).filter("place = 3")
    joined = facts.join(dim, F.col("y") == F.col("year"))
    assert "dynamicpruning" in plan_text(joined).lower()
    assert joined.count() == 100


@pytest.mark.parametrize("most", [4096, 32 << 20])
def test_flag_never_misses_a_key(spark, most):
    """Also with a filter that is too small for its keys, and next to rows without a key."""
    have = spark.range(0, 30_000, 3).withColumnRenamed("id", "k")
    df = spark.range(60_000).select(F.when(F.col("id") < 59_990, F.col("id")).alias("k"), F.col("id").alias("flagless"))
    got = flagged(df, have, "k", "maybe", max_filter_bytes=most).cache()
    assert got.count() == 60_000 and got.columns == ["k", "flagless", "maybe"] and got.filter("maybe is null").count() == 0
    assert got.filter("maybe").join(have, "k").count() == 10_000
    if most > 4096:
        assert got.filter("maybe").count() < 16_000
