"""Reading, publishing and state over a second Hadoop scheme (S8): only Spark's file systems can open these paths."""

import uuid

from pyspark.sql import functions as F

from strata.operators import incremental as I
from strata.sinks.files import write_csv, write_parquet
from strata.sinks.partitions import publish_partitions, read_partitions, vacuum_partitions
from strata.sinks.publish import publish, read_published, vacuum
from strata.sources import fs
from strata.sources.files import read_csv, read_parquet
from strata.sources.manifest import below, manifest
from strata.sources.multiline import read_multiline_csv


def test_every_source_and_sink_over_viewfs(spark, tmp_path):
    mount = f"t{uuid.uuid4().hex[:8]}"
    spark.sparkContext._jsc.hadoopConfiguration().set(f"fs.viewfs.mounttable.{mount}.link./in", f"file://{tmp_path}")
    root = f"viewfs://{mount}/in"
    df = spark.range(40).select("id", F.concat(F.lit("a\n"), "id", F.lit('"')).alias("s"), (F.col("id") % 4).cast("int").alias("p"))
    rows = sorted(map(tuple, df.collect()))
    same = lambda x: sorted(map(tuple, x.select(df.columns).collect())) == rows

    assert write_parquet(df, f"{root}/t", partition_by=["p"]) == 40
    assert same(read_parquet(spark, f"{root}/t"))
    write_csv(df, f"{root}/c")
    schema = "id long, s string, p int"
    assert same(read_csv(spark, f"{root}/c", schema, multiline=True)) and same(read_multiline_csv(spark, f"{root}/c", schema))
    found = below(manifest(spark, f"{root}/t", "*.parquet"), f"{root}/t")
    assert {r.folder for r in found.select("folder").collect()} == {f"p={k}" for k in range(4)}

    publish(df, f"{root}/pub")
    publish(df, f"{root}/pub")
    assert same(read_published(spark, f"{root}/pub")) and len(vacuum(spark, f"{root}/pub", keep=1)) == 1
    publish_partitions(df, f"{root}/parts", "p")
    publish_partitions(df.filter("p = 1"), f"{root}/parts", "p")
    assert same(read_partitions(spark, f"{root}/parts")) and vacuum_partitions(spark, f"{root}/parts", keep=1) == 1
    assert I.update_latest(spark, f"{root}/state", 1, df, ["id"], [F.col("p")], buckets=4)
    assert same(I.read_state(spark, f"{root}/state"))
    assert fs.total_size(spark, f"{root}/t") > 0 and fs.total_size(spark, f"{root}/none") is None
