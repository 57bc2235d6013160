import os

from pyspark.sql import functions as F

from strata.sinks.files import write_csv, write_parquet
from strata.sources.files import read_csv, read_parquet


def test_csv_quoted_multiline_doubled_quote(spark, tmp_dir):
    path = os.path.join(tmp_dir, "raw")
    os.makedirs(os.path.join(path, "sub"))
    with open(os.path.join(path, "a.csv"), "w") as f:
        f.write('id,name,note\n1,"Smith, J","line one\nline ""two"""\n2,Doe,plain\n')
    with open(os.path.join(path, "sub", "B.CSV"), "w") as f:
        f.write("id,name,note\n3,Roe,upper-case suffix\n")
    with open(os.path.join(path, "ignored.txt"), "w") as f:
        f.write("id,name,note\n9,no,no\n")
    df = read_csv(spark, path, multiline=True)                       # all text, *.csv and *.CSV, recursive
    rows = {r.id: r for r in df.collect()}
    assert set(rows) == {"1", "2", "3"}
    assert rows["1"].name == "Smith, J"
    assert rows["1"].note == 'line one\nline "two"'
    typed = read_csv(spark, path, "id int, name string, note string", multiline=True)
    assert sorted(r.id for r in typed.collect()) == [1, 2, 3]


def test_write_returns_observed_count(spark, tmp_dir):
    n = write_parquet(spark.range(123), os.path.join(tmp_dir, "p"))
    assert n == 123
    assert spark.read.parquet(os.path.join(tmp_dir, "p")).count() == 123


def test_csv_round_trip(spark, tmp_dir):
    df = spark.createDataFrame([(1, 'a "q"\nb', 2.5)], "id long, s string, v double")
    write_csv(df, os.path.join(tmp_dir, "c"))
    back = read_csv(spark, os.path.join(tmp_dir, "c"), "id long, s string, v double", multiline=True)
    assert [tuple(r) for r in back.collect()] == [(1, 'a "q"\nb', 2.5)]


def test_partitioned_write_prunes_on_read(spark, tmp_dir):
    df = spark.range(1000).withColumn("y", (F.col("id") % 7 + 1995).cast("int"))
    path = os.path.join(tmp_dir, "by_year")
    write_parquet(df, path, partition_by=["y"])
    folders = sorted(x for x in os.listdir(path) if x.startswith("y="))
    assert folders == [f"y={y}" for y in range(1995, 2002)]
    one = read_parquet(spark, path).filter(F.col("y") == 1997)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(y" in plan and "(y#" in plan
    assert one.count() == df.filter("y = 1997").count()


def test_clear_scratch_removes_only_library_scratch(spark):
    from strata.session import clear_scratch, ensure_checkpoint_dir, scratch_path
    path = scratch_path(spark, "probe")
    write_parquet(spark.range(3), path)
    root = ensure_checkpoint_dir(spark)
    assert os.path.exists(path.replace("file:", ""))
    assert clear_scratch(spark)
    assert not os.path.exists(path.replace("file:", ""))
    assert os.path.exists(root.replace("file:", ""))      # the checkpoint root itself stays


def test_cluster_conf_for_100_tb():
    from strata.session import cluster_conf
    conf = cluster_conf(input_bytes=100 << 40, total_cores=8000,
                        executor_memory_bytes=32 << 30, cores_per_executor=8)
    target = int(conf["spark.sql.adaptive.advisoryPartitionSizeInBytes"])
    assert target == 256 << 20                       # 4 GiB per task / 8 > 256 MiB
    assert int(conf["spark.sql.shuffle.partitions"]) == (100 << 40) // target   # 409,600
    small = cluster_conf(10 << 30, 16, 4 << 30, 4)   # 1 GiB per task -> 128 MiB target
    assert int(small["spark.sql.adaptive.advisoryPartitionSizeInBytes"]) == 128 << 20
    assert int(small["spark.sql.shuffle.partitions"]) == 80


def test_partitioned_write_has_few_files_per_value(spark, tmp_dir):
    path = os.path.join(tmp_dir, "by_year")
    df = spark.range(20000).withColumn("y", (F.col("id") % 5 + 2000).cast("int")).repartition(16)
    assert write_parquet(df, path, partition_by=["y"]) == 20000
    files = [f for d in os.listdir(path) if d.startswith("y=") for f in os.listdir(os.path.join(path, d))
             if f.endswith(".parquet")]
    assert 5 <= len(files) <= 10               # not one per task and year


def test_new_column_in_an_old_folder_is_seen(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    spark.range(3).write.parquet(path)
    assert read_parquet(spark, path).columns == ["id"]
    spark.range(3).withColumn("x", F.lit(1)).write.mode("overwrite").parquet(path)
    assert set(read_parquet(spark, path).columns) == {"id", "x"}
