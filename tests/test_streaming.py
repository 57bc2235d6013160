import os

from strata.streaming.ingest import ingest_new_files

SCHEMA = "id int, name string"


def _write(path, name, rows):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write("id,name\n" + "".join(f"{i},{n}\n" for i, n in rows))


def test_only_new_files_are_ingested(spark, tmp_dir):
    landing, target, ckpt = (os.path.join(tmp_dir, x) for x in ("raw", "bronze", "_ckpt"))
    _write(landing, "a.csv", [(1, "x"), (2, "y")])
    assert ingest_new_files(spark, landing, target, ckpt, SCHEMA) == 2
    assert ingest_new_files(spark, landing, target, ckpt, SCHEMA) == 0      # nothing new
    _write(landing, "b.CSV", [(3, "z")])
    assert ingest_new_files(spark, landing, target, ckpt, SCHEMA) == 1
    rows = spark.read.parquet(target).collect()
    assert sorted(r.id for r in rows) == [1, 2, 3]
    assert {os.path.basename(r._source_file) for r in rows} == {"a.csv", "b.CSV"}


def test_batch_landing_skips_loaded_files(spark, tmp_dir):
    from strata.sinks.landing import land_new_files
    landing, target = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "bronze")
    _write(landing, "a.csv", [(1, "x"), (2, "y")])
    open(os.path.join(landing, "empty.csv"), "w").close()
    assert land_new_files(spark, landing, target, SCHEMA) == 2
    assert land_new_files(spark, landing, target, SCHEMA) == 0
    _write(os.path.join(landing, "sub"), "b.CSV", [(3, "z")])
    assert land_new_files(spark, landing, target, SCHEMA) == 1
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == [1, 2, 3]


def test_batch_landing_with_spaces_in_names(spark, tmp_dir):
    from strata.sinks.landing import land_new_files
    landing, target = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "bronze")
    _write(os.path.join(landing, "FIFA 23 Players"), "male players+x.csv", [(1, "x")])
    assert land_new_files(spark, landing, target, SCHEMA) == 1
    assert land_new_files(spark, landing, target, SCHEMA) == 0


def test_streaming_ingest_with_spaces_in_names(spark, tmp_dir):
    landing, target, ckpt = (os.path.join(tmp_dir, x) for x in ("raw", "bronze", "_ckpt"))
    _write(os.path.join(landing, "FIFA 23 Players"), "male players.csv", [(1, "x")])
    opts = {"recursiveFileLookup": "true"}
    assert ingest_new_files(spark, landing, target, ckpt, SCHEMA, options=opts) == 1
    assert ingest_new_files(spark, landing, target, ckpt, SCHEMA, options=opts) == 0


def test_many_small_batches_are_all_counted(spark, tmp_dir):
    landing, target, ckpt = (os.path.join(tmp_dir, x) for x in ("raw", "bronze", "_ckpt"))
    for i in range(5):
        _write(landing, f"f{i}.csv", [(i, "x"), (i + 10, "y")])
    assert ingest_new_files(spark, landing, target, ckpt, SCHEMA, max_files_per_trigger=1) == 10
    assert spark.read.parquet(target).count() == 10


def test_batch_landing_counts_malformed_lines(spark, tmp_dir):
    from strata.sinks.landing import land_new_files, landing_errors
    landing, target = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "bronze")
    os.makedirs(landing)
    with open(os.path.join(landing, "good.csv"), "w") as f:
        f.write("id,name\n1,a\n2,b\n")
    with open(os.path.join(landing, "bad.csv"), "w") as f:
        f.write("id,name\n3,c\nnot-a-number,d\n")
    assert land_new_files(spark, landing, target, SCHEMA, corrupt_col="_corrupt_record") == 4
    errs = {os.path.basename(r._source_file): (r.rows, r.malformed)
            for r in landing_errors(spark, target).collect()}
    assert errs == {"good.csv": (2, 0), "bad.csv": (2, 1)}
