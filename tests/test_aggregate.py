from pyspark.sql import functions as F

from strata.operators import aggregate as A


def test_having_boundary(spark):
    rows = [("A", i) for i in range(4)] + [("B", i) for i in range(5)]
    df = spark.createDataFrame(rows, "nat string, pid int")
    out = A.summarize(df, ["nat"], {"n": F.count("pid")}, having=F.col("n") >= 5).collect()
    assert [(r.nat, r.n) for r in out] == [("B", 5)]


def test_top_k_tie_break_is_deterministic(spark):
    df = spark.createDataFrame([(3, 100.0), (1, 100.0), (2, 100.0), (4, 50.0)], "id int, v double")
    out = A.top_k(df, 2, [F.col("v").desc()], [F.col("id").asc()])
    assert [r.id for r in out.collect()] == [1, 2]


def test_table_counts_total(spark):
    out = {r.table_name: r.row_count for r in A.table_counts(
        {"a": spark.range(3), "b": spark.range(5)}).collect()}
    assert out == {"a": 3, "b": 5, "TOTAL": 8}


def test_argument_checks(spark):
    import pytest
    with pytest.raises(ValueError):
        A.table_counts({})


def test_rank_rows_is_a_global_sort(spark):
    df = spark.range(5000).select("id", ((F.col("id") * 7919) % 100).alias("v")).repartition(7)
    got = A.rank_rows(df, [F.col("v").desc(), F.col("id").asc()]).collect()
    want = sorted(((r.id, r.v) for r in df.collect()), key=lambda x: (-x[1], x[0]))
    assert [(r.id, r.v) for r in sorted(got, key=lambda r: r["rank"])] == want
    assert sorted(r["rank"] for r in got) == list(range(1, 5001))


def test_size_summary(spark):
    df = spark.createDataFrame([("a", 0), ("a", 1 << 20), ("b", 10)], "g string, length long")
    got = {r.g: (r.n_files, r.total_bytes, r.empty_files, r.total_mb) for r in A.size_summary(df, "g").collect()}
    assert got == {"a": (2, 1 << 20, 1, 1.0), "b": (1, 10, 0, 0.0)}
