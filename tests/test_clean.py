from pyspark.sql import functions as F

from strata.operators import clean as C


def test_dedupe_is_deterministic_and_keeps_first(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 3), (2, "z", 1), (2, "y", 1)],
                               "k int, v string, s int")
    out = C.dedupe(df, ["k"], [F.col("s").desc(), F.col("v").asc()]).orderBy("k").collect()
    assert [(r.k, r.v) for r in out] == [(1, "a"), (2, "y")]
    # same result whatever the input partitioning
    again = C.dedupe(df.repartition(3), ["k"], [F.col("s").desc(), F.col("v").asc()])
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, out))


def test_dedupe_composite_key(spark):
    df = spark.createDataFrame([(1, "2023-01-01", 5.0), (1, "2023-01-01", 7.0),
                                (1, "2023-02-01", 1.0)], "k int, d string, v double")
    out = C.dedupe(df, ["k", "d"], C.total_order(df, ["k", "d"])[2:])
    assert sorted((r.d, r.v) for r in out.collect()) == [("2023-01-01", 5.0), ("2023-02-01", 1.0)]


def test_dedupe_idempotent(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 3)], "k int, v int")
    once = C.dedupe(df, ["k"], ["v"])
    twice = C.dedupe(once, ["k"], ["v"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_null_key_filtered_before_dedupe(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 3)], "k int, v int")
    out = C.dedupe(C.require_not_null(df, ["k"]), ["k"], ["v"]).collect()
    assert [(r.k, r.v) for r in out] == [(1, 3)]


def test_fill_nulls_only_listed(spark):
    df = spark.createDataFrame([(None, None, None)], "a int, b int, c string")
    r = C.fill_nulls(df, 0, ["a", "b"]).collect()[0]
    assert (r.a, r.b, r.c) == (0, 0, None)


def test_sentinel_filter_drops_nulls_too(spark):
    df = spark.createDataFrame([("Missing",), (None,), ("Attack",)], "position string")
    assert [r.position for r in C.exclude_value(df, "position", "Missing").collect()] == ["Attack"]


def test_closed_range_edges(spark):
    df = spark.createDataFrame([(v,) for v in (15, 16, 40, 41, None)], "age int")
    assert sorted(r.age for r in C.in_range(df, "age", 16, 40).collect()) == [16, 40]


def test_positive_filter(spark):
    df = spark.createDataFrame([(v,) for v in (None, 0.0, -3.0, float("nan"), 4.0)], "v double")
    assert [r.v for r in C.require_positive(df, "v").collect()] == [4.0]


def test_dedupe_empty_order_is_refused(spark):
    import pytest
    with pytest.raises(ValueError):
        C.dedupe(spark.range(3), ["id"], [])
