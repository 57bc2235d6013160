"""A key holding a third of all rows: results stay whole and equal a brute-force answer."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators import aggregate as A
from strata.operators import clean as C
from strata.operators import quality as Q
from strata.operators import star as S
from strata.plans.explain import plan_text

N = 30000


@pytest.fixture(scope="module")
def hot(spark):
    # key 0 holds a third of the rows; the rest spread over 2,000 keys
    df = (spark.range(N).withColumn("k", F.when(F.col("id") % 3 == 0, F.lit(0))
                                    .otherwise(F.col("id") % 2000 + 1))
          .withColumn("d", F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 997).cast("int")))
          .withColumn("v", (F.col("id") % 101).cast("double"))
          .repartition(16))
    return df, df.toPandas()


def test_latest_per_key_hot_key(spark, hot):
    df, pdf = hot
    got = S.latest_per_key(df, ["k"], "d", ties="first", tie_break=[F.col("id").asc()])
    exp = pdf.sort_values(["k", "d", "id"], ascending=[True, False, True]).groupby("k").head(1)
    assert sorted(r.id for r in got.collect()) == sorted(exp["id"].tolist())
    plan = plan_text(got)
    assert plan.index("Partial") > plan.index("Exchange")      # limited before the shuffle


def test_latest_all_ties_hot_key(spark, hot):
    df, pdf = hot
    got = S.latest_per_key(df, ["k"], "d", ties="all")
    mx = pdf.groupby("k")["d"].transform("max")
    assert sorted(r.id for r in got.collect()) == sorted(pdf[pdf["d"] == mx]["id"].tolist())


def test_dedupe_hot_key(spark, hot):
    df, pdf = hot
    got = C.dedupe(df, ["k"], [F.col("v").desc(), F.col("id").asc()])
    exp = pdf.sort_values(["k", "v", "id"], ascending=[True, False, True]).groupby("k").head(1)
    assert sorted(r.id for r in got.collect()) == sorted(exp["id"].tolist())


def test_activity_stats_hot_key(spark, hot):
    df, pdf = hot
    got = {r.k: (r.s, r.n) for r in S.activity_stats(df, "k", {"s": "v"}, "id", "n").collect()}
    exp = pdf.groupby("k").agg(s=("v", "sum"), n=("id", "count"))
    assert got == {k: (row.s, row.n) for k, row in exp.iterrows()}
    assert got[0][1] == N // 3


def test_anti_join_hot_key(spark, hot):
    df, pdf = hot
    keys = spark.range(0, 2100).withColumnRenamed("id", "k")
    got = sorted(r.k for r in S.missing_keys(keys, df, "k").collect())
    assert got == sorted(set(range(2100)) - set(pdf["k"]))


def test_unique_rule_hot_key(spark, hot):
    df, pdf = hot
    rep = {r.rule: r.violations for r in Q.violation_report(df, [Q.unique("k_unique", "k")]).collect()}
    sizes = pdf.groupby("k").size()
    assert rep["k_unique"] == int(sizes[sizes > 1].sum())


def test_top_k_hot_key(spark, hot):
    df, pdf = hot
    got = [r.id for r in A.top_k(df, 25, [F.col("v").desc()], [F.col("id").asc()]).collect()]
    exp = pdf.sort_values(["v", "id"], ascending=[False, True]).head(25)["id"].tolist()
    assert got == exp


def test_infer_schema_is_opt_in(spark, tmp_dir):
    import os
    from strata.sources.files import read_csv
    p = os.path.join(tmp_dir, "x.csv")
    with open(p, "w") as f:
        f.write("a,b\n1,2.5\n")
    assert dict(read_csv(spark, p).dtypes) == {"a": "string", "b": "string"}
    assert dict(read_csv(spark, p, infer_schema=True).dtypes) == {"a": "int", "b": "double"}


def test_salted_join_spreads_the_hot_key(spark, hot):
    df, pdf = hot
    right = df.groupBy("k").agg(F.max("d").alias("d"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                           "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plain = S.latest_by_max_join(df, ["k"], "d")
        salted = S.latest_by_max_join(df, ["k"], "d", hot_rows=100)
        assert sorted(r.id for r in plain.collect()) == sorted(r.id for r in salted.collect())
        joined = S.salted_join(df, right.withColumnRenamed("d", "max_d"), ["k"], "inner",
                               hot_rows=100, buckets=16)
        per_task = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        plain_j = df.join(right.withColumnRenamed("d", "max_d"), ["k"], "inner")
        per_task_plain = [r["count"] for r in
                          plain_j.groupBy(F.spark_partition_id()).count().collect()]
        assert joined.count() == plain_j.count() == N
        assert max(per_task_plain) >= N // 3            # the hot key sits in one task
        assert max(per_task) < N // 3                   # salted: spread out
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_check_constraints_salted_equals_plain(spark, hot):
    df, _ = hot
    rules = [Q.unique("k_unique", "k"), Q.between("v_small", "v", 0, 50)]
    a_valid, a_bad = Q.check_constraints(df, rules)
    b_valid, b_bad = Q.check_constraints(df, rules, hot_rows=100)
    assert a_valid.count() == b_valid.count()
    assert sorted((r.id, tuple(sorted(r.failed_rules))) for r in a_bad.collect()) == \
        sorted((r.id, tuple(sorted(r.failed_rules))) for r in b_bad.collect())


def test_latest_all_ties_salted_equals_window(spark, hot):
    df, _ = hot
    # the hot key: every one of its rows on the same latest date
    tied = df.withColumn("d", F.when(F.col("k") == 0, F.lit("2030-01-01").cast("date"))
                         .otherwise(F.col("d")))
    w = Window.partitionBy("k").orderBy(F.col("d").desc_nulls_last())
    a = sorted(r.id for r in tied.withColumn("r", F.rank().over(w)).filter("r = 1").collect())
    b = sorted(r.id for r in S.latest_per_key(tied, ["k"], "d", ties="all",
                                              hot_rows=100).collect())
    assert a == b and len(a) >= N // 3


def test_skew_join_spreads_a_hot_key_of_exact_copies(spark):
    # key 0: a third of the rows, all identical copies
    df = (spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 2000 + 1).alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit(1.0)).otherwise(F.col("id").cast("double")).alias("v"))
        .repartition(16))
    right = df.groupBy("k").agg(F.max("v").alias("mx"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                           "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")

    def per_task(j):
        return max(r["count"] for r in j.groupBy(F.spark_partition_id()).count().collect())

    try:
        plain = df.join(right, ["k"], "inner")
        salted = S.salted_join(df, right, ["k"], "inner", hot_rows=100, buckets=16)
        split = S.skew_join(df, right, ["k"], "inner", hot_rows=100, buckets=16)
        exp = sorted(map(tuple, plain.collect()))
        assert sorted(map(tuple, salted.collect())) == exp == sorted(map(tuple, split.collect()))
        assert per_task(salted) >= N // 3       # copies hash alike: salting cannot spread them
        assert per_task(split) < N // 3        # split off and joined where they are
        left_join = S.skew_join(df, right.filter("k != 5"), ["k"], "left", hot_rows=100, buckets=16)
        assert left_join.count() == N and left_join.filter("mx IS NULL").count() == \
            df.filter("k = 5").count()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_enrich_and_lookup_with_salt_equal_plain(spark, hot):
    df, _ = hot
    dim = spark.range(0, 2001).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    versions = dim.unionByName(dim.withColumn("w", F.col("w") + 1))      # two rows per key
    a = S.enrich(df, versions.withColumnRenamed("k", "rk"), "k", "rk", [F.col("w").desc()])
    b = S.enrich(df, versions.withColumnRenamed("k", "rk"), "k", "rk", [F.col("w").desc()],
                 hot_rows=100)
    assert sorted(a.columns) == sorted(b.columns)
    cols = sorted(a.columns)
    assert sorted(map(tuple, a.select(cols).collect())) == sorted(map(tuple, b.select(cols).collect()))
    c = S.lookup_join(df, dim, "k", "left", hot_rows=100)
    assert c.count() == N and c.filter("w IS NULL").count() == 0


def test_no_task_holds_a_hot_key_with_aqe_on(spark, hot):
    """Right sides are shuffled aggregates, which AQE alone doesn't split; key 0 holds a third of the rows."""
    df, _ = hot
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "true"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)

    def most(j):
        return max(r["count"] for r in j.groupBy(F.spark_partition_id()).count().collect())

    dim = spark.range(0, 2001).select(F.col("id").alias("rk"), (F.col("id") * 10).alias("w"))
    tied = df.withColumn("d", F.when(F.col("k") == 0, F.lit("2030-01-01").cast("date")).otherwise(F.col("d")))
    try:
        _, bad = Q.check_constraints(df, [Q.unique("k_unique", "k")], hot_rows=100)
        joins = [bad, S.enrich(df, dim.unionByName(dim), "k", "rk", [F.col("w").desc()], hot_rows=100),
                 S.missing_keys(df, dim.filter("rk > 0").withColumnRenamed("rk", "k"), "k", hot_rows=100),
                 S.latest_per_key(tied, ["k"], "d", hot_rows=100), S.latest_by_max_join(tied, ["k"], "d", hot_rows=100)]
        for j in joins:
            assert j.filter("k = 0").count() >= N // 3 - 1
            assert most(j.filter("k = 0")) < N // 4
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_null_keys_skip_the_join(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    right = spark.createDataFrame([(0, "a"), (1, "b")], "k long, w string")
    for how in ("inner", "left", "left_semi", "left_anti"):
        a = sorted(map(tuple, df.join(right, "k", how).collect()), key=str)
        b = S.skew_join(df, right, ["k"], how, hot_rows=10)
        assert sorted(map(tuple, b.collect()), key=str) == a
    tied = df.withColumn("d", F.lit(1))
    assert S.latest_per_key(tied, ["k"], "d", hot_rows=10).count() == 3000
