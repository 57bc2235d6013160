"""Property tests: operators against a brute-force pandas answer on random small frames."""

import datetime as dt

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators import clean as C
from strata.operators import star as S

ROWS = st.lists(
    st.tuples(st.integers(0, 5), st.one_of(st.none(), st.integers(0, 6)), st.integers(0, 50)),
    min_size=1, max_size=40)
SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def _frame(spark, rows):
    data = [(i, k, None if d is None else dt.date(2020, 1, 1) + dt.timedelta(days=d), v)
            for i, (k, d, v) in enumerate(rows)]
    return spark.createDataFrame(data, "id int, k int, d date, v int"), pd.DataFrame(
        data, columns=["id", "k", "d", "v"])


@SETTINGS
@given(rows=ROWS)
def test_latest_all_ties_matches_brute_force(spark, rows):
    df, pdf = _frame(spark, rows)
    got = sorted(r.id for r in S.latest_per_key(df, ["k"], "d", ties="all").collect())
    exp = []
    for _, g in pdf.groupby("k"):
        dates = g["d"].dropna()
        exp += g[g["d"] == dates.max()]["id"].tolist() if len(dates) else g["id"].tolist()
    assert got == sorted(exp)


@SETTINGS
@given(rows=ROWS)
def test_dedupe_keeps_first_in_order(spark, rows):
    df, pdf = _frame(spark, rows)
    got = sorted((r.k, r.id) for r in C.dedupe(df, ["k"], [F.col("v").desc(), "id"]).collect())
    exp = pdf.sort_values(["k", "v", "id"], ascending=[True, False, True]).groupby("k").head(1)
    assert got == sorted(zip(exp["k"], exp["id"]))


@SETTINGS
@given(rows=ROWS)
def test_max_join_equals_window_without_null_dates(spark, rows):
    df, _ = _frame(spark, rows)
    df = df.filter(F.col("d").isNotNull())
    a = sorted(r.id for r in S.latest_per_key(df, ["k"], "d").collect())
    b = sorted(r.id for r in S.latest_by_max_join(df, ["k"], "d").collect())
    assert a == b


@SETTINGS
@given(rows=ROWS)
def test_activity_stats_sum_and_count(spark, rows):
    df, pdf = _frame(spark, rows)
    got = {r.k: (r.total, r.n) for r in S.activity_stats(df, "k", {"total": "v"}, "d", "n").collect()}
    exp = {k: (int(g["v"].sum()), int(g["d"].notna().sum())) for k, g in pdf.groupby("k")}
    assert got == exp


@SETTINGS
@given(rows=ROWS)
def test_latest_all_equals_window(spark, rows):
    df, _ = _frame(spark, rows)
    w = Window.partitionBy("k").orderBy(F.col("d").desc_nulls_last())
    a = sorted(r.id for r in df.withColumn("r", F.rank().over(w)).filter("r = 1").collect())
    b = sorted(r.id for r in S.latest_per_key(df, ["k"], "d", ties="all", hot_rows=2).collect())
    assert a == b
