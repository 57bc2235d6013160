import datetime as dt

from pyspark.sql import functions as F

from strata.operators import star as S

D = dt.date


def _vals(spark):
    return spark.createDataFrame([
        (1, D(2023, 1, 1), 10.0, 1), (1, D(2023, 6, 1), 20.0, 2), (1, D(2023, 6, 1), 30.0, 3),
        (2, None, 5.0, 4),                                   # null date only -> kept
        (3, None, 7.0, 5), (3, D(2022, 1, 1), 8.0, 6),       # null date plus a date -> date wins
    ], "k int, d date, v double, id int")


def test_latest_ties_all_keeps_every_tie(spark):
    out = S.latest_per_key(_vals(spark), ["k"], "d", ties="all")
    assert sorted((r.k, r.id) for r in out.collect()) == [(1, 2), (1, 3), (2, 4), (3, 6)]


def test_latest_ties_first_keeps_one(spark):
    out = S.latest_per_key(_vals(spark), ["k"], "d", ties="first", tie_break=[F.col("id").desc()])
    assert sorted((r.k, r.id) for r in out.collect()) == [(1, 3), (2, 4), (3, 6)]


def test_max_join_equals_window_on_non_null_dates(spark):
    df = _vals(spark).filter(F.col("d").isNotNull())
    a = S.latest_per_key(df, ["k"], "d", ties="all")
    b = S.latest_by_max_join(df, ["k"], "d")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_max_join_loses_null_only_key(spark):
    keys = {r.k for r in S.latest_by_max_join(_vals(spark), ["k"], "d").collect()}
    assert keys == {1, 3}


def test_activity_stats_zero_count_gives_null_ratio(spark):
    acts = spark.createDataFrame([(None, 1, 1, 2), (None, 1, 0, 3), ("a", 2, 1, 1), ("b", 2, 2, 0)],
                                 "appearance_id string, player_id int, goals int, assists int")
    out = {r.player_id: r for r in S.activity_stats(
        acts, "player_id", {"g": "goals", "a": "assists"}, "appearance_id", "n",
        ratio_name="gpg", ratio_numerators=["g", "a"]).collect()}
    assert out[1].n == 0 and out[1].gpg is None and out[1].g == 1
    assert out[2].n == 2 and out[2].gpg == 2.0


def test_enrich_collapses_fan_out(spark):
    players = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "player_id int, name string")
    ratings = spark.createDataFrame([(1, 70, D(2022, 1, 1)), (1, 75, D(2023, 1, 1)), (2, 60, None)],
                                    "rid int, rating int, upd date")
    out = S.enrich(players, ratings, "player_id", "rid", [F.col("upd").desc_nulls_last()])
    got = sorted((r.player_id, r.rating) for r in out.collect())
    assert got == [(1, 75), (2, 60), (3, None)]       # one row per player, no fan-out


def test_missing_keys(spark):
    req = spark.createDataFrame([("players/",), ("clubs/",), ("fifa/",)], "name string")
    have = spark.createDataFrame([("players/",), ("clubs/",)], "name string")
    assert [r.name for r in S.missing_keys(req, have, "name").collect()] == ["fifa/"]


def test_lookup_join_checked_broadcast(spark):
    fact = spark.range(1000).withColumn("k", (F.col("id") % 3).cast("int"))
    dim = spark.createDataFrame([(0, "x"), (1, "y")], "k int, label string")
    out = S.lookup_join(fact, dim, "k", "left", max_broadcast_bytes=1000)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert out.filter(F.col("label").isNull()).count() == 333
    # beyond the bound no hint is given
    assert S.bytes_of(dim) > 1
    plan = S.lookup_join(fact, dim, "k", "left", max_broadcast_bytes=1)._jdf.queryExecution().logical().toString()
    assert "ResolvedHint" not in plan and "UnresolvedHint" not in plan
