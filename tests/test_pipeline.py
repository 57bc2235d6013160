"""End to end: dirty raw CSVs -> silver -> gold, compared with hand-computed rows."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from strata.plans import pipeline as P
from strata.sinks.publish import read_published

D = dt.date

PLAYERS = '''player_id,name,position,country_of_citizenship,date_of_birth,height_in_cm,foot,current_club_id,last_season,agent_name
1, Alice ,Attack,France,1998-03-01 00:00:00,180, Left ,10,2023,x
1,Alice Old,Attack,France,1998-03-01 00:00:00,180,left,10,2021,x
2,Bob,Defender, Spain ,2000-07-15 00:00:00,x,right,11,2023,x
3,Carl,Missing,France,1995-01-01 00:00:00,175,both,10,2023,x
4,Dan,,Italy,1990-01-01 00:00:00,170,left,12,2023,x
,NoKey,Attack,France,1990-01-01 00:00:00,170,left,12,2023,x
5,Eve,Midfield,Spain,2003-05-05 00:00:00,165,right,11,2023,x
6,"Finn ""The Fin""",Attack,Italy,1986-02-02 00:00:00,190,left,12,2022,"multi
line"
''' + "".join(f"{i},Keeper{i},Goalkeeper,France,2001-01-01 00:00:00,185,right,10,2023,x\n"
              for i in range(7, 12))

VALUATIONS = """player_id,date,market_value_in_eur,current_club_id,player_club_domestic_competition_id
1,2023-01-01,1000000,10,FR1
1,2023-06-01,1500000,10,FR1
1,2023-06-01,1500000,10,FR1
2,2022-01-01,500000,11,ES1
2,2023-02-01,0,11,ES1
3,2023-03-01,800000,10,FR1
4,2023-03-01,700000,12,IT1
6,2023-04-01,abc,12,IT1
6,2022-04-01,2000000,12,XX9
,2023-01-01,100,1,FR1
""" + "".join(f"{i},2023-05-01,{i * 100000},10,FR1\n" for i in range(7, 12))

APPEARANCES = """appearance_id,game_id,player_id,competition_id,date,goals,assists,minutes_played,yellow_cards,red_cards
a1,100,1,FR1,2023-01-10,1,0,90,0,0
a2,101,1,FR1,2023-01-17,2.0,1,90,1,0
a2,101,1,FR1,2023-01-17,2.0,1,90,1,0
a3,102,1,FR1,2023-01-24,,3.7,45,,0
a4,103,2,ES1,2023-01-10,0,0,x,0,1
a5,104,,ES1,2023-01-10,5,5,90,0,0
"""

CLUBS = """club_id,name,domestic_competition_id,squad_size,average_age,total_market_value
10, PSG ,FR1,25,26.5,1000000
11,Real,ES1,24,27.1,
12,Juve,IT1,x,25.0,abc
"""

COMPETITIONS = """competition_id,name,country_name,type
FR1, Ligue 1 ,France,domestic_league
ES1,LaLiga,Spain,domestic_league
IT1,Serie A,Italy,domestic_league
FR1,zzz duplicate,France,x
"""

RATINGS = """player_id,short_name,long_name,overall,potential,wage_eur,value_eur,age,club_name,nationality_name,preferred_foot,height_cm,weight_kg,player_positions,fifa_update_date
1,A.,Alice A,80,85,1000.0,1e6,25,PSG,France,Left,180,70,ST,2022-09-01
1,A.,Alice A,86.0,88,2000,2e6,25,PSG,France,Left,180,70,ST,2023-01-01
2,B.,Bob B,70,75,500,5e5,23,Real,Spain,Right,x,80,CB,2023-01-01
"""

FILES = {"Transfermarkt/players.csv": PLAYERS, "Transfermarkt/player_valuations.csv": VALUATIONS,
         "Transfermarkt/appearances.csv": APPEARANCES, "Transfermarkt/clubs.csv": CLUBS,
         "Transfermarkt/competitions.csv": COMPETITIONS, "FIFA 23 Players/male_players.csv": RATINGS}


def _bronze(root, skip=(), empty=()):
    for rel, text in FILES.items():
        if rel in skip:
            continue
        path = os.path.join(root, rel)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as f:
            f.write("" if rel in empty else text)


def _cfg(tmp):
    return P.PipelineConfig(bronze=os.path.join(tmp, "bronze"), silver=os.path.join(tmp, "silver"),
                            gold=os.path.join(tmp, "gold"), as_of=D(2026, 1, 1),
                            multiline=frozenset({"players"}))      # one of its fields has a line break


@pytest.fixture(scope="module")
def gold(spark, tmp_path_factory):
    tmp = str(tmp_path_factory.mktemp("e2e"))
    cfg = _cfg(tmp)
    _bronze(cfg.bronze)
    summary = {r.table_name: r.row_count for r in P.run(spark, cfg).collect()}
    return cfg, summary


def _read(spark, cfg, name):
    return read_published(spark, os.path.join(cfg.gold, name))


def test_silver_cleaning(spark, gold):
    cfg, _ = gold
    players = {r.player_id: r for r in spark.read.parquet(f"{cfg.silver}/players").collect()}
    assert set(players) == set(range(1, 12))                 # null key gone, dup collapsed
    assert players[1].name == "Alice" and players[1].last_season == 2023 and players[1].foot == "left"
    assert players[2].nationality == "Spain" and players[2].height_cm is None
    assert players[6].name == 'Finn "The Fin"' and players[6].age == 40
    vals = spark.read.parquet(f"{cfg.silver}/player_valuations")
    assert vals.filter("player_id = 1").count() == 2          # exact duplicate collapsed
    assert vals.filter("market_value_eur <= 0").count() == 0  # zero and junk dropped
    assert sorted(r.valuation_year for r in vals.select("valuation_year").distinct().collect()) \
        == [2022, 2023]
    apps = {r.appearance_id: r for r in spark.read.parquet(f"{cfg.silver}/appearances").collect()}
    assert set(apps) == {"a1", "a2", "a3", "a4"}
    assert (apps["a2"].goals, apps["a3"].goals, apps["a3"].assists) == (2, 0, 3)
    assert apps["a4"].minutes_played == 0
    comps = {r.competition_id: r.competition_name
             for r in spark.read.parquet(f"{cfg.silver}/competitions").collect()}
    assert comps == {"FR1": "Ligue 1", "ES1": "LaLiga", "IT1": "Serie A"}


def test_fact(spark, gold):
    cfg, _ = gold
    fact = {r.player_id: r for r in _read(spark, cfg, "fact_player_value").collect()}
    assert set(fact) == {1, 2, 6, 7, 8, 9, 10, 11}           # Missing / null position / no value out
    a = fact[1]
    assert (a.latest_market_value, a.valuation_date, a.competition_name, a.league_country) == \
        (1500000.0, D(2023, 6, 1), "Ligue 1", "France")
    assert (a.overall_rating, a.potential_rating, a.age) == (86, 88, 28)      # latest rating
    assert (a.total_goals, a.total_assists, a.total_appearances, a.total_minutes, a.goals_per_game) \
        == (3, 4, 3, 225, 2.33)
    b = fact[2]
    assert (b.latest_market_value, b.valuation_date, b.goals_per_game, b.total_minutes) == \
        (500000.0, D(2022, 1, 1), 0.0, 0)
    f = fact[6]
    assert f.competition_name is None and f.total_goals is None and f.overall_rating is None
    assert fact[9].total_appearances is None                 # unmatched stats stay null (K10)


def test_aggregates(spark, gold):
    cfg, _ = gold
    pos = {r.position: tuple(r)[1:] for r in _read(spark, cfg, "agg_value_by_position").collect()}
    assert pos == {"Attack": (1750000.0, 2000000.0, 2, 86.0, 3.0),
                   "Defender": (500000.0, 500000.0, 1, 70.0, 0.0),
                   "Goalkeeper": (900000.0, 1100000.0, 5, None, None)}
    league = {(r.competition_name, r.league_country): (r.avg_market_value, r.player_count)
              for r in _read(spark, cfg, "agg_value_by_league").collect()}
    assert league == {("Ligue 1", "France"): (1000000.0, 6), ("LaLiga", "Spain"): (500000.0, 1)}
    age = {r.age: r.player_count for r in _read(spark, cfg, "agg_value_by_age").collect()}
    assert age == {25: 5, 26: 1, 28: 1, 40: 1}               # 40 is inside the closed band
    top = _read(spark, cfg, "agg_top_players").collect()
    assert len(top) == 8 and top[0].player_name == 'Finn "The Fin"'
    nat = [tuple(r) for r in _read(spark, cfg, "agg_value_by_nationality").collect()]
    assert nat == [("France", 1000000.0, 6, 86.0)]           # Spain/Italy below 5 players


def test_summary_counts(gold):
    _, summary = gold
    assert summary["fact_player_value"] == 8 and summary["dim_player"] == 11
    assert summary["TOTAL"] == sum(v for k, v in summary.items() if k != "TOTAL")


def test_missing_raw_file_is_reported(spark, tmp_dir):
    cfg = _cfg(tmp_dir)
    _bronze(cfg.bronze, skip={"FIFA 23 Players/male_players.csv"})
    with pytest.raises(P.NotReady, match="male_players"):
        P.bronze_to_silver(spark, cfg)


def test_empty_raw_file_is_reported(spark, tmp_dir):
    cfg = _cfg(tmp_dir)
    _bronze(cfg.bronze, empty={"Transfermarkt/players.csv"})
    with pytest.raises(P.NotReady, match="empty"):
        P.bronze_to_silver(spark, cfg)


def test_missing_silver_dataset_is_reported(spark, tmp_dir):
    cfg = _cfg(tmp_dir)
    os.makedirs(os.path.join(cfg.silver, "players"))
    with open(os.path.join(cfg.silver, "players", "part-0.parquet"), "w") as f:
        f.write("x")
    with pytest.raises(P.NotReady, match="clubs"):
        P.silver_to_gold(spark, cfg)


def test_quality_report_is_clean(spark, gold):
    cfg, _ = gold
    rep = _read(spark, cfg, "quality_report").collect()
    assert len(rep) > 40 and all(r.violations == 0 for r in rep)


def test_rules_refuse_a_bad_version(spark, tmp_dir):
    from strata.plans.rules import rules_for
    from strata.sinks.publish import PublishError, publish
    df = spark.createDataFrame([(1, "a", 13), (2, "b", 30)], "player_id int, player_name string, age int")
    with pytest.raises(PublishError, match="age_14_50"):
        publish(df, os.path.join(tmp_dir, "dim"), rules=rules_for("dim_player", df.columns))


def test_multi_line_for_all_gives_same_silver(spark, tmp_dir):
    cfg = _cfg(tmp_dir)
    _bronze(cfg.bronze)
    cfg.multiline = frozenset(P.RAW_FILES)
    counts = P.bronze_to_silver(spark, cfg)
    assert counts == {"players": 11, "player_valuations": 11, "clubs": 3, "competitions": 3,
                      "appearances": 4, "fifa_players": 3}


def test_left_out_rows_are_counted(spark, gold):
    cfg, _ = gold
    got = {(r.dataset, r.reason): r.n_rows for r in spark.read.parquet(f"{cfg.silver}/rejected").collect()}
    assert got == {("players", "player_id unreadable"): 1, ("player_valuations", "player_id unreadable"): 1,
                   ("player_valuations", "value not positive"): 2, ("appearances", "player_id unreadable"): 1}


def test_wide_and_broken_ids_and_dates(spark):
    players = spark.createDataFrame(
        [("3000000000",), ("5",), ("5.2",), ("5.0",), ("x",)], "player_id string").selectExpr(
        "player_id", "'n' AS name", "'p' AS position", "'c' AS country_of_citizenship", "'' AS date_of_birth",
        "'' AS height_in_cm", "'' AS foot", "'' AS current_club_id", "'' AS last_season")
    assert sorted(r.player_id for r in P.clean_players(players, D(2026, 1, 1)).collect()) == [5, 3000000000]
    assert [tuple(r) for r in P.reject_counts(players, "players").collect()] == [("players", "player_id unreadable", 2)]
    vals = spark.createDataFrame([("1", "bad"), ("1", "worse"), ("1", "2020-01-01")], "player_id string, date string").selectExpr(
        "*", "'5' AS market_value_in_eur", "'' AS current_club_id", "'' AS player_club_domestic_competition_id")
    assert P.clean_valuations(vals).count() == 1
    assert [r.n_rows for r in P.reject_counts(vals, "player_valuations").collect()] == [2]


def test_cleaning_reads_only_what_it_uses(spark, tmp_dir):
    """Unused raw columns stay out of the scan and of the shuffle."""
    raw = spark.range(3).selectExpr(
        "id AS player_id", "'n' AS name", "'p' AS position", "'c' AS country_of_citizenship", "'' AS date_of_birth",
        "'' AS height_in_cm", "'' AS foot", "'' AS current_club_id", "'' AS last_season", "'u' AS unused_text")
    path = os.path.join(tmp_dir, "raw")
    raw.write.parquet(path)
    plan = P.clean_players(spark.read.parquet(path), D(2026, 1, 1))._jdf.queryExecution().executedPlan().toString()
    assert "unused_text" not in plan


def test_command_line_run(spark, tmp_dir, capsys):
    cfg = _cfg(tmp_dir)
    _bronze(cfg.bronze)
    P.main(["run", "--bronze", cfg.bronze, "--silver", cfg.silver, "--gold", cfg.gold,
            "--as-of", "2026-01-01", "--rules", "raise", "--multi-line", "players"])
    out = capsys.readouterr().out
    assert "fact_player_value" in out and "TOTAL" in out


def test_recorded_report_equals_recomputed(spark, gold):
    cfg, _ = gold
    recorded = sorted(tuple(r) for r in _read(spark, cfg, "quality_report").collect())
    recomputed = sorted(tuple(r) for r in P.quality_report(spark, cfg.gold).collect())
    assert recorded == recomputed


# questions over several gold tables, as SQL text over their names
GOLD_SQL = {
    "nations_by_scorers": """
        SELECT d.nationality, SUM(f.total_goals) AS goals, COUNT(DISTINCT f.competition_name) AS leagues
        FROM dim_player d JOIN fact_player_value f USING (player_id)
        GROUP BY d.nationality HAVING SUM(f.total_goals) IS NOT NULL""",
    "unvalued_players": """
        SELECT d.player_id FROM dim_player d LEFT ANTI JOIN fact_player_value f USING (player_id)""",
    "leagues_and_clubs": """
        SELECT c.competition_name, COUNT(k.club_id) AS clubs, SUM(k.squad_size) AS squad
        FROM dim_competition c LEFT JOIN dim_club k ON k.domestic_competition_id = c.competition_id
        GROUP BY c.competition_name""",
    "share_of_position": """
        SELECT f.player_id, f.latest_market_value / (a.avg_market_value * a.player_count) AS share
        FROM fact_player_value f JOIN agg_value_by_position a USING (position) WHERE f.position = 'Attack'""",
}


def test_sql_over_gold_views(spark, gold):
    cfg, _ = gold
    P.register_gold_views(spark, cfg.gold)
    out = {k: sorted(map(tuple, spark.sql(q).collect())) for k, q in GOLD_SQL.items()}
    assert out["nations_by_scorers"] == [("France", 3, 1), ("Spain", 0, 1)]
    assert out["unvalued_players"] == [(3,), (4,), (5,)]
    assert out["leagues_and_clubs"] == [("LaLiga", 1, 24), ("Ligue 1", 1, 25), ("Serie A", 1, None)]
    assert [(i, round(s, 4)) for i, s in out["share_of_position"]] == [(1, 0.4286), (6, 0.5714)]


def test_rules_on_table_derived_raw_files(spark, tmp_dir):
    """Derived players born in 1975 are 51 at the as-of date: reported, or refused in raise mode."""
    import duckdb

    from strata.plans.raw_from_tables import write_raw
    from strata.sinks.publish import PublishError

    sf = "/root/testdata/sf0.001"
    cfg = _cfg(tmp_dir)
    write_raw(spark, sf, cfg.bronze)
    P.bronze_to_silver(spark, cfg)
    P.silver_to_gold(spark, cfg)
    rep = {(r.table_name, r.rule): r.violations for r in _read(spark, cfg, "quality_report").collect()}
    over_50 = duckdb.sql(f"SELECT count(*) FROM '{sf}/customer.parquet' "
                         "WHERE 2026 - (1975 + c_nationkey) > 50").fetchall()[0][0]
    assert over_50 > 0 and rep[("dim_player", "age_14_50")] == over_50
    cfg2 = _cfg(os.path.join(tmp_dir, "strict"))
    cfg2.bronze, cfg2.rules = cfg.bronze, "raise"
    P.bronze_to_silver(spark, cfg2)
    with pytest.raises(PublishError, match="age_14_50"):
        P.silver_to_gold(spark, cfg2)


def test_ids_are_never_rounded(spark):
    from strata.functions.scalar import to_id

    texts = ["5", " 5 ", "+5", "-5", "5.", "5.000", "5.0000001", "5.00000000000000000001", "5e3", "1.5E1", "1.55E1", "9" * 18, "9" * 20,
             "1e400", "", "x", None, "0005", "1e-1"]
    got = [r.i for r in spark.createDataFrame([(t,) for t in texts], "t string").select(to_id("t").alias("i")).collect()]
    assert got == [5, 5, 5, -5, 5, 5, None, None, 5000, 15, None, 10**18 - 1, None, None, None, None, None, 5, None]
    numbers = spark.createDataFrame([(5.0,), (5.5,), (1e10,), (None,)], "d double").select(to_id("d").alias("i"))
    assert [r.i for r in numbers.collect()] == [5, None, 10**10, None]


def test_raw_files_are_read_once_and_losses_counted(spark, tmp_path):
    """Rejected and duplicate rows come out of the cleaning job; a null appearance id is a reason."""
    df = spark.createDataFrame([("1", "7"), ("1", "7"), (None, "7"), (None, "8"), ("2", "x"), ("3", "9")],
                               "appearance_id string, player_id string")
    for c in ("game_id", "competition_id", "date", "goals", "assists", "minutes_played", "yellow_cards", "red_cards"):
        df = df.withColumn(c, F.lit("1"))
    frame, seen = P.observed(df, "appearances")
    P.clean_appearances(frame).write.parquet(str(tmp_path / "a"))
    assert seen.get == {"rows": 6, "r0": 1, "r1": 2}
    assert spark.read.parquet(str(tmp_path / "a")).count() == 2
