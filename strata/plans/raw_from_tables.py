"""Raw CSV files shaped like the reference's inputs, derived by Spark from the driver tables.

Lets the real pipeline (raw CSV -> silver -> gold) run on data that grows
with the driver tables.  The raw text is deliberately untidy in the ways the
reference's cleaning handles: padded names, a "Missing" position, counters
written as ``1.0``, minutes as decimals, a code written ``' Left '``.

==============================  =========================================
raw file                        derived from
==============================  =========================================
Transfermarkt/players.csv       customer + nation (birth year 1975 + nation key)
Transfermarkt/player_valuations orders + customer's nation as the league
Transfermarkt/appearances.csv   events (purchase / click / error / signup flags)
Transfermarkt/clubs.csv         nation
Transfermarkt/competitions.csv  nation + region
FIFA 23 Players/male_players    supplier (rating = floor(s_acctbal / 100))
==============================  =========================================

Player ids are shifted beyond 32 bits.  Besides, the files hold what has to be
counted and left out, or decided: players with ids that are no whole numbers,
older rows of the same player, valuations on unreadable dates, ratings of
earlier seasons (one less each) and of unreadable dates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sinks.files import write_csv
from strata.sources.files import table

ID_SHIFT = 3_000_000_000             # beyond 32 bits
SENTINEL_SEGMENT = "FURNITURE"      # written as the reference's "Missing" position


def _flag(kind: str, text_one: str = "1", text_zero: str = "0"):
    return F.when(F.col("event_type") == kind, F.lit(text_one)).otherwise(F.lit(text_zero))


def _id(c: str):
    return (F.col(c).cast("long") + F.lit(ID_SHIFT)).cast("string")


def raw_frames(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """The six raw files as lazy DataFrames of text-like columns, keyed by relative path."""
    c = table(spark, d, "customer")
    n = table(spark, d, "nation")
    r = table(spark, d, "region")
    o = table(spark, d, "orders")
    e = table(spark, d, "events")
    s = table(spark, d, "supplier")
    cn = c.join(n, c["c_nationkey"] == n["n_nationkey"], "left")
    players = cn.select(
        _id("c_custkey").alias("player_id"),
        F.concat(F.lit(" "), "c_name", F.lit(" ")).alias("name"),
        F.when(F.col("c_mktsegment") == SENTINEL_SEGMENT, F.lit("Missing"))
         .otherwise(F.col("c_mktsegment")).alias("position"),
        F.col("n_name").alias("country_of_citizenship"),
        F.make_timestamp_ntz(F.col("c_nationkey") + 1975, F.lit(1), F.lit(1), F.lit(0), F.lit(0),
                             F.lit(0)).alias("date_of_birth"),
        (F.col("c_nationkey") * 2 + 150).cast("string").alias("height_in_cm"),
        F.when(F.col("c_acctbal") > 0, F.lit(" Left ")).otherwise(F.lit("right")).alias("foot"),
        F.col("c_nationkey").alias("current_club_id"),
        F.lit(2023).alias("last_season"))
    # customers in debt have an older row, too, and one whose id is no whole number
    debt = players.join(c.filter("c_acctbal < 0").select(_id("c_custkey").alias("player_id")), "player_id", "left_semi")
    players = (players
               .unionByName(debt.withColumn("last_season", F.lit(2020)).withColumn("name", F.lit("older name")))
               .unionByName(debt.withColumn("player_id", F.concat("player_id", F.lit(".5")))))
    league = c.join(n, c["c_nationkey"] == n["n_nationkey"], "left") \
        .select(F.col("c_custkey").alias("k"), F.col("n_name").alias("league"),
                F.col("c_nationkey").alias("club"))
    valuations = o.join(league, o["o_custkey"] == league["k"], "left").select(
        _id("o_custkey").alias("player_id"),
        F.col("o_orderdate").cast("date").alias("date"),
        F.format_string("%.2f", "o_totalprice").alias("market_value_in_eur"),
        F.col("club").alias("current_club_id"),
        F.col("league").alias("player_club_domestic_competition_id"))
    # open orders have a row on an unreadable date and one without a value, too
    pending = o.filter("o_orderstatus = 'O'").select(_id("o_custkey").alias("player_id"))
    valuations = valuations.withColumn("date", F.col("date").cast("string"))
    for date, value in (("unknown", "1.00"), ("2020-01-01", "")):
        valuations = valuations.unionByName(pending.select(
            "player_id", F.lit(date).alias("date"), F.lit(value).alias("market_value_in_eur"),
            F.lit(None).cast("long").alias("current_club_id"),
            F.lit(None).cast("string").alias("player_club_domestic_competition_id")))
    appearances = e.select(
        F.col("event_id").cast("string").alias("appearance_id"),
        F.col("event_id").alias("game_id"),
        _id("user_id").alias("player_id"),
        F.lit("").alias("competition_id"),
        F.col("ts").cast("date").alias("date"),
        _flag("purchase").alias("goals"),
        _flag("click", "1.0", "0.0").alias("assists"),
        F.format_string("%.2f", "value").alias("minutes_played"),
        _flag("error").alias("yellow_cards"),
        _flag("signup").alias("red_cards"))
    clubs = n.select(F.col("n_nationkey").alias("club_id"),
                     F.concat(F.lit(" "), "n_name", F.lit(" FC")).alias("name"),
                     F.col("n_name").alias("domestic_competition_id"),
                     F.lit("25").alias("squad_size"), F.lit("26.5").alias("average_age"),
                     F.lit("").alias("total_market_value"))
    competitions = n.join(r, n["n_regionkey"] == r["r_regionkey"], "left").select(
        F.col("n_name").alias("competition_id"),
        F.concat(F.lit(" "), "n_name", F.lit(" ")).alias("name"),
        F.col("r_name").alias("country_name"),
        F.lit("domestic_league").alias("type"))
    rating = F.floor(F.col("s_acctbal") / 100)

    def version(less: int, date: str) -> DataFrame:
        return s.select(
            _id("s_suppkey").alias("player_id"), F.col("s_name").alias("short_name"),
            F.col("s_name").alias("long_name"), (rating - less).cast("string").alias("overall"),
            (rating - less + 5).cast("string").alias("potential"),
            F.format_string("%.2f", "s_acctbal").alias("wage_eur"), F.lit("").alias("value_eur"),
            F.lit("25").alias("age"), F.lit("").alias("club_name"),
            F.lit("").alias("nationality_name"), F.lit("Left").alias("preferred_foot"),
            F.lit("180").alias("height_cm"), F.lit("75").alias("weight_kg"),
            F.lit("ST").alias("player_positions"), F.lit(date).alias("fifa_update_date"))

    ratings = version(0, "2023-01-01")
    for less, date in ((1, "2022-09-01"), (2, "2021-09-01"), (-40, "next season")):
        ratings = ratings.unionByName(version(less, date))
    return {
        "Transfermarkt/players.csv": players,
        "Transfermarkt/player_valuations.csv": valuations,
        "Transfermarkt/appearances.csv": appearances,
        "Transfermarkt/clubs.csv": clubs,
        "Transfermarkt/competitions.csv": competitions,
        "FIFA 23 Players/male_players.csv": ratings,
    }


def write_raw(spark: SparkSession, d: str, bronze: str) -> dict[str, int]:
    """Write each raw frame as a folder of CSV part files named like the reference's file.

    Spark writes a folder per "file" (``players.csv/part-*.csv``): the
    pipeline's readers take a path, and a folder of parts reads in parallel.
    """
    from strata.plans.pipeline import run_concurrently
    frames = raw_frames(spark, d)
    return run_concurrently({rel: (lambda r=rel, df=df: write_csv(df, f"{bronze.rstrip('/')}/{r}"))
                             for rel, df in frames.items()})
