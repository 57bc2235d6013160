"""Role mapping: the driver's TPC-H-like tables seen as the reference's silver datasets.

players      <- customer (+ nation name as nationality, nation key as league)
valuations   <- orders   (o_custkey, o_orderdate, o_totalprice)
appearances  <- events   (user_id; purchase = goal, click = assist,
                          floor(value) = minutes, error = yellow, signup = red)
ratings      <- supplier (s_suppkey as player key, floor(s_acctbal / 100) as rating)
competitions <- nation joined to region (nation name, region name)

Every frame here is a lazy projection of a driver table; nothing is read
until a query runs, and column pruning reaches the Parquet scans.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.scalar import clean_text, is_positive, years_between
from strata.operators.star import lookup_join
from strata.sources.files import table

# Fixed reference date for every age / year-difference computation (K5).
AS_OF = _dt.date(2026, 1, 1)


def players(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    j = lookup_join(c, n, c["c_nationkey"] == n["n_nationkey"], "left")
    return j.select(F.col("c_custkey").alias("player_id"),
                    clean_text("c_name").alias("name"),
                    clean_text("c_mktsegment").alias("position"),
                    F.col("n_name").alias("nationality"),
                    F.col("c_nationkey").alias("competition_id"))


def valuations(spark: SparkSession, d: str) -> DataFrame:
    """Silver valuations without the (player, date) dedupe, which the latest
    window folds in (see ``gold.latest_valuation``).  Null key and invalid
    values are filtered first (K2)."""
    o = table(spark, d, "orders")
    o = o.filter(F.col("o_custkey").isNotNull() & is_positive("o_totalprice"))
    return o.select(F.col("o_custkey").alias("player_id"),
                    F.col("o_orderdate").alias("date"),
                    F.col("o_totalprice").alias("market_value_eur"),
                    F.col("o_orderkey").alias("order_key"),
                    years_between(AS_OF, "o_orderdate").alias("age"))


def appearances(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")

    def flag(kind):
        return F.when(F.col("event_type") == kind, 1).otherwise(0)

    return e.select(F.col("event_id").alias("appearance_id"),
                    F.col("user_id").alias("player_id"),
                    flag("purchase").alias("goals"),
                    flag("click").alias("assists"),
                    F.floor("value").cast("int").alias("minutes_played"),
                    flag("error").alias("yellow_cards"),
                    flag("signup").alias("red_cards"))


def ratings(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier")
    return s.select(F.col("s_suppkey").alias("player_id"),
                    F.floor(F.col("s_acctbal") / 100).cast("int").alias("overall_rating"),
                    F.col("s_acctbal").alias("wage_eur"))


def competitions(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation")
    r = table(spark, d, "region")
    j = lookup_join(n, r, n["n_regionkey"] == r["r_regionkey"], "left")
    return j.select(F.col("n_nationkey").alias("competition_id"),
                    F.col("n_name").alias("competition_name"),
                    F.col("r_name").alias("country_name"))
