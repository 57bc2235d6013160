"""The reference's bronze -> silver -> gold pipeline, expressed as configuration of the library.

Bronze is the raw CSV folder.  Raw files are read with a header and *every
column as text* (no inference pass; the real files carry many more columns
than the ones used, in their own order), then each needed column is cast
leniently by name.  Silver is Parquet, valuations partitioned by year.
Gold tables are published with stage / check / switch; the fact is written
once and the aggregates read the published fact back instead of recomputing
its lineage.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.functions.scalar import (clean_code, clean_text, is_positive, to_date, to_double,
                                     to_float, to_id, to_int, years_between)
from strata.operators.aggregate import table_counts
from strata.operators.clean import dedupe, fill_nulls, total_order
from strata.operators.quality import violation_report
from strata.plans import gold as G
from strata.plans.rules import rules_for
from strata.sinks.files import write_parquet
from strata.sinks.publish import Published, publish, read_published
from strata.sources import fs
from strata.sources.files import read_csv, read_parquet
from strata.sources.multiline import read_multiline_csv

# Fixed values that must equal the reference's: raw file locations under the
# bronze root, the raw files the readiness check requires, the silver
# datasets the gold job requires, and the counter columns filled with 0.
RAW_FILES = {
    "players": "Transfermarkt/players.csv",
    "player_valuations": "Transfermarkt/player_valuations.csv",
    "clubs": "Transfermarkt/clubs.csv",
    "competitions": "Transfermarkt/competitions.csv",
    "appearances": "Transfermarkt/appearances.csv",
    "fifa_players": "FIFA 23 Players/male_players.csv",
}
REQUIRED_RAW = ["Transfermarkt/players.csv", "Transfermarkt/player_valuations.csv",
                "FIFA 23 Players/male_players.csv"]
SILVER_DATASETS = ["players", "player_valuations", "clubs", "competitions", "appearances",
                   "fifa_players"]
COUNTERS = ["goals", "assists", "minutes_played", "yellow_cards", "red_cards"]
GOLD_TABLES = ["dim_player", "dim_club", "dim_competition", "fact_player_value",
               "agg_value_by_position", "agg_value_by_league", "agg_value_by_age",
               "agg_top_players", "agg_value_by_nationality"]


class NotReady(RuntimeError):
    pass


@dataclass
class PipelineConfig:
    bronze: str
    silver: str
    gold: str
    as_of: _dt.date                    # ages are counted to this day
    raw_files: Mapping[str, str] = field(default_factory=lambda: dict(RAW_FILES))
    # gold rules (C1-C10): "report" publishes a violation report next to the
    # tables, "raise" also refuses any table that breaks a rule, "off" skips both
    rules: str = "report"
    # datasets that hold quoted line breaks: read by many tasks all the same, but three times
    multiline: frozenset[str] = frozenset()
    # independent datasets / tables written at the same time (driver threads)
    concurrency: int = 4

# ================================================================ helpers

def run_concurrently(tasks: Mapping[str, Callable[[], object]], workers: int = 4) -> dict:
    """Run independent Spark jobs from a few driver threads; results by name.

    Spark schedules the jobs' stages side by side, so small or unsplittable
    datasets do not leave the cluster idle while they run one after another.
    The first failure is re-raised.
    """
    if workers <= 1 or len(tasks) <= 1:
        return {name: fn() for name, fn in tasks.items()}
    with ThreadPoolExecutor(max_workers=min(workers, len(tasks))) as pool:
        futures = {name: pool.submit(fn) for name, fn in tasks.items()}
        return {name: f.result() for name, f in futures.items()}


# ================================================================ silver

def _text(c: str) -> Column:
    """Raw text with blank as null."""
    return F.nullif(F.trim(F.col(c).cast("string")), F.lit(""))


# What makes a raw row unusable, by dataset: (reason, condition).  Such rows are left out of silver and
# counted in the reject report; rows that dedupe removes are counted in the duplicates report.
REJECTS: dict[str, list[tuple[str, Callable[[], Column]]]] = {
    "players": [("player_id unreadable", lambda: to_id("player_id").isNull())],
    "player_valuations": [
        ("player_id unreadable", lambda: to_id("player_id").isNull()),
        ("date unreadable", lambda: _text("date").isNotNull() & to_date("date").isNull()),
        ("value not positive", lambda: ~F.coalesce(is_positive(to_double("market_value_in_eur")), F.lit(False)))],
    "clubs": [("club_id unreadable", lambda: to_id("club_id").isNull())],
    "competitions": [("competition_id missing", lambda: F.col("competition_id").isNull())],
    "appearances": [("player_id unreadable", lambda: to_id("player_id").isNull()),
                    ("appearance_id missing", lambda: F.col("appearance_id").isNull())],
    "fifa_players": [
        ("player_id unreadable", lambda: to_id("player_id").isNull()),
        ("date unreadable", lambda: _text("fifa_update_date").isNotNull() & to_date("fifa_update_date").isNull())],
}


def _reason(name: str) -> Column:
    """The first reason to reject a raw row, or null."""
    out = None
    for reason, condition in REJECTS[name]:
        out = F.when(condition(), reason) if out is None else out.when(condition(), reason)
    return out


def usable(raw: DataFrame, name: str) -> DataFrame:
    """Raw rows of a dataset without a reason to reject them."""
    return raw.filter(_reason(name).isNull())


def observed(raw: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``raw`` with its rows and reasons to reject them counted by whatever job reads it; no pass of its own."""
    seen = Observation(f"raw_{name}_{uuid.uuid4().hex[:8]}")
    why = _reason(name)
    counts = [F.count_if(F.coalesce(why == reason, F.lit(False))).alias(f"r{i}") for i, (reason, _) in enumerate(REJECTS[name])]
    return raw.observe(seen, F.count(F.lit(1)).alias("rows"), *counts), seen


def reject_counts(raw: DataFrame, name: str) -> DataFrame:
    """dataset, reason, n_rows of the raw rows that would be left out: a look at a file before it is cleaned."""
    return (raw.select(_reason(name).alias("reason")).filter("reason is not null").groupBy("reason")
            .agg(F.count(F.lit(1)).alias("n_rows"))
            .select(F.lit(name).alias("dataset"), "reason", "n_rows"))


# The cleaning jobs select what they need first, so that nothing else is read, and dedupe over that.

def clean_players(raw: DataFrame, as_of: _dt.date) -> DataFrame:
    """Key filter, deterministic dedupe, trims, code lower-case, age, height."""
    df = usable(raw, "players").select(
        to_id("player_id").alias("player_id"), clean_text("name").alias("name"),
        clean_text("position").alias("position"),
        clean_text("country_of_citizenship").alias("nationality"),
        years_between(as_of, F.col("date_of_birth").try_cast("timestamp")).alias("age"),
        to_float("height_in_cm").alias("height_cm"), clean_code("foot").alias("foot"),
        to_id("current_club_id").alias("current_club_id"), to_int("last_season").alias("last_season"))
    return dedupe(df, ["player_id"], total_order(df, [F.col("last_season").desc_nulls_last()]))


def clean_valuations(raw: DataFrame) -> DataFrame:
    """Key and value filters, (player, date) dedupe, year for partitioning."""
    df = usable(raw, "player_valuations").select(
        to_id("player_id").alias("player_id"), to_date("date").alias("date"),
        to_double("market_value_in_eur").alias("market_value_eur"),
        to_id("current_club_id").alias("current_club_id"),
        F.col("player_club_domestic_competition_id").alias("competition_id"))
    df = dedupe(df, ["player_id", "date"], total_order(df, ["player_id", "date"])[2:])
    return df.withColumn("valuation_year", F.year("date"))


def clean_clubs(raw: DataFrame) -> DataFrame:
    """D3: clubs."""
    df = usable(raw, "clubs").select(
        to_id("club_id").alias("club_id"), clean_text("name").alias("club_name"),
        clean_text("domestic_competition_id").alias("domestic_competition_id"),
        to_int("squad_size").alias("squad_size"), to_double("average_age").alias("average_age"),
        to_double("total_market_value").alias("total_market_value"))
    return dedupe(df, ["club_id"], total_order(df, ["club_id"])[1:])


def clean_competitions(raw: DataFrame) -> DataFrame:
    """D3: competitions."""
    df = usable(raw, "competitions").select(
        "competition_id", clean_text("name").alias("competition_name"),
        clean_text("country_name").alias("country_name"), "type")
    return dedupe(df, ["competition_id"], total_order(df, ["competition_id"])[1:])


def clean_appearances(raw: DataFrame) -> DataFrame:
    """Key filter, dedupe on appearance id, lenient counters, nulls -> 0."""
    df = usable(raw, "appearances").select(
        "appearance_id", to_id("player_id").alias("player_id"), to_id("game_id").alias("game_id"),
        "competition_id", to_date("date").alias("date"), *[to_int(c).alias(c) for c in COUNTERS])
    df = dedupe(df, ["appearance_id"], total_order(df, ["appearance_id"])[1:])
    return fill_nulls(df, 0, COUNTERS)


def clean_ratings(raw: DataFrame) -> DataFrame:
    """External ratings, several versions per player kept (one per update date)."""
    df = usable(raw, "fifa_players").select(
        to_id("player_id").alias("player_id"), "short_name", "long_name",
        to_int("overall").alias("overall_rating"), to_int("potential").alias("potential_rating"),
        to_float("wage_eur").alias("wage_eur"), to_float("value_eur").alias("value_eur"),
        to_int("age").alias("age"), "club_name", "nationality_name", "preferred_foot",
        to_float("height_cm").alias("height_cm"), to_float("weight_kg").alias("weight_kg"),
        "player_positions", to_date("fifa_update_date").alias("fifa_update_date"))
    return dedupe(df, ["player_id", "fifa_update_date"],
                  total_order(df, ["player_id", "fifa_update_date"])[2:])


@dataclass(frozen=True)
class Presence:
    """One required input: is it there, and is it empty."""
    item: str
    present: bool
    empty: bool


def bronze_readiness(spark: SparkSession, bronze: str, required: list[str] = REQUIRED_RAW) -> list[Presence]:
    """D11 (first half): required raw files present and none empty; one file-system call each."""
    sizes = {r: fs.total_size(spark, f"{bronze.rstrip('/')}/{r}") for r in required}
    return [Presence(r, n is not None, n == 0) for r, n in sizes.items()]


def silver_readiness(spark: SparkSession, silver: str, required: list[str] = SILVER_DATASETS) -> list[Presence]:
    """D11 (second half): every silver dataset folder exists."""
    return [Presence(r, fs.exists(spark, f"{silver.rstrip('/')}/{r}"), False) for r in required]


def _raise_if_not_ready(found: list[Presence], what: str) -> None:
    missing = [p.item for p in found if not p.present]
    empty = [p.item for p in found if p.empty]
    if missing or empty:
        raise NotReady(f"{what}: missing {missing}, empty {empty}")


def bronze_to_silver(spark: SparkSession, cfg: PipelineConfig) -> dict[str, int]:
    """Job 1: clean the six raw files into silver Parquet; returns rows written per dataset.

    Rows that are left out are counted by reason in ``<silver>/rejected``, those that dedupe removes in
    ``<silver>/duplicates``.  Both counts come out of the cleaning jobs: each raw file is read once (one with
    line breaks in fields three times, by many tasks).  As any metric of a job that shuffles, they count the rows
    of a task again that has to be repeated after its executor is lost.
    """
    _raise_if_not_ready(bronze_readiness(spark, cfg.bronze), "bronze")

    def raw(name):
        path = f"{cfg.bronze.rstrip('/')}/{cfg.raw_files[name]}"
        if name in cfg.multiline:
            return read_multiline_csv(spark, path, glob=None, recursive=False)
        return read_csv(spark, path, glob=None, recursive=False)

    clean = {"players": lambda r: clean_players(r, cfg.as_of), "player_valuations": clean_valuations,
             "clubs": clean_clubs, "competitions": clean_competitions, "appearances": clean_appearances,
             "fifa_players": clean_ratings}
    silver = cfg.silver.rstrip("/")

    def job(name):
        frame, seen = observed(raw(name), name)
        rows = write_parquet(clean[name](frame), f"{silver}/{name}",
                             partition_by=["valuation_year"] if name == "player_valuations" else None)
        return rows, seen.get

    done = run_concurrently({name: (lambda n=name: job(n)) for name in clean}, cfg.concurrency)
    rejected, duplicates = [], []
    for name, (rows, counts) in done.items():
        bad = [(name, reason, int(counts[f"r{i}"])) for i, (reason, _) in enumerate(REJECTS[name])]
        rejected += [r for r in bad if r[2]]
        duplicates.append((name, int(counts["rows"]) - sum(r[2] for r in bad) - rows))
    write_parquet(spark.createDataFrame(rejected, "dataset string, reason string, n_rows long"), f"{silver}/rejected")
    write_parquet(spark.createDataFrame(duplicates, "dataset string, n_rows long"), f"{silver}/duplicates")
    return {name: rows for name, (rows, _) in done.items()}


# ================================================================ gold

def silver_to_gold(spark: SparkSession, cfg: PipelineConfig) -> dict[str, Published]:
    """Job 2: build and publish the nine gold tables."""
    _raise_if_not_ready(silver_readiness(spark, cfg.silver), "silver")
    silver, gold = cfg.silver.rstrip("/"), cfg.gold.rstrip("/")

    def s(name):
        return read_parquet(spark, f"{silver}/{name}")

    players, valuations = s("players"), s("player_valuations")
    clubs, competitions = s("clubs"), s("competitions")
    appearances, ratings = s("appearances"), s("fifa_players")

    out: dict[str, Published] = {}

    def put(name, df):
        rules = rules_for(name, df.columns) if cfg.rules != "off" else None
        return publish(df, f"{gold}/{name}", rules=rules, enforce_rules=cfg.rules == "raise")

    out.update(run_concurrently({
        "dim_player": lambda: put("dim_player", G.dim_player(players, ratings)),
        "dim_club": lambda: put("dim_club", clubs.select(
            "club_id", "club_name", "domestic_competition_id", "squad_size", "average_age",
            "total_market_value")),
        "dim_competition": lambda: put("dim_competition", competitions.select(
            "competition_id", "competition_name", "country_name", "type")),
    }, cfg.concurrency))
    # the fact joins the published dimension, not its lineage
    dim_live = read_published(spark, f"{gold}/dim_player")
    fact = G.fact_player_value(G.latest_valuation(valuations), dim_live,
                               G.player_stats(appearances), competitions)
    out["fact_player_value"] = put("fact_player_value", fact)
    fact_live = read_published(spark, f"{gold}/fact_player_value")
    builders = {
        "agg_value_by_position": G.agg_value_by_position,
        "agg_value_by_league": G.agg_value_by_league,
        "agg_value_by_age": G.agg_value_by_age,
        "agg_top_players": G.agg_top_players,
        "agg_value_by_nationality": G.agg_value_by_nationality,
    }
    out.update(run_concurrently(
        {name: (lambda n=name, b=build: put(n, b(fact_live))) for name, build in builders.items()},
        cfg.concurrency))
    if cfg.rules != "off":
        # counted on each staged table during its publish: a few rows per table
        rows = [(name, rule, n) for name, p in out.items() for rule, n in p.violations]
        report = spark.createDataFrame(rows, "table_name string, rule string, violations long")
        out["quality_report"] = publish(report, f"{gold}/quality_report")
    return out


def quality_report(spark: SparkSession, gold: str, tables: list[str] = GOLD_TABLES) -> DataFrame:
    """Violations per (table, rule) over the live gold tables (C1-C10), recomputed
    from the published tables (the pipeline itself records them while publishing)."""
    parts = []
    for t in tables:
        df = read_published(spark, f"{gold.rstrip('/')}/{t}")
        rules = rules_for(t, df.columns)
        if rules:
            parts.append(violation_report(df, rules, table=t))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def register_gold_views(spark: SparkSession, gold: str,
                        tables: list[str] = GOLD_TABLES) -> list[str]:
    """Temp views over the live version of each gold table (S9), so analysts'
    SQL written against the gold tables runs unchanged through ``spark.sql``.
    Each view pins the version that was live when it was registered."""
    for t in tables:
        read_published(spark, f"{gold.rstrip('/')}/{t}").createOrReplaceTempView(t)
    return list(tables)


def gold_summary(spark: SparkSession, gold: str, tables: list[str] = GOLD_TABLES) -> DataFrame:
    """Row count of every published gold table plus the total."""
    return table_counts({t: read_published(spark, f"{gold.rstrip('/')}/{t}") for t in tables})


def run(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    """The whole daily run: job 1, job 2, final counts."""
    bronze_to_silver(spark, cfg)
    silver_to_gold(spark, cfg)
    return gold_summary(spark, cfg.gold)


def main(argv: list[str] | None = None) -> None:
    """``spark-submit strata/plans/pipeline.py {silver|gold|run} --bronze .. --silver .. --gold ..``"""
    import argparse

    ap = argparse.ArgumentParser(prog="strata-pipeline")
    ap.add_argument("step", choices=["silver", "gold", "run"])
    ap.add_argument("--bronze", required=True)
    ap.add_argument("--silver", required=True)
    ap.add_argument("--gold", required=True)
    ap.add_argument("--as-of", default=_dt.date.today().isoformat(), help="default: the day of the run")
    ap.add_argument("--rules", choices=["report", "raise", "off"], default="report")
    ap.add_argument("--multi-line", nargs="*", default=[], choices=sorted(RAW_FILES),
                    help="datasets with line breaks inside fields")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName(f"strata-{a.step}").getOrCreate()
    cfg = PipelineConfig(a.bronze, a.silver, a.gold, _dt.date.fromisoformat(a.as_of),
                         rules=a.rules, multiline=frozenset(a.multi_line))
    if a.step == "silver":
        print(bronze_to_silver(spark, cfg))
    elif a.step == "gold":
        print({k: v.rows for k, v in silver_to_gold(spark, cfg).items()})
    else:
        run(spark, cfg).show(truncate=False)


if __name__ == "__main__":
    main()
