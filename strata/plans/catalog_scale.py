"""Query keys of the operators that are about scale: parallel scans, incremental state, layouts, pruning."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from strata.operators import aggregate as A
from strata.operators import incremental as I
from strata.operators.bloom import missing_keys_filtered
from strata.plans import catalog as K
from strata.session import scratch_path
from strata.sinks.files import write_csv, write_parquet
from strata.sinks.layout import write_bucketed, write_clustered
from strata.sinks.partitions import partition_values, publish_partitions, read_partitions
from strata.sources.files import read_parquet, table
from strata.sources.manifest import below, manifest
from strata.sources.multiline import read_multiline_csv

query = K.query

NOTE_SCHEMA = StructType([StructField("l_orderkey", LongType()), StructField("l_linenumber", IntegerType()),
                          StructField("l_note", StringType())])


@query("csv_multiline_parallel", """
SELECT l_orderkey, CAST(l_linenumber AS INTEGER) AS l_linenumber,
       'part ' || l_partkey || chr(10) || '"' || l_returnflag || '", ' || l_linestatus || chr(10) || chr(10)
       || 'supplier ' || l_suppkey AS l_note
FROM lineitem
""")
def csv_multiline_parallel(spark, d):
    """Lineitem with notes of four lines as CSV, read by many tasks that find records by quote parity."""
    li = table(spark, d, "lineitem")
    note = F.concat(F.lit("part "), "l_partkey", F.lit('\n"'), "l_returnflag", F.lit('", '), "l_linestatus",
                    F.lit("\n\nsupplier "), "l_suppkey")
    path = scratch_path(spark, "multiline")
    write_csv(li.select("l_orderkey", "l_linenumber", note.alias("l_note")), path)
    return read_multiline_csv(spark, path, NOTE_SCHEMA)


@query("file_manifest", """
SELECT 'source=' || source AS folder, CAST(sum(strlen(coalesce(text, '')) + 1) AS BIGINT) AS total_bytes,
       count(CASE WHEN false THEN 1 END) AS empty_files
FROM documents WHERE source IS NOT NULL GROUP BY source
""")
def file_manifest(spark, d):
    """Texts written as files per source, listed as a scan and summed per folder."""
    root = scratch_path(spark, "texts")
    docs = table(spark, d, "documents").filter("source is not null")
    docs.select(F.coalesce("text", F.lit("")).alias("value"), "source").write.partitionBy("source").text(root)
    files = below(manifest(spark, root, "*.txt"), root)
    return A.size_summary(files, "folder").select("folder", "total_bytes", "empty_files")


@query("incremental_latest", """
SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey) = 1
""")
def incremental_latest(spark, d):
    """Latest order per customer kept as state over three batches with late and repeated rows.

    The batches are the orders by status, so each has rows before and after those of the others; the second
    repeats the first and is sent twice.
    """
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice", "o_orderstatus")
    status, rows = F.coalesce("o_orderstatus", F.lit("")), ["o_custkey", "o_orderkey", "o_orderdate", "o_totalprice"]
    target, latest = scratch_path(spark, "latest-state"), [F.col("o_orderdate").desc_nulls_last(), F.col("o_orderkey").asc()]
    put = lambda n, b: I.update_latest(spark, target, n, b.select(*rows), ["o_custkey"], latest)
    put(1, o.filter(status == "O"))
    put(2, o.filter(status.isin("O", "F")))
    if put(2, o.filter(status.isin("O", "F"))):
        raise RuntimeError("a batch was merged twice")
    put(3, o.filter(~status.isin("O", "F")))
    return I.read_state(spark, target)


@query("incremental_totals", """
SELECT user_id, CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS purchases,
       CAST(sum(CAST(round(CASE WHEN event_type = 'click' THEN value * 2 ELSE value END, 2) AS DECIMAL(28,6))) AS DOUBLE) AS total_value,
       count(value) AS n_values, count(*) AS n_rows
FROM events WHERE event_type <> 'error' OR event_type IS NULL GROUP BY user_id
""")
def incremental_totals(spark, d):
    """Totals per user kept as state: all events, then errors deleted and clicks replaced (A1, A2, retraction)."""
    e = table(spark, d, "events").select("event_id", "user_id", "event_type", F.round("value", 2).alias("value"))
    kind = F.coalesce("event_type", F.lit(""))
    after = e.filter(kind != "error").withColumn("value", F.when(kind == "click", F.round(F.col("value") * 2, 2)).otherwise(F.col("value")))
    sums = {"purchases": F.when(kind == "purchase", 1).otherwise(0), "total_value": "value"}
    target = scratch_path(spark, "totals-state")
    state = lambda x: I.totals_state(x, ["user_id"], sums, {"n_values": "value"})
    I.update_totals(spark, target, 1, state(e), ["user_id"])
    I.update_totals(spark, target, 2, state(I.changes(e, after, ["event_id"])), ["user_id"])
    return I.read_state(spark, target).withColumn("total_value", F.col("total_value").cast("double"))


@query("partition_publish", """
SELECT o_orderkey, o_custkey, CASE WHEN year(o_orderdate) = 1997 THEN -1.0 ELSE o_totalprice END AS o_totalprice,
       CAST(year(o_orderdate) AS INTEGER) AS o_year
FROM orders WHERE year(o_orderdate) <> 1996 OR o_orderdate IS NULL
""")
def partition_publish(spark, d):
    """Orders published by year; then one year rewritten and one dropped, the others' files kept."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", F.col("o_totalprice").cast("double").alias("o_totalprice"),
                                         F.year("o_orderdate").alias("o_year"))
    target = scratch_path(spark, "orders-published")
    first = publish_partitions(o, target, "o_year")
    second = publish_partitions(o.filter("o_year = 1997").withColumn("o_totalprice", F.lit(-1.0)), target, "o_year", drop=["1996"])
    parts = partition_values(spark, target)
    if any(v != (second if year == "1997" else first).version for year, v in parts.items()):
        raise RuntimeError("an unchanged year was rewritten")
    return read_partitions(spark, target)


@query("bucketed_join", """
SELECT c.c_custkey, c.c_name, count(o.o_orderkey) AS n_orders,
       CAST(coalesce(sum(CAST(o.o_totalprice AS DECIMAL(18,2))), 0) AS DOUBLE) AS total
FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey GROUP BY c.c_custkey, c.c_name
""")
def bucketed_join(spark, d):
    """Customers joined with their orders' totals, both bucketed on the key: no exchange."""
    root, mark = scratch_path(spark, "bucketed"), uuid.uuid4().hex[:12]
    c = write_bucketed(table(spark, d, "customer").select("c_custkey", "c_name"), f"strata_customer_{mark}", ["c_custkey"],
                       8, f"{root}/customer")
    o = write_bucketed(table(spark, d, "orders").filter("o_custkey is not null").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").alias("price")),
        f"strata_orders_{mark}", ["c_custkey"], 8, f"{root}/orders")
    totals = o.groupBy("c_custkey").agg(F.count("o_orderkey").alias("n_orders"), F.sum("price").alias("total"))
    return c.hint("merge").join(totals, "c_custkey", "left").select(
        "c_custkey", "c_name", F.coalesce("n_orders", F.lit(0)).alias("n_orders"),
        F.coalesce("total", F.lit(0)).cast("double").alias("total"))


@query("pruned_by_dimension", """
SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS o_year
FROM orders WHERE year(o_orderdate) IN (
  SELECT y FROM (SELECT year(o_orderdate) AS y, max(o_totalprice) AS m FROM orders GROUP BY 1 ORDER BY m DESC, y LIMIT 2))
""")
def pruned_by_dimension(spark, d):
    """Orders by year joined with the two years of the largest orders: other years' files aren't read."""
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("o_year"))
    root = scratch_path(spark, "by-year")
    write_parquet(o, f"{root}/orders", partition_by=["o_year"])
    years = o.filter("o_year is not null").groupBy("o_year").agg(F.max("o_totalprice").alias("m"))
    write_parquet(A.rank_rows(years, [F.col("m").desc(), F.col("o_year").asc()], "place"), f"{root}/years")
    chosen = read_parquet(spark, f"{root}/years").filter("place <= 2").select(F.col("o_year").alias("year"))
    orders = read_parquet(spark, f"{root}/orders")
    return orders.join(chosen, F.col("o_year") == F.col("year")).select("o_orderkey", "o_totalprice", "o_year")


@query("missing_keys_filtered", """
SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events WHERE user_id IS NOT NULL)
""")
def missing_keys_filtered_query(spark, d):
    """Customers without an event: a Bloom filter over the events' users first, then an exact anti-join."""
    c = table(spark, d, "customer").select("c_custkey", "c_name")
    e = table(spark, d, "events").select(F.col("user_id").alias("c_custkey"))
    return missing_keys_filtered(c, e, "c_custkey")


@query("clustered_scan", """
SELECT l_orderkey, l_partkey, l_extendedprice FROM lineitem
WHERE l_partkey BETWEEN 10 AND 30 OR l_orderkey BETWEEN 100 AND 300
""")
def clustered_scan(spark, d):
    """Lineitem in curve order of part and order: a filter on either prunes row groups."""
    path = scratch_path(spark, "clustered")
    write_clustered(table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice"), path,
                    "l_partkey", "l_orderkey", files=16)
    return read_parquet(spark, path).filter("l_partkey BETWEEN 10 AND 30 OR l_orderkey BETWEEN 100 AND 300")


@query("gold_summary", K._with(K._REFRESH_CTE, """
SELECT table_name, CAST(row_count AS BIGINT) AS row_count FROM (
  SELECT 'dim_player' AS table_name, (SELECT count(*) FROM dim) AS row_count
  UNION ALL SELECT 'dim_club', (SELECT count(*) FROM nation)
  UNION ALL SELECT 'dim_competition', (SELECT count(*) FROM comp)
  UNION ALL SELECT 'fact_player_value', (SELECT count(*) FROM fact)
  UNION ALL SELECT 'agg_value_by_position', (SELECT count(DISTINCT position) FROM fact)
  UNION ALL SELECT 'agg_value_by_league', (SELECT count(*) FROM (SELECT DISTINCT competition_name, league_country FROM fact WHERE competition_name IS NOT NULL))
  UNION ALL SELECT 'agg_value_by_age', (SELECT count(DISTINCT age) FROM fact WHERE age BETWEEN 16 AND 40)
  UNION ALL SELECT 'agg_top_players', (SELECT least(count(*), 50) FROM fact)
  UNION ALL SELECT 'agg_value_by_nationality', (SELECT least(count(*), 30) FROM (SELECT nationality FROM fact WHERE nationality IS NOT NULL GROUP BY nationality HAVING count(player_id) >= 5)))
UNION ALL
SELECT 'TOTAL', CAST((SELECT count(*) FROM dim) + (SELECT count(*) FROM nation) + (SELECT count(*) FROM comp) + (SELECT count(*) FROM fact)
  + (SELECT count(DISTINCT position) FROM fact)
  + (SELECT count(*) FROM (SELECT DISTINCT competition_name, league_country FROM fact WHERE competition_name IS NOT NULL))
  + (SELECT count(DISTINCT age) FROM fact WHERE age BETWEEN 16 AND 40)
  + (SELECT least(count(*), 50) FROM fact)
  + (SELECT least(count(*), 30) FROM (SELECT nationality FROM fact WHERE nationality IS NOT NULL GROUP BY nationality HAVING count(player_id) >= 5)) AS BIGINT)
"""))
def gold_summary_query(spark, d):
    """Row counts of the pipeline's nine published tables and their total."""
    from strata.plans import pipeline as P

    return P.gold_summary(spark, K._refresh(spark, d).gold)


@query("duplicate_rows", """
SELECT 'players' AS dataset, (SELECT count(*) FROM customer WHERE c_acctbal < 0) AS n_rows
UNION ALL
SELECT 'player_valuations', (
  SELECT count(*) - count(DISTINCT (o_custkey, CAST(o_orderdate AS DATE))) FROM orders
  WHERE o_custkey IS NOT NULL AND o_totalprice >= 0.005)
UNION ALL SELECT 'appearances', (SELECT count(*) - count(DISTINCT event_id) FROM events WHERE user_id IS NOT NULL AND event_id IS NOT NULL)
UNION ALL SELECT 'clubs', 0
UNION ALL SELECT 'competitions', 0
UNION ALL SELECT 'fifa_players', (SELECT 3 * (count(*) - count(DISTINCT s_suppkey)) FROM supplier WHERE s_suppkey IS NOT NULL)
""")
def duplicate_rows(spark, d):
    """Usable raw rows that dedupe removed, per dataset, counted by the cleaning jobs."""
    return read_parquet(spark, f"{K._refresh(spark, d).silver}/duplicates")
