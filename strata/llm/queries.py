"""The registered queries of the training-data operators and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import common as C
from strata.llm import edit_embedding, embedding_dedup, filter_audit, license_scan, link_graph, near_dedup, packing, piece_bpe, repetition, runlength_index, substring_dedup, token_alignment, warc
from strata.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base phrases and licence templates found in every document."""
    found = license_scan.scan_licenses(C.documents(spark, sf_dir), ["doc_id"])
    place, span = "base_places", "spans"
    labels = lambda *columns: F.array_join(F.array_sort(F.array_distinct(F.concat(*columns))), ",")
    covered = F.aggregate(
        F.array_sort(F.col(span)),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to")),
        lambda a, s: F.struct((a["n"] + F.greatest(F.lit(0).cast("long"), s["end"] - F.greatest(s["first"], a["to"])))
                              .alias("n"), F.greatest(a["to"], s["end"]).alias("to")),
        lambda a: a["n"])
    return found.select(
        "doc_id", "n_words",
        F.size(place).cast("long").alias("n_base"),
        F.array_min(f"{place}.word").alias("first_word"),
        F.array_max(f"{place}.word").alias("last_word"),
        labels(F.col(f"{place}.label")).alias("base_labels"),
        labels(F.col(f"{place}.label"), F.col(f"{span}.label")).alias("labels"),
        F.coalesce(covered / F.nullif(F.col("n_words"), F.lit(0)), F.lit(0.0)).alias("score"),
        F.size(span).cast("long").alias("n_spans"),
    )


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repetition and symbol measures of every document, with the verdict."""
    found = repetition.measure_repetition(C.documents(spark, sf_dir)).drop("text")
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        repetition.base_failed().alias("base_failed"),
        (~(repetition.base_failed() | repetition.method_failed())).alias("kept"),
        "dup_line_chars", *(f"dup_chars_{n}" for n in repetition.RUNS[1:]),
    )


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again."""
    path = _tokenizer("piece_bpe_32k.model")
    coded = piece_bpe.decode(piece_bpe.encode(C.documents(spark, sf_dir), path), path)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def packed(docs: DataFrame, keep_words: bool = True) -> DataFrame:
    """The pieces of ``docs`` (doc_id, text), numbered."""
    pieces = packing.decompose(docs.select("doc_id", "text"), _tokenizer("word_bpe_49k.json"), keep_words=keep_words)
    pieces = pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return packing.number(pieces, ["doc_id", "start", "ids_crc32"]).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The binary pieces of every document."""
    return packed(C.documents(spark, sf_dir))


@query
def op2_edit_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint, its likeness to its edit and to the next document, and its component's smallest id."""
    found = edit_embedding.compare_neighbours(C.documents(spark, sf_dir))
    path = scratch_path(spark, "compared")
    found.write.parquet(path)
    found = spark.read.parquet(path)
    return found.join(edit_embedding.near_documents(found.select("doc_id", "fingerprint")), "fingerprint", "left").select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "near_id")


@query
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as archives and read again; lengths and digests of responses are taken of the payload read."""
    path = scratch_path(spark, "warc")
    warc.write_warc(warc.page_records(spark.read.parquet(f"{sf_dir}/pages.parquet")), path)
    response = warc.read_warc(spark, path).filter("record_type = 'response'").select(
        "page_id", F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"), "record_type", F.lit(None).cast("long").alias("refers_to"))
    revisit = warc.read_warc(spark, path, payload="false").filter("record_type = 'revisit'").select(
        "page_id", F.col("payload_length").alias("payload_bytes"), "payload_digest", "record_type",
        F.substring_index("refers_to", ":", -1).cast("long").alias("refers_to"))
    return response.unionByName(revisit)


ORACLE["op10_warc"] = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n,
         max(page_id) OVER (PARTITION BY coalesce(html, '')) AS keeper
  FROM pages)
SELECT page_id, n AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN n >= 1000 AND keeper <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND keeper <> page_id THEN keeper END AS refers_to
FROM p
"""


@query
def op9_link_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by the rules, else by its host's trust and distrust."""
    return link_graph.judge(spark.read.parquet(f"{sf_dir}/pages.parquet")).select(
        "page_id", "host", "path", "rule", "verdict")


@query
def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's component of near-duplicates; its smallest id is kept."""
    return near_dedup.near_groups(C.documents(spark, sf_dir)).select(
        "doc_id", "n_shingles", "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


@query
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of windows that occur elsewhere."""
    return substring_dedup.remove_repeats(C.documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE["op8_substring_dedup"] = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         [x FOR x IN string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+') IF x <> ''] AS w
  FROM documents),
win AS (
  SELECT r, i, array_to_string(w[i : i + 34], ' ') AS k
  FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
again AS (SELECT k FROM win GROUP BY k HAVING count(*) > 1),
gone AS (
  SELECT DISTINCT r, unnest(range(i, i + 35)) AS p FROM win JOIN again USING (k)),
lost AS (SELECT r, list(p) AS ps, count(*) AS n FROM gone GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_removed,
       sha256(array_to_string(CASE WHEN n IS NULL THEN w ELSE
         [w[p] FOR p IN range(1, len(w) + 1) IF NOT list_contains(ps, p)] END, ' ')) AS kept_sha256
FROM d LEFT JOIN lost USING (r)
"""


@query
def op6_runlength_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of 200-byte strings that occur elsewhere."""
    return runlength_index.remove_repeats(C.documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes after every prefix of all their orders, per source."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return filter_audit.audit(
        C.documents(spark, sf_dir, "doc_id", "text", "source"), filter_audit.base_filters(),
        {"good": labels.filter("quality = 1").select("doc_id"), "toxic": labels.filter("toxic = 1").select("doc_id")})


ORACLE["op11_filter_audit"] = """
WITH t AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         [x FOR x IN string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+') IF x <> ''] AS w
  FROM documents),
d AS (
  SELECT part,
         len(w) < 50 AS a,
         100 * len(list_distinct(w)) < 65 * len(w) AS b,
         100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 5 * length(text) AS c,
         regexp_matches(text, '[#$%&*|]') AS d,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS e,
         coalesce(doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL), false) AS good,
         coalesce(doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL), false) AS toxic
  FROM t),
g AS (
  SELECT part,
         (CASE WHEN a THEN 'A' ELSE '' END) || (CASE WHEN b THEN 'B' ELSE '' END) || (CASE WHEN c THEN 'C' ELSE '' END)
         || (CASE WHEN d THEN 'D' ELSE '' END) || (CASE WHEN e THEN 'E' ELSE '' END) AS fails,
         good, toxic, count(*) AS n
  FROM d GROUP BY ALL),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (
  SELECT p.x || q.x || r.x || s.x || u.x AS filter_order
  FROM f p, f q, f r, f s, f u
  WHERE p.x NOT IN (q.x, r.x, s.x, u.x) AND q.x NOT IN (r.x, s.x, u.x) AND r.x NOT IN (s.x, u.x) AND s.x <> u.x),
k AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS x, substr(filter_order, 1, step - 1) AS before
  FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
m AS (
  SELECT part, filter_order, step, x, n, good, toxic, fails,
         contains(fails, x) AS own, translate(before, fails, '') <> before AS gone
  FROM k, g),
c AS (
  SELECT part, filter_order, step, x,
         sum(n) FILTER (WHERE NOT own AND NOT gone) AS kept,
         sum(n) FILTER (WHERE own AND NOT gone) AS removed,
         sum(n) FILTER (WHERE own AND gone) AS redundant,
         sum(n) FILTER (WHERE fails = x) AS unique_fails,
         sum(n) FILTER (WHERE own AND NOT gone AND good) AS good_lost,
         sum(n) FILTER (WHERE own AND NOT gone AND toxic) AS toxic_lost
  FROM m GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step,
       CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
       CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
       CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
       CAST(coalesce(sum(removed) OVER (PARTITION BY part, x), 0) AS BIGINT) AS shapley
FROM c
"""


@query
def op12_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's links at a cosine of 0.93 within its label, and its component; its smallest id is kept."""
    found = embedding_dedup.link_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), 0.93)
    return found.select("vec_id", "n_links", "component_id",
                        F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"))


@query
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's groups of tokens of two tokenizers, and the corpus-wide counts of its linked ids."""
    return token_alignment.align(C.documents(spark, sf_dir), _tokenizer("byte_bpe_50k.json"), _tokenizer("piece_bpe_32k.model"))
