import collections
import re

from strata.llm import repetition as R
from strata.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    grams = list(zip(words, words[1:], words[2:]))
    times = collections.Counter(grams)
    inside = {k + j for k, g in enumerate(grams) if times[g] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n, failed = len(words), len(words) < 50 or 100 * len(inside) > 50 * len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside), failed)


def test_query_against_plain_count(spark, folder, messy):
    got = QUERIES["op7_quality_rules"](spark, f"{folder[0]}/messy").collect()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted((tuple(r)[:7] for r in got), key=key) == sorted(((i, *plain(t)) for i, t in messy), key=key)
    kept = {r.doc_id: r.kept for r in got if r.doc_id}
    assert not any(r.kept for r in got if r.base_failed)
    assert kept[7] and kept[9] and kept[19]
    assert not kept[22] and not kept[17] and not kept[15]      # symbols, repeated lines, repeated words


def test_longer_runs(spark):
    run = "p q r s t u v"
    df = spark.createDataFrame([(1, f"{run} a {run} b"), (2, run)], "doc_id long, text string")
    a, b = R.measure_repetition(df).orderBy("doc_id").collect()
    assert (a.dup_chars_5, a.dup_chars_7, a.dup_chars_10) == (14, 14, 0) and b.dup_chars_5 == 0


def test_empty_table_and_equal_names(spark, folder):
    assert QUERIES["op7_quality_rules"](spark, f"{folder[0]}/empty").count() == 0
    df = spark.createDataFrame([("a b", 7)], "text string, n_words long")
    assert R.measure_repetition(df).first().n_words == 2


def test_each_limit_alone(spark):
    """Texts of words of one length that go beyond one limit and no other, and one that is within all."""
    unique = iter(f"w{k:04d}" for k in range(10000))
    some = lambda n: [next(unique) for _ in range(n)]

    def twice(passages, length, total):
        out = []
        for own in [some(length) for _ in range(passages)] * 2:
            out += own + some(1)
        return " ".join(out + some(total - len(out)))

    texts = {
        "dup_chars_5": twice(4, 5, 200), "dup_chars_7": twice(1, 7, 100), "dup_chars_10": twice(1, 10, 180),
        "dup_line_chars": "\n".join(f"again again2\n{' '.join(some(4))}" for _ in range(25)),
        "n_symbols": " ".join(w + "#" * (k % 4 == 0) for k, w in enumerate(some(60))), "none": twice(1, 10, 220)}
    df = spark.createDataFrame(list(texts.items()), "name string, text string")
    found = R.measure_repetition(df).withColumn("failed", R.method_failed()).withColumn("base", R.base_failed())
    most = {**{f"dup_chars_{n}": share for n, share in R.MOST_SHARE.items()}, "dup_line_chars": R.MOST_LINES}
    for r in found.collect():
        over = {c for c, share in most.items() if 100 * r[c] > share * r.word_chars}
        over |= {"n_symbols"} if 100 * r.n_symbols > R.MOST_SYMBOLS * r.n_words else set()
        assert over == {r["name"]} - {"none"} and r.failed == bool(over) and not r.base
