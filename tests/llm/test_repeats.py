import collections
import hashlib
import random
import re

import numpy as np
import pytest

from strata.llm import runlength_index as X
from strata.llm import substring_dedup as S
from strata.llm.queries import ORACLE, QUERIES

from .conftest import words

key = lambda r: tuple(str(x) for x in r)


def plain_words(rows, window=35):
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    times = collections.Counter(tuple(w[k:k + window]) for _, w in split for k in range(len(w) - window + 1))
    out = []
    for i, w in split:
        gone = {k + j for k in range(len(w) - window + 1) if times[tuple(w[k:k + window])] > 1 for j in range(window)}
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def plain_bytes(rows, window=200):
    raw = [(i, (t or "").encode()) for i, t in rows]
    times = collections.Counter(hash(b[k:k + window]) for _, b in raw for k in range(len(b) - window + 1))
    out = []
    for i, b in raw:
        change = np.zeros(len(b) + 1, int)
        for k in range(len(b) - window + 1):
            if times[hash(b[k:k + window])] > 1:
                change[k] += 1
                change[k + window] -= 1
        gone = np.cumsum(change)[:-1] > 0
        spans = int((gone & ~np.concatenate(([False], gone[:-1]))).sum()) if len(b) else 0
        out.append((i, len(b), int(gone.sum()), spans, bytes(np.frombuffer(b, np.uint8)[~gone])))
    return out


def test_words_query(spark, folder, messy):
    got = QUERIES["op8_substring_dedup"](spark, f"{folder[0]}/messy").collect()
    want = [(*r[:3], hashlib.sha256(r[3].encode()).hexdigest()) for r in plain_words(messy)]
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert QUERIES["op8_substring_dedup"](spark, f"{folder[0]}/empty").count() == 0


def test_words_oracle(folder, messy):
    import duckdb

    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{folder[0]}/messy/documents.parquet/*.parquet'")
    got = con.sql(ORACLE["op8_substring_dedup"]).fetchall()
    want = [(*r[:3], hashlib.sha256(r[3].encode()).hexdigest()) for r in plain_words(messy)]
    assert sorted(got, key=key) == sorted(want, key=key)


@pytest.mark.parametrize("frequent", [3000, 2])
def test_bytes_query(spark, folder, messy, monkeypatch, frequent):
    """With a low bound on frequent runs most windows are asked about one by one: the same result."""
    monkeypatch.setattr(X, "FREQUENT", frequent)
    got = QUERIES["op6_runlength_index"](spark, f"{folder[0]}/messy").collect()
    want = [(*r[:4], hashlib.sha256(r[4]).hexdigest()) for r in plain_bytes(messy)]
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    if frequent == 2:
        assert QUERIES["op6_runlength_index"](spark, f"{folder[0]}/empty").count() == 0


def shared_passages(seed, n):
    """Documents of few different words that share passages at odd places."""
    rng = random.Random(seed)
    passages = [words(seed * 100 + k, rng.randint(5, 60)) for k in range(6)]
    return [(i, " ".join(rng.choice(passages) if rng.random() < 0.5 else words(rng.randrange(10**6), rng.randint(1, 12))
                         for _ in range(rng.randint(1, 8)))) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_other_windows_many_blocks(spark, monkeypatch, seed):
    from strata.llm import blocks

    monkeypatch.setattr(blocks, "BLOCK_BYTES", 500)
    rows = shared_passages(seed, 60)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept) for r in S.remove_repeats(df, window=12).collect()]
    assert sorted(got) == sorted(plain_words(rows, 12))
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in X.remove_repeats(df, window=40).collect()]
    assert sorted(got) == sorted(plain_bytes(rows, 40))


def test_index_statistics():
    rng = random.Random(9)
    for _ in range(150):
        letters = rng.choice([b"a", b"ab", bytes(range(256))])
        strings = list({bytes(rng.choices(letters, k=rng.randint(1, 40))) for _ in range(rng.randint(1, 7))})
        at = np.concatenate(([0], np.cumsum([len(s) for s in strings])))
        found = X.RunLengthIndex(np.frombuffer(b"".join(strings), np.uint8), at).statistics()
        for s, a in zip(strings, at):
            for i in range(len(s)):
                longest = max((n for n in range(1, len(s) - i + 1)
                               if sum(t.startswith(s[i:i + n], k) for t in strings for k in range(len(t))) > 1), default=0)
                assert found[a + i] == longest


def test_runs_are_fewer_than_bytes_where_text_repeats():
    passage = words(77, 40).encode()
    strings = [bytes([65 + k]) + passage for k in range(20)]
    at = np.concatenate(([0], np.cumsum([len(s) for s in strings])))
    index = X.RunLengthIndex(np.frombuffer(b"".join(strings), np.uint8), at)
    assert len(index.above) < at[-1] / 4


def test_equal_names(spark):
    df = spark.createDataFrame([("a b", 7, "x")], "text string, n_words long, kept string")
    assert tuple(S.remove_repeats(df).first()) == ("a b", 2, 0, "a b")
