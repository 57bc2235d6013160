import random

import numpy as np
import pytest

from strata.llm import near_dedup as N
from strata.llm.components import components
from strata.llm.queries import QUERIES
from strata.session import scratch_scope

from .conftest import words


def plain_sets(rows):
    import re

    out = {}
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({k: k + 32 for k in range(65, 91)}))
        out[i] = {tuple(w[j:j + 4]) for j in range(len(w) - 3)} or ({tuple(w)} if w else set())
    return out


def plain_components(rows):
    sets = plain_sets((i, t) for i, t in rows if i is not None)
    parent = {i: i for i in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    return {i: top(i) for i in sets}, {i: len(s) for i, s in sets.items()}


def test_query(spark, folder, messy):
    got = QUERIES["op3_near_dedup"](spark, f"{folder[0]}/messy").collect()
    comp, size = plain_components(messy)
    assert len(got) == len(messy)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (size[r.doc_id], comp[r.doc_id], comp[r.doc_id] == r.doc_id)
    assert QUERIES["op3_near_dedup"](spark, f"{folder[0]}/empty").count() == 0


@pytest.mark.parametrize("block", [3])
def test_chains_of_near_copies(spark, monkeypatch, block):
    """Each copy is near to the last one only; ends are far apart."""
    monkeypatch.setattr(N, "BLOCK", block)
    rng = random.Random(block)
    text, rows = words(31, 60).split(), []
    for i in range(40):
        rows.append((100 + (i * 17) % 40, " ".join(text)))
        text = list(text)
        text[rng.randrange(len(text))] = f"w{i}"
    rows += [(200 + i, words(300 + i, 30)) for i in range(20)]
    got = {r.doc_id: r.component_id for r in N.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == plain_components(rows)[0]


@pytest.mark.parametrize("few", [0, 4])
def test_families_near_the_threshold(spark, monkeypatch, few):
    """A family that its base alone holds together, one just under the threshold, and one of exact copies."""
    monkeypatch.setattr(N, "BLOCK", 24)
    rng = random.Random(few)
    rows = []

    def edited(text, n):
        text = list(text)
        for at in rng.sample(range(0, len(text), 5), n):
            text[at] = f"w{rng.random()}"
        return " ".join(text)

    base = words(71, 200).split()
    rows += [(i, edited(base, 4)) for i in range(60)] + [(60, " ".join(base))]
    base = words(72, 200).split()
    rows += [(100 + i, edited(base, 3 + i % 4)) for i in range(60)]
    rows += [(300 + i, words(73, 40)) for i in range(50)]
    got = {r.doc_id: r.component_id for r in N.near_groups(spark.createDataFrame(rows, "doc_id long, text string"), few).collect()}
    want = plain_components(rows)[0]
    assert got == want
    assert len({want[i] for i in range(61)}) == 1 and len({want[100 + i] for i in range(60)}) > 5


def test_texts_of_one_id(spark):
    """Rows of one id with different texts are linked each by its own; ``first`` marks one text of a component."""
    a, b, c = words(81, 50), words(82, 50), words(83, 50)
    rows = [(7, a), (7, b), (7, a), (8, b + " end"), (9, c), (3, a + " end"), (10, None), (10, "")]
    got = sorted((r.doc_id, r.component_id, r.n_shingles, r.first)
                 for r in N.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(3, 3, 48, True), (7, 3, 47, False), (7, 3, 47, False), (7, 7, 47, True), (8, 7, 48, False), (9, 9, 47, True),
                   (10, 10, 0, True), (10, 10, 0, True)]


@pytest.mark.parametrize("sketch", [N.SMALL, N.LARGE])
def test_odd_sketch_counts_samples_that_differ(sketch):
    rng = np.random.default_rng(1)
    for share in (0.0, 0.1, 0.2, 0.4):
        a = rng.integers(0, 2**63, 4000, dtype=np.uint64)
        b = a.copy()
        b[:int(2000 * share)] = rng.integers(0, 2**63, int(2000 * share), dtype=np.uint64)
        x, y = np.unique(a), np.unique(b)
        samples, bits = N.signatures(np.concatenate((x, y)), np.array([0, len(x), len(x) + len(y)]), sketch)
        differ = int((samples[0] != samples[1]).sum())
        apart = int(np.bitwise_count(bits[0] ^ bits[1]).sum())
        expected = sketch.bits * (1 - np.exp(-4 * differ / sketch.bits)) / 2
        assert abs(apart - expected) <= 8 + 3 * expected**0.5
        assert apart <= sketch.most or share > 0.2


def test_components_of_paths_and_stars(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    rng.shuffle(edges)
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, **{100 + i: 100 for i in range(30)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def shuffles_with(df, column):
    """The plans, as text, of what goes through a shuffle with ``column`` in it; plan ``df`` without adaptive execution."""
    def walk(node):
        if node.nodeName() == "Exchange" and any(node.output().apply(i).name() == column for i in range(node.output().size())):
            yield node.toString()
        for i in range(node.children().size()):
            yield from walk(node.children().apply(i))

    return list(walk(df._jdf.queryExecution().executedPlan()))


@pytest.fixture
def plain_plans(spark):
    """Joins as for large tables, in plans that don't change while they run."""
    put = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    was = {k: spark.conf.get(k) for k in put}
    for k, v in put.items():
        spark.conf.set(k, v)
    yield
    for k, v in was.items():
        spark.conf.set(k, v)


def test_only_texts_of_shared_bands_move_and_only_once(spark, tmp_path, plain_plans):
    texts = [(i, words(i, 30)) for i in range(60)] + [(7, words(7, 30)), (None, words(9, 30)), (8, words(900, 30))]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    keyed = docs.filter("doc_id in (7, 8)").select(
        "doc_id", N.text_sha("text").alias("text_sha")).distinct().selectExpr("xxhash64(text_sha) id", "*")
    keyed.write.parquet(f"{tmp_path}/ids")
    ids = spark.read.parquet(f"{tmp_path}/ids")
    found = N.full_sets(docs, ids)
    moved = shuffles_with(found, "text") + shuffles_with(found, "first")
    assert len(moved) == 1 and "BroadcastExchange" in moved[0]           # behind the filter of the ids
    assert not shuffles_with(found, "members")
    got = {r.id: len(r.members) // 8 for r in found.collect()}
    assert got == {r.id: 27 for r in ids.collect()} and len(got) == 3 and found.count() == 3


def test_confirmed_sets_move_behind_a_filter_and_links_stay(spark, tmp_path, plain_plans):
    base = np.arange(100, dtype=np.uint64)
    sets = {1: base, 2: base[:80], 3: base[:79], 4: base + np.uint64(1000)}
    spark.createDataFrame([(i, bytearray(x.tobytes())) for i, x in sets.items()], "id long, members binary").write.parquet(f"{tmp_path}/sets")
    spark.createDataFrame([(1, 2), (1, 3), (1, 4), (2, 3)], "a long, b long").write.parquet(f"{tmp_path}/pairs")
    found = N.confirm(spark.read.parquet(f"{tmp_path}/pairs"), spark.read.parquet(f"{tmp_path}/sets"))
    assert all("BroadcastExchange" in x for x in shuffles_with(found, "members") + shuffles_with(found, "x"))
    assert sorted(map(tuple, found.collect())) == [(1, 2), (2, 3)]


def test_filter_takes_each_set_once(spark, monkeypatch):
    """The rows made for the filter grow with the sets of the pairs, not with the pairs."""
    seen, plain = [], N.flagged
    monkeypatch.setattr(N, "flagged", lambda df, wanted, *more: seen.append(wanted) or plain(df, wanted, *more))
    members = np.arange(20, dtype=np.uint64).tobytes()
    sets = spark.createDataFrame([(i, bytearray(members)) for i in range(12)], "id long, members binary")
    pairs = spark.createDataFrame([(a, b) for a in range(10) for b in range(a + 1, 10)], "a long, b long")
    assert N.confirm(pairs, sets).count() == 45
    assert [x.count() for x in seen] == [10]


def test_components_write_once_a_round(spark):
    chain = [(i, i + 1) for i in range(40)]
    edges = spark.createDataFrame([(b, a) for a, b in chain[::2]] + chain[1::2] + [(7, 7), (50, 60), (60, 50), (50, 70)], "a long, b long")
    got = {r.id: r.component for r in components(edges).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 50 for i in (50, 60, 70)}
    with scratch_scope() as ends:
        assert components(spark.createDataFrame([(1, i) for i in range(2, 9)], "a long, b long")).count() == 8
    assert len(ends) == 2
    assert components(edges.limit(0)).count() == 0
