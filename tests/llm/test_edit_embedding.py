import hashlib
import random

import numpy as np

from strata.llm import edit_embedding as X
from strata.llm.queries import QUERIES

from .conftest import words


def mark(*texts):
    return X.embed([X.classes(t) for t in texts])


def test_likeness_follows_edits():
    text = words(21, 400)
    cut = text[:900] + text[910:]
    half = text[:len(text) // 2] + words(22, 400)[:len(text) // 2]
    a, same, few, some, other = mark(text, text, cut, half, words(23, 400))
    like = lambda b: float(X.likeness(a[None], b[None])[0])
    assert like(same) == 1 and like(few) > 0.75 and 0.35 < like(some) < 0.75 and like(other) < 0.3


def test_company_does_not_change_a_walk():
    texts = [words(s, n) for s, n in ((1, 5), (2, 900), (3, 60), (4, 1))] + [""]
    together = mark(*texts)
    assert all((mark(t)[0] == together[i]).all() for i, t in enumerate(texts))
    assert not together[-1].any()


def test_query(spark, folder, messy):
    got = QUERIES["op2_edit_embedding"](spark, f"{folder[0]}/messy").collect()
    assert len(got) == len(messy)
    # ids that repeat stand in the order of a text hash, so look at those that don't
    order = sorted(((i, t or "") for i, t in messy if i is not None), key=lambda r: -r[0])
    by_id = {r.doc_id: r for r in got}
    for (i, text), (j, after) in zip(order, order[1:]):
        if 8 in (i, j):
            continue
        half = len(text) // 2
        changed = text[:len(text) - half] + after[:half]
        row = by_id[i]
        assert row.n_chars == len(text) and row.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        a, b, c = mark(text, changed, after)
        assert [row.fingerprint, row.edited_fingerprint] == X.as_text(np.stack([a, b]))
        assert abs(row.near_edited - X.likeness(a[None], b[None])[0]) < 1e-12
        assert abs(row.near_next - X.likeness(a[None], c[None])[0]) < 1e-12
    marks = {}
    for (i, text), row in ((x, by_id[x[0]]) for x in messy if x[0]):
        assert marks.setdefault(text or "", row.fingerprint) == row.fingerprint
    assert by_id[14].near_id == 12 and by_id[13].near_id == 12 and by_id[7].near_id == 7


def test_first_follows_last(spark):
    df = spark.createDataFrame([(5, "five"), (9, "nine nine"), (7, "")], "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.edited_sha256 for r in X.compare_neighbours(df).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got == {9: sha("nine "), 7: sha(""), 5: sha("fi" + "ni")}


def test_empty_table(spark, folder):
    assert QUERIES["op2_edit_embedding"](spark, f"{folder[0]}/empty").count() == 0


def family(seed: int, n: int, edits: int) -> list[str]:
    """A text and copies of earlier copies, each with some words changed."""
    rng = random.Random(seed)
    texts = [words(seed, 300)]
    while len(texts) < n:
        own = rng.choice(texts).split()
        for k in range(edits):
            own[rng.randrange(len(own))] = f"changed{k}"
        texts.append(" ".join(own))
    return texts


def plain_near(ids, marks, near, banded=True):
    """The smallest id of each row's component, by all pairs that are alike (and share a band)."""
    least = {i: i for i in ids}

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    pairs = []
    for x in range(len(ids)):
        same = marks == marks[x]
        shared = np.any([same[:, places].all(axis=1) for places in X.band_places()], axis=0) if banded else True
        for y in np.flatnonzero((X.likeness(marks, marks[x][None]) >= near) & shared).tolist():
            pairs.append((x, y))
            a, b = sorted((root(ids[x]), root(ids[y])))
            least[b] = a
    return {i: root(i) for i in ids}, pairs


def test_near_documents_against_all_pairs(spark, monkeypatch):
    """Families whose members are near to some of the others: no link hangs on which member leads a band."""
    texts = [t for seed in range(6) for t in family(100 + seed, 25, 3 + seed)]
    ids = random.Random(5).sample(range(1000), len(texts))
    marks = mark(*texts)
    df = spark.createDataFrame(list(zip(ids, X.as_text(marks))), "doc_id long, fingerprint string").repartition(3)
    want, _ = plain_near(ids, marks, 0.8)
    by_mark = dict(zip(X.as_text(marks), (want[i] for i in ids)))
    assert len(set(want.values())) > 6                      # some members are near to none
    for stars, block in ((X.STARS, X.BLOCK_MEMBERS), (1, 5)):
        monkeypatch.setattr(X, "STARS", stars)
        monkeypatch.setattr(X, "BLOCK_MEMBERS", block)
        got = {r.fingerprint: r.near_id for r in X.near_documents(df).collect()}
        assert got == by_mark
    # what bands miss: pairs that are alike but in different components
    _, pairs = plain_near(ids, marks, 0.8, banded=False)
    lost = sum(want[ids[x]] != want[ids[y]] for x, y in pairs)
    assert lost <= 0.01 * len(pairs)


def test_a_member_that_the_leader_of_its_bands_is_not_near_to(spark):
    """B is near to A and to C, but A is not to C; the smallest id is A's or another's."""
    a = np.arange(128, dtype=np.uint8) % 16
    b, c = a.copy(), a.copy()
    b[:20] = (b[:20] + 1) % 16
    c[:40] = (c[:40] + 1) % 16
    ab, bc, ac = (float(X.likeness(x[None], y[None])[0]) for x, y in ((a, b), (b, c), (a, c)))
    assert ab >= 0.8 and bc >= 0.8 and ac < 0.8
    hexes = X.as_text(np.stack([a, b, c]))
    df = spark.createDataFrame([*zip((2, 3, 1), hexes), (None, hexes[2]), (None, "0" * 128)],
                               "doc_id long, fingerprint string")
    got = {r.fingerprint: r.near_id for r in X.near_documents(df).collect()}
    assert got == {**dict.fromkeys(hexes, 1), "0" * 128: None}
