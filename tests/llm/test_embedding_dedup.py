import math

import numpy as np
import pytest

from strata.llm import embedding_dedup as E

SCHEMA = "vec_id long, embedding array<float>, label int, key string, node int, n string, keys int"


def family(rng, dim, n, spread):
    centre = rng.standard_normal(dim)
    return [(centre + spread * rng.standard_normal(dim) * np.linalg.norm(centre) / math.sqrt(dim)).tolist() for _ in range(n)]


def plain(rows, threshold=0.93):
    ok = [r[1] is not None and r[2] is not None and len(r[1]) and all(x is not None and math.isfinite(x) for x in r[1])
          and any(r[1]) for r in rows]
    vectors = [np.array(r[1], dtype=np.float32).astype(float) if o else None for r, o in zip(rows, ok)]
    links = [[] for _ in rows]
    for i in range(len(rows)):
        for j in range(i):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(vectors[i]) == len(vectors[j]):
                a, b = vectors[i], vectors[j]
                if a @ b / math.sqrt(a @ a) / math.sqrt(b @ b) >= threshold or (a == b).all():
                    links[i].append(j), links[j].append(i)
    out, seen = [None] * len(rows), set()
    for i in range(len(rows)):
        if i not in seen:
            stack, group = [i], {i}
            while stack:
                for j in links[stack.pop()]:
                    if j not in group:
                        group.add(j), stack.append(j)
            seen |= group
            ids = [rows[j][0] for j in group if rows[j][0] is not None]
            for j in group:
                out[j] = (rows[j][0], len(links[j]), min(ids) if ids else None)
    return sorted(out, key=str)


def found(spark, rows, **sizes):
    df = spark.createDataFrame([(*r, "k", 1, "n", 2) for r in rows], SCHEMA).repartition(3)
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in E.link_vectors(df, **sizes).collect()), key=str)


def messy():
    rng = np.random.default_rng(5)
    vectors = [v for n in (1, 2, 5, 40) for v in family(rng, 24, n, 0.22)] + family(rng, 24, 90, 0.3) \
        + [rng.standard_normal(24).tolist() for _ in range(60)]
    rows = [(i, np.float32(v).tolist(), i % 3 if i < 60 else 0) for i, v in enumerate(vectors)]
    odd = [None, [], [0.0] * 24, [float("nan")] * 24, [1.0, None, 2.0], [float("inf")] * 24]
    rows += [(1000 + k, v, 0) for k, v in enumerate(odd)]
    rows += [(2000, rows[3][1], None), (None, rows[3][1], rows[3][2]), (3, *rows[3][1:]), (2001, rows[3][1], 2),
             (2002, [1.0] * 5, 0), (2003, [2.0] * 5, 0), (2004, [-1.0], 0), (2005, [3.0], 0), (2006, [1e30] * 5, 0),
             (2007, [1e-30] * 5, 0), (None, [7.0, 1.0], 9)]
    return rows + [(3000 + k, rows[5][1], rows[5][2]) for k in range(50)]


def test_equals_brute_force(spark):
    """Nulls, zeros, non-finite components, copies, repeated rows, clashing names, several lengths."""
    rows = messy()
    assert found(spark, rows) == plain(rows)


def test_parts_and_bands(spark):
    """Buckets cut into parts that meet in pairs, and labels parted by bands."""
    rows = messy()
    assert found(spark, rows, block=16) == plain(rows)
    assert found(spark, rows, whole=32, block=16) == plain(rows)


def test_empty(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, None, 1)]) == [(1, 0, 1)]


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(1)
    for dim in (16, 64, 200):
        base = E.units(rng.standard_normal((400, dim)))
        near = E.units(base + 0.38 / math.sqrt(dim) * rng.standard_normal((400, dim)))
        cosine = np.einsum("ij,ij->i", base, near)
        signs, factor, error = E.encode(near)
        guess = np.array([E.estimates(base[i:i + 1], signs[i:i + 1], factor[i:i + 1])[0, 0] for i in range(400)])
        off = (guess - cosine) / np.sqrt(1 - cosine ** 2)
        assert (np.abs(off) <= error).all()
        assert abs(off.mean()) < 4 * off.std() / 20
        assert off.std() * 4 < error.mean() < off.std() * 9
        assert (guess[cosine >= 0.93] >= E.lower_limit(0.93, error)[cosine >= 0.93]).all()
    far = E.estimates(base, *E.encode(E.units(rng.standard_normal((400, 200))))[:2])
    assert (far < E.lower_limit(0.93, error)).mean() > 0.999           # what needs no recomputation


@pytest.mark.parametrize("members", [20_000, 10**6, 10**9])
def test_bands_miss_less_than_stated(members):
    bits, count = E.bands(members, 0.93)
    share = (1 - math.acos(0.93) / math.pi) ** bits
    assert (1 - share) ** count <= E.MISS and members / 2 ** bits <= E.BLOCK
