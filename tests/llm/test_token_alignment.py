import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from strata.llm import token_alignment as T

from .conftest import frame

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def byte_letters():
    """The published rule of byte-level letters."""
    own = list(range(ord("!"), ord("~") + 1)) + list(range(ord("¡"), ord("¬") + 1)) + list(range(ord("®"), ord("ÿ") + 1))
    chars = own[:]
    n = 0
    for x in range(256):
        if x not in own:
            own.append(x)
            chars.append(256 + n)
            n += 1
    return {chr(c): x for x, c in zip(own, chars)}


def plain(texts):
    """Whole texts through the libraries: (n_a, n_b, n_groups, n_links, n_best, count_sum, digest) of each."""
    a_lib, b_lib = libraries()
    letters = byte_letters()
    found = []
    for text in texts:
        body = (" " + text).encode() if text else b""
        ids_a = a_lib.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b_lib.encode(text) if text else []
        bytes_a = [bytes(letters[c] for c in a_lib.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(b_lib.id_to_piece(i)[3:5], 16)]) if b_lib.is_byte(i)
                   else b_lib.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if not text or b"".join(bytes_a) != body or b"".join(bytes_b) != body:
            found.append(None)
            continue
        ends_a, ends_b = (np.cumsum([len(x) for x in y]).tolist() for y in (bytes_a, bytes_b))
        cuts = sorted(set(ends_a) & set(ends_b))
        groups, link, i, j = [], [], 0, 0
        for c in cuts:
            x, y = ids_a[i:ends_a.index(c, i) + 1], ids_b[j:ends_b.index(c, j) + 1]
            groups.append(",".join(map(str, x)) + "|" + ",".join(map(str, y)))
            link.append((x[-1], y[-1]))
            i, j = i + len(x), j + len(y)
        found.append((len(ids_a), len(ids_b), groups, link))
    counts = Counter(pair for f in found if f for pair in f[3])
    top = Counter()
    for (_, y), n in counts.items():
        top[y] = max(top[y], n)
    return [(0, 0, 0, 0, 0, 0, "") if f is None else
            (f[0], f[1], len(f[2]), len(f[3]), sum(counts[p] == top[p[1]] for p in f[3]), sum(counts[p] for p in f[3]),
             hashlib.sha256(";".join(f[2]).encode()).hexdigest()) for f in found]


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def aligned(df, **sizes):
    return sorted(((r.doc_id, *(r[c] for c in COLUMNS)) for r in T.align(df, A, B, **sizes).collect()), key=str)


def odd_texts():
    rng = random.Random(4)
    pool = ["a", "Hello", "  ", "\n", " \n ", " ", "　 ", " ", "\x1c ", "᠎ ", "don't", "x'll", "12 345",
            "日本語", "テキスト", "İK", "naïve", "😀", "é", "<0x41>", "<|endoftext|>", "\x00", "...", "\t", "Ünï", "ß",
            "​ ", "﻿", "supercalifragilistic", " "]
    return ["".join(rng.choice(pool) + (" " if rng.random() < 0.5 else "") for _ in range(rng.randint(1, 25))) for _ in range(700)]


def test_equals_brute_force(spark, messy):
    """Whole documents against the libraries: nulls, copies, odd white space, U+2581, a long text, clashing names."""
    rows = messy + [(100 + k, t) for k, t in enumerate(odd_texts())]
    expected = sorted(((i, *f) for (i, _), f in zip(rows, plain([t for _, t in rows]))), key=str)
    assert sum(f[1] > 0 for f in expected) > 600
    assert aligned(frame(spark, rows)) == expected


@pytest.mark.parametrize("chunk,margin", [(64, 24), (257, 40), (1000, 1000)])
def test_ranges_compose(spark, messy, chunk, margin):
    """The same with texts cut into many ranges, whose fragments are reduced in several rounds."""
    rows = [(i, t) for i, t in messy if t is None or len(t) < 20000] + [(100 + k, t) for k, t in enumerate(odd_texts()[:200])]
    rows += [(999, "unbroken" * 400 + " end"), (998, "fine words " * 300 + "▁")]
    expected = sorted(((i, *f) for (i, _), f in zip(rows, plain([t for _, t in rows]))), key=str)
    assert aligned(frame(spark, rows), chunk=chunk, margin=margin) == expected


def test_empty(spark):
    assert aligned(frame(spark, [])) == []
    assert aligned(frame(spark, [(1, None), (None, "")])) == [(1, 0, 0, 0, 0, 0, 0, ""), (None, 0, 0, 0, 0, 0, 0, "")]


def test_ranges_cover_the_text():
    for text in odd_texts()[:100] + ["a" * 500, "b " * 300]:
        body = (" " + text).encode()
        found = T.ranges(body, 20, 16)
        assert [r[2] for r in found] == [0] + [r[3] for r in found[:-1]] and found[-1][3] == len(body)
        for first, last, lo, hi in found:
            assert first <= lo < hi <= last
            body[lo:hi].decode()
            body[first:last].decode()


def test_composition_is_associative():
    rng = random.Random(3)
    some = lambda: [rng.randrange(9) for _ in range(rng.randint(0, 3))]
    for _ in range(300):
        parts = [{"cut": k if rng.random() < 0.6 else None, "pa": some(), "pb": some(), "sa": [], "sb": []} for k in range(3)]
        for p in parts:
            if p["cut"] is not None:
                p |= {"sa": some(), "sb": some()}
        x, y, z = parts
        xy, s1 = T.compose(x, y)
        left, s2 = T.compose(xy, z)
        yz, s3 = T.compose(y, z)
        right, s4 = T.compose(x, yz)
        assert left == right
        assert [s for s in (s1, s2) if s] == sorted(s for s in (s3, s4) if s)
