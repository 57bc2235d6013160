import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from strata.llm import piece_bpe as B
from strata.llm.queries import QUERIES

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def lib():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_as_the_library(lib):
    rng = random.Random(3)
    texts = ["".join(rng.choices("aeénst \n▁\t.,'<|>日😀0x", k=rng.randint(0, 80))) for _ in range(1500)]
    texts += ["", None, " " * 70, "ab" * 3000, "-" * 9000, "▁" * 33, "\x00\x7f", "ｆ　\xa0"]
    ids, at = B.encode_texts(texts, PATH)
    back = B.load(PATH)[0].decode(ids.astype(np.int64), at)
    for i, text in enumerate(texts):
        want = lib.encode(text or "")
        assert ids[at[i]:at[i + 1]].tolist() == want
        assert back[i] == lib.decode(want)


def test_decoding_any_ids(lib):
    rng = random.Random(4)
    model = B.load(PATH)[0]
    for _ in range(1500):
        ids = [rng.choice([rng.randrange(3, 32000), rng.randrange(3, 259), rng.randrange(0, 3), 259])
               for _ in range(rng.randint(0, 9))]
        assert model.decode(np.array(ids, dtype=np.int64), np.array([0, len(ids)]))[0] == lib.decode(ids)


def test_query(spark, folder, messy, lib):
    got = sorted(tuple(map(str, r)) for r in QUERIES["op4_sentencepiece"](spark, f"{folder[0]}/messy").collect())
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for i, text in messy:
        ids = lib.encode(text or "")
        want.append((str(i), str(len(ids)), sha(",".join(map(str, ids))), sha(lib.decode(ids))))
    assert got == sorted(want)
    assert QUERIES["op4_sentencepiece"](spark, f"{folder[0]}/empty").count() == 0


def test_memo_starts_afresh_without_changing_results():
    table = B.WordTable(B.load(PATH)[0].encode_words, most=5)
    words = "▁a ▁bb ▁ccc ▁dddd ▁eeeee ▁ffffff ▁a ▁gg ▁hh".split()
    whole = B.WordTable(B.load(PATH)[0].encode_words).ids(words)[0].tolist()
    assert sum((table.ids([w])[0].tolist() for w in words), []) == whole
