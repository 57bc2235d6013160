import collections
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from strata.llm import packing as K
from strata.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_binary_pieces():
    n = np.array([1, 2, 3, 4095, 4096, 4097, 12289])
    doc, start, length = K.binary_pieces(n)
    for d, size in enumerate(n):
        own = [(s, k) for x, s, k in zip(doc, start, length) if x == d]
        assert own[0][0] == 0 and all(a + k == b for (a, k), (b, _) in zip(own, own[1:])) and sum(k for _, k in own) == size
        assert all(k & (k - 1) == 0 and k <= 4096 for _, k in own)


def test_tokens_as_the_library():
    lib = Tokenizer.from_file(PATH)
    texts = ["", None, "It's DON'T, I'M.", "foo,.-bar, (baz).", "<|endoftext|>, <|STARTOFTEXT|>. x<|startoftext|>y.",
             "x\x1cy\x85z\xa0w", "a ́b Σας", "12,3. É, é.", "日本。 text;", "a" * 3000 + ".", "...", "a\r\nb\tc"]
    ids, at = K.tokenize(texts, PATH)
    for i, text in enumerate(texts):
        assert ids[at[i]:at[i + 1]].tolist() == lib.encode(text or "", add_special_tokens=False).ids + [2]


def test_query(spark, folder, messy):
    lib = Tokenizer.from_file(PATH)
    got = QUERIES["op5_packing"](spark, f"{folder[0]}/messy").collect()
    want = collections.Counter()
    for i, text in messy:
        ids = lib.encode(text or "", add_special_tokens=False).ids + [2]
        doc, start, length = K.binary_pieces(np.array([len(ids)]))
        for s, k in zip(start.tolist(), length.tolist()):
            want[i, s, k, zlib.crc32(np.array(ids[s:s + k], dtype="<u4").tobytes()), len(ids)] += 1
    assert collections.Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == want
    assert len({r.sequence_id for r in got}) == len(got) and all(r.offset == 0 for r in got)
    by_length = [r.length for r in sorted(got, key=lambda r: r.sequence_id)]
    assert by_length == sorted(by_length)                     # equal lengths are numbered together
    assert QUERIES["op5_packing"](spark, f"{folder[0]}/empty").count() == 0


def test_every_letter_before_each_stop():
    """Letters whose normalised form ends in a mark are not parted from a stop."""
    import unicodedata

    lib = Tokenizer.from_file(PATH)
    letters = [chr(c) for c in range(33, 0x110000) if not 0xD800 <= c < 0xE000
               and unicodedata.category(chr(c))[0] in "LMN"]
    for stop in K.STOPS:
        chunks = [f"a{c}{stop}" for c in letters if c.isprintable()]
        for at in range(0, len(chunks), 20000):
            part = chunks[at:at + 20000]
            found, size = K.load(PATH).ids(part)
            want = [e.ids for e in lib.encode_batch_fast(part, add_special_tokens=False)]
            assert size.tolist() == [len(x) for x in want]
            assert found.tolist() == [i for x in want for i in x]


def test_clashing_names(spark):
    df = spark.createDataFrame([(1, "one two", "x", "y")], "doc_id long, text string, __text string, _text string")
    assert K.decompose(df, PATH).drop("ids").collect()[0][:3] == (1, "x", "y")


def test_workers_keep_no_words_after_a_task(spark):
    """Python workers are used again; what a task's tables held is free for the next stage."""
    rows = spark.range(400).selectExpr("id", "concat_ws(' ', 'word', hex(id * 7919), hex(id * 104729)) as text").repartition(8)
    assert K.decompose(rows, PATH, keep_words=False).count() > 400

    def held(batches):
        import pyarrow as pa

        for _ in batches:
            pass
        tables = [t for pair in K._tables.values() for t in pair]
        yield pa.RecordBatch.from_pydict({"tables": [len(tables)], "words": [sum(t.n for t in tables)]})

    found = rows.mapInArrow(held, "tables long, words long").groupBy().sum("tables", "words").first()
    assert found[0] > 0 and found[1] == 0


def test_forgotten_words_come_back():
    lib = Tokenizer.from_file(PATH)
    texts = ["one, two. three", "one two; four"]
    K.tokenize(texts[:1], PATH)
    K.forget(PATH)
    ids, at = K.tokenize(texts, PATH)
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [lib.encode(t, add_special_tokens=False).ids + [2] for t in texts]
