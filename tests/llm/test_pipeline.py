import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as P
from strata.llm.packing import binary_pieces
from strata.session import scratch_scope

from .conftest import frame, words
from .test_near_dedup import plain_components, plain_plans, shuffles_with  # noqa: F401
from .test_repeats import plain_words
from .test_repetition import plain as plain_quality


def test_stages_in_order():
    assert [name for name, _ in P.STAGES] == ["quality rules", "near dedup", "substring dedup", "packing"]


def test_run_against_plain_stages(spark, tmp_path, messy):
    rows = [r for r in messy if r[0] not in (15, 16, 17, 22)] + [(40, words(13, 70) + " #*$%& " * 40), (41, words(2, 120))]
    frame(spark, rows).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = P.run(spark, str(tmp_path))

    kept = [(i, t) for i, t in rows if not plain_quality(t)[5] and i != 40]
    comp, _ = plain_components(kept)
    once = {i: t for i, t in kept if i is not None and comp[i] == i}
    left = [*once.items(), *((i, t) for i, t in kept if i is None)]
    texts = []
    for (i, text), (_, _, lost, rest) in zip(left, plain_words(left)):
        if not lost:
            texts.append((i, text))
        elif rest:
            texts.append((i, rest))
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for i, text in texts:
        ids = np.array(lib.encode(text, add_special_tokens=False).ids + [2], dtype="<u4")
        _, start, length = binary_pieces(np.array([len(ids)]))
        want += [(str(i), s, k, len(ids), zlib.crc32(ids[s:s + k].tobytes())) for s, k in zip(start.tolist(), length.tolist())]
    assert sorted((str(r.doc_id), r.start, r.length, r.doc_tokens, r.ids_crc32) for r in got.collect()) == sorted(want)


def test_texts_that_share_an_id_all_stay(spark):
    a, b = words(91, 80), words(92, 80)
    docs = frame(spark, [(7, a), (7, b), (7, a), (8, b + " end"), (None, a), (9, "")])
    got = P.near(spark, docs, "")
    assert sorted((str(r.doc_id), r.text) for r in got.collect()) == sorted([("7", a), ("7", b), ("None", a), ("9", "")])


def test_stages_keep_the_columns_and_survive_an_empty_table(spark, tmp_path):
    frame(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for k, (_, stage) in enumerate(P.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if k < len(P.STAGES) - 1:
            assert out.columns == P.COLUMNS
            out.write.parquet(f"{tmp_path}/{k}")
            docs = spark.read.parquet(f"{tmp_path}/{k}")
        assert out.count() == 0


def test_texts_without_near_copies_stay_where_they_are(spark, tmp_path, plain_plans):  # noqa: F811
    a, b, c = words(93, 80), words(94, 80), words(95, 80)
    rows = [(1, a), (1, a), (2, a + " end"), (3, b), (3, c), (4, b + " end"), (5, c), (None, c), (6, None), (6, None), (7, "")]
    rows += [(100 + i, words(1000 + i, 60)) for i in range(40)]
    frame(spark, rows).write.parquet(f"{tmp_path}/docs")
    found = P.near(spark, spark.read.parquet(f"{tmp_path}/docs"), "")
    moved = shuffles_with(found, "text")
    assert moved and all("BroadcastExchange" in x for x in moved)
    want = [("1", a), ("3", b), ("3", c), ("None", c), ("6", None), ("6", None), ("7", "")]
    want += [(str(i), t) for i, t in rows[11:]]
    assert sorted(((str(r.doc_id), r.text) for r in found.collect()), key=str) == sorted(want, key=str)


def test_near_writes_few_tables(spark):
    """Each file of a table is a risk of its own on an executor: it takes children of the JVM to write it."""
    text = words(3, 40)
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate((text, text + " more", words(4, 40)))],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    with scratch_scope() as ends:
        found = P.near(spark, docs, "")
    assert sorted(r.doc_id for r in found.collect()) == [0, 2]
    assert len(ends) <= 28


def test_packing_leaves_no_words_in_workers(spark, monkeypatch):
    seen = []
    plain = P.queries.packing.decompose
    monkeypatch.setattr(P.queries.packing, "decompose", lambda *a, **b: seen.append(b.get("keep_words", True)) or plain(*a, **b))
    assert P.pack(spark, frame(spark, [(1, "one two three")]), "").count() > 0
    assert seen == [False]
