import random
import re

from strata.llm import license_scan as L
from strata.llm.queries import QUERIES


def plain(text):
    """(words, base places) by definition."""
    low = (text or "").translate({i: i + 32 for i in range(65, 91)})
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = [(i, label) for phrase, label in L.BASE.items() for k in [phrase.split()]
              for i in range(len(words)) if words[i:i + len(k)] == k]
    return words, sorted(places)


def test_every_substring_and_nothing_else_is_accepted():
    rng = random.Random(5)
    for _ in range(60):
        texts = [[rng.choice("abc") for _ in range(rng.randint(1, 9))] for _ in range(rng.randint(1, 5))]
        auto = L.Automaton(texts)
        inside = {tuple(t[i:j]) for t in texts for i in range(len(t)) for j in range(i, len(t) + 1)}
        for _ in range(80):
            probe = [rng.choice("abc") for _ in range(rng.randint(1, 6))]
            state = 0
            for w in probe:
                state = None if state is None else auto.next[state].get(auto.vocab.get(w.encode()))
            assert (state is not None) == (tuple(probe) in inside)


def test_query_against_plain_search(spark, folder, messy):
    got = QUERIES["op1_license_scan"](spark, f"{folder[0]}/messy").collect()
    assert len(got) == len(messy)
    want = []
    for i, text in messy:
        words, places = plain(text)
        want.append((i, len(words), len(places), min((p for p, _ in places), default=None),
                     max((p for p, _ in places), default=None), ",".join(sorted({x for _, x in places}))))
    key = lambda r: tuple(str(x) for x in r)
    assert sorted((tuple(r)[:6] for r in got), key=key) == sorted(want, key=key)
    assert all(0 <= r.score <= 1 and set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""} for r in got)
    by_id = {r.doc_id: r for r in got if r.doc_id}
    assert "apache-2.0" in by_id[20].labels and by_id[20].score > 0
    assert by_id[21].base_labels == "cc-by,gpl,reserved" and by_id[21].n_base == 4
    assert by_id[7].labels == "" and by_id[7].score == 0


def test_spans_chain_over_gaps_and_pieces(monkeypatch):
    scan = L.scanner()
    text = ("some words. Permission is hereby granted, free of charge, to any person (yes) obtaining a copy of this "
            "software and associated documentation files (the Software), to deal in the Software without restriction")
    n, _, spans = scan.scan(text.encode())
    assert [(s[2], round(s[3], 1)) for s in spans if scan.labels[s[2]] == "mit"]
    monkeypatch.setattr(L, "PIECE", 7)
    assert scan.scan(text.encode()) == (n, [], spans)


def test_disturbed_templates_are_found():
    """Words replaced in place, or a few of the template's own words put in again; runs stand in it more than once."""
    scan = L.scanner()
    rng = random.Random(8)
    tried = 0
    for label, texts in L.TEMPLATES.items():
        for text in texts:
            words = re.findall("[0-9a-z]+", text)
            for _ in range(150 if len(words) >= 12 else 0):
                own = list(words)
                for at in rng.sample(range(len(own)), rng.randint(1, 5)):
                    own[at] = "qqq"
                # runs of the seed or more that stand where they stood, linked over small gaps
                runs, at = [], 0
                while at < len(own):
                    to = at
                    while to < len(own) and own[to] != "qqq":
                        to += 1
                    if to - at >= scan.seed:
                        runs.append((at, to))
                    at = to + 1
                chained = all(b[0] - a[1] <= scan.gap for a, b in zip(runs, runs[1:]))
                if not chained or sum(b - a for a, b in runs) < scan.cover * len(own):
                    continue
                tried += 1
                if rng.random() < 0.3:
                    at, k = rng.randrange(len(words) - 5), rng.randrange(3)
                    own = words[at:at + 5] + ["zzz"] * k + own
                found = {scan.labels[s[2]] for s in scan.scan(" ".join(["lead", "in", *own, "rest"]).encode())[2]}
                assert label in found, " ".join(own)
    assert tried > 500


def test_a_template_twice_is_two_spans():
    scan = L.scanner()
    text = L.TEMPLATES["mit"][0]
    spans = [s for s in scan.scan(f"{text} some other words between them here now and more {text}".encode())[2] if scan.labels[s[2]] == "mit"]
    assert len(spans) >= 2 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]) if a[2] == b[2])


def test_empty_table_and_equal_names(spark, folder):
    assert QUERIES["op1_license_scan"](spark, f"{folder[0]}/empty").count() == 0
    df = spark.createDataFrame([(1, "cc by", "x", "y")], "doc_id long, text string, spans string, __text string")
    assert L.scan_licenses(df, ["doc_id", "spans"]).first().n_words == 2
    assert L.scan_licenses(df, ["doc_id", "__text"]).first()["__text"] == "y"
