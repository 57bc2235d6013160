import re
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from strata.llm import filter_audit

from .conftest import frame

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain(rows, good, toxic):
    """The contract, row by row: {(part, order, step): counts}."""
    fails = []
    for i, text, part in rows:
        text = text or ""
        w = WORD.findall(text)
        own = set()
        if len(w) < 50:
            own.add("A")
        if 100 * len(set(w)) < 65 * len(w):
            own.add("B")
        if 100 * len(re.findall("[A-Z]", text)) > 5 * len(text):
            own.add("C")
        if re.search("[#$%&*|]", text):
            own.add("D")
        if i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in rows):
            own.add("E")
        fails.append((i, part or "", own))
    out = {}
    for part in {p for _, p, _ in fails}:
        own = [(i, f) for i, p, f in fails if p == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            for step, x in enumerate(order, 1):
                before = set(order[:step - 1])
                removed = [i for i, f in own if x in f and not f & before]
                shapley[x] += len(removed)
                out[part, "".join(order), step] = [
                    sum(not f & set(order[:step]) for _, f in own), len(removed),
                    sum(x in f and bool(f & before) for _, f in own), sum(f == {x} for _, f in own),
                    sum(i in good for i in removed), sum(i in toxic for i in removed)]
        for (p, order, step), counts in out.items():
            if p == part:
                counts.append(shapley[order[step - 1]])
    return out


COLUMNS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def audited(df, good, toxic):
    spark = df.sparkSession
    ids = lambda x: spark.createDataFrame([(i,) for i in x], "doc_id long")
    found = filter_audit.audit(df, filter_audit.base_filters(), {"good": ids(good), "toxic": ids(toxic)})
    return {(r.part, r.filter_order, r.step): [r[c] for c in COLUMNS] for r in found.collect()}


def test_equals_brute_force(spark, messy):
    """Nulls in every column, copies, repeated rows, a long text, columns with clashing names."""
    rows = [(i, t, [None, "", "a", "b"][n % 4]) for n, (i, t) in enumerate(messy + messy[:9])]
    rows += [(100 + n, "the same short text", "hot") for n in range(300)]
    df = spark.createDataFrame([(i, t, p, 1, "x", 2) for i, t, p in rows],
                               "doc_id long, text string, source string, row int, failed string, prefix int")
    good, toxic = [1, 8, 8, 20, 101, None, 999], [9, 101, 102]
    assert audited(df, good, toxic) == plain(rows, set(good) - {None}, set(toxic))


def test_empty_tables(spark):
    assert audited(frame(spark, []), [], []) == {}
    alone = audited(frame(spark, [(1, " ".join(f"w{n}" for n in range(60)))]), [], [])
    assert len(alone) == 600 and all(v == [1, 0, 0, 0, 0, 0, 0] for v in alone.values())


def test_other_filters(spark):
    """Any number of filters and names; a filter nothing fails."""
    df = frame(spark, [(n, "x" * n) for n in range(10)])
    found = filter_audit.audit(df, {"long ": F.length("text") > 7, "none ": F.lit(False), "odd ": F.col("doc_id") % 2 == 1}, {})
    rows = {(r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.shapley) for r in found.collect()}
    assert len(rows) == 18
    assert rows["long none odd ", 3] == (4, 4, 1, 4, 27)
    assert rows["odd long none ", 2] == (4, 1, 1, 1, 9)
    with pytest.raises(ValueError):
        filter_audit.audit(df, {"a": "unknown"}, {})
