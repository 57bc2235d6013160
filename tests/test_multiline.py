"""Multi-line CSV by quote parity (S4): equal to Spark's single-task reader, however the file is cut."""

import random

import pytest

from strata.sources.files import read_csv
from strata.sources.multiline import range_parity, read_multiline_csv, records, _lines


def field(rng) -> str:
    text = "".join(rng.choice(["a", "b c", "\n", "\r\n", '"', ",", "é", "", "\n\n", " ", '""', "x" * 9]) for _ in range(rng.randint(0, 9)))
    return '"' + text.replace('"', '""') + '"' if any(c in text for c in '",\r\n') or rng.random() < 0.2 else text


def write(path, rows, end="\n", header="k,v,w"):
    with open(path, "w", newline="", encoding="utf-8") as f:
        f.write(end.join([header, *rows]) + end)


@pytest.fixture()
def small_ranges(spark):
    """Byte ranges of a few hundred bytes."""
    kept = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "301")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for c, v in kept.items():
        spark.conf.set(c, v)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


SCHEMA = "k int, v string, w string"


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_equals_single_task_reader(spark, tmp_path, small_ranges, end):
    rng = random.Random(7)
    for n in range(3):
        write(tmp_path / f"f{n}.csv", [f"{i},{field(rng)},{field(rng)}" for i in range(120)], end)
    write(tmp_path / "G.CSV", ['1,"' + "line\n" * 300 + '",over many ranges', "2,plain,end"], end)
    write(tmp_path / "blank.csv", ["1,a,b", "", '2,"x\n\ny",', "", "3"], end)
    write(tmp_path / "empty.csv", [], end)
    path = str(tmp_path)
    lines = _lines(spark, path, "*.[cC][sS][vV]", True)
    assert range_parity(lines).count() > 30 and lines.rdd.getNumPartitions() > 30
    expected = rows_of(read_csv(spark, path, SCHEMA, multiline=True))
    assert len(expected) == 365
    assert rows_of(read_multiline_csv(spark, path, SCHEMA)) == expected
    assert rows_of(read_multiline_csv(spark, path, SCHEMA, max_broadcast_bytes=0)) == expected
    text = rows_of(read_csv(spark, path, multiline=True))
    assert rows_of(read_multiline_csv(spark, path)) == text


def test_single_file_header_and_sources(spark, tmp_path):
    write(tmp_path / "a.csv", ['1,"two\nlines","say ""hi"""', "2,,x"], header='"k","the\nvalue",w')
    df = read_multiline_csv(spark, str(tmp_path / "a.csv"), source_col="src", glob=None, recursive=False)
    assert df.columns == ["k", "the\nvalue", "w", "src"]
    assert [tuple(r)[:3] for r in df.orderBy("k").collect()] == [("1", "two\nlines", 'say "hi"'), ("2", None, "x")]
    none = read_multiline_csv(spark, str(tmp_path / "a.csv"), SCHEMA, header=False, glob=None)
    assert none.count() == 3
    assert records(spark, str(tmp_path / "a.csv")).filter("first").count() == 1


def test_unbalanced_quote_keeps_the_text(spark, tmp_path, small_ranges):
    write(tmp_path / "u.csv", ["1,a,b", '2,"never closed,c'] + ["3,d,e"] * 200)
    found = records(spark, str(tmp_path)).filter("not first").collect()
    assert sorted(len(r.record) for r in found)[0] == 5 and len(found) == 2


def test_no_shuffle_of_whole_records(spark, tmp_path):
    """Records are parsed in the tasks that read them; what is shuffled has passed the filter for pieces."""
    write(tmp_path / "a.csv", ["1,a,b"])
    plan = read_multiline_csv(spark, str(tmp_path), SCHEMA)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 2 and plan.count("Union") == 1
