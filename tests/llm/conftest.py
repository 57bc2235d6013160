import random

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, n_words long, kept string, ids string, "
          "start string, length string, digest string, block string, rows string, component_id string")


def words(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdeé", k=rng.randint(2, 7))) for _ in range(n))


def messy_texts() -> list[tuple[int | None, str | None]]:
    """Nulls, empty and blank texts, ties, repeated rows, copies, shared passages, odd characters, a long text."""
    passage = words(1, 60)
    base = words(2, 120).split()
    near = base[:50] + ["changed"] + base[51:]
    rows = [
        (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "one two three"), (6, "one two three"),
        (7, words(3, 80)), (8, words(3, 80)), (8, words(3, 80)),
        (9, f"{words(4, 20)} {passage} {words(5, 30)}"), (10, f"{words(6, 7)}\n{passage}\t{words(7, 9)}"),
        (11, f"{passage} {words(8, 5)} {passage}"),
        (12, " ".join(base)), (13, " ".join(near)), (14, " ".join(near + ["end"])),
        (15, "x " * 300), (16, "a" * 5000), (17, "same line here\n" * 40 + words(9, 60)),
        (18, "日本語 テキスト ▁▁ \x00   <|endoftext|> İK 😀 " * 4),
        (19, words(10, 60000)), (20, "Licensed under the Apache License, Version 2.0. " + words(11, 50)),
        (21, "ALL rights reserved, cc-by; General Public License all rights all rights reserved " + words(12, 40)),
        (22, words(13, 70) + " #*$%& " * 40), (None, words(14, 55)), (None, None), (None, words(14, 55)),
    ]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, t, None, "s", None, -1, "k", "i", "s", "l", "d", "b", "r", "c") for i, t in rows], SCHEMA)


@pytest.fixture(scope="session")
def messy():
    return messy_texts()


@pytest.fixture(scope="session")
def folder(spark, tmp_path_factory, messy):
    """A table folder with the messy documents, and one whose tables are empty."""
    root = tmp_path_factory.mktemp("llm")
    frame(spark, messy).repartition(4).write.parquet(f"{root}/messy/documents.parquet")
    frame(spark, []).write.parquet(f"{root}/empty/documents.parquet")
    page = "page_id long, url string, html string, host string, payload string, same string, record_type string"
    link = "<a href='http://bad.net/x'>a</a> <a HREF=\"//Good.example.net/en/1\">b</a> <a href=/local>c</a>"
    html = [(1, "http://a.com/x?y", "<p>" + "é" * 600), (2, "http://b.com", "<p>" + "é" * 600), (3, None, None),
            (4, "no scheme", ""), (5, "https://X.bad.NET/q#f", "z" * 999), (6, "https://x.bad.net/r", "z" * 999),
            (7, "http://good.example.net/en/1", link), (8, "http://www.mixed.example.com/de/1", link * 30),
            (9, "http://example.com/de/", link * 30), (9, "http://example.com/de/", link * 30),
            (10, "http://o.org/fr/#x", "\r\n\r\nWARC/1.1\r\n\r\n" * 200), (11, "http://c.com\r\nX: y", "w" * 1000),
            (None, "http://d.com/", "w" * 1000), (12, "http://e.com", "v" * 200000)]
    rows = [(i, u, h, "h", "p", "s", "t") for i, u, h in html]
    spark.createDataFrame(rows, page).repartition(3).write.parquet(f"{root}/messy/pages.parquet")
    spark.createDataFrame([], page).write.parquet(f"{root}/empty/pages.parquet")
    return str(root), html
