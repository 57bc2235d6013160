import gzip
import hashlib
import os

import pytest

from strata.llm import warc as W
from strata.llm.queries import ORACLE, QUERIES

key = lambda r: tuple(str(x) for x in r)


def plain(pages):
    out = []
    raw = [(i, (h or "").encode()) for i, _, h in pages]
    for i, b in raw:
        keeper = max((j for j, c in raw if c == b and j is not None), default=None)
        again = len(b) >= 1000 and keeper is not None and i != keeper
        out.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response", keeper if again else None))
    return sorted(out, key=key)


def test_query(spark, folder):
    root, pages = folder
    got = QUERIES["op10_warc"](spark, f"{root}/messy").collect()
    assert sorted(map(tuple, got), key=key) == plain(pages)
    assert QUERIES["op10_warc"](spark, f"{root}/empty").count() == 0


def test_oracle(folder):
    import duckdb

    root, pages = folder
    pages = [p for p in pages if p[0] is not None]
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{root}/messy/pages.parquet/*.parquet' WHERE page_id IS NOT NULL")
    assert sorted(con.sql(ORACLE["op10_warc"]).fetchall(), key=key) == plain(pages)


@pytest.mark.parametrize("compress", ["true", "false"])
def test_round_trip_pushdown_and_partitions(spark, tmp_path, folder, compress):
    path = f"file://{tmp_path}/a"
    pages = spark.read.parquet(f"{folder[0]}/messy/pages.parquet")
    W.write_warc(W.page_records(pages), path, compress=compress, file_bytes="3000")
    read = W.read_warc(spark, path, partition_bytes="4000")
    assert read.rdd.getNumPartitions() > 1
    html = {i: (h or "").encode() for i, _, h in folder[1]}
    rows = read.collect()
    assert len(rows) == len(folder[1])
    for r in rows:
        assert r.payload is None if r.record_type == "revisit" else bytes(r.payload) == html[r.page_id]
    assert {r.target_uri for r in rows if r.page_id == 11} == {"http://c.com%0D%0AX: y"}
    some = read.filter("record_type = 'revisit' and page_id >= 1").select("page_id", "refers_to")
    assert sorted(map(tuple, some.collect())) == [(1, "urn:page:2"), (8, "urn:page:9")]
    assert {r.payload for r in W.read_warc(spark, path, payload="false").collect()} == {None}


def test_skipped_payloads_are_not_decoded(tmp_path, monkeypatch):
    rows = [{"record_id": f"urn:page:{i}", "record_type": "response", "target_uri": None, "payload_digest": "0",
             "page_id": i, "payload_length": 5000, "refers_to": None, "payload": os.urandom(5000)} for i in range(5)]
    for name, data in (("a.warc", b"".join(map(W.record, rows))), ("a.warc.gz", b"".join(W.gzip_member(W.record(r)) for r in rows)),
                       ("b.warc.gz", b"".join(gzip.compress(W.record(r)) for r in rows))):
        (tmp_path / name).write_bytes(data)
        reader = W.WarcReader({"path": str(tmp_path / name)})
        list(reader.pushFilters([W.D.In(("page_id",), (1, 3)), W.D.Not(W.D.EqualTo(("page_id",), 1))]))
        decoded = []
        monkeypatch.setattr(W, "_payload", lambda block, kind, keep=W._payload.__wrapped__ if hasattr(W._payload, "__wrapped__")
                            else W._payload: decoded.append(1) or keep(block, kind))
        found = [r for b in reader.read(W.Files([str(tmp_path / name)])) for r in b.to_pylist()]
        monkeypatch.undo()
        assert [r["page_id"] for r in found] == [1, 3] and len(decoded) == 2
        assert [r["payload"] for r in found] == [rows[1]["payload"], rows[3]["payload"]]


def test_members_are_gzip():
    assert gzip.decompress(W.gzip_member(b"abc" * 1000) + W.gzip_member(b"x")) == b"abc" * 1000 + b"x"


def test_cut_off_files_are_an_error(tmp_path):
    row = {"record_id": "urn:page:1", "record_type": "response", "target_uri": None, "payload_digest": "0", "page_id": 1,
           "payload_length": 9, "refers_to": None, "payload": os.urandom(9000)}
    (tmp_path / "a.warc.gz").write_bytes(W.gzip_member(W.record(row))[:6000])
    with pytest.raises(ValueError):
        list(W.WarcReader({"path": str(tmp_path / "a.warc.gz")}).read(W.Files([str(tmp_path / "a.warc.gz")])))
