"""WARC archives as a Python data source (format ``strata_warc``).

Writing: each task writes its rows as records into files of its own, under
names that no other attempt uses; the commit lists the files of the attempts
that count in ``_files``, and only those are read.  With ``compress`` (the
default) each record is a gzip member whose extra field ``LN`` holds the
member's length, so that a reader can step over it.

Reading: files are planned into partitions of about ``partition_bytes`` (a
file is never split, as records can only be found from its start).  The header
of each record is parsed first; predicates on header columns are pushed down,
and a record that fails one -- or any record when ``payload`` is ``false`` --
is stepped over without decoding its payload: by a seek in plain files, by the
member's length in compressed ones (members without it are inflated and
dropped).  Archives written elsewhere are read, too.

Results: a null payload is written as an empty one; a null url or page id
leaves its header out and reads as null; an empty folder reads as no rows.
"""

from __future__ import annotations

import json
import posixpath
import struct
import uuid
import zlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import datasource as D

from strata.llm import salted
from strata.session import scratch_path

FORMAT = "strata_warc"
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
FILE_BYTES = 256 << 20
PARTITION_BYTES = 64 << 20
BATCH_BYTES = 4 << 20

# What a row of the source is; record_id to http_header come from headers, payload from the block.
SCHEMA = ("record_id string, record_type string, page_id long, target_uri string, payload_digest string, "
          "payload_length long, refers_to string, payload binary")
_FIELDS = ["record_id", "record_type", "page_id", "target_uri", "payload_digest", "payload_length", "refers_to"]
_ARROW = pa.schema([
    ("record_id", pa.string()), ("record_type", pa.string()), ("page_id", pa.int64()), ("target_uri", pa.string()),
    ("payload_digest", pa.string()), ("payload_length", pa.int64()), ("refers_to", pa.string()),
    ("payload", pa.binary())])

# Field names and the profile of the format's standard.
_HEADERS = {"warc-record-id": "record_id", "warc-type": "record_type", "warc-target-uri": "target_uri",
            "warc-payload-digest": "payload_digest", "warc-refers-to": "refers_to",
            "page-id": "page_id", "payload-length": "payload_length"}
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "1970-01-01T00:00:00Z"


def file_system(path: str):
    """(pyarrow file system, path in it) of a folder."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    if path.startswith("/"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


# ------------------------------------------------------------------ records

def _line(text: str) -> str:
    """A header value on one line."""
    return text.replace("\r", "%0D").replace("\n", "%0A")


def record(row: dict) -> bytes:
    """One record's bytes."""
    payload = row["payload"] or b""
    fields = [("WARC-Type", row["record_type"]), ("WARC-Record-ID", f"<{row['record_id']}>"), ("WARC-Date", _DATE)]
    if row["target_uri"] is not None:
        fields.append(("WARC-Target-URI", _line(row["target_uri"])))
    fields.append(("WARC-Payload-Digest", f"sha1:{row['payload_digest']}"))
    if row["page_id"] is not None:
        fields.append(("Page-Id", str(row["page_id"])))
    fields.append(("Payload-Length", str(row["payload_length"])))
    if row["record_type"] == "revisit":
        fields += [("WARC-Refers-To", f"<{row['refers_to']}>"), ("WARC-Profile", _REVISIT)]
        block = b"HTTP/1.1 200 OK\r\n\r\n"
    else:
        block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
                 % len(payload)) + payload
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    """A gzip member whose extra field LN is its own length."""
    packer = zlib.compressobj(1, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    extra = b"LN" + struct.pack("<HQ", 8, 12 + 12 + len(body) + 8)
    head = b"\x1f\x8b\x08\x04" + bytes(4) + b"\x04\xff" + struct.pack("<H", len(extra)) + extra
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def parse_header(head: bytes) -> dict:
    """The columns of a record's header, with ``content_length``."""
    out: dict = dict.fromkeys(_FIELDS)
    out["content_length"] = 0
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        name, value = name.strip().lower().decode("latin-1"), value.strip().decode("utf-8", "replace")
        if name == "content-length":
            out["content_length"] = int(value)
        elif name in _HEADERS:
            out[_HEADERS[name]] = value
    for name in ("record_id", "refers_to"):
        out[name] = out[name] and out[name].strip("<>")
    if out["payload_digest"]:
        out["payload_digest"] = out["payload_digest"].rpartition(":")[2]
    for name in ("page_id", "payload_length"):
        out[name] = None if out[name] is None else int(out[name])
    return out


def _payload(block: bytes, kind: str | None) -> bytes | None:
    if kind == "revisit":
        return None
    if block.startswith(b"HTTP/"):
        return block.partition(b"\r\n\r\n")[2]
    return block


class PlainRecords:
    """Records of an uncompressed file."""

    def __init__(self, file):
        self.file = file

    def __iter__(self):
        """(header, function that decodes the payload); what isn't decoded is stepped over."""
        at, size = 0, self.file.size()
        while at < size:
            self.file.seek(at)
            head = b""
            while (end := head.find(b"\r\n\r\n")) < 0:
                more = self.file.read(4096)
                if not more:
                    if head.strip():
                        raise ValueError("a record's header is cut off")
                    return
                head += more
            header = parse_header(head[:end])
            body = at + end + 4

            def decode(body=body, header=header):
                self.file.seek(body)
                return _payload(self.file.read(header["content_length"]), header["record_type"])

            yield header, decode
            at = body + header["content_length"] + 4


class GzipRecords:
    """Records of a file of gzip members, one each."""

    def __init__(self, file):
        self.file = file

    def __iter__(self):
        at, size = 0, self.file.size()
        while at < size:
            self.file.seek(at)
            raw = self.file.read(4096)
            known = None
            if len(raw) >= 24 and raw[3] & 4 and raw[12:14] == b"LN":
                known = struct.unpack("<Q", raw[16:24])[0]
            unpack = zlib.decompressobj(31)
            head, used = unpack.decompress(raw, 1 << 16), len(raw)
            while (end := head.find(b"\r\n\r\n")) < 0:
                raw = unpack.unconsumed_tail or self.file.read(4096)
                if not raw or unpack.eof:
                    raise ValueError("a record's header is cut off")
                used += 0 if unpack.unconsumed_tail else len(raw)
                head += unpack.decompress(raw, 1 << 16)
            header = parse_header(head[:end])
            state = [unpack, head[end + 4:], at + used]

            def rest(keep: bool, state=state):
                """The member's remaining bytes; afterwards state[2] is where the next member begins."""
                unpack, have, at = state
                out = [have]
                while not unpack.eof:
                    raw = unpack.unconsumed_tail
                    if not raw:
                        self.file.seek(at)
                        raw = self.file.read(1 << 18)
                        at += len(raw)
                        if not raw:
                            raise ValueError("a record is cut off")
                    piece = unpack.decompress(raw, 1 << 22)
                    if keep:
                        out.append(piece)
                state[0], state[2] = unpack, at - len(unpack.unused_data)
                return b"".join(out)

            def decode(header=header, rest=rest):
                return _payload(rest(True)[:header["content_length"]], header["record_type"])

            yield header, decode
            if known:
                at += known
            else:
                if not state[0].eof:
                    rest(False)
                at = state[2] if state[0].eof and state[2] > at else size


# ------------------------------------------------------------------ the data source

@dataclass
class Files(D.InputPartition):
    paths: list


@dataclass
class Written(D.WriterCommitMessage):
    files: list


class WarcSource(D.DataSource):
    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options)


class WarcReader(D.DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.payload = options.get("payload", "true").lower() != "false"
        self.partition_bytes = int(options.get("partition_bytes", PARTITION_BYTES))
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters):
        """Takes comparisons of one header column with values; the others stay with Spark."""
        kinds = {D.EqualTo: "=", D.In: "in", D.IsNotNull: "set", D.StringStartsWith: "starts",
                 D.GreaterThan: ">", D.GreaterThanOrEqual: ">=", D.LessThan: "<", D.LessThanOrEqual: "<="}
        for f in filters:
            kind = kinds.get(type(f))
            if kind and len(f.attribute) == 1 and f.attribute[0] in _FIELDS:
                self.tests.append((kind, f.attribute[0], getattr(f, "value", None)))
            else:
                yield f

    def partitions(self):
        from pyarrow import fs

        system, folder = file_system(self.path)
        if system.get_file_info(folder).type == fs.FileType.File:
            return [Files([folder])]
        listed = posixpath.join(folder, "_files")
        if system.get_file_info(listed).type == fs.FileType.File:
            with system.open_input_stream(listed) as f:
                files = [(posixpath.join(folder, n), s) for n, s in json.loads(f.read())]
        else:
            files = [(i.path, i.size) for i in system.get_file_info(fs.FileSelector(folder, allow_not_found=True))
                     if i.path.endswith((".warc", ".warc.gz"))]
        plan, own, total = [], [], 0
        for path, size in sorted(files):
            if own and total + size > self.partition_bytes:
                plan.append(Files(own))
                own, total = [], 0
            own.append(path)
            total += size
        if own:
            plan.append(Files(own))
        return plan or [Files([])]

    def wanted(self, header: dict) -> bool:
        for kind, name, value in self.tests:
            have = header[name]
            if have is None:
                return False
            if not {"=": lambda: have == value, "in": lambda: have in value, "set": lambda: True,
                    "starts": lambda: have.startswith(value), ">": lambda: have > value,
                    ">=": lambda: have >= value, "<": lambda: have < value, "<=": lambda: have <= value}[kind]():
                return False
        return True

    def read(self, partition):
        system, _ = file_system(self.path)
        rows: dict[str, list] = {f.name: [] for f in _ARROW}
        size = 0
        for path in partition.paths:
            with system.open_input_file(path) as file:
                for header, decode in (GzipRecords if path.endswith(".gz") else PlainRecords)(file):
                    if not self.wanted(header):
                        continue
                    for name in _FIELDS:
                        rows[name].append(header[name])
                    payload = decode() if self.payload else None
                    rows["payload"].append(payload)
                    size += 256 + len(payload or b"")
                    if size > BATCH_BYTES:
                        yield pa.RecordBatch.from_pydict(rows, schema=_ARROW)
                        rows, size = {f.name: [] for f in _ARROW}, 0
        if rows["payload"]:
            yield pa.RecordBatch.from_pydict(rows, schema=_ARROW)


class WarcWriter(D.DataSourceArrowWriter):
    def __init__(self, options):
        self.path = options["path"]
        self.compress = options.get("compress", "true").lower() != "false"
        self.file_bytes = int(options.get("file_bytes", FILE_BYTES))

    def write(self, iterator):
        system, folder = file_system(self.path)
        system.create_dir(folder, recursive=True)
        files: list[tuple[str, int]] = []
        out = name = None
        size = 0
        try:
            for batch in iterator:
                for at in range(0, batch.num_rows, 64):
                    for row in batch.slice(at, 64).to_pylist():
                        if out is None:
                            name = f"{uuid.uuid4().hex}.warc" + ".gz" * self.compress
                            out, size = system.open_output_stream(posixpath.join(folder, name), compression=None), 0
                        data = record(row)
                        data = gzip_member(data) if self.compress else data
                        out.write(data)
                        size += len(data)
                        if size >= self.file_bytes:
                            out.close()
                            files.append((name, size))
                            out = None
        finally:
            if out is not None:
                out.close()
                files.append((name, size))
        return Written(files)

    def commit(self, messages):
        system, folder = file_system(self.path)
        system.create_dir(folder, recursive=True)
        files = [f for m in messages if m is not None for f in m.files]
        with system.open_output_stream(posixpath.join(folder, "_files")) as f:
            f.write(json.dumps(sorted(files)).encode())

    def abort(self, messages):
        system, folder = file_system(self.path)
        for m in messages:
            for name, _ in m.files if m is not None else ():
                system.delete_file(posixpath.join(folder, name))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcSource)
    spark.conf.set(PUSHDOWN, "true")


# ------------------------------------------------------------------ pages to archives and back

LEAST_SHARED = 1000


def page_records(pages: DataFrame) -> DataFrame:
    """A record per page: of equal payloads of ``LEAST_SHARED`` bytes or more, the largest page id's is a response
    and the others revisit it; all others are responses.

    Null ids count as the smallest; rows that repeat the largest id are responses all.  Payloads count as
    equal if their SHA-256 and length are.  Counting is done on digests alone, before payloads move.
    """
    spark = pages.sparkSession
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    digest = F.when(F.octet_length("html") >= LEAST_SHARED, F.unhex(F.sha2(payload, 256)))
    number, uri = F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("target_uri")
    salt = F.struct("page_id", "target_uri")        # a payload that a third of all pages share is spread over tasks
    shared = salted.totals(
        salted.with_salt(pages.select(number, uri, digest.alias("same")).filter("same is not null"), salt), ["same"],
        [F.max("page_id").alias("keeper"), F.count("*").alias("n")],
        [F.max("keeper").alias("keeper"), F.sum("n").alias("n")], keep=F.expr("n > 1 and keeper is not null")).drop("n")
    path = scratch_path(spark, "shared-payloads")
    shared.write.parquet(path)
    rows = pages.select(number, uri, payload.alias("payload"), digest.alias("same"))
    # smaller payloads are all responses, and stay where they are
    small = rows.filter("same is null").withColumn("keeper", F.lit(None).cast("long"))
    rows = salted.with_salt(rows.filter("same is not null"), salt).join(
        spark.read.parquet(path), ["same", salted.SALT], "left").drop(salted.SALT).unionByName(small)
    revisit = F.coalesce(F.col("keeper") != F.coalesce("page_id", F.col("keeper") - 1), F.lit(False))
    name = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(c.cast("string"), F.lit("none")))
    return rows.select(
        name(F.col("page_id")).alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        "page_id", "target_uri", F.sha1("payload").alias("payload_digest"),
        F.octet_length("payload").cast("long").alias("payload_length"),
        F.when(revisit, name(F.col("keeper"))).alias("refers_to"),
        F.when(~revisit, F.col("payload")).alias("payload"))


def write_warc(records: DataFrame, path: str, **options) -> None:
    register(records.sparkSession)
    records.write.format(FORMAT).mode("append").options(**options).save(path)


def read_warc(spark: SparkSession, path: str, **options) -> DataFrame:
    register(spark)
    return spark.read.format(FORMAT).options(**options).load(path)
