"""WARC archives as a Python data source, and duplicate payloads as revisit records.

``df.write.format("warc")`` writes one record per row: per-record gzip members, and beside
each archive an index with every member's offset. Files that a failed attempt left behind
are never read, because each commit writes a list of its valid files; in mode append the
earlier lists hold on, in mode overwrite the new list names those that it replaces.
``spark.read.format("warc")`` plans partitions as runs of files of bounded size, takes filters
on record_type and on header columns, inflates a member's headers first, and inflates the
payload only of records that pass, and only with option payload=true.

Responses hold an HTTP message whose body is the payload. Record ids follow from the page_id
and the digest, so that a revisit can name the record that it refers to. Header values with
control characters are written percent-encoded, and whole in a field of their own.

Null html is an empty payload; long ones are whole. Rows that share a page_id and a payload
get the same record type. Rows without a page_id are never referred to: they are revisits of
a page with the same payload if there is one. An empty table gives no records. Extra columns
are ignored.
"""

from __future__ import annotations

import base64
import json
import re
import uuid
import zlib

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    In,
    InputPartition,
    IsNotNull,
    WriterCommitMessage,
)

from . import shared

#: Header names of the columns; fixed values of the WARC 1.1 format, and two extension fields.
HEADERS = {
    "record_type": "WARC-Type",
    "target_uri": "WARC-Target-URI",
    "payload_digest": "WARC-Payload-Digest",
    "refers_to_uri": "WARC-Refers-To-Target-URI",
    "page_id": "X-Page-Id",
    "refers_to": "X-Refers-To-Page-Id",
    "payload_bytes": "X-Payload-Length",
}
SCHEMA = "page_id string, record_type string, target_uri string, payload_digest string, payload_bytes string, refers_to string, refers_to_uri string, payload binary"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def file_system(uri: str):
    return pafs.FileSystem.from_uri(uri)


_CONTROL = re.compile(r"[\x00-\x1F\x7F\x85\u2028\u2029]")
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"


def _fields(column: str, header: str, value) -> list[str]:
    text = str(value)
    clean = _CONTROL.sub(lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), text)
    return [f"{header}: {clean}"] + ([f"X-Whole-{column}: {base64.b64encode(text.encode()).decode()}"] if clean != text or text != text.strip() else [])


def _record_id(page_id, digest) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{digest}')}>"


def _lists(fs, base: str) -> dict[str, dict]:
    """The commits' lists of files that hold, by their paths."""
    found = {i.path.rsplit("/", 1)[-1]: i.path for i in fs.get_file_info(pafs.FileSelector(base, allow_not_found=True)) if i.path.endswith(".list.json")}
    out = {}
    for name, path in found.items():
        with fs.open_input_stream(path, compression=None) as f:
            out[name] = json.loads(f.read())
    gone = {x for v in out.values() for x in v["replaces"]}
    return {k: v for k, v in sorted(out.items()) if k not in gone}


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, file_bytes: int, overwrite: bool):
        self.path, self.file_bytes, self.overwrite = path, file_bytes, overwrite

    def write(self, batches):
        fs, base = file_system(self.path)
        fs.create_dir(base, recursive=True)
        written, out, index, at, name = [], None, [], 0, ""

        def close():
            nonlocal out
            if out is not None:
                out.close()
                with fs.open_output_stream(f"{base}/{name}.idx", compression=None) as side:
                    side.write(json.dumps(index).encode())
                written.append(name)
                out = None

        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    name, at, index = f"{uuid.uuid4().hex}.warc.gz", 0, []
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                body = (row["payload"] or b"") if row["record_type"] == "response" else b""
                member = self._member(row, body)
                out.write(member)
                index.append([at, len(member)])
                at += len(member)
                if at >= self.file_bytes:
                    close()
        close()
        return WarcFiles(written)

    @staticmethod
    def _member(row: dict, body: bytes) -> bytes:
        own = f"{row['page_id']}:revisit" if row["record_type"] == "revisit" else row["page_id"]
        lines = ["WARC/1.1", f"WARC-Record-ID: {_record_id(own, row['payload_digest'])}", "WARC-Date: 1970-01-01T00:00:00Z"]
        lines += [line for c, header in HEADERS.items() if row.get(c) is not None for line in _fields(c, header, row[c])]
        if row["record_type"] == "revisit":
            lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {_record_id(row['refers_to'], row['payload_digest'])}"]
        else:
            body = HTTP.format(len(body)).encode() + body
        lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}", "", ""]
        press = zlib.compressobj(1, wbits=31)
        # the headers end on a sync point, so that a reader can inflate them alone
        return press.compress("\r\n".join(lines).encode()) + press.flush(zlib.Z_SYNC_FLUSH) + press.compress(body) + press.compress(b"\r\n\r\n") + press.flush()

    def commit(self, messages):
        fs, base = file_system(self.path)
        fs.create_dir(base, recursive=True)
        old = _lists(fs, base) if self.overwrite else {}
        with fs.open_output_stream(f"{base}/{uuid.uuid4().hex}.list.json", compression=None) as out:
            out.write(json.dumps({"names": sorted(n for m in messages if m for n in m.names), "replaces": sorted(old)}).encode())
        for n in (n for v in old.values() for n in v["names"]):
            for path in (f"{base}/{n}", f"{base}/{n}.idx"):
                fs.delete_file(path)

    def abort(self, messages):
        fs, base = file_system(self.path)
        for m in messages:
            for n in m.names if m else []:
                for path in (f"{base}/{n}", f"{base}/{n}.idx"):
                    fs.delete_file(path)


class WarcFiles(WriterCommitMessage):
    def __init__(self, names):
        self.names = names


class FileRun(InputPartition):
    def __init__(self, names):
        super().__init__(names)


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payload: bool, split_bytes: int):
        self.path, self.payload, self.split_bytes = path, payload, split_bytes
        self.wanted: dict[str, set[str]] = {}
        self.present: set[str] = set()

    def pushFilters(self, filters):
        for f in filters:
            name = f.attribute[0] if getattr(f, "attribute", None) and len(f.attribute) == 1 else None
            if name in HEADERS and isinstance(f, EqualTo):
                self._want(name, {str(f.value)})
            elif name in HEADERS and isinstance(f, In):
                self._want(name, {str(v) for v in f.value})
            elif name in HEADERS and isinstance(f, IsNotNull):
                self.present.add(name)
            else:
                yield f

    def _want(self, name, values):
        self.wanted[name] = self.wanted.get(name, values) & values

    def partitions(self):
        fs, base = file_system(self.path)
        lists = _lists(fs, base)
        if not lists:
            raise FileNotFoundError(f"no WARC archives in {self.path}")
        names = sorted(n for v in lists.values() for n in v["names"])
        sizes = [i.size for i in fs.get_file_info([f"{base}/{n}" for n in names])] if names else []
        runs, run, total = [], [], 0
        for name, size in zip(names, sizes):
            run, total = [*run, name], total + size
            if total >= self.split_bytes:
                runs, run, total = [*runs, FileRun(run)], [], 0
        return [*runs, FileRun(run)] if run or not runs else runs

    def read(self, partition):
        fs, base = file_system(self.path)
        columns = list(HEADERS)
        for name in partition.value:
            with fs.open_input_stream(f"{base}/{name}.idx", compression=None) as f:
                index = json.loads(f.read())
            with fs.open_input_file(f"{base}/{name}") as f:
                rows = []
                for at, size in index:
                    f.seek(at)
                    head, rest = self._headers(f, size)
                    values = {c: base64.b64decode(head[f"X-Whole-{c}"]).decode() if f"X-Whole-{c}" in head else head.get(HEADERS[c]) for c in columns}
                    if any(values[c] not in v for c, v in self.wanted.items()) or any(values[c] is None for c in self.present):
                        continue
                    body = None
                    if self.payload:
                        body = rest(f)[: int(head["Content-Length"])]
                        body = body.partition(b"\r\n\r\n")[2] if head["Content-Type"].startswith("application/http") else body
                    rows.append(values | {"payload": body})
                    if len(rows) >= 512:
                        yield self._batch(rows)
                        rows = []
                if rows:
                    yield self._batch(rows)

    @staticmethod
    def _headers(f, size):
        """The header fields, from the first bytes of a member; and how to inflate the rest."""
        inflate, left, got = zlib.decompressobj(wbits=31), size, b""
        while b"\r\n\r\n" not in got:
            piece = f.read(min(1024, left))
            if not piece:
                raise ValueError("a record without an end of its headers")
            left -= len(piece)
            got += inflate.decompress(piece)
        head, _, start = got.partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        return fields, lambda g: start + inflate.decompress(g.read(left))

    @staticmethod
    def _batch(rows):
        names = [x.strip().split(" ")[0] for x in SCHEMA.split(",")]
        kinds = [pa.binary() if n == "payload" else pa.string() for n in names]
        return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds)], names=names)


class WarcDataSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options["path"], self.options.get("payload", "true") == "true", int(self.options.get("splitbytes", 64 << 20)))

    def writer(self, schema, overwrite):
        return WarcWriter(self.options["path"], int(self.options.get("filebytes", 64 << 20)), overwrite)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def to_records(pages: DataFrame, min_bytes: int = 100) -> DataFrame:
    """One WARC record per page; of equal payloads of min_bytes or more all but the smallest page_id's revisit it."""
    rows = shared.small_batches(shared.with_columns(pages, "page_id", "url", "html")).withColumn("payload", F.encode(F.coalesce("html", F.lit("")), "utf-8"))
    rows = rows.select("page_id", F.col("url").alias("target_uri"), "payload", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("digest"))
    firsts = (
        rows.filter(F.col("payload_bytes") >= min_bytes)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "target_uri")))["target_uri"].alias("first_uri"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("digest", "first", "first_uri")
    )
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(firsts, "digest", "left").select(
        F.col("page_id").cast("string").alias("page_id"),
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        "target_uri",
        F.concat(F.lit("sha256:"), "digest").alias("payload_digest"),
        F.col("payload_bytes").cast("string").alias("payload_bytes"),
        F.when(again, F.col("first").cast("string")).alias("refers_to"),
        F.when(again, F.col("first_uri")).alias("refers_to_uri"),
        F.when(~again, F.col("payload")).alias("payload"),
    )


def write_warc(records: DataFrame, path: str, mode: str = "append") -> None:
    register(records.sparkSession)
    records.write.format("warc").mode(mode).save(path)


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared.scratch(spark, "warc")
    write_warc(to_records(shared.table(spark, sf_dir, "pages")), path)
    common = [F.col("page_id").cast("long").alias("page_id"), F.col("record_type"), F.col("refers_to").cast("long").alias("refers_to")]
    # the full payload of a response is in the archive and is measured again; that of a revisit is in its headers
    whole = read_warc(spark, path).filter("record_type = 'response'").select(*common, F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest"))
    again = read_warc(spark, path, payload=False).filter("record_type = 'revisit'").select(*common, F.col("payload_bytes").cast("long").alias("payload_bytes"), F.substring_index("payload_digest", ":", -1).alias("payload_digest"))
    return whole.unionByName(again).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP5_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, p.payload_digest,
       CASE WHEN first IS NULL OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM p LEFT JOIN f ON p.payload_digest = f.payload_digest AND p.payload_bytes >= 100
"""
