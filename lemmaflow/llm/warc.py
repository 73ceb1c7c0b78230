"""WARC: convert legacy ARC archives to WARC, and read WARC files back.

An ARC file has records of a header line and as many bytes as that line declares. The first record, ``filedesc://``, says
which version the lines have: version 1 has URL, IP, date, content type and length; version 2 adds result code,
checksum, location, offset and file name before the length. From a line and its bytes this makes what WARC asks for:
a record identifier (name-based UUID of URI, date, block digest, the ARC file's name and the record's place in it), an ISO 8601 timestamp, the
record type, and block and payload digests. Every WARC file begins with a warcinfo record. A revisit has its response's identifier, URI and
date, as the format asks for, and the page's number in a header of its own.

Defined results: null html is the empty payload; a null url is written as ``urn:unknown``; a null page_id stays null, is
never what others refer to, and its record is a response unless a page with an id has the same payload; pages
with equal ids and payloads are all responses or all revisits, each with an identifier of its own; an empty table gives no records; other columns
aren't read; equal ARC files without names give equal identifiers.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lemmaflow.llm.common import P, heavy_keys, scratch_dir, staged
from lemmaflow.llm.files import new_name, put

#: Fields of the header line by version.
FIELDS = {
    1: ("url", "ip", "date", "content_type", "length"),
    2: ("url", "ip", "date", "content_type", "result_code", "checksum", "location", "offset", "filename", "length"),
}
ARC_BYTES, WARC_BYTES = 4 << 20, 48 << 20
RECORD = "record_id string, warc_date string, warc_type string, uri string, ip string, content_type string, head binary, payload binary, payload_digest string, block_digest string"
_DATE = "20200101000000"


# ---- ARC


def arc_file(records: list[tuple[str, str, str, str, bytes]], version: int) -> bytes:
    """An ARC file of (url, ip, 14-digit date, content type, bytes)."""
    about = f"{version} 0 lemmaflow\n{' '.join(n.replace('_', '-').capitalize() if n not in ('url', 'ip') else {'url': 'URL', 'ip': 'IP-address'}[n] for n in FIELDS[version])}\n\n".encode()
    out, at = bytearray(), 0
    for url, ip, date, kind, data in [("filedesc://pages.arc", "0.0.0.0", _DATE, "text/plain", about), *records]:
        values = {"url": url, "ip": ip, "date": date, "content_type": kind, "result_code": "200", "checksum": "-", "location": "-", "offset": str(at), "filename": "pages.arc", "length": str(len(data))}
        out += " ".join(values[n] for n in FIELDS[version]).encode() + b"\n" + data + b"\n"
        at = len(out)
    return bytes(out)


def read_arc(data: bytes) -> Iterator[dict]:
    """Records of an ARC file: the header line's fields by its version, ``data`` of the declared length, and where the record begins (``at``; 0: the version block)."""
    at, version = 0, 0
    while at < len(data):
        if data[at : at + 1] in (b"\n", b"\r"):
            at += 1
            continue
        end = data.find(b"\n", at)
        if end < 0:
            raise ValueError(f"ARC header line at byte {at} has no end")
        line = data[at:end].decode("utf-8", "replace").rstrip("\r").split(" ")
        if not version:
            body = data[end + 1 : end + 1 + int(line[-1])]
            if not line[0].startswith("filedesc:") or (version := int(body.split(b" ", 1)[0] or b"0")) not in FIELDS:
                raise ValueError("no ARC version block of version 1 or 2")
            names = FIELDS[1] if len(line) == len(FIELDS[1]) else FIELDS[version]
        else:
            names = FIELDS[version]
        if len(line) != len(names):
            raise ValueError(f"ARC header line at byte {at} has {len(line)} fields; version {version} has {len(names)}")
        record = dict(zip(names, line, strict=True))
        length = int(record["length"])
        if end + 1 + length > len(data):
            raise ValueError(f"ARC record at byte {at} is cut off")
        yield record | {"data": data[end + 1 : end + 1 + length], "at": at}
        at = end + 1 + length


def page_arcs(pages: DataFrame) -> DataFrame:
    """Pages as ARC files, of both versions by turns, of about 4 MB: the legacy input. The page's id stands in its HTTP header."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        made, held, size = 0, [], 0

        def file() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([f"pages-{part}-{made}.arc"]), pa.array([arc_file(held, 1 + made % 2)], pa.binary())], names=["name", "arc"])

        for batch in batches:
            for page_id, url, html in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                payload = (html or "").encode()
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(payload)}\r\n" + (f"X-Page-Id: {page_id}\r\n" if page_id is not None else "") + "\r\n"
                held.append((re.sub(r"[\s\x00]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url or "urn:unknown") or "urn:unknown", "0.0.0.0", _DATE, "text/html", head.encode() + payload))
                size += len(payload)
                if size >= ARC_BYTES:
                    yield file()
                    made, held, size = made + 1, [], 0
        if held:
            yield file()

    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(run, "name string, arc binary")


# ---- ARC to WARC


def to_warc(record: dict, file: str = "") -> dict:
    """What an equivalent WARC record has. ``file``: the ARC file's name. The version block becomes a warcinfo record, whatever others are called."""
    data, url = record["data"], record["url"]
    head, payload = b"", data
    if record["at"] == 0:
        kind, content = "warcinfo", "application/warc-fields"
    elif data.startswith(b"HTTP/"):
        kind, content = "response", "application/http; msgtype=response"
        cut = re.search(rb"\r?\n\r?\n", data)
        head, payload = (data[: cut.end()], data[cut.end() :]) if cut else (data, b"")
    else:
        kind, content = ("response" if url.startswith("dns:") else "resource"), record["content_type"]
    date = datetime.strptime((record["date"] + "20000101000000"[len(record["date"]) :])[:14], "%Y%m%d%H%M%S")
    block = hashlib.sha256(data).hexdigest()
    return {
        "record_id": f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{url} {record["date"]} {block} {file} {record["at"]}')}", "warc_date": date.strftime("%Y-%m-%dT%H:%M:%SZ"), "warc_type": kind, "uri": url, "ip": record["ip"],
        "content_type": content, "head": head, "payload": payload, "payload_digest": hashlib.sha256(payload).hexdigest(), "block_digest": block,
    }


def convert_arcs(arcs: DataFrame) -> DataFrame:
    """WARC records (as columns) of ARC files in the column ``arc``, with their names in ``name``, if there is such a column."""
    names = [x.split()[0] for x in RECORD.split(", ")]
    kinds = [pa.binary() if x.endswith("binary") else pa.string() for x in RECORD.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, arc in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows = [to_warc(r, file or "") for r in read_arc(arc.as_py() or b"")]
                yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds, strict=True)], names=names)

    return arcs.select("name" if "name" in arcs.columns else F.lit("").alias("name"), "arc").mapInArrow(run, RECORD)


def mark_revisits(records: DataFrame, order: str, least: int = 100) -> DataFrame:
    """Of responses with equal payloads of ``least`` bytes or more, the one of smallest ``order`` stays a response; the others become revisits.

    Adds ``refers`` (order, record_id, uri and warc_date of the response that a revisit refers to). ``records`` is read twice: a table. Payloads move
    once, dealt by digest; digests with over 1/500 of the rows don't move.
    """
    is_body = (F.col("warc_type") == "response") & (F.octet_length("payload") >= least)
    who = F.struct(F.col(order).alias("order"), "record_id", "uri", "warc_date")
    first = F.min(F.when(F.col(order).isNotNull(), who)).alias(f"{P}first")
    counts = staged(records.filter(is_body).groupBy("payload_digest").agg(first, F.count(F.lit(1)).alias("n")).filter("n > 1 and __lf_first is not null"), "payloads")
    heavy = heavy_keys(counts, ["payload_digest"])
    firsts = counts.drop("n").withColumnRenamed("payload_digest", f"{P}digest")
    few = F.broadcast(heavy.drop("n").withColumnRenamed("payload_digest", f"{P}hot").withColumnRenamed(f"{P}first", f"{P}hot_first"))
    key = F.when(is_body, F.col("payload_digest"))
    at_hand = records.join(few, key == F.col(f"{P}hot"), "left")
    # a key of its own for rows that need no look-up keeps them from meeting in one task
    lookup = F.coalesce(F.when(F.col(f"{P}hot").isNull(), key), F.concat(F.lit("-"), F.col("record_id")))
    joined = at_hand.withColumn(f"{P}key", lookup).join(firsts, F.col(f"{P}key") == F.col(f"{P}digest"), "left")
    first = F.coalesce(f"{P}hot_first", f"{P}first")
    again = first.isNotNull() & ~F.col(order).eqNullSafe(first["order"])
    return joined.select(*(F.when(again, "revisit").otherwise(F.col("warc_type")).alias(c) if c == "warc_type" else F.col(c) for c in records.columns), F.when(again, first).alias("refers"))


# ---- WARC files


def warc_record(r: dict) -> bytes:
    again = r["warc_type"] == "revisit"
    block = r["head"] if again else r["head"] + r["payload"]
    lines = ["WARC/1.1", f"WARC-Type: {r['warc_type']}", f"WARC-Record-ID: <{r['record_id']}>", f"WARC-Date: {r['warc_date']}", f"Content-Type: {r['content_type']}", f"Content-Length: {len(block)}",
             f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest() if again else r['block_digest']}", f"WARC-Payload-Digest: sha256:{r['payload_digest']}", f"X-Payload-Length: {len(r['payload'])}"]
    if r["warc_type"] != "warcinfo":
        lines += [f"WARC-Target-URI: {r['uri']}", f"WARC-IP-Address: {r['ip']}"]
    if again:
        first = r["refers"]
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <{first['record_id']}>", f"WARC-Refers-To-Target-URI: {first['uri']}", f"WARC-Refers-To-Date: {first['warc_date']}",
                  f"X-Refers-To-Page: {first['order']}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def about_file(name: str) -> bytes:
    """A file's first record."""
    block = b"software: lemmaflow\r\nformat: WARC File Format 1.1\r\n"
    digest = hashlib.sha256(block).hexdigest()
    lines = ["WARC/1.1", "WARC-Type: warcinfo", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>", f"WARC-Date: {datetime.now(UTC).strftime('%Y-%m-%dT%H:%M:%SZ')}", f"WARC-Filename: {name}", "Content-Type: application/warc-fields",
             f"Content-Length: {len(block)}", f"WARC-Block-Digest: sha256:{digest}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(record: bytes, level: int) -> bytes:
    pack = zlib.compressobj(level, zlib.DEFLATED, 31)
    return pack.compress(record) + pack.flush()


def write_warc(records: DataFrame, folder: str, level: int = 4) -> DataFrame:
    """Write records as ``.warc.gz`` files (a gzip member a record, after one about the file) in ``folder``; the manifest of the files that count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def file(parts: list[bytes]) -> pa.RecordBatch:
            name = new_name(".warc.gz")
            data = b"".join([member(about_file(name), level), *parts])
            return pa.RecordBatch.from_arrays([pa.array([put(folder, name, data)]), pa.array([len(parts)], pa.int64()), pa.array([len(data)], pa.int64())], names=["file", "records", "bytes"])

        parts, size = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                data = warc_record(row)
                parts.append(member(data, level))
                size += len(data)
                if size >= WARC_BYTES:
                    yield file(parts)
                    parts, size = [], 0
        if parts:
            yield file(parts)

    return staged(records.mapInArrow(run, "file string, records long, bytes long"), "manifest")


def read_members(data: bytes) -> Iterator[bytes]:
    """The gzip members of a file, one after the other."""
    view, at = memoryview(data), 0
    while at < len(view):
        unpack, out = zlib.decompressobj(31), []
        while not unpack.eof and at < len(view):
            part = view[at : at + (1 << 16)]
            out.append(unpack.decompress(part))
            at += len(part) - len(unpack.unused_data)
        yield b"".join(out)


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record")
    fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    block = rest[: int(fields["content-length"])]
    if fields["warc-block-digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
        raise ValueError(f"block digest of {fields['warc-record-id']} doesn't fit")
    return fields, block


def read_warc(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """Records of the files that the manifest has: fields of the WARC and HTTP headers."""
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, uri string, warc_date string, record_id string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = [x.split()[0] for x in schema.split(", ")], [pa.int64() if x.endswith("long") else pa.string() for x in schema.split(", ")]
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for member in read_members(content.as_py()):
                    fields, block = parse_record(member)
                    if fields["warc-type"] == "warcinfo":
                        continue
                    head = block.partition(b"\r\n\r\n")[0]
                    page = re.search(rb"\r\nX-Page-Id: (-?\d+)(?:\r|$)", head)
                    payload = block[len(head) + 4 :]
                    if fields["warc-type"] == "response" and hashlib.sha256(payload).hexdigest() != fields["warc-payload-digest"].removeprefix("sha256:"):
                        raise ValueError(f"payload digest of {fields['warc-record-id']} doesn't fit")
                    again = fields.get("x-refers-to-page")
                    rows.append((int(page[1]) if page else None, int(fields["x-payload-length"]), fields["warc-payload-digest"].removeprefix("sha256:"), fields["warc-type"], int(again) if again else None, fields["warc-target-uri"], fields["warc-date"], fields["warc-record-id"].strip("<>")))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").schema("path string, modificationTime timestamp, length long, content binary").load(folder)
    # the manifest has a row a file; the join reads no more than names before it reads contents
    counted = files.withColumn(f"{P}name", F.element_at(F.split("path", "/"), -1)).join(manifest.select("file"), F.col(f"{P}name") == F.col("file"), "left_semi")
    return counted.select("content").mapInArrow(run, schema)


def convert_pages(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Pages as ARC, converted to WARC files with revisits, read back from those."""
    spark = pages.sparkSession
    folder = folder or scratch_dir(spark, "warc")
    number = F.regexp_extract(F.decode("head", "UTF-8"), r"\r\nX-Page-Id: (-?\d+)\r", 1)
    # the version blocks become the files' own warcinfo records; a table, as revisits read it twice
    records = staged(convert_arcs(page_arcs(pages)).filter("warc_type <> 'warcinfo'").withColumn(f"{P}page", F.when(number != "", number).cast("long")), "records")
    manifest = write_warc(mark_revisits(records, f"{P}page").drop(f"{P}page"), folder)
    if manifest.isEmpty():
        return spark.createDataFrame([], "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, uri string, warc_date string, record_id string")
    return read_warc(spark, folder, manifest)
