"""Legacy ARC archives and their conversion to WARC.

An ARC file opens with a version block that says which header lines follow: 5
fields in version 1, 10 in version 2. Every record is one header line and as
many bytes as its last field declares. The converter reads both and makes
what WARC needs and ARC lacks: record ids (from archive name and offset, so a
second run makes the same), ISO timestamps, types and digests.

Archives are written and read by Spark's own writers and readers, several
records to a file of bounded size.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..sources import stages

#: Bytes of records after which an archive file is full; a longer record has one of its own. A task holds one
#: file in memory, several times over, so this bounds the memory of a task and the number of files.
ARCHIVE_BYTES = 32_000_000
#: Smallest payload of which a second copy becomes a revisit.
REVISIT_BYTES = 1000

#: The field lists of the two versions.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
#: Fixed value: the WARC profile of a revisit with an equal payload.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_KEY = b"X-Record-Key"
_ID_SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "arc-to-warc")


@dataclass
class ArcRecord:
    archive: str
    offset: int
    url: str
    ip: str
    date: str
    mime: str
    block: bytes
    problem: str | None = None


def _clean(field: str | None) -> str:
    """A header field holds no white space or control characters."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", field or "") or "-"


def arc_record(version: int, url: str | None, date: str, block: bytes, offset: int = 0, name: str = "-") -> bytes:
    start = [_clean(url), "0.0.0.0", date, "text/html"]
    extra = [] if version == 1 else ["200", "-", "-", str(offset), name]
    return b"\n" + " ".join([*start, *extra, str(len(block))]).encode() + b"\n" + block


def arc_version_block(version: int, name: str, date: str) -> bytes:
    body = f"{version} 0 archive\n{FIELDS[version]}\n".encode()
    start = [f"filedesc://{name}", "0.0.0.0", date, "text/plain"]
    extra = [] if version == 1 else ["200", "-", "-", "0", name]
    return " ".join([*start, *extra, str(len(body))]).encode() + b"\n" + body


def http_block(key: int | None, payload: bytes) -> bytes:
    lines = [b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8"]
    if key is not None:
        lines.append(_KEY + b": " + str(key).encode())
    lines.append(b"Content-Length: " + str(len(payload)).encode())
    return b"\r\n".join(lines) + b"\r\n\r\n" + payload


def split_http(block: bytes) -> tuple[bytes, dict[bytes, bytes], bytes]:
    """Head with its empty line, header fields, payload; a block that is no HTTP message is all payload."""
    if not block.startswith(b"HTTP/"):
        return b"", {}, block
    head, empty, payload = block.partition(b"\r\n\r\n")
    fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:] if b": " in line)
    return head + empty, fields, payload


def parse_arc(data: bytes) -> Iterator[ArcRecord]:
    """The records of one ARC file after its version block.

    The field list of the version block says how many fields a header line has;
    they are counted from the right, so blanks in a URL do no harm. A declared
    length beyond the end of the file gives the bytes that are there and a
    problem; a line that is no header line ends the file with a problem.
    """
    at, end, version, archive, file_date = 0, len(data), 1, "", ""
    while True:
        while at < end and data[at:at + 1] in (b"\n", b"\r"):
            at += 1
        if at >= end:
            return
        start = at
        stop = data.find(b"\n", at)
        line = data[at:stop if stop >= 0 else end].rstrip(b"\r").decode("utf-8", "replace")
        fields = line.rsplit(" ", len(FIELDS[version].split()) - 1)
        if line.startswith("filedesc://"):
            fields = line.split(" ")
        if stop < 0 or len(fields) < 5 or not fields[-1].isdigit():
            yield ArcRecord(archive, start, "", "", file_date, "", data[start:], "no header line")
            return
        length = int(fields[-1])
        block = data[stop + 1:stop + 1 + length]
        at = stop + 1 + length
        if line.startswith("filedesc://"):
            archive, file_date = fields[0].removeprefix("filedesc://"), fields[2]
            version = 2 if block.split(b" ", 1)[0] == b"2" else 1
            continue
        yield ArcRecord(
            archive, start, fields[0], fields[1], fields[2], fields[3], block,
            None if len(block) == length else "shorter than declared",
        )


def warc_date(arc_date: str) -> str:
    """``20240131235959`` as ``2024-01-31T23:59:59Z``; short dates are filled up, other texts give 1970."""
    digits = arc_date if re.fullmatch(r"\d{4,14}", arc_date) else "1970"
    full = digits + "00000101000000"[len(digits):]
    return f"{full[:4]}-{full[4:6]}-{full[6:8]}T{full[8:10]}:{full[10:12]}:{full[12:14]}Z"


def record_id(archive: str, offset: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(_ID_SPACE, f'{archive}@{offset}')}>"


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def warc_record(r: dict, block: bytes) -> bytes:
    """One WARC record for an ARC record; a revisit keeps the HTTP head and refers to the response."""
    head, fields, payload = split_http(block)
    revisit = r["refers_to"] is not None
    kind = "revisit" if revisit else "response" if head else "resource"
    kept = head if revisit else block
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(r['archive'], r['offset'])}",
        f"WARC-Target-URI: {r['url']}", f"WARC-Date: {warc_date(r['date'])}", f"WARC-IP-Address: {r['ip']}",
        f"WARC-Payload-Digest: {_sha1(payload)}", f"WARC-Block-Digest: {_sha1(kept)}",
    ]
    if revisit:
        lines += [
            f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(r['to_archive'], r['to_offset'])}",
            f"WARC-Refers-To-Target-URI: {r['to_url']}", f"WARC-Refers-To-Date: {warc_date(r['to_date'])}",
            f"X-Refers-To-Key: {r['refers_to']}",
        ]
    lines += [
        "Content-Type: " + ("application/http; msgtype=response" if head else r["mime"] or "application/octet-stream"),
        f"Content-Length: {len(kept)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + kept + b"\r\n\r\n"


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of every record, by declared lengths."""
    at = 0
    while (at := data.find(b"WARC/", at)) >= 0:
        stop = data.find(b"\r\n\r\n", at)
        if stop < 0:
            return
        lines = data[at:stop].decode("utf-8", "replace").split("\r\n")[1:]
        fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}
        length = int(fields.get("content-length", 0))
        yield fields, data[stop + 4:stop + 4 + length]
        at = stop + 4 + length


def _as_text(parts: list[bytes]) -> pa.Array:
    """Bytes as a string column, unchecked: Spark's text writer writes them as they are."""
    return pa.array(parts, pa.binary()).view(pa.string())


def write_archives(archives: DataFrame, path: str) -> None:
    """One compressed file for every row of the only column."""
    archives.write.option("compression", "gzip").option("maxRecordsPerFile", 1).text(path)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("content")


def _inflate(data: bytes) -> bytes:
    return gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data


def arc_archives(
    pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", date: str = "20240101000000",
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Whole ARC files, one a row: the payloads in UTF-8 as HTTP responses, both versions in turn.

    A NULL payload is empty, a NULL url is ``-``, a NULL key leaves the key out.
    Repeated rows stay separate records, an empty table gives no file, other
    columns are not read. A file is full at ``archive_bytes``.
    """
    chosen = pages.select(
        F.col(key).cast("long").alias("key"), F.col(url).cast("string").alias("url"), F.col(payload).cast("binary").alias("payload")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        full, size, version, name = 0, 0, 1, ""

        def close() -> pa.RecordBatch:
            nonlocal held, full, size
            out = pa.RecordBatch.from_arrays([_as_text([b"".join(held)])], names=["value"])
            held, size, full = [], 0, full + 1
            return out

        for batch in batches:
            for k, u, p in zip(*(batch.column(c) for c in range(3))):
                block = http_block(k.as_py(), p.as_py() or b"")
                if not held:
                    version = 1 + full % 2
                    # Named by content, so a repeated task names it alike.
                    name = f"{hashlib.sha1(block + str(u).encode() + str(full).encode()).hexdigest()}.arc"
                    held.append(arc_version_block(version, name, date))
                    size = len(held[0])
                held.append(arc_record(version, u.as_py(), date, block, size, name))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield close()
        if held:
            yield close()

    return chosen.mapInArrow(run, "value string")


_RECORD = T.StructType([
    T.StructField("archive", T.StringType()), T.StructField("offset", T.LongType()),
    T.StructField("url", T.StringType()), T.StructField("ip", T.StringType()),
    T.StructField("date", T.StringType()), T.StructField("mime", T.StringType()),
    T.StructField("key", T.LongType()), T.StructField("payload_bytes", T.LongType()),
    T.StructField("payload_digest", T.StringType()), T.StructField("problem", T.StringType()),
])


def arc_records(archives: DataFrame, blocks: bool) -> DataFrame:
    """One row per record of the ARC files in ``content``; with the block when asked for."""
    schema = T.StructType([*_RECORD.fields, *([T.StructField("block", T.BinaryType())] if blocks else [])])

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = {"LongType()": pa.int64(), "StringType()": pa.string(), "BinaryType()": pa.binary()}
        columns = list(zip(*rows))
        return pa.RecordBatch.from_arrays(
            [pa.array(c, kinds[repr(f.dataType)]) for c, f in zip(columns, schema)], names=schema.names
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for r in parse_arc(_inflate(content.as_py())):
                    _, fields, payload = split_http(r.block)
                    key = fields.get(_KEY)
                    rows.append((
                        r.archive, r.offset, r.url, r.ip, r.date, r.mime, int(key) if key else None, len(payload),
                        hashlib.sha1(payload).hexdigest(), r.problem, *([r.block] if blocks else []),
                    ))
                if rows:
                    yield batch_of(rows)

    return archives.mapInArrow(run, schema)


def convert(
    spark: SparkSession, arc_path: str, warc_path: str, least: int = REVISIT_BYTES, archive_bytes: int = ARCHIVE_BYTES
) -> None:
    """Convert all ARC files of a folder to WARC files in another.

    Of records with equal payloads of at least ``least`` bytes the one with the
    largest key is the response and the others revisit it; rows tied on that
    key are all responses, and a missing key is smaller than any. Other records
    are kept whole. A folder without records gives one without; a WARC file is
    full at ``archive_bytes``.

    Digests that recur are counted first and written as a table; it is joined
    to the records by digest, in memory while small, else with hot digests split.
    """
    archives = read_archives(spark, arc_path)
    light = arc_records(archives, blocks=False).where((F.col("payload_bytes") >= least) & F.col("problem").isNull())
    to = F.struct("key", "archive", "offset", "url", "date")
    repeated, repeated_path = stages.stage_at(
        light.groupBy(F.col("payload_digest").alias("_digest")).agg(F.max(to).alias("_to"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1 AND _to.key IS NOT NULL").drop("_n"),
        "repeated-payloads",
    )
    records = arc_records(archives, blocks=True)
    other = ~F.col("key").eqNullSafe(F.col("_to.key")) & (F.col("payload_bytes") >= least) & F.col("problem").isNull()
    joined = records.join(repeated, records["payload_digest"] == repeated["_digest"], "left").select(
        *[c for c in records.columns if c != "block"],
        *[F.when(other, F.col(f"_to.{c}")).alias(n) for c, n in
          (("key", "refers_to"), ("archive", "to_archive"), ("offset", "to_offset"), ("url", "to_url"), ("date", "to_date"))],
        "block",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        size = 0
        for batch in batches:
            rows = batch.select(batch.schema.names[:-1]).to_pylist()
            for row, block in zip(rows, batch.column(batch.num_columns - 1)):
                held.append(warc_record(row, block.as_py()))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield _archive(held)
                    held, size = [], 0
        if held:
            yield _archive(held)

    write_archives(joined.mapInArrow(run, "value string"), warc_path)
    stages.discard(spark, repeated_path)


def _archive(records: list[bytes]) -> pa.RecordBatch:
    """A WARC file: an information record, then the records."""
    about = b"software: arc-to-warc\r\nformat: WARC File Format 1.1\r\n"
    digest = hashlib.sha1(b"".join(hashlib.sha1(r).digest() for r in records)).hexdigest()
    info = "\r\n".join([
        "WARC/1.1", "WARC-Type: warcinfo", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(_ID_SPACE, digest)}>",
        "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Filename: {digest}.warc",
        "Content-Type: application/warc-fields", f"Content-Length: {len(about)}",
    ]).encode() + b"\r\n\r\n" + about + b"\r\n\r\n"
    return pa.RecordBatch.from_arrays([_as_text([b"".join([info, *records])])], names=["value"])


WARC_ROW = (
    "key long, record_type string, target_uri string, warc_date string, record_id string, payload_bytes long,"
    " payload_digest string, refers_to long, digest_ok boolean"
)


def warc_records(archives: DataFrame) -> DataFrame:
    """One row per response, revisit or resource record of the WARC files in ``content``.

    Size and digest are those of the full payload, which a revisit states in its
    HTTP head and its payload digest; ``digest_ok`` compares a present payload
    with the digest its record states.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for fields, block in parse_warc(_inflate(content.as_py())):
                    kind = fields.get("warc-type")
                    if kind == "warcinfo":
                        continue
                    head, http, payload = split_http(block)
                    key, to = http.get(_KEY), fields.get("x-refers-to-key")
                    stated = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
                    size = int(http.get(b"Content-Length", len(payload))) if kind == "revisit" else len(payload)
                    rows.append((
                        int(key) if key else None, kind, fields.get("warc-target-uri"), fields.get("warc-date"),
                        fields.get("warc-record-id"), size, stated, int(to) if to else None,
                        kind == "revisit" or hashlib.sha1(payload).hexdigest() == stated,
                    ))
                if rows:
                    kinds = [pa.int64(), *[pa.string()] * 4, pa.int64(), pa.string(), pa.int64(), pa.bool_()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                        names=[p.split()[0] for p in WARC_ROW.split(", ")],
                    )

    return archives.mapInArrow(run, WARC_ROW)
