"""WARC archives: a writer with revisit records and a splittable reader.

Writing: every row becomes a record in a gzip member of its own.  Equal payloads of at
least ``least_revisit`` bytes are kept once, with the largest page_id; the others become
revisit records that name it.  The groups are found on digests, narrow rows combined on
the map side, so a large group of copies is one row; html moves at most once.  A task
writes its archive under a name of its own and renames it at the end, so a task that
runs again leaves the same file.

Reading: files are cut into byte ranges.  A task looks for gzip magic in its range and
takes a place as a member only if the bytes there decode to a WARC header.  From then on
members follow each other.  A task owns the records that start inside its range and
reads past the end of it to finish the last one.

Files are reached through pyarrow's file systems by the URI of the shared folder.

Defined cases: NULL html is an empty payload; NULL page_id and NULL url are left out of
the header and come back NULL; rows with the same largest page_id and payload are all
responses; if a group has no page_id at all, its rows are responses; line breaks in a url
are percent-encoded; an empty table gives no archive and an empty result; extra columns
are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataload.llm.common import settle
from strataload.operators.skew import join_side
from strataload.sources.sink import scratch_folder


@dataclass(frozen=True)
class WarcSpec:
    least_revisit: int = 1000
    range_bytes: int = 4 << 20  # of a reading task
    date: str = "2024-01-01T00:00:00Z"  # the clock is passed in
    level: int = 6


_MAGIC = b"\x1f\x8b\x08"
_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL name space of RFC 4122
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'page:{page_id}:{digest}')}>"


def _gzip_member(data: bytes, level: int) -> bytes:
    """One gzip member without a time stamp."""
    press = zlib.compressobj(level, zlib.DEFLATED, 31)
    return press.compress(data) + press.flush()


def _page(value: str | None) -> int | None:
    return None if value is None else int(value)


def encode_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, spec: WarcSpec) -> bytes:
    """One record: a response with the payload, or a revisit with its HTTP header only."""
    digest = hashlib.sha1(payload)
    name = digest.hexdigest()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    header = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id, name)}",
        f"WARC-Date: {spec.date}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(digest.digest()).decode()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        header.append(f"WARC-Target-URI: {url.replace(chr(13), '%0D').replace(chr(10), '%0A')}")
    if page_id is not None:
        header.append(f"X-Page-ID: {page_id}")
    if refers_to is not None:
        header += [f"WARC-Profile: {_REVISIT}", f"WARC-Refers-To: {record_id(refers_to, name)}"]
    data = "\r\n".join(header).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return _gzip_member(data, spec.level)


def decode_record(data: bytes) -> dict:
    """The fields of one record; a digest that does not fit its payload is an error."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    sizes = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    kind = fields["WARC-Type"]
    if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    return {
        "record_id": fields["WARC-Record-ID"],
        "page_id": int(fields["X-Page-ID"]) if "X-Page-ID" in fields else None,
        "url": fields.get("WARC-Target-URI"),
        "record_type": kind,
        "payload": payload if kind == "response" else None,
        "payload_bytes": int(sizes["Content-Length"]),
        "payload_digest": digest,
        "refers_to_record": fields.get("WARC-Refers-To"),
    }


def _with_originals(pages: DataFrame, spec: WarcSpec) -> DataFrame:
    """page_id, url, html and the page_id that the row revisits (NULL: none)."""
    body = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", F.sha1(body).alias("digest"))
    narrow = rows.filter(F.octet_length(F.coalesce("html", F.lit(""))) >= spec.least_revisit).select("page_id", "digest")
    groups = join_side(narrow, ["digest"], F.max("page_id").alias("original"), F.count(F.lit(1)).alias("rows"))
    groups = groups.filter("rows > 1 and original is not null").drop("rows")
    revisits = narrow.join(groups, "digest").filter("page_id is null or page_id <> original").distinct()
    revisits = revisits.select(F.col("page_id").alias("_page"), F.col("digest").alias("_digest"), "original")
    same = F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("digest") == F.col("_digest"))
    found = rows.join(settle(revisits), same, "left")
    # ids travel as text: pandas would make floats of whole numbers next to NULL
    return found.select(F.col("page_id").cast("string"), "url", "html", F.col("original").cast("string"))


def write_archives(pages: DataFrame, folder: str, spec: WarcSpec = WarcSpec()) -> DataFrame:
    """Write ``pages`` as archives below ``folder``; a row (file, records) per archive."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = arrow_fs.FileSystem.from_uri(folder)
        context = TaskContext.get()
        final = f"{root}/part-{context.partitionId():06d}.warc.gz"
        fresh = f"{root}/_{context.partitionId():06d}-{context.taskAttemptId()}"
        records, out = 0, None
        for batch in batches:
            for page, url, html, original in zip(batch.page_id, batch.url, batch.html, batch.original):
                if out is None:
                    system.create_dir(root, recursive=True)
                    out = system.open_output_stream(fresh, compression=None)
                payload = (html or "").encode("utf-8", "surrogatepass")
                out.write(encode_record(_page(page), url, payload, _page(original), spec))
                records += 1
        if out is not None:
            out.close()
            system.move(fresh, final)
            yield pd.DataFrame({"file": [final], "records": [records]}, dtype=object)

    found = _with_originals(pages, spec)
    return settle(found.mapInPandas(run, "file string, records long"))


class _Window:
    """Bytes of a file from ``at`` on, read in blocks as needed."""

    def __init__(self, source, at: int, block: int = 1 << 20):
        self.source, self.block, self.at = source, block, at
        self.data, self.ended = b"", False
        source.seek(at)

    def more(self) -> bool:
        new = b"" if self.ended else self.source.read(self.block)
        self.ended = not new
        self.data += new
        return bool(new)

    def skip(self, count: int) -> None:
        self.data = self.data[count:]
        self.at += count


def _starts_record(window: _Window, offset: int) -> bool:
    """Whether the bytes at ``offset`` decode to the start of a WARC header."""
    while len(window.data) < offset + 256 and window.more():
        pass
    try:
        start = zlib.decompressobj(31).decompress(window.data[offset : offset + 4096], 16)
    except zlib.error:
        return False
    return start.startswith(b"WARC/1.")


def _member(window: _Window) -> bytes | None:
    """The decoded member at the window's start, which moves behind it; None at the end."""
    if not window.data and not window.more():
        return None
    unpack, out = zlib.decompressobj(31), io.BytesIO()
    while True:
        out.write(unpack.decompress(window.data))
        if unpack.eof:
            window.skip(len(window.data) - len(unpack.unused_data))
            return out.getvalue()
        window.skip(len(window.data))
        if not window.more():
            raise ValueError("the archive ends inside a record")


def read_range(source, start: int, end: int) -> Iterator[bytes]:
    """The decoded records that start in [start, end) of an archive."""
    window = _Window(source, start)
    while True:  # find the first member that starts here
        spot = window.data.find(_MAGIC)
        if spot >= 0:
            if window.at + spot >= end:
                return
            if _starts_record(window, spot):
                window.skip(spot)
                break
            window.skip(spot + 1)
            continue
        window.skip(max(0, len(window.data) - len(_MAGIC) + 1))
        if window.at >= end or not window.more():
            return
    while window.at < end:
        data = _member(window)
        if data is None:
            return
        yield data


_RECORDS = (
    "record_id string, page_id long, url string, record_type string, payload binary, payload_bytes long, "
    "payload_digest string, refers_to_record string"
)


_MOST_TASKS = 100_000  # beyond that a task reads several ranges


def read_archives(spark: SparkSession, folder: str, spec: WarcSpec = WarcSpec(), payload: bool = True) -> DataFrame:
    """All records of the archives below ``folder``; ``payload=False`` leaves payloads out."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder).select("path", "length")
    starts = F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(spec.range_bytes).cast("long"))
    ranges = files.filter("length > 0").select("path", F.explode(starts).alias("start"))
    # a row of a hundred bytes stands for a range of the archive, so the number of tasks is
    # given: with it, rows are not dealt to fewer tasks by their own small size
    tasks = files.agg(F.sum(F.ceil(F.col("length") / spec.range_bytes))).first()[0] or 1
    ranges = ranges.repartition(min(int(tasks), _MOST_TASKS), "path", "start")
    width = spec.range_bytes

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, start in zip(batch.path, batch.start):
                system, name = arrow_fs.FileSystem.from_uri(path)
                with system.open_input_file(name) as source:
                    rows, held = [], 0
                    for data in read_range(source, start, start + width):
                        row = decode_record(data)
                        if not payload:
                            row["payload"] = None
                        rows.append(row)
                        held += len(data)
                        if held > (8 << 20):
                            yield pd.DataFrame(rows, dtype=object)
                            rows, held = [], 0
                    if rows:
                        yield pd.DataFrame(rows, dtype=object)

    return ranges.mapInPandas(run, _RECORDS)


def archived(pages: DataFrame, spec: WarcSpec = WarcSpec()) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read the records back.

    Columns of :func:`read_archives` without the payload, and refers_to: the page_id of the
    record that a revisit names.
    """
    spark = pages.sparkSession
    folder = f"{scratch_folder(spark)}/warc"
    written = write_archives(pages, folder, spec)
    if written.isEmpty():
        return spark.createDataFrame([], f"{_RECORDS}, refers_to long")
    records = settle(read_archives(spark, folder, spec, payload=False))
    named = records.filter("record_type = 'response'").select("record_id", F.col("page_id").alias("refers_to"))
    named = join_side(named, ["record_id"], F.max("refers_to").alias("refers_to"))
    named = named.select(F.col("record_id").alias("refers_to_record"), "refers_to")
    return records.join(named, "refers_to_record", "left").select(*records.columns, "refers_to")
