"""WARC archives of web pages, an index of their records, and reads of selected records by coalesced byte ranges.

Writing: records are composed by Spark expressions and written by its text writer, whose line separator is the blank
line that ends a WARC record, so archives are committed with the job and a lost executor leaves nothing half-written.
A page whose payload equals that of a page with a smaller id becomes a revisit record without the payload.

Index first: a pass over the archives hops from header to header and writes archive, offset, length, URL and payload
digest of every record. Reading: the selected index rows are ranged and sorted by archive and offset; ranges that lie
close together are fetched in one read of bounded size, and the records are cut out of it.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbflow.llm import heavy
from curbflow.llm.tables import table, written
from curbflow.session import scratch_dir

# Lines and names of the archive format.
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Header fields of our own: ids of the page and of the page a revisit refers to.
PAGE_ID, REFERS_TO_ID = "X-Page-ID", "X-Refers-To-Page-ID"


@dataclass(frozen=True)
class Settings:
    """least: payloads of fewer bytes are always stored. records: of an archive at most. gap: bytes between two selected
    records that are read rather than skipped. span: bytes of a read, unless one record is longer. date: of all records."""

    least: int = 100
    records: int = 20_000
    gap: int = 64 << 10
    span: int = 8 << 20
    task: int = 64 << 20
    date: str = "1970-01-01T00:00:00Z"


def judged(pages: DataFrame, least: int, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """(id, url, payload, size, digest, first): first is the smallest id among the rows with an equal payload of at least
    `least` bytes; null where the payload is shorter or has no equal."""
    payload = F.coalesce(html_col, F.lit(""))
    rows = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("size"), F.unhex(F.sha2(payload.cast("binary"), 256)).alias("key"),
    )
    narrow = written(rows.filter(F.col("size") >= least).select("id", "key"), "payload-digests")
    best = F.min("id")
    hot = written(heavy.winners(narrow, best), "heavy-payloads")
    rest = narrow.join(F.broadcast(hot.select("key")), "key", "left_anti")
    several = rest.groupBy("key").agg(best.alias("rare_best"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    several = written(several.select(F.col("key").alias("rare_key"), "rare_best"), "repeated-payloads")
    marked = rows.join(F.broadcast(hot.select("key", F.col("best").alias("hot_best"), F.lit(True).alias("hot"))), "key", "left")
    settled = F.col("hot").isNotNull() | (F.col("size") < least)
    # rows that need no lookup get a key of another length, which matches nothing and spreads them over all tasks
    lookup = F.when(settled, F.unhex(F.md5(F.monotonically_increasing_id().cast("string")))).otherwise(F.col("key"))
    found = marked.withColumn("lookup", lookup).join(several, F.col("lookup") == F.col("rare_key"), "left")
    first = F.when(F.col("size") >= least, F.coalesce("hot_best", "rare_best"))
    return found.select("id", "url", "payload", "size", F.lower(F.hex("key")).alias("digest"), first.alias("first"))


def _urn(*parts: Column) -> Column:
    h = F.md5(F.concat_ws(" ", *parts))
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *(F.substring(h, a, n) for a, n in cuts)), F.lit(">"))


def composed(rows: DataFrame, date: str) -> DataFrame:
    """(value): the records of judged rows, without the blank line at their end."""
    own_id = F.coalesce(F.col("id").cast("string"), F.lit("-"))
    response = F.col("first").isNull() | F.col("id").eqNullSafe(F.col("first"))
    uri = F.when(F.col("url").rlike(r"[\x00-\x20\x7f]"), F.url_encode("url")).otherwise(F.col("url"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("size").cast("string"), F.lit(END),
    )
    block = F.octet_length(http) + F.when(response, F.col("size")).otherwise(0)

    def field(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"\r\n{name}: "), value), F.lit(""))

    of_first = _urn(F.col("digest"), F.col("first").cast("string"))
    of_revisit = _urn(F.col("digest"), own_id, F.coalesce("url", F.lit("-")), F.lit("revisit"))
    of_response = _urn(F.col("digest"), own_id)
    revisit = lambda value: F.when(~response, value)
    header = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(response, "response").otherwise("revisit"),
        field("WARC-Record-ID", F.when(response, of_response).otherwise(of_revisit)),
        field("WARC-Date", F.lit(date)),
        field("WARC-Target-URI", uri),
        field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        field("WARC-Profile", revisit(F.lit(PROFILE))),
        field("WARC-Refers-To", revisit(of_first)),
        field(PAGE_ID, F.col("id").cast("string")),
        field(REFERS_TO_ID, revisit(F.col("first").cast("string"))),
        F.lit("\r\nContent-Type: application/http; msgtype=response"),
        field("Content-Length", block.cast("string")), F.lit(END),
    )
    return rows.select(F.concat(header, http, F.when(response, F.col("payload")).otherwise("")).alias("value"))


def write_archives(
    pages: DataFrame, folder: str, settings: Settings = Settings(),
    id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
) -> None:
    """One record per row of pages, in archives of at most `records` records under `folder`.

    A null html counts as empty. Of rows with equal payloads of at least `least` bytes, the one with the smallest id is
    the response, rows that repeat that id too are responses as well, and the others refer to it; a null id is larger
    than all others, and where equal payloads have only null ids all are responses. A null url leaves its field out;
    one with blanks or control characters is percent-encoded. Other columns play no part; no rows give no records.
    """
    rows = judged(pages, settings.least, id_col, url_col, html_col)
    writer = composed(rows, settings.date).write.option("maxRecordsPerFile", settings.records)
    writer.text(folder, compression="none", lineSep=END)


def _opened(path: str) -> pa.NativeFile:
    """A file in any store that pyarrow reads, by the path as Spark reports it."""
    parts = urlsplit(path)
    if parts.scheme in ("", "file"):
        return fs.LocalFileSystem().open_input_file(unquote(parts.path))
    store, inner = fs.FileSystem.from_uri(path)
    return store.open_input_file(inner)


def fields(header: bytes) -> dict[str, str]:
    """Name -> value of a header's lines; the first line has no colon-separated name and is left out."""
    pairs = (line.split(": ", 1) for line in header.decode("utf-8", "surrogateescape").split("\r\n")[1:])
    return {p[0]: p[1] for p in pairs if len(p) == 2}


def headers(file: pa.NativeFile, size: int, window: int = 1 << 20) -> Iterator[tuple[int, int, dict[str, str]]]:
    """(offset, length, fields) of an archive's records, reading on from header to header."""
    at, start, data = 0, 0, b""
    while at < size:
        step = window
        while (end := data.find(END.encode(), at - start) if start <= at < start + len(data) else -1) < 0:
            if start == at and start + len(data) >= size:
                raise ValueError(f"no record at offset {at}")
            file.seek(at)
            start, data, step = at, file.read(min(step, size - at)), step * 2
        found = fields(data[at - start : end])
        length = end - (at - start) + len(END) + int(found["Content-Length"]) + len(END)
        yield at, length, found
        at += length


INDEX = "archive string, offset long, length long, url string, digest string"


def indexed(spark: SparkSession, folder: str) -> DataFrame:
    """(archive, offset, length, url, digest) of every record in the archives of `folder`; length includes the blank line
    at the end. Archives are dealt out whole; they are bounded by their number of records. Empty archives give no rows."""
    files = spark.read.format("binaryFile").load(folder).select("path", "length")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows = []
                with _opened(path) as file:
                    for offset, length, found in headers(file, size):
                        digest = found.get("WARC-Payload-Digest", "").removeprefix("sha256:")
                        rows.append((path, offset, length, found.get("WARC-Target-URI"), digest))
                columns = list(zip(*rows, strict=True)) or [()] * 5
                types = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                    names=["archive", "offset", "length", "url", "digest"],
                )

    return files.mapInArrow(scan, INDEX)


def spans(places: list[tuple[int, int]], gap: int, span: int) -> Iterator[tuple[int, int, int]]:
    """(first place, offset, bytes) of reads that cover sorted (offset, length) places: neighbours at most `gap` bytes
    apart share a read of `span` bytes at most."""
    first, start, stop = 0, None, None
    for k, (offset, length) in enumerate(places):
        if start is None:
            start, stop = offset, offset + length
        elif offset - stop > gap or offset + length - start > span:
            yield first, start, stop - start
            first, start, stop = k, offset, offset + length
        else:
            stop = max(stop, offset + length)
    if start is not None:
        yield first, start, stop - start


def parsed(record: bytes) -> tuple:
    """(id, url, type, digest, bytes, refers_to, payload, intact) of a record. The payload of a revisit is null, its digest
    and size come from the headers; those of a response are measured and compared with its headers."""
    head, _, block = record.partition(END.encode())
    found = fields(head)
    http, _, payload = block[: int(found["Content-Length"])].partition(END.encode())
    digest = found["WARC-Payload-Digest"].removeprefix("sha256:")
    size = int(fields(http)["Content-Length"])
    common = (found.get(PAGE_ID), found.get("WARC-Target-URI"), found["WARC-Type"])
    if found["WARC-Type"] == "revisit":
        return (*common, digest, size, found.get(REFERS_TO_ID), None, True)
    measured = hashlib.sha256(payload).hexdigest()
    return (*common, measured, len(payload), None, payload, measured == digest and len(payload) == size)


RECORD = (
    "archive string, offset long, id string, url string, record_type string, payload_digest string, "
    "payload_bytes long, refers_to string, payload binary, intact boolean"
)
_TYPES = (
    pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary(),
    pa.bool_(),
)
_NAMES = [f.split()[0] for f in RECORD.split(", ")]


def read_records(selected: DataFrame, settings: Settings = Settings(), payloads: bool = True) -> DataFrame:
    """The records of selected index rows: see RECORD. Rows that repeat a record give it as often. Without `payloads` that
    column is null, though sizes and digests are still those of the payloads read. No rows give no rows."""
    # tasks by the bytes they will fetch: the index rows themselves are far smaller
    total = selected.agg(F.sum("length")).first()[0] or 0
    ordered = selected.select("archive", "offset", "length").repartitionByRange(total // settings.task + 1, "archive", "offset")
    ordered = ordered.sortWithinPartitions("archive", "offset")
    gap, span = settings.gap, settings.span

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            archives, offsets, lengths = (c.to_pylist() for c in batch.columns)
            bounds = [k for k in range(len(archives)) if k == 0 or archives[k] != archives[k - 1]] + [len(archives)]
            for begin, end in zip(bounds, bounds[1:], strict=False):
                places = list(zip(offsets[begin:end], lengths[begin:end], strict=True))
                with _opened(archives[begin]) as file:
                    reads = list(spans(places, gap, span))
                    for (first, start, size), until in zip(reads, [r[0] for r in reads[1:]] + [len(places)], strict=True):
                        file.seek(start)
                        data, rows = file.read(size), []
                        for offset, length in places[first:until]:
                            found = parsed(data[offset - start : offset - start + length])
                            if not payloads:
                                found = (*found[:-2], None, found[-1])
                            rows.append((archives[begin], offset, *found))
                        columns = zip(*rows, strict=True)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], names=_NAMES
                        )

    return ordered.mapInArrow(fetch, RECORD)


def archived(
    pages: DataFrame, settings: Settings = Settings(), payloads: bool = False,
    id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
) -> DataFrame:
    """Pages written to archives in the shared folder, indexed, and all read back, one row per row of pages:
    page_id, payload_bytes, payload_digest, record_type, refers_to, url, archive, offset, intact (and payload).
    See `write_archives` for nulls, ties, repeated rows and empty tables."""
    spark = pages.sparkSession
    folder = os.path.join(scratch_dir(spark), f"warc-{uuid.uuid4().hex}")
    write_archives(pages, folder, settings, id_col, url_col, html_col)
    index = written(indexed(spark, folder), "warc-index")
    kind = pages.schema[id_col].dataType
    found = read_records(index, settings, payloads)
    extra = ("url", "archive", "offset", "intact", *(("payload",) if payloads else ()))
    return found.select(
        F.col("id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"), *extra,
    )


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = archived(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


OP11_SQL = """
with payloads as (
  select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha256(coalesce(html, '')) as payload_digest
  from pages
), firsts as (
  select *, case when payload_bytes >= 100 then min(page_id) over (partition by payload_digest) end as first_id
  from payloads
)
select page_id, payload_bytes, payload_digest,
       case when coalesce(first_id, page_id) = page_id then 'response' else 'revisit' end as record_type,
       case when first_id <> page_id then first_id end as refers_to,
       true as intact
from firsts
"""
