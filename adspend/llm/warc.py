"""WARC archives with an index first, and coalesced reads of byte ranges.

Writing: rows of equal payload are found by digest (counts are combined before
the shuffle); the row with the smallest identifier is stored whole, the others
as revisit records. Each task appends gzip members, one a record, to files of
its own in a shared folder, and returns a row per record: file, offset, length,
URL and digest. These rows are the index. It is written as a table before
anything is read, and only files that it names count: files of an attempt that
failed or was repeated elsewhere are never referred to.

Reading: any selection of index rows is sorted by file and offset, ranges with
small gaps are fetched by one read, and the records are cut out of it.

The archive folder may be any that pyarrow's file systems open (file, hdfs, s3,
gs). Defined results: a null payload is empty, a null URL gives no target
header; rows repeating identifier and payload are all responses; a row without
an identifier is a response and no one refers to it.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scratch import cut, scratch_path

REVISIT_BYTES = 100       # payloads of at least so many bytes are stored once
FILE_BYTES = 512 << 20    # a task begins a new file beyond this size
LEVEL = 4                 # of compression
GAP_BYTES = 64 << 10      # ranges nearer than this are one read
READ_BYTES = 8 << 20      # and a read stops growing here

_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page_id(record_id: str) -> int | None:
    own = record_id[len("<urn:page:"):-1]
    return int(own) if own else None


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
           date: str) -> bytes:
    """One WARC record; a revisit has no payload."""
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: {_record_id(page_id)}", f"WARC-Date: {date}",
            f"WARC-Payload-Digest: sha256:{digest}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is None:
        block = _HTTP + b"Content-Length: %d\r\n\r\n" % len(payload) + payload
    else:
        block = _HTTP + b"\r\n"
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_record_id(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not the beginning of a WARC record")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(headers["Content-Length"])]
    return headers, block.partition(b"\r\n\r\n")[2]


INDEX = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("file", T.StringType()),
    T.StructField("offset", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("url", T.StringType()), T.StructField("digest", T.StringType()),
    T.StructField("record_type", T.StringType())])
_INDEX = pa.schema([("page_id", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()),
                    ("url", pa.string()), ("digest", pa.string()), ("record_type", pa.string())])


def _append(folder: str, date: str, level: int, file_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = pyarrow.fs.FileSystem.from_uri(folder)
        attempt = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        out, name, at, made = None, "", 0, 0
        try:
            for batch in batches:
                rows = []
                for page_id, url, payload, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns),
                                                                    strict=True):
                    if out is None or at >= file_bytes:
                        if out is not None:
                            out.close()
                        name, at, made = f"part-{attempt}-{made}.warc.gz", 0, made + 1
                        out = store.open_output_stream(f"{base}/{name}", compression=None)
                    raw = record(page_id, url, payload.encode(), digest, refers_to, date)
                    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
                    member = packer.compress(raw) + packer.flush()
                    out.write(member)
                    rows.append((page_id, name, at, len(member), url, digest,
                                 "response" if refers_to is None else "revisit"))
                    at += len(member)
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _INDEX, strict=True)],
                        schema=_INDEX)
        finally:
            if out is not None:
                out.close()
    return write


def write_warc(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url",
               payload_col: str = "html", revisit_bytes: int = REVISIT_BYTES, date: str = "2000-01-01T00:00:00Z",
               level: int = LEVEL, file_bytes: int = FILE_BYTES) -> tuple[str, DataFrame]:
    """Writes the archives; returns their folder and the index, itself a written table."""
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    if "://" not in folder and not folder.startswith("file:"):
        folder = "file://" + folder
    store, base = pyarrow.fs.FileSystem.from_uri(folder)
    store.create_dir(base, recursive=True)
    payload = F.coalesce(F.col(f"`{payload_col}`"), F.lit(""))
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("_id"), F.col(f"`{url_col}`").alias("_url"),
                        payload.alias("_payload")).withColumn("_digest", F.sha2(F.col("_payload").cast("binary"), 256))
    first = rows.where(F.octet_length("_payload") >= revisit_bytes).groupBy("_digest").agg(
        F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_digest", "_first")
    rows = rows.join(first, "_digest", "left").select(
        "_id", "_url", "_payload", "_digest", F.when(F.col("_id") != F.col("_first"), F.col("_first")).alias("_to"))
    index = rows.mapInArrow(_append(folder, date, level, file_bytes), INDEX)
    return folder, cut(index, "warc-index")


def _fetch(folder: str, gap: int, most: int):
    def ranges(rows: Iterator[tuple[str, int, int]]) -> Iterator[tuple[str, int, int, list[tuple[int, int]]]]:
        """Neighbouring records of a file as one range."""
        name, start, end, parts = None, 0, 0, []
        for file, offset, length in rows:
            if file != name or offset - end > gap or offset < end or end - start >= most:
                if parts:
                    yield name, start, end, parts
                name, start, parts = file, offset, []
            parts.append((offset - start, length))
            end = offset + length
        if parts:
            yield name, start, end, parts

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = pyarrow.fs.FileSystem.from_uri(folder)
        wanted = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        opened, source = None, None
        for name, start, end, parts in ranges(wanted):
            if name != opened:
                if source is not None:
                    source.close()
                opened, source = name, store.open_input_file(f"{base}/{name}")
            data = source.read_at(end - start, start)
            rows = []
            for at, length in parts:
                headers, payload = parse(zlib.decompress(data[at: at + length], 31))
                kind = headers["WARC-Type"]
                to = headers.get("WARC-Refers-To")
                rows.append((_page_id(headers["WARC-Record-ID"]), headers.get("WARC-Target-URI"), kind,
                             None if to is None else _page_id(to),
                             headers["WARC-Payload-Digest"].removeprefix("sha256:"),
                             payload if kind == "response" else None))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _RECORD, strict=True)], schema=_RECORD)
        if source is not None:
            source.close()
    return read


RECORD = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
    T.StructField("record_type", T.StringType()), T.StructField("refers_to", T.LongType()),
    T.StructField("digest", T.StringType()), T.StructField("payload", T.BinaryType())])
_RECORD = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                     ("refers_to", pa.int64()), ("digest", pa.string()), ("payload", pa.binary())])


def read_warc(folder: str, selected: DataFrame, gap_bytes: int = GAP_BYTES, read_bytes: int = READ_BYTES) -> DataFrame:
    """The records of the index rows given (any selection, by URL, digest or other columns).

    A revisit has a null payload and says which page it refers to.
    """
    rows = selected.select("file", "offset", "length").repartitionByRange("file", "offset")
    return rows.sortWithinPartitions("file", "offset").mapInArrow(_fetch(folder, gap_bytes, read_bytes), RECORD)


def payloads(folder: str, index: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of all
    records read back; size and digest are those of the payload bytes read, for
    revisits those of the response they refer to."""
    own = read_warc(folder, index).select(
        "page_id", "record_type", "refers_to", "digest",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.when(F.col("payload").isNotNull(), F.sha2("payload", 256)).alias("payload_digest"))
    own = cut(own, "warc-records")
    stored = own.where("record_type = 'response'").select(
        F.col("page_id").alias("refers_to"), "digest", F.col("payload_bytes").alias("_bytes"),
        F.col("payload_digest").alias("_digest")).dropDuplicates(["refers_to", "digest"])
    return own.join(stored, ["refers_to", "digest"], "left").select(
        "page_id", F.coalesce("payload_bytes", "_bytes").alias("payload_bytes"),
        F.coalesce("payload_digest", "_digest").alias("payload_digest"), "record_type", "refers_to")
