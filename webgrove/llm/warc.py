"""WARC archives with an index written first.

Every record is a gzip member of its own.  The task that writes a record also writes
its index row: file, offset, length, URL and digest.  Reading starts at the index: the
selected records' byte ranges are sorted, neighbouring ones coalesced into few reads,
and each read is cut into records.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from webgrove.llm.common import in_batches, rows_of, shuffle_partitions, stored, text_bytes, work_folder

#: Payloads from this size on are stored once; equal ones become revisit records.
LEAST_SHARED = 1000
#: Reads cover at most so many bytes, unless one record is longer; gaps up to GAP are read over.
READ_BYTES, GAP = 4 << 20, 64 << 10
#: A task begins a new file after so many bytes.
FILE_BYTES = 1 << 30
LEVEL = 3
CRLF = "\r\n"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def typed(pages: DataFrame, *, least_shared: int = LEAST_SHARED) -> DataFrame:
    """``page_id, url, payload, digest, record_type, refers_to``, a row per page.

    Of records with equal payloads of ``least_shared`` bytes or more the one with the
    largest ``page_id`` is a response, the others revisit it.  Who is repeated is found
    from ids and digests alone and stored; only if that list is too large for Spark to
    broadcast do payloads cross a shuffle, whose hot digests it can split.  Rows with a
    null id are responses; a null page is an empty payload; repeated rows are records each.
    """
    body = F.coalesce(F.col("html").cast("binary"), F.lit("").cast("binary"))
    plain = pages.select("page_id", F.coalesce(F.expr("make_valid_utf8(url)"), F.lit("")).alias("url"), body.alias("payload"), F.sha1(body).alias("digest"))
    shared = (F.octet_length("payload") >= least_shared) & F.col("page_id").isNotNull()
    originals = (plain.where(shared).groupBy("digest").agg(F.max("page_id").alias("_original"), F.count("*").alias("_n")).where("_n > 1")
                 .select(F.col("digest").alias("_digest"), "_original"))
    joined = plain.withColumn("_key", F.when(shared, F.col("digest"))).join(
        stored(originals, "originals"), F.col("_key") == F.col("_digest"), "left")
    revisit = F.col("_original") != F.col("page_id")
    return joined.select("page_id", "url", "payload", "digest", F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                         F.when(revisit, F.col("_original")).alias("refers_to"))


def _one_line(value: str) -> str:
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _as_given(value: str) -> str:
    return value.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def make_record(page_id: int | None, url: str, payload: bytes, digest: str, kind: str, refers_to: int | None) -> bytes:
    """A whole WARC record.  A revisit keeps the response's headers and leaves its payload out."""
    http = f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: {len(payload)}{CRLF}{CRLF}".encode()
    block = http if kind == "revisit" else http + payload
    fields = {
        "WARC-Type": kind, "WARC-Record-ID": _name(page_id), "WARC-Target-URI": _one_line(url), "WARC-Date": DATE, "WARC-Payload-Digest": f"sha1:{digest}",
        **({"WARC-Profile": PROFILE, "WARC-Refers-To": _name(refers_to)} if kind == "revisit" else {}),
        "Content-Type": "application/http;msgtype=response", "Content-Length": len(block),
    }
    head = f"WARC/1.1{CRLF}" + "".join(f"{name}: {value}{CRLF}" for name, value in fields.items()) + CRLF
    return head.encode() + block + b"\r\n\r\n"


def _deflated(data: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write_archive(pages: DataFrame, folder: str, *, least_shared: int = LEAST_SHARED, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write ``folder/records/*.warc.gz`` and ``folder/index`` (Parquet); the index.

    Every attempt of a task has file names of its own, and only the index rows of the
    attempt that succeeds are kept: files that a lost attempt leaves are never read.
    """
    index = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("digest", pa.string()), ("record_type", pa.string()), ("file", pa.string()),
                       ("offset", pa.int64()), ("length", pa.int64())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            out, at, name = None, 0, ""
            try:
                for page_id, url, payload, digest, kind, refers_to in rows_of(batches, "page_id", "url", "payload", "digest", "record_type", "refers_to"):
                    if out is None or at >= file_bytes:
                        if out is not None:
                            out.close()
                        name, at = f"{folder}/records/{uuid.uuid4()}.warc.gz", 0
                        system, place = fs.FileSystem.from_uri(name)
                        system.create_dir(place.rpartition("/")[0], recursive=True)
                        out = system.open_output_stream(place, compression=None)
                    data = _deflated(make_record(page_id, url, payload, digest, kind, refers_to))
                    out.write(data)
                    yield page_id, url, digest, kind, name, at, len(data)
                    at += len(data)
            finally:
                if out is not None:
                    out.close()

        yield from in_batches(rows(), index)

    typed(pages, least_shared=least_shared).mapInArrow(
        write, "page_id long, url string, digest string, record_type string, file string, offset long, length long").write.parquet(f"{folder}/index")
    return pages.sparkSession.read.parquet(f"{folder}/index")


def read_records(spark: SparkSession, selected: DataFrame) -> DataFrame:
    """``page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload`` of selected index rows.

    ``selected`` needs ``file, offset, length``.  Every value comes from the archive's
    bytes.  A revisit's payload is null, its size and digest are those its headers
    state; a response's digest is made from the payload it holds.
    """
    in_order = Window.partitionBy("file", "_cell").orderBy("offset")
    cells = selected.select("file", "offset", "length").distinct().withColumn("_cell", F.expr(f"offset div {READ_BYTES}"))
    gap = F.col("offset") - F.lag(F.col("offset") + F.col("length")).over(in_order)
    reads = (cells.withColumn("_gap", (gap > GAP).cast("int"))
             .withColumn("_range", F.coalesce(F.sum("_gap").over(in_order), F.lit(0)))
             .groupBy("file", "_cell", "_range")
             .agg(F.min("offset").alias("start"), F.max(F.col("offset") + F.col("length")).alias("end"), F.array_sort(F.collect_list(F.struct("offset", "length"))).alias("parts"))
             .select("file", "start", "end", F.col("parts.offset").alias("offsets"), F.col("parts.length").alias("lengths")))
    result = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for name, start, end, offsets, lengths in rows_of(batches, "file", "start", "end", "offsets", "lengths"):
                system, place = fs.FileSystem.from_uri(name)
                with system.open_input_file(place) as file:
                    data = memoryview(file.read_at(end - start, start))
                for offset, length in zip(offsets, lengths, strict=True):
                    yield parse_record(zlib.decompress(data[offset - start:offset - start + length], 31))

        yield from in_batches(rows(), result)

    return reads.repartition(shuffle_partitions(spark), "file", "start").mapInArrow(
        read, "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary")


def _headers(lines: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in lines.decode().split(CRLF)[1:])


def _page(name: str) -> int | None:
    number = name.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def parse_record(data: bytes) -> tuple:
    """One record's bytes as a row of ``read_records``; what does not add up raises an error."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = _headers(head)
    size = int(fields["Content-Length"])
    if not head.startswith(b"WARC/1.1") or rest[size:] != b"\r\n\r\n":
        raise ValueError("index and archive do not agree")
    http, _, payload = rest[:size].partition(b"\r\n\r\n")
    stated = int(_headers(http)["Content-Length"])
    if fields["WARC-Type"] == "revisit":
        return (_page(fields["WARC-Record-ID"]), _as_given(fields["WARC-Target-URI"]), "revisit", _page(fields["WARC-Refers-To"]), stated,
                fields["WARC-Payload-Digest"].removeprefix("sha1:"), None)
    if stated != len(payload):
        raise ValueError("a payload is cut short")
    return (_page(fields["WARC-Record-ID"]), _as_given(fields["WARC-Target-URI"]), "response", None, len(payload), hashlib.sha1(text_bytes(payload)).hexdigest(), payload)


def archive_and_read(pages: DataFrame) -> DataFrame:
    """Write all pages to a new archive in the shared folder and read all of it back."""
    spark = pages.sparkSession
    return read_records(spark, write_archive(pages, work_folder(spark, "archive")))
