"""WARC archives from a chunked record table.

Payloads move as rows (record key, chunk number, chunk, running digest): a payload is read through zero-copy slices of
the Arrow buffer that it arrives in, its SHA-1 is carried from chunk to chunk, and nothing allocates a second copy of
a whole record.  A payload of one chunk becomes one WARC record; a longer one becomes a segmented record (a
``response`` and its ``continuation`` records), as the format provides.  Reading streams the segments of a record
in order through one digest.

Archives are gzip-compressed text files in a shared folder, written and read by Spark's own text source, so any
store that Spark reaches will do.  Records are cut apart at the record delimiter on reading; chunks are cut so that
none contains it, and the parser goes by Content-Length.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.components import materialize
from strata.session import scratch_path
from strata.sinks.versions import delete_path

#: bytes of payload in a record at most
CHUNK_BYTES = 1 << 20
#: rows of a batch that is handed back to Spark hold at most about so many bytes
BATCH_BYTES = 4 << 20
#: payloads of at least so many bytes are stored once, later copies as revisits
MIN_REVISIT_BYTES = 0

# fixed values of the format
_EOL = "\r\n"
_VERSION = "WARC/1.0"
_DELIMITER = f"{_EOL}{_EOL}{_VERSION}{_EOL}"
_HTTP = f"HTTP/1.1 200 OK{_EOL}Content-Type: text/html; charset=utf-8{_EOL}{_EOL}"
_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"


def _base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _is_utf8(column: pa.Array) -> bool:
    """Whether all values are well-formed (they are looked at where they are)."""
    try:
        column.cast(pa.string()).validate(full=True)
    except pa.ArrowInvalid:
        return False
    return True


def cut(payload: memoryview, limit: int = CHUNK_BYTES) -> Iterator[memoryview]:
    """Slices of a payload, each of at most ``limit`` bytes (and at most a character more), none of which forms the
    record delimiter with the line ends before and after it.  An empty payload is one empty slice."""
    mark, edge = _DELIMITER.encode(), _EOL.encode() * 2
    at, end = 0, len(payload)
    while True:
        stop = min(at + limit, end)
        while stop < end and payload[stop] & 0xC0 == 0x80:
            stop += 1
        # where the delimiter would come about, the cut goes through its version string
        if (found := (edge + bytes(payload[at:stop]) + edge).find(mark)) >= 0:
            stop = at + found + 4
        yield payload[at:stop]
        at = stop
        if at >= end:
            return


def chunk_records(pages: DataFrame, limit: int = CHUNK_BYTES) -> DataFrame:
    """Chunked record table of pages (page_id, url, html).

    Columns: record (identifier of the row, unique once the table is written), page_id, url (of the last chunk only),
    chunk_no, is_last, data, bytes_so_far and digest_so_far (base32 SHA-1 of the payload up to here).  A null html
    is an empty payload; one that is not UTF-8 is stored with U+FFFD in the place of what is malformed.
    """
    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held = 0
        for batch in batches:
            types = [pa.int64(), batch.schema.field("page_id").type, pa.string(), pa.int64(), pa.bool_(), pa.string(),
                     pa.int64(), pa.string()]
            keys = (batch.column(c).to_pylist() for c in ("record", "page_id", "url"))
            sound = _is_utf8(batch.column("html"))
            for value, record, page, url in zip(batch.column("html").cast(pa.binary()), *keys, strict=True):
                payload = memoryview(value.as_buffer() if value.is_valid else b"")
                if not sound:
                    payload = memoryview(bytes(payload).decode("utf-8", "replace").encode())
                digest, done = hashlib.sha1(usedforsecurity=False), 0
                for no, chunk in enumerate(cut(payload, limit)):
                    digest.update(chunk)
                    done += len(chunk)
                    last = done == len(payload)
                    rows.append((record, page, url if last else None, no, last, str(chunk, "utf-8"), done,
                                 _base32(digest.digest())))
                    held += len(chunk) + 100
                    if held > BATCH_BYTES:
                        yield _batch(rows, names, types)
                        rows, held = [], 0
        if rows:
            yield _batch(rows, names, types)

    names = ["record", "page_id", "url", "chunk_no", "is_last", "data", "bytes_so_far", "digest_so_far"]
    kind = pages.schema["page_id"].dataType.simpleString()
    return (pages.select(F.monotonically_increasing_id().alias("record"), "page_id",
                         F.col("url").cast("string").alias("url"), "html")
            .mapInArrow(stream, f"record long, page_id {kind}, url string, chunk_no long, is_last boolean, "
                                "data string, bytes_so_far long, digest_so_far string"))


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types, strict=True)], names=names)


def assign_records(chunks: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Response or revisit for each record of a written chunk table: (record, page_id, url, bytes, digest, record_id,
    refers_id); ``refers_id`` is null for responses.

    Of records with one payload digest, that with the largest page_id is the response (a null page_id only where all
    are null; of several rows with it, the first).  Only the rows of last chunks are read, without their data.
    """
    whole = chunks.where("is_last").select("record", "page_id", "url", F.col("bytes_so_far").alias("bytes"),
                                           F.col("digest_so_far").alias("digest"))
    by_page = whole.groupBy("digest", "page_id").agg(F.min("record").alias("first_record"))
    top = (by_page.groupBy("digest").agg(F.max("page_id").alias("top_page"))
           .withColumnRenamed("digest", "top_digest"))
    first = by_page.join(top, (F.col("digest") == F.col("top_digest"))
                         & F.col("page_id").eqNullSafe(F.col("top_page"))).select("top_digest", "first_record")
    stored = F.col("bytes") >= F.lit(min_bytes)
    return (whole.join(first, F.col("digest") == F.col("top_digest"))
            .select("record", "page_id", "url", "bytes", "digest", record_id(F.col("record")).alias("record_id"),
                    F.when(stored & (F.col("record") != F.col("first_record")),
                           record_id(F.col("first_record"))).alias("refers_id")))


def record_id(record: Column) -> Column:
    """Record identifier (a name-based UUID)."""
    h = F.md5(record.cast("string").cast("binary"))
    part = lambda a, n: F.substring(h, a, n)
    return F.concat(F.lit("<urn:uuid:"), part(1, 8), F.lit("-"), part(9, 4), F.lit("-3"), part(14, 3), F.lit("-8"),
                    part(18, 3), F.lit("-"), part(21, 12), F.lit(">"))


def _header(name: str, value: Column) -> Column:
    """One header line, empty where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), F.regexp_replace(value.cast("string"), r"[\r\n]", ""),
                               F.lit(_EOL)), F.lit(""))


def render(row: dict[str, Column], kind: Column, block: Column) -> Column:
    """Text of a WARC record without its very last line end (the text source writes that)."""
    lines = [F.lit(f"{_VERSION}{_EOL}"), _header("WARC-Type", kind),
             *(_header(name, value) for name, value in row.items()),
             _header("Content-Length", F.octet_length(block)), F.lit(_EOL), block, F.lit(_EOL)]
    return F.concat(*lines)


def write_archives(pages: DataFrame, path: str, limit: int = CHUNK_BYTES, date: str = "2020-01-01T00:00:00Z") -> str:
    """Write a record for each page; returns the folder of the archives (``path``/archives).

    The chunk table is written first (``path``/chunks), which fixes the record identifiers; the archives are made from
    it, so a lost task reads the table again.  It goes when the archives are complete.

    Defined cases: a null html is an empty payload; a null page_id is kept (no X-Page-Id line); repeated rows are
    separate records; line ends in a url are dropped; an empty table writes no records; only page_id, url and html
    are read, so other columns may have any name.
    """
    spark = pages.sparkSession
    chunk_records(pages, limit).write.option("compression", "zstd").parquet(f"{path}/chunks")
    table = spark.read.parquet(f"{path}/chunks")
    roles = assign_records(table)
    common = {"WARC-Record-ID": F.col("record_id"), "WARC-Date": F.lit(date),
              "WARC-Target-URI": F.coalesce("url", F.lit("urn:unknown")), "X-Page-Id": F.col("page_id"),
              "WARC-Payload-Digest": F.concat(F.lit("sha1:"), "digest")}
    revisits = roles.where(F.col("refers_id").isNotNull()).select(render(
        common | {"WARC-Refers-To": F.col("refers_id"), "WARC-Profile": F.lit(_PROFILE),
                  "Content-Type": F.lit("application/http; msgtype=response")},
        F.lit("revisit"), F.lit(_HTTP)).alias("value"))
    responses = roles.where(F.col("refers_id").isNull())
    chunks = table.select("record", "chunk_no", "is_last", "data").join(responses, "record")
    first, segmented = F.col("chunk_no") == 0, ~(F.col("is_last") & (F.col("chunk_no") == 0))
    own_id = F.when(first, F.col("record_id")).otherwise(
        F.concat(F.expr("substring(record_id, 1, char_length(record_id) - 1)"), F.lit("#"), "chunk_no", F.lit(">")))
    body = chunks.select(render(
        common | {"WARC-Record-ID": own_id,
                  "WARC-Segment-Number": F.when(segmented, F.col("chunk_no") + 1),
                  "WARC-Segment-Origin-ID": F.when(segmented & ~first, F.col("record_id")),
                  "WARC-Segment-Total-Length": F.when(segmented & F.col("is_last"),
                                                      F.col("bytes") + F.lit(len(_HTTP))),
                  "Content-Type": F.when(first, F.lit("application/http; msgtype=response"))},
        F.when(first, F.lit("response")).otherwise(F.lit("continuation")),
        F.when(first, F.concat(F.lit(_HTTP), "data")).otherwise(F.col("data"))).alias("value"))
    (body.unionByName(revisits).write.option("lineSep", _EOL).option("compression", "gzip")
     .text(f"{path}/archives"))
    delete_path(spark, f"{path}/chunks")
    return f"{path}/archives"


def _parse(text: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Records in a stretch of archive that starts at a record (with or without its version line)."""
    at, version = 0, f"{_VERSION}{_EOL}".encode()
    while at < len(text):
        if text.startswith(version, at):
            at += len(version)
        end = text.index(b"\r\n\r\n", at)
        headers = dict(line.split(": ", 1) for line in text[at:end].decode().split(_EOL))
        at = end + 4
        size = int(headers["Content-Length"])
        if at + size > len(text):
            raise ValueError(f"record {headers.get('WARC-Record-ID')} is cut short")
        yield headers, text[at:at + size]
        at += size
        while text[at:at + 2] == b"\r\n":
            at += 2


def read_archives(spark: SparkSession, path: str, page_type: str = "long") -> DataFrame:
    """Records read back: (page_id, payload_bytes, payload_digest, record_type, refers_to).

    Length and digest are taken from the payload bytes that were read; a revisit has those of the response that it
    names, found by record identifier.  The archives are unpacked, parsed and hashed once: the records found, without
    the payloads that are complete, are written to a table, and all that follows reads this table.
    """
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = len(_HTTP.encode())
        for batch in batches:
            rows: list[tuple] = []
            held = 0
            for text in batch.column("value").cast(pa.binary()):
                for headers, block in _parse(text.as_py()):
                    origin = headers.get("WARC-Segment-Origin-ID")
                    segment = int(headers.get("WARC-Segment-Number", 0))
                    kind = headers["WARC-Type"]
                    payload = block if kind == "continuation" else block[head:]
                    page = headers.get("X-Page-Id")
                    rows.append((origin or headers["WARC-Record-ID"], page, kind, headers.get("WARC-Refers-To"), segment,
                                 payload if segment else None, len(payload),
                                 _base32(hashlib.sha1(payload, usedforsecurity=False).digest())))
                    held += len(payload) if segment else 100
                    if held > BATCH_BYTES:
                        yield _batch(rows, names, types)
                        rows, held = [], 0
            if rows:
                yield _batch(rows, names, types)

    names = ["record_id", "page_id", "kind", "refers_id", "segment", "data", "payload_bytes", "payload_digest"]
    types = [pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.string()]
    lines = spark.read.schema("value string").option("lineSep", _DELIMITER).text(path)
    records = materialize(lines.where(F.length("value") > 0).mapInArrow(
        parse, "record_id string, page_id string, kind string, refers_id string, segment long, data binary, "
               "payload_bytes long, payload_digest string"), "warc-records")

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Join the segments of a record, which come in order, through one running digest."""
        current, page, digest, size = None, None, None, 0
        for batch in batches:
            out: list[tuple] = []
            for record, own_page, data in zip(batch.column("record_id").to_pylist(),
                                              batch.column("page_id").to_pylist(), batch.column("data"), strict=True):
                if record != current:
                    if current is not None:
                        out.append((current, page, size, _base32(digest.digest())))
                    current, page, digest, size = record, own_page, hashlib.sha1(usedforsecurity=False), 0
                chunk = data.as_buffer()
                digest.update(chunk)
                size += chunk.size
            if out:
                yield _responses(out)
        if current is not None:
            yield _responses([(current, page, size, _base32(digest.digest()))])

    single = records.where((F.col("segment") == 0) & (F.col("kind") == "response")).select(
        "record_id", "page_id", "payload_bytes", "payload_digest")
    joined = (records.where("segment > 0").select("record_id", "segment", "page_id", "data")
              .repartition("record_id").sortWithinPartitions("record_id", "segment")
              .mapInArrow(assemble, "record_id string, page_id string, payload_bytes long, payload_digest string"))
    responses = single.unionByName(joined)
    revisits = (records.where(F.col("kind") == "revisit").select("page_id", "refers_id").alias("v")
                .join(responses.alias("r"), F.col("v.refers_id") == F.col("r.record_id"), "left")
                .select("v.page_id", "r.payload_bytes", "r.payload_digest", F.lit("revisit").alias("record_type"),
                        F.col("r.page_id").alias("refers_to")))
    return (responses.select("page_id", "payload_bytes", "payload_digest", F.lit("response").alias("record_type"),
                             F.lit(None).cast("string").alias("refers_to"))
            .unionByName(revisits)
            .withColumns({c: F.col(c).cast(page_type) for c in ("page_id", "refers_to")}))


def _responses(rows: list[tuple]) -> pa.RecordBatch:
    return _batch(rows, ["record_id", "page_id", "payload_bytes", "payload_digest"],
                  [pa.string(), pa.string(), pa.int64(), pa.string()])


def op5_chunked_records(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    path = write_archives(pages, scratch_path(spark, f"warc-{uuid.uuid4().hex}"))
    return read_archives(spark, path, pages.schema["page_id"].dataType.simpleString())


OP5_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes,
    sha1(coalesce(html, '')) AS hex FROM pages
), d AS (
  SELECT *, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (
      (('0x' || substr(hex, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4)))  & 31)::INT, 1)), '') AS payload_digest,
    max(page_id) OVER (PARTITION BY hex) AS first_page,
    row_number() OVER (PARTITION BY hex ORDER BY page_id DESC NULLS LAST) AS k
  FROM p
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN k > 1 THEN first_page END AS refers_to
FROM d
"""
