"""WARC archives: writing captures, reading records, and assembling transactions.

A capture is written as three records. The request and the metadata record name the response
(or the revisit that stands for it) in ``WARC-Concurrent-To``. Reading gives one row a record;
:func:`assemble_captures` joins request and metadata records to their capture through the
concurrent-to identifiers, in either direction and also where a metadata record names the
request, and emits one nested row a capture.

Records are built by Spark expressions and written by Spark's own file writer, whose line
separator is the blank line that ends a record: the files are committed by the job, so lost
tasks leave nothing behind, and any file system that Spark reaches will do. Archives are read
whole, one file a row, hence a file is kept to about ``ARCHIVE_BYTES``; inside, records are
parsed one after the other by their length.

Defined results: a null payload is empty; a null identifier or address is left out of its
record and comes back as null; line breaks are taken out of addresses. Of equal payloads of at
least ``revisit_from`` bytes the row with the smallest identifier (null last; of equal ones,
any one) becomes the response and the others revisit it; all rows with smaller payloads are
responses. Repeated rows are captures of their own. Columns other than the three named ones
are not written.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from versemill.operators.joins import broadcast_if_small, lookup_join
from versemill.session import Staging, stage_table

ARCHIVE_BYTES = 32 << 20
LAST_ID = 2**63 - 1
DATE = "2024-01-01T00:00:00Z"
# Fixed values of the format.
VERSION = "WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEX_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BASE32_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
END = "\r\n"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in base 32: each five hexadecimal digits are four digits to the base 32."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, i, 5), 16, 32), 4, "0") for i in range(1, 41, 5)]
    return F.translate(F.upper(F.concat(*parts)), HEX_DIGITS, BASE32_DIGITS)


def _record_id(kind: str, row: Column) -> Column:
    digest = F.md5(F.concat_ws(":", F.lit(kind), row.cast("string")))
    cut = [F.substring(digest, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _lines(*fields: tuple[str, Column | None]) -> Column:
    """Header lines; a field whose value is null is left out."""
    shown = [F.concat(F.lit(f"{name}: "), value, F.lit(END)) for name, value in fields if value is not None]
    return F.concat_ws("", *shown)


def _record(kind: str | Column, block: Column, *fields: tuple[str, Column | None]) -> Column:
    """A record without the blank line that ends it."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    head = _lines(("WARC-Type", kind), *fields, ("Content-Length", F.octet_length(block).cast("string")))
    return F.concat(F.lit(VERSION + END), head, F.lit(END), block)


def capture_rows(pages: DataFrame, staging: Staging, id_col: str, url_col: str, payload_col: str, revisit_from: int) -> DataFrame:
    """``row, id, url, payload, digest, bytes, keep_row``: ``keep_row`` is set on revisits only."""
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = staging.table(
        pages.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_col).cast("long").alias("id"),
            F.regexp_replace(F.col(url_col).cast("string"), r"[\r\n]+", "").alias("url"),
            payload.alias("payload"),
        ).withColumns(
            {"digest": base32_sha1(F.col("payload")), "same": F.sha2("payload", 256), "bytes": F.octet_length("payload").cast("long")}
        )
    )
    first = F.min(F.struct(F.coalesce("id", F.lit(LAST_ID)).alias("at"), "row"))
    groups = (
        rows.where(F.col("bytes") >= revisit_from)
        .groupBy("same")
        .agg(first.alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("same", F.col("first.row").alias("keep_row"))
    )
    found = rows.join(broadcast_if_small(staging.table(groups)), "same", "left")
    return found.withColumn("keep_row", F.when(F.col("keep_row") != F.col("row"), F.col("keep_row"))).drop("same")


def capture_records(captures: DataFrame) -> DataFrame:
    """``record``: the text of each record of each capture."""
    row, url = F.col("row"), F.col("url")
    revisit = F.col("keep_row").isNotNull()
    capture_id = _record_id("capture", row)
    http = F.concat(
        F.lit("HTTP/1.1 200 OK" + END),
        _lines(("Content-Type", F.lit("text/html; charset=utf-8")), ("Content-Length", F.col("bytes").cast("string"))),
        F.lit(END),
    )
    common = (("WARC-Date", F.lit(DATE)), ("WARC-Target-URI", url))
    capture = _record(
        F.when(revisit, "revisit").otherwise("response"),
        F.when(revisit, http).otherwise(F.concat(http, F.col("payload"))),
        ("WARC-Record-ID", capture_id),
        *common,
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        ("WARC-Profile", F.when(revisit, SAME_PAYLOAD)),
        ("WARC-Refers-To", F.when(revisit, _record_id("capture", F.col("keep_row")))),
        ("Content-Type", F.lit("application/http;msgtype=response")),
    )
    request = _record(
        "request",
        F.concat(F.lit("GET "), F.coalesce(url, F.lit("*")), F.lit(" HTTP/1.1" + END + END)),
        ("WARC-Record-ID", _record_id("request", row)),
        *common,
        ("WARC-Concurrent-To", capture_id),
        ("Content-Type", F.lit("application/http;msgtype=request")),
    )
    metadata = _record(
        "metadata",
        _lines(("page-id", F.col("id").cast("string"))),
        ("WARC-Record-ID", _record_id("metadata", row)),
        *common,
        ("WARC-Concurrent-To", capture_id),
        ("Content-Type", F.lit("application/warc-fields")),
    )
    return captures.select(F.explode(F.array(request, capture, metadata)).alias("record"))


def write_archives(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", revisit_from: int = 0
) -> None:
    """One capture a row of ``pages``, in gzipped archives below ``path``."""
    with Staging(pages.sparkSession) as staging:
        captures = capture_rows(pages, staging, id_col, url_col, payload_col, revisit_from)
        mean = captures.agg(F.avg("bytes")).first()[0] or 0
        per_file = max(3, int(3 * ARCHIVE_BYTES / (mean + 1024)))
        capture_records(captures).write.option("lineSep", END + END).option("compression", "gzip").option("maxRecordsPerFile", per_file).text(path)


# --- reading ----------------------------------------------------------------------------

RECORD_SCHEMA = (
    "record_id string, type string, uri string, date string, concurrent_to array<string>, refers_to string, "
    "http_status int, fields map<string,string>, payload_bytes bigint, payload_digest string, digest_holds boolean"
)
_ARROW = pa.schema(
    [
        ("record_id", pa.string()),
        ("type", pa.string()),
        ("uri", pa.string()),
        ("date", pa.string()),
        ("concurrent_to", pa.list_(pa.string())),
        ("refers_to", pa.string()),
        ("http_status", pa.int32()),
        ("fields", pa.map_(pa.string(), pa.string())),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("digest_holds", pa.bool_()),
    ]
)


def header_lines(stream: io.BufferedIOBase) -> list[tuple[str, str]]:
    """``(lower-case name, value)`` of the lines up to a blank one."""
    fields = []
    while line := stream.readline().strip(b"\r\n"):
        name, _, value = line.decode("utf-8", "replace").partition(":")
        fields.append((name.strip().lower(), value.strip()))
    return fields


def records_of(content: bytes) -> Iterator[tuple[list[tuple[str, str]], bytes]]:
    """Header fields and block of each record of one archive, gzipped or not."""
    file = io.BytesIO(content)
    stream = io.BufferedReader(gzip.GzipFile(fileobj=file)) if content[:2] == b"\x1f\x8b" else file
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record starts with {line[:40]!r}")
        fields = header_lines(stream)
        length = int(dict(fields)["content-length"])
        block = stream.read(length)
        if len(block) != length:
            raise ValueError(f"a record ends after {len(block)} of {length} bytes")
        yield fields, block


def parsed(fields: list[tuple[str, str]], block: bytes) -> tuple[dict, bytes]:
    """One row of :func:`read_archives`, and the payload."""
    last = dict(fields)
    kind, media = last.get("warc-type"), last.get("content-type", "")
    row = {
        "record_id": last.get("warc-record-id"),
        "type": kind,
        "uri": last.get("warc-target-uri"),
        "date": last.get("warc-date"),
        "concurrent_to": [v for name, v in fields if name == "warc-concurrent-to"],
        "refers_to": last.get("warc-refers-to"),
        "payload_digest": last.get("warc-payload-digest", "").removeprefix("sha1:") or None,
    }
    stream = io.BytesIO(block)
    if media.startswith("application/http"):
        words = stream.readline().split()
        row["fields"] = header_lines(stream)
        payload = stream.read()
        if kind in ("response", "revisit"):
            row["http_status"] = int(words[1]) if len(words) > 1 and words[1].isdigit() else None
    else:
        row["fields"] = header_lines(stream) if media.startswith("application/warc-fields") else []
        payload = stream.read()
    row["payload_bytes"] = len(payload)
    if kind == "response":
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        row |= {"payload_digest": digest, "digest_holds": row["payload_digest"] in (None, digest)}
    elif kind == "revisit":  # what it revisits has the payload; its header tells the length
        told = dict(row["fields"]).get("content-length", "")
        row["payload_bytes"] = int(told) if told.isdigit() else None
    row["fields"] = list(dict(row["fields"]).items())
    return row, payload


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """One row a record of all archives below ``path``; digests of responses are computed anew."""
    schema = RECORD_SCHEMA + (", payload binary" if with_payload else "")
    arrow = _ARROW.append(pa.field("payload", pa.binary())) if with_payload else _ARROW

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for fields, block in records_of(content.as_buffer().to_pybytes()):
                    row, payload = parsed(fields, block)
                    rows.append(row | {"payload": payload} if with_payload else row)
                    held += len(payload) if with_payload else 0
                    if len(rows) == 2000 or held > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                        rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(parse, schema)


def assemble_captures(records: DataFrame) -> DataFrame:
    """One nested row a capture: the response or revisit with its ``requests`` and ``metadata``.

    ``records`` is read several times, so it should be a staged table.
    """
    is_capture = F.col("type").isin("response", "revisit")
    captures = records.where(is_capture)
    named = F.explode("concurrent_to")
    companions = records.where(F.col("type").isin("request", "metadata"))
    forward = companions.select(F.col("record_id").alias("member"), named.alias("capture"))
    backward = captures.select(named.alias("member"), F.col("record_id").alias("capture"))
    known = captures.select(F.col("record_id").alias("capture"))
    direct = forward.join(known, "capture").select("member", "capture").unionByName(backward)
    # A metadata record may name the request instead of the response.
    through = forward.select("member", F.col("capture").alias("via")).join(
        direct.select(F.col("member").alias("via"), "capture"), "via"
    )
    links = direct.unionByName(through.select("member", "capture")).distinct()
    what = F.struct("record_id", "uri", "date", "fields")
    beside = (
        links.join(companions, links["member"] == companions["record_id"])
        .groupBy("capture")
        .agg(
            F.collect_list(F.when(F.col("type") == "request", what)).alias("requests"),
            F.collect_list(F.when(F.col("type") == "metadata", what)).alias("metadata"),
        )
    )
    extra = [c for c in ("payload",) if c in records.columns]
    return captures.join(beside, captures["record_id"] == beside["capture"], "left").select(
        "record_id", "type", "uri", "date", "http_status", F.col("fields").alias("http_headers"), "refers_to",
        "payload_bytes", "payload_digest", "digest_holds", *extra, "requests", "metadata",
    )


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", revisit_from: int = 0) -> DataFrame:
    """``pages`` written to archives, read back and assembled: one nested row a page.

    To the columns of :func:`assemble_captures` come ``page_id``, and for revisits ``refers_to_page``.
    """
    spark = pages.sparkSession
    with Staging(spark) as staging:
        path = staging.path()
        write_archives(pages, path, id_col, url_col, payload_col, revisit_from)
        records = staging.table(read_archives(spark, path))
        page = F.element_at(F.col("metadata")[0]["fields"], "page-id").cast("long")
        captures = staging.table(assemble_captures(records).withColumn("page_id", page))
        # Only revisits look for their response; one that very many name is salted.
        originals = captures.where("type = 'response'").select(
            F.col("record_id").alias("refers_to"), F.col("page_id").alias("refers_to_page")
        )
        revisits = captures.where("refers_to IS NOT NULL")
        named = staging.table(revisits.select("record_id", "refers_to"))
        asked = originals.join(broadcast_if_small(staging.table(named.select("refers_to").distinct())), "refers_to", "left_semi")
        found = lookup_join(named, asked, "refers_to", "record_id").drop("refers_to")
        others = captures.where("refers_to IS NULL").withColumn("refers_to_page", F.lit(None).cast("long"))
        return stage_table(others.unionByName(revisits.join(broadcast_if_small(staging.table(found)), "record_id")))
