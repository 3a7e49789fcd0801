"""WARC archives: a native writer and a Python data source that reads headers first.

Writing needs no Python: a record is a line of Spark's text writer, whose line separator is
the blank lines that end a record, so archives go to any file system that Spark can write.

Reading: each archive file is a partition (small ones share one). The reader parses a
record's header block and applies the pushed record-type and header predicates; the block of
a record that fails them is passed over unread, and a payload is only read, hashed or decoded
as the option ``payload`` asks.
"""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    StringStartsWith,
)

from weftline.llm.common import beside, new_path, ship, stored, with_row_id
from weftline.llm.files import FilePack, open_file, pack_files

END = "\r\n\r\n"
PAGE_URN = "urn:weftline:page:"
#: Payloads shorter than this are always stored.
LEAST_SHARED = 100

SCHEMA = (
    "record_id string, record_type string, page_id bigint, target_uri string, "
    "refers_to bigint, content_type string, content_length bigint, header_digest string, "
    "header_payload_bytes bigint, payload_bytes bigint, payload_digest string, payload binary"
)
_ARROW = pa.schema(
    [
        ("record_id", pa.string()),
        ("record_type", pa.string()),
        ("page_id", pa.int64()),
        ("target_uri", pa.string()),
        ("refers_to", pa.int64()),
        ("content_type", pa.string()),
        ("content_length", pa.int64()),
        ("header_digest", pa.string()),
        ("header_payload_bytes", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("payload", pa.binary()),
    ]
)
#: Columns known from the header block alone.
HEADER_COLUMNS = frozenset(_ARROW.names[:9])


# ---------------------------------------------------------------- writing


def mark_revisits(pages: DataFrame) -> DataFrame:
    """Add ``payload``, ``digest``, ``first_id`` and ``is_revisit`` to (page_id, url, html).

    Of equal payloads of ``LEAST_SHARED`` bytes or more the smallest page_id is the response
    and other page_ids revisit it. Rows that repeat that page_id are responses too; a null
    page_id revisits if the group has an id. Digests and the revisits' places move, payloads
    do not as long as the list of revisits is small enough to be broadcast.
    """
    payload = F.encode(F.coalesce("doc.html", F.lit("")), "UTF-8")
    rows = with_row_id(pages).select(
        "row_file", "row_no", F.col("doc.page_id").cast("long").alias("page_id"), "doc.url",
        payload.alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    narrow = rows.where(F.octet_length("payload") >= LEAST_SHARED).select(
        "row_file", "row_no", "page_id", F.unhex("digest").alias("key")
    )
    narrow = stored(narrow, "payload-digests")
    firsts = (
        narrow.groupBy("key")
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
        .drop("copies")
    )
    other = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    revisits = narrow.join(firsts, "key").where(other).select("row_file", "row_no", "first_id")
    revisits = stored(revisits, "revisits")
    found = beside(rows, revisits, 32 * revisits.count(), "left")
    return found.withColumn("is_revisit", F.col("first_id").isNotNull())


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing for null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def record_text(rows: DataFrame) -> DataFrame:
    """One column ``value``: whole records without the blank lines that end them."""
    size = F.octet_length("payload")
    length = size.cast("string")
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        length,
        F.lit(END),
    )
    revisit = F.col("is_revisit")
    kept = F.when(revisit, F.lit("")).otherwise(F.col("payload").cast("string"))
    block = F.octet_length(http) + F.when(revisit, 0).otherwise(size)
    # A header value ends at a line break.
    url = F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")
    ident = F.coalesce(F.col("page_id").cast("string"), F.lit("none"))
    value = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "),
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\n"),
        _line("WARC-Record-ID", F.concat(F.lit(f"<{PAGE_URN}"), ident, F.lit(">"))),
        F.lit("WARC-Date: 1970-01-01T00:00:00Z\r\n"),
        _line("WARC-Target-URI", url),
        F.when(
            revisit,
            F.lit(
                "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n"
            ),
        ).otherwise(F.lit("")),
        F.when(
            revisit,
            _line("WARC-Refers-To", F.concat(F.lit(f"<{PAGE_URN}"), F.col("first_id"), F.lit(">"))),
        ).otherwise(F.lit("")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        _line("X-Payload-Length", length),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        _line("Content-Length", block.cast("string")),
        F.lit("\r\n"),
        http,
        kept,
    )
    return rows.select(value.alias("value"))


def write_warc(pages: DataFrame, path: str, compression: str = "none") -> None:
    """Write (page_id, url, html) as WARC files, one per task, each within one row's memory."""
    lines = record_text(mark_revisits(pages))
    lines.write.text(path, lineSep=END, compression=compression)


# ---------------------------------------------------------------- reading


def _test(f: Filter):
    """(column, test of a value) of a filter that the header decides, else None.
    A comparison with null is not true."""
    name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
    if name not in HEADER_COLUMNS:
        return None
    tests = {
        EqualTo: lambda x: x is not None and x == f.value,
        In: lambda x: x is not None and x in f.value,
        GreaterThan: lambda x: x is not None and x > f.value,
        GreaterThanOrEqual: lambda x: x is not None and x >= f.value,
        LessThan: lambda x: x is not None and x < f.value,
        LessThanOrEqual: lambda x: x is not None and x <= f.value,
        StringStartsWith: lambda x: x is not None and x.startswith(f.value),
        IsNull: lambda x: x is None,
        IsNotNull: lambda x: x is not None,
    }
    test = tests.get(type(f))
    return (name, test) if test else None


def _page(urn: str | None) -> int | None:
    ident = (urn or "").strip("<>").removeprefix(PAGE_URN)
    return int(ident) if ident.lstrip("-").isdigit() else None


def parse_headers(block: bytes) -> dict[str, str]:
    """Header lines by lower-case name; a line that starts blank goes on with the one before."""
    out: dict[str, str] = {}
    name = ""
    for line in block.decode("utf-8", "replace").split("\r\n"):
        if line[:1] in (" ", "\t") and name:
            out[name] += " " + line.strip()
        elif ":" in line:
            name, _, value = line.partition(":")
            name = name.strip().lower()
            out[name] = value.strip()
    return out


def _header_block(stream) -> bytes:
    """Bytes up to the blank line, which is read too."""
    lines = []
    while (line := stream.readline()) not in (b"\r\n", b""):
        lines.append(line)
    return b"".join(lines)


def read_records(stream, tests: list, payload: str) -> Iterator[dict]:
    """Records of an archive that pass all header tests, in file order.

    ``stream`` is a buffered binary file that can seek. Blocks that are not needed are
    skipped by seeking. A torn record raises ``ValueError``.
    """
    while True:
        line = stream.readline()
        while line in (b"\r\n", b"\n"):
            line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record at byte {stream.tell() - len(line)}")
        h = parse_headers(_header_block(stream))
        length = int(h["content-length"])
        digest = h.get("warc-payload-digest", "")
        record = {
            "record_id": h.get("warc-record-id"),
            "record_type": h.get("warc-type"),
            "page_id": _page(h.get("warc-record-id")),
            "target_uri": h.get("warc-target-uri"),
            "refers_to": _page(h.get("warc-refers-to")),
            "content_type": h.get("content-type"),
            "content_length": length,
            "header_digest": digest.partition(":")[2].lower() or None,
            "header_payload_bytes": int(h["x-payload-length"]) if "x-payload-length" in h else None,
            "payload_bytes": None,
            "payload_digest": None,
            "payload": None,
        }
        passed = all(test(record[name]) for name, test in tests)
        if not passed or payload == "none":
            stream.seek(length, 1)
            if passed:
                yield record
            continue
        block = stream.read(length)
        if len(block) != length:
            raise ValueError(f"record {record['record_id']} ends early")
        if (record["content_type"] or "").startswith("application/http"):
            block = block.partition(b"\r\n\r\n")[2]
        if record["record_type"] != "revisit":
            record["payload_bytes"] = len(block)
            record["payload_digest"] = hashlib.sha256(block).hexdigest()
            if payload == "binary":
                record["payload"] = block
        yield record


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path = options["path"]
        self.payload = options.get("payload", "digest")
        if self.payload not in ("none", "digest", "binary"):
            raise ValueError("payload is none, digest or binary")
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            if _test(f):
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        return pack_files(self.path)

    def read(self, partition: FilePack) -> Iterator[pa.RecordBatch]:
        tests = [_test(f) for f in self.filters]
        rows: list[dict] = []
        held = 0
        for path in partition.paths:
            with open_file(self.path, path) as stream:
                source = gzip.GzipFile(fileobj=stream) if path.endswith(".gz") else stream
                for record in read_records(source, tests, self.payload):
                    rows.append(record)
                    held += len(record["payload"] or b"") + 500
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)


class WarcSource(DataSource):
    """``format("warc")`` with the options ``path`` and ``payload`` (none, digest, binary)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(dict(self.options))


def read_warc(spark: SparkSession, path: str, payload: str = "digest") -> DataFrame:
    """Records of the archives below ``path``.

    Filters on header columns reach the reader, for which Spark's pushdown to Python sources
    has to be on; this turns it on in the session. ``payload_bytes`` and ``payload_digest``
    are measured on what the archive holds and null for a revisit, or with payload ``none``.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").option("path", path).option("payload", payload).load()


def archive_digest(pages: DataFrame) -> DataFrame:
    """Write the pages as archives in the shared folder, and read back per page:
    ``page_id, payload_bytes, payload_digest, record_type, refers_to``.

    Null html is an empty payload. A response's size and digest are measured on the payload
    read back; a revisit, which has none, gives those of its header.
    """
    spark = pages.sparkSession
    path = new_path(spark, "warc")
    write_warc(pages, path)
    return read_warc(spark, path).select(
        "page_id",
        F.coalesce("payload_bytes", "header_payload_bytes").alias("payload_bytes"),
        F.coalesce("payload_digest", "header_digest").alias("payload_digest"),
        "record_type",
        "refers_to",
    )


ship(__name__)
