"""WARC archives: writing captures, reading records back, and assembling transactions.

A capture is three records: its request, its response (or a revisit, where another capture
has the same payload) and a metadata record; request and metadata name the response as
concurrent. Records are composed in DataFrame functions and written by Spark's text writer
with the format's own record separator as line separator, gzipped: any file system, and no
part of a lost or repeated task. Reading takes files as Spark's binary source gives them
and inflates and splits them as a stream; ``records_per_file`` bounds their size.

Transactions are the records that reach each other through concurrent-to identifiers; each
capture becomes one row with its requests and metadata nested.

Null html is an empty payload; null urls have no target header. Pages with a null id are
captures like others, named by url and payload. Rows equal in id and payload share their
record ids; each still becomes a row, and equal requests and metadata are nested once.
An empty table gives no rows; columns other than the named ones are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow.llm.graph import components
from salesflow.session import cut, scratch_path

LEAST_REVISIT_BYTES = 100
RECORDS_PER_FILE = 30_000
DATE = "2024-01-01T00:00:00Z"
SEPARATOR = "\r\n\r\n"
BROADCAST_DIGESTS = 100_000
CHUNK = 1 << 20
# Fixed value: the profile of the WARC standard for payloads already stored.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

FIELDS = (
    "type string, record_id string, concurrent_to string, refers_to string, target_uri string, "
    "payload_digest string, payload_bytes bigint, payload_sha256 string, fields string"
)


def urn(*parts: Column) -> Column:
    """A record id made from a hash of the parts."""
    h = F.md5(F.concat_ws("\x1f", *parts))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in cuts]), F.lit(">"))


def record(headers: dict[str, Column], block: Column) -> Column:
    """One record without its separator; headers that are null are left out."""
    lines = [
        F.concat(F.lit(f"{name}: "), F.regexp_replace(value, r"[\x00-\x1F\x7F]", " "))
        for name, value in (headers | {"Content-Length": F.octet_length(block).cast("string")}).items()
    ]
    head = F.concat_ws("\r\n", F.lit("WARC/1.1"), *lines)
    return F.concat(head, F.lit(SEPARATOR), block)


def captures(df: DataFrame, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(id, url, html, digest, bytes, own, first): pages with record ids and what they revisit.

    ``first`` is the record id of the page with the smallest id and this payload, where that
    is another page. Digests are counted before the pages meet them.
    """
    pages = df.select(
        F.col(id).alias("id"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html")
    ).withColumns({"digest": F.sha2("html", 256), "bytes": F.octet_length("html").cast("bigint")})
    repeated = cut(
        pages.where(F.col("bytes") >= LEAST_REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .where((F.col("n") > 1) & F.col("first_id").isNotNull())
        .select(F.col("digest").alias("same"), "first_id")
    )
    side = F.broadcast(repeated) if repeated.count() <= BROADCAST_DIGESTS else repeated
    another = F.col("first_id").isNotNull() & ~F.col("id").eqNullSafe(F.col("first_id"))
    named = F.coalesce(F.col("id").cast("string"), F.concat(F.lit("url "), F.coalesce("url", F.lit(""))))
    return pages.join(side, F.col("digest") == F.col("same"), "left").select(
        "id", "url", "html", "digest", "bytes",
        urn(F.lit("response"), named, F.col("digest")).alias("own"),
        F.when(another, urn(F.lit("response"), F.col("first_id").cast("string"), F.col("digest"))).alias("first"),
    )


def write(pages: DataFrame, path: str, records_per_file: int = RECORDS_PER_FILE, date: str = DATE) -> None:
    """Write the records of ``captures`` to gzipped files in a folder."""
    own, first = F.col("own"), F.col("first")
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("bytes").cast("string"),
        F.lit(SEPARATOR),
    )
    host = F.regexp_extract("url", "://([^/?#]*)", 1)
    path_of = F.regexp_extract("url", "://[^/?#]*([^#]*)", 1)
    common = {"WARC-Date": F.lit(date), "WARC-Target-URI": F.col("url")}
    response = record(
        {
            "WARC-Type": F.when(first.isNull(), "response").otherwise("revisit"),
            "WARC-Record-ID": own,
            **common,
            "WARC-Payload-Digest": F.concat(F.lit("sha256:"), "digest"),
            "WARC-Refers-To": first,
            "WARC-Profile": F.when(first.isNotNull(), PROFILE),
            "Content-Type": F.lit("application/http;msgtype=response"),
        },
        F.when(first.isNull(), F.concat(http, "html")).otherwise(http),
    )
    request = record(
        {
            "WARC-Type": F.lit("request"),
            "WARC-Record-ID": urn(F.lit("request"), own),
            **common,
            "WARC-Concurrent-To": own,
            "Content-Type": F.lit("application/http;msgtype=request"),
        },
        F.concat(
            F.lit("GET "), F.when(path_of.startswith("/"), path_of).otherwise(F.concat(F.lit("/"), F.coalesce(path_of, F.lit("")))),
            F.lit(" HTTP/1.1\r\nHost: "), F.coalesce(host, F.lit("")), F.lit(SEPARATOR),
        ),
    )
    metadata = record(
        {
            "WARC-Type": F.lit("metadata"),
            "WARC-Record-ID": urn(F.lit("metadata"), own),
            **common,
            "WARC-Concurrent-To": own,
            "Content-Type": F.lit("application/json"),
        },
        F.to_json(F.struct("id", "url", F.col("bytes").alias("payload_bytes"))),
    )
    (
        pages.select(F.explode(F.array(request, response, metadata)).alias("value"))
        .write.option("lineSep", SEPARATOR)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", records_per_file)
        .text(path)
    )


class _Stream:
    """Bytes of a file, inflated as they are asked for; files of several gzip members too."""

    def __init__(self, content: bytes):
        self.rest = memoryview(content)
        self.gzip = content[:2] == b"\x1f\x8b"
        self.inflate = zlib.decompressobj(31) if self.gzip else None
        self.buffer = bytearray()

    def more(self) -> bool:
        if not self.rest.nbytes:
            return False
        part, self.rest = self.rest[:CHUNK], self.rest[CHUNK:]
        if not self.gzip:
            self.buffer += part
            return True
        while part.nbytes:
            self.buffer += self.inflate.decompress(part)
            part = memoryview(self.inflate.unused_data)
            if part.nbytes:
                self.inflate = zlib.decompressobj(31)
        return True

    def until(self, mark: bytes) -> bytes | None:
        """What comes before the next mark, which is taken too; None at the end."""
        seen = 0
        while (at := self.buffer.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self.buffer)
            if not self.more():
                return None
        out = bytes(self.buffer[:at])
        del self.buffer[: at + len(mark)]
        return out

    def take(self, n: int) -> bytes:
        while len(self.buffer) < n and self.more():
            pass
        out = bytes(self.buffer[:n])
        del self.buffer[:n]
        return out


def parse(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of a file; header names in lower case."""
    stream = _Stream(content)
    while (head := stream.until(b"\r\n\r\n")) is not None:
        lines = head.decode("utf-8", "replace").strip().split("\r\n")
        pairs = [line.partition(":") for line in lines[1:]]
        headers: dict[str, str] = {}
        for a, _, c in pairs:
            name, value = a.strip().lower(), c.strip()
            # The one header that may be repeated; identifiers hold no spaces.
            again = name == "warc-concurrent-to" and name in headers
            headers[name] = f"{headers[name]} {value}" if again else value
        size = int(headers["content-length"])
        block = stream.take(size)
        if len(block) < size:
            raise ValueError("a record ends too early")
        yield headers, block
        stream.take(len(SEPARATOR))


def read(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """All records of a folder of archives; size and hash are those of the payload as stored.

    ``concurrent_to`` holds all identifiers a record names, with spaces between them;
    ``fields`` is the block of metadata records. With ``payloads`` the payload comes along.
    """
    schema = FIELDS + (", payload binary" if payloads else "")
    names = [f.split()[0] for f in schema.split(", ")]
    kinds = [pa.int64() if n == "payload_bytes" else pa.binary() if n == "payload" else pa.string() for n in names]

    def row(headers: dict[str, str], block: bytes) -> tuple:
        kind = headers["warc-type"]
        http = headers.get("content-type", "").startswith("application/http")
        payload = block.partition(b"\r\n\r\n")[2] if http else block
        return (
            kind,
            headers.get("warc-record-id"),
            headers.get("warc-concurrent-to"),
            headers.get("warc-refers-to"),
            headers.get("warc-target-uri"),
            headers.get("warc-payload-digest", "").removeprefix("sha256:") or None,
            len(payload),
            hashlib.sha256(payload).hexdigest(),
            block.decode("utf-8", "replace") if kind == "metadata" else None,
            *([payload] if payloads else []),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            for k in range(len(batch)):
                rows, size = [], 0
                for headers, block in parse(batch.column(0)[k].as_py()):
                    rows.append(row(headers, block))
                    size += len(block) if payloads else 200
                    if size >= 8 * CHUNK:
                        yield flush()
                        rows, size = [], 0
                if rows:
                    yield flush()

    found = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return found.where(F.col("length") > 0).select("content").mapInArrow(run, schema)


def assemble(records: DataFrame) -> DataFrame:
    """(transaction, capture, requests, metadata): one row per response or revisit record.

    Records that name each other over several steps are followed to the end. Requests and
    metadata without a capture make a row with a null capture. Only headers are grouped,
    never payloads.
    """
    named = records.where(F.col("concurrent_to").isNotNull())
    links = named.select("record_id", F.explode(F.split("concurrent_to", " ")).alias("concurrent_to"))
    ahead = links.select(F.col("record_id").alias("concurrent_to"))
    several = named.where(F.col("concurrent_to").contains(" "))
    if several.isEmpty() and links.join(ahead, "concurrent_to", "left_semi").isEmpty():
        keyed = records.withColumn("transaction", F.coalesce("concurrent_to", "record_id"))
    else:
        roots = components(links, "record_id", "concurrent_to").withColumnRenamed("id", "record_id")
        keyed = records.join(roots, "record_id", "left").withColumn("transaction", F.coalesce("root", "record_id")).drop("root")
    is_capture = F.col("type").isin("response", "revisit")
    held = keyed.where(is_capture).select("transaction", F.struct(*records.columns).alias("capture"))
    light = F.struct("record_id", "target_uri", "payload_bytes", "fields")
    others = keyed.where(~is_capture).groupBy("transaction").agg(
        F.collect_set(F.when(F.col("type") == "request", light)).alias("requests"),
        F.collect_set(F.when(F.col("type") == "metadata", light)).alias("metadata"),
    )
    return held.join(others, "transaction", "full")


def round_trip(df: DataFrame, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(id, url, payload_bytes, payload_digest, record_type, refers_to) of every page, from its records.

    A revisit's size and digest are those of the response it refers to.
    """
    spark = df.sparkSession
    kind = dict(df.dtypes)[id]
    path = scratch_path(spark, "warc")
    write(captures(df, id, url, html), path)
    rows = assemble(cut(read(spark, path)))
    known = F.from_json(F.col("metadata")[0]["fields"], f"id {kind}, url string")
    pages = rows.select("capture.*", known.alias("known")).select(
        "type", "record_id", "refers_to", "payload_bytes", "payload_sha256", F.col("known.id").alias("id"), F.col("known.url").alias("url")
    )
    targets = pages.where(F.col("type") == "response").groupBy(F.col("record_id").alias("refers_to")).agg(
        F.min("id").alias("target"), F.max("payload_bytes").alias("size"), F.min("payload_sha256").alias("sha")
    )
    revisit = F.col("type") == "revisit"
    return pages.join(cut(targets), "refers_to", "left").select(
        F.col("id").alias(id),
        F.col("url").alias(url),
        F.when(revisit, F.col("size")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(revisit, F.col("sha")).otherwise(F.col("payload_sha256")).alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.when(revisit, F.col("target")).alias("refers_to"),
    )
