"""Web archives: writing captures as WARC records and assembling them back.

A capture is a transaction of three records: the response (or a revisit of an
equal payload), the request, and a metadata record. The latter two name the
record they belong to in ``WARC-Concurrent-To``.

Writing is native: each record is one string, and Spark's text writer ends it
with the two line breaks that the format asks for, so the part files are
compressed WARC 1.0 files in whatever store Spark writes to. Reading takes whole
files (``binaryFile``) and frames records by their Content-Length in Arrow
batches; ``records_per_file`` bounds a file. Assembly joins on record ids.

Scale. Which record is the response of equal payloads is decided on digests
alone (map-side combined maximum, so a payload shared by a third of all pages
is one row); the pages themselves are shuffled once, by (digest, page), which
splits a hot payload by page.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderflow.llm.common import written
from orderflow.session import scratch_path, ship_package

#: RFC 4648 base-32 alphabet (fixed value).
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_END = "\r\n\r\n"
_DATE = "2000-01-01T00:00:00Z"


def sha1_base32(binary: Column) -> Column:
    """Bare upper-case base-32 SHA-1, by native expressions."""
    digest = F.sha1(binary)
    symbols = []
    for group in range(8):  # five hexadecimal digits are four symbols
        bits = F.conv(F.substring(digest, group * 5 + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            at = (F.shiftright(bits, shift).bitwiseAND(F.lit(31)) + 1).cast("int")
            symbols.append(F.lit(_BASE32).substr(at, F.lit(1)))
    return F.concat(*symbols)


def _record_id(kind: str) -> Column:
    h = F.md5(F.concat_ws("/", F.lit(kind), F.coalesce(F.col("page_id").cast("string"), F.lit("-")),
                          F.col("digest"), F.col("nth").cast("string")).cast("binary"))
    return F.concat(F.lit("<urn:uuid:"), *[x for k, (a, n) in enumerate(((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
                                           for x in ([F.lit("-")] if k else []) + [F.substring(h, a, n)]], F.lit(">"))


def _record(kind: str, headers: list[tuple[str, Column]], block: Column) -> Column:
    """One record without its closing line breaks; a header whose value is null is left out."""
    lines = [F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")) for name, value in headers]
    return F.concat(F.lit(f"WARC/1.0\r\nWARC-Type: {kind}\r\n"),
                    *[F.coalesce(x, F.lit("")) for x in lines],
                    F.lit("Content-Length: "), F.octet_length(block.cast("binary")).cast("string"),
                    F.lit(_END), block)


def write_warc(pages: DataFrame, path: str, min_payload: int = 0, records_per_file: int = 3000) -> None:
    """Write a request, a response or revisit, and a metadata record for each page.

    Among pages with equal payloads of at least ``min_payload`` bytes, the one
    with the largest page_id keeps the payload (response) and the others
    revisit it. Null html is the empty payload; null page ids sort lowest; of
    repeated rows of one page one is the response; line breaks in a url are
    blanked, a null url leaves the header out; extra columns are ignored.
    """
    body = F.coalesce(F.col("html"), F.lit(""))
    src = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                       body.alias("html"), sha1_base32(body.cast("binary")).alias("digest"),
                       F.octet_length(body.cast("binary")).cast("long").alias("size"))
    narrow = written(src.select("page_id", "digest").distinct(), "digests")
    # page ids order as (is there one, id): a null id is the lowest
    order = F.struct(F.col("page_id").isNotNull().alias("has"), F.col("page_id").alias("id"))
    best = narrow.groupBy("digest").agg(F.max(order).alias("best"))
    # null-safe key columns, the same for join and window: one shuffle of the pages serves both
    key = [F.col("page_id").isNull().alias("no_id"), F.coalesce("page_id", F.lit(0)).alias("id")]
    chosen = narrow.join(best, "digest").select(*key, "digest", F.col("best.id").alias("original"))
    nth = F.row_number().over(Window.partitionBy("no_id", "id", "digest").orderBy("url"))
    rows = src.select("*", *key).join(chosen, ["no_id", "id", "digest"]).withColumn("nth", nth)
    is_response = (F.col("size") < min_payload) | (F.col("page_id").eqNullSafe(F.col("original")) & (F.col("nth") == 1))
    rows = rows.withColumn("response", is_response)

    own = _record_id("response")
    original = F.md5(F.concat_ws("/", F.lit("response"), F.coalesce(F.col("original").cast("string"), F.lit("-")),
                                 F.col("digest"), F.lit("1")).cast("binary"))
    original = F.regexp_replace(original, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "<urn:uuid:$1-$2-$3-$4-$5>")
    uri = F.regexp_replace(F.col("url"), "[\r\n]+", " ")
    date = ("WARC-Date", F.lit(_DATE))
    payload = ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest")))
    http = ("Content-Type", F.lit("application/http; msgtype=response"))
    status = F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n")
    response = _record("response", [("WARC-Record-ID", own), date, ("WARC-Target-URI", uri), payload, http],
                       F.concat(status, F.col("html")))
    revisit = _record("revisit", [
        ("WARC-Record-ID", own), date, ("WARC-Target-URI", uri), payload,
        ("WARC-Profile", F.lit("http://netpreserve.org/warc/1.0/revisit/identical-payload-digest")),
        ("WARC-Refers-To", original), http], status)
    request = _record("request", [("WARC-Record-ID", _record_id("request")), date, ("WARC-Target-URI", uri),
                                  ("WARC-Concurrent-To", own),
                                  ("Content-Type", F.lit("application/http; msgtype=request"))],
                      F.concat(F.lit("GET "), F.coalesce(uri, F.lit("/")), F.lit(" HTTP/1.1\r\n\r\n")))
    metadata = _record("metadata", [("WARC-Record-ID", _record_id("metadata")), date, ("WARC-Target-URI", uri),
                                    ("WARC-Concurrent-To", own),
                                    ("Content-Type", F.lit("application/warc-fields"))],
                       F.concat(F.lit("page-id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit("\r\n")))
    record = F.explode(F.array(request, F.when(F.col("response"), response).otherwise(revisit), metadata))
    rows.select(record.alias("value")).write.option("lineSep", _END) \
        .option("maxRecordsPerFile", records_per_file).option("compression", "gzip").text(path)


RECORDS = ("warc_type string, record_id string, concurrent_to string, refers_to string, target_uri string, "
           "declared_digest string, payload_bytes long, payload_digest string, page_id long, payload binary")


def _frames(content) -> Iterator[tuple[dict, bytes]]:
    """(headers, block) of each record of an archive, plain or compressed, framed by Content-Length."""
    raw = bytes(content)
    if raw.startswith(b"\x1f\x8b"):
        raw = gzip.decompress(raw)
    at = 0
    while at < len(raw):
        if raw.startswith(b"\r\n", at):
            at += 2
            continue
        end = raw.find(b"\r\n\r\n", at)
        if end < 0 or not raw.startswith(b"WARC/", at):
            raise ValueError(f"no WARC record at byte {at}")
        headers = {}
        for line in raw[at:end].split(b"\r\n")[1:]:
            name, _, value = line.partition(b":")
            headers[name.strip().lower().decode()] = value.strip().decode("utf-8", "replace")
        begin = end + 4
        stop = begin + int(headers["content-length"])
        if stop > len(raw):
            raise ValueError(f"record at byte {at} is cut off")
        yield headers, raw[begin:stop]
        at = stop


def _parser(keep_payload: bool):
    def parse(batches):
        names = [c.split()[0] for c in RECORDS.split(", ")]
        types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
        schema = pa.schema([(c.split()[0], types[c.split()[1]]) for c in RECORDS.split(", ")])
        for batch in batches:
            for content in batch.column("content"):
                out, held = [], 0
                for headers, block in _frames(content.as_buffer()):
                    kind = headers.get("warc-type")
                    payload = page = None
                    if kind == "response":
                        payload = block.partition(b"\r\n\r\n")[2] if headers.get("content-type", "").startswith("application/http") else block
                    elif kind == "metadata":
                        fields = dict(x.split(": ", 1) for x in block.decode("utf-8", "replace").split("\r\n") if ": " in x)
                        page = int(fields["page-id"]) if fields.get("page-id") else None
                    out.append((kind, headers.get("warc-record-id"), headers.get("warc-concurrent-to"),
                                headers.get("warc-refers-to"), headers.get("warc-target-uri"),
                                (headers.get("warc-payload-digest") or "").rpartition(":")[2] or None,
                                None if payload is None else len(payload),
                                None if payload is None else base64.b32encode(hashlib.sha1(payload).digest()).decode(),
                                page, payload if keep_payload else None))
                    held += len(block) if keep_payload else 0
                    if len(out) >= 5000 or held > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], names)
                        out, held = [], 0
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], names)
    return parse


def read_warc(spark: SparkSession, path: str, keep_payload: bool = True) -> DataFrame:
    """The records of the archives under ``path``; payload digests and lengths are those of the bytes read."""
    ship_package(spark)
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(_parser(keep_payload), RECORDS)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``capture_id, response, request, metadata``.

    Requests and metadata find their capture through Concurrent-To, directly or
    through one other record (a metadata record that names the request).
    ``original`` is left for :func:`resolve_revisits`. A capture without request
    or metadata has null there, and of several the one with the smallest record
    id; records that lead to no response or revisit are left out; a null
    Concurrent-To leads nowhere. ``records`` is read several times: a written
    table serves best.
    """
    main = F.col("warc_type").isin("response", "revisit")
    side = F.struct("record_id", "target_uri", "page_id")
    response = F.struct("warc_type", "record_id", "target_uri", "refers_to", "declared_digest",
                        "payload_bytes", "payload_digest", *(["payload"] if "payload" in records.columns else []))
    groups = records.withColumn("capture_id", F.when(main, F.col("record_id")).otherwise(F.col("concurrent_to"))) \
        .where("capture_id is not null").groupBy("capture_id").agg(
            F.min(F.when(main, response)).alias("response"),
            F.min(F.when(F.col("warc_type") == "request", side)).alias("request"),
            F.min(F.when(F.col("warc_type") == "metadata", side)).alias("metadata"))
    # metadata that names a request: one step further
    links = records.where(~main & F.col("concurrent_to").isNotNull()) \
        .select(F.col("record_id").alias("via"), F.col("concurrent_to").alias("capture_id"))
    late = groups.where("response is null").select(F.col("capture_id").alias("via"), F.col("metadata").alias("late")) \
        .join(links, "via").groupBy("capture_id").agg(F.min("late").alias("late"))
    captures = groups.where("response is not null").join(late, "capture_id", "left") \
        .withColumn("metadata", F.coalesce("metadata", "late")).drop("late")
    return captures.withColumn("original", F.lit(None).cast(captures.schema["metadata"].dataType))


def resolve_revisits(captures: DataFrame) -> DataFrame:
    """Give revisits the payload length and digest, and as ``original`` the metadata, of their response."""
    revisit = F.col("response.warc_type") == "revisit"
    source = captures.where(~revisit).select(
        F.col("capture_id").alias("o_id"), F.col("response.payload_bytes").alias("o_bytes"),
        F.col("response.payload_digest").alias("o_digest"), F.col("metadata").alias("o_meta"))
    found = captures.where(revisit).join(source, F.col("response.refers_to") == F.col("o_id"), "left") \
        .withColumn("response", F.col("response").withField("payload_bytes", F.col("o_bytes"))
                    .withField("payload_digest", F.col("o_digest"))) \
        .withColumn("original", F.col("o_meta")).drop("o_id", "o_bytes", "o_digest", "o_meta")
    return captures.where(~revisit).unionByName(found)


def warc_round_trip(pages: DataFrame, min_payload: int = 0) -> DataFrame:
    """Write ``pages`` as archives in the shared folder, read them back and report each capture.

    Returns ``page_id, payload_bytes, payload_digest, record_type, refers_to,
    digest_ok``; refers_to is the page_id of the revisited response.
    An empty table gives no rows; see :func:`write_warc` for nulls and ties.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "llm-warc")
    write_warc(pages, path, min_payload)
    records = written(read_warc(spark, path, keep_payload=False).drop("payload"), "warc-records")
    captures = resolve_revisits(written(assemble(records), "captures"))
    return captures.select(
        F.col("metadata.page_id").alias("page_id"), F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"), F.col("response.warc_type").alias("record_type"),
        F.col("original.page_id").alias("refers_to"),
        (F.col("response.payload_digest") == F.col("response.declared_digest")).alias("digest_ok"))
