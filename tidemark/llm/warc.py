"""WARC archives: writing captures, reading records, assembling transactions.

A capture is written as three records: the response (or a revisit of an equal
payload), its request and a metadata record, tied by WARC-Concurrent-To.
Archives are written by Spark's text writer, so they may lie in any store
that Spark writes: a row is a record, and the separator of rows is the blank
lines that end one. They are read as whole files of bounded size, record by
record, by the Content-Length of each.
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

from ..operators.staging import staged
from ..session import scratch_path

RECORDS_PER_FILE = 3000
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MAIN_TYPES = ("response", "revisit", "resource")
END = "\r\n\r\n"

RECORDS = ("record_id string, record_type string, date string, target_uri string, concurrent_to array<string>, "
           "refers_to_uri string, declared_digest string, payload_bytes long, payload_digest string, payload binary")


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1 of the bytes."""
    digest = F.sha1(payload)
    letters = []
    for group in range(8):  # 20 bits, five hex digits, four letters
        bits = F.conv(F.substring(digest, 5 * group + 1, 5), 16, 10).cast("int")
        letters += [F.substring(F.lit(BASE32), F.shiftright(bits, shift).bitwiseAND(31) + 1, F.lit(1)) for shift in (15, 10, 5, 0)]
    return F.concat(*letters)


def _record(kind: str, own_id: Column, date: str, fields: list[tuple[str, Column]], block: Column) -> Column:
    """A record without the blank lines after it. Fields that are null are left out."""
    named = [F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit("")) for name, value in fields]
    return F.concat(
        F.lit(f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: "), own_id, F.lit(f"\r\nWARC-Date: {date}\r\n"), *named,
        F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(END), block)


def write_archives(pages: DataFrame, path: str, date: str, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", min_revisit_bytes: int = 0,
                   records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write a capture per row as gzipped archives under ``path``.

    The payload is the text in UTF-8, a null one empty. Of rows whose payloads
    are equal and have at least ``min_revisit_bytes`` bytes, the one with the
    largest id is the response and the others are revisits without payload
    (rows that repeat that id with that payload are all responses; so are all
    rows if none has an id). Line breaks in a url are percent-encoded, a null
    url or id is left out of its record. Other columns are not written.
    """
    text = F.coalesce(F.col("html"), F.lit(""))
    captures = (
        pages.select(pages[id_col].cast("bigint").alias("id"), pages[url_col].alias("raw"), pages[html_col].alias("html"))
        .select("id", F.replace(F.replace("raw", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")).alias("url"),
                text.alias("html"))
        .withColumn("digest", base32_sha1(F.col("html").cast("binary"))).withColumn("size", F.octet_length("html"))
    )
    equal = staged(
        captures.filter(F.col("size") >= min_revisit_bytes).groupBy("digest", "size")
        .agg(F.count("*").alias("n"), F.max(F.struct("id", "url")).alias("original"))
        .filter("n > 1 and original.id is not null").select("digest", "size", "original"), "equal-payloads")
    said = captures.join(equal, ["digest", "size"], "left").withColumn(
        "again", F.col("original").isNotNull() & ~F.col("id").eqNullSafe(F.col("original.id")))

    # One name per row, used by all records of its capture.
    said = said.withColumn("name", F.uuid())
    urn = {kind: F.concat(F.lit(f"<urn:{space}:"), "name", F.lit(">")) for kind, space in (
        ("main", "uuid"), ("request", "x-request"), ("metadata", "x-metadata"))}
    status = F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: ")
    answer = F.concat(status, F.col("size").cast("string"), F.lit(END))
    common = [("WARC-Target-URI", F.col("url")), ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
              ("Content-Type", F.lit("application/http;msgtype=response"))]
    response = _record("response", urn["main"], date, common, F.concat(answer, "html"))
    revisit = _record("revisit", urn["main"], date, [
        *common, ("WARC-Profile", F.lit(PROFILE)), ("WARC-Refers-To-Target-URI", F.col("original.url"))], answer)
    place = F.regexp_extract("url", r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    request = _record("request", urn["request"], date, [
        ("WARC-Target-URI", F.col("url")), ("WARC-Concurrent-To", urn["main"]),
        ("Content-Type", F.lit("application/http;msgtype=request"))],
        F.concat(F.lit("GET "), F.coalesce(F.when(place.startswith("/"), place), F.lit("/")), F.lit(" HTTP/1.1"), F.lit(END)))
    metadata = _record("metadata", urn["metadata"], date, [
        ("WARC-Target-URI", F.col("url")), ("WARC-Concurrent-To", urn["main"]),
        ("Content-Type", F.lit("application/warc-fields"))],
        F.coalesce(F.concat(F.lit("page_id: "), F.col("id").cast("string"), F.lit("\r\n")), F.lit("")))
    rows = said.select(F.explode(F.array(F.when(F.col("again"), revisit).otherwise(response), request, metadata)).alias("value"))
    rows.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path)


def _fields(block: bytes) -> dict[str, list[str]]:
    found: dict[str, list[str]] = {}
    for line in block.decode("utf-8", "replace").split("\r\n"):
        name, colon, value = line.partition(":")
        if colon:
            found.setdefault(name.strip().lower(), []).append(value.strip())
    return found


def records_of(content: bytes, where: str = "archive") -> Iterator[tuple[dict[str, list[str]], bytes]]:
    """(fields, block) of each record of an archive, gzipped or not."""
    source = io.BytesIO(content)
    if content[:2] == b"\x1f\x8b":
        source = io.BufferedReader(gzip.GzipFile(fileobj=source))
    while True:
        line = source.readline()
        while line in (b"\r\n", b"\n"):
            line = source.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError(f"{where}: no record where one should begin")
        head = []
        while (line := source.readline()) not in (b"\r\n", b"\n"):
            if not line:
                raise ValueError(f"{where}: a record ends in its header")
            head.append(line)
        fields = _fields(b"".join(head))
        size = int(fields["content-length"][0])
        block = source.read(size)
        if len(block) != size:
            raise ValueError(f"{where}: a record is cut short")
        yield fields, block


def read_records(spark: SparkSession, path: str, payload_of: tuple[str, ...] | None = None) -> DataFrame:
    """One row per record of all archives under ``path``.

    Size and digest are those of the payload as read; the payload itself is
    given for the record types in ``payload_of`` (default: all). The payload of
    an HTTP message begins after its header. A damaged archive fails the job.
    """
    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for where, content in zip(batch.column(0), batch.column(1)):
                for fields, block in records_of(content.as_py(), where.as_py()):
                    first = {name: values[0] for name, values in fields.items()}
                    kind = first.get("warc-type")
                    if first.get("content-type", "").startswith("application/http"):
                        block = block.partition(b"\r\n\r\n")[2]
                    keep = payload_of is None or kind in payload_of
                    declared = first.get("warc-payload-digest", "")
                    rows.append((
                        first.get("warc-record-id"), kind, first.get("warc-date"), first.get("warc-target-uri"),
                        fields.get("warc-concurrent-to", []), first.get("warc-refers-to-target-uri"),
                        declared.partition(":")[2] or None, len(block),
                        base64.b32encode(hashlib.sha1(block, usedforsecurity=False).digest()).decode(), block if keep else None))
                    held += len(block) if keep else 0
                    if len(rows) >= 4096 or held >= 1 << 24:
                        yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], kinds)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], kinds)

    names = [field.split()[0] for field in RECORDS.split(", ")]
    types = {"array<string>": pa.list_(pa.string()), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    kinds = pa.schema([(f.split()[0], types[f.split()[1]]) for f in RECORDS.split(", ")])
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(parsed, RECORDS)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: its response or revisit, requests and metadata.

    Records name each other by WARC-Concurrent-To, in either direction; a
    metadata record may also name the request. Records that reach no response,
    revisit or resource belong to no capture. A field that is absent is null,
    a capture without requests or metadata has empty arrays.
    """
    is_main = F.col("record_type").isin(*MAIN_TYPES)
    named = records.select("record_id", "record_type", F.explode("concurrent_to").alias("other"))
    mains = records.filter(is_main).select(F.col("record_id").alias("capture_id"))
    to_side = named.filter(is_main).select(F.col("other").alias("record_id"), F.col("record_id").alias("capture_id"))
    to_other = named.filter(~is_main).select("record_id", "other")
    to_main = to_other.join(mains, F.col("other") == F.col("capture_id")).select("record_id", "capture_id")
    direct = to_side.unionByName(to_main).distinct()
    by_side = (
        to_other.unionByName(to_other.select(F.col("other").alias("record_id"), F.col("record_id").alias("other")))
        .join(direct.withColumnRenamed("record_id", "other"), "other").select("record_id", "capture_id")
        .join(direct.select("record_id"), "record_id", "left_anti")
        .join(mains.select(F.col("capture_id").alias("record_id")), "record_id", "left_anti")
    )
    tied = direct.unionByName(by_side).distinct()
    part = F.struct("record_id", "record_type", "date", "target_uri", "payload_bytes", "payload_digest", "payload")
    sides = (
        records.filter(~is_main).join(tied, "record_id").groupBy("capture_id")
        .agg(*[F.sort_array(F.collect_list(F.when(F.col("record_type") == kind, part))).alias(name)
               for kind, name in (("request", "requests"), ("metadata", "metadata"))])
    )
    main = records.filter(is_main).select(F.col("record_id").alias("capture_id"), F.struct(
        "record_type", "date", "target_uri", "refers_to_uri", "declared_digest", "payload_bytes", "payload_digest",
        "payload").alias("response"))
    none = F.array().cast("array<struct<record_id:string,record_type:string,date:string,target_uri:string,"
                          "payload_bytes:bigint,payload_digest:string,payload:binary>>")
    return main.join(sides, "capture_id", "left").select(
        "capture_id", "response", *[F.coalesce(name, none).alias(name) for name in ("requests", "metadata")])


def page_captures(captures: DataFrame) -> DataFrame:
    """``page_id``, size and digest of the full payload, type, and the page a revisit refers to."""
    said = F.regexp_extract(F.decode(F.col("metadata")[0]["payload"], "UTF-8"), r"(?m)^page_id: (-?\d+)", 1)
    rows = staged(captures.select(
        F.when(said != "", said).cast("bigint").alias("page_id"), F.col("response.record_type").alias("record_type"),
        F.coalesce("response.declared_digest", "response.payload_digest").alias("payload_digest"),
        F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("read_digest")), "captures")
    responses = rows.filter("record_type = 'response'")
    # Written first: a join of two new shuffles splits a payload with very many revisits.
    originals = staged(responses.groupBy("read_digest").agg(
        F.max("page_id").alias("refers_to"), F.max("payload_bytes").alias("full_bytes")), "originals")
    revisits = rows.filter("record_type = 'revisit'").join(
        originals.withColumnRenamed("read_digest", "digest"), F.col("payload_digest") == F.col("digest"), "left")
    return responses.select("page_id", "payload_bytes", F.col("read_digest").alias("payload_digest"), "record_type",
                            F.lit(None).cast("bigint").alias("refers_to")).unionByName(
        revisits.select("page_id", F.col("full_bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to"))


def round_trip(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write archives of the pages, read them back and list the captures."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path, date)
    records = staged(read_records(spark, path, payload_of=("metadata",)), "warc-records")
    return page_captures(assemble(records))
