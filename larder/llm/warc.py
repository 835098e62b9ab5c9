"""WARC archives of pages: writing them, reading them, and assembling transactions.

Each page becomes a transaction of three records: a response with the html as
payload, or a revisit where an equal payload is kept elsewhere, and a request and
a metadata record that name it in their concurrent-to field. Records are composed
by DataFrame functions and written as compressed text whose line separator is the
two empty lines that end a record, so that any WARC reader can read the files. Their
number of records is bounded from the mean size, so that a file fits in a task.

Reading takes whole files, walks them record by record by the stated lengths (a
payload may hold anything), checks payloads against their digests, and gives one row
per record. Assembly joins requests and metadata to responses and revisits through
concurrent-to fields, in either direction and over one record between, and emits one
nested row per capture.

Equal payloads are found by digest and length. The largest page of a group is its
response; groups are aggregated before they meet the pages, and the meeting is a
join that can split a large group.

Defined results: null html is an empty payload, and the empty payload is a group like
any other; null page ids are less than all others; a null url has no target field;
rows equal in page, url and html are copies of one capture, and each keeps its row;
an empty table gives an empty result; other columns are not touched.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.common import shared_folder, stored, text_of

# Names of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
ANCHORS = ("response", "revisit", "resource")

LINE = "\r\n"
DATE = "2024-01-01T00:00:00Z"
FILE_BYTES = 16_000_000
FIELD_BYTES = 400


# --- writing --------------------------------------------------------------

def base32_of(digest: Column) -> Column:
    """A SHA-1 in base 32 from its hex form: four digits for every five."""
    digits = []
    for i in range(8):
        value = F.conv(F.substring(digest, 5 * i + 1, 5), 16, 10).cast("int")
        digits += [
            F.substring(F.lit(BASE32), F.shiftright(value, shift).bitwiseAND(31) + 1, F.lit(1)) for shift in (15, 10, 5, 0)
        ]
    return F.concat(*digits)


def _record_id(kind: str, *parts: Column) -> Column:
    """A record's name, the same for the same page."""
    hashed = F.md5(F.concat_ws("\n", F.lit(kind), *[F.coalesce(p.cast("string"), F.lit("\r")) for p in parts]))
    cut = [F.substring(hashed, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _one_line(value: Column) -> Column:
    return F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def _record(fields: list[tuple[str, Column | str]], block: Column, length: Column | None = None) -> Column:
    """One record: version, named fields (null ones are left out), length, block.

    The length of a large block is given, so that the block is not put together for it.
    """
    length = F.octet_length(block) if length is None else length
    lines = [F.lit(VERSION)]
    for name, value in fields:
        lines.append(F.concat(F.lit(f"{name}: "), F.lit(value) if isinstance(value, str) else value))
    lines.append(F.concat(F.lit("Content-Length: "), length.cast("string")))
    return F.concat(F.concat_ws(LINE, *lines), F.lit(LINE + LINE), block)


def records_of(
    pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html", date: str = DATE,
) -> DataFrame:
    """The records of all pages as text, three rows for each page, in the column value."""
    html = text_of(html_column)
    rows = pages.select(
        F.col(id_column).cast("long").alias("page"), F.col(url_column).cast("string").alias("url"), html.alias("html"),
        F.sha1(html).alias("sha1"), F.octet_length(html).cast("long").alias("bytes"),
    )
    kept = stored(rows.groupBy("sha1", "bytes").agg(F.max(F.struct("page", "url")).alias("first")).withColumn(
        "digest", F.concat(F.lit("sha1:"), base32_of(F.col("sha1")))))
    rows = rows.join(kept, ["sha1", "bytes"])

    page, url, first = F.col("page"), F.col("url"), F.col("first")
    is_response = F.struct("page", "url").eqNullSafe(first)
    capture = _record_id("capture", page, url, F.col("sha1"))
    target = _one_line(url)
    digest = F.col("digest")
    head = F.concat(
        F.lit(f"HTTP/1.1 200 OK{LINE}Content-Type: text/html; charset=utf-8{LINE}Content-Length: "),
        F.col("bytes").cast("string"), F.lit(LINE + LINE))

    def common(kind: str, name: Column) -> list:
        return [("WARC-Type", kind), ("WARC-Record-ID", name), ("WARC-Date", date), ("WARC-Target-URI", target)]

    http = "application/http; msgtype="
    response = _record(
        [*common("response", capture), ("WARC-Payload-Digest", digest), ("Content-Type", http + "response")],
        F.concat(head, F.col("html")), F.octet_length(head) + F.col("bytes"))
    revisit = _record(
        [*common("revisit", capture), ("WARC-Payload-Digest", digest), ("WARC-Profile", REVISIT_PROFILE),
         ("WARC-Refers-To", _record_id("capture", first["page"], first["url"], F.col("sha1"))),
         ("Content-Type", http + "response")], head)
    where = F.regexp_extract(F.coalesce(target, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)([^#]*)", 1)
    path = F.regexp_extract(F.coalesce(target, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)([^#]*)", 2)
    request = _record(
        [*common("request", _record_id("request", page, url, F.col("sha1"))), ("WARC-Concurrent-To", capture),
         ("Content-Type", http + "request")],
        F.concat(F.lit("GET "), F.when(path == "", "/").otherwise(path), F.lit(f" HTTP/1.1{LINE}Host: "), where,
                 F.lit(LINE + LINE)))
    metadata = _record(
        [*common("metadata", _record_id("metadata", page, url, F.col("sha1"))), ("WARC-Concurrent-To", capture),
         ("Content-Type", "application/warc-fields")],
        F.concat_ws("", F.lit("page: "), page.cast("string"), F.lit(LINE)))
    three = F.array(request, F.when(is_response, response).otherwise(revisit), metadata)
    return rows.select(F.explode(three).alias("value"))


def write(records: DataFrame, folder: str, mean_bytes: float, file_bytes: int = FILE_BYTES) -> None:
    """Write records (column value) of some mean size as compressed archives of about file_bytes before compression."""
    records.write.option("lineSep", LINE + LINE).option("compression", "gzip").option(
        "maxRecordsPerFile", max(1, int(file_bytes / max(1.0, mean_bytes)))).text(folder)


def mean_record_bytes(pages: DataFrame, html_column: str = "html") -> float:
    """The mean size of the three records of a page, their fields included."""
    mean = pages.agg(F.avg(F.octet_length(text_of(html_column)))).first()[0]
    return (mean or 0.0) / 3 + FIELD_BYTES


# --- reading --------------------------------------------------------------

RECORDS = (
    "record_id string, record_type string, concurrent_to array<string>, target_uri string, refers_to string, "
    "payload_digest string, payload_bytes bigint, intact boolean, block string, payload binary"
)


def _walk(content: bytes) -> Iterator[tuple[list[tuple[str, str]], bytes]]:
    """Fields and block of each record of one archive, compressed (as a whole or by records) or not."""
    raw = io.BytesIO(content)
    stream = io.BufferedReader(gzip.GzipFile(fileobj=raw)) if content[:2] == b"\x1f\x8b" else raw
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("a WARC record was expected")
        fields: list[tuple[str, str]] = []
        while (line := stream.readline().rstrip(b"\r\n")):
            text = line.decode("utf-8", "replace")
            if text[0] in " \t" and fields:
                fields[-1] = (fields[-1][0], f"{fields[-1][1]} {text.strip()}")
            else:
                name, _, value = text.partition(":")
                fields.append((name.strip().lower(), value.removeprefix(" ")))
        length = int(next((v for n, v in fields if n == "content-length"), "0"))
        block = stream.read(length)
        if len(block) < length:
            raise ValueError("an archive ends within a record")
        yield fields, block


def _row(fields: list[tuple[str, str]], block: bytes, with_payload: bool) -> tuple:
    first = dict(reversed(fields))
    kind = first.get("warc-type", "").strip()
    digest = first.get("warc-payload-digest")
    bare = digest.partition(":")[2] if digest else None
    payload = size = intact = text = None
    if kind == "response":
        head, _, payload = block.partition(b"\r\n\r\n")
        size = len(payload)
        found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        intact = bare is None or bare == found
        bare = found
    elif kind == "resource":
        payload, size = block, len(block)
        bare = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        intact = True
    else:
        text = block.decode("utf-8", "replace")
    return (
        first.get("warc-record-id"), kind, [v for n, v in fields if n == "warc-concurrent-to"],
        first.get("warc-target-uri"), first.get("warc-refers-to"), bare, size, intact, text,
        payload if with_payload else None,
    )


def read_records(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """One row per record of all archives in a folder; payloads may be left out once checked."""
    names = [f.split()[0] for f in RECORDS.split(", ")]

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                rows, size = [], 0
                for fields, block in _walk(content):
                    rows.append(_row(fields, block, with_payload))
                    size += len(block) if with_payload else 0
                    if len(rows) >= 2_000 or size > 8_000_000:
                        yield pd.DataFrame(rows, columns=names)
                        rows, size = [], 0
                if rows:
                    yield pd.DataFrame(rows, columns=names)

    return spark.read.format("binaryFile").load(folder).select("content").mapInPandas(walk, RECORDS)


# --- assembly -------------------------------------------------------------

def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: its record, request and metadata.

    A request or metadata record belongs to the response, revisit or resource that
    it names as concurrent, that names it, or that a record it names belongs to.
    Records that occur several times under one id are one; `copies` counts the
    capture's own. Those that belong to no capture are left out.
    """
    is_anchor = F.col("record_type").isin(*ANCHORS)
    named = records.select("record_id", is_anchor.alias("anchor"), F.explode("concurrent_to").alias("other"))
    anchors = records.where(is_anchor).select("record_id").distinct()
    ties = named.select("record_id", "other").union(named.select(F.col("other"), F.col("record_id"))).distinct()
    direct = ties.join(anchors.select(F.col("record_id").alias("other")), "other", "left_semi").select(
        "record_id", F.col("other").alias("capture"))
    further = ties.join(
        direct.select(F.col("record_id").alias("other"), "capture"), "other"
    ).select("record_id", "capture")
    belongs = direct.withColumn("hops", F.lit(1)).union(further.withColumn("hops", F.lit(2))).groupBy(
        "record_id").agg(F.min(F.struct("hops", "capture")).alias("best")).select("record_id", "best.capture")

    own = F.struct("record_id", "record_type", "target_uri", "refers_to", "payload_digest", "payload_bytes", "intact", "payload")
    others = records.where(~is_anchor).join(belongs, "record_id").select(
        "capture", "record_type", F.lit(0).alias("own"), F.lit(None).cast(_kind(records, own)).alias("record"),
        F.struct("record_id", "target_uri", "block").alias("side"))
    captures = records.where(is_anchor).select(
        F.col("record_id").alias("capture"), "record_type", F.lit(1).alias("own"), own.alias("record"),
        F.lit(None).cast("struct<record_id:string,target_uri:string,block:string>").alias("side"))
    return (
        captures.union(others).groupBy("capture").agg(
            F.first("record", ignorenulls=True).alias("record"), F.sum("own").alias("copies"),
            F.min(F.when(F.col("record_type") == "request", F.col("side"))).alias("request"),
            F.array_sort(F.collect_set(F.when(F.col("record_type") == "metadata", F.col("side")))).alias("metadata"),
        ).where("copies > 0")
    )


def _kind(records: DataFrame, column: Column) -> str:
    return records.select(column.alias("x")).schema["x"].dataType.simpleString()


def round_trip(
    pages: DataFrame, folder: str | None = None, id_column: str = "page_id", url_column: str = "url",
    html_column: str = "html",
) -> DataFrame:
    """Write all pages to archives, read these, assemble the captures: one row per page.

    Everything but the grouping of equal payloads comes back from the archives.
    """
    spark = pages.sparkSession
    folder = folder or f"{shared_folder(spark)}.warc"
    write(records_of(pages, id_column, url_column, html_column), folder, mean_record_bytes(pages, html_column))
    records = stored(read_records(spark, folder, with_payload=False).drop("payload").withColumn(
        "payload", F.lit(None).cast("binary")))
    page = F.regexp_extract(F.get("metadata", F.lit(0))["block"], r"\Apage: (-?[0-9]+)", 1)
    captures = stored(assemble(records).select(
        "capture", "copies", "record.*", F.when(page != "", page.cast("long")).alias("page")))
    responses = captures.where("record_type = 'response'").select(
        F.col("capture").alias("refers_to"), F.col("page").alias("first_page"), F.col("payload_bytes").alias("first_bytes"))
    each = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return captures.join(responses, "refers_to", "left").select(
        F.col("page").alias(id_column), F.coalesce("payload_bytes", "first_bytes").alias("payload_bytes"),
        "payload_digest", "record_type",
        F.when(F.col("record_type") == "revisit", F.col("first_page")).alias("refers_to"),
        F.col("target_uri").alias(url_column), F.col("record_id"), each.alias("copy"),
    ).drop("copy")
