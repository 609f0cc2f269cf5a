"""WARC archives with revisit resolution (operator 6).

The headers of all records (row, page, digest, without payloads) are shuffled by payload digest; of equal
payloads the record of the smallest page is the response and the others become revisits that refer to it.
Payloads then meet these decisions once and go straight to the archives, revisits without them. The
deduplicated archives are written with fresh headers as gzipped text files of bounded size (record lines
end in CR LF and payloads are counted in bytes, so the files are plain WARC/1.1), and read again by their
Content-Length; revisits are joined to the responses they refer to.

Defined cases: null payloads are empty; payloads under ``MIN_BYTES`` are always responses; null page
ids come last; of rows repeated with one id and payload one is the response and the others
revisit it (all are responses if small); other columns are ignored. A payload over 2 GB cannot be read back.
"""

from __future__ import annotations

import gzip
import hashlib
import io

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, keyed_rows, text_or_empty

MIN_BYTES = 100
LARGE_BYTES = 1 << 18              # payloads over this go to files of their own
FILE_BYTES = 1 << 30               # of payloads in one file, unless one alone is larger
ROW = "__record_row"               # key of a row beside the columns of the pages
_EOL = "\r\n"


def _record_id(page: Column, digest: Column) -> Column:
    h = F.sha2(F.concat_ws(":", F.lit("page"), F.coalesce(page.cast("string"), F.lit("")), digest), 256)
    return F.concat(F.lit("<urn:uuid:"), *[x for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
                                           for x in (F.substring(h, a, n), F.lit("-" if n != 12 else ">"))])


def resolve(rows: DataFrame, id_col: Column, url_col: Column, html_col: Column,
            min_bytes: int = MIN_BYTES) -> DataFrame:
    """page, url, html (null for revisits), bytes, digest and first (the page referred to, as a
    struct; null for responses) of every row of ``rows``, which have a unique ``ROW``."""
    src = rows.select(F.col(ROW).alias("row"), id_col.alias("page"), url_col.alias("url"), text_or_empty(html_col).alias("html"))
    src = src.withColumn("digest", F.sha2(F.encode("html", "UTF-8"), 256)).withColumn("bytes", F.octet_length("html"))
    same = src.filter(F.col("bytes") >= min_bytes).groupBy("digest").agg(
        F.count("*").alias("records"),
        F.min(F.struct(F.col("page").isNull().alias("null"), "page", "row")).alias("first")).filter("records > 1")
    again = F.col("first").isNotNull() & (F.col("row") != F.col("first.row"))
    return src.join(same, "digest", "left").select(
        "page", "url", F.when(~again, F.col("html")).alias("html"), "bytes", "digest",
        F.when(again, F.struct("first.page")).alias("first"))


def record(date: Column) -> Column:
    """Text of a WARC record without its last line end, from the columns of ``resolve``."""
    def header(name, value):
        return F.when(value.isNull(), F.lit("")).otherwise(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(_EOL)))
    revisit = F.col("first").isNotNull()
    clean = F.regexp_replace(F.col("url"), r"[\x00-\x20\x7F]", "%20")
    return F.concat(
        F.lit("WARC/1.1" + _EOL), F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response"), F.lit(_EOL),
        F.lit("WARC-Record-ID: "), F.when(revisit, _record_id(F.col("page"), F.concat("digest", F.lit("/revisit"))))
        .otherwise(_record_id(F.col("page"), F.col("digest"))), F.lit(_EOL),
        F.lit("WARC-Date: "), date, F.lit(_EOL), header("WARC-Target-URI", clean),
        header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))), header("X-Page-ID", F.col("page")),
        F.when(revisit, F.concat(
            F.lit("WARC-Refers-To: "), _record_id(F.col("first.page"), F.col("digest")), F.lit(_EOL),
            F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" + _EOL))).otherwise(""),
        F.lit("Content-Type: text/html; charset=utf-8" + _EOL),
        F.lit("Content-Length: "), F.when(revisit, F.lit("0")).otherwise(F.col("bytes").cast("string")),
        F.lit(_EOL + _EOL), F.coalesce("html", F.lit("")), F.lit(_EOL))


def write(records: DataFrame, path: str, largest: int | None = None) -> None:
    """Archives below ``path``, some for each task; a repeated task writes its files anew. ``largest`` is the
    largest payload, if known. Files hold at most ``FILE_BYTES`` of payloads or a single one."""
    date = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    if largest is None:
        largest = records.agg(F.max("bytes")).first()[0] or 0
    sizes = [(F.col("bytes") <= LARGE_BYTES, "pages", LARGE_BYTES), (F.col("bytes") > LARGE_BYTES, "large", largest)]
    for rows, name, most in sizes[:1 + (largest > LARGE_BYTES)]:
        records.filter(rows).select(record(date).alias("value")).write.mode("overwrite").option("lineSep", _EOL) \
            .option("compression", "gzip").option("maxRecordsPerFile", max(1, FILE_BYTES // most)).text(f"{path}/{name}")


def parse(stream) -> list[tuple]:
    """(type, record id, page, digest, bytes, refers to) of all records of a binary stream."""
    out = []
    while line := stream.readline():
        if not line.strip():
            continue
        if line.rstrip() != b"WARC/1.1":
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        head = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.decode("utf-8").partition(": ")
            head[name] = value
        size = int(head["Content-Length"])
        payload = stream.read(size)
        digest = hashlib.sha256(payload).hexdigest()
        if head["WARC-Type"] == "response" and head["WARC-Payload-Digest"] != f"sha256:{digest}":
            raise ValueError(f"payload and digest differ: {head['WARC-Record-ID']}")
        out.append((head["WARC-Type"], head["WARC-Record-ID"], head.get("X-Page-ID"),
                    head["WARC-Payload-Digest"].partition(":")[2], size, head.get("WARC-Refers-To")))
    return out


def read(scratch: Scratch, path: str) -> DataFrame:
    """type, record_id, page (text), digest, bytes and refers_to of every record below ``path``."""
    def run(batches):
        for b in batches:
            for content in b.column("content"):
                rows = parse(gzip.GzipFile(fileobj=io.BytesIO(content.as_py())))
                cols = list(zip(*rows)) or [[]] * 6
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64() if i == 4 else pa.string()) for i, c in enumerate(cols)],
                    ["type", "record_id", "page", "digest", "bytes", "refers_to"])
    files = scratch.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("content").mapInArrow(
        run, "type string, record_id string, page string, digest string, bytes long, refers_to string")


def archive(scratch: Scratch, pages: DataFrame, id_col: Column, url_col: Column, html_col: Column,
            min_bytes: int = MIN_BYTES) -> DataFrame:
    """Write the archives of ``pages`` and return what reading them back gives, per page: page_id,
    payload_bytes, payload_digest, record_type, refers_to."""
    kind = pages.select(id_col.alias("page")).schema["page"].dataType
    rows = keyed_rows(scratch, pages).select(F.col("row").alias(ROW), "rec.*")
    largest = pages.select(F.octet_length(html_col).alias("n")).agg(F.max("n")).first()[0] or 0
    write(resolve(rows, id_col, url_col, html_col, min_bytes), scratch.path("warc"), largest)
    heads = scratch.table(read(scratch, scratch.path("warc")), "heads")
    revisit = heads.filter("type = 'revisit'")
    origin = heads.filter("type = 'response'").select(
        F.col("record_id").alias("refers_to"), F.struct("page", "bytes").alias("origin")).join(
            revisit.select("refers_to").distinct(), "refers_to", "left_semi")
    own = heads.filter("type = 'response'").select(
        "page", "bytes", "digest", "type", F.lit(None).cast("string").alias("to"))
    back = revisit.join(origin, "refers_to").select(
        "page", F.col("origin.bytes").alias("bytes"), "digest", "type", F.col("origin.page").alias("to"))
    return own.unionByName(back).select(
        F.col("page").cast(kind).alias("page_id"), F.col("bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"),
        F.col("to").cast(kind).alias("refers_to"))
