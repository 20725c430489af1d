"""WARC archives without repeated payloads: revisit resolution.

Only headers (digest, id) are shuffled by digest: one partial aggregate gives the smallest id of
each payload that occurs more than once, and the headers joined to that are the revisits.  The
records, payloads and all, meet their header by id and digest, so a payload that a third of
all records share is dealt over all tasks.  The deduplicated archives are then written with
fresh headers: the smallest id keeps its payload as a ``response`` record, the others become
``revisit`` records that refer to it.

Archives are written by Spark's own writer into any folder Spark can reach (a record ends
with CR LF CR LF, which is the writer's record separator).  Records of a like size share a
file, as many as fit, so a file holds ``file_bytes`` or one record.  Archives are read as whole
files, record by record by Content-Length.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.llm.storage import scratch, stored, stored_parts
from feedlens.session import shared_dir

CRLF = "\r\n"
#: fixed values of the WARC 1.1 format
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

_HTTP = CRLF.join(["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", "", ""])
_ID = "urn:page:"


def sha1_base32(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a string's UTF-8 bytes or of a binary (32 characters)."""
    digest = F.sha1(payload)
    parts = []
    for g in range(8):  # 5 hex digits are 4 base32 digits
        five = F.conv(F.substring(digest, 5 * g + 1, 5), 16, 10).cast("int")
        parts += [F.substr(F.lit(BASE32), F.shiftright(five, 15 - 5 * k).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for k in range(4)]
    return F.concat(*parts)


def revisits(headers: DataFrame) -> DataFrame:
    """(id, digest, refers_to): which of the records (id, digest) repeat a payload, and of which id.

    Of the records with equal digest, those with the smallest id are responses, all
    others revisits of that id.  A null id is never the smallest; if all ids of a digest
    are null its records are all responses.
    """
    repeats = headers.groupBy("digest").agg(F.min("id").alias("refers_to"), F.count("*").alias("n")).where("n > 1 AND refers_to IS NOT NULL")
    repeats = stored(repeats.select("digest", "refers_to"), "repeats")
    return headers.join(repeats, "digest").where(~F.col("id").eqNullSafe(F.col("refers_to"))).select("id", "digest", "refers_to").distinct()


def record_text(date: str) -> Column:
    """One WARC record, without its closing CR LF CR LF, from id, url, payload, digest, record_type, refers_to."""
    response = F.col("record_type") == "response"
    uri = lambda c: F.concat(F.lit(f"<{_ID}"), F.coalesce(F.col(c).cast("string"), F.lit("null")), F.lit(">"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    body = F.when(response, F.col("payload")).otherwise(F.lit(""))
    return F.concat(
        F.lit(VERSION + CRLF),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", uri("id")),
        line("WARC-Date", F.lit(date)),
        F.when(F.col("url").isNotNull(), line("WARC-Target-URI", url)).otherwise(F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(response, F.lit("")).otherwise(F.concat(line("WARC-Refers-To", uri("refers_to")), line("WARC-Profile", F.lit(REVISIT_PROFILE)))),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", (F.octet_length(body) + F.lit(len(_HTTP))).cast("string")),
        F.lit(CRLF + _HTTP),
        body,
    )


def write_archives(pages: DataFrame, path: str, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", date: str = "2024-01-01T00:00:00Z", file_bytes: int = 32 << 20, compression: str = "gzip") -> None:
    """Write ``pages`` as deduplicated archives into the new folder ``path``.

    A null payload is empty.  Rows with the smallest id of their payload keep it, repeated
    rows of that id included.  A file holds about ``file_bytes`` before compression, or one record.
    """
    records = pages.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"), F.coalesce(F.col(f"`{payload_col}`").cast("string"), F.lit("")).alias("payload"))
    records = records.withColumn("digest", sha1_base32(F.col("payload")))
    spark = pages.sparkSession
    with scratch(spark):
        repeated = stored(revisits(records.select("id", "digest")), "revisits")
        repeated = repeated.select(F.col("id").alias("to_id"), F.col("digest").alias("to_digest"), "refers_to")
        resolved = records.join(repeated, F.col("id").eqNullSafe(F.col("to_id")) & (F.col("digest") == F.col("to_digest")), "left")
        resolved = resolved.withColumn("record_type", F.when(F.col("to_digest").isNull(), "response").otherwise("revisit"))
        texts = resolved.select(record_text(date).alias("value"))
        # records of up to 4, 16, 64 ... bytes
        texts = texts.withColumn("size", F.ceil(F.log2(F.octet_length("value").cast("double")) / 2).cast("int"))
        at = stored_parts(texts, "records", "size")
        sizes = [r["size"] for r in spark.read.schema("value string, size int").parquet(at).select("size").distinct().collect()]  # sixteen at most
        for size in sorted(sizes):
            per_file = max(1, file_bytes // 4**size)
            same = spark.read.schema("value string").parquet(f"{at}/size={size}")
            same.write.mode("append").option("lineSep", CRLF * 2).option("compression", compression).option("maxRecordsPerFile", per_file).text(path)
        if not sizes:
            texts.select("value").limit(0).write.mode("append").text(path)


def _records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of an archive file's bytes."""
    at = 0
    while at < len(data):
        stop = data.index(b"\r\n\r\n", at)
        lines = data[at:stop].decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a WARC record at byte {at}")
        headers = dict(x.split(": ", 1) for x in lines[1:])
        size = int(headers["Content-Length"])
        block = data[stop + 4 : stop + 4 + size]
        if len(block) < size or data[stop + 4 + size : stop + 8 + size] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} is cut off")
        yield headers, block
        at = stop + 8 + size


def _payload(block: bytes) -> bytes:
    return block[block.index(b"\r\n\r\n") + 4 :]


def _page(uri: str | None) -> int | None:
    number = (uri or "").removeprefix(f"<{_ID}").removesuffix(">")
    return int(number) if number not in ("", "null") else None


_READ = "id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, declared_digest string"


def _parse(keep_payload: bool):
    fields = [("id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("declared_digest", pa.string())]
    schema = pa.schema(fields + [("payload", pa.binary())] * keep_payload)

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for files in batches:
            for content in files.column(0):
                data = content.as_py()
                if data[:2] == b"\x1f\x8b":
                    parts = []
                    while data:  # members, one after another
                        member = zlib.decompressobj(31)
                        parts.append(member.decompress(data))
                        data = member.unused_data
                    data = b"".join(parts)
                rows, held = [], 0
                for headers, block in _records(data):
                    payload = _payload(block)
                    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    declared = headers.get("WARC-Payload-Digest", "").removeprefix("sha1:")
                    row = (_page(headers.get("WARC-Record-ID")), headers.get("WARC-Target-URI"), headers["WARC-Type"], _page(headers.get("WARC-Refers-To")), len(payload), digest, declared)
                    rows.append(row + (payload,) * keep_payload)
                    held += len(payload)
                    if len(rows) >= 5000 or held * keep_payload > 8 << 20:
                        yield batch(rows)
                        rows, held = [], 0
                if rows:
                    yield batch(rows)

    return run


def read_archives(spark: SparkSession, path: str, keep_payload: bool = False) -> DataFrame:
    """One row per record: id, url, record_type, refers_to, payload_bytes and payload_digest of the bytes found
    there, declared_digest of the header, and the payload if asked for.  Raises on a broken archive."""
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(_parse(keep_payload), _READ + (", payload binary" if keep_payload else ""))


def followed(records: DataFrame) -> DataFrame:
    """Records read from archives, with revisits given the size and digest of the response they refer to.

    A revisit whose response is missing, or has another digest than it declares, gets a null size and digest.
    """
    records = stored(records, "records")
    response = records.where("record_type = 'response'")
    held = response.groupBy(F.col("id").alias("refers_to"), F.col("payload_digest").alias("declared_digest")).agg(F.max("payload_bytes").alias("payload_bytes"))
    targets = records.where("record_type = 'revisit'").select("refers_to").distinct()
    held = stored(held.join(targets, "refers_to", "left_semi"), "held")
    revisit = records.where("record_type = 'revisit'").drop("payload_bytes").join(held, ["refers_to", "declared_digest"], "left")
    revisit = revisit.withColumn("payload_digest", F.when(F.col("payload_bytes").isNotNull(), F.col("declared_digest")))
    return response.unionByName(revisit)


#: DuckDB SQL of the registered query, from the definition
ORACLE = f"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
d AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first_id,
  array_to_string(list_transform(range(0, 32), lambda k: substr('{BASE32}',
    CAST(((CAST('0x' || substr(h, CAST(k // 4 * 5 + 1 AS INTEGER), 5) AS BIGINT) >> CAST(15 - 5 * (k % 4) AS INTEGER)) & 31) + 1 AS INTEGER), 1)), '') AS digest FROM p)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN first_id IS NULL OR page_id IS NOT DISTINCT FROM first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first_id IS NULL OR page_id IS NOT DISTINCT FROM first_id THEN NULL ELSE first_id END AS refers_to, url
FROM d
"""


def archived_pages(pages: DataFrame, **names: str) -> DataFrame:
    """Write ``pages`` as deduplicated archives to the shared folder, read them back, resolve the revisits.

    One row per page: page_id, payload_bytes, payload_digest, record_type, refers_to, url.
    Null payloads are empty payloads; payloads of any size, empty ones too, are
    deduplicated.  Rows that repeat the smallest id of a payload are all responses; a
    null id is a revisit of the smallest id of its payload, or a response if there is
    none.  Other columns play no part.  An empty table gives no rows.
    """
    spark = pages.sparkSession
    path = shared_dir(spark, "llm", "warc")
    write_archives(pages, path, **names)
    out = followed(read_archives(spark, path))
    return out.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to", "url")
