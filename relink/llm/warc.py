"""A content-addressed WARC archive.

Payload bytes are stored once, under their SHA-256; the exact bytes of every record's header stand in a table of their own
beside that address. Records are put together again by a join: header, payload, two line ends. When the archive is read,
every payload is hashed anew and its length taken again; a payload that no longer fits its address stops the read.
A revisit record has a header only; its payload is its response's.

Of records with equal payloads the one with the largest page_id is the response, the others are revisits (RESPONSE_FROM
bytes at least; smaller payloads are all responses). Equal means equal SHA-256 and length; SHA-1, which WARC headers name,
is computed besides and must agree as well.

Defined results: null html is an empty payload; a null url an empty target; a null page_id is never preferred as a response
while another page has the payload; of rows with one page_id and payload exactly one is the response, the others refer to
that id; an empty table gives an empty archive; other columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..lineage import work_path
from .common import map_batches

RESPONSE_FROM = 0
END = b"\r\n\r\n"
#: Fixed words of the format.
TYPE, DIGEST, REFERS, LENGTH_OF, PAGE = b"WARC-Type: ", b"WARC-Payload-Digest: sha1:", b"WARC-Refers-To: <urn:page:", b"X-Payload-Length: ", b"WARC-Record-ID: <urn:page:"
PROFILE = b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n"

def _digests(pages: DataFrame) -> DataFrame:
    """Payload of each page and its digests, by Spark's own functions; `copy` numbers the rows, for ties."""
    payload = F.coalesce(F.col("html").cast("string").cast("binary"), F.lit(b""))
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.monotonically_increasing_id().alias("copy"),
        F.unhex(F.sha2(payload, 256)).alias("sha256"), F.sha1(payload).alias("sha1"), F.octet_length(payload).cast("long").alias("payload_bytes"),
        payload.alias("payload"))


def base32(sha1: str) -> bytes:
    return base64.b32encode(bytes.fromhex(sha1))


def header(page_id: int | None, url: str | None, kind: str, sha1: str, size: int, refers_to: int | None) -> bytes:
    """The exact header of a record, up to and with its empty line."""
    name = b"" if page_id is None else str(page_id).encode()
    lines = [b"WARC/1.1", TYPE + kind.encode(), PAGE + name + b">", b"WARC-Target-URI: " + " ".join((url or "").split()).encode(),
             b"WARC-Date: 1970-01-01T00:00:00Z", DIGEST + base32(sha1), LENGTH_OF + str(size).encode()]
    text = b"\r\n".join(lines) + b"\r\n"
    if kind == "revisit":
        text += PROFILE + REFERS + (b"" if refers_to is None else str(refers_to).encode()) + b">\r\nContent-Length: 0"
    else:
        text += b"Content-Type: text/html\r\nContent-Length: " + str(size).encode()
    return text + END


def parse(head: bytes) -> dict:
    """The fields of a record's header."""
    if not head.startswith(b"WARC/1.1\r\n") or not head.endswith(END):
        raise ValueError("not the header of a record")
    out = {"refers_to": None}
    for line in head.split(b"\r\n"):
        if line.startswith(TYPE):
            out["record_type"] = line[len(TYPE):].decode()
        elif line.startswith(DIGEST):
            out["payload_digest"] = line[len(DIGEST):].decode()
        elif line.startswith(LENGTH_OF):
            out["payload_bytes"] = int(line[len(LENGTH_OF):])
        elif line.startswith(PAGE):
            out["page_id"] = int(line[len(PAGE):-1]) if line[len(PAGE):-1] else None
        elif line.startswith(REFERS):
            out["refers_to"] = int(line[len(REFERS):-1]) if line[len(REFERS):-1] else None
    return out


def archive(pages: DataFrame, path: str | None = None) -> str:
    """Write the archive below `path` (by default a new one in the shared folder) and return it.

    The payload table takes one shuffle of payloads: equal ones are brought together by address, and those of one task are
    merged before. The response is picked from ids alone.
    """
    spark = pages.sparkSession
    path = path or work_path(spark, "archive")
    sums = _digests(pages)
    sums.dropDuplicates(["sha256", "payload_bytes", "sha1"]).select("sha256", "sha1", "payload_bytes", "payload").write.parquet(f"{path}/payloads")
    stored = spark.read.parquet(f"{path}/payloads")
    if stored.groupBy("sha256").count().where("count > 1").limit(1).count():
        raise ValueError("two payloads share a SHA-256")
    sums.drop("payload").write.parquet(f"{path}/rows")
    slim = spark.read.parquet(f"{path}/rows")
    slim.groupBy("sha256").agg(F.max(F.struct(F.col("page_id").isNotNull().alias("named"), "page_id", "copy")).alias("lead")).select(
        "sha256", F.col("lead.page_id").alias("lead_id"), F.col("lead.copy").alias("lead_copy")).write.parquet(f"{path}/responses")
    led = slim.join(spark.read.parquet(f"{path}/responses"), "sha256")  # both sides are files: a large group's rows can be split
    response = (F.col("copy") == F.col("lead_copy")) | (F.col("payload_bytes") < RESPONSE_FROM)
    told = led.select("page_id", "url", "sha256", "sha1", "payload_bytes", F.when(response, "response").otherwise("revisit").alias("kind"),
                      F.when(~response, F.col("lead_id")).alias("refers_to"))

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [header(r["page_id"], r["url"], r["kind"], r["sha1"], r["payload_bytes"], r["refers_to"]) for r in b.to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("sha256"), pa.array(made, pa.binary())], ["sha256", "header"])

    map_batches(told, heads, "sha256 binary, header binary").write.parquet(f"{path}/headers")
    return path


def payloads(spark: SparkSession, path: str) -> DataFrame:
    """The stored payloads, each verified: hashed and measured again; one that differs stops the read."""
    stored = spark.read.parquet(f"{path}/payloads")
    sound = (F.unhex(F.sha2("payload", 256)) == F.col("sha256")) & (F.octet_length("payload") == F.col("payload_bytes"))
    return stored.withColumn("sha1", F.when(sound, F.col("sha1")).otherwise(F.raise_error(F.lit("a stored payload does not fit its digest"))))


def records(spark: SparkSession, path: str) -> DataFrame:
    """All records, put together by address: page_id, record_type, refers_to, payload_digest, payload_bytes, header, record.

    `record` is the record's exact bytes, `payload` its full payload (a revisit's is its response's). Columns that aren't
    asked for aren't shuffled: without them the join moves addresses only.
    """
    kinds = {"page_id": "long", "record_type": "string", "refers_to": "long", "payload_digest": "string", "payload_bytes": "long", "said_sha1": "string"}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [parse(h) for h in b.column("header").to_pylist()]
            for f in found:
                f["said_sha1"] = base64.b32decode(f["payload_digest"]).hex()
            yield pa.RecordBatch.from_arrays(
                [b.column("sha256"), b.column("header"), *(pa.array([f[k] for f in found], pa.int64() if t == "long" else pa.string()) for k, t in kinds.items())],
                ["sha256", "header", *kinds])

    fields = "sha256 binary, header binary, " + ", ".join(f"{k} {t}" for k, t in kinds.items())
    heads = map_batches(spark.read.parquet(f"{path}/headers"), read, fields)
    stored = payloads(spark, path).select("sha256", F.col("sha1").alias("_sha1"), F.col("payload_bytes").alias("_bytes"), "payload")
    fits = (F.col("_sha1") == F.col("said_sha1")) & (F.col("_bytes") == F.col("payload_bytes"))
    body = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return heads.join(stored, "sha256").select(
        "page_id", "record_type", "refers_to", "header", "payload", F.concat("header", body, F.lit(END)).alias("record"), "payload_bytes",
        F.when(fits, F.col("payload_digest")).otherwise(F.raise_error(F.lit("a header does not fit its payload"))).alias("payload_digest"))
