"""Content-addressed WARC archive: payloads once by digest, exact record headers apart, records by joins."""

from __future__ import annotations

import base64
import hashlib
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brindle.llm import common

#: The alphabet of base32, the revisit profile and the end of a record.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = "\r\n"
#: References to a payload that one join task takes at most; a payload with more is stored once but read by salts.
FANOUT = 5_000


def base32_of_hex(digest: Column) -> Column:
    """Base32 of a 40-digit hex column, in JVM expressions: each five hex digits are four letters."""
    letters = []
    for i in range(8):
        five = F.conv(F.substring(digest, 5 * i + 1, 5), 16, 10).cast("long")
        for shift in (15, 10, 5, 0):
            letters.append(F.substring(F.lit(BASE32), F.shiftright(five, shift).bitwiseAND(31).cast("int") + 1, F.lit(1)))
    return F.concat(*letters)


def record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), page_id.cast("string"), F.lit(">"))


def write_archive(df: DataFrame, payload_col: str = "html", id_col: str = "page_id", uri_col: str = "url", date: str = "2024-01-01T00:00:00Z") -> tuple[DataFrame, DataFrame]:
    """Write one record a row; returns the two tables as written to the shared folder.

    ``payloads`` (sha256, sha1, payload, n_refs): each distinct payload once. ``headers`` (page_id, sha256, salt,
    header): the exact bytes of each record's header block. Of the records with equal payloads that with the largest
    id is the response and the others are revisits that refer to it. A null payload is empty; a null URI gives no
    target header. CR and LF in a URI are percent-encoded. Rows whose id is null or repeated are records too; among
    repeated rows of the largest id one is the response, the others refer to it. Rows are dealt by digest only after
    counting, and the references to a payload with very many are salted.
    """
    uri = F.regexp_replace(F.regexp_replace(F.col(uri_col).cast("string"), "\r", "%0D"), "\n", "%0A")
    rows = df.select(F.col(id_col).alias("page_id"), uri.alias("uri"), F.encode(F.coalesce(F.col(payload_col).cast("string"), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("sha256", F.sha2("payload", 256)).withColumn("n", F.length("payload").cast("long"))
    rows = rows.withColumn("pick", F.struct(F.col("page_id"), F.xxhash64("uri").alias("u"), F.monotonically_increasing_id().alias("at")))
    slim = common.staged(rows.select("page_id", "uri", "sha256", "n", "pick", F.sha1("payload").alias("sha1_hex")), "warc-slim")
    # one row a payload, by partial maxima before the shuffle; payloads themselves are not dealt by digest
    store = slim.groupBy("sha256", "n").agg(F.max("pick").alias("pick"), F.count("*").alias("n_refs"))
    store = common.staged(store.withColumn("salts", F.ceil(F.col("n_refs") / FANOUT).cast("int")), "warc-store")  # so that the join below may split the rows of one payload
    joined = slim.join(store.select("sha256", F.col("pick").alias("best"), "salts"), "sha256")
    response = F.col("pick") == F.col("best")
    digest = base32_of_hex(F.col("sha1_hex"))
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(response, "response").otherwise("revisit")),
        F.concat(F.lit("WARC-Record-ID: "), F.coalesce(record_id(F.col("page_id")), F.lit("<urn:page:null>"))),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), F.col("uri")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), digest),
        F.when(~response, F.lit(f"WARC-Profile: {PROFILE}")),
        F.when(~response, F.concat(F.lit("WARC-Refers-To: "), F.coalesce(record_id(F.col("best.page_id")), F.lit("<urn:page:null>")))),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.when(response, F.col("n")).otherwise(0).cast("string")),
    ]
    header = F.encode(F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF * 2)), "UTF-8")
    headers = joined.select("page_id", "sha256", F.pmod(F.xxhash64("pick"), F.col("salts")).cast("int").alias("salt"), header.alias("header"))
    # the payload of the response row; repeated rows of it meet in the partitions that the join has made
    key = F.coalesce(F.col("page_id").cast("string"), F.lit("null")).alias("page")
    best = store.select("sha256", "pick.page_id", F.col("pick.u").alias("u"), "n_refs", "salts").select("sha256", key, "u", "n_refs", "salts")
    payloads = rows.select("sha256", key, F.col("pick.u").alias("u"), "payload", F.sha1("payload").alias("sha1"))
    payloads = payloads.join(best, ["sha256", "page", "u"]).groupBy("sha256", "page", "u").agg(F.first("sha1").alias("sha1"), F.first("payload").alias("payload"), F.first("n_refs").alias("n_refs"), F.first("salts").alias("salts")).drop("page", "u")
    return common.staged(payloads, "warc-payloads"), common.staged(headers, "warc-headers")


def read_archive(payloads: DataFrame, headers: DataFrame) -> DataFrame:
    """Rows (page_id, record, payload, sha256): the original records' bytes, rebuilt by joining on the digest.

    A record is its header, its block (a response's payload, nothing for a revisit) and two line ends; payload is the
    page's full payload either way. Stored payloads are hashed again; one that does not match its key raises.
    """
    checked = payloads.where(F.assert_true(F.sha2("payload", 256) == F.col("sha256"), F.lit("a stored payload does not match its digest")).isNull())
    dealt = checked.select("sha256", "payload", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    joined = headers.join(dealt, ["sha256", "salt"])
    block = F.when(F.contains(F.decode("header", "UTF-8"), F.lit(CRLF + "WARC-Type: response" + CRLF)), F.col("payload")).otherwise(F.lit(b""))
    return joined.select("page_id", F.concat("header", block, F.lit((CRLF * 2).encode())).alias("record"), "payload", "sha256")


def header_field(header: Column, name: str) -> Column:
    found = F.regexp_extract(header, f"(?m)^{re.escape(name)}: ([^\r\n]*)\r?$", 1)
    return F.when(found != "", found)


def parse_records(records: DataFrame, record_col: str = "record") -> DataFrame:
    """Adds header (string), record_type, record_id, refers_to_id, target_uri, payload_digest and block from a
    record's bytes. A record without a header end has an empty block."""
    text = F.decode(F.col(record_col), "ISO-8859-1")  # a character a byte, so that positions are bytes
    end = F.instr(text, CRLF * 2)
    head = F.when(end > 0, F.substring(F.col(record_col), F.lit(1), end - 1)).otherwise(F.col(record_col))
    df = records.withColumn("header", F.decode(head, "UTF-8")).withColumn("_end", end)
    df = df.withColumn("_n", F.coalesce(header_field(F.col("header"), "Content-Length").cast("int"), F.lit(0)))
    block = F.when(F.col("_end") > 0, F.substring(F.col(record_col), F.col("_end") + 4, F.col("_n"))).otherwise(F.lit(b""))
    names = {"record_type": "WARC-Type", "record_id": "WARC-Record-ID", "refers_to_id": "WARC-Refers-To", "target_uri": "WARC-Target-URI"}
    df = df.withColumns({k: header_field(F.col("header"), v) for k, v in names.items()} | {"block": block})
    return df.withColumn("payload_digest", F.regexp_replace(header_field(F.col("header"), "WARC-Payload-Digest"), "^sha1:", "")).drop("_end", "_n")


def split_warc(content: bytes) -> list[bytes]:
    """The records of an uncompressed WARC file, by their lengths. What follows a broken record is left out."""
    out, at = [], 0
    while (end := content.find(b"\r\n\r\n", at)) >= 0 and content.startswith(b"WARC/", at):
        found = re.search(rb"(?im)^content-length:\s*(\d+)", content[at:end])
        stop = end + 4 + (int(found[1]) if found else 0) + 4
        out.append(content[at:stop])
        at = stop
    return out


def read_warc_files(spark, path: str) -> DataFrame:
    """Records of uncompressed or gzip WARC files through Spark's ``binaryFile`` reader: (path, position, record), in the
    files' order from 0. Equal records, within a file or across files, are rows of their own; an empty file has none."""
    import gzip

    schema = T.StructType([T.StructField("path", T.StringType()), T.StructField("records", T.ArrayType(T.BinaryType()))])

    def run(batch):
        contents = (c.as_py() for c in batch.column(1))
        return common.batch(schema, [batch.column(0), [split_warc(gzip.decompress(c) if c[:2] == b"\x1f\x8b" else c) for c in contents]])

    rows = common.map_batches(spark.read.format("binaryFile").load(path).select("path", "content"), run, schema)
    return rows.select("path", F.posexplode("records").alias("position", "record"))


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()
