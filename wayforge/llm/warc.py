"""WARC archives: writing records by Spark's own writer, and a reader that salvages what damage leaves."""

from __future__ import annotations

import hashlib
import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayforge.llm.common import Staging
from wayforge.llm.graph import filter_bits, may_hold, membership_filter

VERSION = re.compile(rb"WARC/1\.[01]\r\n")
START = re.compile(rb"WARC/1\.[01]\r\n|\x1f\x8b\x08")
GZIP = b"\x1f\x8b\x08"
HTTP_END = b"\r\n\r\n"


class Damaged(Exception):
    pass


def _record(data: bytes, at: int) -> tuple[int, dict[str, str], bytes]:
    """(end, headers, block) of the record at ``at``; Damaged where a check fails."""
    if not VERSION.match(data, at):
        raise Damaged("no version line")
    stop = data.find(HTTP_END, at)
    if stop < 0:
        raise Damaged("header without an end")
    headers: dict[str, str] = {}
    for line in data[at:stop].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon or not name.strip():
            raise Damaged("bad header line")
        headers[name.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
    length = headers.get("content-length", "")
    if not re.fullmatch(r"[0-9]{1,18}", length):
        raise Damaged("bad content length")
    block = data[stop + 4 : stop + 4 + int(length)]
    end = stop + 4 + int(length)
    if len(block) < int(length):
        raise Damaged("short block")
    if data[end : end + 4] != HTTP_END:
        raise Damaged("no record end")
    for name, body in (("warc-block-digest", block), ("warc-payload-digest", payload_of(block))):
        kind, _, want = headers.get(name, "").partition(":")
        if kind == "sha256" and not (name == "warc-payload-digest" and headers.get("warc-type") == "revisit") and hashlib.sha256(body).hexdigest() != want:
            raise Damaged(f"wrong {name}")
    return end + 4, headers, block


def payload_of(block: bytes) -> bytes:
    """The body of an HTTP message; of other blocks the whole."""
    return block.partition(HTTP_END)[2] if block.startswith(b"HTTP/") else block


def salvage(data: bytes, most: int = 0):
    """Yields ("record", start, end, headers, block) and ("gap", start, end, reason, None) over all bytes of an archive.

    Plain records and gzip members of one or more records may alternate. Where a check fails, the next version line or
    member that passes all checks is searched, byte by byte, and what lies between is a gap. Offsets within a member are the
    member's. With ``most``, a member larger than so many bytes when inflated counts as damaged."""
    at, gap, reason = 0, None, ""
    while at < len(data):
        try:
            if data.startswith(GZIP, at):
                inflate = zlib.decompressobj(31)
                try:
                    inner = inflate.decompress(memoryview(data)[at:], most)
                except zlib.error as e:
                    raise Damaged("bad member") from e
                if not inflate.eof:
                    raise Damaged("member without an end")
                end = len(data) - len(inflate.unused_data)
                found = [(kind, at, end, *rest) for kind, _, _, *rest in salvage(inner, most)]
            else:
                end, headers, block = _record(data, at)
                found = [("record", at, end, headers, block)]
        except Damaged as e:
            if gap is None:
                gap, reason = at, str(e)
            following = START.search(data, at + 1)
            at = following.start() if following else len(data)
            continue
        if gap is not None:
            yield "gap", gap, at, reason, None
            gap = None
        yield from found
        at = end
    if gap is not None:
        yield "gap", gap, len(data), reason, None


def gzip_member(record: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


def mark_revisits(pages: DataFrame, least: int = 100) -> DataFrame:
    """pages (page_id, url, html) with payload_bytes, payload_digest, record_type and refers_to.

    Only ids and digests are grouped; of the pages themselves, those that a bounded filter holds for revisits move, once. Rows
    that repeat the smallest id are responses too. A null page_id counts as larger than any other."""
    staging = Staging(pages.sparkSession, "revisits")
    data = F.coalesce(F.encode("html", "UTF-8"), F.lit(b""))
    made = pages.select("page_id", "url", "html", F.octet_length(data).cast("long").alias("payload_bytes"), F.sha2(data, 256).alias("payload_digest"))
    keys = staging.keep(made.select("page_id", "payload_digest", "payload_bytes").distinct(), "keys").where(F.col("payload_bytes") >= least)
    firsts = keys.groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    revisits = keys.join(firsts, "payload_digest").where("not (page_id <=> first)").select(F.col("page_id").alias("_id"), F.col("payload_digest").alias("_digest"), "first")
    revisits = staging.keep(revisits, "revisits")
    bits = filter_bits(revisits.count())
    marked = may_hold(made, "page_id", membership_filter(revisits, "_id", bits), bits)
    doubtful, plain = marked.where("_maybe").drop("_maybe"), marked.where("not _maybe").drop("_maybe")
    same = doubtful["page_id"].eqNullSafe(revisits["_id"]) & (doubtful["payload_digest"] == revisits["_digest"])
    joined = doubtful.join(revisits, same, "left")
    joined = joined.withColumn("record_type", F.when(F.col("_digest").isNotNull(), "revisit").otherwise("response")).withColumnRenamed("first", "refers_to").drop("_id", "_digest")
    return joined.unionByName(plain.withColumns({"record_type": F.lit("response"), "refers_to": F.lit(None).cast(joined.schema["refers_to"].dataType)}))


def write_warc(marked: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z") -> None:
    """One record a row, written as text whose line end is the end of a WARC record: uncompressed WARC 1.1 files.

    Spark's commit protocol makes the files safe against lost executors, on any file system that Spark writes."""
    clean = lambda c: F.regexp_replace(F.coalesce(F.col(c).cast("string"), F.lit("")), r"[\r\n]", " ")
    eol, http = "\r\n", F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes"), F.lit("\r\n\r\n"))
    revisit = F.col("record_type") == "revisit"
    body = F.when(revisit, F.lit("")).otherwise(F.coalesce("html", F.lit("")))
    length = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    refers = F.when(revisit, F.concat(F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: "), urn("refers_to"), F.lit(eol))).otherwise("")
    record = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.col("record_type"), F.lit("\r\nWARC-Record-ID: "), urn("page_id"), F.lit(f"\r\nWARC-Date: {date}\r\nWARC-Target-URI: "), clean("url"), F.lit(eol),
        refers, F.lit("X-Payload-Length: "), F.col("payload_bytes").cast("string"), F.lit("\r\nWARC-Payload-Digest: sha256:"), F.col("payload_digest"), F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), length.cast("string"), F.lit("\r\n\r\n"), http, body,
    )
    marked.select(record.alias("value")).write.option("lineSep", "\r\n\r\n").text(path)


READ = "archive string, kind string, start long, end long, reason string, headers map<string, string>, payload_bytes long, payload_digest string, payload binary"


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records and quarantined gaps of the archives under path, as rows of READ; payload is null unless asked for.

    An archive is read by one task, so archives should stay under some hundred MB, as write_warc's do."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches):
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows, size = [], 0
                for kind, start, end, what, block in salvage(content.as_buffer().to_pybytes()):
                    if kind == "gap":
                        rows.append((name, kind, start, end, what, None, None, None, None))
                    else:
                        body = payload_of(block)
                        rows.append((name, kind, start, end, None, list(what.items()), len(body), hashlib.sha256(body).hexdigest(), body if payloads else None))
                        size += len(body) if payloads else 0
                    if size > 8 << 20 or len(rows) >= 10_000:
                        yield _batch(rows)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows)

    return files.mapInArrow(run, READ)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.map_(pa.string(), pa.string()), pa.int64(), pa.string(), pa.binary()]
    names = [x.split()[0] for x in re.sub(r"<.*?>", "", READ).split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names)


def pages_read(records: DataFrame) -> DataFrame:
    """The digest rows from the records that were read back; what a revisit's payload was comes from its headers."""
    h = lambda name: F.col("headers").getItem(name)
    number = lambda name: F.expr(f"try_cast(regexp_extract(headers['{name}'], '^<urn:page:(.*)>$', 1) as long)")
    revisit = h("warc-type") == "revisit"
    return records.where("kind = 'record'").select(
        number("warc-record-id").alias("page_id"),
        F.when(revisit, F.expr("try_cast(headers['x-payload-length'] as long)")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(revisit, F.substring_index(h("warc-payload-digest"), ":", -1)).otherwise(F.col("payload_digest")).alias("payload_digest"),
        h("warc-type").alias("record_type"),
        F.when(revisit, number("warc-refers-to")).alias("refers_to"),
    )


def op7_warc(spark, sf_dir: str) -> DataFrame:
    """Writes all pages as WARC, reads the archives back with the salvage reader and returns what they hold."""
    staging = Staging(spark, "warc")
    path = staging.path("archives")
    write_warc(mark_revisits(spark.read.parquet(f"{sf_dir}/pages.parquet")), path)
    return pages_read(read_warc(spark, path, payloads=False))
