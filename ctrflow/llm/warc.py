"""WARC archives with revisit records.

Pages are staged with a number and the digest of their payload, and who revisits whom is found from these headers alone. A bitmap
of at most 16 MB marks the digests that occur more than once: a payload without a mark is written where it lies, and of the
others only those travel that a second bitmap takes for an original. The payload of a revisit is moved only where both marks
are there by chance, which becomes common as repeated payloads near the number of bits; the result is the same.

Archives are files of bounded size with a gzip member per record, so that a record can be read by its offset alone.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ctrflow.llm.common import Scratch, release

#: Shorter payloads are always stored in full.
LEAST_BYTES = 1000
#: Compressed bytes after which an archive is closed; it is longer by one record at most.
ARCHIVE_BYTES = 8 << 20
#: Bits of a bitmap: 16 MB.
SLOTS = 1 << 27
#: A digest or record that this part of all rows refers to is joined by broadcast; there are at most as many of them.
HOT_PART = 512
# Fixed values of the WARC 1.1 format.
RECORD_END = b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

HEADER = "record_id string, page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to_record string"


def _slot(columns: tuple[str, ...]) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(SLOTS)) + 1


def _marks(keys: DataFrame, *columns: str) -> DataFrame:
    """A bitmap of the hashes of ``columns``, in at most 4097 rows of 4 KB."""
    slots = keys.select(_slot(columns).alias("slot"))
    return slots.groupBy(F.bitmap_bucket_number("slot").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))


def _marked(rows: DataFrame, marks: DataFrame, *columns: str) -> DataFrame:
    """``rows`` with ``marked``: true for all rows whose key the bitmap was made of, and for few others."""
    at = F.bitmap_bit_position(_slot(columns))
    byte = F.conv(F.hex(F.substring("bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return rows.withColumn("part", F.bitmap_bucket_number(_slot(columns))).join(F.broadcast(marks), "part", "left").withColumn(
        "marked", F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))).drop("part", "bits")


def _meet(rows: DataFrame, groups: DataFrame, *keys: str) -> DataFrame:
    """Inner join with one row per key, which says in ``n`` how many rows it meets.

    Keys of at least 1/512 of the rows are at most 512, and are broadcast; no other key is more than that in a task.
    """
    total = groups.agg(F.sum("n")).first()[0] or 0
    hot = F.col("n") * HOT_PART >= F.lit(total)
    often = groups.where(hot)
    rest = rows.join(F.broadcast(often.select(*keys)), list(keys), "left_anti")
    return rows.join(F.broadcast(often), list(keys)).unionByName(rest.join(groups.where(~hot), list(keys)))


def resolve_revisits(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    least_bytes: int = LEAST_BYTES,
) -> DataFrame:
    """(page_id, url, payload, digest, bytes, row, original, original_row, original_url): a row per page.

    ``original`` is the page whose payload is the same, or null; the payload of a page that has one is null. ``row`` is a number
    that no two rows share.

    Payloads are compared by SHA-1 and length. Null payloads are empty. Of pages with equal payloads of at least
    ``least_bytes`` bytes the one with the largest id is the original of the others; repeated rows of that id are
    originals too, and the last of them is the one referred to. Pages without an id refer to the original, and are one only among
    themselves: then ``original`` stays null. Other columns are not looked at.
    """
    scratch = Scratch(pages.sparkSession, "warc")
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumns({"digest": F.sha1("payload"), "bytes": F.octet_length("payload").cast("long"), "row": F.monotonically_increasing_id()})
    # The numbers of the rows hold from here on.
    rows = scratch.stage(rows, "rows")
    headers = rows.drop("payload").where(F.col("bytes") >= least_bytes)

    repeated = headers.groupBy("digest", "bytes").count().where("count > 1")
    marks = scratch.stage(_marks(repeated, "digest", "bytes"), "marks")
    headers = _marked(headers, marks, "digest", "bytes").where("marked").drop("marked")
    # Whatever is marked, those by chance too, so that each payload that is to be written is known by its first page.
    groups = scratch.stage(headers.groupBy("digest", "bytes").agg(
        F.max(F.struct("page_id", "row", "url")).alias("first"), F.count("*").alias("n")), "groups")
    firsts = groups.select("digest", "bytes", F.col("first.page_id").alias("page_id"))
    first_marks = scratch.stage(_marks(firsts, "digest", "bytes", "page_id"), "firsts")

    revisits = _meet(headers, groups.where("n > 1 AND first.page_id IS NOT NULL"), "digest", "bytes").where(
        ~F.col("page_id").eqNullSafe(F.col("first.page_id")))
    asked = _marked(rows, marks, "digest", "bytes").withColumn("marked", F.col("marked") & (F.col("bytes") >= least_bytes))
    alone = asked.where("NOT marked")
    moved = _marked(asked.where("marked").drop("marked"), first_marks, "digest", "bytes", "page_id").where("marked").alias("r")
    f = firsts.alias("f")
    moved = moved.join(
        f, (F.col("r.digest") == F.col("f.digest")) & (F.col("r.bytes") == F.col("f.bytes"))
        & F.col("r.page_id").eqNullSafe(F.col("f.page_id")), "left_semi")
    responses = alone.unionByName(moved).select(
        "page_id", "url", "payload", "digest", "bytes", "row", F.lit(None).cast("long").alias("original"),
        F.lit(None).cast("long").alias("original_row"), F.lit(None).cast("string").alias("original_url"))
    return responses.unionByName(revisits.select(
        "page_id", "url", F.lit(None).cast("binary").alias("payload"), "digest", "bytes", "row",
        F.col("first.page_id").alias("original"), F.col("first.row").alias("original_row"), F.col("first.url").alias("original_url")))


def _base32(hex_digest: Column) -> Column:
    """Base 32 of 40 hex digits: groups of 5 bits of the binary number."""
    # Fixed value: the alphabet of RFC 4648.
    alphabet = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")

    def group(k: Column) -> Column:
        # 10 hex digits are 40 bits are 8 letters
        part = F.conv(F.substring(hex_digest, (F.floor(k / 8) * 10 + 1).cast("int"), F.lit(10)), 16, 10).cast("long")
        value = F.floor(part / F.pow(F.lit(2.0), (35 - 5 * (k % 8)).cast("double"))).cast("long") % 32
        return F.substring(alphabet, (value + 1).cast("int"), F.lit(1))

    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(31)), group), "")


def _record_id(page_id: Column, row: Column) -> Column:
    """The name of a record, from the page, its row and its payload."""
    uuid = F.md5(F.concat_ws(" ", F.coalesce(page_id.cast("string"), F.lit("")), row, F.col("digest"), F.col("bytes")).cast("binary"))
    return F.regexp_replace(uuid, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "<urn:uuid:$1-$2-$3-$4-$5>")


def _address(url: Column, page_id: Column) -> Column:
    escaped = F.regexp_replace(F.regexp_replace(url, r"[\r\n]+", "%0D%0A"), r"\s", "%20")
    return F.coalesce(F.when(F.length(url) > 0, escaped), F.concat(F.lit("urn:page:"), F.coalesce(page_id.cast("string"), F.lit(""))))


def warc_records(resolved: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """(record): the bytes of a WARC record per row of :func:`resolve_revisits`.

    The block is an HTTP response; that of a revisit has headers only, whose length field tells the size of the full
    payload, and the record names id, address and date of the record that it revisits. Addresses are percent-encoded where they
    hold characters that a header must not; a page without an address gets one from its id.
    """
    end = "\r\n"
    revisit = F.col("original").isNotNull()
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{end}Content-Type: text/html; charset=utf-8{end}Content-Length: "),
                    F.col("bytes"), F.lit(end + end))
    block_bytes = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("bytes"))
    refers = F.concat(
        F.lit(f"{end}WARC-Profile: {PROFILE}{end}WARC-Refers-To: "), _record_id(F.col("original"), F.col("original_row")),
        F.lit(f"{end}WARC-Refers-To-Target-URI: "), _address(F.col("original_url"), F.col("original")),
        F.lit(f"{end}WARC-Refers-To-Date: {date}"))
    header = F.concat(
        F.lit(f"WARC/1.1{end}WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit(f"{end}WARC-Record-ID: "), _record_id(F.col("page_id"), F.col("row")),
        F.lit(f"{end}WARC-Date: {date}{end}WARC-Target-URI: "), _address(F.col("url"), F.col("page_id")),
        F.lit(f"{end}WARC-Payload-Digest: sha1:"), _base32(F.col("digest")),
        F.when(revisit, refers).otherwise(F.lit("")),
        F.lit(f"{end}Page-Id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")),
        F.lit(f"{end}Content-Type: application/http; msgtype=response{end}Content-Length: "), block_bytes,
        F.lit(end + end), http)
    body = F.when(revisit, F.lit(b"")).otherwise(F.col("payload"))
    return resolved.select(F.concat(header.cast("binary"), body, F.lit(RECORD_END)).alias("record"))


def _member(data: bytes) -> bytes:
    stream = zlib.compressobj(6, zlib.DEFLATED, 31)
    return stream.compress(data) + stream.flush()


def _info(first: bytes) -> bytes:
    """The record that opens an archive; its id follows from the archive's first record."""
    name = hashlib.md5(b"warcinfo" + first).hexdigest()
    uuid = "-".join((name[:8], name[8:12], name[12:16], name[16:20], name[20:]))
    date = next(x for x in first.split(b"\r\n") if x.startswith(b"WARC-Date: ")).decode()
    block = b"format: WARC File Format 1.1\r\n"
    lines = ["WARC/1.1", "WARC-Type: warcinfo", f"WARC-Record-ID: <urn:uuid:{uuid}>", date, "Content-Type: application/warc-fields",
             f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + RECORD_END + block + RECORD_END


def write_archives(records: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Writes records as archives below ``path``: a ``warcinfo`` record, then the others, each a gzip member of its own.

    An archive is closed when it has ``archive_bytes``. Spark's text files hold them as they are, one line each: what ends the
    line is a member without content, which every reader of gzip skips.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            for record in batch.column(0):
                data = record.as_py()
                if not parts:
                    parts, size = [_member(_info(data))], 0
                parts.append(_member(data))
                size += len(parts[-1])
                if size >= archive_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(parts)], pa.binary())], names=["archive"])
                    parts = []
            release()
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(parts)], pa.binary())], names=["archive"])

    archives = records.mapInArrow(run, "archive binary").select(F.col("archive").cast("string"))
    archives.write.option("encoding", "ISO-8859-1").option("lineSep", _member(b"").decode("latin-1")).option(
        "maxRecordsPerFile", 1).text(path)


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, block) of a WARC record; names in lower case."""
    if not data.startswith(b"WARC/"):
        raise ValueError("no WARC record")
    header, _, rest = data.partition(b"\r\n\r\n")
    fields = _fields(header)
    length = int(fields["content-length"])
    if rest[length:] != RECORD_END:
        raise ValueError("a record does not end where its length says")
    return fields, rest[:length]


def _fields(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines) if k}


def members(data: bytes) -> Iterator[bytes]:
    """The contents of the gzip members of a file, one at a time, without empty ones."""
    view = memoryview(data)
    while view:
        stream = zlib.decompressobj(31)
        content = stream.decompress(view)
        if not stream.eof:
            raise ValueError("a gzip member is cut off")
        view = view[len(view) - len(stream.unused_data):]
        if content:
            yield content


def _parsed(spark: SparkSession, path: str, payloads: bool) -> DataFrame:
    """The records below ``path`` with what their headers say; with their payloads only the responses."""
    names = [x.split()[0] for x in HEADER.split(", ")] + ["payload"] * payloads
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string()] + [pa.binary()] * payloads

    def batch_of(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column(0):
                rows, size = [], 0
                for record in members(archive.as_py()):
                    warc, block = parse_record(record)
                    if warc["warc-type"] == "warcinfo" or payloads and warc["warc-type"] != "response":
                        continue
                    head, _, payload = block.partition(b"\r\n\r\n")
                    rows.append((
                        warc["warc-record-id"], int(warc["page-id"]) if warc["page-id"] else None, warc["warc-target-uri"],
                        warc["warc-type"], base64.b32decode(warc["warc-payload-digest"].removeprefix("sha1:")).hex(),
                        int(_fields(head)["content-length"]), warc.get("warc-refers-to"), *[payload] * payloads))
                    size += len(payload) if payloads else 0
                    if size >= ARCHIVE_BYTES:
                        yield batch_of(rows)
                        rows, size = [], 0
                if rows:
                    yield batch_of(rows)
                release()

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, HEADER + ", payload binary" * payloads)


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """(record_id, page_id, url, record_type, payload_digest, payload_bytes, refers_to_record, refers_to) of all records below ``path``.

    ``payload_digest`` is in lower-case hex. ``refers_to`` is the page of the response that a revisit names by its record id, and
    null where the archives do not hold that record. With ``payloads`` there is ``payload`` too, which is empty for revisits.
    """
    scratch = Scratch(spark, "warc-read")
    heads = scratch.stage(_parsed(spark, path, False), "heads")
    revisits = heads.where(F.col("refers_to_record").isNotNull())
    # One row per record that is referred to, however many revisits it has.
    named = revisits.groupBy("refers_to_record").agg(F.count("*").alias("n"))
    targets = heads.where("record_type = 'response'").select(F.col("record_id").alias("refers_to_record"), F.col("page_id").alias("refers_to"))
    named = scratch.stage(named.join(targets, "refers_to_record", "left").groupBy("refers_to_record", "n").agg(
        F.max("refers_to").alias("refers_to")), "named")
    revisits = _meet(revisits, named, "refers_to_record").drop("n")
    if payloads:
        revisits = revisits.withColumn("payload", F.lit(b""))
    rest = _parsed(spark, path, True) if payloads else heads
    rest = rest.where(F.col("refers_to_record").isNull()).withColumn("refers_to", F.lit(None).cast("long"))
    return rest.unionByName(revisits)
