"""WARC archives: written as text with the record separator, read back by following chains of record boundaries.

Every place where the magic line stands is a candidate: a record may begin there, and its Content-Length says where its
successor would. Pointer jumping from offset 0 of each file keeps the candidates that the chain reaches; a magic line
inside a payload is none of them, whatever header it is followed by.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.session import scratch_path, written

MAGIC = "WARC/1.0\r\n"
END = "\r\n\r\n"
#: Records in one file, so that files stay small enough for one task each.
RECORDS_PER_FILE = 20_000
#: The digits of numbers in base 32 as Spark writes them, and those of RFC 4648.
CONV_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BASE32_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def sha1_base32(payload: Column) -> Column:
    """The bare upper-case base32 SHA-1 of a text's UTF-8: 40 hex digits in parts of 60, 60 and 40 bits."""
    digest = F.sha1(payload.cast("binary"))
    parts = [(1, 15, 12), (16, 15, 12), (31, 10, 8)]
    digits = [F.lpad(F.conv(F.substring(digest, at, n), 16, 32), out, "0") for at, n, out in parts]
    return F.translate(F.concat(*digits), CONV_DIGITS, BASE32_DIGITS)


def record_types(pages: DataFrame, min_bytes: int = 0, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id``, ``url``, ``payload``, ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to`` per page.

    Of pages with equal payloads of ``min_bytes`` at least, that with the largest id is the response and the others are
    revisits of it; repeated rows of that id are responses, too. Null html is an empty payload. Pages without an id are revisits
    where a page with an id has their payload, else responses. A payload that many pages share is one row of the other side of the join.
    """
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.coalesce(html, F.lit("")).alias("payload"))
    rows = rows.withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn("payload_digest", sha1_base32(F.col("payload")))
    shared = rows.where(F.col("payload_bytes") >= min_bytes).groupBy(F.col("payload_digest").alias("digest")).agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
    # Payloads that one page has need no join; the others' digests are what is left to look up.
    shared = shared.where("n > 1 and first is not null").drop("n")
    both = rows.join(shared, (rows["payload_digest"] == shared["digest"]) & (rows["payload_bytes"] >= min_bytes), "left")
    revisit = F.coalesce(F.col("page_id") != F.col("first"), F.col("page_id").isNull() & F.col("first").isNotNull())
    return both.withColumn("record_type", F.when(revisit, "revisit").otherwise("response")).withColumn("refers_to", F.when(revisit, F.col("first"))).drop("digest", "first")


def record_text(rows: DataFrame, date: str | None = None) -> DataFrame:
    """The record of each row as one text, without the two line ends that close it. ``date`` (UTC, ISO 8601) is now if it is not given."""
    now = F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'") if date is None else F.lit(date)
    # Rows without an id are named by what they hold.
    named = F.md5(F.concat_ws("|", "url", "payload_digest"))
    uuid = F.concat_ws("-", *[F.substring(named, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    record_id = F.coalesce(F.concat(F.lit("<urn:page:"), F.col("page_id").cast("string"), F.lit(">")), F.concat(F.lit("<urn:uuid:"), uuid, F.lit(">")))
    one_line = lambda c: F.regexp_replace(F.regexp_replace(c, "\r", "%0D"), "\n", "%0A")
    response = F.col("record_type") == "response"
    block = F.when(response, F.concat(F.lit(HTTP_HEAD), F.col("payload"))).otherwise("")
    length = F.when(response, F.col("payload_bytes") + len(HTTP_HEAD)).otherwise(0).cast("string")
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    head = F.concat(
        F.lit(MAGIC),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", record_id),
        line("WARC-Date", now),
        F.coalesce(line("WARC-Target-URI", one_line(F.col("url"))), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        line("WARC-Payload-Length", F.col("payload_bytes").cast("string")),
        F.coalesce(line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))), F.lit("")),
        F.when(response, "").otherwise(f"WARC-Profile: {REVISIT_PROFILE}\r\n"),
        F.when(response, "Content-Type: application/http; msgtype=response\r\n").otherwise(""),
        line("Content-Length", length),
        F.lit("\r\n"),
        block,
    )
    return rows.select(head.alias("value"))


def write_warc(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """Write what ``record_types`` made as WARC files below ``path``: each row is a record, the line separator closes it."""
    record_text(records).write.option("lineSep", END).option("maxRecordsPerFile", RECORDS_PER_FILE).option("compression", compression).text(path)


def field(head: str, name: str) -> str | None:
    found = re.search(rf"^{name}:[ \t]*(.*?)[ \t]*\r?$", head, re.I | re.M)
    return found[1] if found else None


def page_number(value: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", value or "")
    return int(found[1]) if found else None


CHUNK = (
    "file string, part long, place long, size long, reach long, kind string, page_id long, url string, payload_bytes long, payload_digest string, "
    "refers_to long, raw string, body_from int, body_bytes long, body_digest string"
)


def chunks(spark: SparkSession, path: str, texts: bool = True, files: DataFrame | None = None) -> DataFrame:
    """What stands after each magic line up to the next, with its place among the split's bytes and the length that its header claims.

    Without ``texts``, ``raw`` is null and the rows are small. ``files`` (``of_file``) says which files to read, else all are. Spark's text reader cuts the files at the magic line and splits large files. Every byte belongs to one split's
    chunks, so a chunk's offset is the sum of the sizes before it. A claim is -1 where no header with a length can be read.
    """
    names = [x.split()[0] for x in CHUNK.split(", ")]
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32()}
    schema = pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in CHUNK.split(", ")])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, place = None, 0
        for batch in batches:
            rows = []
            for text, file, part in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                raw = text.as_py()
                if (file, part) != split:
                    split, place = (file, part), 0
                size = len(raw)
                at = raw.find(END.encode())
                head = raw[: max(at, 0)].decode("utf-8", "replace")
                claim = field(head, "Content-Length")
                reach = len(MAGIC) + at + len(END) + int(claim) + len(END) if at >= 0 and claim and claim.isdigit() and len(claim) < 16 else -1
                body = raw[at + len(END) :] if at >= 0 else b""
                stated = field(head, "WARC-Payload-Length")
                # A record that ends with its chunk is whole here; others are put together later.
                whole = reach == size + len(MAGIC)
                body = body[: -len(END)] if whole else body
                payload = body[body.find(END.encode()) + len(END) :] if whole and END.encode() in body else b""
                rows.append((
                    file, part, place, size + len(MAGIC), reach, field(head, "WARC-Type"), page_number(field(head, "WARC-Record-ID")), field(head, "WARC-Target-URI"),
                    int(stated) if stated and stated.isdigit() else None, (field(head, "WARC-Payload-Digest") or "").removeprefix("sha1:") or None, page_number(field(head, "WARC-Refers-To")),
                    raw.decode("utf-8", "replace") if texts else None, len(raw[: len(raw) - len(END) - len(payload)].decode("utf-8", "replace")) if texts else None, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(),
                ))
                place += size + len(MAGIC)
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), schema.types)], schema=schema) if rows else pa.RecordBatch.from_pylist([], schema=schema)

    lines = spark.read.option("lineSep", MAGIC).text(path).select(F.col("value").cast("binary"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("part"))
    if files is not None:
        lines = lines.join(files, F.col("file") == F.col("of_file"), "left_semi")
    return lines.mapInArrow(parse, CHUNK).select(*names)


def reachable(candidates: DataFrame) -> DataFrame:
    """``file`` and ``offset`` of the candidates that the chain of ``file``, ``offset``, ``next`` reaches from offset 0 of each file.

    Pointer jumping: after round k all of the first 2^k records are known, and each candidate's pointer leads 2^k records on.
    The rounds are as many as the logarithm of the longest chain. Pointers only lead on, so a claim cannot make a loop.
    """
    jumps = written(candidates.where("next > offset").select("file", "offset", "next"), "jumps")
    known = written(candidates.where("offset = 0").select("file", "offset"), "reached")
    while True:
        new = known.join(jumps, ["file", "offset"]).select("file", F.col("next").alias("offset"))
        known, before = written(known.unionByName(new).distinct(), "reached"), known
        if known.count() == before.count():
            break
        on = jumps.select("file", F.col("offset").alias("next"), F.col("next").alias("further"))
        jumps = written(jumps.join(on, ["file", "next"]).select("file", "offset", F.col("further").alias("next")), "jumps")
    return known.join(candidates.select("file", "offset"), ["file", "offset"], "left_semi")


def read_warc(spark: SparkSession, path: str, bodies: bool = True) -> DataFrame:
    """A row for each record that the chains reach: the header's fields, and ``body``, ``body_bytes``, ``body_digest`` of the payload that was read.

    A record whose payload holds the magic line is put together from its chunks. Files are known by path; an archive without records gives an empty result.
    One pass reads all there is to know of whole records, and writes it down without their texts. Texts are read again for
    ``bodies`` (else ``body`` is null), and from the files that hold a record to be put together.
    """
    found = written(chunks(spark, path, texts=False), "chunks")
    # One row for each split: where its first chunk stands. A file has as many splits as its size calls for.
    ends = found.groupBy("file", "part").agg(F.sum("size").alias("bytes"))
    ahead = Window.partitionBy("file").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = ends.select("file", "part", F.coalesce(F.sum("bytes").over(ahead), F.lit(0)).alias("base"))
    # The text before a file's first magic line is not a candidate: it is empty in a proper file, and moves all offsets by the magic it lacks.
    place = F.col("base") + F.col("place") - len(MAGIC)
    candidates = found.select("file", "part", "place", "size", "reach").join(bases, ["file", "part"])
    candidates = candidates.select("file", "part", "place", "size", place.alias("offset"), F.when(F.col("reach") > 0, place + F.col("reach")).otherwise(-1).alias("next"))
    candidates = written(candidates.where("offset >= 0"), "candidates")
    starts = written(reachable(candidates), "record-starts")
    # Chunks that no chain reaches belong to the record before them in their file: numbers only, the texts stay where they are.
    flags = candidates.join(starts.withColumn("begin", F.col("offset")), ["file", "offset"], "left")
    flags = flags.withColumn("whole", F.col("next") == F.col("offset") + F.col("size"))
    owner = F.last("begin", True).over(Window.partitionBy("file").orderBy("offset"))
    flags = written(flags.withColumn("record", owner).where("record is not null"), "chunk-owners")
    fields = ["kind", "page_id", "url", "payload_bytes", "payload_digest", "refers_to", "body", "body_bytes", "body_digest"]
    # What stands between the head of the HTTP block and the two line ends that close the record.
    body = F.col("raw").substr(F.col("body_from") + 1, F.length("raw") - F.col("body_from") - len(END)) if bodies else F.lit(None).cast("string")
    records = (chunks(spark, path) if bodies else found).withColumn("body", body)
    whole = records.join(flags.where("begin is not null and whole").select("file", "part", "place"), ["file", "part", "place"], "left_semi").select(*fields)
    broken = written(flags.join(flags.where("begin is not null and not whole").select("file", "record"), ["file", "record"], "left_semi"), "broken-records")
    if broken.isEmpty():
        return whole
    parts = chunks(spark, path, files=broken.select(F.col("file").alias("of_file")).distinct())
    parts = parts.join(broken.select("file", "part", "place", "record", "offset"), ["file", "part", "place"])
    firsts = [F.min_by(c, "offset").alias(c) for c in fields if not c.startswith("body")]
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("offset", F.col("raw").alias("b")))), lambda s: s["b"]), MAGIC)
    # The text of a record from its header on: the HTTP head and the payload lie between the first and the last blank line.
    text = parts.groupBy("file", "record").agg(*firsts, F.min_by("reach", "offset").alias("reach"), joined.alias("text"))
    text = text.withColumn("block", F.expr(r"substring(text, locate('\r\n\r\n', text) + 4)")).withColumn("block", F.expr("substring(block, 1, length(block) - 4)"))
    text = text.withColumn("body", F.when(F.expr(r"locate('\r\n\r\n', block) > 0"), F.expr(r"substring(block, locate('\r\n\r\n', block) + 4)")).otherwise(""))
    text = text.withColumn("body_bytes", F.octet_length("body").cast("long")).withColumn("body_digest", sha1_base32(F.col("body")))
    text = text if bodies else text.withColumn("body", F.lit(None).cast("string"))
    return whole.unionByName(text.select(*fields))


def archive_path(spark: SparkSession) -> str:
    return scratch_path(spark, "warc")
