"""WARC archives: writing, normalising monolithic gzip files, offset index, reading back.

A monolithic archive is one gzip stream over many records, which can only be read from its
start. ``normalise`` inflates each such file once, as a stream, writes every record as a gzip
member of its own and, beside each archive, a sidecar index with the offset and length of
every record, so that a record can be cut out and inflated alone (``inflate_at``).

All files go through Spark's own text source, so they may live wherever Spark can read and
write: an archive is "text" whose line separator is the blank line between records. Reading
splits at blank lines, inflating as it goes, and the parser joins the pieces again by the
records' stated lengths, whatever bytes they hold; a task holds one record at a time. Writing
uses that a gzip member of less than 16 MiB ends in a zero byte (the top byte of its length):
zero is the separator, and each member is handed over without its last byte. A record of
16 MiB or more becomes a run of such members, which its one index entry spans.

Cases: NULL payloads are empty; NULL ids and addresses are written as empty values and read as
NULL; control characters and spaces in an address become %20; repeated rows are repeated
records; an empty table gives no records. A stream that ends within a record, lacks a length
or contradicts its digest raises ValueError: a damaged archive is never read as a short one.
"""

from __future__ import annotations

import base64
import hashlib
import json
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallystick.sources.workspace import staged

BREAK = "\r\n\r\n"
MEMBER_BYTES = (1 << 24) - 1
INDEX_LINES = 4096
DATE = "2000-01-01T00:00:00Z"
INDEX_SCHEMA = "record_id string, record_type string, target_uri string, payload_digest string, offset long, length long"
RECORD_SCHEMA = (
    "record_id string, record_type string, target_uri string, refers_to string, "
    "payload_digest string, payload_bytes long, payload binary"
)


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: four characters for each five hexadecimal digits."""
    digest = F.sha1(payload)
    digits = F.concat(*(F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)))
    return F.translate(digits, "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def with_revisits(records: DataFrame, order: str, min_bytes: int = 0) -> DataFrame:
    """Adds payload_digest, payload_bytes, record_type and ``original``.

    Of records with equal payloads of at least ``min_bytes``, the one with the largest
    ``order`` is the response (all of them if several share it, or if none has a value); the
    others are revisits and ``original`` is that value. Only digests that occur twice are
    written out, so Spark joins them by broadcast or by a merge, going by their size.
    """
    payload = F.coalesce(F.col("payload"), F.lit("").cast("binary"))
    records = records.withColumn("payload", payload).withColumn("payload_digest", base32_sha1(F.col("payload")))
    records = records.withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    equal = records.where(F.col("payload_bytes") >= min_bytes).groupBy(F.col("payload_digest").alias("_digest"))
    repeated = equal.agg(F.max(order).alias("original"), F.count("*").alias("_n")).where("_n > 1 and original is not null")
    joined = records.join(staged(repeated.drop("_n"), "repeated"), F.col("payload_digest") == F.col("_digest"), "left").drop("_digest")
    revisit = F.col("original").isNotNull() & ~F.col(order).eqNullSafe(F.col("original"))
    return joined.withColumn("record_type", F.when(revisit, "revisit").otherwise("response")).withColumn(
        "original", F.when(revisit, F.col("original"))
    )


def write_monolithic(records: DataFrame, folder: str, date: str = DATE) -> None:
    """One gzip stream per partition. Revisits keep their HTTP header but not the payload.

    ``records``: record_id, record_type, target_uri, refers_to, payload_digest, payload_bytes
    and payload; see ``with_revisits``.
    """
    response = F.col("record_type") == "response"
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit(BREAK),
    )
    block = F.concat(http, F.when(response, F.col("payload").cast("string")).otherwise(""))
    profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.col("record_type")),
        F.concat(F.lit("WARC-Record-ID: <"), F.coalesce("record_id", F.lit("")), F.lit(">")),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace(F.coalesce("target_uri", F.lit("")), r"[\x00-\x20\x7F]", "%20")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest")),
        F.when(~response, F.concat(F.lit("WARC-Refers-To: <"), F.coalesce("refers_to", F.lit("")), F.lit(">"))),
        F.when(~response, F.lit(f"WARC-Profile: {profile}")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    ]
    record = F.concat(F.concat_ws("\r\n", *lines), F.lit(BREAK), block)
    records.select(record.alias("value")).write.text(folder, compression="gzip", lineSep=BREAK)


def _pieces(spark: SparkSession, folder: str) -> DataFrame:
    rows = spark.read.text(folder, lineSep=BREAK)
    return rows.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("value"))


def parse(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[dict[str, str], bytes, bytes]]:
    """(header fields, header bytes, block) of each record of a stream of (file, value) pieces."""
    current, held = None, bytearray()
    stop = BREAK.encode()
    for batch in batches:
        for file, value in zip(batch["file"], batch["value"], strict=True):
            if file != current:
                _ended(current, held)
                current, held = file, bytearray()
            held += value
            held += stop
            while (head := held.find(stop)) >= 0:
                if not head:  # blank lines between records, or the break added after the last one
                    del held[:4]
                    continue
                fields = _fields(bytes(held[:head]), current)
                end = head + 4 + int(fields["content-length"])
                if len(held) < end + 4:
                    break
                if held[end : end + 4] != stop:
                    raise ValueError(f"no blank line after a record of {current}")
                yield fields, bytes(held[:head]), bytes(held[head + 4 : end])
                del held[: end + 4]
    _ended(current, held)


def _ended(file: str | None, held: bytearray) -> None:
    if held.strip(b"\r\n"):
        raise ValueError(f"{file} ends within a record")


def _fields(head: bytes, file: str) -> dict[str, str]:
    version, *lines = head.decode(errors="replace").lstrip("\r\n").split("\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    if not version.startswith("WARC/") or not fields.get("content-length", "").isdigit():
        raise ValueError(f"not a WARC record header in {file}: {version[:40]!r}")
    return fields


def _bare(value: str | None) -> str | None:
    return (value or "").strip("<>") or None


def gzip_members(data: bytes, size: int = MEMBER_BYTES) -> bytes:
    """One gzip member, or a run of them where the data exceeds ``size``; ends in a zero byte."""
    run = []
    for at in range(0, max(len(data), 1), size):
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        run.append(packer.compress(data[at : at + size]) + packer.flush())
    return b"".join(run)


def inflate_at(archive: bytes, offset: int, length: int) -> bytes:
    """The record at an index entry's place."""
    data, rest = b"", archive[offset : offset + length]
    while rest:
        member = zlib.decompressobj(31)
        data += member.decompress(rest)
        rest = member.unused_data
    return data


def normalise(spark: SparkSession, monolithic: str, folder: str) -> None:
    """Rewrites the archives of one folder to ``folder``/archives/N.warc.gz, a gzip member per
    record, with ``folder``/index/N.cdxj.gz: JSON lines of INDEX_SCHEMA. One pass over the input.
    """

    def rewrite(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        offset, count, lines = 0, 0, []
        for fields, head, block in parse(batches):
            member = gzip_members(head + BREAK.encode() + block + BREAK.encode())
            entry = {
                "record_id": _bare(fields.get("warc-record-id")),
                "record_type": fields.get("warc-type"),
                "target_uri": fields.get("warc-target-uri"),
                "payload_digest": _digest(fields),
                "offset": offset,
                "length": len(member),
            }
            lines.append(json.dumps(entry) + "\n")
            yield 0, count, member[:-1]
            offset, count = offset + len(member), count + 1
            if len(lines) == INDEX_LINES:
                yield 1, count, gzip_members("".join(lines).encode())[:-1]
                lines = []
        if lines:
            yield 1, count, gzip_members("".join(lines).encode())[:-1]

    rows = _mapped(_pieces(spark, monolithic), rewrite, "side int, place long, value binary")
    records = Observation()
    rows = rows.observe(records, F.count_if(F.col("side") == 0).alias("written"))
    ordered = rows.sortWithinPartitions("side", "place").select("side", F.col("value").cast("string").alias("value"))
    # An index holds offsets into one file, so a task may not begin another one.
    ordered.write.option("maxRecordsPerFile", 0).partitionBy("side").text(f"{folder}/parts", lineSep="\0")
    archives = _named(spark, f"{folder}/parts/side=0", f"{folder}/archives", "warc.gz")
    indexes = _named(spark, f"{folder}/parts/side=1", f"{folder}/index", "cdxj.gz")
    written, listed = records.get["written"], read_index(spark, folder).count() if indexes else 0
    if archives != indexes or written != listed:
        raise OSError(f"{written} records in {archives} archives, but {listed} in {indexes} indexes of {folder}")


def _named(spark: SparkSession, parts: str, folder: str, ending: str) -> list[str]:
    """Moves Spark's part files to names by part number, so archive and index go together.
    Returns the numbers; raises if a file cannot be moved or a number comes up twice."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path(folder))
    numbers = []
    if files.exists(path(parts)):
        for status in files.listStatus(path(parts)):
            name = status.getPath().getName()
            if name.startswith("part-"):
                numbers.append(name.split("-")[1])
                if not _moved(files, status.getPath(), path(f"{folder}/{numbers[-1]}.{ending}")):
                    raise OSError(f"cannot move {name} to {folder}/{numbers[-1]}.{ending}")
    return sorted(numbers)


def _moved(files, source, target) -> bool:
    """Never over another file."""
    return not files.exists(target) and files.rename(source, target)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """INDEX_SCHEMA and ``archive``, the number that archive and index share."""
    rows = spark.read.schema(INDEX_SCHEMA).json(f"{folder}/index")
    return rows.withColumn("archive", F.regexp_extract(F.col("_metadata.file_name"), r"^(\d+)", 1))


def read_archives(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """RECORD_SCHEMA of every record; digests and lengths of responses are recomputed."""

    def records(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        for fields, _, block in parse(batches):
            http, _, payload = block.partition(BREAK.encode())
            digest, size = _digest(fields), len(payload)
            if fields.get("warc-type") == "revisit":
                stated = [line.split(":")[1] for line in http.decode(errors="replace").split("\r\n") if line.lower().startswith("content-length:")]
                size, payload = int(stated[0]) if stated else None, None
            else:
                found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                if digest not in (None, found):
                    raise ValueError(f"payload digest of {fields.get('warc-record-id')} is {found}, not {digest}")
                digest = found
            yield (
                _bare(fields.get("warc-record-id")), fields.get("warc-type"), fields.get("warc-target-uri") or None,
                _bare(fields.get("warc-refers-to")), digest, size, payload if with_payload else None,
            )

    return _mapped(_pieces(spark, f"{folder}/archives"), records, RECORD_SCHEMA)


def _digest(fields: dict[str, str]) -> str | None:
    return (fields.get("warc-payload-digest") or "").removeprefix("sha1:") or None


def _mapped(pieces: DataFrame, rows: Callable[[Iterator[pd.DataFrame]], Iterator[tuple]], schema: str) -> DataFrame:
    """Rows of Python tuples, handed to Spark in frames of at most 256 rows or about 16 MB."""
    columns = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for row in rows(batches):
            held.append(row)
            size += len(row[-1] or b"")
            if len(held) == 256 or size > 1 << 24:
                yield pd.DataFrame(held, columns=columns, dtype=object)
                held, size = [], 0
        if held:
            yield pd.DataFrame(held, columns=columns, dtype=object)

    return pieces.mapInPandas(run, schema)
