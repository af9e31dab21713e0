"""WARC archives with an index of byte ranges.

Every task writes the records of its partition to one file, each record a gzip member of its
own, and returns an index row per record: file, offset, length, URL and digest. The index is
stored as Parquet; records that it doesn't name (of a lost or repeated task) don't exist.
Reading starts from the index: the ranges of the selected records are sorted and ranges close
to each other are joined, so one read serves many records, and no file is opened as a whole.

Of equal payloads of at least 100 bytes the record with the smallest id is a response and the
others are revisits, which name it and hold no payload; readers get a revisit's size and digest
from its own headers, and a response's from the payload itself.

Defined cases: a null or empty payload is an empty response; a null URL becomes an empty one;
a null id is stored as an empty header and is a revisit only of a record with an id; rows that
repeat an id are all responses if that id is the smallest of their payload, or all revisits;
a payload of any length is one record; an empty table gives an archive without records.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import small_batches
from tidewatch.session import stage, stage_path

LEAST_BYTES = 100
#: Ranges of one file are read together if no more than so many bytes lie between them, up to about READ_BYTES.
GAP_BYTES = 1 << 16
READ_BYTES = 1 << 22
#: What a reading task takes, about.
TASK_BYTES = 1 << 24
# Schemes of Hadoop's file systems and what the same stores are called here.
SCHEMES = {"s3a://": "s3://", "s3n://": "s3://", "abfss://": "abfs://", "dbfs:/": "file:///dbfs/"}
# The WARC profile of revisits to an identical payload.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "file string, offset long, length long, url string, digest string, record_id long, record_type string"
RECORDS = "record_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def place(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder or file, and the path on it."""
    for scheme, known in SCHEMES.items():
        if uri.startswith(scheme):
            uri = known + uri.removeprefix(scheme).lstrip("/")
    return fs.FileSystem.from_uri(uri if ":/" in uri else f"file://{uri}")


def record(record_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record as a gzip member."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head if refers_to is not None else head + payload
    named = uuid.uuid5(uuid.NAMESPACE_URL, f"{record_id} {url} {digest}")
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", f"<urn:uuid:{named}>"),
        ("WARC-Date", "2024-01-01T00:00:00Z"), ("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")),
        ("WARC-Payload-Digest", f"sha256:{digest}"), ("X-Record-Number", "" if record_id is None else str(record_id)),
        ("X-Payload-Length", str(len(payload))), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block))),
    ]
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("X-Refers-To-Number", str(refers_to))]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    packer = zlib.compressobj(5, wbits=31)
    return packer.compress(text.encode() + block + b"\r\n\r\n") + packer.flush()


def write_batches(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    system, path = place(folder)
    out, name, offset = None, f"{uuid.uuid4().hex}.warc.gz", 0
    try:
        for batch in batches:
            rows = []
            for one in batch.to_pylist():
                if out is None:
                    system.create_dir(path, recursive=True)
                    out = system.open_output_stream(f"{path}/{name}", compression=None)
                url, payload = one["url"] or "", (one["payload"] or "").encode()
                digest = hashlib.sha256(payload).hexdigest()
                packed = record(one["record_id"], url, payload, digest, one["refers_to"])
                out.write(packed)
                kind = "response" if one["refers_to"] is None else "revisit"
                rows.append((f"{folder}/{name}", offset, len(packed), url, digest, one["record_id"], kind))
                offset += len(packed)
            yield table_of(rows, INDEX)
    finally:
        if out is not None:
            out.close()


def table_of(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(list(c), kinds[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields])


def first_of_payloads(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """``record_id, refers_to`` for the records that are revisits."""
    size = F.coalesce(F.octet_length("payload"), F.lit(0))
    digests = pages.where(size >= least).select("record_id", F.sha2(F.col("payload").cast("binary"), 256).alias("digest"))
    firsts = digests.groupBy("digest").agg(F.min("record_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1")
    later = digests.join(firsts.select("digest", "refers_to"), "digest").where("record_id > refers_to")
    return later.select("record_id", "digest", "refers_to").distinct()


def write_archive(pages: DataFrame, path: str, least: int = LEAST_BYTES) -> str:
    """Write ``pages(record_id, url, payload)``. Only ids and digests are grouped; payloads are shuffled by id at most."""
    spark = pages.sparkSession
    small_batches(spark, 200)
    pages = pages.select(F.col("record_id").cast("long").alias("record_id"), "url", "payload")
    revisits = first_of_payloads(pages, least)
    # A payload belongs to its digest too, as an id may come with several payloads.
    keyed = pages.withColumn("digest", F.sha2(F.coalesce("payload", F.lit("")).cast("binary"), 256))
    typed = keyed.join(revisits, ["record_id", "digest"], "left").select("record_id", "url", "payload", "refers_to")
    rows = typed.mapInArrow(lambda it: write_batches(it, f"{path}/data"), INDEX)
    rows.write.parquet(f"{path}/index")
    return path


def archive_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(f"{path}/index")


def parse(raw: bytes) -> tuple:
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    number = lambda name: int(fields[name]) if fields.get(name, "").strip() else None
    kind, url = fields["WARC-Type"], fields["WARC-Target-URI"]
    if kind == "revisit":
        return number("X-Record-Number"), url, kind, number("X-Refers-To-Number"), number("X-Payload-Length"), fields["WARC-Payload-Digest"].partition(":")[2], None
    payload = block.partition(b"\r\n\r\n")[2]
    return number("X-Record-Number"), url, kind, None, len(payload), hashlib.sha256(payload).hexdigest(), payload


def read_batches(batches: Iterator[pa.RecordBatch], keep_payload: bool) -> Iterator[pa.RecordBatch]:
    """One row per joined range, with the records in it; each range is one read."""
    opened, current = None, None
    for batch in batches:
        for one in batch.to_pylist():
            if one["file"] != current:
                if opened is not None:
                    opened.close()
                system, path = place(one["file"])
                opened, current = system.open_input_file(path), one["file"]
            start = one["start"]
            data = opened.read_at(one["stop"] - start, start)
            rows = []
            for part in one["records"]:
                low = part["offset"] - start
                row = parse(zlib.decompress(data[low : low + part["length"]], wbits=31))
                rows.append(row if keep_payload else (*row[:-1], None))
            yield table_of(rows, RECORDS)
    if opened is not None:
        opened.close()


def joined_ranges(selected: DataFrame, gap: int = GAP_BYTES, most: int = READ_BYTES) -> DataFrame:
    """``file, start, stop, records``: sorted ranges of ``selected(file, offset, length)``, near ones joined.

    A file is one writer's partition; within it a range ends where a large gap begins or where
    the next multiple of ``most`` bytes is passed.
    """
    order = Window.partitionBy("file").orderBy("offset")
    end = F.col("offset") + F.col("length")
    before = F.lag(end).over(order)
    fresh = before.isNull() | (F.col("offset") - before > gap) | (F.floor(F.col("offset") / most) > F.floor(F.lag("offset").over(order) / most))
    marked = selected.select("file", "offset", "length", F.when(fresh, 1).otherwise(0).alias("fresh"))
    numbered = marked.withColumn("range", F.sum("fresh").over(order))
    return numbered.groupBy("file", "range").agg(
        F.min("offset").alias("start"), F.max(end).alias("stop"), F.array_sort(F.collect_list(F.struct("offset", "length"))).alias("records")
    )


def read_records(selected: DataFrame, keep_payload: bool = True) -> DataFrame:
    """The records that rows of the index name."""
    small_batches(selected.sparkSession, 200)
    ranges = stage(joined_ranges(selected.select("file", "offset", "length").distinct()).drop("range"), "warc-ranges")
    # Ranges are few rows that stand for many bytes, so tasks are counted by the bytes they read, not by rows.
    total = ranges.agg(F.sum(F.col("stop") - F.col("start"))).first()[0] or 0
    dealt = ranges.repartitionByRange(max(1, -(-total // TASK_BYTES)), "file", "start").sortWithinPartitions("file", "start")
    return dealt.mapInArrow(lambda it: read_batches(it, keep_payload), RECORDS)


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write the archive to the shared folder and read every record back through its index."""
    spark = pages.sparkSession
    path = write_archive(pages, stage_path(spark, "warc"))
    return read_records(archive_index(spark, path), keep_payload=False)
