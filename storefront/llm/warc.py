"""WARC archives with a Zstandard dictionary of their own.

Each archive is one file of a Spark write: a leading skippable frame that
holds a dictionary built from the archive's own records, then one Zstandard
frame per record, compressed with that dictionary, so each record can be
read by itself. Spark's writers commit the files task by task, on any file
system Spark can write to; the frames go through the text writer, whose line
separator is an empty skippable frame, which readers of the format pass over.

Of records with equal payloads (from a least size on) the one with the
smallest id is a response and the others are revisits that refer to it. The
smallest ids are a partial aggregate over digests, so a payload that a third
of all pages share costs one row per task, and the join with pages is one
that Spark splits when skewed.

Defined results: a null payload is empty; a null id is never the smallest
(if no copy has an id, all are responses) and is written without the id's
header; rows that share the smallest id are all responses; a null URL is left
out; line breaks in URLs are percent-encoded; an empty table gives archives
without records; a very long payload is one record; extra columns play no
part, whatever their names.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storefront.llm.shared import column, written

DICTIONARY_MAGIC = 0x184D2A5D  # skippable frame that holds an archive's dictionary
EMPTY_FRAME = "\x50\x2a\x4d\x18\x00\x00\x00\x00"  # skippable frame of no bytes
ZSTD_DICTIONARY = b"\x37\xa4\x30\xec"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
REVISIT = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = b"1970-01-01T00:00:00Z"  # the tables hold no fetch times


def record_id(page: str | None, digest: str) -> bytes:
    return b"<urn:uuid:%s>" % str(uuid.uuid5(uuid.NAMESPACE_URL, f"page:{page}:{digest}")).encode()


def record(page: str | None, url: str | None, payload: bytes, digest: str, first: str | None) -> bytes:
    """One WARC/1.1 record; ``first`` is the id referred to by a revisit."""
    http = HTTP % len(payload)
    block = http if first is not None else http + payload
    head = [b"WARC/1.1", b"WARC-Type: " + (b"response" if first is None else b"revisit"),
            b"WARC-Record-ID: " + record_id(page, digest), b"WARC-Date: " + DATE]
    if url is not None:
        head.append(b"WARC-Target-URI: " + url.encode().replace(b"\r", b"%0D").replace(b"\n", b"%0A"))
    if page is not None:
        head.append(b"X-Page-ID: " + page.encode())
    if first is not None:
        head += [b"WARC-Profile: " + REVISIT, b"WARC-Refers-To: " + record_id(first, digest),
                 b"X-Refers-To-Page-ID: " + first.encode()]
    head += [b"WARC-Payload-Digest: sha256:" + digest.encode(), b"Content-Type: application/http;msgtype=response",
             b"Content-Length: %d" % len(block)]
    return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """The fields of a record, its payload's size and digest taken from the
    payload itself, or for a revisit from its headers."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = {k.decode(): v.decode() for k, v in (x.split(b": ", 1) for x in head.split(b"\r\n")[1:])}
    http, _, payload = rest[:int(fields["Content-Length"])].partition(b"\r\n\r\n")
    out = {"page": fields.get("X-Page-ID"), "url": fields.get("WARC-Target-URI"), "record_type": fields["WARC-Type"],
           "refers_to": fields.get("X-Refers-To-Page-ID")}
    if out["record_type"] == "response":
        return out | {"payload_bytes": len(payload), "payload_digest": hashlib.sha256(payload).hexdigest(),
                      "payload": payload}
    sizes = [int(x[16:]) for x in http.split(b"\r\n") if x.startswith(b"Content-Length: ")]
    return out | {"payload_bytes": sizes[0], "payload_digest": fields["WARC-Payload-Digest"][7:], "payload": None}


def dictionary(records: list[bytes], size: int) -> bytes:
    """A dictionary of about ``size`` bytes; the records' own last bytes where
    there are too few to train on."""
    try:
        return zstandard.train_dictionary(size, records, k=512, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(records)[-size:]


def _coder(words: bytes) -> zstandard.ZstdCompressionDict:
    kind = zstandard.DICT_TYPE_FULLDICT if words.startswith(ZSTD_DICTIONARY) else zstandard.DICT_TYPE_RAWCONTENT
    return zstandard.ZstdCompressionDict(words, dict_type=kind)


def with_firsts(rows: DataFrame, least_revisit: int) -> DataFrame:
    """``rows`` (_id, payload, digest, ...) with ``_first``, the smallest id of
    a payload that several rows share."""
    firsts = (rows.filter(F.octet_length("payload") >= least_revisit).groupBy("digest")
              .agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1"))
    # Written first: a join that shuffles both sides itself can be split where one payload has most rows.
    return rows.join(written(firsts.select("digest", "_first"), "first-copies"), "digest", "left")


def write_archives(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", payload: str = "html",
                   least_revisit: int = 100, dictionary_bytes: int = 32_768, train_bytes: int = 2_000_000,
                   level: int = 3) -> None:
    """Write a record for each row of ``pages`` into archives under ``path``.

    The dictionary is built from an archive's first ``train_bytes`` of
    records; its size and that bound affect compression only."""
    rows = pages.select(column(pages, page_id).cast("string").alias("page"), column(pages, page_id).alias("_id"),
                        column(pages, url).alias("url"), F.coalesce(column(pages, payload), F.lit("")).alias("payload"))
    joined = with_firsts(rows.withColumn("digest", F.sha2("payload", 256)), least_revisit)
    other = F.col("_id").isNull() | (F.col("_id") > F.col("_first"))
    records = joined.select("page", "url", "payload", "digest",
                            F.when(F.col("_first").isNotNull() & other, F.col("_first").cast("string")).alias("first"))

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = (record(page, link, body.encode(), digest, first)
                for batch in batches for page, link, body, digest, first in
                zip(*[batch.column(i).to_pylist() for i in range(5)], strict=True))
        head, size = [], 0
        for one in made:
            head.append(one)
            size += len(one)
            if size >= train_bytes:
                break
        if not head:
            return
        words = dictionary(head, dictionary_bytes)
        squeeze = zstandard.ZstdCompressor(level=level, dict_data=_coder(words)).compress
        yield batch_of([struct.pack("<II", DICTIONARY_MAGIC, len(words)) + words, *map(squeeze, head)])
        out: list[bytes] = []
        for one in made:
            out.append(squeeze(one))
            if len(out) == 1000:
                yield batch_of(out)
                out = []
        yield batch_of(out)

    def batch_of(values: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(values, pa.binary())], ["frame"])

    made = records.mapInArrow(frames, "frame binary")
    made.select(F.col("frame").cast("string").alias("value")).write.option("lineSep", EMPTY_FRAME).text(path)


def records_in(archive: bytes) -> Iterator[bytes]:
    """The records of one archive, decompressed one by one."""
    at, words = 0, None
    while at < len(archive):
        magic, size = struct.unpack_from("<II", archive, at)
        if magic & 0xFFFFFFF0 == 0x184D2A50:  # skippable frames
            if magic == DICTIONARY_MAGIC and words is None:
                words = archive[at + 8:at + 8 + size]
                reader = zstandard.ZstdDecompressor(dict_data=_coder(words))
            at += 8 + size
            continue
        frame, out = reader.decompressobj(), []
        while not frame.eof and at < len(archive):
            piece = archive[at:at + 4096]
            out.append(frame.decompress(piece))
            at += len(piece)
        at -= len(frame.unused_data)
        yield b"".join(out)


def read_archives(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to)
    per record of the archives under ``path``."""
    fields = ["page", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column(0):
                out = []
                for raw in records_in(archive.as_buffer().to_pybytes()):
                    out.append(parse(raw))
                    if len(out) == 1000:
                        yield batch_of(out)
                        out = []
                yield batch_of(out)

    def batch_of(parsed: list[dict]) -> pa.RecordBatch:
        kinds = [pa.int64() if f == "payload_bytes" else pa.string() for f in fields]
        return pa.RecordBatch.from_arrays([pa.array([p[f] for p in parsed], k) for f, k in zip(fields, kinds, strict=True)],
                                          fields)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    got = files.mapInArrow(read, "page string, url string, payload_bytes long, payload_digest string, "
                                 "record_type string, refers_to string")
    return got.select(F.col("page").cast(id_type).alias("page_id"), "url", "payload_bytes", "payload_digest",
                      "record_type", F.col("refers_to").cast(id_type).alias("refers_to"))
