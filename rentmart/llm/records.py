"""Token-ID output: length-delimited binary records of whole documents, with an offset index.

A record is: payload length (unsigned 64-bit, little endian), masked CRC-32 of those eight bytes, the payload, masked
CRC-32 of the payload, and one line feed, which Spark's text writer puts behind every row. The mask rotates the
checksum right by 15 bits and adds 0xA282EAD8, so that checksums of data that hold checksums stay sound. The payload
is one serialized sequence: a flag byte (1: the document has an id), the id (signed 64-bit), the number of token ids
(unsigned 32-bit) and the ids (unsigned 16-bit), compressed by zstd.

Files are written by Spark's own committed writer in ascending doc_id (null first), one per range of ids, so a
lost task or executor leaves no half file. ``index/`` holds file, ordinal, offset and size of each record; with it
``read_records`` fetches any records in any order.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentmart.llm.common import cut_lineage, pick, running_total, small_batches
from rentmart.llm.textarrays import slices
from rentmart.llm.tokens import encoder

END_ID = 0
#: bytes of text for one file of records, about (a file is one row when it is read back)
FILE_BYTES = 32 << 20
_HEAD, _PAYLOAD = "<QI", "<BqI"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return length + struct.pack("<I", masked(length)) + payload + struct.pack("<I", masked(payload))


def unframe(data: memoryview, at: int) -> tuple[memoryview, int]:
    """The payload of the record at this offset, checked, and the offset of the next record."""
    length, check = struct.unpack_from(_HEAD, data, at)
    if masked(bytes(data[at : at + 8])) != check:
        raise ValueError(f"damaged record length at byte {at}")
    payload = data[at + 12 : at + 12 + length]
    if len(payload) != length or struct.unpack_from("<I", data, at + 12 + length)[0] != masked(bytes(payload)):
        raise ValueError(f"damaged record at byte {at}")
    return payload, at + 12 + length + 5


def ids_crc(ids: np.ndarray) -> int:
    """CRC-32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())


def pack_ids(ids: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(ids.astype("<u2").tobytes())


def unpack_ids(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), "<u2")


def encoded_texts(batches: Iterator[pa.RecordBatch], tokenizer: str) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Pieces of the batches with the ids of each text, the end id appended."""
    for batch in batches:
        for part in slices(batch, "text"):
            ids, n = encoder(tokenizer).encode(part.column("text"))
            ends = np.cumsum(n)
            yield part, [np.append(ids[e - k : e], np.uint16(END_ID)) for e, k in zip(ends, n, strict=True)]


def write_records(docs: DataFrame, path: str, tokenizer: str) -> str:
    """Encodes every whole text of ``docs`` (doc_id long, text string; null text: empty) into files under ``path``.

    Repeated ids give one record per row; an empty table gives no record. Returns ``path``.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = pick(docs, "doc_id", "text")
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b"), F.count("*").alias("n")).first()
    files = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size["b"] // FILE_BYTES))
    steps = [i / files for i in range(1, files)]
    bounds = sorted(set(rows.agg(F.percentile_approx("doc_id", steps, 20 * files)).first()[0] or [])) if steps else []

    def tokens(batches):
        for part, ids in encoded_texts(batches, tokenizer):
            doc = part.column("doc_id").to_pylist()
            yield pa.RecordBatch.from_pydict({
                "file": pa.array([0 if d is None else bisect_left(bounds, d) for d in doc], pa.int32()),
                "doc_id": pa.array(doc, pa.int64()),
                "n": pa.array([len(i) for i in ids], pa.int64()),
                "ids": pa.array([pack_ids(i) for i in ids], pa.binary()),
            })

    def framed(batches):
        for batch in batches:
            doc, n, ids = (batch.column(c).to_pylist() for c in ("doc_id", "n", "ids"))
            yield pa.RecordBatch.from_pydict({"value": pa.array(
                [frame(struct.pack(_PAYLOAD, d is not None, d or 0, k) + z) for d, k, z in zip(doc, n, ids, strict=True)], pa.binary()
            )})

    dealt = rows.mapInArrow(tokens, "file int, doc_id long, n long, ids binary").repartitionById(len(bounds) + 1, "file")
    records = dealt.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "n", "ids").mapInArrow(framed, "value binary")
    records.select(F.col("value").cast("string")).write.mode("overwrite").text(f"{path}/records")

    def walk(batches):
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                data, at, rows_ = memoryview(content.as_buffer()), 0, []
                while at < len(data):
                    length = struct.unpack_from(_HEAD, data, at)[0]
                    has, doc, n = struct.unpack_from(_PAYLOAD, data, at + 12)
                    rows_.append((len(rows_), doc if has else None, at, length + 17, n))
                    at += length + 17
                for k in range(0, len(rows_), 50_000):
                    o, d, a, s, n = zip(*rows_[k : k + 50_000], strict=True)
                    yield pa.RecordBatch.from_pydict({
                        "file": pa.array([name.rpartition("/")[2]] * len(o)), "ordinal": pa.array(o, pa.int64()),
                        "doc_id": pa.array(d, pa.int64()), "offset": pa.array(a, pa.int64()),
                        "size": pa.array(s, pa.int64()), "n_tokens": pa.array(n, pa.int64()),
                    })

    spread_files(spark, path).mapInArrow(
        walk, "file string, ordinal long, doc_id long, offset long, size long, n_tokens long"
    ).write.mode("overwrite").parquet(f"{path}/index")
    return path


def spread_files(spark: SparkSession, path: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")  # one file of records a batch
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/records")
    return files.select("path", "content")


def read_records(spark: SparkSession, path: str, wanted: DataFrame | None = None) -> DataFrame:
    """(file, ordinal, doc_id, n_tokens, ids) of all records, or of those whose (file, ordinal) are in ``wanted``,
    found through the index. Every checksum is verified. ``ids`` are little-endian unsigned 16-bit integers."""
    spec = "file string, ordinal long, doc_id long, n_tokens long, ids binary"
    return _read(spark, path, wanted, spec, lambda ids: {"ids": pa.array([i.tobytes() for i in ids], pa.binary())})


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """As ``read_records``, with the CRC-32 of the ids in place of the ids."""
    spec = "file string, ordinal long, doc_id long, n_tokens long, ids_crc32 long"
    return _read(spark, path, None, spec, lambda ids: {"ids_crc32": pa.array([ids_crc(i) for i in ids], pa.int64())})


def _read(spark: SparkSession, path: str, wanted: DataFrame | None, spec: str, last) -> DataFrame:
    files = spread_files(spark, path)
    if wanted is not None:
        index = spark.read.parquet(f"{path}/index").join(wanted.select("file", "ordinal").distinct(), ["file", "ordinal"])
        at = index.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("ordinal", "offset"))).alias("at"))  # of one file
        files = files.withColumn("file", F.element_at(F.split("path", "/"), -1)).join(at, "file").drop("file")

    def records(data: memoryview, at: list | None):
        if at is not None:
            yield from ((x["ordinal"], unframe(data, x["offset"])[0]) for x in at)
            return
        place, k = 0, 0
        while place < len(data):
            payload, place = unframe(data, place)
            yield k, payload
            k += 1

    def out(name: str, found: list) -> pa.RecordBatch:
        ordinal, doc, n, ids = zip(*found, strict=True)
        return pa.RecordBatch.from_pydict({
            "file": pa.array([name] * len(ordinal)), "ordinal": pa.array(ordinal, pa.int64()),
            "doc_id": pa.array(doc, pa.int64()), "n_tokens": pa.array(n, pa.int64()), **last(ids),
        })

    def parse(batches):
        for batch in batches:
            ats = batch.column("at").to_pylist() if "at" in batch.schema.names else [None] * batch.num_rows
            for name, content, at in zip(batch.column("path").to_pylist(), batch.column("content"), ats, strict=True):
                name, found, held = name.rpartition("/")[2], [], 0
                for ordinal, payload in records(memoryview(content.as_buffer()), at):
                    has, doc, n = struct.unpack_from(_PAYLOAD, payload)
                    ids = unpack_ids(bytes(payload[struct.calcsize(_PAYLOAD) :]))
                    if len(ids) != n:
                        raise ValueError("a record holds another number of ids than it says")
                    found.append((ordinal, doc if has else None, n, ids))
                    held += n
                    if held > 2_000_000:
                        yield out(name, found)
                        found, held = [], 0
                if found:
                    yield out(name, found)

    return files.mapInArrow(parse, spec)


def documents_from_records(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 of every record read back."""
    back = cut_lineage(read_digests(spark, path))
    small_batches(spark)
    return running_total(back, "file", [F.col("ordinal")], "n_tokens", "start").select("doc_id", "start", "n_tokens", "ids_crc32")
