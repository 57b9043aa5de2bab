"""Packing along a space-filling curve: neighbouring documents share training sequences.

Each document's ids are projected to a few dimensions (the mean of fixed random signs that a hash gives every id), the
coordinates are scaled by their mean and deviation over all documents, and the cell on a Hilbert curve is the
sort key. Documents are range-sorted by it; their ids, laid end to end in that order, are cut every ``length``
ids. So every sequence but the last is full, and it holds documents that lie close together on the curve.
"""

from __future__ import annotations

from math import erf

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentmart.llm.common import cut_lineage, pick, range_parts, running_total, small_batches
from rentmart.llm.records import encoded_texts, ids_crc, pack_ids, unpack_ids
from rentmart.llm.textarrays import mix

DIMS, BITS = 4, 12


def id_signs(n: int = 65_536, dims: int = DIMS) -> np.ndarray:
    """-1 or 1 for each id and dimension, from a hash of both."""
    h = mix(np.arange(n, dtype=np.uint64)[:, None] * np.uint64(64) + np.arange(1, dims + 1, dtype=np.uint64))
    return (h >> np.uint64(40) & np.uint64(1)).astype(np.float32) * 2 - 1


def hilbert_key(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Index on the Hilbert curve of each row of integer coordinates (below 2^bits), by Skilling's transform."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(dims):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where((x[dims - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = key << 1 | (x[i] >> b & 1)
    return key


def pack(docs: DataFrame, tokenizer: str, length: int = 1024) -> DataFrame:
    """One row per piece of a document: doc_id, start (its ids before the piece), length, ids (little-endian unsigned
    16-bit), ids_crc32, doc_tokens, sequence_id, offset (in the sequence), padding (of that sequence), curve_key.

    ``docs``: doc_id, text; other columns are ignored. A null or empty text is the end id alone. Rows that share a
    doc_id are packed each; a null id is kept as null. No rows give no pieces. A sequence that falls short is to
    be padded to ``length``, unless its own length is a power of two; only the last one can fall short.
    """
    spark = docs.sparkSession
    small_batches(spark)
    dims = [f"p{i}" for i in range(DIMS)]

    def tokens(batches):
        signs = id_signs()
        for part, ids in encoded_texts(batches, tokenizer):
            at = np.array([signs[i].mean(axis=0, dtype=np.float64) for i in ids])
            yield pa.RecordBatch.from_pydict({
                "doc_id": part.column("doc_id").cast(pa.int64()),
                "n": pa.array([len(i) for i in ids], pa.int64()),
                "ids": pa.array([pack_ids(i) for i in ids], pa.binary()),
                **{d: pa.array(at[:, i]) for i, d in enumerate(dims)},
            })

    spec = "doc_id long, n long, ids binary, " + ", ".join(f"{d} double" for d in dims)
    encoded = pick(docs, "doc_id", "text").mapInArrow(tokens, spec)
    encoded = cut_lineage(encoded.withColumn("row", F.monotonically_increasing_id()))
    s = encoded.agg(F.coalesce(F.sum("n"), F.lit(0)), *[f(d) for d in dims for f in (F.avg, F.stddev_pop)]).first()
    total, centre = s[0], np.array([s[i] or 0.0 for i in range(1, 2 * DIMS, 2)])
    scale = np.array([s[i] or 1.0 for i in range(2, 2 * DIMS + 1, 2)])

    def keys(batches):
        normal = np.vectorize(lambda z: 0.5 + 0.5 * erf(z / 2**0.5), otypes=[float])
        for b in batches:
            if b.num_rows:
                z = (np.array([b.column(d).to_numpy() for d in dims]).T - centre) / scale
                cells = np.minimum((normal(z) * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)
                yield pa.RecordBatch.from_pydict({n: b.column(n) for n in ("row", "doc_id", "n")} | {"curve_key": pa.array(hilbert_key(cells))})

    order = [F.col("curve_key"), F.col("doc_id"), F.col("row")]
    narrow = encoded.select("row", "doc_id", "n", *dims).mapInArrow(keys, "row long, doc_id long, n long, curve_key long")
    placed = running_total(range_parts(narrow, order), "_part", order, "n", "place").select("row", "curve_key", "place")
    fill = total % length
    padding = 0 if fill == 0 or fill & (fill - 1) == 0 else length - fill

    def cut(batches):
        for b in batches:
            out = {k: [] for k in ("doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens", "sequence_id", "offset", "padding", "curve_key")}
            for doc, n, z, key, place in zip(*(b.column(c).to_pylist() for c in ("doc_id", "n", "ids", "curve_key", "place")), strict=True):
                ids, at = unpack_ids(z), 0
                while at < n:
                    sequence, offset = divmod(place + at, length)
                    piece = ids[at : at + length - offset]
                    for k, v in zip(out, (doc, at, len(piece), piece.tobytes(), ids_crc(piece), n, sequence, offset, padding if sequence == total // length else 0, key), strict=True):
                        out[k].append(v)
                    at += len(piece)
            yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.binary() if k == "ids" else pa.int64()) for k, v in out.items()})

    spec = "doc_id long, start long, length long, ids binary, ids_crc32 long, doc_tokens long, sequence_id long, offset long, padding long, curve_key long"
    wide = encoded.select("row", "doc_id", "n", "ids").join(placed.hint("shuffle_hash"), "row")
    return wide.mapInArrow(cut, spec)
