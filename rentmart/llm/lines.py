"""Line dedup: range-partitioned line hashes, sorted by document, streamed; the answer is a keep bitmap per document.

Each document gives one row per distinct line key: two 64-bit hashes and the line numbers. Rows are range-partitioned
and sorted by hash and document, so the lines of one key stand in a row, a hot key is cut over several
partitions, and the first row of a key is its first occurrence. A partition's first key may have begun in an earlier
one; each partition therefore also reports its last key, and these few rows settle the open cases. Only line
numbers go back to the documents, never text.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentmart.llm.common import cut_lineage, schema_of, small_batches, stored
from rentmart.llm.textarrays import IS_SPACE, LOWER, flat, slices, span_hash

NO_ID = -(1 << 63)  # stands for a null doc_id, which thereby counts as the smallest


def line_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each line (without its line feed) and the number of lines of each text (one at least)."""
    feeds = np.flatnonzero(data == 10)
    n = np.searchsorted(feeds, offsets[1:]) - np.searchsorted(feeds, offsets[:-1]) + 1
    starts = np.sort(np.concatenate([offsets[:-1], feeds + 1]), kind="stable")
    ends = np.sort(np.concatenate([offsets[1:], feeds]), kind="stable")
    return starts, ends, n


def line_keys(data: np.ndarray, offsets: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """Text and number in it of each line whose key has ``least`` code points or more, and its two hashes."""
    starts, ends, n = line_spans(data, offsets)
    owner = np.repeat(np.arange(len(n)), n)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    solid = np.flatnonzero(~IS_SPACE[data])
    a, b = np.searchsorted(solid, starts), np.searchsorted(solid, ends)
    some = np.flatnonzero(b > a)
    starts, ends = solid[a[some]], solid[b[some] - 1] + 1
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    long = points[ends] - points[starts] >= least
    some, starts, ends = some[long], starts[long], ends[long]
    low = LOWER[data]
    return owner[some], number[some], span_hash(low, starts, ends, 0), span_hash(low, starts, ends, 1)


def _pack(number: np.ndarray, first: np.ndarray) -> pa.Array:
    """Line numbers as unsigned 32-bit integers, one binary value for each group that begins at ``first``."""
    offsets = np.append(first, len(number)).astype(np.int32) * 4
    return pa.BinaryArray.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(number.astype("<u4"))])


def repeated_lines(docs: DataFrame, least: int = 10) -> DataFrame:
    """(doc, tag, lines): the numbers of the lines to drop, as a list of packed unsigned 32-bit integers, for each text
    (doc_id, hash of the text) that loses any. ``docs``: doc_id long, doc long, tag long, text string."""
    small_batches(docs.sparkSession)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                owner, number, h1, h2 = line_keys(*flat(part.column("text")), least)
                order = np.lexsort((number, h2, h1, owner))
                owner, number, h1, h2 = owner[order], number[order], h1[order], h2[order]
                new = np.ones(len(owner), bool)
                new[1:] = (owner[1:] != owner[:-1]) | (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
                first = np.flatnonzero(new)
                yield pa.RecordBatch.from_pydict({
                    "h1": pa.array(h1[first].view(np.int64)), "h2": pa.array(h2[first].view(np.int64)),
                    "doc": part.column("doc").take(pa.array(owner[first])), "tag": part.column("tag").take(pa.array(owner[first])),
                    "lines": _pack(number, first),
                })

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = doc = None
        opening = True  # still in the partition's first key
        where = TaskContext.get().partitionId()
        spec = pa.schema([("kind", pa.int32()), ("part", pa.int32()), *[(c, pa.int64()) for c in ("h1", "h2", "doc", "tag")], ("lines", pa.binary())])

        def out(kind: int, rows: pa.RecordBatch) -> pa.RecordBatch:
            n = rows.num_rows
            return pa.RecordBatch.from_arrays([pa.array(np.full(n, v, np.int32)) for v in (kind, where)] + [rows.column(c) for c in spec.names[2:]], schema=spec)

        for b in batches:
            if not b.num_rows:
                continue
            h1, h2, d = (b.column(c).to_numpy() for c in ("h1", "h2", "doc"))
            new = np.ones(len(h1), bool)
            new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
            new[0] = key != (h1[0], h2[0])
            run = np.cumsum(new)  # 0: the run that the batch before left open
            firsts = np.concatenate([[0 if doc is None else doc], d[new]])
            later = d != firsts[run]
            if opening:
                first_run = run == (1 if key is None else 0)
                yield out(1, b.filter(pa.array(first_run & ~later)))
                opening = bool(first_run.all())
            yield out(0, b.filter(pa.array(later)))
            key, doc, last = (h1[-1], h2[-1]), firsts[run[-1]], b.slice(b.num_rows - 1)
        if key is not None:
            yield out(2, last)

    columns = "h1 long, h2 long, doc long, tag long, lines binary"
    # stored: a range partitioning reads its rows twice, first to find the bounds
    rows = stored(docs.select("doc", "tag", "text").mapInArrow(keys, columns), "lines")
    rows = rows.repartitionByRange("h1", "h2", "doc").sortWithinPartitions("h1", "h2", "doc")
    found = cut_lineage(rows.mapInArrow(stream, f"kind int, part int, {columns}"))
    ended = found.filter("kind = 2").groupBy("h1", "h2").agg(F.min("part").alias("begun"))  # a row per partition at most
    carried = found.filter("kind = 1").join(F.broadcast(ended), ["h1", "h2"]).filter("begun < part")
    dropped = found.filter("kind = 0").select("doc", "tag", "lines").unionByName(carried.select("doc", "tag", "lines"))
    return dropped.groupBy("doc", "tag").agg(F.collect_list("lines").alias("lines"))  # lines of one document


def dedup_lines(docs: DataFrame, least: int = 10) -> DataFrame:
    """All columns of ``docs`` with the kept lines as ``text``, and n_lines, n_dropped, keep_bitmap (zlib-compressed bits,
    most significant first, one per line), kept_sha256.

    A key is the line without white space at both ends, A-Z in lower case. Keys of ``least`` code points or more that
    stand in two documents or more lose all lines but those of the smallest doc_id. A null or empty text is one
    empty line, and its text becomes empty. Rows that share a doc_id are one document; a null id is the smallest.
    A row stays, with an empty text, when it loses all its lines. An empty table gives no row.
    """
    cols = docs.columns
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols if c != "text"]).alias("_rest"), F.col("text"),
                    F.coalesce("doc_id", F.lit(NO_ID)).cast("long").alias("doc"), F.xxhash64("text").alias("tag"))
    drops = repeated_lines(d.select("doc", "tag", "text"), least)
    joined = d.join(drops.hint("shuffle_hash"), ["doc", "tag"], "left").select("_rest", "text", "lines")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                texts, n, gone, bits, sha = [], [], [], [], []
                for text, drop in zip(part.column("text").to_pylist(), part.column("lines").to_pylist(), strict=True):
                    text = text or ""
                    lines = text.split("\n")
                    keep = np.ones(len(lines), bool)
                    if drop:
                        keep[np.frombuffer(b"".join(drop), "<u4")] = False
                        text = "\n".join([x for x, k in zip(lines, keep, strict=True) if k])
                    texts.append(text)
                    n.append(len(lines))
                    gone.append(int(len(lines) - keep.sum()))
                    bits.append(zlib.compress(np.packbits(keep).tobytes(), 1))
                    sha.append(hashlib.sha256(text.encode()).hexdigest())
                yield pa.RecordBatch.from_pydict({
                    "_rest": part.column("_rest"), "text": pa.array(texts, pa.string()), "n_lines": pa.array(n, pa.int64()),
                    "n_dropped": pa.array(gone, pa.int64()), "keep_bitmap": pa.array(bits, pa.binary()), "kept_sha256": pa.array(sha),
                })

    new = ["n_lines long", "n_dropped long", "keep_bitmap binary", "kept_sha256 string"]
    out = joined.mapInArrow(apply, schema_of(joined.drop("lines"), ", ".join(new)))
    return out.select(*[F.col("text") if c == "text" else F.col(f"_rest.`{c}`") for c in cols], *[x.split()[0] for x in new])
