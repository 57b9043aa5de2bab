"""Substring dedup by recompression: repeated word windows are found through shared symbols.

Words are symbols of level 0. Where a document is read, a first round names every run of exactly two equal symbols and
a second one every pair whose left and right symbol fall into different halves of the alphabet (a bit of the name
decides). A name is the 64-bit hash of the words that a symbol stands for, so it is the same in every document without a
table of names. Where a symbol ends depends on a few words around it, hence equal passages hold the same symbols in their
interior. The symbols with the smallest name within any ``SPREAD`` words begin the *blocks*: the words from one such
place to the next are one symbol of the next level, and the hash of the ``REACH`` words behind its start is its key.

From here on Spark names: a round counts the names of all documents and keeps symbols that occur twice. The first one
keeps blocks by their keys: every window of the asked length holds the key of a block that depends on the window's words
alone, so a window that occurs twice holds a key that occurs twice, and only windows around such keys matter. In
each further round neighbours that were kept are joined, runs of equal symbols first, then pairs, and what does
not occur twice is dropped; the data shrink from round to round. A symbol of a window's length or more that occurs twice
is a repeat by itself: all its words go, and its windows are looked at in one of its places alone. The other windows
and these are hashed over all documents, and so are the long symbols, by two 64-bit hashes of their words. A task
sends one of its equal windows on and has the others settled at once; what it sends meets its like in one sorted
stream, so that a window of very many documents is a few rows there.

Nothing is capped; documents of the same words are one document with copies. Texts are read from the input again where
they are needed and never stored.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentmart.llm.common import cut_lineage, key_filter, pick, small_batches, stored, union_all, with_maybe
from rentmart.llm.textarrays import IS_SPACE, flat, mix, slices, span_hash, words

#: words on each side that can change where a symbol ends, after both rounds
CONTEXT = 4
REACH = 8
#: rounds of joining kept symbols: a symbol may hold 2 ** ROUNDS blocks, and runs of any length
ROUNDS = 2
#: windows that a task holds before it sends them on
HELD = 1 << 18


def spread_for(window: int) -> int:
    """Consecutive word positions of which one starts an anchor, inside any window."""
    reach = min(REACH, max(1, (window - 2 * CONTEXT) // 2))
    return window - 2 * CONTEXT - reach + 1


def symbols(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start word of each symbol after a round of runs and a round of pairs, and its name. ``h``: word hashes of
    documents laid end to end, ``first``: the first word of each (one more than documents); no symbol spans two."""
    n = len(h)
    begins = np.zeros(n + 1, bool)
    begins[first] = True
    # runs of exactly two
    same = np.zeros(n + 1, bool)
    same[1:n] = (h[1:] == h[:-1]) & ~begins[1:n]
    joined = same[:n].copy()  # this word continues a run of two
    joined[1:] &= ~same[: n - 1]
    joined &= ~same[1:]
    starts = np.flatnonzero(~joined)
    ends = np.append(starts[1:], n)
    name = span_hash(h, starts, ends)
    # pairs: left half then right half
    side = (name >> np.uint64(7)) & np.uint64(1)
    pair = np.zeros(len(starts), bool)
    pair[1:] = (side[:-1] == 0) & (side[1:] == 1) & ~begins[starts[1:]]
    starts = starts[~pair]
    ends = np.append(starts[1:], n)
    return starts, span_hash(h, starts, ends)


def first_least(values: np.ndarray, wide: int) -> np.ndarray:
    """Position of the first smallest value of every ``wide`` consecutive ones, by spans that double."""
    at, span = np.arange(len(values)), 1
    while span < wide:
        step = min(span, wide - span)
        at = np.where(values[step:] < values[:-step], at[step:], at[:-step])
        values = np.minimum(values[step:], values[:-step])
        span += step
    return at


def anchors(h: np.ndarray, first: np.ndarray, window: int) -> np.ndarray:
    """Positions of the anchors of documents laid end to end (word hashes, first word of each), ascending."""
    n, sizes = len(h), np.diff(first)
    if not (sizes >= window).any():
        return np.zeros(0, np.int64)
    wide = spread_for(window)
    starts, names = symbols(h, first)
    rank = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    rank[starts] = names
    # a place whose ``wide`` positions lie in one document, with the words of a key behind each of them
    places = spans(n - wide + 1, first[:-1], np.where(sizes >= window, first[1:] - window + 2 * CONTEXT + 1, first[:-1]))
    found = np.zeros(n, bool)
    for at in range(0, len(places), 1 << 16):  # in bounded pieces
        part = places[at : at + (1 << 16)]
        found[at + first_least(rank[at : at + len(part) + wide - 1], wide)[part]] = True
    return np.flatnonzero(found)


def spans(size: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Which of ``size`` places lie in one of the spans, of which none ends before it begins."""
    change = np.bincount(np.minimum(low, size), minlength=size + 1) - np.bincount(np.minimum(high, size), minlength=size + 1)
    return np.cumsum(change[:size]) > 0


def _word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Both hashes of the words of all texts, and the first word of each text (one more than texts)."""
    data, offsets = flat(column)
    starts, ends, first = words(data, offsets)
    return span_hash(data, starts, ends, 0), span_hash(data, starts, ends, 1), first.astype(np.int64)


def _lists(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values))


def _entries(lists: pa.Array, *names: str) -> tuple[np.ndarray, list[pa.Array]]:
    """The entries of a column of lists of structs (null: none): the list of each, and these of their fields."""
    size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    flat_ = pc.list_flatten(lists)
    return np.repeat(np.arange(len(lists)), size), [flat_.field(flat_.type.get_field_index(c)) for c in names]


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def join_symbols(at: np.ndarray, end: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One round over the kept symbols of one document, in order: which of them begin a joined symbol, and its name.

    ``at`` and ``end`` are the words that a symbol spans; a neighbour begins where the one before ends. Runs of
    equal neighbours become one symbol, then pairs by the halves of the alphabet.
    """
    next_to = np.zeros(len(names), bool)
    next_to[1:] = at[1:] == end[:-1]
    run = next_to.copy()
    run[1:] &= names[1:] == names[:-1]
    starts = np.flatnonzero(~run)
    count = np.diff(np.append(starts, len(names))).astype(np.uint64)
    named = np.where(count > 1, mix(names[starts] + count * np.uint64(0x9E3779B97F4A7C15)), names[starts])
    side = (named >> np.uint64(9)) & np.uint64(1)
    pair = np.zeros(len(starts), bool)
    pair[1:] = next_to[starts[1:]] & (side[:-1] == 0) & (side[1:] == 1)
    heads = np.flatnonzero(~pair)
    right = np.append(pair[1:], False)[heads]
    out = named[heads]
    out[right] = mix(out[right] * np.uint64(0xC2B2AE3D27D4EB4F) + named[heads[right] + 1])
    return starts[heads], out


def _joined(kept: DataFrame) -> DataFrame:
    """(row, at, end, name): the symbols of the next level, from those kept of the last one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("row", "at", "end", "name")}
            for row, symbols_ in zip(batch.column("row").to_pylist(), batch.column("symbols"), strict=True):
                at, end, name = (symbols_.values.field(c).to_numpy(zero_copy_only=False) for c in ("at", "end", "name"))
                begin, named = join_symbols(at, end, name.view(np.uint64))
                out["row"].append(np.full(len(begin), row, np.int64))
                for c, x in (("at", at[begin]), ("end", end[np.append(begin[1:], len(at)) - 1]), ("name", named.view(np.int64))):
                    out[c].append(x)
            yield pa.RecordBatch.from_pydict({
                c: pa.array(np.concatenate(x) if x else np.zeros(0, np.int64), pa.int64() if c in ("row", "name") else pa.int32()) for c, x in out.items()
            })

    listed = kept.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("at", "end", "name"))).alias("symbols"))
    return listed.mapInArrow(run, "row long, at int, end int, name long")


def _twice(level: DataFrame) -> DataFrame:
    """The symbols whose name occurs twice in all documents, and whether this is the name's first place."""
    names = level.groupBy("name").agg(F.count("*").alias("m"), F.min(F.struct("row", "at")).alias("place")).filter("m > 1")
    kept = level.join(names.select("name", "place"), "name")
    return kept.select("row", "at", "end", "name", (F.struct("row", "at") == F.col("place")).alias("here"))


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a stream sorted by (g1, g2) whose key stands there twice, or that were found before."""
    held = None  # the last row, whose next one is still to come
    same = False  # and whether it has the key of the row before
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks().to_batches()[0]
        g1, g2 = (rows.column(c).to_numpy() for c in ("g1", "g2"))
        alike = np.zeros(len(g1) + 1, bool)  # each row and the one before
        alike[0] = same
        alike[1:-1] = (g1[1:] == g1[:-1]) & (g2[1:] == g2[:-1])
        again = (alike[:-1] | alike[1:]) | rows.column("again").to_numpy(zero_copy_only=False)
        held, same = rows.slice(rows.num_rows - 1), bool(alike[-2])
        yield rows.slice(0, rows.num_rows - 1).filter(pa.array(again[:-1])).select(["row", "start", "words"])
    if held is not None and (same or held.column("again")[0].as_py()):
        yield held.select(["row", "start", "words"])


def remove_repeats(docs: DataFrame, window: int = 35) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, text (kept words joined by one blank), for each row of ``docs``.

    ``docs``: doc_id, text; other columns are ignored. Words are runs of anything but white space, unchanged. A word
    goes when a window of ``window`` words that covers it also starts anywhere else, in this document or another.
    A null, empty or blank text has no word and an empty result. Rows that share a doc_id, or have none, are
    documents each. Texts shorter than a window stay whole. An empty table gives no row. ``window``: 12 or more.
    """
    if window < 2 * CONTEXT + 4:
        raise ValueError("window too short for its symbols")
    spark = docs.sparkSession
    small_batches(spark)
    reach = min(REACH, max(1, (window - 2 * CONTEXT) // 2))
    # equal texts are one: two hashes stand for a text until it is read again
    text = F.coalesce("text", F.lit(""))
    d = pick(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("t1"), F.xxhash64(F.lit("t2"), text).alias("t2")
    )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                h, h2, first = _word_hashes(part.column("text"))
                w1, w2 = (span_hash(x, first[:-1], first[1:]) for x in (h, h2))
                at = anchors(h, first, window)
                offsets = np.searchsorted(at, first)
                owner = np.repeat(np.arange(part.num_rows), np.diff(offsets))
                keys = span_hash(h, at, at + reach)
                blocks = span_hash(h, at, np.minimum(np.append(at[1:], len(h))[: len(at)], first[owner + 1]))
                yield pa.RecordBatch.from_pydict({
                    "t1": part.column("t1"), "t2": part.column("t2"), "n": pa.array(np.diff(first)), "w1": _long(w1), "w2": _long(w2),
                    "keys": _lists(keys.view(np.int64), offsets), "blocks": _lists(blocks.view(np.int64), offsets),
                    "at": _lists((at - first[owner]).astype(np.int32), offsets),
                })

    base = d.select("text", "t1", "t2").mapInArrow(digest, "t1 long, t2 long, n long, w1 long, w2 long, keys array<long>, blocks array<long>, at array<int>")
    # the number of a row is fixed by the stored table, so a lost executor cannot change it
    base = stored(base.withColumn("row", F.monotonically_increasing_id()), "blocks")
    classes = base.groupBy("n", "w1", "w2").agg(F.min("row").alias("row"), F.count("*").alias("copies"))
    classes = cut_lineage(classes)
    one = base.join(classes.select("row"), "row")
    ends = F.concat(F.slice("at", 2, F.size("at")), F.array(F.col("n").cast("int")))
    entries = one.filter("size(at) > 0").select("row", F.explode(F.arrays_zip("keys", "blocks", "at", ends.alias("ends"))).alias("e"))
    entries = entries.select("row", F.col("e.at").alias("at"), F.col("e.ends").alias("end"), F.col("e.keys").alias("key"), F.col("e.blocks").alias("name"))
    # the first round, by keys
    shared = entries.groupBy("key").agg(F.count("*").alias("m")).filter("m > 1").select("key")
    spots = stored(entries.join(shared, "key").select("row", "at", "end", "name"), "spots")
    kept, covers = _twice(spots), []
    for _ in range(ROUNDS):
        kept = stored(_twice(_joined(kept)), "symbols")
        covers.append(kept.filter(F.col("end") - F.col("at") >= window).select("row", "at", "end", "here"))
        kept = kept.drop("here")
    covers = union_all(covers).distinct()
    plan = spots.select("row", "at", F.lit(None).cast("int").alias("end"), F.lit(False).alias("here")).unionByName(covers)
    plan = plan.groupBy("row").agg(F.collect_list(F.struct("at", "end", "here")).alias("plan"))  # one document's own
    plan = stored(plan.join(base.select("row", "t1", "t2"), "row"), "plan")

    def listed_of(plans: pa.Array, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last word (one behind) of the windows and long symbols that are to be hashed, in documents laid end to end."""
        owner, (at, end, here) = _entries(plans, "at", "end", "here")
        begin, n = first[owner], int(first[-1])
        is_cover = end.is_valid().to_numpy(zero_copy_only=False)
        at = at.to_numpy(zero_copy_only=False).astype(np.int64) + begin
        end = end.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) + begin
        here = here.to_numpy(zero_copy_only=False).astype(bool) & is_cover
        last = np.maximum(first[owner + 1] - window + 1, begin)  # behind the last window of the document

        def inside(which: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
            return spans(n, np.clip(low, begin, last)[which], np.clip(high, begin, last)[which])

        # windows that hold the key of a shared block, but for those inside a long symbol that is not in its first place;
        # a symbol of a window's length is one of the windows
        near = inside(~is_cover, at - window + reach, at + 1) & ~inside(is_cover, at, end - window + 1)
        near |= inside(here, at, end - window + 1)
        near[at[is_cover & (end - at == window)]] = True
        start = np.flatnonzero(near)
        long = np.unique((at * (n + 1) + end)[is_cover & (end - at > window)])
        return np.concatenate([start, long // (n + 1)]), np.concatenate([start + window, long % (n + 1)])

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def out() -> Iterator[pa.RecordBatch]:
            g1, g2, row, start, size = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            order = np.lexsort((g2, g1))
            g1, g2, row, start, size = (x[order] for x in (g1, g2, row, start, size))
            new = np.ones(len(g1), bool)
            new[1:] = (g1[1:] != g1[:-1]) | (g2[1:] != g2[:-1])
            group = np.cumsum(new) - 1
            again = np.bincount(group)[group] > 1
            # the others of a group have found each other: they are only passed on, under one key of no window
            g1, g2 = np.where(new, g1, mix(g1[:1])), np.where(new, g2, np.uint64(0))
            for k in range(0, len(g1), 1 << 16):
                x = slice(k, k + (1 << 16))
                yield pa.RecordBatch.from_pydict({
                    "g1": _long(g1[x]), "g2": _long(g2[x]), "row": pa.array(row[x]), "start": pa.array(start[x].astype(np.int32)),
                    "words": pa.array(size[x].astype(np.int32)), "again": pa.array(again[x]),
                })

        n = 0
        for batch in batches:
            for part in slices(batch, "text"):
                h, h2, first = _word_hashes(part.column("text"))
                start, end = listed_of(part.column("plan"), first)
                rows = part.column("row").to_numpy()
                for k in range(0, len(start), HELD):
                    a, b = start[k : k + HELD], end[k : k + HELD]
                    owner = np.searchsorted(first, a, side="right") - 1
                    held.append((span_hash(h, a, b, 0), span_hash(h2, a, b, 1), rows[owner], a - first[owner], b - a))
                    n += len(a)
                    if n >= HELD:
                        yield from out()
                        n = 0
        if held:
            yield from out()

    # one row of each text; those without a shared block stay where they are
    planned = cut_lineage(key_filter(plan, "t1"))
    texts = with_maybe(d.select("t1", "t2", "text"), "t1", planned, "wanted").filter("wanted").drop("wanted").join(plan, ["t1", "t2"]).groupBy("row", "t1", "t2").agg(F.first("text").alias("text"), F.first("plan").alias("plan"))
    columns = "g1 long, g2 long, row long, start int, words int, again boolean"
    windows = texts.select("row", "text", "plan").mapInArrow(hashes, columns)
    met = windows.repartition(F.xxhash64("g1", "g2")).sortWithinPartitions("g1", "g2").mapInArrow(_met, "row long, start int, words int")
    starts = met.groupBy("row").agg(F.collect_list(F.struct("start", "words")).alias("starts"))
    # all words of a document that has copies go, if it holds a window; its other texts have the same words
    marks = classes.join(starts, "row", "left").filter(f"starts is not null or (copies > 1 and n >= {window})")
    marks = marks.select("n", "w1", "w2", "starts", ((F.col("copies") > 1) & (F.col("n") >= window)).alias("whole"))
    marks = base.select("t1", "t2", "n", "w1", "w2").distinct().join(marks, ["n", "w1", "w2"]).select("t1", "t2", "starts", "whole")
    marks = stored(marks, "marks")
    marked = with_maybe(d, "t1", cut_lineage(key_filter(marks, "t1")), "marked")
    joined = marked.filter("marked").join(marks.hint("shuffle_hash"), ["t1", "t2"], "left").select("doc_id", "text", "starts", "whole")
    none = [F.lit(None).cast(joined.schema[c].dataType).alias(c) for c in ("starts", "whole")]
    joined = joined.unionByName(marked.filter("not marked").select("doc_id", "text", *none))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                data, offsets = flat(part.column("text"))
                begin, end, first = words(data, offsets)
                first = first.astype(np.int64)
                owner, (start, size) = _entries(part.column("starts"), "start", "words")
                start = start.to_numpy(zero_copy_only=False).astype(np.int64) + first[owner]
                drop = spans(len(begin), start, start + size.to_numpy(zero_copy_only=False))
                drop |= np.repeat(pc.fill_null(part.column("whole"), False).to_numpy(zero_copy_only=False), np.diff(first))
                gone = np.concatenate([[0], np.cumsum(drop)])[first]
                # a kept word takes the byte behind it along as its blank, but for the last one of a text
                keep = np.flatnonzero(~drop)
                text_of = np.repeat(np.arange(part.num_rows), np.diff(first))[keep]
                more = np.append(text_of[1:] == text_of[:-1], False)[: len(keep)]
                stop = end[keep] + more
                change = np.zeros(len(data) + 1, np.int8)
                change[begin[keep]] += 1
                change[stop] -= 1
                kept = np.where(IS_SPACE[data], np.uint8(0x20), data)[np.cumsum(change[:-1], dtype=np.int8) > 0]
                offsets = np.concatenate([[0], np.cumsum(stop - begin[keep])])[np.searchsorted(text_of, np.arange(part.num_rows + 1))]
                raw = kept.tobytes()
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column("doc_id"), "n_words": pa.array(np.diff(first)), "n_removed": pa.array(np.diff(gone).astype(np.int64)),
                    "kept_sha256": pa.array([hashlib.sha256(raw[x:y]).hexdigest() for x, y in itertools.pairwise(offsets.tolist())], pa.string()),
                    "text": pa.StringArray.from_buffers(part.num_rows, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(raw)),
                })

    return joined.mapInArrow(apply, "doc_id long, n_words long, n_removed long, kept_sha256 string, text string")
