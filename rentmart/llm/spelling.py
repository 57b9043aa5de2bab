"""Spelling variants: words one edit apart, found by dense prefix-suffix tiling.

Two words differ by exactly one inserted, deleted or replaced code point if and only if their longest common prefix and
suffix together reach the longer word's length less one. An edit leaves one half of the shorter word's length
untouched, at the front or at the back, so words meet by (shorter length, front or back, that half). Each meeting is cut
into tiles of about ``TILE`` words by a hash; every pair of its tiles is compared densely: the words as padded matrices of
code points, prefixes and suffixes grown column by column for all pairs at once. A pair that shares both halves counts
at the front alone, so each is counted once, in one tile pair. Tiles hand on a count and the best partner
of each word, no pairs: a meeting of any size is spread over its tile pairs and never held by one task.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentmart.llm.common import cut_lineage, pick, roots, small_batches, stored

# What a word is, which runs lose a code point, and which words count.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
DIVISOR, LEAST_LENGTH, LEAST_COUNT = 97, 5, 3

#: words of a tile, on average; words counted in a task before they are handed on
TILE, HELD = 512, 100_000
_CHUNK = 1 << 20
FRONT, BACK = 0, 1


def text_runs(text: str) -> Counter:
    """The runs of a whole text, A-Z lower-cased, with their counts; a long text is read in pieces that end behind a run."""
    low = text.encode().lower().decode()  # bytes: A-Z alone
    counts: Counter = Counter()
    at = 0
    while at < len(low):
        end = at + _CHUNK
        cut = RUN.match(low, end)
        end = cut.end() if cut else end
        counts.update(RUN.findall(low, at, end))
        at = end
    return counts


def document_words(doc_id: str, runs: Counter) -> Iterator[tuple[str, int]]:
    """The runs as words: one whose hash with the id is a multiple of ``DIVISOR`` loses a code point."""
    start = zlib.crc32(f"{doc_id}:".encode())
    for run, n in runs.items():
        h = zlib.crc32(run.encode(), start)
        if h % DIVISOR == 0:
            cut = h % len(run)
            run = run[:cut] + run[cut + 1 :]
        yield run, n


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n) of all documents: words of ``LEAST_LENGTH`` code points that occur ``LEAST_COUNT`` times."""
    small_batches(docs.sparkSession)
    d = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), "text").filter("text is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"word": pa.array(counts.keys(), pa.string()), "n": pa.array(counts.values(), pa.int64())})

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                for word, n in document_words(doc_id, text_runs(text.as_py())):
                    if len(word) >= LEAST_LENGTH:
                        counts[word] += n
                if len(counts) >= HELD:
                    yield out()
                    counts.clear()
        yield out()

    found = d.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return found.filter(F.col("n") >= LEAST_COUNT)


def _matrix(words: list[bytes], width: int, pad: bytes, front: bool) -> np.ndarray:
    padded = [w.ljust(width, pad) if front else w[::-1].ljust(width, pad) for w in words]
    return np.frombuffer(b"".join(padded), np.uint8).reshape(len(words), width)


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each row of ``a`` and each row of ``b``."""
    alike = np.ones((len(a), len(b)), bool)
    total = np.zeros((len(a), len(b)), np.int32)
    for x, y in zip(a.T, b.T, strict=True):
        alike &= x[:, None] == y[None, :]
        if not alike.any():
            break
        total += alike
    return total


def single_edits(a: list[bytes], b: list[bytes], shorter: int, side: int) -> np.ndarray:
    """Which pairs of two tiles are one edit apart, the shorter word having ``shorter`` code points (one byte each)."""
    long_a, long_b = (np.array([len(w) > shorter for w in x]) for x in (a, b))
    width = shorter + 1
    # unlike pads: behind its end a word agrees with nothing
    front = _common(_matrix(a, width, b"\0", True), _matrix(b, width, b"\1", True))
    back = _common(_matrix(a, width, b"\0", False), _matrix(b, width, b"\1", False))
    longer = shorter + (long_a[:, None] | long_b[None, :])
    # alike words reach their whole length with the prefix alone
    near = (front + back >= longer - 1) & (front < longer) & ~(long_a[:, None] & long_b[None, :])
    return near & (front < shorter // 2) if side == BACK else near


def _tile_results(a: list[str], na: np.ndarray, b: list[str], nb: np.ndarray, near: np.ndarray) -> Iterator[tuple[str, int, str, int]]:
    """(word, near words, the best of them, its count) for the rows of ``near``."""
    order = np.array(sorted(range(len(b)), key=lambda j: (-nb[j], b[j])))
    ranked = near[:, order]
    for i in np.flatnonzero(ranked.any(axis=1)).tolist():
        best = int(order[int(ranked[i].argmax())])
        yield a[i], int(ranked[i].sum()), b[best], int(nb[best])


def near_words(words: DataFrame, tile: int = TILE) -> DataFrame:
    """(word, n_near, best, best_n) for the words of (word, n) with a word one edit apart; best: largest n, smallest word."""
    small_batches(words.sparkSession)
    length = F.char_length("word")
    meets = words.select(
        "word", "n", length.alias("_length"),
        # as the shorter or an equal word, and as the longer one
        F.explode(F.array(length, length - 1)).alias("shorter"),
    ).filter(F.col("shorter") >= LEAST_LENGTH)
    meets = meets.withColumn("_half", F.floor(F.col("shorter") / 2).cast("int")).select(
        "word", "n", "_length", "shorter",
        F.explode(F.array(
            F.struct(F.lit(FRONT).alias("side"), F.expr("left(word, _half)").alias("part")),
            F.struct(F.lit(BACK).alias("side"), F.expr("right(word, _half)").alias("part")),
        )).alias("_at"),
    ).select("word", "n", "_length", "shorter", "_at.side", "_at.part")
    key = ["shorter", "side", "part"]
    sizes = meets.groupBy(*key).agg(F.count("*").alias("_words"), F.min("_length").alias("_least"))
    # a single word meets none, and two longer ones meet elsewhere
    sizes = sizes.filter("_words > 1 and _least = shorter").select(*key, F.ceil(F.col("_words") / tile).cast("int").alias("tiles"))
    placed = meets.join(sizes, key).withColumn("tile", F.pmod(F.xxhash64("word"), F.col("tiles")).cast("int"))
    tiles = placed.groupBy(*key, "tiles", "tile").agg(F.sort_array(F.collect_list(F.struct("word", "n"))).alias("a"))
    tiles = stored(tiles, "tiles")
    alone = tiles.filter("tiles = 1").select(*key, "a", F.lit(None).cast(tiles.schema["a"].dataType).alias("b"))
    several = tiles.filter("tiles > 1")
    first = several.select(*key, "a", "tile", F.explode(F.sequence("tile", F.col("tiles") - 1)).alias("_other"))
    second = several.select(*key, F.col("tile").alias("_other"), F.col("a").alias("b"))
    pairs = first.join(second, [*key, "_other"])
    pairs = pairs.select(*key, "a", F.when(F.col("tile") != F.col("_other"), F.col("b")).alias("b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                shorter, side = batch.column("shorter")[i].as_py(), batch.column("side")[i].as_py()
                got: list = []
                (a, na), other = _words(batch.column("a")[i]), batch.column("b")[i]
                b, nb = _words(other) if other.is_valid else (a, na)
                code = [[w.encode("latin-1") for w in x] for x in (a, b)]
                near = single_edits(*code, shorter, side)
                got += _tile_results(a, na, b, nb, near)
                if other.is_valid:
                    got += _tile_results(b, nb, a, na, near.T)
                if got:
                    word, n, best, best_n = zip(*got, strict=True)
                    yield pa.RecordBatch.from_pydict({
                        "word": pa.array(word, pa.string()), "n_near": pa.array(n, pa.int64()),
                        "best": pa.array(best, pa.string()), "best_n": pa.array(best_n, pa.int64()),
                    })

    found = alone.unionByName(pairs).mapInArrow(run, "word string, n_near long, best string, best_n long")
    # the smallest of (-n, word)
    first_best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word")))
    out = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), first_best.alias("_best"))
    return out.select("word", "n_near", F.col("_best.word").alias("best"), (-F.col("_best.less")).alias("best_n"))


def _words(tile: pa.ListScalar) -> tuple[list[str], np.ndarray]:
    values = tile.values
    return values.field("word").to_pylist(), values.field("n").to_numpy(zero_copy_only=False)


def variants(words: DataFrame, tile: int = TILE) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of (word, n).

    A word's form is its near word of largest n (of those the smallest in code-point order) if that n is at
    least twice the word's; else it has none and is its own root.
    """
    words = pick(words, "word", "n")
    near = near_words(words, tile)
    is_form = F.col("best_n") >= 2 * F.col("n")
    found = cut_lineage(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n"),
    ))
    # every form has at least twice its word's count: no path closes, and its length follows the logarithm of the counts
    ends = roots(found.filter("form is not null").select(F.col("word").alias("node"), F.col("form").alias("root")))
    out = found.join(ends.withColumnRenamed("node", "word"), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """``variants`` of the words of whole texts.

    Null and empty texts have no words; a null id counts as an empty one; repeated rows count each; an empty table
    gives no row. Other columns are not read.
    """
    return variants(stored(vocabulary(pick(docs, "doc_id", "text")), "words"))
