"""Near-duplicate embeddings by collision-counting projections.

Unit vectors are projected on random lines. Two vectors of cosine c differ on a line by a normal amount with variance
2 - 2c, whatever the dimension. Lines are cut into windows at random shifts; the windows of several lines together are a
cell, and vectors of one cell meet as a run of one key. ``layout`` takes the window's width, the lines of a cell
and the number of cells per vector from the threshold and the number of vectors: unrelated vectors meet a fixed number
of times per vector, however many there are, and a pair at the threshold meets nowhere with probability ``MISS``.

For a pair that met, the lines on which one vector lies in the window centred on the other are counted over ``M`` further
projections; it goes on when the count reaches ``least_count``, calibrated so that a pair at the threshold passes
with probability 1 - 1e-6. Whoever passes is verified by cosine in double precision.

Families of near copies meet in many cells, so their pairs are never listed. First every vector is paired with the
heads of its cells alone; the link to the head with the highest count makes families. Pairs of different families that
met are listed, counted and verified once. Inside a family, tiles of vectors are compared with each other as matrices, which hand on the number of
links of each vector and nothing else. Equal vectors are one class and are never expanded into pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, comb, erf, exp, log, log1p, pi, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentmart.llm.common import components, cut_lineage, pick, roots, schema_of, small_batches, stored
from rentmart.llm.lines import NO_ID
from rentmart.llm.textarrays import mix

#: unrelated vectors that a vector meets in a cell, on average; share of pairs at the threshold that meet in no cell
RANDOM, MISS = 0.03, 1e-3
#: lines whose collisions are counted, the half width of the query-centred window, and its parts: a vector's places on
#: the lines are kept as one byte each, and the window of whole parts is a little wider, never narrower
M, RADIUS, STEPS = 64, 0.7, 16
#: vectors of a tile, on average; vectors projected at once
TILE, ROWS = 256, 256


def same_window(cosine: float, width: float) -> float:
    """Probability that two unit vectors of this cosine share a window of a line with a random shift."""
    s = sqrt(max(0.0, 2 - 2 * cosine))
    if s == 0:
        return 1.0
    return erf(width / s / sqrt(2)) - 2 * s / (width * sqrt(2 * pi)) * (1 - exp(-(width**2) / 2 / s**2))


def layout(n: int, threshold: float) -> tuple[float, int, int]:
    """Width of a window, lines of a cell, cells per vector: the fewest cells over a range of widths."""
    found = []
    for step in range(4, 21):
        width = step / 4
        near, far = same_window(threshold, width), same_window(0, width)
        lead = max(1, ceil(log(max(n, 2) / RANDOM) / -log(far)))
        groups = 1 if near**lead >= 1 else max(1, ceil(log(MISS) / log1p(-(near**lead))))
        found.append((groups, lead, width))
    groups, lead, width = min(found)
    return width, lead, groups


def least_count(threshold: float, miss: float = 1e-6) -> int:
    """The largest count that a pair at the threshold reaches with probability 1 - ``miss``."""
    p = erf(RADIUS / sqrt(2 - 2 * threshold) / sqrt(2)) if threshold < 1 else 1.0
    below = 0.0
    for t in range(M + 1):
        below += comb(M, t) * p**t * (1 - p) ** (M - t)
        if below > miss:
            return t
    return M


def _lines(dim: int, n: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim, n]).standard_normal((dim, n))


def _unit(packed: list[bytes], dim: int) -> np.ndarray:
    x = np.frombuffer(b"".join(packed), "<f8").reshape(len(packed), dim)
    scaled = x / np.abs(x).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _vectors(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Dimension, rows and unit vectors for each dimension in the batch (vectors of two dimensions never link)."""
    packed = batch.column("v").to_pylist()
    sizes = np.array([len(p) for p in packed], np.int64)
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        yield int(size) // 8, at, _unit([packed[i] for i in at], int(size) // 8)


def _places(x: np.ndarray) -> np.ndarray:
    """Where unit vectors lie on the counted lines, in parts of the window's half width."""
    return np.clip(np.floor(x @ _lines(x.shape[1], M, 2) * (STEPS / RADIUS)), -127, 127).astype(np.int8)


def _collisions(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Lines on which places lie in each other's window; rows that were cut to the range of a byte only gain."""
    return (np.abs(p.astype(np.int16) - q) <= STEPS + 1).sum(axis=-1)


def _alike(x: np.ndarray, y: np.ndarray, need: int, threshold: float) -> np.ndarray:
    """Which rows of ``x`` and ``y`` link: enough window collisions, then the cosine."""
    p, q = _places(x).astype(np.int16), _places(y).astype(np.int16)
    count = np.zeros((len(x), len(y)), np.int8)
    for a, b in zip(p.T, q.T, strict=True):
        count += np.abs(a[:, None] - b[None, :]) <= STEPS + 1
    return (count >= need) & (x @ y.T >= threshold)


def _cells(classes: DataFrame, n: int, threshold: float) -> DataFrame:
    """(k, cell): the cells of each vector, by a hash of the dimension, the cell's number and its windows."""
    width, lead, groups = layout(n, threshold)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        random = np.random.default_rng(7)
        shift = random.random(groups * lead) * width
        odd = random.integers(0, 1 << 62, groups * lead, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        for b in batches:
            for dim, at, x in _vectors(b):
                lines = _lines(dim, groups * lead, 1)
                start = (np.arange(groups, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(dim)
                for i in range(0, len(at), ROWS):
                    windows = np.floor((x[i : i + ROWS] @ lines + shift) / width).astype(np.int64).astype(np.uint64)
                    cell = mix((mix(windows * odd)).reshape(-1, groups, lead).sum(axis=2, dtype=np.uint64) + start)
                    yield pa.RecordBatch.from_pydict({
                        "k": b.column("k").take(pa.array(np.repeat(at[i : i + ROWS], groups))), "cell": pa.array(cell.reshape(-1).view(np.int64)),
                    })

    return classes.select("k", "v").mapInArrow(keys, "k long, cell long")


def _counted(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """(a, b, count): the pairs whose collisions reach the calibrated count."""
    need = least_count(threshold)
    side = classes.select("k", "places")
    both = pairs.join(side.select(F.col("k").alias("a"), F.col("places").alias("pa")), "a").join(side.select(F.col("k").alias("b"), F.col("places").alias("pb")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p, q = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.int8).reshape(-1, M) for c in ("pa", "pb"))
            count = _collisions(p, q)
            out = pa.RecordBatch.from_pydict({"a": b.column("a"), "b": b.column("b"), "count": pa.array(count, pa.int32())})
            yield out.filter(pa.array(count >= need))

    return both.select("a", "b", "pa", "pb").mapInArrow(run, "a long, b long, count int")


def _verified(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose cosine reaches the threshold."""
    side = classes.select("k", "v")
    both = pairs.join(side.select(F.col("k").alias("a"), F.col("v").alias("va")), "a").join(side.select(F.col("k").alias("b"), F.col("v").alias("vb")), "b")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            va, vb = b.column("va").to_pylist(), b.column("vb").to_pylist()
            dims = np.array([len(p) if len(p) == len(q) else 0 for p, q in zip(va, vb, strict=True)], np.int64)
            keep = np.zeros(len(va), bool)
            for size in np.unique(dims[dims > 0]):
                at, dim = np.flatnonzero(dims == size), int(size) // 8
                keep[at] = (_unit([va[i] for i in at], dim) * _unit([vb[i] for i in at], dim)).sum(axis=1) >= threshold
            yield pa.RecordBatch.from_pydict({"a": b.column("a"), "b": b.column("b")}).filter(pa.array(keep))

    return both.select("a", "b", "va", "vb").mapInArrow(verify, "a long, b long")


def _inside(members: DataFrame, threshold: float) -> DataFrame:
    """(k, others): for each vector of ``members`` (family, k, v, copies) the vectors of its family that it links to.

    A family's vectors have one length, as links join no others.
    """
    sizes = members.groupBy("family").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles"))
    tiles = members.join(sizes, "family").withColumn("tile", F.pmod(F.xxhash64("k"), F.col("tiles")).cast("int"))
    tiles = stored(tiles.groupBy("family", "tiles", "tile").agg(F.collect_list(F.struct("k", "v", "copies")).alias("a")), "tiles")
    first = tiles.select("family", "a", "tile", F.explode(F.sequence("tile", F.col("tiles") - 1)).alias("_other"))
    second = tiles.select("family", F.col("tile").alias("_other"), F.col("a").alias("b"))
    pairs = first.join(second, ["family", "_other"]).select("a", "b", (F.col("tile") == F.col("_other")).alias("same"))
    need = least_count(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                a, b = (batch.column(c)[i].values for c in "ab")
                packed = [t.field("v").to_pylist() for t in (a, b)]
                dim = len(packed[0][0]) // 8
                near = _alike(_unit(packed[0], dim), _unit(packed[1], dim), need, threshold)
                ka, kb = a.field("k"), b.field("k")
                ca, cb = (t.field("copies").to_numpy(zero_copy_only=False) for t in (a, b))
                if batch.column("same")[i].as_py():
                    near &= ka.to_numpy()[:, None] != kb.to_numpy()[None, :]
                    k, others = ka, near @ cb
                else:
                    k, others = pa.concat_arrays([ka, kb]), np.concatenate([near @ cb, ca @ near])
                yield pa.RecordBatch.from_pydict({"k": k, "others": pa.array(others, pa.int64())})

    return pairs.mapInArrow(run, "k long, others long").groupBy("k").agg(F.sum("others").alias("others"))


def near_vectors(table: DataFrame, threshold: float = 0.9) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    ``table``: vec_id, embedding (array of numbers); other columns are ignored. Vectors link when their cosine in double
    precision reaches ``threshold``; null, empty or zero vectors and those with null or non-finite components link
    with nothing, nor do vectors of different lengths. Rows that share a vec_id are nodes of one component; a null
    id is the smallest node and stays null. An empty table gives no row.
    """
    small_batches(table.sparkSession)
    rows = pick(table, "vec_id", "embedding").select(
        F.coalesce("vec_id", F.lit(NO_ID)).cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("e")
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for e in b.column("e").to_pylist():
                x = np.array([np.nan if c is None else c for c in e], "<f8") if e else np.zeros(0)
                fine = len(x) and np.isfinite(x).all() and np.abs(x).max() > 0
                out.append((x + 0.0).tobytes() if fine else None)
            yield pa.RecordBatch.from_pydict({"id": b.column("id"), "v": pa.array(out, pa.binary())})

    rows = cut_lineage(rows.mapInArrow(pack, "id long, v binary"))
    sound = rows.filter("v is not null")
    classes = cut_lineage(sound.groupBy("v").agg(F.min("id").alias("c"), F.count("*").alias("copies"))
                          .withColumn("k", F.monotonically_increasing_id()))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, at, x in _vectors(b):
                part = b.take(pa.array(at))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([p.tobytes() for p in _places(x)], pa.binary())], [*part.schema.names, "places"])

    classes = cut_lineage(classes.mapInArrow(place, schema_of(classes, "places binary")))
    # the cells that several vectors share, and the head of each
    cells = stored(_cells(classes, classes.count(), threshold), "cells")
    heads = cells.groupBy("cell").agg(F.min("k").alias("head"), F.count("*").alias("m")).filter("m > 1").select("cell", "head")
    met = cut_lineage(cells.join(heads, "cell"))
    stars = _counted(met.filter("k != head").select(F.col("head").alias("a"), F.col("k").alias("b")).distinct(), classes, threshold)
    best = stars.groupBy("b").agg(F.max_by("a", F.struct("count", F.bitwise_not("a"))).alias("a"))
    # each vector has one link at most, to a smaller one: a forest
    found = roots(_verified(best, classes, threshold).select(F.col("b").alias("node"), F.col("a").alias("root")))
    found = found.unionByName(found.select(F.col("root").alias("node"), "root").distinct()).withColumnRenamed("root", "component")
    classes = classes.join(found.withColumnRenamed("node", "k"), "k", "left")
    classes = cut_lineage(classes.select("k", "v", "places", "c", "copies", F.coalesce("component", "k").alias("family"), F.col("component").isNull().alias("alone")))
    families = classes.select("k", "family")
    placed = met.join(families, "k").select("cell", "k", "family")
    mixed = placed.groupBy("cell").agg(F.min("family").alias("lo"), F.max("family").alias("hi")).filter("lo != hi").select("cell")
    placed = cut_lineage(placed.join(mixed, "cell"))
    x = placed.select("cell", F.col("k").alias("a"), F.col("family").alias("fa"))
    apart = x.join(placed, (x["cell"] == placed["cell"]) & (x["a"] < placed["k"]) & (x["fa"] != placed["family"]))
    across = _counted(apart.select("a", F.col("k").alias("b")).distinct(), classes, threshold).select("a", "b")
    across = cut_lineage(_verified(across, classes, threshold))

    ends = across.unionByName(across.select(F.col("b").alias("a"), F.col("a").alias("b")))
    size = classes.select("k", "copies")
    others = ends.join(size.select(F.col("k").alias("b"), "copies"), "b").select(F.col("a").alias("k"), F.col("copies").alias("others"))
    others = others.unionByName(_inside(classes.filter("not alone").select("family", "k", "v", "copies"), threshold))
    others = others.groupBy("k").agg(F.sum("others").alias("others"))
    counted = classes.join(others, "k", "left").select("k", "c", "family", "v", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    counted = cut_lineage(counted)

    # nodes of the answer are ids: the smallest of a family, then links across families and ids in several classes
    least = counted.groupBy("family").agg(F.min("c").alias("top"))
    member = sound.join(counted.select("v", "family", "n_links"), "v").join(least, "family").select("id", "n_links", "top", "family")
    member = cut_lineage(member)
    tops = counted.select("k", "family").join(least, "family").select("k", "top")
    edges = across.join(tops.select(F.col("k").alias("a"), F.col("top").alias("ta")), "a").join(tops.select(F.col("k").alias("b"), F.col("top").alias("tb")), "b")
    twice = member.groupBy("id").agg(F.min("top").alias("a"), F.max("top").alias("z")).filter("a != z").select("id", "a")
    shared = member.join(twice, "id").select("a", F.col("top").alias("b")).distinct()
    again = components(edges.select(F.col("ta").alias("a"), F.col("tb").alias("b")).unionByName(shared))
    every = member.join(again.withColumnRenamed("node", "top"), "top", "left").select("id", "n_links", F.coalesce("component", "top").alias("component"))
    bare = rows.filter("v is null").select("id", F.lit(0).cast("long").alias("n_links"))
    # a row without a sound vector goes with the other rows of its id
    bare = bare.join(every.groupBy("id").agg(F.min("component").alias("component")), "id", "left").select("id", "n_links", F.coalesce("component", "id").alias("component"))
    out = every.unionByName(bare)
    real = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return out.select(real("id").alias("vec_id"), "n_links", real("component").alias("component_id"), (F.col("component") == F.col("id")).alias("kept"))
