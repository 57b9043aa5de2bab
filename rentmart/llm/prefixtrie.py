"""Prefix trie of conversations, rolled up by centroid decomposition.

Conversations are cut into turns, every turn gets the hash of its prefix, and equal prefixes are one node of the trie. The
hash is a sum of turn hashes times powers of a base, modulo a prime: the turns lie in range partitions, a
conversation may span several of them, and what one partition has summed is carried into the next.

Totals of subtrees follow from a centroid decomposition of the parent edges. The turns below a node are its weight, so the
heavy nodes of a component, those with more than half of its weight, are a chain from its top down, and the last of
them is the centroid. Without it every piece has at most half the weight. One round splits all components: it
sums each centroid's part of its component, adds the sum along the chain to the top, takes the centroid's weight off the
chain, and goes on with the pieces. Components of at most ``LIMIT`` turns are split further in the task that
holds them. The rounds follow the logarithm of the turns, not the depth of the trie.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentmart.llm.common import cut_lineage, pick, range_parts, small_batches, stored, union_all

# Fixed values of the contract: what conversations are rebuilt from.
FAMILY, HEADS = 20, 4
WORD = r"[^\x20\x09-\x0D]+"

#: weight of a component that one task finishes; bytes of ids that are hashed at once; rows of a batch handed on
LIMIT, CHUNK, ROWS = 4_096, 1 << 16, 10_000
_PRIME = (1 << 127) - 1
_BASE = 0x5851F42D4C957F2D14057B7EF767814F
_INVERSE = pow(_BASE, -1, _PRIME)
ROOT = bytes(16)


def turn_rows(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, key (hash of role and text), words: what a turn is, without its text."""
    rows = pick(conversations, "conv_id", "turn", "role", "text").filter("conv_id is not null")
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    said = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.unhex(F.md5(said)).alias("key"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )


def _number(key: bytes) -> int:
    return int.from_bytes(key, "big") % _PRIME


def _bytes(h: int) -> bytes:
    return h.to_bytes(16, "big")


def prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), before and here (hashes of the turns before this one, and with it), words.

    Turns are ordered by turn, null first; those of one number by the hash of role and text. Each partition
    tells its first and last conversation and the last one's sum so far: one row per partition, folded on the driver.
    """
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("key"), F.col("words")]
    ranged = range_parts(turns, order).sortWithinPartitions(*order)

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = first = last = None
        n = total = 0
        power = 1
        for batch in batches:
            for conv, key, at in zip(batch.column("conv_id").to_pylist(), batch.column("key").to_pylist(), batch.column("_part").to_pylist(), strict=True):
                if part is None:
                    part, first, last = at, conv, conv
                if conv != last:
                    last, n, total, power = conv, 0, 0, 1
                n, power = n + 1, power * _BASE % _PRIME
                total = (total + _number(key) * power) % _PRIME
        if part is not None:
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "first": pa.array([first], pa.int64()), "last": pa.array([last], pa.int64()),
                "n": pa.array([n], pa.int64()), "total": pa.array([_bytes(total)], pa.binary()),
            })

    carried: dict[int, tuple[int, int, int]] = {}
    open_ = None  # the conversation that the partitions so far end in, its turns and its sum
    for r in sorted(ranged.mapInArrow(edges, "part int, first long, last long, n long, total binary").collect()):
        n, total = r["n"], _number(bytes(r["total"]))
        if open_ and open_[0] == r["first"]:
            carried[r["part"]] = open_
            if r["first"] == r["last"]:
                total = (open_[2] + pow(_BASE, open_[1], _PRIME) * total) % _PRIME
                n += open_[1]
        open_ = (r["last"], n, total)
    shared = turns.sparkSession.sparkContext.broadcast(carried)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        pos = total = 0
        power = 1
        fresh = True
        for batch in batches:
            out: dict[str, list] = {"pos": [], "before": [], "here": []}
            convs = batch.column("conv_id").to_pylist()
            if fresh and convs:
                fresh = False
                if carry := shared.value.get(batch.column("_part")[0].as_py()):
                    last, pos, total = carry
                    power = pow(_BASE, pos, _PRIME)
            for conv, key in zip(convs, batch.column("key").to_pylist(), strict=True):
                if conv != last:
                    last, pos, total, power = conv, 0, 0, 1
                pos, power = pos + 1, power * _BASE % _PRIME
                out["pos"].append(pos)
                out["before"].append(_bytes(total))
                total = (total + _number(key) * power) % _PRIME
                out["here"].append(_bytes(total))
            yield pa.RecordBatch.from_pydict({
                "conv_id": batch.column("conv_id"), "pos": pa.array(out["pos"], pa.int64()), "before": pa.array(out["before"], pa.binary()),
                "here": pa.array(out["here"], pa.binary()), "words": batch.column("words"),
            })

    return ranged.mapInArrow(run, "conv_id long, pos long, before binary, here binary, words long")


def _moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of a conversation's own turns behind the head of another one: the sum behind its own first turns, by as
    many powers as the heads differ in length, added to the other head's."""
    for batch in batches:
        nodes: dict[str, list] = {"node": [], "parent": []}
        columns = [batch.column(c).to_pylist() for c in ("shift", "head", "cut", "here", "before")]
        for shift, head, cut, here, before in zip(*columns, strict=True):
            factor, start, less = pow(_INVERSE, shift, _PRIME), _number(head), _number(cut)
            nodes["node"].append(_bytes((start + factor * (_number(here) - less)) % _PRIME))
            nodes["parent"].append(_bytes((start + factor * (_number(before) - less)) % _PRIME))
        yield pa.RecordBatch.from_pydict({
            **{c: batch.column(c) for c in ("conv_id", "depth", "length")}, "node": pa.array(nodes["node"], pa.binary()),
            "parent": pa.array(nodes["parent"], pa.binary()), "words": batch.column("words"),
        })


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, length) of every rebuilt conversation, and its turns: conv_id, depth, length, node, parent, words.

    A conversation c gives up its first h turns, h = crc32 of its number modulo ``HEADS``, for the first h (or
    all) of conversation c - c % ``FAMILY``.
    """
    turns = stored(prefixes(turn_rows(conversations)), "turns")
    most = HEADS - 1
    heads = [F.max(F.when(F.col("pos") == i, F.struct("here", "words"))).alias(f"h{i}") for i in range(1, most + 1)]
    convs = turns.groupBy("conv_id").agg(F.max("pos").alias("n"), *heads)
    convs = convs.withColumn("h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int"))
    convs = cut_lineage(convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY))
    bases = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"), *[F.col(f"h{i}").alias(f"b{i}") for i in range(1, most + 1)])

    def hash_at(name: str, count: str) -> F.Column:
        """The hash of the first ``count`` turns of the heads of ``name``."""
        out = F.lit(ROOT)
        for i in range(1, most + 1):
            out = F.when(F.col(count) >= i, F.col(f"{name}{i}.here")).otherwise(out)
        return out

    joined = convs.join(bases, "base", "left")
    joined = joined.withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0))).cast("int"))
    plan = cut_lineage(joined.select(
        "conv_id", "h", "taken", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"),
        hash_at("b", "taken").alias("head"), hash_at("h", "h").alias("cut"),
        F.slice(F.array(*[F.col(f"b{i}") for i in range(1, most + 1)]), F.lit(1), F.col("taken")).alias("first"),
    ))
    own = turns.join(plan.select("conv_id", "h", "taken", "length", "head", "cut"), "conv_id").filter(F.col("pos") > F.col("h")).select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("depth"), "length", "before", "here", "words", "head", "cut",
        (F.col("h") - F.col("taken")).alias("shift"),
    )
    schema = "conv_id long, depth long, length long, node binary, parent binary, words long"
    own = own.mapInArrow(_moved, schema)
    borrowed = plan.select("conv_id", "length", "first", F.posexplode("first").alias("i", "at")).select(
        "conv_id", (F.col("i") + 1).cast("long").alias("depth"), "length", F.col("at.here").alias("node"),
        F.when(F.col("i") == 0, F.lit(ROOT)).otherwise(F.expr("try_element_at(first, i).here")).alias("parent"), F.col("at.words").alias("words"),
    )
    return plan.select("conv_id", "length"), stored(own.unionByName(borrowed), "members")


def component_sums(parents: list[int], weights: list[int], values: list[tuple[int, ...]]) -> list[list[int]]:
    """Subtree totals of one component by centroid decomposition; nodes by depth, parents as positions (-1: outside)."""
    weights = list(weights)
    totals = [[0] * len(v) for v in values]
    todo = [list(range(len(parents)))]
    while todo:
        nodes = todo.pop()
        whole = weights[nodes[0]]
        heavy = [v for v in nodes if 2 * weights[v] > whole]
        centre = heavy[-1]
        top_of: dict[int, int] = {}
        pieces: dict[int, list[int]] = {}
        above = []
        for v in nodes:
            top = v if parents[v] == centre else top_of.get(parents[v])
            if top is not None:
                top_of[v] = top
                pieces.setdefault(top, []).append(v)
            elif v != centre:
                above.append(v)
        sums = list(values[centre])
        for v in top_of:
            sums = [a + b for a, b in zip(sums, values[v], strict=True)]
        for v in heavy:
            totals[v] = [a + b for a, b in zip(totals[v], sums, strict=True)]
            if v != centre:
                weights[v] -= weights[centre]
        todo.extend(pieces.values())
        if above:
            todo.append(above)
    return totals


def _finished(small: DataFrame, values: list[str]) -> DataFrame:
    """node and totals of components that one task holds: no more than their weight in rows each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        out: list[tuple] = []

        def finish() -> None:
            place = {r[1]: i for i, r in enumerate(held)}
            totals = component_sums([place.get(r[2], -1) for r in held], [r[3] for r in held], [r[4:] for r in held])
            out.extend((r[1], *t) for r, t in zip(held, totals, strict=True))
            held.clear()

        def batch_of() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [()] * (1 + len(values))
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.binary()), *[pa.array(c, pa.int64()) for c in columns[1:]]], ["node", *values]
            )

        for batch in batches:
            for r in zip(*[batch.column(c).to_pylist() for c in ("top", "node", "parent", "weight", *values)], strict=True):
                if held and held[0][0] != r[0]:
                    finish()
                    if len(out) >= ROWS:
                        yield batch_of()
                held.append(r)
        if held:
            finish()
        yield batch_of()

    # by an expression of its own: where the joins before are by top, Spark would take a repartition by top for done,
    # and leave out that a join may split a partition
    by_part = small.select("top", "depth", "node", "parent", "weight", *values).repartition(F.xxhash64("top"))
    by_part = by_part.sortWithinPartitions("top", "depth", "node")
    return by_part.mapInArrow(run, "node binary, " + ", ".join(f"{v} long" for v in values))


def subtree_sums(nodes: DataFrame, paths: DataFrame, values: list[str], limit: int = LIMIT) -> DataFrame:
    """node and, for each of ``values``, its sum over the node's subtree.

    ``nodes``: node, parent, depth, top (of the tree), weight (positive, of the whole subtree, at least the sum of
    its children's and 1), guide (a path through the node), values. ``paths``: guide, depth, node, parent of every node on
    these paths. A node lies below a centroid if its own path does, so one look at the path gives its new component.
    """
    steps = paths.select("guide", F.col("depth").alias("_at"), F.col("node").alias("_node"), F.col("parent").alias("_over"))
    state, small, sums, adds = nodes.select("node", "parent", "depth", "top", "weight", "guide", *values), [], [], []
    while True:
        tops = state.filter("node = top").select("top", F.col("weight").alias("whole"))
        sized = state.join(tops, "top")
        small.append(sized.filter(F.col("whole") <= limit).drop("whole"))
        large = sized.filter(F.col("whole") > limit)
        heavy = 2 * F.col("weight") > F.col("whole")
        centres = large.filter(heavy).groupBy("top").agg(F.max(F.struct("depth", "node", "weight")).alias("c"))
        split = large.join(centres, "top").withColumn("_at", F.col("c.depth") + 1).join(steps, ["guide", "_at"], "left")
        is_centre = F.col("node") == F.col("c.node")
        below = (F.col("depth") > F.col("c.depth")) & F.coalesce(F.col("_over") == F.col("c.node"), F.lit(False))
        split = cut_lineage(split.select(
            "node", "parent", "depth", "guide", *values, F.col("c.node").alias("centre"), is_centre.alias("is_centre"),
            (heavy & ~is_centre).alias("above"), (below | is_centre).alias("within"),
            F.when(below, F.col("_node")).otherwise(F.col("top")).alias("top"),
            (F.col("weight") - F.when(heavy & ~is_centre, F.col("c.weight")).otherwise(0)).alias("weight"),
        ))
        if split.isEmpty():
            break
        part = split.filter("within").groupBy("centre").agg(*[F.sum(v).alias(v) for v in values])
        sums.append(part.select(F.col("centre").alias("node"), *values))
        adds.append(split.filter("above").select("node", "centre").join(part, "centre").select("node", *values))
        state = split.filter(~F.col("is_centre")).select("node", "parent", "depth", "top", "weight", "guide", *values)
    found = union_all([_finished(union_all(small), values), *sums, *adds])
    return found.groupBy("node").agg(*[F.sum(v).alias(v) for v in values])


def _end_hashes(ends: DataFrame) -> DataFrame:
    """node and the hash of the ascending, comma-joined conv_ids of (node, conv_id).

    A node's ids may fill many range partitions: these hand on strings of ``CHUNK`` bytes, and one hash reads a node's
    strings in order, none of them kept.
    """

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[bytes, int, str]] = []
        node, first, ids, size = None, 0, [], 0

        def out() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [(), (), ()]
            rows.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())], ["node", "first", "ids"]
            )

        for batch in batches:
            for n, c in zip(batch.column("node").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
                if ids and (n != node or size >= CHUNK):
                    rows.append((node, first, ",".join(ids)))
                    ids, size = [], 0
                if not ids:
                    node, first = n, c
                ids.append(str(c))
                size += len(ids[-1]) + 1
            if sum(len(r[2]) for r in rows) >= 16 * CHUNK:
                yield out()
        if ids:
            rows.append((node, first, ",".join(ids)))
        yield out()

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, h = None, hashlib.sha256()
        for batch in batches:
            done: list[tuple[bytes, str]] = []
            for n, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if n != node:
                    if node is not None:
                        done.append((node, h.hexdigest()))
                    node, h = n, hashlib.sha256(ids.encode())
                else:
                    h.update(b"," + ids.encode())
            columns = list(zip(*done, strict=True)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.string())], ["node", "ends_sha256"])
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([h.hexdigest()], pa.string())], ["node", "ends_sha256"])

    listed = ends.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id").mapInArrow(chunks, "node binary, first long, ids string")
    return listed.repartition("node").sortWithinPartitions("node", "first").mapInArrow(hashes, "node binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame, limit: int = LIMIT) -> DataFrame:
    """One row per node of the trie of all rebuilt conversations.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    Null role and text are empty. Rows without conv_id belong to no conversation and are left out; repeated rows are
    repeated turns; turns of one number are ordered by the hash of role and text. An empty table has no trie and gives no
    row. Other columns are not read.
    """
    small_batches(conversations.sparkSession)
    convs, members = rebuilt(conversations)
    weight = F.sum(F.col("length") - F.col("depth") + 1)
    ended = F.col("length") == F.col("depth")
    nodes = members.groupBy("node").agg(
        F.min("parent").alias("parent"), F.min("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"),
        F.max("words").alias("words"), weight.alias("weight"),
    )
    root = convs.groupBy(F.lit(ROOT).alias("node")).agg(
        F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("depth"), F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"), F.lit(0).cast("long").alias("words"), F.sum(F.col("length") + 1).alias("weight"),
    )
    nodes = cut_lineage(nodes.unionByName(root))
    children = nodes.filter("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    nodes = nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    # stored with the rest: as a constant the top would make joins by it products
    nodes = cut_lineage(nodes.join(parents, "parent", "left").withColumn("top", F.lit(ROOT)))
    ends = members.filter(ended).select("node", "conv_id").unionByName(convs.filter("length = 0").select(F.lit(ROOT).alias("node"), "conv_id"))
    totals = subtree_sums(
        nodes.select(
            "node", "parent", "depth", "top", "weight", F.col("conv_id").alias("guide"),
            (F.col("n_children") == 0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"),
        ),
        members.select(F.col("conv_id").alias("guide"), "depth", "node", "parent"), ["n_leaves", "saved_tokens"], limit,
    )
    out = nodes.join(totals, "node").join(_end_hashes(ends), "node", "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"),
    )
