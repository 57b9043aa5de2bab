"""The prefix trie against plain Python on small tables."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from rentmart.llm.prefixtrie import component_sums, prefix_trie

SCHEMA = "conv_id long, turn int, role string, text string"


def key(role, text):
    return hashlib.md5(f"{len(role or '')}:{role or ''}{text or ''}".encode()).digest()


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, key(role, text), role or "", text or ""))
    turns = {c: [x[3:] for x in sorted(t)] for c, t in own.items()}
    new = {}
    for c, t in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        new[c] = turns.get(c - c % 20, [])[:h] + t[h:]
    nodes = {}
    for c, t in new.items():
        for d in range(len(t) + 1):
            nodes.setdefault(tuple(t[:d]), []).append(c)
    out = set()
    for path, convs in nodes.items():
        below = [p for p in nodes if p[: len(path)] == path]
        children = sum(len(p) == len(path) + 1 for p in below)
        leaves = sum(not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in below) for p in below)
        saved = sum((len(nodes[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) for p in below if p)
        ends = ",".join(map(str, sorted(c for c in convs if len(new[c]) == len(path))))
        out.add((
            min(convs), len(path), min(nodes[path[:-1]]) if path else None, len(convs), children, leaves, saved,
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return out


def some_rows(seed, convs=90, longest=12):
    r = random.Random(seed)
    said = [("user", "hi there"), ("user", "hi  there"), ("bot", ""), (None, None), ("bot", "a b c d"), ("user", "é 日本\n x")]
    rows = []
    for c in range(convs):
        if r.random() < 0.1 and c % 20 == 0:
            continue  # no head to borrow
        for turn in range(r.randrange(1, longest)):
            rows.append((c, turn if r.random() < 0.95 else None, *r.choice(said[: r.choice([1, 2, 6])])))
    rows += [(7, 1, "user", "again"), (7, 1, "user", "again"), (None, 0, "user", "nobody's"), (203, 0, "x", "short"), (-41, 0, "n", "below zero")]
    rows += [(300, i, "u", f"step {i}") for i in range(150)] + [(301, i, "u", f"step {i}") for i in range(100)]
    return rows


def got(df):
    out = [tuple(r) for r in df.collect()]
    assert len(out) == len(set(out))
    return set(out)


@pytest.mark.parametrize("limit", [1, 30, 4096])
def test_trie(spark, limit):
    """A small limit: the components are split by Spark rounds, down to single nodes."""
    rows = some_rows(limit)
    random.Random(1).shuffle(rows)
    table = spark.createDataFrame(rows, SCHEMA).withColumn("node", F.lit("x")).withColumn("depth", F.lit(1)).repartition(5)
    assert got(prefix_trie(table, limit)) == brute(rows)


def test_one_conversation_over_many_partitions(spark):
    rows = [(40, i, "u", f"w{i % 3}") for i in range(400)] + [(41, i, "u", f"w{i % 3}") for i in range(400)] + [(60, 0, "u", "x")]
    assert got(prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(8), 50)) == brute(rows)


def test_empty_and_turnless(spark):
    table = spark.createDataFrame([], SCHEMA)
    assert prefix_trie(table).count() == 0
    assert prefix_trie(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)).count() == 0
    c = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(c, 0, "a", "b")]  # gives up its only turn, and there is no head
    assert got(prefix_trie(spark.createDataFrame(rows, SCHEMA))) == brute(rows) == {(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())}


def test_component_sums():
    r = random.Random(3)
    for n in (1, 2, 17, 200):
        parents = [-1] + [max(0, i - r.choice([1, 1, 1, 5])) for i in range(1, n)]
        values = [(r.randrange(9), 1) for _ in range(n)]
        totals = [list(v) for v in values]
        for i in reversed(range(1, n)):
            totals[parents[i]] = [a + b for a, b in zip(totals[parents[i]], totals[i], strict=True)]
        depth = [0] * n
        for i in range(1, n):
            depth[i] = depth[parents[i]] + 1
        order = sorted(range(n), key=lambda i: depth[i])
        place = {v: i for i, v in enumerate(order)}
        got = component_sums([place.get(parents[v], -1) for v in order], [totals[v][1] for v in order], [values[v] for v in order])
        assert got == [totals[v] for v in order]
