"""Operators on odd tables (nulls, empty and very long texts, ties, repeated rows, no rows, clashing columns) against their
SQL twins in DuckDB, the tokenizers library, and sketches computed by hand."""

import hashlib
import random
import struct
from collections import Counter

import duckdb
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rentmart.llm import fingerprints as fp
from rentmart.llm.lines import dedup_lines
from rentmart.llm.mixing import mix, mixed_documents
from rentmart.llm.oracles import SQL
from rentmart.llm.packing import pack
from rentmart.llm.queries import tokenizer_path
from rentmart.llm.records import documents_from_records, ids_crc, write_records
from rentmart.llm.urltree import judge

DOCS = "doc_id long, text string, source string"


def odd_docs(seed=1, n=80):
    r = random.Random(seed)
    lines = ["a line that many texts share", "  A LINE that many texts share\t", "short", "", " ", "é" * 10, "日本語の文章がここにあります", "x" * 9, "x" * 10, "unlike"]
    docs = [(None, "no id\na line that many texts share", "s1"), (None, "no id\na line that many texts share", None), (0, None, "s1"), (1, "", None), (2, "\n\n", "S1"),
            (3, "one", ""), (3, "two words", ""), (4, "same row", "s2"), (4, "same row", "s2"), (5, "\r\n\x0b \x0c", "é")]
    for i in range(10, n):
        body = "\n".join(r.choice(lines) + (f" {r.randrange(40)}" if r.random() < 0.4 else "") for _ in range(r.randrange(1, 12)))
        docs.append((i, body, r.choice(["s1", "s2", "s3", "é", None, "hot", "hot", "hot"])))
    docs.append((n, "\n".join(f"{lines[0]} {i % 50}" for i in range(20_000)), "long"))
    return docs


def table(spark, docs, extra=True):
    df = spark.createDataFrame(docs, DOCS)
    if extra:
        for c in ("n", "size", "tag", "doc", "lines", "sketch", "row", "_row", "target", "_key"):
            df = df.withColumn(c, F.lit("clash"))
    return df.repartition(5)


def twin(name, docs):
    con = duckdb.connect()
    con.register("given", pd.DataFrame({"doc_id": pd.array([d[0] for d in docs], "Int64"), "text": [d[1] for d in docs], "source": [d[2] for d in docs]}))
    con.execute("CREATE VIEW documents AS SELECT doc_id, text::VARCHAR AS text, source::VARCHAR AS source FROM given")
    return con.execute(SQL[name]).fetchall(), [c[0] for c in con.description]


def same(got, want):
    assert Counter(map(tuple, got)) == Counter(map(tuple, want))


def test_line_dedup(spark):
    docs = [d for d in odd_docs() if d[0] is not None]  # ids repeat; in SQL a repeated id is one group of rows
    seen, once = set(), []
    for d in docs:
        if d[0] not in seen:
            seen.add(d[0])
            once.append(d)
    want, names = twin("op6_line_dedup", once)
    got = dedup_lines(table(spark, once))
    assert got.columns[:3] == ["doc_id", "text", "source"] and "keep_bitmap" in got.columns
    same(got.select(*names).collect(), want)
    kept = {r["doc_id"]: r for r in got.select("doc_id", "text", "kept_sha256").collect()}
    assert all(hashlib.sha256(r["text"].encode()).hexdigest() == r["kept_sha256"] for r in kept.values())
    assert dedup_lines(table(spark, once).limit(0)).count() == 0


def test_line_dedup_without_ids(spark):
    rows = [(None, "a line that many texts share\nown", "s"), (None, "a line that many texts share\nown", "s"), (7, "a line that many texts share", "s"), (7, "own too", "s")]
    got = sorted(((r["doc_id"], r["text"], r["n_dropped"]) for r in dedup_lines(spark.createDataFrame(rows, DOCS)).collect()), key=str)
    assert got == sorted([(None, rows[0][1], 0), (None, rows[0][1], 0), (7, "", 1), (7, "own too", 0)], key=str)


def test_mixing(spark):
    docs = odd_docs(3)
    want, names = twin("op8_mix_sources", docs)
    got = mix(table(spark, docs)).select(*names).collect()
    same([tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in got], [tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in want])
    assert mix(table(spark, docs).limit(0)).count() == 0
    assert [tuple(r) for r in mix(spark.createDataFrame([(1, None, "a"), (2, " ", None)], DOCS)).select("taken").collect()] == [(0,), (0,)]


def test_mixed_documents(spark):
    docs = odd_docs(4)
    planned = {}
    df = table(spark, docs, extra=False)
    for r in mix(df, keep=("doc_id", "text", "source")).collect():
        planned.setdefault((r["doc_id"], r["source"]), []).append((r["text"], r["taken"]))
    out = mixed_documents(df)
    assert out.columns == df.columns
    words = Counter()
    for r in out.collect():
        words[r["doc_id"], r["source"]] += len(r["text"].split())
    for key, plan in planned.items():
        assert words[key] == sum(t for _, t in plan), key


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path())


def ids_of(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 0]


def test_packing(spark, library):
    docs = odd_docs(5)
    pieces = pack(table(spark, docs), tokenizer_path()).collect()
    given = Counter((d, len(i), tuple(i)) for d, i in ((d[0], ids_of(library, d[1])) for d in docs))
    sequences, whole = {}, Counter()
    for p in pieces:
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
        assert ids_crc(__import__("numpy").frombuffer(p["ids"], "<u2")) == p["ids_crc32"] and p["length"] * 2 == len(p["ids"])
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert sum(at < 1024 for at in (sum(x[1] for x in p) for p in sequences.values())) <= 1  # one sequence falls short at most
    by_doc = {}
    for p in sorted(pieces, key=lambda p: p["start"]):
        by_doc.setdefault((p["doc_id"], p["doc_tokens"]), []).append(p)
    for (doc, n), parts in by_doc.items():
        tokens = Counter()
        for p in parts:
            tokens[p["start"]] += 1
        copies = tokens[0]
        assert sum(p["length"] for p in parts) == copies * n
        whole[doc, n] += copies
    assert whole == Counter({(d, n): 0 for d, n, _ in given}) + sum((Counter({(d, n): k}) for (d, n, _), k in given.items()), Counter())
    assert pack(table(spark, docs).limit(0), tokenizer_path()).count() == 0


def test_records(spark, library, tmp_path):
    docs = odd_docs(6)
    got = documents_from_records(spark, write_records(table(spark, docs), str(tmp_path / "r"), tokenizer_path())).collect()
    start, numpy = 0, __import__("numpy")
    want = Counter((d, len(i), ids_crc(numpy.array(i))) for d, i in ((d[0], ids_of(library, d[1])) for d in docs))
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == want
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == start
        start += r["n_tokens"]
    order = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert order == sorted(order, key=lambda d: (d is not None, d or 0))
    assert documents_from_records(spark, write_records(table(spark, docs).limit(0), str(tmp_path / "none"), tokenizer_path())).count() == 0


def sketch(text):
    """The retained hashes: Spark's xxhash64 of a text, and of five of these in a row, each the seed of the next."""
    def signed(x):
        return x - (1 << 64) if x >> 63 else x

    words = [signed(xxhash.xxh64_intdigest(w.encode(), 42)) for w in __import__("re").split(r"[\x20\x09-\x0D]+", text) if w]
    out = set()
    for i in range(max(len(words) - 4, 1) if words else 0):
        h = 42
        for w in words[i : i + 5]:
            h = xxhash.xxh64_intdigest(struct.pack("<q", w), h)
        out.add(signed(h))
    return sorted(h for h in out if h < -(1 << 63) + (1 << 64) // fp.SCALE)


def alike(a, b, x, y):
    if a == b:
        return 1.0
    x, y = set(x), set(y)
    return len(x & y) / len(x | y) if x | y else 0.0


def test_fingerprints(spark):
    r = random.Random(9)
    words = [f"w{i}" for i in range(900)] + ["é", "日本"]
    docs = [(0, None, "s"), (1, "", "s"), (2, "a", "s"), (3, "ab", "s"), (4, "abc d", "s"), (5, "one two three four five six", "s"), (None, "no id at all here now", "s"), (6, " \t ", "s")]
    docs += [(i, " ".join(r.choices(words, k=k)), "s") for i, k in enumerate([3, 254, 255, 256, 257, 259, 260, 261, 262, 300, 2_000, 30_000], 10)]
    docs += [(30, docs[-1][1], "s"), (31, docs[-1][1] + " z", "s")]
    got = {x["doc_id"]: x for x in fp.fingerprints(table(spark, docs)).collect()}
    order = sorted(docs, key=lambda d: (d[0] is None, -(d[0] or 0)))
    for i, (doc, text, _) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        k = len(text) // 3
        edited = text[: len(text) - k] + after[:k]
        x, y, z, g = sketch(text), sketch(edited), sketch(after), got[doc]
        assert (g["n_chars"], g["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest()), doc
        assert g["fingerprint"] == "".join(f"{h & (1 << 64) - 1:016X}" for h in x) and g["edited_fingerprint"] == "".join(f"{h & (1 << 64) - 1:016X}" for h in y)
        assert abs(g["near_edited"] - alike(text, edited, x, y)) < 1e-12 and abs(g["near_next"] - alike(text, after, x, z)) < 1e-12
        assert g["contained_in_edited"] == (len(set(x) & set(y)) / len(x) if x else None)
    assert fp.fingerprints(table(spark, docs).limit(0)).count() == 0


def test_sketches_merge(spark):
    a, b = " ".join(f"a{i}" for i in range(300)), " ".join(f"b{i}" for i in range(40))
    df = spark.createDataFrame([(a, b)], "a string, b string")
    df = fp.with_sketch(fp.with_sketch(df, "a", "x"), "b", "y")
    row = df.select(fp.merged(F.col("x"), F.col("y")).alias("m"), fp.containment(F.col("y"), fp.merged(F.col("x"), F.col("y"))).alias("c")).first()
    assert row["m"] == sorted({*sketch(a), *sketch(b)}) and row["c"] == 1.0


def pages(spark, urls):
    return spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit("h")).withColumn("way", F.lit(1)).repartition(3)


def test_siblings_merge_by_their_labelled_shares(spark):
    """Two always blocked siblings become one branch, an always allowed one stays apart; unlabelled pages follow their template."""
    rules = (("block", "h.org", "/bad/a"), ("block", "h.org", "/bad/b"), ("allow", "h.org", "/bad/c"))
    urls = [f"http://h.org/bad/{x}" for x in "abc" for _ in range(60)]
    urls += ["http://h.org/bad/d"] * 3 + ["http://h.org/good"] * 5 + ["http://other.org/bad/a/b/c/d/e/f/g/h/i/j/k", "http://other.org/bad/a/b/c/d/e/f/g/h/i/j/l"]
    got = {x["page_id"]: x for x in judge(pages(spark, urls), rules).collect()}
    assert len(got) == len(urls)
    a, b, c = (got[i]["template"] for i in (0, 60, 120))
    assert a == b == "/bad/{a|b}" and c != a and "c" in c
    assert got[0]["purity"] > 0.8 and got[120]["purity"] < 0.5
    deep = {got[len(urls) - i]["template"] for i in (1, 2)}
    assert deep == {"/bad/a/b/c/d/e/f/g/h/i/j/{k|l}"}  # below the eighth level, too


def test_rare_and_numbered_segments_are_wildcards(spark):
    urls = [f"http://h/list/item-{i}" for i in range(40)] + [f"http://h/list/{'ab'[i % 2]}" for i in range(400)] + ["http://h/list/once", None, "", "http://h", "x" * 50, "http://h/" + "a/" * 600 + "z"]
    got = [x["template"] for x in judge(pages(spark, urls)).collect() if x["path"].startswith("/list/")]
    # without labels nothing tells the siblings apart: what is left of the numbers and the rare one is the wildcard
    assert set(got) == {"/{*|list}/{*|a|b}"}
    rules = (("block", "h", "/list/a"), ("allow", "h", "/list/b"))
    got = {x["path"]: x["template"] for x in judge(pages(spark, urls), rules).collect()}
    assert got["/list/item-3"] == got["/list/item-4"] == got["/list/once"] == "/list/*"
    assert (got["/list/a"], got["/list/b"]) == ("/list/a", "/list/b")
    out = judge(pages(spark, urls)).collect()
    assert len(out) == len(urls) and all(x["verdict"] in ("allow", "block") for x in out)
    assert judge(pages(spark, urls).limit(0)).count() == 0
