"""The stages of the corpus pipeline, each on an odd table, and the whole run against its stages' rules."""

import hashlib
import re
from collections import Counter

import brute
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C

COLUMNS = "doc_id long, text string, source string, lang string, n_chars int, row string, tag string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def documents():
    """English and German texts with labels; nulls, no letters, repeated rows and ids, a very long text."""
    english, german = "the house and the tree are of that old town", "das haus und der baum sind von jener alten stadt"
    docs = []
    for i in range(300):
        words = (english if i % 2 else german).split()
        text = " ".join(words[(i * 7 + k * k) % len(words)] + (str(i) if k % 9 == 0 else "") for k in range(30 + i % 25))
        docs.append((i, text + ("\nterms of use apply to this page" if i % 3 == 0 else ""), ["a", "b", None][i % 3], "en" if i % 2 else "de"))
    docs += [(400, None, "a", "en"), (401, "", "b", None), (402, "123 !?", None, "de"), (403, docs[5][1], "a", None), (5, docs[7][1], "c", "en")]
    docs += [(None, docs[9][1] + " at the end", "a", None), (404, "the tree " * 60_000, "long", "en")]
    return [(d, t, s, y, len(t) if t is not None else None, "r", None) for d, t, s, y in docs]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(documents(), COLUMNS).repartition(4).cache()


def ids(df):
    return Counter(r["doc_id"] for r in df.select("doc_id").collect())


def test_language(spark, table):
    out = C.language(spark, table, "")
    assert out.columns == table.columns
    kept = ids(out)
    assert all(kept[i] == 0 for i in (400, 401, 402))           # no text, or no letter
    clean = Counter(d[0] for d in documents() if d[1] and any(c.isalpha() for c in d[1]))
    assert kept == clean                                         # documents in a learned language stay
    assert C.language(spark, table.limit(0), "").count() == 0


def test_lines(spark, table):
    out = C.lines(spark, table, "")
    assert out.columns == table.columns and out.count() == table.count()
    texts = {}
    for r in out.collect():
        texts.setdefault(r["doc_id"], []).append(r["text"])
        assert r["n_chars"] == len(r["text"])
    marked = [d for d, t in texts.items() for x in t if "terms of use apply to this page" in x.split("\n")]
    assert marked == [0]                                         # the smallest id keeps it
    assert C.lines(spark, table.limit(0), "").count() == 0


def test_near_duplicates(spark, table):
    out = C.near_duplicates(spark, table, "")
    assert out.columns == table.columns
    rows = [(i, r["text"]) for i, r in enumerate(sorted(table.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0)))]
    groups = Counter(v[1] for v in brute.near_copies(rows, 5).values())
    assert out.count() == len(groups)                            # one row of each group
    assert C.near_duplicates(spark, table.limit(0), "").count() == 0


def test_mixture(spark, table):
    out = C.mixture(spark, table, "")
    assert out.columns == table.columns
    size = Counter()
    for d in documents():
        size[d[2]] += len(WORD.findall(d[1] or ""))
    words = Counter()
    for r in out.select("source", "text").collect():
        words[r["source"]] += len(WORD.findall(r["text"] or ""))
    total = sum(size.values())
    assert abs(sum(words.values()) - total) <= len(size)         # shares of all words, floors apart
    assert all(words[s] <= 3 * size[s] for s in size)
    assert C.mixture(spark, table.limit(0), "").count() == 0


def test_packing(spark, table):
    out = C.packing(spark, table, "")
    pieces = out.collect()
    by_row = Counter()
    for p in pieces:
        by_row[p["doc_id"]] += p["length"]
    whole = Counter()
    for p in pieces:
        if p["start"] == 0:
            whole[p["doc_id"]] += p["doc_tokens"]
    assert by_row == whole and set(whole) == {d[0] for d in documents()}
    assert C.packing(spark, table.limit(0), "").count() == 0


def test_run(spark, table, tmp_path):
    """Every stage works on what its predecessor kept."""
    table.write.parquet(str(tmp_path / "documents.parquet"))
    assert [n for n, _ in C.STAGES] == ["language_id", "line_dedup", "near_dedup", "mixing", "packing"]
    pieces = C.run(spark, str(tmp_path)).collect()
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in C.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        docs.write.mode("overwrite").parquet(str(tmp_path / "now"))
        docs = spark.createDataFrame(spark.read.parquet(str(tmp_path / "now")).collect(), docs.schema)
    assert Counter(p["doc_id"] for p in pieces if p["start"] == 0) == ids(docs)
    assert {400, 401, 402} & {p["doc_id"] for p in pieces} == set()
    assert len({hashlib.md5(str((p["doc_id"], p["start"], p["ids_crc32"], p["sequence_id"], p["offset"])).encode()).digest() for p in pieces}) == len(pieces)
    assert docs.filter(F.col("text").isNull()).count() == 0
