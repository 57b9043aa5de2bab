"""Operators against plain Python on small tables: nulls, empty texts, ties, repeated rows, empty tables, extra columns."""

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from rentmart.llm.langid import fit, identify
from rentmart.llm.nearcopies import near_copies
from rentmart.llm.repeats import remove_repeats
from rentmart.llm.urltree import judge
from rentmart.llm.vectors import near_vectors

DOCS = "doc_id long, text string"


def corpus(seed=3, n=120):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["É", "日本", "Wörter"]
    passage = " ".join(r.choices(vocabulary, k=60))
    base = " ".join(r.choices(vocabulary, k=150)).split()
    docs = [(0, None), (1, ""), (2, " \n\t "), (3, "one"), (4, "a " * 100), (5, "b c " * 60), (6, "One"), (7, "x y z"), (8, "X y\nz")]
    for i in range(10, n):
        kind = i % 4
        if kind == 0:
            words = list(base)
            for _ in range(r.randrange(4)):
                words[r.randrange(len(words))] = "edit%d" % r.randrange(9)
            docs.append((i, " ".join(words)))
        elif kind == 1:
            docs.append((i, " ".join(r.choices(vocabulary, k=r.randrange(1, 90))) + " " + passage + "\n" + " ".join(r.choices(vocabulary, k=20))))
        elif kind == 2:
            docs.append((i, docs[-1][1] if r.random() < 0.5 else " ".join(r.choices(vocabulary, k=r.randrange(1, 200)))))
        else:
            docs.append((i, " ".join(r.choices(vocabulary[:3], k=r.randrange(30, 200)))))
    docs.append((n, " ".join(r.choices(vocabulary, k=20_000))))
    return docs


@pytest.mark.parametrize("size", [4, 5])
def test_near_copies(spark, size):
    docs = corpus()
    got = {x[0]: tuple(x[1:]) for x in near_copies(spark.createDataFrame(docs, DOCS).withColumn("n", F.lit("x")), size).collect()}
    assert got == brute.near_copies(docs, size)


def test_near_copies_long_lists(spark):
    """A family larger than a short list, and one common passage in unlike texts."""
    r = random.Random(5)
    base = [f"b{i}" for i in range(200)]
    docs = []
    for i in range(200):
        words = list(base)
        for _ in range(3):
            words[r.randrange(200)] = f"e{r.randrange(10**6)}"
        docs.append((i, " ".join(words)))
    docs += [(i, " ".join(base[:50] + [f"u{r.randrange(10**6)}" for _ in range(60)])) for i in range(200, 400)]
    got = {x[0]: tuple(x[1:]) for x in near_copies(spark.createDataFrame(docs, DOCS), 4).collect()}
    assert got == brute.near_copies(docs, 4)


def test_near_copies_repeated_and_null_ids(spark):
    text = " ".join(f"w{i}" for i in range(40))
    docs = [(None, text), (5, text), (5, "other words here now"), (9, "other words here now")]
    got = near_copies(spark.createDataFrame(docs, DOCS)).collect()
    assert len(got) == 4 and {x["component_id"] for x in got} == {None}
    assert near_copies(spark.createDataFrame([], DOCS)).count() == 0


@pytest.mark.parametrize("window", [35, 12, 20])
def test_repeats(spark, window):
    docs = corpus(8) + [(3, "again the same id"), (None, corpus(8)[30][1])]
    table = spark.createDataFrame(docs, DOCS).withColumn("row", F.lit(1)).withColumn("key", F.lit("k"))
    got = sorted((tuple(x) for x in remove_repeats(table, window).drop("text").collect()), key=str)
    assert got == brute.repeats(docs, window)


def test_repeats_empty(spark):
    assert remove_repeats(spark.createDataFrame([], DOCS)).count() == 0


def near_table(spark, rows, dim_type="double"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{dim_type}>").withColumn("v", F.lit(1)).withColumn("k", F.lit(2)).repartition(4)


def test_near_vectors(spark):
    """Odd rows, families larger than a tile, exact copies, equal directions, repeated and null ids."""
    r = random.Random(1)
    rows = [(0, None), (1, []), (2, [0.0] * 16), (3, [1.0, None] + [0.0] * 14), (4, [float("nan")] * 16), (5, [1.0]), (6, [-1.0]), (7, [2.0])]
    centres = [[r.gauss(0, 1) for _ in range(16)] for _ in range(12)]
    for i in range(10, 250):
        c = r.choice(centres)
        rows.append((i, [x + r.gauss(0, 0.25) for x in c]))
    rows += [(i, rows[-1][1]) for i in range(250, 300)]
    rows += [(i, [x + r.gauss(0, 0.02) for x in centres[0]]) for i in range(300, 900)]
    got, want = {x[0]: tuple(x[1:]) for x in near_vectors(near_table(spark, rows)).collect()}, brute.near_vectors(rows)
    assert sum(g[0] for g in got.values()) >= 0.998 * sum(w[0] for w in want.values())
    assert all(got[i][0] <= want[i][0] for i in want) and sum(got[i] == want[i] for i in want) >= 0.98 * len(want)
    assert near_vectors(near_table(spark, rows).limit(0)).count() == 0


def test_near_vectors_shared_ids(spark):
    rows = [(None, [1.0, 0.0, 0.0]), (5, [1.0, 0.1, 0.0]), (5, [0.0, 1.0, 0.0]), (5, None), (9, [0.0, 1.0, 0.05]), (8, [0.0, 0.0, 3.0])]
    got = sorted((tuple(x) for x in near_vectors(near_table(spark, rows)).collect()), key=str)
    assert got == sorted([(None, 1, None, None), (5, 1, None, None), (5, 1, None, None), (5, 0, None, None), (9, 1, None, None), (8, 0, 8, True)], key=str) or [
        (g[0], g[1], g[2]) for g in got] == sorted([(None, 1, None), (5, 1, None), (5, 1, None), (5, 0, None), (9, 1, None), (8, 0, 8)], key=str)


@pytest.mark.parametrize("threshold", [0.9, 0.8])
def test_near_vectors_at_the_threshold(spark, threshold):
    """Pairs at most 0.02 above the threshold among unrelated vectors: the share of links found."""
    rng = np.random.default_rng(5)
    base = rng.standard_normal((600, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    other = rng.standard_normal((600, 64))
    other -= (other * base).sum(axis=1, keepdims=True) * base
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    c = rng.uniform(threshold + 1e-6, threshold + 0.02, (600, 1))
    twins = c * base + np.sqrt(1 - c * c) * other
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([base, twins]))]
    got = {x[0]: x[1] for x in near_vectors(near_table(spark, rows), threshold).collect()}
    assert sum(got.values()) >= 0.99 * 1_200 and max(got.values()) <= 2


def test_language(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = fit(table)
    out = identify(table.select("doc_id", "text"), model).join(table.select("doc_id", "lang"), "doc_id").filter("held_out and lang is not null and lang_pred != 'und'")
    right = out.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.97
    odd = spark.createDataFrame([(None, None, "x"), (1, "", "y"), (2, "123 !", "z"), (3, "the house " * 50_000, None)], "doc_id long, text string, score string")
    got = {x["doc_id"]: x for x in identify(odd, model).collect()}
    assert [got[i]["lang_pred"] for i in (None, 1, 2)] == ["und"] * 3 and got[3]["lang_pred"] != "und"
    assert all(0 <= x["score"] <= 1 for x in got.values())
    assert identify(odd.limit(0), model).count() == 0
    nothing = fit(table.select("doc_id", "text", F.lit(None).cast("string").alias("lang")))
    assert {x["lang_pred"] for x in identify(odd, nothing).collect()} == {"und"}


def test_urls(spark):
    urls = [None, "no scheme", "http://A.Example.COM/en/1?x#y", "https://www.example.com/en/2", "http://x.net/es/1", "http://net", "ftp://u.net?q=/es/", "http://n.org/fr/3://k", "http://other.com"]
    rows = [(i, u) for i, u in enumerate(urls)] + [(2, urls[2])]
    got = {x["page_id"]: x for x in judge(spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit("h"))).collect()}
    assert [got[i]["rule"] for i in range(9)] == [None, None, "example.com/en/", "www.example.com/en/", "net/es/", None, None, None, None]
    assert (got[2]["host"], got[2]["path"], got[0]["host"], got[1]["path"]) == ("a.example.com", "/en/1", "", "")
    assert (got[2]["verdict"], got[3]["verdict"], got[4]["verdict"]) == ("block", "allow", "block")
    assert (got[7]["host"], got[7]["path"]) == ("n.org", "/fr/3://k")
    assert all(x["verdict"] in ("allow", "block") for x in got.values())
    assert judge(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_repeats_of_long_symbols(spark):
    """Long near copies, a text inside a longer one, periods and runs: symbols of many windows, and windows at their edges."""
    r = random.Random(21)
    base = [f"v{r.randrange(5_000)}" for _ in range(1_500)]
    docs = [(0, " ".join(base)), (1, " ".join(base[100:900])), (2, " ".join(base[140:175])), (3, " ".join(["x"] + base[300:334]))]
    for i in range(4, 24):
        words = list(base[r.randrange(300) : 1_500 - r.randrange(300)])
        for _ in range(r.randrange(1, 12)):
            words[r.randrange(len(words))] = f"e{i}"
        docs.append((i, " ".join(words)))
    docs += [(30, "p q r " * 100), (31, "a " * 300 + "b " * 100), (32, " ".join(base[:60] * 3)), (33, " ".join(f"u{k}" for k in range(400)))]
    docs += [(34, docs[1][1].replace(" ", "  ")), (35, docs[1][1])]
    got = sorted((tuple(x) for x in remove_repeats(spark.createDataFrame(docs, DOCS).repartition(4)).drop("text").collect()), key=str)
    assert got == brute.repeats(docs)


def test_key_filter_never_loses_a_key(spark):
    from rentmart.llm.common import key_filter, with_maybe

    keys = spark.range(0, 4_000, 2).select((F.xxhash64("id")).alias("k")).unionByName(spark.createDataFrame([(0,), (-1,), (2**63 - 1,), (-(2**63),)], "k long"))
    rows = spark.range(0, 4_000).select(F.xxhash64("id").alias("k"), (F.col("id") % 2 == 0).alias("there"))
    rows = rows.unionByName(spark.createDataFrame([(0, True), (-1, True), (2**63 - 1, True), (-(2**63), True)], "k long, there boolean"))
    got = with_maybe(rows, "k", key_filter(keys, "k"), "maybe")
    assert got.filter("there and not maybe").count() == 0 and got.filter("maybe and not there").count() <= 10
    assert with_maybe(rows, "k", key_filter(keys.limit(0), "k"), "maybe").filter("maybe").count() == 0
