"""Spelling variants against plain Python: all pairs, compared by deletions."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rentmart.llm.spelling import single_edits, spelling_variants, text_runs, variants

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def brute_words(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in RUN.findall(text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w in counts:
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= 2 * counts[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return {w: (form[w], root(w), counts[w], len(near[w]), counts[form[w]] if form[w] else None) for w in counts}


def results(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def test_single_edits_of_all_short_words():
    words = ["".join(x) for n in (2, 3, 4) for x in __import__("itertools").product("abé", repeat=n)]
    for shorter in (2, 3):
        some = [w for w in words if len(w) in (shorter, shorter + 1)]
        code = [w.encode("latin-1") for w in some]
        near = single_edits(code, code, shorter, 0)
        for i, a in enumerate(some):
            for j, b in enumerate(some):
                assert near[i, j] == (one_edit(a, b) and min(len(a), len(b)) == shorter)


@pytest.mark.parametrize("tile", [3, 512])
def test_variants(spark, tile):
    """Small tiles: most meetings are cut into several."""
    r = random.Random(11)
    counts = {}
    for _ in range(400):
        w = "".join(r.choices("abÿ", k=r.randrange(5, 9)))
        counts[w] = r.choice([3, 3, 4, 6, 12, 24, 50, 100, 200])
    counts |= {"é" * 3_000: 3, "é" * 3_001: 9, "lonely" * 4: 5}
    table = spark.createDataFrame(list(counts.items()), "word string, n long").withColumn("a", F.lit(1)).repartition(3)
    assert results(variants(table, tile)) == brute(counts)


def test_documents(spark):
    r = random.Random(2)
    words = ["straße", "Straße", "strasse", "hello", "hallo", "hullo", "Éclair", "éclair", "a×b÷cd", "four", "ABCDE", "abcdf", "naïve", "日本hello"]
    docs = [(i, " ".join(r.choices(words, k=40)) + f"\n{r.choice(words)}-{r.choice(words)}'s") for i in range(120)]
    docs += [(None, "hello hello hello"), (5, docs[5][1]), (200, None), (201, ""), (202, "12 345 ... Āā"), (203, "hellp " * 200_000), (204, "x" * 1_500_000)]
    table = spark.createDataFrame(docs, "doc_id long, text string").withColumn("word", F.lit("w")).withColumn("n", F.lit(2)).repartition(4)
    assert results(spelling_variants(table)) == brute(brute_words(docs))
    assert spelling_variants(table.limit(0)).count() == 0
    assert spelling_variants(table.filter("text is null")).columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_long_texts_are_cut_between_runs():
    text = "Éa " + "b" * 3_000_000 + " c" * 700_000
    assert text_runs(text) == Counter(RUN.findall(text.encode().lower().decode()))
