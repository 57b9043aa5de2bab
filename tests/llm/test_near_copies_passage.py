"""Two documents that are alike mostly by a passage which many unlike documents have, too."""

import random

import brute
import pytest

from rentmart.llm import nearcopies
from rentmart.llm.nearcopies import MARGIN, K, near_copies


@pytest.mark.parametrize("seed", [4569, 6120, 7372])
def test_link_by_a_common_passage(spark, seed):
    """Likeness 160 / 200, 150 of them the passage; the first eight values of either that are its own differ."""
    r = random.Random(seed)
    passage = [f"p{i}" for i in range(150)]
    docs = [(i, " ".join(r.sample(passage, 100) + [f"u{i}v{k}" for k in range(9)])) for i in range(150)]
    own = [f"s{seed}x{i}" for i in range(50)]
    docs += [(1000, " ".join(passage + own[:30])), (1001, " ".join(passage + own[:10] + own[30:]))]
    docs += [(2000 + i, " ".join(passage + [f"u{2000 + i}v{k}" for k in range(200 + i)])) for i in range(3)]
    got = {x[0]: tuple(x[1:]) for x in near_copies(spark.createDataFrame(docs, "doc_id long, text string"), 1).collect()}
    want = brute.near_copies(docs, 1)
    assert want[1001] == (180, 1000, False)
    assert got == want


def test_open_classes_are_dealt_out_once(spark, monkeypatch):
    """The shingles of open classes go to their documents in one shuffle, for the grouping and for the order."""
    plans = {}

    def kept(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return nearcopies.cut_lineage(df)

    monkeypatch.setattr(nearcopies, "stored", kept)
    common = spark.createDataFrame([(7, 1, 2, 0), (7, 2, 2, 0)], "value long, doc long, n long, rank int")
    parts = spark.createDataFrame([(1, 1), (2, 2)], "doc long, part long")
    texts = spark.createDataFrame([(1, "a b"), (2, "b a")], "doc long, text string")
    found = nearcopies._open(common, parts, texts, 1, 80)
    assert plans["prefix"].count("Exchange hashpartitioning(doc") == 1
    assert [tuple(r) for r in found.distinct().collect()] == [(1, 2)]


def test_margin_keeps_links():
    from math import comb

    lost = sum(comb(K, i) * 0.8**i * 0.2 ** (K - i) for i in range(K + 1) if i / K < 0.8 - MARGIN)
    assert lost < 1e-6
