"""Stages of the corpus pipeline on small tables."""

from corpus_pipeline import near_duplicates

COLUMNS = "doc_id long, text string, source string"


def test_near_duplicates_judges_rows(spark):
    """Repeated and null ids: a row goes for its own text only, copies go whatever their ids."""
    copy, other, third = (" ".join(f"{c}{i}" for i in range(40)) for c in "abc")
    near = copy.replace("a39", "x")
    docs = [
        (1, copy, "s"), (5, near, "s"), (5, other, "s"),  # the second row of 5 resembles nothing
        (7, third, "s"), (7, third, "s"),  # one of them stays
        (None, "d " * 9 + third, "s"), (None, "no words in common here", "s"), (None, "no words in common here", "s"),
        (8, None, "s"), (9, "", "s"), (9, "", "t"),
    ]
    out = near_duplicates(spark, spark.createDataFrame(docs, COLUMNS), "")
    assert out.columns == ["doc_id", "text", "source"]
    got = sorted((tuple(x) for x in out.collect()), key=str)
    want = [(1, copy, "s"), (5, other, "s"), (None, "d " * 9 + third, "s"), (None, "no words in common here", "s"), (8, None, "s"), (9, "", "s"), (9, "", "t")]
    assert got == sorted(want, key=str)
    assert near_duplicates(spark, spark.createDataFrame([], COLUMNS), "").count() == 0
