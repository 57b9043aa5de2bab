"""What the language model learns from: every label, and no held-out text."""

import zlib

import numpy as np

from rentmart.llm.langid import DIMS, features, fit

COLUMNS = "doc_id long, text string, lang string"


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_every_label_and_idf_of_the_training_fold(spark):
    docs = [(i, f"text number {i} of {chr(0x4E00 + i)}", f"l{i % 230:03d}") for i in range(1_500)]
    docs += [(i, "zqx never labelled", None) for i in range(1_500, 1_520)] + [(None, None, "l000")]
    model = fit(spark.createDataFrame(docs, COLUMNS), sample=300)
    learned = [d for d in docs if not held(d[0])]
    assert model.labels == sorted({d[2] for d in learned if d[2] and d[1]})
    df = np.zeros(DIMS)
    texts = [d[1] for d in learned if d[1] is not None]
    for text in texts:
        df[features(text)[0]] += 1
    assert np.allclose(model.idf, np.log((1 + len(texts)) / (1 + df)) + 1)


def test_held_out_texts_do_not_matter(spark):
    """One frequent label, ties of the hash (repeated ids), few rows of another one."""
    docs = [(i % 700, f"the text {i} in {'abc'[i % 3]}", "aa") for i in range(900)] + [(i, f"der text {i}", "bb") for i in range(900, 920)]
    changed = [(i, "something else altogether " + t[::-1], "cc") if held(i) else (i, t, y) for i, t, y in docs]
    a, b = (fit(spark.createDataFrame(d, COLUMNS), sample=60) for d in (docs, changed))
    assert a.labels == b.labels == ["aa", "bb"] and a.temperature == b.temperature
    assert np.array_equal(a.idf, b.idf) and np.array_equal(a.weights, b.weights)
