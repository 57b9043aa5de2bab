"""Token ids of a text against one call of the library on the whole text."""

import random

import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from rentmart.llm.queries import tokenizer_path
from rentmart.llm.records import documents_from_records, ids_crc, write_records
from rentmart.llm.tokens import Encoder

END = "<|endoftext|>"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path())


def same(library, texts):
    ids, n = Encoder(tokenizer_path()).encode(pa.array(texts, pa.string()))
    want = [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    return n.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_added_token(library):
    ids, n = Encoder(tokenizer_path()).encode(pa.array([f"a page{END}next"]))
    assert ids.tolist() == [64, 2443, 50256, 19545] and n.tolist() == [4]
    # next to texts without it, repeated, cut, over the edge of two texts, null and empty ones
    assert same(library, [None, "", "plain, text", f"x {END} y", END * 3, "<|endof", "text|>", f"<|endoftext|{END}\n", None, "last"])
    assert same(library, [END]) and same(library, [None, ""]) and same(library, [])


def test_ids_are_those_of_one_library_call(library):
    r = random.Random(1)
    alphabet = "aB1 ,.;\n\t\r '\"s<|>é日　  \u0085\u001c​-—"
    texts = ["".join(r.choices([*alphabet, END], [3] * len(alphabet) + [1], k=r.randrange(40))) for _ in range(5_000)]
    assert same(library, texts)


def test_token_records(spark, library, tmp_path):
    docs = [(5, "five words, no more"), (1, f"one{END}two"), (None, "no id"), (9, None), (3, f"{END}"), (7, "last")]
    out = documents_from_records(spark, write_records(spark.createDataFrame(docs, "doc_id long, text string"), str(tmp_path / "r"), tokenizer_path()))
    want, start = [], 0
    for doc, text in sorted(docs, key=lambda d: (d[0] is not None, d[0])):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        want.append((doc, start, len(ids), ids_crc(pa.array(ids).to_numpy())))
        start += len(ids)
    assert sorted((tuple(x) for x in out.collect()), key=lambda x: x[1]) == want
