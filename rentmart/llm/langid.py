"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

Characters are lower-cased code points; n-grams of 1 to 3 are hashed to ``DIMS`` columns, weighted by 1 + log(tf) times
idf and scaled to length 1. Weights are learned by follow-the-regularised-leader with per-coordinate steps and an
elastic-net penalty (L1 and L2), so most of them are zero. A temperature fitted on rows kept out of the training
then calibrates the probabilities. The size of the model follows the labels, not the corpus; prediction is one pass over whole
texts without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rentmart.llm.common import pick, schema_of, small_batches
from rentmart.llm.textarrays import mix, slices

DIMS = 1 << 14
#: bound of the training sample, the rows with the smallest hash of their id (one row of each label at least)
SAMPLE = 3_000
#: bits of that hash that a label's rows are counted by, to find where its share ends
_COUNTED = 12
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")
#: code points of a text that are hashed at once: memory stays level for texts of any length
_CHUNK = 1 << 20


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Columns and counts of the hashed n-grams of a whole text."""
    total = np.zeros(DIMS, np.int64)
    for at in range(0, max(len(text), 1), _CHUNK):
        # two code points of overlap behind the chunk, counted once
        piece = np.frombuffer(text[at : at + _CHUNK + 2].lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        m = min(_CHUNK, len(piece)) if at + _CHUNK < len(text) else len(piece)
        for n in (1, 2, 3):
            h = np.full(max(min(m, len(piece) - n + 1), 0), n, np.uint64)
            for i in range(n):
                h = h * np.uint64(0x100000001B3) + piece[i : i + len(h)]
            total += np.bincount((mix(h) >> np.uint64(40)).astype(np.int64) & (DIMS - 1), minlength=DIMS)
    cols = np.flatnonzero(total)
    return cols, total[cols]


@dataclass
class Model:
    labels: list[str]
    idf: np.ndarray
    weights: np.ndarray  # labels x (DIMS + 1), the last column is the bias
    temperature: float

    def vector(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        return self.weighted(*features(text))

    def weighted(self, cols: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = (1 + np.log(counts)) * self.idf[cols]
        size = np.sqrt((x * x).sum())
        return np.append(cols, DIMS), np.append(x / size if size else x, 1.0)

    def logits(self, text: str) -> np.ndarray:
        cols, x = self.vector(text)
        return self.weights[:, cols] @ x

    def predict(self, text: str | None) -> tuple[str, float]:
        if text is None or not self.labels or not _LETTER.search(text):
            return UNKNOWN, 0.0
        p = softmax(self.logits(text) / self.temperature)
        best = int(p.argmax())
        return self.labels[best], float(p[best])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max())
    return e / e.sum()


def fit_rows(counted: list[tuple[np.ndarray, np.ndarray]], langs: list[str], idf: np.ndarray, epochs: int = 3, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.05) -> Model:
    """Fits a model on the ``features`` of rows in the given order; every fifth one is kept for the temperature."""
    labels = sorted(set(langs))
    model = Model(labels, idf, np.zeros((len(labels), DIMS + 1)), 1.0)
    if not labels:
        return model
    number = {y: i for i, y in enumerate(labels)}
    rows = [(*model.weighted(*c), number[y]) for c, y in zip(counted, langs, strict=True)]
    held = rows[4::5] if len(rows) >= 20 else rows
    train = [r for i, r in enumerate(rows) if i % 5 != 4] if len(rows) >= 20 else rows
    z, n, w = np.zeros_like(model.weights), np.zeros_like(model.weights), model.weights
    for _ in range(epochs):
        for cols, x, y in train:
            g = softmax(w[:, cols] @ x)
            g[y] -= 1
            grad = g[:, None] * x
            zc, nc = z[:, cols], n[:, cols]
            sigma = (np.sqrt(nc + grad**2) - np.sqrt(nc)) / alpha
            zc = zc + grad - sigma * w[:, cols]
            nc = nc + grad**2
            w[:, cols] = np.where(np.abs(zc) <= l1, 0, -(zc - np.sign(zc) * l1) / ((beta + np.sqrt(nc)) / alpha + l2))
            z[:, cols], n[:, cols] = zc, nc
    scores = [(w[:, cols] @ x, y) for cols, x, y in held]
    loss = lambda t: -sum(np.log(max(softmax(s / t)[y], 1e-12)) for s, y in scores)
    model.temperature = float(min(np.geomspace(0.05, 5, 60), key=loss))
    return model


def held_out(doc_id: str = "doc_id") -> F.Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """idf of each column over all texts that are not held out: each task sums its own, at most ``DIMS`` rows reach the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(DIMS + 1, np.int64)  # the last one counts the documents
        for batch in batches:
            for t in batch.column("text"):
                df[features(t.as_py())[0]] += 1
                df[DIMS] += 1
        cols = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({"col": pa.array(cols, pa.int64()), "df": pa.array(df[cols], pa.int64())})

    learned = pick(docs, "doc_id", "text").filter(~held_out() & F.col("text").isNotNull()).select("text")
    parts = learned.mapInArrow(run, "col long, df long")
    df = np.zeros(DIMS + 1)
    for r in parts.groupBy("col").agg(F.sum("df").alias("df")).collect():
        df[r["col"]] = r["df"]
    return np.log((1 + df[DIMS]) / (1 + df[:DIMS])) + 1


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Learns from text and lang of the rows whose id does not fall into the held-out fold.

    The ``sample`` labelled rows with the smallest hash of their id are taken, an equal number for each label at most and
    one at least. The idf is that of all texts outside the held-out fold. Only hashed counts reach the driver, no text.
    """
    small_batches(docs.sparkSession)
    rows = pick(docs, "doc_id", "text", "lang").filter(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    key = F.xxhash64(F.col("doc_id"), F.lit("langid"))
    share = max(1, sample // max(1, rows.select("lang").distinct().count()))
    narrow = rows.select("lang", key.alias("_key"), F.xxhash64("text").alias("_t"))
    # where each label's share ends, by counts of the leading bits: only these rows of a frequent label are ranked
    narrow = narrow.withColumn("_lead", F.shiftright("_key", 64 - _COUNTED))
    upto = F.sum("_n").over(Window.partitionBy("lang").orderBy("_lead"))
    counts = narrow.groupBy("lang", "_lead").agg(F.count("*").alias("_n")).withColumn("_upto", upto - F.col("_n"))
    last = counts.filter(F.col("_upto") < share).groupBy("lang").agg(F.max("_lead").alias("_last"))
    # one row per label, of which the model has as many
    narrow = narrow.join(F.broadcast(last), "lang").filter(F.col("_lead") <= F.col("_last")).select("lang", "_key", "_t")
    order = Window.partitionBy("lang").orderBy("_key", "_t")
    narrow = narrow.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= share).drop("_rank")
    taken = narrow.groupBy("lang", "_key", "_t").agg(F.count("*").alias("_n"))
    texts = rows.withColumns({"_key": key, "_t": F.xxhash64("text")}).join(F.broadcast(taken), ["lang", "_key", "_t"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                got = [features(t.as_py()) for t in part.column("text")]
                yield pa.RecordBatch.from_pydict({
                    **{c: part.column(c) for c in ("lang", "_key", "_t", "_n")},
                    "cols": pa.array([g[0].astype("<i4").tobytes() for g in got], pa.binary()),
                    "counts": pa.array([g[1].astype("<i8").tobytes() for g in got], pa.binary()),
                })

    counted = texts.select("lang", "_key", "_t", "_n", "text").mapInArrow(run, "lang string, _key long, _t long, _n long, cols binary, counts binary")
    # rows of equal id and text are alike: as many as were taken
    alike = counted.groupBy("lang", "_key", "_t", "_n").agg(F.first("cols").alias("cols"), F.first("counts").alias("counts"))
    got = sorted((r for r in alike.collect() for _ in range(r["_n"])), key=lambda r: (r["_key"], r["_t"], r["lang"]))
    vectors = [(np.frombuffer(r["cols"], "<i4").astype(np.int64), np.frombuffer(r["counts"], "<i8")) for r in got]
    return fit_rows(vectors, [r["lang"] for r in got], inverse_frequencies(docs) if got else np.ones(DIMS))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` and held_out, lang_pred, score.

    The prediction reads the text alone. A null text or one without a letter is ``und`` with score 0. An empty table
    gives no row; a null id is not held out. Columns of the same names are replaced.
    """
    small_batches(docs.sparkSession)
    cols = [c for c in docs.columns if c not in ("held_out", "lang_pred", "score")]
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("_row"), F.col("text"), held_out().alias("held_out"))
    d = d.select("_row", "text", "held_out")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # DIMS x labels weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                got = [m.predict(t.as_py()) for t in part.column("text")]
                yield pa.RecordBatch.from_pydict({
                    "_row": part.column("_row"), "held_out": part.column("held_out"),
                    "lang_pred": pa.array([g[0] for g in got], pa.string()), "score": pa.array([g[1] for g in got], pa.float64()),
                })

    out = d.mapInArrow(run, schema_of(d.select("_row", "held_out"), "lang_pred string, score double"))
    return out.select(*[F.col(f"_row.`{c}`") for c in cols], "held_out", "lang_pred", "score")
