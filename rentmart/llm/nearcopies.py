"""Near-duplicate documents by bottom-k sketches of one hash function.

A sketch is the ``K`` smallest hashes of a document's shingle set. Documents with equal sets are one class and only the
class goes on. The smallest retained values of every class form inverted lists. Every list first pairs its members with
a few heads of the list alone; members of a list of more than ``LIST`` classes (a common passage, a large family of
copies) go on to their next retained values until they have ``LEADS`` short ones. The sketch of the union of a
pair estimates its similarity and drops clear misses; each class is confirmed with its likeliest head on full sets.
These links are a forest of families. From here on only pairs from different families matter: the members of
every short list, and the *open* classes, those that lead to a long list which several families share.

Open classes are compared by their whole sets: their shingles are ordered by the number of open classes that hold them,
rarest first. Two sets with Jaccard J share at least one of the first n - ceil(J n) + 1 shingles of each in any
common order, and what can still follow after their first shared one must suffice for J. A passage that
thousands of otherwise unlike documents share is last in that order, so these never meet; nothing is left out.

Two sets with Jaccard J share none of their ``LEADS`` smallest union values with probability (1 - J)^LEADS: 3e-6 at 0.8.
The first value they share is one of the first ``LEADS`` of both. If its list is short, they meet there; if it is long,
both are open.
"""

from __future__ import annotations

from collections.abc import Iterator
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rentmart.llm.common import components, cut_lineage, let_go, maybe_among, roots, small_batches, stored
from rentmart.llm.lines import NO_ID
from rentmart.llm.textarrays import LOWER, flat, ngram_hash, slices, span_hash, words

#: values of a sketch; values that lead to lists; values looked at for them; classes of a short list
K, LEADS, LOOK, LIST = 64, 8, 32, 64
#: an estimate this far below the threshold ends a pair (six standard deviations of a sketch)
MARGIN = 0.3


def shingle_sets(column: pa.Array, size: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the ``size``-word shingles of each text (A-Z in lower case)."""
    data, offsets = flat(column)
    data = LOWER[data]
    starts, ends, first = words(data, offsets)
    h = span_hash(data, starts, ends)
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        w = h[a:b]
        out.append(np.unique(ngram_hash(w, min(size, len(w)))) if len(w) else np.zeros(0, np.uint64))
    return out


def estimate(a: np.ndarray, na: int, b: np.ndarray, nb: int) -> float:
    """Jaccard from two bottom-k sketches (sorted), by the bottom-k sketch of their union; exact for small sets."""
    k = K if max(na, nb) > K else na + nb
    union = np.union1d(a, b)[:k]
    both = np.intersect1d(a, b, assume_unique=True)
    return float(np.count_nonzero(both <= union[-1])) / len(union) if len(union) else 0.0


def _packed(values: list[np.ndarray]) -> pa.Array:
    return pa.array([v.astype("<u8").tobytes() for v in values], pa.binary())


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """(doc, n, h1, h2, sketch, lead): set size, hashes of the set, retained values (packed), the smallest ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(part.column("text"), size)
                every = np.concatenate([*sets, np.zeros(0, np.uint64)])
                ends = np.cumsum([len(s) for s in sets], dtype=np.int64)
                starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                yield pa.RecordBatch.from_pydict({
                    "doc": part.column("doc"), "n": pa.array([len(s) for s in sets], pa.int64()),
                    "h1": pa.array(span_hash(every, starts, ends, 0).view(np.int64)),
                    "h2": pa.array(span_hash(every, starts, ends, 1).view(np.int64)),
                    "sketch": _packed([s[:K] for s in sets]),
                    "lead": pa.array([s[:LOOK].view(np.int64) for s in sets], pa.list_(pa.int64())),
                })

    return docs.mapInArrow(run, "doc long, n long, h1 long, h2 long, sketch binary, lead array<long>")


def _candidates(classes: DataFrame, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(a, b), a < b: pairs of classes with heads of their inverted lists; the short lists (value, members); and the members
    of long lists (value, doc, n, rank) by their first ``LEADS`` values. ``classes``: doc, n, lead, copies. Heads of a long list are its first, its smallest and its largest
    member, one by hash, and the one with the most equal copies, as families grow around what is copied most."""
    entries = classes.select("doc", "n", "copies", F.posexplode("lead").alias("rank", "value"))
    early = entries.filter(F.col("rank") < LEADS)
    here = F.struct("doc", "n")
    # counted first: the heads' wide rows are shuffled for the values of long lists alone
    often = cut_lineage(entries.groupBy("value").count().filter(F.col("count") > LIST).select("value"))
    long_ = cut_lineage(entries.join(often, "value").groupBy("value").agg(
        F.min(here).alias("h0"), F.min_by(here, F.xxhash64("doc", "value")).alias("h1"),
        F.min_by(here, F.struct("n", "doc")).alias("h2"), F.max_by(here, F.struct("n", "doc")).alias("h3"),
        F.max_by(here, F.struct("copies", F.bitwise_not("doc"))).alias("h4")))
    let_go(classes.sparkSession)
    heads = F.explode(F.array_distinct(F.array("h0", "h1", "h2", "h3", "h4")))
    hot = early.join(long_, "value").select("doc", "n", heads.alias("o")).filter(f"doc != o.doc and 100 * least(n, o.n) >= {percent} * greatest(n, o.n)")
    # short lists: the first LEADS short values of each class
    short = entries.join(long_.select("value"), "value", "left_anti")
    lists = cut_lineage(short.groupBy("doc", "n").agg(F.slice(F.array_sort(F.collect_list(F.struct("rank", "value"))), 1, LEADS).alias("lead")))
    let_go(classes.sparkSession)
    common = cut_lineage(early.join(long_.select("value"), "value", "left_semi").select("value", "doc", "n", "rank"))
    lists = lists.select("doc", "n", F.explode("lead").alias("e")).groupBy("e.value").agg(F.collect_list(F.struct("doc", "n")).alias("members"))
    lists = cut_lineage(lists.filter(F.size("members") > 1))
    let_go(classes.sparkSession)
    drawn = F.element_at("members", (F.pmod(F.xxhash64("value"), F.size("members")) + 1).cast("int"))
    ahead = lists.select(F.explode("members").alias("x"), F.array_distinct(F.array(F.array_min("members"), drawn)).alias("o"))
    ahead = ahead.select("x.doc", "x.n", F.explode("o").alias("o")).filter(f"doc != o.doc and 100 * least(n, o.n) >= {percent} * greatest(n, o.n)")
    pairs = hot.unionByName(ahead).select(F.least("doc", "o.doc").alias("a"), F.greatest("doc", "o.doc").alias("b")).distinct()
    return pairs, lists, common


def _apart(lists: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """(a, b), a < b: the members of each short list that lie in different families."""
    m = lists.select("value", F.explode("members").alias("m")).select("value", "m.doc", "m.n").join(parts, "doc")
    m = m.groupBy("value").agg(F.collect_list(F.struct("doc", "n", "part")).alias("members"), F.min("part").alias("lo"), F.max("part").alias("hi"))
    both = m.filter("lo != hi").select(F.explode("members").alias("x"), "members").select("x", F.explode("members").alias("y"))
    both = both.filter(f"x.doc < y.doc and x.part != y.part and 100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n)")
    return both.select(F.col("x.doc").alias("a"), F.col("y.doc").alias("b"))


def _estimated(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(a, b, likeness): the pairs of different families that the sketch of their union does not rule out."""
    side = ["doc", "n", "part", "sketch"]
    both = pairs.join(classes.select(*[F.col(c).alias(f"{c}_a") for c in side]).withColumnRenamed("doc_a", "a"), "a").join(
        classes.select(*[F.col(c).alias(f"{c}_b") for c in side]).withColumnRenamed("doc_b", "b"), "b"
    ).filter(f"part_a != part_b and 100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            j = np.array([
                estimate(np.frombuffer(x, "<u8"), nx, np.frombuffer(y, "<u8"), ny)
                for x, nx, y, ny in zip(*(b.column(c).to_pylist() for c in ("sketch_a", "n_a", "sketch_b", "n_b")), strict=True)
            ], dtype=float)
            out = pa.RecordBatch.from_pydict({"a": b.column("a"), "b": b.column("b"), "likeness": pa.array(j)})
            yield out.filter(pa.array(j >= percent / 100 - MARGIN))

    return both.select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b").mapInArrow(run, "a long, b long, likeness double")


def _confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are alike: 100 * intersection >= percent * union."""
    pairs = cut_lineage(pairs.select("a", "b"))
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("doc")).distinct()
    texts = stored(maybe_among(texts, wanted, "doc").join(wanted, "doc", "left_semi"), "texts")
    left, right = (texts.select(F.col("doc").alias(c), F.col("text").alias(f"t{c}")) for c in "ab")
    both = pairs.select("a", "b").join(left, "a").join(right, "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "ta"):
                x, y = shingle_sets(part.column("ta"), size), shingle_sets(part.column("tb"), size)
                common = [len(np.intersect1d(p, q, assume_unique=True)) for p, q in zip(x, y, strict=True)]
                keep = [100 * c >= percent * (len(p) + len(q) - c) for c, p, q in zip(common, x, y, strict=True)]
                yield pa.RecordBatch.from_pydict({"a": part.column("a"), "b": part.column("b")}).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def _open(common: DataFrame, parts: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """(a, b), a < b: pairs of open classes of different families whose whole sets can be alike.

    ``common``: (value, doc, n, rank), the members of the long lists. Shingles that one open class alone holds come
    first in the order and can be shared by none: they only count. A class's text may stand in several rows, all alike
    but by the doc_id that they share with rows of other texts; the set of the class's size is taken.
    """
    m = common.join(parts, "doc")
    mixed = m.groupBy("value").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).filter("lo != hi").select("value")
    docs = cut_lineage(m.join(mixed, "value", "left_semi").select("doc", "n", "part").distinct())

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(part.column("text"), size)
                sizes = np.array([len(x) for x in sets], np.int64)
                here = [i for i, (a, b) in enumerate(zip(sizes.tolist(), part.column("n").to_pylist(), strict=True)) if a == b]
                at = np.repeat(np.array(here, np.int64), sizes[here])
                values = np.concatenate([sets[i] for i in here] or [np.zeros(0, np.uint64)])
                yield pa.RecordBatch.from_pydict({
                    **{c: part.column(c).take(pa.array(at)) for c in ("doc", "n", "part")}, "value": pa.array(values.view(np.int64)),
                })

    held = maybe_among(texts, docs, "doc").join(docs, "doc").mapInArrow(shingles, "doc long, n long, part long, value long")
    held = stored(held, "shingles")
    several = held.groupBy("value").agg(F.count("*").alias("df")).filter("df > 1")
    # dealt out once, by what the window below goes by: the rows of one class and id are grouped where they lie
    held = held.join(several, "value").repartition("doc", "n").groupBy("doc", "n", "part", "value", "df").count()
    every = Window.partitionBy("doc", "n")
    spot = F.row_number().over(every.orderBy("df", "value")) - 1 + F.col("n") - F.count("*").over(every)
    prefix = held.withColumn("spot", spot).filter(f"spot <= n - ceil(n * {percent} / 100.0D)").select("doc", "n", "part", "value", "spot")
    prefix = stored(prefix, "prefix")
    meets = prefix.groupBy("value").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).filter("lo != hi").select("value")
    y = cut_lineage(prefix.join(meets, "value", "left_semi"))
    x = y.select("value", *[F.col(c).alias(f"x_{c}") for c in ("doc", "n", "part", "spot")])
    need = f"{percent} * (n + x_n) <= {100 + percent} * least(n - spot, x_n - x_spot)"
    near = f"x_doc < doc and x_part != part and 100 * least(n, x_n) >= {percent} * greatest(n, x_n) and {need}"
    both = x.join(y, (x["value"] == y["value"]) & F.expr(near))
    return both.select(F.col("x_doc").alias("a"), F.col("doc").alias("b"))


def near_copies(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    ``docs``: doc_id, text; other columns are ignored. Words are runs of anything but white space, A-Z in lower case.
    A document with fewer than ``size`` words has all of them as its only shingle; one without words (null, empty)
    links with nothing and is kept. Documents link when 100 * intersection >= ``percent`` * union; ``component_id``
    is the smallest doc_id reachable. Rows that share a doc_id are one node; a null id is the smallest node and
    stays null. An empty table gives no row.
    """
    small_batches(docs.sparkSession)
    d = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).cast("long").alias("doc"), F.col("text"))
    s = cut_lineage(sketches(d, size))
    classes = cut_lineage(s.filter("n > 0").groupBy("n", "h1", "h2").agg(F.min("doc").alias("doc"), F.first("sketch").alias("sketch"), F.first("lead").alias("lead"), F.count("*").alias("copies")))
    s = cut_lineage(s.select("doc", "n", "h1", "h2"))
    let_go(docs.sparkSession)       # the sketches of all rows: from here on classes have them
    full = s.filter("n > 0")
    candidates, lists, common = _candidates(classes.select("doc", "n", "lead", "copies"), percent)
    pairs = cut_lineage(_estimated(candidates, classes.withColumn("part", F.col("doc")), percent))
    best = pairs.groupBy("b").agg(F.max_by("a", F.struct("likeness", F.bitwise_not("a"))).alias("a")).select("a", "b")
    first = cut_lineage(_confirmed(best, d, size, percent))
    # each class has one link at most, to a smaller one: a forest
    tops = roots(first.select(F.col("b").alias("node"), F.col("a").alias("root")))
    classes = cut_lineage(classes.join(tops.withColumnRenamed("node", "doc"), "doc", "left").withColumn("part", F.coalesce("root", "doc")).drop("root", "lead"))
    parts = classes.select("doc", "part")
    let_go(docs.sparkSession)
    late = pairs.select("a", "b").unionByName(_apart(lists, parts, percent)).unionByName(_open(common, parts, d, size, percent))
    late = _estimated(late.distinct(), classes, percent)
    second = cut_lineage(_confirmed(late, d, size, percent))
    let_go(docs.sparkSession)
    # members follow their class; only links between families need another pass (mostly few)
    member = full.join(classes.select("n", "h1", "h2", "part"), ["n", "h1", "h2"]).groupBy("doc").agg(F.collect_set("part").alias("parts"))
    member = cut_lineage(member.select("doc", F.array_min("parts").alias("part"), "parts"))
    shared = member.filter("size(parts) > 1").select(F.col("part").alias("a"), F.explode("parts").alias("b")).filter("a != b")
    linked = second.join(parts.select(F.col("doc").alias("a"), F.col("part").alias("pa")), "a").join(parts.select(F.col("doc").alias("b"), F.col("part").alias("pb")), "b")
    again = components(linked.select(F.col("pa").alias("a"), F.col("pb").alias("b")).unionByName(shared))
    top = member.join(again.withColumnRenamed("node", "part"), "part", "left").withColumn("component", F.coalesce("component", "part"))
    out = s.select("doc", "n").join(top.select("doc", "component"), "doc", "left")
    component = F.coalesce("component", "doc")
    real = lambda c: F.when(c != NO_ID, c)
    return out.select(
        real(F.col("doc")).alias("doc_id"), F.col("n").alias("n_shingles"), real(component).alias("component_id"),
        (component == F.col("doc")).alias("kept"),
    )
