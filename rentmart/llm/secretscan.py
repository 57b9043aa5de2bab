"""Secret scans: keyed patterns, and the Shannon entropy of sliding windows per character class.

Three kinds have a fixed form: ``assign`` (a name such as password, a sign and a value), ``access`` (access key ids) and
``hex`` (long lower-case hex strings). The kind ``entropy`` needs no form: every run of one character class that is as
long as the class's window is a candidate, the window slides over it, and its entropy follows from the counts of its
characters, of which a step changes two. Windows that reach the class's bits are joined where they overlap. An allow
list then suppresses what is no secret: words and identifiers, sequences, placeholders, UUIDs, labelled checksums and
the paths of URLs; further patterns can be given. It never suppresses a span of the three fixed kinds.

Texts are scanned where they are read, in one pass and without a shuffle; rows are independent of each other.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentmart.llm.common import pick, schema_of, small_batches
from rentmart.llm.textarrays import slices

# The three kinds of the contract and the least length of what they find.
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 6, 20, 24

#: all kinds, in the order of spans with one start
KINDS = ("assign", "access", "hex", "entropy")
SPANS = "spans array<struct<kind: string, start: bigint, end: bigint, bits: double>>"
#: a text without any of these has no match of ASSIGN
_NAMES = (b"passw", b"secret", b"token", b"api")
#: fractions of a bit: counts are summed as whole numbers, so a window far into a run has no rounding error
_SCALE = 1 << 24


def _members(pattern: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[i for i in range(256) if re.fullmatch(b"[" + pattern + b"]", bytes([i]))]] = True
    return out


@dataclass(frozen=True)
class CharacterClass:
    """Characters that one encoding uses, the length of its window, and the entropy that makes a window a find."""

    characters: bytes
    window: int
    bits: float


#: 20 random characters have about 3.4 bits in the hex classes and 4.1 in the last one, prose 3.7 at most
CLASSES = (CharacterClass(b"0-9a-f", 20, 3.0), CharacterClass(b"0-9A-F", 20, 3.0), CharacterClass(b"A-Za-z0-9+/_=-", 20, 3.75))

_PLACEHOLDER = re.compile(rb"example|sample|dummy|placeholder|changeme|redacted|x{4}|0{8}", re.IGNORECASE)
_UUID = re.compile(rb"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
_LABEL = rb"(md5|sha-?(1|224|256|384|512)|crc32|checksum|digest|integrity|commit|fingerprint)"
_CHECKSUM = re.compile(_LABEL + rb"[^A-Za-z0-9]{0,4}\Z", re.IGNORECASE), re.compile(rb"\A" + _LABEL + rb"[=-]", re.IGNORECASE)
_PIECE = re.compile(rb"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
#: bytes before a candidate that its context is read from
_BEFORE = 256
_BASE64 = _members(CLASSES[-1].characters)


def runs(member: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Maximal runs of at least ``least`` true values."""
    edges = np.flatnonzero(np.diff(member, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= least
    return list(zip(starts[long].tolist(), ends[long].tolist(), strict=True))


def rich_windows(run: bytes, window: int, bits: float) -> list[tuple[int, int, float]]:
    """(start, end, highest entropy) of the joined windows of ``run`` whose entropy is ``bits`` or more.

    With counts c of the characters in a window of w, its entropy is log2(w) - sum(c * log2(c)) / w. A step takes one
    character out and one in, so the sum changes in two terms.
    """
    weight = [0] + [round(c * math.log2(c) * _SCALE) for c in range(1, window + 1)]
    highest = round(window * (math.log2(window) - bits) * _SCALE)
    counts, total, out = [0] * 256, 0, []
    for i, x in enumerate(run):
        total += weight[counts[x] + 1] - weight[counts[x]]
        counts[x] += 1
        if i >= window - 1:
            if total <= highest:
                start, entropy = i - window + 1, math.log2(window) - total / _SCALE / window
                if out and start <= out[-1][1]:
                    out[-1] = (out[-1][0], i + 1, max(out[-1][2], entropy))
                else:
                    out.append((start, i + 1, entropy))
            first = run[i - window + 1]
            total += weight[counts[first] - 1] - weight[counts[first]]
            counts[first] -= 1
    return out


def harmless(text: bytes, start: int, end: int, allow: tuple[re.Pattern, ...] = ()) -> bool:
    """Whether the allow list takes the find ``text[start:end]`` for no secret, by itself and by what surrounds it."""
    find = text[start:end]
    left, right = start, end
    while left > max(0, start - _BEFORE) and _BASE64[text[left - 1]]:
        left -= 1
    while right < min(len(text), end + _BEFORE) and _BASE64[text[right]]:
        right += 1
    whole, before = text[left:right], text[max(0, left - _BEFORE) : left]
    if _PLACEHOLDER.search(whole) or _UUID.fullmatch(whole):
        return True
    if _CHECKSUM[0].search(before[-24:]) or _CHECKSUM[1].search(whole):
        return True
    if b"://" in re.split(rb"[\x20\x09-\x0D\"'<>]", before + whole)[-1] and b"=" not in whole:
        return True
    steps = sum(b - a == 1 for a, b in zip(find, find[1:], strict=False))
    if 2 * steps >= len(find) - 1:
        return True
    pieces = _PIECE.findall(find)
    letters = sum(not p.isdigit() for p in pieces)
    # digits alone; words and identifiers: long pieces of one case, where an encoding changes every character or two
    if not letters or sum(map(len, pieces)) >= 3 * len(pieces):
        return True
    return any(p.search(whole) for p in allow)


def find_spans(text: bytes, allow: tuple[re.Pattern, ...] = ()) -> list[tuple[str, int, int, float | None]]:
    """All spans of one UTF-8 text as (kind, start, end, bits), in code points, by start, kind and end."""
    found: list[tuple[str, int, int, float | None]] = []
    if not text:
        return found
    low = text.lower()
    if any(name in low for name in _NAMES):
        found += [("assign", *m.span(), None) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    if b"AKIA" in text:
        found += [("access", *m.span(), None) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    data = np.frombuffer(text, np.uint8)
    found += [("hex", s, e, None) for s, e in runs(_HEX[data], LEAST_HEX)]
    rich: list[tuple[int, int, float]] = []
    # every class is part of the last one: its runs hold all candidates
    for start, end in runs(_BASE64[data], min(c.window for c in CLASSES)):
        for c, member in zip(CLASSES, _MEMBERS, strict=True):
            for s, e in runs(member[data[start:end]], c.window):
                for a, b, bits in rich_windows(text[start + s : start + e], c.window, c.bits):
                    if not harmless(text, start + s + a, start + s + b, allow):
                        rich.append((start + s + a, start + s + b, bits))
    joined: list[list] = []
    for a, b, bits in sorted(rich):  # the finds of several classes
        if joined and a <= joined[-1][1]:
            joined[-1][1:] = max(b, joined[-1][1]), max(bits, joined[-1][2])
        else:
            joined.append([a, b, bits])
    found += [("entropy", a, b, bits) for a, b, bits in joined]
    if found and not text.isascii():
        points = np.unique([p for f in found for p in f[1:3]])
        # code points before each place: bytes that continue none
        parts = np.split(data, points)[:-1]
        before = dict(zip(points.tolist(), np.cumsum([np.count_nonzero(p & 0xC0 != 0x80) for p in parts]).tolist(), strict=True))
        found = [(k, before[a], before[b], bits) for k, a, b, bits in found]
    return sorted(found, key=lambda f: (f[1], KINDS.index(f[0]), f[2]))


_MEMBERS = tuple(_members(c.characters) for c in CLASSES)
_HEX = _MEMBERS[0]


def scan(docs: DataFrame, allow: tuple[str, ...] = ()) -> DataFrame:
    """All columns of ``docs`` and ``spans``: kind, start, end (code points, end exclusive) and, for entropy, its bits.

    ``allow`` are further patterns (of bytes in UTF-8) that suppress a find by entropy when they occur in the string
    around it. A null or empty text has no spans. Every row is scanned by itself: repeated rows and null ids
    stay as they are, an empty table gives an empty one. A column named spans is replaced.
    """
    small_batches(docs.sparkSession)
    cols = [c for c in docs.columns if c != "spans"]
    others = F.struct(F.lit(True).alias("_"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(cols) if c != "text"])
    d = docs.select(others.alias("_row"), "text")
    patterns = tuple(allow)
    listed = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("bits", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extra = tuple(re.compile(p.encode()) for p in patterns)
        for batch in batches:
            for part in slices(batch, "text"):
                got = []
                for t in part.column("text"):
                    spans = find_spans(t.as_buffer().to_pybytes(), extra) if t.is_valid else []
                    got.append([{"kind": k, "start": a, "end": b, "bits": bits} for k, a, b, bits in spans])
                yield pa.RecordBatch.from_pydict({"_row": part.column("_row"), "text": part.column("text"), "spans": pa.array(got, listed)})

    out = d.mapInArrow(run, schema_of(d, SPANS))
    return out.select(*[F.col("text") if c == "text" else F.col(f"_row.c{i}").alias(c) for i, c in enumerate(cols)], "spans")


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _count(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def span_digests(scanned: DataFrame) -> DataFrame:
    """doc_id, counts of the fixed kinds, the hash of their list, and the list of all spans."""
    fixed = F.filter("spans", lambda s: s["kind"] != "entropy")
    return scanned.select("doc_id", *map(_count, KINDS[:3]), F.sha2(_listed(fixed), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))


def secrets(docs: DataFrame) -> DataFrame:
    """``span_digests`` of the scan of doc_id and text alone."""
    return span_digests(pick(scan(pick(docs, "doc_id", "text")), "doc_id", "spans"))
