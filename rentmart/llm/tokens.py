"""Token ids of whole texts by the ``tokenizers`` library, memoised by chunk.

A byte-level BPE never merges across the boundaries of its pre-tokeniser. Texts are cut only where one lies for sure:
before a white-space byte that follows a visible character, before a comma, full stop or the like that follows an
ASCII letter, and behind a lone line feed. Each distinct chunk is cut into pre-tokens and encoded by the library's BPE
model once; the ids of a text are those of its chunks in order: the ids of the whole text in one library call
(tests hold both against each other). The library takes an added token of the vocabulary (``<|endoftext|>``) out of a
text before it cuts pre-tokens; a text that holds the string of one is encoded by the library whole. Vocabularies of
other kinds are encoded text by text.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa

from rentmart.llm.textarrays import IS_SPACE, flat, span_hash, spread

#: chunks (about 30 bytes each) and pre-tokens kept at most by a worker; beyond it a memo starts anew
MEMO_CHUNKS, MEMO_TOKENS = 400_000, 100_000
#: the pre-tokeniser's own split of a byte-level BPE (fixed value)
_PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_VISIBLE = np.zeros(256, bool)
_VISIBLE[0x21:0x7F] = True
_VISIBLE[0x80:] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ",.;:!?"]] = True


def _byte_alphabet() -> dict[int, str]:
    """The printable stand-in of each byte in a byte-level vocabulary: itself if printable, else 256 and up."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return {b: chr(b if b in plain else next(rest)) for b in range(256)}


def _chunk_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    cut = np.zeros(len(data), bool)
    before, here = data[:-1], data[1:]
    seen = _VISIBLE[before]
    # behind a character of several bytes that may be a wide blank, nothing is cut
    seen[1:] &= ~((data[:-2] == 0xC2) & ((before[1:] == 0x85) | (before[1:] == 0xA0)))
    seen[2:] &= ~((data[:-3] >= 0xE1) & (data[:-3] <= 0xE3))
    cut[1:] = IS_SPACE[here] & seen
    cut[1:] |= _STOP[here] & _LETTER[before]
    cut[2:] |= _LETTER[data[2:]] & (data[1:-1] == 10) & cut[1:-1]
    cut[offsets[:-1][offsets[:-1] < len(data)]] = True
    return np.flatnonzero(cut)


class Encoder:
    """``encode(column)``: flat 16-bit ids of all texts of a string column, and the number of ids of each text."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        if self.lib.get_vocab_size() > 65_536:
            raise ValueError("ids of this vocabulary do not fit 16 bits")
        spec = json.loads(self.lib.to_str())
        pre = spec.get("pre_tokenizer") or {}
        self.plain = (
            pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
            and not spec.get("normalizer") and spec["model"]["type"] == "BPE"
        )
        self.added = [t["content"].encode() for t in spec.get("added_tokens") or []]
        self.model, self.split = self.lib.model, regex.compile(_PRE_TOKEN).findall
        self.alphabet = str.maketrans({chr(b): c for b, c in _byte_alphabet().items()})
        self.tokens: dict[str, bytes] = {}
        self._forget()

    def _forget(self) -> None:
        self.keys, self.bytes_ = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.at, self.n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint16)

    def _pre_token(self, piece: str) -> bytes:
        ids = self.tokens.get(piece)
        if ids is None:
            mapped = piece.encode().decode("latin-1").translate(self.alphabet)
            ids = np.array([t.id for t in self.model.tokenize(mapped)], dtype="<u2").tobytes()
            if len(self.tokens) >= MEMO_TOKENS:
                self.tokens = {}
            if len(piece) <= 64:
                self.tokens[piece] = ids
        return ids

    def _learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, keys: np.ndarray) -> None:
        raw = data.tobytes()
        ids = [b"".join(map(self._pre_token, self.split(raw[s:e].decode()))) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
        n = np.array([len(x) // 2 for x in ids], np.int64)
        at = np.cumsum(n) - n + len(self.pool)
        self.pool = np.concatenate([self.pool, np.frombuffer(b"".join(ids), "<u2")])
        order = np.argsort(all_keys := np.concatenate([self.keys, keys]), kind="stable")
        self.keys = all_keys[order]
        for name, new in (("bytes_", ends - starts), ("at", at), ("n", n)):
            setattr(self, name, np.concatenate([getattr(self, name), new])[order])

    def _find(self, keys: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return at, (self.keys[at] == keys) & (self.bytes_[at] == sizes)

    def _by_library(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.lib.encode_batch([x or "" for x in texts], add_special_tokens=False)]
        return np.array([i for f in found for i in f], np.uint16), np.array([len(f) for f in found], np.int64)

    def _with_added(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The numbers of the texts that hold the string of an added token."""
        raw, found = data.tobytes(), set()
        for token in self.added:
            at = raw.find(token)
            while at >= 0:
                text = int(np.searchsorted(offsets, at, "right")) - 1
                inside = at + len(token) <= offsets[text + 1]
                if inside:
                    found.add(text)
                at = raw.find(token, int(offsets[text + 1]) if inside else at + 1)
        return np.array(sorted(found), np.int64)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not self.plain:
            return self._by_library(column.to_pylist())
        data, offsets = flat(column)
        whole = self._with_added(data, offsets)
        if not len(whole):
            return self._by_chunks(data, offsets)
        own = np.zeros(len(column), bool)
        own[whole] = True
        ids, n = self._by_chunks(*flat(column.filter(pa.array(~own))))
        more, m = self._by_library(column.take(pa.array(whole)).to_pylist())
        sizes = np.zeros(len(column), np.int64)
        sizes[~own], sizes[own] = n, m
        out, there = np.empty(len(ids) + len(more), np.uint16), np.repeat(own, sizes)
        out[~there], out[there] = ids, more
        return out, sizes

    def _by_chunks(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(data):
            return np.zeros(0, np.uint16), np.zeros(len(offsets) - 1, np.int64)
        starts = _chunk_starts(data, offsets)
        ends = np.append(starts[1:], len(data))
        keys, first, which = np.unique(span_hash(data, starts, ends), return_index=True, return_inverse=True)
        sizes = (ends - starts)[first]
        at, known = self._find(keys, sizes)
        if not known.all():
            if len(self.keys) + np.count_nonzero(~known) > MEMO_CHUNKS:
                self._forget()
                known[:] = False
            new = ~known
            self._learn(data, starts[first[new]], ends[first[new]], keys[new])
            at, known = self._find(keys, sizes)
            if not known.all():
                raise ValueError("two chunks of a text have one hash")
        n = self.n[at][which]
        owner, inside = spread(n)
        ids = self.pool[self.at[at][which][owner] + inside]
        total = np.concatenate([[0], np.cumsum(n)])
        return ids, np.diff(total[np.searchsorted(starts, offsets)])


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker process and vocabulary file."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Encoder(path)
