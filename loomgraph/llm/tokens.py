"""Encoding of a corpus with a public byte-level BPE vocabulary: speculate and verify.

Texts are split by the vocabulary's pattern; each distinct word of a worker is encoded once.
*Speculate*: greedy longest match in a byte trie proposes tokens.  *Verify*: a proposal equals the BPE
result exactly if each adjacent pair of its tokens is compatible, i.e. BPE applied to the pair's bytes
would give the pair back; all distinct pairs are tested at once in NumPy by undoing merges on both sides
of the boundary.  Only words with a failing pair undergo exact merging.

Nothing is shuffled: the corpus is read, encoded in Arrow batches and returned.
"""

from __future__ import annotations

import base64
import json
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

VOCAB_DIR = "/opt/tokenizers"
#: The pattern that splits a text before the merges (a fixed value of the vocabulary).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Distinct words that a worker remembers; the memory starts anew beyond them; one slice of texts may hold more. Results don't depend on it.
REMEMBERED = 250_000
#: Characters handled at once inside a worker.
SLICE_CHARS = 1_000_000
_LOADED: dict[tuple[str, str], "SpeculativeBpe"] = {}


def load(name: str = "byte_bpe_50k", vocab_dir: str = VOCAB_DIR) -> "SpeculativeBpe":
    """The encoder of this worker, loaded once."""
    if (vocab_dir, name) not in _LOADED:
        _LOADED[vocab_dir, name] = SpeculativeBpe(vocab_dir, name)
    return _LOADED[vocab_dir, name]


class SpeculativeBpe:
    def __init__(self, vocab_dir: str, name: str):
        import regex
        import tiktoken

        with open(os.path.join(vocab_dir, f"{name}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        with open(os.path.join(vocab_dir, f"{name}.json"), encoding="utf-8") as f:
            model = json.load(f)["model"]
        self.split = regex.compile(PATTERN).findall
        self.exact = tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
        vocab = model["vocab"]
        n = len(ranks)
        # undoing a merge gives its two halves; a single byte gives itself
        self.left, self.right = np.arange(n, dtype=np.int64), np.arange(n, dtype=np.int64)
        keys = np.empty(len(model["merges"]), np.int64)
        values = np.empty(len(keys), np.int64)
        self.n = n
        for i, m in enumerate(model["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            t, a, b = vocab[a + b], vocab[a], vocab[b]
            keys[i], values[i] = a * n + b, t
            self.left[t], self.right[t] = a, b
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]
        # a token may be proposed only if BPE gives it for its own bytes
        whole = np.arange(n, dtype=np.int64)
        self.sound = (self.left == whole) | self._meet(self.left, self.right, whole)
        self._build_trie(ranks)
        self.forget()

    def _build_trie(self, ranks: dict[bytes, int]) -> None:
        self.step: dict[int, int] = {}
        ends = [-1]
        for word, t in ranks.items():
            node = 0
            for c in word:
                key = node << 8 | c
                node = self.step.get(key, 0)
                if not node:
                    ends.append(-1)
                    node = self.step[key] = len(ends) - 1
            ends[node] = t
        self.ends = ends

    def forget(self) -> None:
        self.code: dict[str, int] = {}
        self.ids = np.empty(1 << 16, np.int32)
        self.off = np.zeros(1 << 14, np.int64)

    def _merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The token that the pair merges to, or a large number."""
        key = a * self.n + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.values[at], 1 << 40)

    def _meet(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Whether a boundary between a and b stands until merge number ``limit``.

        Merges beside the boundary are undone from the latest to the earliest.  Before each, the tokens
        that touch must not have had an earlier merge across the boundary; of equal merges the left one
        comes first.
        """
        good = np.ones(len(a), bool)
        live = np.arange(len(a))
        a, b, limit = a.copy(), b.copy(), limit.copy()
        while len(live):
            crossed = self._merged(a, b) < limit
            good[live[crossed]] = False
            can_a, can_b = self.left[a] != a, self.left[b] != b
            take_a = can_a & (~can_b | (a > b))
            take_b = can_b & ~take_a
            limit = np.where(take_a, a, np.where(take_b, b + 1, limit))
            a, b = np.where(take_a, self.right[a], a), np.where(take_b, self.left[b], b)
            keep = ~crossed & (take_a | take_b)
            live, a, b, limit = live[keep], a[keep], b[keep], limit[keep]
        return good

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self._meet(a, b, np.full(len(a), 1 << 39, np.int64))

    def _propose(self, word: bytes) -> list[int]:
        step, ends, out, i, n = self.step.get, self.ends, [], 0, len(word)
        while i < n:
            node, j, best, end = 0, i, -1, i
            while j < n:
                node = step(node << 8 | word[j])
                if node is None:
                    break
                j += 1
                if ends[node] >= 0:
                    best, end = ends[node], j
            out.append(best)
            i = end
        return out

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Token ids of each word."""
        raw = [w.encode("utf-8", "replace") for w in words]
        out = [self._propose(w) for w in raw]
        size = np.fromiter(map(len, out), np.int64, len(out))
        flat = np.fromiter(chain.from_iterable(out), np.int64, int(size.sum()))
        owner = np.repeat(np.arange(len(out)), size)
        inside = owner[1:] == owner[:-1]
        pair, where = np.unique((flat[:-1] * self.n + flat[1:])[inside], return_inverse=True)
        fits = self.compatible(pair // self.n, pair % self.n)[where]
        failed = np.unique(np.concatenate([owner[:-1][inside][~fits], owner[~self.sound[flat]]]))
        for i in failed.tolist():
            out[i] = self.exact(raw[i])
        self.failed = len(failed)
        return out

    def _learn(self, words: list[str]) -> None:
        got = self.encode_words(words)
        first = len(self.code)
        self.code.update(zip(words, range(first, first + len(words))))
        size = np.fromiter(map(len, got), np.int64, len(got))
        used, total = int(self.off[first]), int(size.sum())
        while used + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        while first + len(words) + 1 > len(self.off):
            self.off = np.concatenate([self.off, np.zeros_like(self.off)])
        self.ids[used : used + total] = np.fromiter(chain.from_iterable(got), np.int32, total)
        self.off[first + 1 : first + 1 + len(words)] = used + np.cumsum(size)

    def codes(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Codes of all words of the texts, and the number of words of each text."""
        split = [self.split(t) for t in texts]
        words = list(chain.from_iterable(split))
        got = list(map(self.code.get, words))
        if None in got:
            new = list(dict.fromkeys(w for w, c in zip(words, got) if c is None))
            if self.code and len(self.code) + len(new) > REMEMBERED:  # begun anew: at most once, then all words of the texts, whatever their number
                self.forget()
                new = list(dict.fromkeys(words))
            self._learn(new)
            got = list(map(self.code.get, words))
        return np.array(got, np.int64), np.fromiter(map(len, split), np.int64, len(split))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row, and the number of ids of each text."""
        codes, words = self.codes(texts)
        start, size = self.off[codes], self.off[codes + 1] - self.off[codes]
        total = int(size.sum())
        at = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(total)
        return self.ids[at], _per_text(size, words)

    def count(self, texts: list[str]) -> np.ndarray:
        codes, words = self.codes(texts)
        return _per_text(self.off[codes + 1] - self.off[codes], words)


def _per_text(size: np.ndarray, words: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(size)])
    end = np.cumsum(words)
    return total[end] - total[end - words]


def _slices(texts: list[str | None]) -> Iterator[list[str]]:
    """The texts in order, null as empty, in slices of bounded size."""
    part, chars = [], 0
    for t in texts:
        part.append(t or "")
        chars += len(part[-1])
        if chars >= SLICE_CHARS:
            yield part
            part, chars = [], 0
    if part:
        yield part


def encode_corpus(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = "byte_bpe_50k", vocab_dir: str = VOCAB_DIR) -> DataFrame:
    """``id_col, ids array<int>``: the ids of each text, without special tokens.

    An empty and a null text give an empty list; strings of special tokens are ordinary text.  One row
    per input row, repeated rows included; a null id is kept; an empty table gives no rows; other
    columns play no part.  Texts of any length are encoded whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(tokenizer, vocab_dir)
        for batch in batches:
            at = 0
            for part in _slices(batch.column(1).to_pylist()):
                ids, sizes = bpe.encode(part)
                offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(part)), pa.ListArray.from_arrays(offsets, pa.array(ids))], [id_col, "ids"])
                at += len(part)

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>")


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = "byte_bpe_50k", vocab_dir: str = VOCAB_DIR) -> DataFrame:
    """``id_col, n_tokens``: the length of what :func:`encode_corpus` gives; null and empty texts have 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(tokenizer, vocab_dir)
        for batch in batches:
            sizes = [bpe.count(part) for part in _slices(batch.column(1).to_pylist())]
            total = np.concatenate(sizes).astype(np.int64) if sizes else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(total)], [id_col, "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, n_tokens bigint")
