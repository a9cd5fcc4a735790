"""The best of many scored groups, kept while blocks of scores pass by.

A block is a matrix of scores with a row per document and a column per query, and the documents' names and groups.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Scores that are held at once, in numbers.
TILE = 2_000_000
_NULL = "\x00"


class Best:
    """The best ``k`` groups of each query: highest rounded score first, then smallest group; of a group the best member, then the smallest.

    Blocks of scores may come in any order and may hold parts of a group: a group among the best of all is among the best of the
    blocks that hold its best member, so nothing else needs to be kept.  With ``k`` None every group stays, for full rankings; such
    a holder is to be emptied block after block.
    """

    def __init__(self, k: int | None, digits: int, positive: bool):
        self.k, self.digits, self.positive = k, digits, positive
        self.query, self.score = np.empty(0, np.int64), np.empty(0)
        self.doc, self.unit = np.empty(0, object), np.empty(0, object)

    def add(self, score: np.ndarray, doc: pa.Array, unit: pa.Array) -> None:
        """``score`` has a row per document and a column per query."""
        if not score.size:
            return
        docs, units = (objects(c) for c in (doc, unit))
        d, u = (np.unique(c, return_inverse=True)[1] for c in (docs, units))
        order = np.lexsort((d, u))
        raw, docs, units = score[order], docs[order], units[order]
        s = np.round(raw, self.digits)
        u = u[order]
        edge = np.flatnonzero(np.concatenate([[True], u[1:] != u[:-1]]))
        top = np.maximum.reduceat(s, edge, axis=0)
        n = len(edge)
        bar = np.partition(top, n - self.k, axis=0)[n - self.k] if self.k and n > self.k else np.full(top.shape[1], -np.inf)
        good = (top >= bar) & ((top > 0) if self.positive else np.isfinite(top))
        g, q = np.nonzero(good)
        # the first row of the group that has its best score
        of = np.repeat(np.arange(n), np.diff(np.append(edge, len(u))))
        row = np.minimum.reduceat(np.where(s == top[of], np.arange(len(u))[:, None], len(u)), edge, axis=0)[g, q]
        self.query, self.score = np.concatenate([self.query, q]), np.concatenate([self.score, raw[row, q]])
        self.doc, self.unit = np.concatenate([self.doc, docs[row]]), np.concatenate([self.unit, units[row]])
        if self.k:
            self._cut()

    def _cut(self) -> None:
        d, u = (np.unique(c, return_inverse=True)[1] for c in (self.doc, self.unit))
        s = -np.round(self.score, self.digits)
        order = np.lexsort((d, s, u, self.query))
        q, u = self.query[order], u[order]
        order = order[np.concatenate([[True], (q[1:] != q[:-1]) | (u[1:] != u[:-1])])] if len(order) else order
        u = np.unique(self.unit[order], return_inverse=True)[1]
        order = order[np.lexsort((u, s[order], self.query[order]))]
        q = self.query[order]
        first = np.searchsorted(q, q)
        order = order[np.arange(len(q)) - first < self.k]
        self.query, self.score, self.doc, self.unit = self.query[order], self.score[order], self.doc[order], self.unit[order]

    def batch(self, queries: pa.Array, doc: pa.DataType, unit: pa.DataType) -> pa.RecordBatch:
        held = lambda c, t: pa.array([None if x == _NULL else x for x in c.tolist()], t)
        return pa.RecordBatch.from_arrays([queries.take(pa.array(self.query)), held(self.doc, doc), held(self.unit, unit), pa.array(self.score)], ["query", "doc", "unit", "score"])


def objects(column: pa.Array) -> np.ndarray:
    """Names as objects; null becomes a name that sorts before all others."""
    out = np.empty(len(column), object)
    out[:] = [_NULL if x is None else x for x in column.to_pylist()]
    return out
