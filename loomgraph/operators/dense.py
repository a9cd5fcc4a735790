"""Exact similarity search: blocks of queries against all vectors as matrix products in Arrow batches.

For rankings, vectors are written in the order of their units, and each task answers its own queries over all of them
(:mod:`loomgraph.operators.blocks`); scores exist in tiles of bounded size, and a task keeps the best k of each of its queries.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from loomgraph.operators.blocks import Rows, Searched
from loomgraph.operators.lexical import best_again, ranked, wanted_of
from loomgraph.operators.ranking import TILE
from loomgraph.workspace import Workspace

#: Elements of a query block, at most; more queries are answered block after block.
BLOCK_ELEMENTS = 16_000_000

#: An encoder turns texts into vectors; models are given by the caller.
Encoder = Callable[[list[str]], np.ndarray]


def _matrix(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Valid rows as doubles, and their places."""
    size = np.asarray(column.value_lengths().fill_null(-1))
    at = np.flatnonzero(size == dim)
    flat = column.take(pa.array(at)).flatten().cast(pa.float64()).fill_null(np.nan)
    x = np.asarray(flat).reshape(-1, dim)
    good = np.isfinite(x).all(axis=1)
    return x[good], at[good]


def _blocks(queries: DataFrame, query: str, query_embedding: str, cosine: bool, block: int) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """Width, names and vectors of the valid queries, in blocks of bounded size: a stated query set against all rows."""
    dim = queries.select(F.max(F.size(query_embedding))).first()[0] or 0
    if dim <= 0:
        return
    parts = -(-queries.count() // max(1, block // dim))
    for i in range(parts):
        part = queries.select(query, query_embedding)
        table = (part if parts == 1 else part.where(F.pmod(F.xxhash64(query), F.lit(parts)) == i)).toArrow()
        q, at = _matrix(table.column(1).combine_chunks(), dim)
        names = table.column(0).combine_chunks().take(pa.array(at))
        if cosine and len(q):
            size = np.linalg.norm(q, axis=1)
            names, q = names.filter(pa.array(size > 0)), q[size > 0] / size[size > 0, None]
        yield dim, names, q


def _tiles(batches: Iterator[pa.RecordBatch], column: int, dim: int, width: int, cosine: bool) -> Iterator[tuple[pa.RecordBatch, np.ndarray, pa.Array]]:
    """Parts of the batches with their valid vectors and these vectors' rows, so small that scores against ``width`` queries fit a tile."""
    rows = max(1, TILE // max(1, width))
    for whole in batches:
        for a in range(0, whole.num_rows, rows):
            batch = whole.slice(a, rows)
            x, at = _matrix(batch.column(column), dim)
            if cosine and len(x):
                size = np.linalg.norm(x, axis=1)
                x, at = x[size > 0] / size[size > 0, None], at[size > 0]
            if len(x):
                yield batch, x, pa.array(at)


def similarities(vectors: DataFrame, id_col: str, embedding: str, queries: DataFrame, query: str, query_embedding: str, cosine: bool = False, block: int = BLOCK_ELEMENTS) -> DataFrame:
    """``query, doc, score``: dot products (or cosines) of all pairs, for full rankings.

    Vectors that are null, of another length than the queries', or not finite take no part, nor do such
    queries; cosine leaves out zero vectors.
    """
    spark = vectors.sparkSession
    q_type, d_type = queries.schema[query].dataType.simpleString(), vectors.schema[id_col].dataType.simpleString()
    schema = f"query {q_type}, doc {d_type}, score double"
    out = spark.createDataFrame([], schema)
    for dim, names, q in _blocks(queries, query, query_embedding, cosine, block):
        shared = spark.sparkContext.broadcast((names, q))

        def run(batches: Iterator[pa.RecordBatch], shared=shared, dim=dim) -> Iterator[pa.RecordBatch]:
            names, q = shared.value
            for batch, x, at in _tiles(batches, 1, dim, len(q), cosine):
                if len(q):
                    s = q @ x.T
                    i, j = np.divmod(np.arange(s.size), s.shape[1])
                    yield pa.RecordBatch.from_arrays([names.take(pa.array(i)), batch.column(0).take(at).take(pa.array(j)), pa.array(s.ravel())], ["query", "doc", "score"])

        out = out.unionByName(vectors.select(id_col, embedding).mapInArrow(run, schema))
    return out


@dataclass
class _Queries:
    names: pa.Array
    vectors: np.ndarray
    #: First vector of each query; a query may have several.
    start: np.ndarray
    wanted: pa.Array | None = None
    ends: np.ndarray | None = None


@dataclass
class _Scorer:
    dim: int
    cosine: bool

    def _vectors(self, rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        x, at = _matrix(rows.column("embedding").combine_chunks(), self.dim)
        if self.cosine and len(x):
            size = np.linalg.norm(x, axis=1)
            x, at = x[size > 0] / size[size > 0, None], at[size > 0]
        return x, at

    def queries(self, rows: pa.Table) -> _Queries:
        x, at = self._vectors(rows)
        rows = rows.take(pa.array(at))
        names = rows.column("query").combine_chunks()
        code = np.asarray(names.dictionary_encode("encode").indices)
        start = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else np.empty(0, np.int64)
        first = pa.array(start)
        return _Queries(names.take(first), x, np.append(start, len(code)), *wanted_of(rows.take(first)))

    def prepare(self, rows: pa.Table) -> tuple[np.ndarray, pa.Table]:
        x, at = self._vectors(rows)
        return x, rows.select(["doc", "unit"]).take(pa.array(at))

    def score(self, tile: np.ndarray, queries: _Queries, a: int, b: int) -> np.ndarray:
        at = queries.start[a : b + 1]
        s = queries.vectors[at[0] : at[-1]] @ tile.T
        s[~np.isfinite(s)] = -np.inf
        return s if len(s) == b - a else np.maximum.reduceat(s, at[:-1] - at[0], axis=0)


class Dense:
    """Queries against vectors, prepared once: both are written, vectors in the order of their units."""

    def __init__(self, vectors: DataFrame, id_col: str, embedding: str, queries: DataFrame, query: str, query_embedding: str, unit: str | None = None, digits: int = 9, cosine: bool = False, block: int = BLOCK_ELEMENTS):
        ws, self.digits = Workspace(vectors.sparkSession, "dense"), digits
        kinds = tuple(df.schema[c].dataType.simpleString() for df, c in ((queries, query), (vectors, id_col), (vectors, unit or id_col)))
        asked = ws.write(queries.select(F.col(query).alias("query"), F.col(query_embedding).alias("embedding")), "asked")
        n, dim = asked.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("embedding")), F.lit(0))).first()
        dim = max(dim, 1)
        rows = Rows(vectors.select(F.col(id_col).alias("doc"), F.col(unit or id_col).alias("unit"), F.col(embedding).alias("embedding")).where(F.size("embedding") == dim), ws)
        self.searched = Searched(rows, asked, n, _Scorer(dim, cosine), kinds, digits, False, TILE, max(1, block // dim))

    def top(self, k: int | None) -> DataFrame:
        """See :func:`top`."""
        return self.searched.ranking() if k is None else ranked(best_again(self.searched.top(k), self.digits), k, self.digits)

    def ranks(self, wanted: DataFrame) -> DataFrame:
        """See :meth:`loomgraph.operators.lexical.Bm25.ranks`."""
        return self.searched.ranks(wanted)


def top(vectors: DataFrame, id_col: str, embedding: str, queries: DataFrame, query: str, query_embedding: str, k: int | None, unit: str | None = None, digits: int = 9, cosine: bool = False, block: int = BLOCK_ELEMENTS) -> DataFrame:
    """``query, doc, unit, score, rank`` of the best ``k`` vectors, or of the best vectors of the best ``k`` units, of each query; None ranks all.

    Order: highest score to ``digits`` digits, then smallest unit; of a unit the best vector, then the smallest id.  What takes part is as in
    :func:`similarities`.  Each task keeps the best k of its queries while tiles of bounded size pass by.
    """
    return Dense(vectors, id_col, embedding, queries, query, query_embedding, unit, digits, cosine, block).top(k)


def pooled(output: np.ndarray, rows: int) -> np.ndarray:
    """One vector per text of a model's output: the first token's of a sequence output, else as it is."""
    x = output[:, 0] if output.ndim == 3 else output
    if x.ndim != 2 or len(x) != rows:
        raise ValueError(f"{rows} texts gave an output of shape {output.shape}")
    return x


def model_conflicts(manifests: dict[str, dict], fields: list[str]) -> list[str]:
    """Fields in which the models of bundles that are to be searched together differ."""
    return [f for f in fields if len({repr(m.get(f)) for m in manifests.values()}) > 1]


def encode(df: DataFrame, id_col: str, text: str, make: Callable[[], Encoder], counter: Callable[[], Callable[[str], int]] | None = None, most_tokens: int = 512) -> DataFrame:
    """``id_col, embedding``: unit vectors of texts by an encoder that each worker makes once.

    With a ``counter``, a text of more than ``most_tokens`` tokens is an error: nothing is cut off silently.
    """
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, count = make(), counter() if counter else None
        for batch in batches:
            if not batch.num_rows:
                continue
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if count else ():
                if count(t or "") > most_tokens:
                    raise ValueError(f"text {i!r} has more than {most_tokens} tokens")
            x = pooled(np.asarray(encoder([t or "" for t in batch.column(1).to_pylist()]), np.float32), batch.num_rows)
            size = np.linalg.norm(x, axis=1, keepdims=True)
            if not (np.isfinite(x).all() and (size > 0).all()):
                raise ValueError("the encoder gave a zero or non-finite vector")
            x = x / size
            offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, pa.array(x.ravel()))], [id_col, "embedding"])

    return df.select(id_col, text).mapInArrow(run, f"{id_col} {kind}, embedding array<float>")
