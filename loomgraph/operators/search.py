"""Search over chunks: filters first, then a method, best chunk per unit, top k complete units."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from loomgraph.functions.text import is_blank, tokens
from loomgraph.operators import dense as D, fusion, lexical as L
from loomgraph.operators.current import IntegrityError, assert_empty, collection, shared_keys
from loomgraph.workspace import Workspace

METHODS = ("lexical", "dense", "hybrid")


class QueryInputError(ValueError):
    """A request that can't be answered as it stands."""


def filter_chunks(chunks: DataFrame, source: str | None = None, subject: str | None = None, node_id: str | None = None) -> DataFrame:
    """Chunks of a source, subject root and unit; an unknown or blank source or subject is an error, an unknown unit gives none."""
    out = chunks
    for column, value in (("source_id", source), ("subject_root", subject)):
        if value is not None:
            if not value.strip():
                raise QueryInputError(f"a blank value can't select by {column}")
            if not chunks.where(F.col(column) == value).limit(1).count():
                raise QueryInputError(f"no chunk has {column} {value!r}")
            out = out.where(F.col(column) == value)
    return out if node_id is None else out.where(F.col("knowledge_unit_id") == node_id)


def exact_lookup(chunks: DataFrame, nodes: DataFrame, node: str = "node_id") -> DataFrame:
    """``node_id, chunk_id, score, method``: the smallest chunk of each asked unit; unknown ids give no row."""
    first = chunks.groupBy(F.col("knowledge_unit_id").alias(node)).agg(F.min("chunk_id").alias("chunk_id"))
    return nodes.select(node).distinct().join(first, node).select(node, "chunk_id", F.lit(1.0).alias("score"), F.lit("exact-node-id").alias("method"))


def check_queries(queries: DataFrame, tokens_needed: bool = True, query: str = "query", text: str = "text") -> None:
    """Raise on the first query of a batch that can't be answered: null or repeated id, null or blank text, a NUL, no token.

    A batch is checked in one pass over its texts, before anything is searched.
    """
    said = F.col(text)
    fault = (
        F.when(F.col(query).isNull(), "a query without an id").when(is_blank(said), "a blank query text").when(F.instr(said, "\x00") > 0, "a query text with NUL")
        .when(F.lit(tokens_needed) & (F.size(tokens(said)) == 0), "a query text without tokens").when(F.col("_n") > 1, "a query id given twice")
    )
    counted = queries.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(query)))
    first = counted.select(F.col(query).cast("string").alias("id"), fault.alias("fault")).where("fault is not null").orderBy("id", "fault").limit(1).collect()
    if first:
        raise QueryInputError(f"{first[0]['fault']}: {first[0]['id']}")


def check_request(query: object, node_id: object, method: str, limit: int) -> None:
    """Raise on the first thing that makes a request meaningless."""
    blank = query is None or (isinstance(query, str) and not query.strip())
    faults = {
        f"method is one of {', '.join(METHODS)}": method in METHODS,
        "at least one result has to be asked for": limit > 0,
        "a query is text without NUL": query is None or (isinstance(query, str) and "\x00" not in query),
        "a node id is text that isn't blank": node_id is None or (isinstance(node_id, str) and bool(node_id.strip())),
        "a request names a query, a node or both": not blank or node_id is not None,
    }
    for demand, met in faults.items():
        if not met:
            raise QueryInputError(demand)


@dataclass
class Searcher:
    """Batch search over one bundle or collection.

    ``chunks`` has chunk_id, knowledge_unit_id, search_text, source_id and subject_root; ``vectors`` has
    chunk_id and embedding; ``queries`` passed to a method have query, text and, for dense, embedding.  A ``bundle_id`` of the
    chunks comes out with the results.
    """

    chunks: DataFrame
    vectors: DataFrame | None = None
    #: Refuse a batch that holds a query without an id, a text or a token; else such queries find nothing.
    strict: bool = False

    @classmethod
    def over(cls, bundles: dict[str, DataFrame], vectors: dict[str, DataFrame] | None = None, models: dict[str, dict] | None = None, fields: tuple[str, ...] = ()) -> Searcher:
        """A collection: all bundles under one set of statistics.

        Bundles that share a chunk or a unit, or whose models differ in one of ``fields``, can't be searched together.
        """
        every = collection(bundles, "chunk_id")
        assert_empty(shared_keys(every, "chunk_id"), "chunks in several bundles")
        assert_empty(shared_keys(every, "knowledge_unit_id"), "units in several bundles")
        unlike = D.model_conflicts(models or {}, list(fields))
        if unlike:
            raise IntegrityError(f"models differ in {', '.join(unlike)}")
        return cls(every, None if vectors is None else collection(vectors, "chunk_id"))

    def lexical(self, queries: DataFrame) -> DataFrame:
        """Every unit with a positive score, ranked."""
        return L.bm25_top(self.chunks, "chunk_id", "search_text", queries, "query", "text", None, "knowledge_unit_id")

    def lexical_ranks(self, queries: DataFrame) -> DataFrame:
        """``query, unit, rank`` of every unit with a positive score."""
        return L.Bm25(self.chunks, "chunk_id", "search_text", queries, "query", "text", "knowledge_unit_id").unit_ranks()

    def dense(self, queries: DataFrame) -> DataFrame:
        """Every unit with a vector, ranked."""
        return D.top(self._held(), "chunk_id", "embedding", queries, "query", "embedding", None, "unit")

    def search(self, queries: DataFrame, method: str = "lexical", limit: int = 5) -> DataFrame:
        """``query, unit, doc, score, channel_score, rank`` of the best ``limit`` units of each query."""
        check_request("a batch", None, method, limit)
        if self.strict:
            check_queries(queries, method != "dense")
        if method == "hybrid":
            found = fusion.fuse_best(*self._channels(queries), limit, Workspace(self.chunks.sparkSession, "hybrid")).withColumnRenamed("rrf", "score")
        else:
            best = self._best_lexical if method == "lexical" else self._best_dense
            found = best(queries, limit).withColumn("channel_score", F.col("score"))
        if "bundle_id" in self.chunks.columns:
            of = self.chunks.select(F.col("chunk_id").alias("doc"), "bundle_id")
            return found.join(of, "doc").select("query", "unit", "doc", "score", "channel_score", "rank", "bundle_id")
        return found.select("query", "unit", "doc", "score", "channel_score", "rank")

    def compare(self, queries: DataFrame, limit: int = 5) -> DataFrame:
        """``method, query, unit, rank`` of the best ``limit`` units by each method; channels are prepared and searched once for all three."""
        check_request("a batch", None, "hybrid", limit)
        if self.strict:
            check_queries(queries)
        channels, ws = self._channels(queries), Workspace(self.chunks.sparkSession, "compare")
        tops = fusion.first_places(*channels, limit, ws)
        found = [*(t.where(F.col("rank") <= limit) for t in tops), fusion.fuse_best(*channels, limit, ws, tops)]
        lexical, dense, hybrid = (df.select(F.lit(m).alias("method"), "query", "unit", "rank") for m, df in zip(METHODS, found))
        return lexical.unionByName(dense).unionByName(hybrid)

    def _channels(self, queries: DataFrame) -> tuple[L.Bm25, D.Dense]:
        return (
            L.Bm25(self.chunks, "chunk_id", "search_text", queries, "query", "text", "knowledge_unit_id"),
            D.Dense(self._held(), "chunk_id", "embedding", queries, "query", "embedding", "unit"),
        )

    def _best_lexical(self, queries: DataFrame, limit: int) -> DataFrame:
        return L.bm25_top(self.chunks, "chunk_id", "search_text", queries, "query", "text", limit, "knowledge_unit_id")

    def _best_dense(self, queries: DataFrame, limit: int) -> DataFrame:
        return D.top(self._held(), "chunk_id", "embedding", queries, "query", "embedding", limit, "unit")

    def _held(self) -> DataFrame:
        if self.vectors is None:
            raise QueryInputError("dense and hybrid search need vectors")
        units = self.chunks.select("chunk_id", F.col("knowledge_unit_id").alias("unit"))
        return self.vectors.select("chunk_id", "embedding").join(units, "chunk_id")

    def complete(self, found: DataFrame, units: DataFrame) -> DataFrame:
        """Found units with the chunk's span and place and the complete unit as a struct."""
        spans = self.chunks.select(F.col("chunk_id").alias("doc"), "body_start", "body_end", "token_count", "segment_index", "segment_count")
        whole = units.select(F.col("knowledge_unit_id").alias("unit"), F.struct(*units.columns).alias("knowledge_unit"))
        return found.join(spans, "doc").join(whole, "unit")
