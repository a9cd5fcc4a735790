"""BM25 over ideograph and Latin tokens, for many queries at once.

:func:`bm25` gives every positive score and stays in the JVM.  Documents are hashed by id once; counting terms per document,
joining the queries' terms and summing scores per query and document all keep that partitioning, as the
query side is small and broadcast where its size allows.

:func:`bm25_top` gives the best of each query.  Texts are cut into tokens once, and the places of the asked terms are written as a compact
table; statistics come from that table, and tasks score their own queries against all of it in NumPy, a few nanoseconds a product
(:mod:`loomgraph.operators.blocks`).  Only answers leave a task, so nothing that is shuffled grows with documents times queries.

Statistics are those of the documents given, so a filter comes first.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from loomgraph.functions.text import tokens
from loomgraph.operators.blocks import Rows, Searched
from loomgraph.operators.ranking import TILE
from loomgraph.workspace import Workspace

K1, B = 1.2, 0.75
#: Query terms that are broadcast at most, some 50 bytes each.
BROADCAST_TERMS = 1_000_000
#: Queries that one task answers at most.
QUERIES = 20_000
#: Terms whose scores are a matrix product, at most, and the share of all pairs of a query and a document that a term has to be in.
HOT, OFTEN = 256, 0.02


def postings(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """``doc, len, term, tf``: how often each term occurs in each document.

    The number of partitions is fixed, at twice the session's: AQE would size them by the bytes of the texts,
    and the work behind is a thousand times that.  A number of its own keeps the exchange from being merged
    with one below that AQE may shrink.
    """
    parts = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = docs.select(F.col(doc).alias("doc"), F.col(text).alias("text")).repartition(parts, "doc")
    toks = spread.select("doc", tokens(F.col("text")).alias("t"))
    return toks.select("doc", F.size("t").alias("len"), F.explode("t").alias("term")).groupBy("doc", "len", "term").agg(F.count(F.lit(1)).alias("tf"))


def document_frequency(p: DataFrame) -> DataFrame:
    return p.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def corpus_stats(docs: DataFrame, text: str) -> DataFrame:
    """One row: number of documents, and their mean length of at least 1."""
    return docs.agg(F.count(F.lit(1)).alias("n"), F.greatest(F.lit(1.0), F.coalesce(F.avg(F.size(tokens(F.col(text)))), F.lit(0.0))).alias("avgdl"))


def query_terms(queries: DataFrame, query: str, text: str) -> DataFrame:
    """``query, term, weight``; a term asked q times weighs 1 + ln(1 + q)."""
    t = queries.select(F.col(query).alias("query"), F.explode(tokens(F.col(text))).alias("term"))
    return t.groupBy("query", "term").agg((1 + F.log1p(F.count(F.lit(1)))).alias("weight"))


def term_weight(n: Column, df: Column, weight: Column) -> Column:
    """What a query's term is worth before a document's share of it: inverse document frequency times query weight."""
    return F.log(1 + (n - df + 0.5) / (df + 0.5)) * weight


def saturation(tf: Column, length: Column, avgdl: Column) -> Column:
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / avgdl))


def bm25(docs: DataFrame, doc: str, text: str, queries: DataFrame, query: str, query_text: str) -> DataFrame:
    """``query, doc, score`` of every pair with a positive score.

    Documents with null or token-less text count in the statistics and never match; a query without tokens matches
    nothing.  Ids should be unique: rows that share an id are scored as one bag per length.
    """
    q = query_terms(queries, query, query_text)
    p = postings(docs, doc, text)
    # only terms that are asked take part; df counts are per asked term
    asked = p.join(q.select("term").distinct(), "term", "left_semi")
    df = document_frequency(asked)
    # each logarithm once per query term, each saturation once per posting; a pair costs one product
    stats = F.broadcast(corpus_stats(docs, text))
    weights = q.join(df, "term").crossJoin(stats).select("query", "term", term_weight(F.col("n"), F.col("df"), F.col("weight")).alias("w"))
    # the postings stay where they are as long as the terms asked are few; else the planner chooses
    if q.limit(BROADCAST_TERMS + 1).count() <= BROADCAST_TERMS:
        weights = F.broadcast(weights)
    shares = asked.crossJoin(stats).select("doc", "term", saturation(F.col("tf"), F.col("len"), F.col("avgdl")).alias("s"))
    total = shares.join(weights, "term").groupBy("query", "doc").agg(F.sum(F.col("w") * F.col("s")).alias("score"))
    return total.where("score > 0")


def top_k(scores: DataFrame, k: int, by: list[str], score: Column, *tie: str) -> DataFrame:
    """Rank from 1 by score, then by the tie columns; the group-limited window keeps k per partition before the shuffle."""
    w = Window.partitionBy(*by).orderBy(score.desc(), *tie)
    return scores.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def best_per_unit(scores: DataFrame, units: DataFrame, digits: int = 9) -> DataFrame:
    """Best chunk of each unit and query: highest score, then smallest chunk; ``units`` has ``doc, unit``."""
    joined = scores.join(units, "doc")
    w = Window.partitionBy("query", "unit").orderBy(F.round("score", digits).desc(), "doc")
    return joined.withColumn("place", F.row_number().over(w)).where("place = 1").drop("place")


def _places(docs: DataFrame, doc: str, text: str, unit: str, terms: pa.Array, ws: Workspace) -> DataFrame:
    """``doc, unit, len, terms, tfs``: of each document its number of tokens and the asked terms it holds, by number."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(terms)
    kinds = [docs.schema[c].dataType.simpleString() for c in (doc, unit)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            lists = batch.column(2)
            size = np.asarray(lists.value_lengths().fill_null(0)).astype(np.int64)
            at = pc.index_in(lists.flatten(), value_set=known)
            asked = np.asarray(at.is_valid())
            owner, term = np.repeat(np.arange(len(size)), size)[asked], np.asarray(at.drop_null()).astype(np.int64)
            key, tf = np.unique(owner * max(1, len(known)) + term, return_counts=True)
            owner, term = np.divmod(key, max(1, len(known)))
            offsets = pa.array(np.searchsorted(owner, np.arange(len(size) + 1)).astype(np.int32))
            held = [pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int32))) for x in (term, tf)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(size.astype(np.int32)), *held], ["doc", "unit", "len", "terms", "tfs"])

    parts = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = docs.select(F.col(doc).alias("doc"), F.col(unit).alias("unit"), F.col(text).alias("text")).repartition(parts, "doc")
    toks = spread.select("doc", "unit", tokens(F.col("text")).alias("t"))
    return ws.write(toks.mapInArrow(run, f"doc {kinds[0]}, unit {kinds[1]}, len int, terms array<int>, tfs array<int>"), "places")


@dataclass
class _Queries:
    """Queries of a task: each one's terms lie together, those of the first kind with a column in ``hot``."""

    names: pa.Array
    start: np.ndarray
    term: np.ndarray
    weight: np.ndarray
    hot: np.ndarray
    wanted: pa.Array | None = None
    ends: np.ndarray | None = None


@dataclass
class _Postings:
    hot: np.ndarray
    start: np.ndarray
    row: np.ndarray
    share: np.ndarray


@dataclass
class _Scorer:
    """Frequent terms that many ask are a matrix product; of the others, each adds its postings."""

    terms: pa.Array
    idf: np.ndarray
    hot: np.ndarray
    avgdl: float

    def queries(self, rows: pa.Table) -> _Queries:
        asked = rows.column("asked").combine_chunks()
        size = np.asarray(asked.value_lengths()).astype(np.int64)
        term = np.asarray(pc.index_in(asked.flatten().field("term"), value_set=self.terms)).astype(np.int64)
        weight = np.asarray(asked.flatten().field("weight")) * self.idf[term]
        owner, column = np.repeat(np.arange(len(size)), size), np.full(len(self.terms), -1)
        column[self.hot] = np.arange(len(self.hot))
        often = column[term] >= 0
        hot = np.zeros((len(size), len(self.hot)))
        hot[owner[often], column[term[often]]] = weight[often]
        start = np.searchsorted(owner[~often], np.arange(len(size) + 1))
        return _Queries(rows.column("query").combine_chunks(), start, term[~often], weight[~often], hot, *wanted_of(rows))

    def prepare(self, rows: pa.Table) -> tuple[_Postings, pa.Table]:
        lists, n = rows.column("terms").combine_chunks(), rows.num_rows
        size = np.asarray(lists.value_lengths())
        owner = np.repeat(np.arange(n), size)
        term, tf = np.asarray(lists.flatten()), np.asarray(rows.column("tfs").combine_chunks().flatten())
        # in place, as many values pass here
        under = np.repeat(K1 * (1 - B + B * np.asarray(rows.column("len")) / self.avgdl), size)
        under += tf
        share = tf * (K1 + 1)
        share /= under
        column = np.full(len(self.terms) + 1, -1, np.int32)
        column[self.hot] = np.arange(len(self.hot))
        place = column[term]
        often, rest = np.flatnonzero(place >= 0), np.flatnonzero(place < 0)
        hot = np.zeros((len(self.hot), n))
        hot[place[often], owner[often]] = share[often]
        term = term[rest]
        order = np.argsort((term & 0xFFFF).astype(np.uint16), kind="stable")
        if len(self.terms) > 0xFFFF:
            order = order[np.argsort((term[order] >> 16).astype(np.uint16), kind="stable")]
        count, rest = np.bincount(term, minlength=len(self.terms)), rest[order]
        return _Postings(hot, np.concatenate([[0], np.cumsum(count)]), owner[rest], share[rest]), rows.select(["doc", "unit"])

    def score(self, tile: _Postings, queries: _Queries, a: int, b: int) -> np.ndarray:
        out = queries.hot[a:b] @ tile.hot
        lo, hi = queries.start[a], queries.start[b]
        first, last = tile.start[queries.term[lo:hi]], tile.start[queries.term[lo:hi] + 1]
        owner = np.repeat(np.arange(b - a), np.diff(queries.start[a : b + 1]))
        held = np.flatnonzero(last > first)
        for i, x, y, w in zip(owner[held].tolist(), first[held].tolist(), last[held].tolist(), queries.weight[lo:hi][held].tolist()):
            np.add.at(out[i], tile.row[x:y], w * tile.share[x:y])
        return out


def wanted_of(rows: pa.Table) -> tuple[pa.Array, np.ndarray] | tuple[()]:
    """Wanted units of all queries, one after the other, and where each query's begin."""
    if "wanted" not in rows.column_names:
        return ()
    lists = rows.column("wanted").combine_chunks()
    return lists.flatten().field("unit"), np.concatenate([[0], np.cumsum(np.asarray(lists.value_lengths()))])


class Bm25:
    """Queries against documents, prepared once: the compact table of places, and the queries' terms."""

    def __init__(self, docs: DataFrame, doc: str, text: str, queries: DataFrame, query: str, query_text: str, unit: str | None = None, digits: int = 9):
        spark = docs.sparkSession
        self.digits = digits
        queries = queries.select(query, query_text).where(F.col(query).isNotNull())
        ws = Workspace(spark, "bm25")
        asked = query_terms(queries, query, query_text).groupBy("query").agg(F.collect_list(F.struct("term", "weight")).alias("asked"))
        asked = ws.write(asked, "asked")
        self.whole: DataFrame | None = None
        # so many different terms reach the driver at most; vocabularies beyond that take the other way
        each = asked.select(F.explode("asked.term").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
        each = each.limit(BROADCAST_TERMS + 1).toArrow().combine_chunks()
        if each.num_rows > BROADCAST_TERMS:
            units = docs.select(F.col(doc).alias("doc"), F.col(unit or doc).alias("unit"))
            self.scores = bm25(docs, doc, text, queries, query, query_text)
            self.whole = best_per_unit(self.scores, units, digits)
            return
        each = each.sort_by("term")
        terms = each.column("term").combine_chunks() if each.num_rows else pa.array([], pa.string())
        places = _places(docs, doc, text, unit or doc, terms, ws)
        stats = places.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.avg("len"), F.lit(0.0)).alias("avgdl")).first()
        # at most as many rows as terms are asked
        freq = places.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow()
        df = np.zeros(len(terms))
        df[freq.column("term").to_numpy()] = freq.column("count").to_numpy()
        rows = Rows(places, ws)
        ws.discard("places")
        n = asked.count()
        # a product costs more where it is added by itself than as one of a matrix's
        often = df * np.asarray(each.column("n")) / max(1, stats["n"] * n) if len(terms) else df
        hot = np.argsort(-often, kind="stable")[:HOT]
        scorer = _Scorer(terms, np.log(1 + (stats["n"] - df + 0.5) / (df + 0.5)), np.sort(hot[often[hot] > OFTEN]), max(1.0, stats["avgdl"]))
        kinds = tuple(df.schema[c].dataType.simpleString() for df, c in ((queries, query), (docs, doc), (docs, unit or doc)))
        self.searched = Searched(rows, asked, n, scorer, kinds, digits, True, TILE, QUERIES)

    def top(self, k: int | None) -> DataFrame:
        """See :func:`bm25_top`."""
        if self.whole is not None:
            return ranked(self.whole, k, self.digits)
        return self.searched.ranking() if k is None else ranked(best_again(self.searched.top(k), self.digits), k, self.digits)

    def unit_ranks(self) -> DataFrame:
        """``query, unit, rank`` of every unit with a positive score."""
        return ranked(self.whole, None, self.digits).select("query", "unit", "rank") if self.whole is not None else self.searched.unit_ranks()

    def totals(self) -> DataFrame:
        """``query, n, total, best``: how many documents have a positive score, the sum and the best of their scores."""
        if self.whole is not None:
            return self.scores.groupBy("query").agg(F.count(F.lit(1)).alias("n"), F.sum("score").alias("total"), F.max("score").alias("best"))
        return self.searched.totals().groupBy("query").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.max("best").alias("best"))

    def ranks(self, wanted: DataFrame) -> DataFrame:
        """``query, doc, unit, score, rank``: the exact ranks of wanted ``query, unit`` pairs among all units; pairs that score nothing have none."""
        if self.whole is not None:
            every = ranked(self.whole, None, self.digits)
            return every.join(wanted, (every["query"] == wanted["query"]) & every["unit"].eqNullSafe(wanted["unit"]), "left_semi")
        return self.searched.ranks(wanted)


def bm25_top(docs: DataFrame, doc: str, text: str, queries: DataFrame, query: str, query_text: str, k: int | None, unit: str | None = None, digits: int = 9) -> DataFrame:
    """``query, doc, unit, score, rank`` of the best ``k`` documents, or of the best documents of the best ``k`` units, of each query; None ranks all.

    Order: highest score to ``digits`` digits, then smallest unit; of a unit the best document, then the smallest.  Scores are those of
    :func:`bm25`; only positive ones count.  A null unit is a unit of its own.
    """
    return Bm25(docs, doc, text, queries, query, query_text, unit, digits).top(k)


def ranked(best: DataFrame, k: int | None, digits: int) -> DataFrame:
    """Ranks of units per query, all or the first ``k``."""
    if k is None:
        return best.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(F.round("score", digits).desc(), "unit")))
    return top_k(best, k, ["query"], F.round("score", digits), "unit")


def best_again(found: DataFrame, digits: int = 9) -> DataFrame:
    """Of the best of each partition, the best document per query and unit."""
    w = Window.partitionBy("query", "unit").orderBy(F.round("score", digits).desc(), "doc")
    return found.withColumn("place", F.row_number().over(w)).where("place = 1").drop("place")
