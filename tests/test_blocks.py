"""Blocks of queries against rows that every task reads."""

import numpy as np
from pyspark.sql import functions as F

from loomgraph.operators import blocks, dense as D, lexical as L
from loomgraph.operators.search import Searcher


def corpus(spark, n=150, asked=12):
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(30)]
    text = lambda k: " ".join(rng.choice(words, k)) if k else None
    docs = spark.createDataFrame([(f"d{i:03d}", None if i % 40 == 0 else f"u{i % 35:02d}", text(int(rng.integers(0, 20)))) for i in range(n)], "doc string, unit string, t string")
    return docs.repartition(3), spark.createDataFrame([(i, text(4)) for i in range(asked)], "q bigint, t string")


def test_totals_are_those_of_all_pairs(spark):
    """no row per query and document is made."""
    docs, queries = corpus(spark)
    pairs = L.bm25(docs, "doc", "t", queries, "q", "t").groupBy("query").agg(F.count(F.lit(1)).alias("n"), F.sum("score").alias("total"), F.max("score").alias("best"))
    rows = lambda df: sorted((r.query, r.n, round(r.total, 7), round(r.best, 9)) for r in df.collect())
    totals = L.Bm25(docs, "doc", "t", queries, "q", "t").totals()
    assert rows(totals) == rows(pairs)
    assert "explode(term" not in totals._jdf.queryExecution().executedPlan().toString()


def test_units_over_several_tiles_and_tasks(spark, monkeypatch):
    """what leaves a task is the best of its queries, however rows are cut."""
    docs, queries = corpus(spark)
    full = L.best_per_unit(L.bm25(docs, "doc", "t", queries, "q", "t"), docs.select("doc", "unit"))
    rows = lambda df: sorted((r.query, r["rank"], r.unit or "", r.doc, round(r.score, 9)) for r in df.collect())
    want = {k: rows(L.ranked(full, k, 9)) for k in (3, None)}
    monkeypatch.setattr(L, "TILE", 7)
    monkeypatch.setattr(blocks, "WORTH", 3)
    monkeypatch.setattr(blocks, "HELD", 80)
    b = L.Bm25(docs, "doc", "t", queries, "q", "t", "unit")
    assert {k: rows(b.top(k)) for k in want} == want
    monkeypatch.setattr(blocks, "WORTH", 1000)
    b = L.Bm25(docs, "doc", "t", queries, "q", "t", "unit")
    assert rows(b.top(3)) == want[3]
    assert b.searched.top(3).count() <= 3 * 12 * b.searched.tasks


def test_many_queries_of_few_terms_make_no_row_per_pair(spark, monkeypatch):
    """what is bounded is the vocabulary that is asked, not the number of queries."""
    docs, queries = corpus(spark, n=40, asked=12)
    monkeypatch.setattr(L, "BROADCAST_TERMS", 30)
    assert L.query_terms(queries, "q", "t").count() > 30
    assert L.Bm25(docs, "doc", "t", queries, "q", "t").whole is None


def test_full_rankings_are_not_shuffled(spark):
    """F1, F14: a query's units are ranked in the task that scores them."""
    docs, queries = corpus(spark, n=40, asked=3)
    assert "Window" not in L.bm25_top(docs, "doc", "t", queries, "q", "t", None, "unit")._jdf.queryExecution().executedPlan().toString()


def test_ranks_of_all_units_leave_a_task_as_lists(spark, monkeypatch):
    """F1 of round 3: a row of what leaves a task is a unit, not a query and a unit, and has no document."""
    docs, queries = corpus(spark)
    full = L.best_per_unit(L.bm25(docs, "doc", "t", queries, "q", "t"), docs.select("doc", "unit"))
    rows = lambda df: sorted((r.query, r["rank"], r.unit or "") for r in df.collect())
    want = rows(L.ranked(full, None, 9))
    monkeypatch.setattr(L, "TILE", 7)
    for held, listed in ((80, 5), (16_000_000, 131_072)):
        monkeypatch.setattr(blocks, "HELD", held)
        monkeypatch.setattr(blocks, "LISTED", listed)
        got = L.Bm25(docs, "doc", "t", queries, "q", "t", "unit").unit_ranks()
        assert rows(got) == want
        left = next(x for x in got._jdf.queryExecution().executedPlan().toString().splitlines() if "MapInArrow" in x)
        assert "queries" in left and "doc" not in left and "score" not in left


def test_order_of_rounded_scores():
    rng = np.random.default_rng(1)
    for s in (rng.integers(0, 50, 400) / 7, rng.normal(size=300), np.array([2e-10, 0.0, 1e-10, 6e-10]), rng.normal(size=50) * 1e20, np.empty(0)):
        assert blocks._order(s, 9).tolist() == np.argsort(-np.round(s, 9), kind="stable").tolist()


def test_ranks_of_wanted_pairs_read_the_rows_twice(spark, monkeypatch):
    """ranks among all units are counted while tiles pass by, however many queries there are."""
    docs, queries = corpus(spark)
    monkeypatch.setattr(L, "TILE", 7)
    monkeypatch.setattr(blocks, "HELD", 80)
    read, tiles = [], blocks._tiles
    monkeypatch.setattr(blocks, "_tiles", lambda *a: read.append(a) or tiles(*a))
    b = L.Bm25(docs, "doc", "t", queries, "q", "t", "unit")
    wanted = queries.select(F.col("q").alias("query")).crossJoin(docs.select("unit").distinct())
    full = {(r.query, r.unit): (r.doc, r["rank"], r.score) for r in b.top(None).collect()}

    def here(self, answer, schema, asked, blocks, parts):
        table = asked.toArrow().sort_by("query").combine_chunks()
        return [x for batch in answer(self.scorer, parts[0], self.scorer.queries(table)) for x in batch.to_pylist()]

    monkeypatch.setattr(blocks.Searched, "_run", here)
    got = b.ranks(wanted)
    assert {(x["query"], x["unit"]): (x["doc"], x["rank"], x["score"]) for x in got} == full and len(got) == len(full)
    assert len({s for *_, s in full.values()}) < len(full)
    assert len(read) == 2


def test_ranks_of_tied_vectors(spark):
    """ties are counted by the order of units, also where a unit's rows lie in several tiles."""
    rng = np.random.default_rng(6)
    rows = [(i, None if i % 30 == 0 else f"u{i % 23:02d}", [float(x) for x in rng.integers(-1, 2, 3)]) for i in range(120)]
    v = spark.createDataFrame(rows, "id bigint, unit string, e array<float>").repartition(3)
    d = D.Dense(v, "id", "e", v.where("id < 15").select(F.col("id").alias("q"), "e"), "q", "e", "unit")
    d.searched.size, d.searched.width = 4, 3
    full = {(r.query, r.unit): (r.doc, r["rank"]) for r in d.top(None).collect()}
    wanted = spark.createDataFrame([(q, u) for (q, u) in full if hash((q, u or "")) % 2] + [(1, "none"), (77, "u01")], "query bigint, unit string")
    got = {(r.query, r.unit): (r.doc, r["rank"]) for r in d.ranks(wanted).collect()}
    assert got and got == {(r.query, r.unit): full[r.query, r.unit] for r in wanted.collect() if (r.query, r.unit) in full}


def test_methods_are_compared_over_channels_prepared_once(spark, monkeypatch):
    """F7, F8, F11: the three rankings are those of three searches."""
    docs, _ = corpus(spark, n=60)
    c = docs.select(F.col("doc").alias("chunk_id"), F.col("unit").alias("knowledge_unit_id"), F.col("t").alias("search_text"))
    e = c.select("chunk_id", F.array(*[F.pmod(F.xxhash64("chunk_id", F.lit(i)), F.lit(5)).cast("float") for i in range(3)]).alias("embedding"))
    q = c.join(e, "chunk_id").where("search_text is not null and chunk_id < 'd006'").select(F.substring("chunk_id", 2, 3).cast("bigint").alias("query"), F.col("search_text").alias("text"), "embedding")
    made = []
    for m, kind in ((L, "Bm25"), (D, "Dense")):
        monkeypatch.setattr(m, kind, lambda *a, f=getattr(m, kind), kind=kind: made.append(kind) or f(*a))
    s = Searcher(c, e)
    rows = lambda df, m=None: {(m or r.method, r.query, r.unit, r["rank"]) for r in df.collect()}
    got = rows(s.compare(q, 4))
    assert sorted(made) == ["Bm25", "Dense"]
    assert got == set().union(*(rows(s.search(q, m, 4), m) for m in ("lexical", "dense", "hybrid")))
