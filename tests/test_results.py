"""Ranking, identities, array functions, result checks and requests."""


import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loomgraph.functions import arrays as A
from loomgraph.operators import dense as D, evaluate as E, graph as G, identity as I, integrity as R, lexical as L, segment as S
from loomgraph.operators.current import IntegrityError
from loomgraph.operators.ranking import Best
from loomgraph.operators.search import QueryInputError, Searcher, check_queries
from loomgraph.sources import readers, writers


@pytest.mark.parametrize("seed", range(5))
def test_best_of_tiles_is_the_best_of_all(seed):
    rng = np.random.default_rng(seed)
    n, q, k = 200, 7, 4
    score = rng.integers(-3, 9, (n, q)) / 4 + rng.integers(0, 2, (n, q)) * 1e-12  # many ties
    docs = [f"d{i:03d}" for i in rng.permutation(n)]
    units = [None if i % 17 == 0 else f"u{i % 23:02d}" for i in range(n)]
    best = Best(k, 9, True)
    for a in range(0, n, 31):
        best.add(score[a : a + 31], pa.array(docs[a : a + 31]), pa.array(units[a : a + 31], pa.string()))
    got = {}
    for r in best.batch(pa.array([f"q{i}" for i in range(q)]), pa.string(), pa.string()).to_pylist():
        got.setdefault(r["query"], []).append((r["unit"], r["doc"]))
    for j in range(q):
        per = {}
        for i in range(n):
            s = round(score[i, j], 9)
            if s > 0:
                per[units[i]] = min(per.get(units[i], (0, "~")), (-s, docs[i]))
        want = sorted((s, u or "", u, d) for u, (s, d) in per.items())[:k]
        assert got.get(f"q{j}", []) == [(u, d) for _, _, u, d in want]


def test_bm25_top_is_the_top_of_bm25(spark, monkeypatch):
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(40)] + ["塔板", "效率"]
    text = lambda n: " ".join(rng.choice(words, n)) if n else None
    docs = spark.createDataFrame([(f"d{i}", f"u{i % 30}", text(int(rng.integers(0, 30))), "x") for i in range(120)], "doc string, unit string, t string, term string")
    queries = spark.createDataFrame([(i, text(5)) for i in range(11)] + [(50, None), (51, ""), (52, "nowhere"), (None, "w1")], "q bigint, t string")
    full = L.bm25(docs, "doc", "t", queries.where("q is not null"), "q", "t")
    want = L.top_k(L.best_per_unit(full, docs.select("doc", "unit")), 3, ["query"], F.round("score", 9), "unit")
    row = lambda r: (r["query"], r["unit"], r["doc"], r["rank"], round(r["score"], 9))
    take = lambda: sorted(map(row, L.bm25_top(docs, "doc", "t", queries, "q", "t", 3, "unit").collect()))
    want = sorted(map(row, want.collect()))
    assert take() == want
    monkeypatch.setattr(L, "QUERIES", 4)
    assert take() == want
    monkeypatch.setattr(L, "BROADCAST_TERMS", 10)
    assert take() == want
    assert L.bm25_top(docs.where("false"), "doc", "t", queries, "q", "t", 3).count() == 0
    assert L.bm25_top(docs, "doc", "t", queries.where("false"), "q", "t", 3).count() == 0


def test_dense_top_keeps_ties_by_id(spark):
    x = [[1.0, 0.0]] * 40 + [[0.0, 1.0]] * 5
    v = spark.createDataFrame([(i, e, f"u{i % 9}") for i, e in enumerate(x)] + [(99, None, "u"), (98, [1.0], "u"), (97, [float("nan"), 1.0], "u")], "id int, e array<double>, unit string").repartition(6)
    q = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 2.0]), ("c", None)], "q string, e array<double>")
    got = D.top(v, "id", "e", q, "q", "e", 3).collect()
    assert sorted((r["query"], r["rank"], r["doc"]) for r in got) == [("a", 1, 0), ("a", 2, 1), ("a", 3, 2), ("b", 1, 40), ("b", 2, 41), ("b", 3, 42)]
    per_unit = D.top(v, "id", "e", q, "q", "e", 2, "unit", block=2).collect()
    assert sorted((r["query"], r["unit"], r["doc"]) for r in per_unit if r["query"] == "a") == [("a", "u0", 0), ("a", "u1", 1)]
    assert D.top(v, "id", "e", q.where("false"), "q", "e", 3).count() == 0 and D.top(v.where("false"), "id", "e", q, "q", "e", 3).count() == 0


def test_canonical_json_is_in_order_at_every_depth(spark):
    df = spark.sql("select named_struct('z', 1, 'a', array(named_struct('y', 2, 'b', null))) as s, map('q', 1, 'c', 2) as m, timestamp_ntz'2024-01-02 03:04:05.000007' as t, cast(null as struct<b: int, a: int>) as n")
    assert df.select(I.canonical_json(df)).first()[0] == '{"m":{"c":2,"q":1},"n":null,"s":{"a":[{"b":null,"y":2}],"z":1},"t":"2024-01-02T03:04:05.000007"}'


def test_vector_hashes_are_of_the_bytes(spark):
    import hashlib

    rows = [(1, [1.0, 2.0]), (2, None), (3, [1.0, None]), (4, []), (5, [0.1])]
    got = {r.k: r.vector_sha256 for r in I.vector_hashes(spark.createDataFrame(rows, "k int, e array<float>"), "k", "e").collect()}
    h = lambda v: hashlib.sha256(np.asarray(v, "<f4").tobytes()).hexdigest()
    assert got == {1: h([1, 2]), 2: None, 3: None, 4: h([]), 5: h([0.1])}


def test_bundle_identity_covers_all_tables(spark, tmp_path):
    a, b = spark.createDataFrame([("a", 1)], "k string, v int"), spark.createDataFrame([("x", 1)], "k string, v int")
    args = (f"file://{tmp_path}/bundle", {"a": "k", "b": "k"}, "B1")
    first = writers.write_bundle({"a": a, "b": b}, [], *args)
    assert writers.write_bundle({"b": b, "a": a}, [], *args) == first and set(first["roots"]) == {"a", "b"}
    with pytest.raises(IntegrityError):
        writers.write_bundle({"a": a, "b": b.withColumn("v", F.lit(2))}, [], *args)
    with pytest.raises(ValueError):
        writers.write_bundle({"a": a, "b": b}, [], f"file://{tmp_path}/c", {"a": "k"}, "B1")


def test_bad_lines_come_with_their_numbers(spark, tmp_path):
    (tmp_path / "in.jsonl").write_text('﻿{"a": 1}\n\n{"a": "no"}\n[1]\n{"a": 3}\nx\n', encoding="utf-8")
    (tmp_path / "two.jsonl").write_text("oops\n" + '{"a": 5}\n' * 3 + "{\n", encoding="utf-8")
    good, bad = readers.read_jsonl_reporting(spark, str(tmp_path), "a int")
    assert sorted((r.file.rsplit("/", 1)[1], r.line_number) for r in bad.collect()) == [("in.jsonl", 3), ("in.jsonl", 4), ("in.jsonl", 6), ("two.jsonl", 1), ("two.jsonl", 5)]
    assert good.count() == 5
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        (tmp_path / "long").mkdir()
        (tmp_path / "long/a.jsonl").write_text("".join("bad\n" if i % 7 == 0 else f'{{"a": {i}}}\n' for i in range(60)), encoding="utf-8")
        _, bad = readers.read_jsonl_reporting(spark, str(tmp_path / "long"), "a int")
        assert sorted(r.line_number for r in bad.collect()) == [i + 1 for i in range(0, 60, 7)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_segments_count_title_and_applicability(spark):
    text = "短句。" * 60 + "some words here. " * 20
    df = spark.createDataFrame([("a", text, "标题" * 5, ["x y", "z"]), ("b", text, None, None)], "k string, t string, title string, app array<string>")
    seg = S.segment(df, "k", "t", 90, counter=S.lexical_counter, title="title", applicability="app").collect()
    count = S.lexical_counter()
    for r in seg:
        head, tail = ("标题" * 5, "x y\nz") if r.k == "a" else ("", "")
        assert r.token_count == count(f"{head}\n{text[r.body_start:r.body_end]}\n{tail}") <= 90
    assert sum(r.k == "a" for r in seg) > sum(r.k == "b" for r in seg)
    with pytest.raises(Exception, match="alone exceed the budget"):
        S.segment(df, "k", "t", 15, counter=S.lexical_counter, title="title", applicability="app").collect()


def test_lexical_counter_counts_the_engine_tokens(spark):
    from loomgraph.functions.text import tokens

    texts = ["", "塔板效率 a.b-c 3.14", "豈x一", "--", "Aé B_c", "㐀㐀 x."]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(F.size(tokens(F.col("t")))).collect()]
    assert got == [S.lexical_counter()(t) for t in texts]


def test_positions_in_order_over_many_tasks(spark):
    rows = [(i, i if i % 40 else 0) for i in range(1, 400)]
    df = spark.createDataFrame(rows, "at int, v int").repartition(7)
    assert sorted(int(r.location) for r in R.ordered(df, "at", "v").collect()) == list(range(40, 400, 40))
    assert R.ordered(df.where("false"), "at", "v").count() == 0
    assert {r.location for r in R.ordered(df.withColumn("g", F.col("at") % 2), "at", "v", "g").collect()} == {str(i) for i in range(40, 400, 40)}


def test_arrays(spark):
    df = spark.sql("select array('a', 'b', null) as a, array('b') as b, cast(null as array<string>) as n, array('c', 'c') as c, array() as e")
    c = F.col
    got = df.select(
        A.duplicate_free(c("a")), A.duplicate_free(c("c")), A.duplicate_free(c("n")), A.disjoint(c("a"), c("b")), A.disjoint(c("a"), c("c"), c("n")), A.place_of(c("a"), F.lit("b")), A.place_of(c("a"), F.lit("z")), A.all_named(c("a")), A.all_named(c("b")), A.all_named(c("n")),
    ).first()
    assert tuple(got) == (True, False, False, False, True, 2, None, False, True, False)
    texts = ["3-7, 12", " 5 ", "", None, "a", "0-2", "7-3", "1,,2", "4–6"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(A.intervals(c("t")).alias("i")).select("i", A.valid_intervals(c("i")).alias("v")).collect()
    assert [[tuple(x) for x in r.i] if r.i is not None else None for r in got] == [[(3, 7), (12, 12)], [(5, 5)], None, None, None, [(0, 2)], [(7, 3)], None, [(4, 6)]]
    assert [r.v for r in got] == [True, True, False, False, False, False, False, False, True]
    got = spark.createDataFrame([(t,) for t in ['["a","b"]', '"a \\"q\\""', "7", None, "{}", "[]"]], "t string").select(A.as_array(c("t"))).collect()
    assert [r[0] for r in got] == [["a", "b"], ['a "q"'], None, None, None, []]
    got = spark.createDataFrame([('{"b": "x"}',), ('{"a": null, "b": "y"}',), ('{"a": "z", "b": "y"}',), (None,)], "t string").select(A.first_named(c("t"), ["a", "b"])).collect()
    assert [r[0] for r in got] == ["x", "y", "z", None]


def test_results_are_verified_and_contradictions_refused(spark):
    import hashlib

    h = lambda t: hashlib.sha256(t.encode()).hexdigest()
    schema = "knowledge_unit_id string, title string, text string, text_sha256 string"
    units = spark.createDataFrame([("a", "t", "x", h("x")), ("b", None, "y", h("y").upper()), ("c", "t", "z", "0" * 64)], schema)
    rows = [("q1", 1, ("a", "t", "x", h("x"))), ("q1", 2, ("b", None, "y", h("y").upper())), ("q1", 3, ("c", "t", "z", "0" * 64)), ("q2", 1, ("a", "T", "x", h("x"))), ("q2", 2, ("gone", "t", "x", h("x"))), ("q2", 3, ("b", None, "changed", h("y")))]
    found = E.verified(spark.createDataFrame(rows, f"query string, rank int, u struct<{schema.replace(' string', ': string')}>"), "u", units, ["title", "text"])
    errors = {(r["query"], r["rank"]): r["errors"] for r in found.collect()}
    assert errors == {("q1", 1): [], ("q1", 2): [], ("q1", 3): ["text_sha256"], ("q2", 1): ["title"], ("q2", 2): ["unknown unit"], ("q2", 3): ["text", "text_sha256"]}
    assert "u" not in found.columns
    q = spark.createDataFrame([("q1", "any_hit"), ("q2", "any_hit")], "query string, role string")
    rel = spark.createDataFrame([("q1", "a", "primary"), ("q2", "a", "primary")], "query string, id string, kind string")
    run = spark.createDataFrame([("q1", 1, "a", []), ("q2", 1, "a", ["title"]), ("q2", 2, "b", [])], "query string, rank int, id string, errors array<string>")
    assert {(r["query"], r.hit, r.error) for r in E.evaluate(q, rel, run).collect()} == {("q1", True, None), ("q2", False, None)}
    assert {(r["query"], r.hit, r.error) for r in E.evaluate(q, rel, run, k=1).collect()} == {("q1", True, None), ("q2", False, "more than 1 results")}
    with pytest.raises(IntegrityError, match="primary and must_not"):
        E.evaluate(q, rel.union(spark.createDataFrame([("q1", "a", "must_not")], rel.schema)), run)


def test_regressions(spark):
    s = lambda rows: spark.createDataFrame(rows, "role string, mrr double")
    got = {r.role: r.regressed for r in E.regressions(s([("a", 0.5), ("b", 0.5), ("c", None), ("d", 0.1)]), s([("a", 0.5), ("b", 0.4), ("c", 0.1)]), ["role"], ["mrr"]).collect()}
    assert got == {"a": False, "b": True, "c": False, "d": True}


def test_bad_batches_and_collections_are_refused(spark):
    q = lambda *rows: spark.createDataFrame(list(rows), "query string, text string")
    check_queries(q(("a", "x"), ("b", "塔")))
    for rows, why in (([("a", None)], "blank"), ([("a", " 　")], "blank"), ([("a", "x\x00")], "NUL"), ([("a", "--")], "tokens"), ([("a", "x"), ("a", "y")], "twice"), ([(None, "x")], "without an id")):
        with pytest.raises(QueryInputError, match=why):
            check_queries(q(*rows))
    check_queries(q(("a", "--")), tokens_needed=False)
    c = spark.createDataFrame([("c1", "u1", "some text")], "chunk_id string, knowledge_unit_id string, search_text string")
    with pytest.raises(QueryInputError, match="tokens"):
        Searcher(c, strict=True).search(q(("a", "?")))
    assert Searcher(c).search(q(("a", "?"))).count() == 0
    other = c.withColumn("chunk_id", F.lit("c2"))
    with pytest.raises(IntegrityError, match="chunks"):
        Searcher.over({"x": c, "y": c})
    with pytest.raises(IntegrityError, match="units"):
        Searcher.over({"x": c, "y": other})
    own = other.withColumn("knowledge_unit_id", F.lit("u2"))
    with pytest.raises(IntegrityError, match="dims"):
        Searcher.over({"x": c, "y": own}, models={"x": {"dims": 1}, "y": {"dims": 2}}, fields=("dims",))
    found = Searcher.over({"x": c, "y": own}).search(q(("a", "text"))).collect()
    assert {(r.doc, r.bundle_id) for r in found} == {("c1", "x"), ("c2", "y")}


def test_profiles(spark):
    t = spark.createDataFrame([("a", "0F"), ("b", "1e")], "k string, h string")
    got = {(r.location, r.detail) for r in R.against_profile(t, {"rows": 3, "ids": ["a", "c"], "hashes": {"a": "0f", "b": "0f", "z": "1"}, "hash": "h"}, "k").collect()}
    assert got == {("rows", "2 instead of 3"), ("b", "missing right"), ("c", "missing left"), ("b", "hash"), ("z", "hash")}
    assert R.against_profile(t, {}, "k").count() == 0


def test_whole_graph(spark):
    u = spark.createDataFrame([("r", "s", "v", "u1", ["e1"]), ("r", "s", "v", "u2", None)], "subject_root string, source_id string, source_volume_id string, knowledge_unit_id string, evidence_refs array<string>")
    o = spark.createDataFrame([("ch", "chapter", "r", "s", "v", None), ("su", "support_unit", "r", "s", "v", ["ch"])], "node_id string, node_type string, subject_root string, source_id string, source_volume_id string, chapter_refs array<string>")
    m = spark.createDataFrame([("ch", "u1"), ("ch", "nobody")], "group_id string, knowledge_unit_id string")
    edges = {r.edge_id for r in G.build_edges(u, o, m, spark.createDataFrame([("u1", "u2"), (None, "u2")], "source_node_id string, target_node_id string")).collect()}
    assert edges == {"edge:r:contains:v", "edge:u1:supported_by:e1", "edge:ch:contains:u1", "edge:v:contains:u2", "edge:v:contains:ch", "edge:su:has_chapter_context:ch", "edge:u1:related_to:u2"}
    assert {r.node_type for r in G.build_nodes(u, o).collect()} == {"subject_root", "source_volume", "knowledge_unit", "evidence", "chapter", "support_unit"}


def test_ranking_code_names_no_targets():
    """No module that ranks or scores holds an id of a document, unit, chunk or query."""
    import ast
    import inspect
    import re

    from loomgraph.operators import fusion, ranking, search

    for module in (L, D, fusion, ranking, search, E):
        for node in ast.walk(ast.parse(inspect.getsource(module))):
            if isinstance(node, ast.Constant) and isinstance(node.value, str):
                assert not re.search(r"\b[A-Z]{2}\d{2}-[A-Z]\d|:chunk:\d|volume:", node.value), (module.__name__, node.value)


def test_matrix_parts_are_put_together(spark, tmp_path):
    x = np.random.default_rng(0).normal(size=(500, 3)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "k int, embedding array<float>").repartition(9)
    assert writers.export_f32_matrix(df, f"{tmp_path}/m.f32", "k") == 500
    assert (tmp_path / "m.f32").read_bytes() == x.tobytes() and not (tmp_path / "m.f32.parts").exists()


def test_hot_keys_are_broadcast_to_the_same_result(spark):
    from loomgraph.operators.skew import attach, hot_keys

    left = spark.createDataFrame([(f"e{i}", "hub" if i % 3 == 0 else f"k{i % 50}" if i % 7 else None) for i in range(900)], "e string, k string")
    right = spark.createDataFrame([("hub", 1), ("nobody", 2)] + [(f"k{i}", i) for i in range(0, 50, 2)], "k string, v int")
    assert hot_keys(left, "k", 100)[1] == ["hub"]
    for how in ("inner", "left"):
        want = sorted(map(str, left.join(right, "k", how).select("e", "k", "v").collect()))
        assert sorted(map(str, attach(left, right, "k", how=how, hot_rows=100).select("e", "k", "v").collect())) == want
        assert sorted(map(str, attach(left, right, "k", how=how).select("e", "k", "v").collect())) == want


def test_too_long_texts_are_not_encoded(spark):
    df = spark.createDataFrame([("a", "x y"), ("b", "x y z")], "k string, t string")
    make = lambda: lambda texts: np.ones((len(texts), 3))
    words = lambda: lambda t: len(t.split())
    assert D.encode(df, "k", "t", make, words, 3).count() == 2
    with pytest.raises(Exception, match="more than 2 tokens"):
        D.encode(df, "k", "t", make, words, 2).collect()


@pytest.mark.parametrize("limit", [1, 5])
def test_hybrid_search_is_the_fusion_of_full_rankings(spark, limit, monkeypatch):
    """Ranks beyond the first places of a channel are looked up, ties and units in several parts included."""
    from loomgraph.operators import fusion, ranking

    rng = np.random.default_rng(limit)
    words = [f"w{i}" for i in range(25)]
    n = 420
    rows = [(f"c{i:03d}", None if i % 97 == 0 else f"u{int(rng.integers(0, 260)):03d}", " ".join(rng.choice(words, int(rng.integers(0, 9)))), rng.integers(-2, 3, 4).astype(float).tolist()) for i in range(n)]
    chunks = spark.createDataFrame([(c, u, t) for c, u, t, _ in rows], "chunk_id string, knowledge_unit_id string, search_text string").repartition(5)
    vectors = spark.createDataFrame([(c, e) for c, _, _, e in rows if c[-1] != "7"], "chunk_id string, embedding array<double>").repartition(3)
    queries = spark.createDataFrame([(i, " ".join(rng.choice(words, 4)), rng.integers(-2, 3, 4).astype(float).tolist()) for i in range(12)] + [(90, "nowhere", [1.0, 0.0, 0.0, 1.0]), (91, "w1 w2", None)], "query bigint, text string, embedding array<double>")
    s = Searcher(chunks, vectors)
    row = lambda r: (r["query"], r["rank"], r["unit"] or "", r["doc"], round(r["score"], 9), round(r["channel_score"], 6))
    want = sorted(map(row, fusion.fuse(s.lexical(queries), s.dense(queries), limit).withColumnRenamed("rrf", "score").collect()))
    assert sorted(map(row, s.search(queries, "hybrid", limit).collect())) == want
    monkeypatch.setattr(L, "QUERIES", 5)
    monkeypatch.setattr(ranking, "TILE", 60)
    monkeypatch.setattr(L, "TILE", 60)
    assert sorted(map(row, s.search(queries, "hybrid", limit).collect())) == want
    monkeypatch.setattr(L, "BROADCAST_TERMS", 3)
    assert sorted(map(row, s.search(queries, "hybrid", limit).collect())) == want
