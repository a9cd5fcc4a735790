import json
import math

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from loomgraph.operators import evaluate as E, graph as G, identity as I, integrity as R, segment as S
from loomgraph.operators.current import IntegrityError
from loomgraph.sources import readers, writers
from loomgraph.streaming import incremental


@given(st.text(alphabet="ab。.\n", max_size=900), st.integers(61, 200), st.integers(0, 60))
@settings(max_examples=150, deadline=None)
def test_spans_cover_and_overlap(text, budget, overlap):
    out = S.spans(text, budget, overlap)
    assert (out == []) == (text == "")
    if out:
        assert out[0][0] == 0 and out[-1][1] == len(text)
    for (a, b), (c, d) in zip(out, out[1:]):
        assert b - a <= budget and a < c <= b and b - c <= overlap and d > b


def test_spans_with_a_counter():
    words = lambda t: len(t.split())
    out = S.spans("one two three. four five six seven", 3, 0, words)
    assert all(words("one two three. four five six seven"[a:b]) <= 3 for a, b in out)
    odd = lambda t: 9 if len(t) == 1 else 1
    assert S.spans("abcd", 1, 0, odd) == [(0, 4)]
    with pytest.raises(S.SegmentError):
        S.spans("abc", 0, 0, lambda t: 5)
    with pytest.raises(ValueError):
        S.spans("abc", 5, 61)


def test_segment_and_coverage(spark):
    df = spark.createDataFrame([("a", "x" * 950), ("b", ""), ("c", None), ("d", "短。")], "id string, t string")
    seg = S.segment(df, "id", "t", 400).cache()
    assert {(r.id, r.segment_count) for r in seg.collect()} == {("a", 3), ("d", 1)}
    c = S.coverage(seg, "id")
    assert c.where("gap > 0 or overlap > 60").count() == 0
    holes = spark.createDataFrame([("a", 0, 5), ("a", 7, 9), ("a", 1, 8)], "id string, body_start int, body_end int")
    assert [(r.gap, r.overlap) for r in S.coverage(holes, "id").orderBy("body_start").collect()] == [(0, 0), (0, 4), (0, 1)]


def test_metrics(spark):
    q = spark.createDataFrame([("q1", "any_hit"), ("q2", "all_relevant"), ("q3", "negative"), ("q4", "relation_only"), ("q5", "any_hit")], "query string, role string")
    rel = spark.createDataFrame([("q1", "a", "primary"), ("q2", "a", "primary"), ("q2", "b", "primary"), ("q2", "b", "primary"), ("q3", "z", "must_not"), ("q4", "c", "context"), ("q5", "a", "primary")], "query string, id string, kind string")
    runs = [("q1", 2, "a"), ("q1", 1, "x"), ("q2", 1, "b"), ("q2", 2, "x"), ("q2", 3, "a"), ("q3", 1, "y"), ("q3", 2, "z"), ("q4", 3, "c"), ("q5", 15, "a")]
    d = {r["query"]: r for r in E.diagnose(q, rel, spark.createDataFrame(runs, "query string, rank int, id string")).collect()}
    assert d["q1"].mrr == 0.5 and d["q1"].hit and not d["q1"].rank1 and d["q1"].recall is None
    assert d["q2"].recall == 1.0 and abs(d["q2"].ndcg - (1 + 1 / math.log2(4)) / (1 + 1 / math.log2(3))) < 1e-12
    assert d["q3"].clean is False and d["q3"].violations == ["z"] and d["q3"].hit is None
    assert d["q4"].context_ranks == [3] and d["q4"].mrr is None
    assert d["q5"].hit and d["q5"].mrr == 0.0 and d["q5"].first_rank == 15
    agg = {r.role: r for r in E.aggregate(E.diagnose(q, rel, spark.createDataFrame(runs, "query string, rank int, id string")), "role").collect()}
    assert agg["any_hit"].mrr_at_k == 0.25 and agg["relation_only"].hit_at_k is None
    bad = {(r["query"], r.problem) for r in E.input_violations(q, rel, spark.createDataFrame(runs[:2] + [("q9", 1, "a")], "query string, rank int, id string")).collect()}
    assert ("q9", "unknown query") in bad and ("q2", "no ranking") in bad
    assert [r["query"] for r in E.over_limit(spark.createDataFrame(runs, "query string, rank int, id string"), 2, "query").collect()] == ["q2"]
    with pytest.raises(ValueError):
        E.diagnose(q, rel, q, k=0)


def test_constraints(spark):
    a = spark.createDataFrame([("1", "x"), ("1", "x"), ("2", None), ("3", "q")], "k string, ref string")
    b = spark.createDataFrame([("x",), ("y",)], "id string")
    assert [tuple(r) for r in R.unique(a, "k").collect()] == [("1", "2")]
    assert [tuple(r) for r in R.refers(a, "k", "ref", b, "id").collect()] == [("3", "q")]
    assert {r.location for r in R.same_sets(a.select(F.col("ref").alias("id")).where("id is not null"), b, ["id"]).collect()} == {"q", "y"}
    assert {r.location for r in R.predicate(a, "k", F.col("ref") == "x").collect()} == {"2", "3"}
    with pytest.raises(IntegrityError):
        R.demand({"a": a}, [R.Rule("twice", lambda t: R.unique(t["a"], "k"))])
    diff = R.field_diff(a.where("k = '3'"), spark.createDataFrame([("3", None)], "k string, ref string"), "k", ["ref"])
    assert diff.first().differing == ["ref"]


def test_graph(spark):
    u = spark.createDataFrame([("r", "s", "v", "u1", ["e1", "e2"]), ("r", "s", "v", "u2", None)], "subject_root string, source_id string, source_volume_id string, knowledge_unit_id string, evidence_refs array<string>")
    n, e = G.build_nodes(u), G.build_edges(u)
    assert n.count() == 6 and e.count() == 5 and G.dangling(e, n).count() == 0
    assert G.dangling(e, n.where("node_id <> 'e2'")).collect()[0].node_id == "e2"


def test_corpus_identity_is_of_the_set(spark):
    df = spark.createDataFrame([(str(i), f"t{i}") for i in range(50)], "k string, t string")
    root = lambda x: I.corpus_identity(x, "k", F.col("t")).first().root
    assert root(df) == root(df.orderBy(F.desc("k")).repartition(7).union(df.limit(3)))
    assert root(df) != root(df.where("k <> '7'"))
    assert I.corpus_identity(df.where("false"), "k", F.col("t")).first().n == 0


def test_jsonl_sources_and_sinks(spark, tmp_path):
    df = spark.createDataFrame([(2, None, "é"), (1, "x", "")], "b int, a string, c string")
    writers.write_jsonl(df, f"{tmp_path}/out", "b")
    lines = [r.value for r in spark.read.text(f"{tmp_path}/out").collect()]
    assert sorted(lines) == ['{"a":"x","b":1,"c":""}', '{"a":null,"b":2,"c":"é"}']
    assert readers.read_jsonl(spark, f"{tmp_path}/out", df.schema).count() == 2
    (tmp_path / "in.jsonl").write_text('\ufeff{"a": 1}\n\n{"a": "no"}\n[1]\n{"a": 3}\n', encoding="utf-8")
    good, bad = readers.read_jsonl_reporting(spark, f"{tmp_path}/in.jsonl", "a int")
    assert sorted(r.a for r in good.collect()) == [1, 3] and bad.count() == 2
    with pytest.raises(Exception):
        readers.read_jsonl(spark, f"{tmp_path}/in.jsonl", "a int").collect()


def test_matrix_round_trip(spark, tmp_path):
    x = np.arange(24, dtype=np.float32).reshape(6, 4)
    df = spark.createDataFrame([(f"k{i}", row.tolist()) for i, row in enumerate(x)], "k string, embedding array<float>")
    assert writers.export_f32_matrix(df.repartition(3), f"{tmp_path}/m.f32", "k") == 6
    assert (tmp_path / "m.f32").read_bytes() == x.astype("<f4").tobytes()
    back = readers.read_f32_matrix(spark, f"{tmp_path}/m.f32", 4).orderBy("row").collect()
    assert [r.row for r in back] == list(range(6)) and np.allclose([r.embedding for r in back], x)
    with pytest.raises(Exception):
        readers.read_f32_matrix(spark, f"{tmp_path}/m.f32", 5).count()
    hashes = I.vector_hashes(df, "k", "embedding").collect()
    assert len({r.vector_sha256 for r in hashes}) == 6


def test_files(spark, tmp_path):
    (tmp_path / "d/sub").mkdir(parents=True)
    (tmp_path / "d/a.txt").write_text("x")
    (tmp_path / "d/sub/b.bin").write_text("y")
    files = readers.file_set(spark, f"{tmp_path}/d").cache()
    assert {r.name for r in files.collect()} == {"a.txt", "sub/b.bin"}
    m = files.where("name = 'a.txt'").withColumn("sha256", F.lit("0" * 64)).union(spark.createDataFrame([("c", 1, "")], "n string, b bigint, s string"))
    assert {tuple(r) for r in readers.compare_manifest(files, m).collect()} == {("a.txt", "hash"), ("c", "missing"), ("sub/b.bin", "extra")}
    assert [r.name for r in readers.denied_files(files, [".bin"]).collect()] == ["sub/b.bin"]
    (tmp_path / "rec/S1").mkdir(parents=True)
    (tmp_path / "rec/S1/n1.json").write_text(json.dumps({"id": "n1"}))
    assert tuple(readers.read_records(spark, f"{tmp_path}/rec", "id string").first()) == ("n1", "S1", "n1")


def test_bundle_writes_once(spark, tmp_path):
    t = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    args = (f"file://{tmp_path}/bundle", {"t": "k"}, "B1")
    first = writers.write_bundle({"t": t}, [], *args)
    assert writers.write_bundle({"t": t}, [], *args) == first
    with pytest.raises(IntegrityError):
        writers.write_bundle({"t": t.limit(1)}, [], *args)
    with pytest.raises(IntegrityError):
        writers.write_bundle({"t": t}, [R.Rule("none", lambda x: R.predicate(x["t"], "k", F.lit(False)))], f"file://{tmp_path}/other", {"t": "k"}, "B1")


def test_stream_of_units(spark, tmp_path):
    schema = "knowledge_unit_id string, text_sha256 string, title string, text string, applicability array<string>, source_id string, subject_root string, recorded_at timestamp"
    row = lambda i: {"knowledge_unit_id": i, "text_sha256": "h" + i, "title": "t", "text": "x" * 500, "applicability": [], "source_id": "s", "subject_root": "r", "recorded_at": "2024-01-01T00:00:00Z"}
    (tmp_path / "in").mkdir()
    (tmp_path / "in/1.json").write_text(json.dumps(row("a")) + "\n" + json.dumps(row("a")) + "\n")
    go = lambda: incremental.index_new_units(spark.readStream.schema(schema).json(f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination(120)
    go()
    (tmp_path / "in/2.json").write_text(json.dumps(row("a")) + "\n" + json.dumps(row("b")) + "\n")
    go()
    out = spark.read.parquet(f"{tmp_path}/out")
    assert {(r.chunk_id) for r in out.collect()} == {"a:chunk:001", "a:chunk:002", "b:chunk:001", "b:chunk:002"} and out.count() == 4


def test_event_rates(spark):
    e = spark.sql("select timestamp '2024-01-01 00:10:00' as ts, 'a' as event_type, 1.0 as value union all select timestamp '2024-01-01 00:50:00', 'a', 2.0")
    r = incremental.event_rates(e).collect()
    assert len(r) == 1 and r[0].n == 2 and float(r[0].total) == 3.0


def test_roles_of_the_judged_queries_are_counted(spark):
    import __spark_entry__

    got = {r.role: r.n for r in __spark_entry__.queries()["judged_role_counts"](spark, "/root/testdata/sf0.001").collect()}
    assert set(got) == {"any_hit", "all_relevant", "negative", "relation_only"} and sum(got.values()) > 0


def test_custom_order_of_all_chunks(spark):
    import __spark_entry__

    from loomgraph.plans.structure import chunks

    sf = "/root/testdata/sf0.001"
    got = __spark_entry__.queries()["whole_custom_order"](spark, sf).collect()
    assert sorted(r.position for r in got) == list(range(1, chunks(spark, sf).count() + 1))
