import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomgraph.functions import text as T, vectors as V
from loomgraph.operators import dense as D, fusion, lexical as L
from loomgraph.operators.current import collection, latest, shared_keys
from loomgraph.operators.search import QueryInputError, Searcher, check_request, exact_lookup, filter_chunks

DOCS = [("a", "塔板效率 Tray-1 tray"), ("b", "塔 flow.rate flow"), ("c", ""), ("d", None), ("e", "塔板效率 Tray-1 tray")]


def toks(spark, s):
    return spark.createDataFrame([(s,)], "t string").select(T.tokens(F.col("t"))).first()[0]


def test_tokens(spark):
    assert toks(spark, "塔板X，v1.2_b 塔") == ["塔", "板", "塔板", "x", "v1.2_b", "塔"]
    assert toks(spark, "") == [] and toks(spark, None) == [] and toks(spark, "∂∇ 𠀀") == []


def test_bm25_against_plain_python(spark):
    docs = spark.createDataFrame(DOCS, "id string, text string")
    q = spark.createDataFrame([(1, "塔板 tray tray"), (2, "flow"), (3, "∂"), (4, None)], "query int, text string")
    got = {(r.query, r.doc): r.score for r in L.bm25(docs, "id", "text", q, "query", "text").collect()}
    bags = {i: Counter(toks(spark, t)) for i, t in DOCS}
    n, avg = len(DOCS), sum(sum(b.values()) for b in bags.values()) / len(DOCS)
    want = {}
    for qi, qt in [(1, "塔板 tray tray"), (2, "flow")]:
        for i, bag in bags.items():
            s = 0.0
            for t, k in Counter(toks(spark, qt)).items():
                df = sum(t in b for b in bags.values())
                if df and bag[t]:
                    s += math.log(1 + (n - df + 0.5) / (df + 0.5)) * bag[t] * 2.2 / (bag[t] + 1.2 * (0.25 + 0.75 * sum(bag.values()) / avg)) * (1 + math.log1p(k))
            if s > 0:
                want[qi, i] = s
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_similarities_skip_invalid_and_keep_ties(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 0.0]), (4, None), (5, [1.0]), (6, [float("nan"), 1.0]), (7, [0.0, 0.0])], "id int, e array<float>")
    got = D.top(v, "id", "e", v.where("id in (1, 4)"), "id", "e", 2).collect()
    assert {(r.query, r.doc, r.rank) for r in got} == {(1, 1, 1), (1, 3, 2)}
    assert {r.doc for r in D.similarities(v, "id", "e", v.where("id in (1, 4)"), "id", "e").collect()} == {1, 2, 3, 7}
    assert D.similarities(v, "id", "e", v.where("id = 99"), "id", "e").count() == 0
    blocks = D.similarities(v, "id", "e", v.where("id in (1, 2, 3)"), "id", "e", block=2)
    assert blocks.count() == 3 * 4
    cos = {r.doc for r in D.similarities(v, "id", "e", v.where("id = 1"), "id", "e", cosine=True).collect()}
    assert cos == {1, 2, 3}


def test_encode(spark):
    df = spark.createDataFrame([(1, "ab"), (2, None)], "id int, t string")
    make = lambda: lambda texts: np.array([[len(t) + 1.0, 2.0] for t in texts])
    out = {r.id: r.embedding for r in D.encode(df, "id", "t", make).collect()}
    assert abs(sum(x * x for x in out[1]) - 1) < 1e-6 and len(out) == 2


def test_models_and_pooling():
    assert D.pooled(np.zeros((2, 5, 3)), 2).shape == (2, 3)
    for bad in (np.zeros((3, 3)), np.zeros(4)):
        with pytest.raises(ValueError):
            D.pooled(bad, 2)
    assert D.model_conflicts({"a": {"dim": 512, "rev": 1}, "b": {"dim": 512, "rev": 2}}, ["dim", "rev"]) == ["rev"]


def test_fusion_prefers_dense_chunk(spark):
    lex = fusion.rank_units(spark.createDataFrame([(1, "u", "c1", 2.0), (1, "w", "c9", 1.0)], "query int, unit string, doc string, score double"))
    den = fusion.rank_units(spark.createDataFrame([(1, "v", "c3", 0.9), (1, "u", "c2", 0.5)], "query int, unit string, doc string, score double"))
    rows = fusion.fuse(lex, den).orderBy("rank").collect()
    assert [(r.unit, r.doc) for r in rows] == [("u", "c2"), ("v", "c3"), ("w", "c9")]
    assert abs(rows[0].rrf - (1 / 61 + 1 / 62)) < 1e-12


CHUNKS = [("u1:chunk:001", "u1", "塔 板", "s", "r"), ("u1:chunk:002", "u1", "flow", "s", "r"), ("u2:chunk:001", "u2", "塔", "t", "q")]


def chunks(spark):
    return spark.createDataFrame(CHUNKS, "chunk_id string, knowledge_unit_id string, search_text string, source_id string, subject_root string")


def test_filters_and_lookup(spark):
    c = chunks(spark)
    assert filter_chunks(c, source="t").count() == 1 and filter_chunks(c, node_id="nope").count() == 0
    for bad in ({"source": "zz"}, {"subject": " "}):
        with pytest.raises(QueryInputError):
            filter_chunks(c, **bad)
    asked = spark.createDataFrame([("u1",), ("nope",), ("u1",)], "node_id string")
    assert [tuple(r) for r in exact_lookup(c, asked).collect()] == [("u1", "u1:chunk:001", 1.0, "exact-node-id")]


@pytest.mark.parametrize("args", [("x", None, "fuzzy", 5), ("x", None, "lexical", 0), (3, None, "lexical", 5), (" ", None, "lexical", 5), ("a\x00", None, "lexical", 5), (None, " ", "lexical", 5)])
def test_bad_requests(args):
    with pytest.raises(QueryInputError):
        check_request(*args)


def test_search_groups_units(spark):
    q = spark.createDataFrame([(1, "塔")], "query int, text string")
    rows = Searcher(chunks(spark)).search(q).orderBy("rank").collect()
    assert [r.unit for r in rows] == ["u2", "u1"]
    with pytest.raises(QueryInputError):
        Searcher(chunks(spark)).search(q, "dense")


def test_latest_and_collection(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "y"), (None, 3, "z"), ("b", None, "w")], "k string, at int, v string")
    assert {tuple(r) for r in latest(df, ["k"], F.desc_nulls_last("at"), F.col("v")).collect()} == {("a", 2, "y"), ("b", None, "w")}
    both = collection({"one": df, "two": df.where("k = 'b'")}, "k")
    assert [r.k for r in shared_keys(both.where("k is not null"), "k").collect()] == ["b"]


def test_text_predicates(spark):
    rows = [(None,), ("",), (" \u3000\n",), ("a\x00",), ("ok",), ("C:\\x",), ("see abc:/x",), ("\\\\users\\a",)]
    got = spark.createDataFrame(rows, "t string").select(T.is_unsafe(F.col("t")), T.has_private_path(F.col("t"))).collect()
    assert [r[0] for r in got] == [True, True, True, True, False, False, False, False]
    assert [r[1] for r in got] == [False, False, False, False, False, True, False, True]
    hits = spark.createDataFrame([("at C:\\Users\\bob x",), ("api_key = 'abcdefghijklmnop'",), ("see /home/bob/x",), (None,)], "t string").select(T.secrets(F.col("t")), T.redact_paths(F.col("t"))).collect()
    assert hits[0][0] == ["windows_absolute_path", "windows_user_path"] and hits[1][0] == ["credential_assignment"] and hits[2][0] == ["unix_home_path"] and hits[3][0] == []
    assert hits[0][1] == "at <path> x"
    ids = spark.createDataFrame([("a.b-c",), ("a\n",), ("-a",), (None,), ("a" * 129,)], "t string").select(T.is_identifier(F.col("t"))).collect()
    assert [r[0] for r in ids] == [True, False, False, False, False]
    paths = spark.createDataFrame([("a/b",), ("/a",), ("a/../b",), ("c:x",), ("",), (None,)], "t string").select(T.is_safe_relative_path(F.col("t"))).collect()
    assert [r[0] for r in paths] == [True, False, False, False, False, False]


def test_vectors(spark):
    v = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],), ([1.0, None],), (None,), ([1.0, float("inf")],)], "e array<float>")
    assert [r[0] for r in v.select(V.is_valid(F.col("e"), 2)).collect()] == [True, False, False, False, False]
    unit = v.limit(1).select(V.normalized(F.col("e"))).first()[0]
    assert abs(unit[0] - 0.6) < 1e-6 and v.select(V.normalized(F.col("e"))).collect()[1][0] is None


def test_tokens_against_a_scan(spark):
    import random
    import re

    rng = random.Random(5)
    texts = ["".join(rng.choice("塔板率效abAB01._- 、。㐀豈😀é") for _ in range(rng.randrange(40))) for _ in range(400)]

    def scan(s):
        out = []
        for run in re.findall(r"[㐀-䶿一-鿿豈-﫿]+|[A-Za-z0-9]+(?:[._-][A-Za-z0-9]+)*", s):
            out += [run.lower()] if run[0].isascii() else [*run, *map("".join, zip(run, run[1:]))]
        return out

    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", T.tokens(F.col("t"))).collect()
    assert all(r[1] == scan(texts[r[0]]) for r in got)
