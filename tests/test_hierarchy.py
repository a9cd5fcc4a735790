import random

import pytest

from loomgraph import workspace
from loomgraph.operators.hierarchy import build_hierarchy, descendant_counts, descendants, links_of, paths, rejected_links


def brute(parent):
    out = {}
    for v in parent:
        seen = [v]
        while seen[-1] in parent and parent[seen[-1]] not in seen:
            seen.append(parent[seen[-1]])
        top = parent.get(seen[-1])
        if top is None:
            out[v] = (seen[-1], len(seen) - 1)
        else:
            circle = seen[seen.index(top):]
            out[v] = (min(circle), -1 if v in circle else -2)
    return out


def found(spark, links, **kw):
    return build_hierarchy(spark.createDataFrame(links, "child string, parent string"), **kw)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_graphs(spark, seed):
    rng = random.Random(seed)
    n = 400
    parent = {f"n{i}": f"n{rng.randrange(i) if rng.random() < 0.97 else rng.randrange(n)}" for i in range(1, n)}
    h = found(spark, list(parent.items())).cache()
    assert {r.node_id: (r.root_node_id, r.depth) for r in h.collect()} == brute(parent)
    tree = {v for v, (_, d) in brute(parent).items() if d > 0}
    got = {r.node_id: r.path for r in paths(h).collect()}
    for v in tree:
        want = [v]
        while want[-1] in parent:
            want.append(parent[want[-1]])
        assert got[v] == want[::-1]
    below = {r.node_id: r.descendants for r in h.where("depth > 0").collect()}
    pairs = descendants(paths(h)).where("distance > 0").groupBy("ancestor_id").count().collect()
    assert {r.ancestor_id: r["count"] for r in pairs if r.ancestor_id in tree} == {v: n for v, n in below.items() if n}


def test_deep_chain_and_cycle_with_tail(spark):
    links = [(f"c{i + 1}", f"c{i}") for i in range(150)] + [("x", "y"), ("y", "z"), ("z", "x"), ("t1", "y"), ("t2", "t1"), ("self", "self"), ("u", "self")]
    got = {r.node_id: (r.root_node_id, r.depth) for r in found(spark, links).collect()}
    assert got["c150"] == ("c0", 150)
    assert got["x"] == got["z"] == ("x", -1) and got["t2"] == ("x", -2) and got["self"] == ("self", -1) and got["u"] == ("self", -2)


def test_hot_parent_uses_salted_siblings(spark):
    links = [(f"k{i}", "hub") for i in range(5000)] + [("leaf", "k17")]
    h = found(spark, links, salts=7)
    assert h.where("depth = 1").count() == 5000
    assert h.where("node_id = 'k17'").first().descendants == 1


def test_links_nulls_repeats_empty(spark):
    rows = [("a", "b", " Contains\t"), ("a", "b", "contains"), ("a", None, "contains"), (None, "b", "contains"), ("a", "c", "other"), ("a", "d", None), ("z", "e", "CONTAINS"), ("y", "e", "contains")]
    e = spark.createDataFrame(rows, "source_node_id string, target_node_id string, relation string")
    assert {(r.child, r.parent) for r in links_of(e).collect()} == {("b", "a"), ("e", "y")}
    assert found(spark, []).count() == 0
    assert paths(found(spark, [])).count() == 0


def test_whole_closure_and_counts(spark):
    """b and c are a circle, d to f hang from it; s is its own parent, r a root with two nodes."""
    h = found(spark, [("b", "c"), ("c", "b"), ("d", "c"), ("e", "d"), ("f", "c"), ("s", "s"), ("x", "r"), ("y", "x")])
    got = {tuple(r) for r in descendants(paths(h)).collect()}
    assert got == {("c", "d", 1), ("c", "e", 2), ("d", "e", 1), ("c", "f", 1), ("r", "x", 1), ("r", "y", 2), ("x", "y", 1)}
    counts = [tuple(r) for r in descendant_counts(h).collect()]
    assert sorted(counts) == [("b", 0), ("c", 3), ("d", 1), ("e", 0), ("f", 0), ("r", 2), ("s", 0), ("x", 1), ("y", 0)]


def test_whole_queries_hold_what_hangs_below_circles(spark, tmp_path):
    import __spark_entry__

    edges = [("1", "contains", "b", "c"), ("2", "contains", "c", "b"), ("3", "contains", "c", "d"), ("4", "contains", "r", "x")]
    spark.createDataFrame(edges, "edge_id string, relation string, source_node_id string, target_node_id string").write.parquet(f"{tmp_path}/kg_edges.parquet")
    run = lambda name: {tuple(r) for r in __spark_entry__.queries()[name](spark, str(tmp_path)).collect()}
    assert run("p5_closure_whole") == {("c", "d", 1), ("r", "x", 1)}
    assert run("p5_descendants_whole") == {("b", 0), ("c", 1), ("d", 0), ("r", 1), ("x", 0)}


def test_one_large_tree_is_spliced_and_undone(spark):
    """A tree of 100,000 nodes with a deep spine and a hub that holds a third of them; lists are spliced, hot keys broadcast."""
    rng = random.Random(5)
    parent = {1: 0}
    for i in range(2, 100_000):
        parent[i] = i - 1 if i < 3000 else 1500 if i % 3 == 0 else rng.randrange(i)
    depth, size = {0: 0}, dict.fromkeys(range(100_000), 0)
    for i in range(1, 100_000):
        depth[i] = depth[parent[i]] + 1
    for i in range(99_999, 0, -1):
        size[parent[i]] += size[i] + 1
    rows = [(f"n{c}", f"n{p}") for c, p in parent.items()]
    h = build_hierarchy(spark.createDataFrame(rows, "child string, parent string"), remainder=60_000, hot_rows=20_000)
    got = h.select("node_id", "root_node_id", "depth", "descendants").toArrow().to_pylist()
    assert len(got) == 99_999
    for r in got:
        i = int(r["node_id"][1:])
        assert (r["root_node_id"], r["depth"], r["descendants"]) == ("n0", depth[i], size[i])
    inside = h.select("entry", "exit", "descendants").toArrow().to_pandas().sort_values("entry")
    entry = inside["entry"].to_numpy()
    reach = entry.searchsorted(inside["exit"].to_numpy(), "right") - range(1, len(entry) + 1)
    assert (reach == inside["descendants"].to_numpy()).all()


@pytest.mark.parametrize("remainder", [3, 60])
def test_splicing_gives_what_one_task_gives(spark, remainder):
    rng = random.Random(remainder)
    links = [(f"n{i}", f"n{rng.randrange(max(0, i - 9), i)}") for i in range(1, 60)] + [("x", "y"), ("y", "x"), ("z", "x"), ("w", "z"), *((f"q{i}", f"p{i}") for i in range(80))]
    cols = ["node_id", "root_node_id", "depth", "tour", "descendants"]
    run = lambda **kw: sorted(map(tuple, found(spark, links, **kw).select(*cols).collect()), key=repr)
    assert run(remainder=remainder, hot_rows=5) == run()


def test_second_parents_are_reported(spark):
    e = spark.createDataFrame([("b", "x", "contains"), ("a", "x", " CONTAINS"), ("c", "x", "contains"), ("c", "x", "contains"), ("a", "y", "contains"), (None, "x", "contains"), ("d", "x", "other")], "source_node_id string, target_node_id string, relation string")
    assert {tuple(r) for r in rejected_links(e).collect()} == {("x", "b", "a"), ("x", "c", "a")}


def test_tables_are_released(spark):
    import glob

    root = workspace.shared_dir(spark).removeprefix("file://")
    before = set(glob.glob(f"{root}/loomgraph/hierarchy-*/*"))
    with workspace.released():
        h = found(spark, [("a", "b"), ("b", "c")])
        assert {p.rsplit("/", 1)[1] for p in set(glob.glob(f"{root}/loomgraph/hierarchy-*/*")) - before} == {"hierarchy"}
        assert h.count() == 2
    assert set(glob.glob(f"{root}/loomgraph/hierarchy-*/*")) == before
