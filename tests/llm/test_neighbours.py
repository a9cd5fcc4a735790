import numpy as np

from loomgraph.llm import neighbours as V
from loomgraph.llm.neighbours import Forest, nearest, neighbour_pairs, pack

MANIFEST, MATRIX = "row int, chunk_id string, score string", "row int, embedding array<float>, chunk_id string"


def tables(spark, x, ids=None):
    m = spark.createDataFrame([(i, c, "s") for i, c in enumerate(ids or [f"c{i:04d}" for i in range(len(x))])], MANIFEST)
    v = spark.createDataFrame([(i, [float(y) for y in row], "s") for i, row in enumerate(x)], MATRIX)
    return m, v


def brute(x, k):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = u @ u.T
    np.fill_diagonal(s, -2)
    return np.argsort(-s, axis=1, kind="stable")[:, :k]


def test_recall_of_the_forest(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(160, 32))
    x = (centres[rng.integers(0, 160, 1600)] + 0.35 * rng.normal(size=(1600, 32))).astype(np.float32)
    got = nearest(*tables(spark, x), k=5, dim=32, leaf=200).collect()
    found = {}
    for r in got:
        found.setdefault(int(r.chunk_id[1:]), set()).add(int(r.other_id[1:]))
    truth = brute(x, 5)
    assert len(found) == 1600 and all(len(v) == 5 for v in found.values())
    assert np.mean([len(found[i] & set(truth[i])) / 5 for i in range(1600)]) >= 0.9


def test_small_sets_are_exact_and_odd_rows_are_left_out(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(30, 8)).astype(np.float32)
    m, v = tables(spark, x)
    odd = [(100, None), (101, [1.0] * 7), (102, [0.0] * 8), (103, [float("nan")] + [1.0] * 7), (104, [float("inf")] + [1.0] * 7), (105, [None] + [1.0] * 7), (106, [1.0] * 8), (None, [1.0] * 8)]
    v = v.union(spark.createDataFrame([(a, b, "s") for a, b in odd], MATRIX)).union(v.limit(5))
    m = m.union(spark.createDataFrame([(a, f"odd{a}", "s") for a, _ in odd if a and a != 106] + [(200, "none", "s"), (None, "c", "s"), (3, None, "s"), (0, "c0000", "s")], MANIFEST))
    got = {}
    for r in nearest(m, v, 5, 8).collect():
        got.setdefault(r.chunk_id, []).append((r.place, r.other_id))
    truth = brute(x, 5)
    assert {k: [o for _, o in sorted(p)] for k, p in got.items()} == {f"c{i:04d}": [f"c{j:04d}" for j in truth[i]] for i in range(30)}


def test_copies_fill_places_first(spark):
    x = np.eye(6, dtype=np.float32)[[0] * 9 + [1, 2]] + np.float32(0.01)
    got = {}
    for r in nearest(*tables(spark, x), k=5, dim=6).collect():
        got.setdefault(r.chunk_id, set()).add(r.other_id)
    assert all(len(v) == 5 and v <= {f"c{i:04d}" for i in range(9)} - {c} for c, v in got.items() if c < "c0009")
    assert len(got) == 11


def test_few_and_none(spark):
    x = np.eye(3, dtype=np.float32)[:2] + 0.5
    m, v = tables(spark, x)
    assert [(r.chunk_id_a, r.chunk_id_b) for r in neighbour_pairs(nearest(m, v, 5, 3)).collect()] == [("c0000", "c0001")]
    assert nearest(m.where("false"), v, 5, 3).count() == 0 and nearest(m, v.where("false"), 5, 3).count() == 0
    assert nearest(m.limit(1), v, 5, 3).count() == 0


def test_queue_visits_home_leaves_first():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 16)).astype(np.float32)
    f = Forest(x, 500, leaf=60, trees=3, probes=6)
    tree, node, far = f.visit(x)
    assert (far[:, :3] == 0).all() and (np.sort(tree[:, :3], axis=1) == np.arange(3)).all()
    assert (np.diff(far, axis=1) >= 0).all()
    assert all(len(set(zip(t, n))) == 6 for t, n in zip(tree.tolist(), node.tolist()))


def test_pack_is_fine_enough():
    x = np.random.default_rng(1).normal(size=(50, 512))
    q = pack(x).astype(np.float64)
    u, w = x / np.linalg.norm(x, axis=1, keepdims=True), q / np.linalg.norm(q, axis=1, keepdims=True)
    assert np.abs(u @ u.T - w @ w.T).max() < 1e-5
    assert pack(np.array([[1e38, -1e38]]))[0].tolist() == [32767, -32767]


def test_close_cosines_are_settled_on_the_original_numbers(spark):
    """Neighbours that 16-bit numbers can't tell apart come in the exact order."""
    rng = np.random.default_rng(8)
    base = rng.normal(size=(10, 24))
    x = np.stack([base[i // 5] + 3e-6 * (i % 5) ** 2 * rng.normal(size=24) for i in range(50)]).astype(np.float32)
    x = x[rng.permutation(50)]
    got = {}
    for r in nearest(*tables(spark, x), k=3, dim=24).collect():
        got.setdefault(int(r.chunk_id[1:]), {})[r.place] = int(r.other_id[1:])
    u = x.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    s = 1 - ((u[:, None] - u[None]) ** 2).sum(2) / 2
    np.fill_diagonal(s, -2)
    lost = [s[i].max() - s[i, p[1]] for i, p in got.items()]
    assert len(got) == 50 and max(lost) < 2e-12


def test_sample_is_the_same_in_every_run_and_popular_leaves_are_split(spark, monkeypatch):
    monkeypatch.setattr(V, "FIT_SAMPLE", 300)
    rng = np.random.default_rng(5)
    x = (rng.normal(size=(40, 16))[rng.integers(0, 40, 900)] + 0.3 * rng.normal(size=(900, 16))).astype(np.float32)
    m, v = tables(spark, x)
    run = lambda v: {(r.chunk_id, r.other_id, r.place) for r in nearest(m, v, 5, 16, leaf=120).collect()}
    want = run(v)
    assert run(v.repartition(5)) == want
    monkeypatch.setattr(V, "VISITORS", 1)
    assert run(v) == want


def test_exact_cosines_hold_no_more_than_the_vectors(spark, monkeypatch):
    """p3_found's disk: the packed vectors are gone by then, and floats travel as floats."""
    x = np.random.default_rng(8).normal(size=(40, 8)).astype(np.float32)
    m, v = tables(spark, x)
    q = V._valid_packed(v, "row", "embedding", 8, exact=True).collect()
    assert len(q) == 40 and all(r.q == x[r.row].tobytes() for r in q)
    doubles = v.withColumn("embedding", v.embedding.cast("array<double>"))
    assert all(len(r.q) == 64 for r in V._valid_packed(doubles, "row", "embedding", 8, exact=True).collect())
    held, settled = [], V._settled
    monkeypatch.setattr(V, "_settled", lambda *a: held.append("packed" in a[-1].names) or settled(*a))
    assert nearest(m, v, k=3, dim=8).count() == 120 and held == [False]
