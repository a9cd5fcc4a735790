import random

import numpy as np
import pytest

from loomgraph.llm import near_duplicates as N
from loomgraph.workspace import Workspace

SCHEMA = "knowledge_unit_id string, title string, text string, unit_id string, digest string, cid bigint"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA)


def brute(rows, threshold=0.7):
    sets = {i: N.shingles(c) for i, t, x in rows if i is not None and (c := N.content(t, x)) and len(c) >= 5}
    ids = sorted(sets)
    return {(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= threshold}


def corpus(seed, n=120):
    rng = random.Random(seed)
    words = [f"词{i}word{i}" for i in range(300)]
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.5:
            _, t, x = rng.choice(rows)
            w = x.split()
            for _ in range(rng.randrange(8)):
                w[rng.randrange(len(w))] = rng.choice(words)
            rows.append((f"u{i:03d}", t, " ".join(w)))
        else:
            rows.append((f"u{i:03d}", rng.choice(words), " ".join(rng.choice(words) for _ in range(60))))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_pairs_against_brute_force(spark, seed):
    rows = corpus(seed)
    got = {(r.unit_id_a, r.unit_id_b) for r in N.near_duplicates(frame(spark, rows)).collect()}
    assert got == brute(rows)


@pytest.mark.parametrize("region", [4, 2])
def test_crowded_regions_lose_no_pair(spark, region, monkeypatch):
    rows = corpus(3, 40) + [(f"v{i:02d}", "t", "同一段文字 " * 20 + f"{i}") for i in range(30)]
    monkeypatch.setattr(N, "REGION", region)
    got = {(r.unit_id_a, r.unit_id_b) for r in N.near_duplicates(frame(spark, rows)).collect()}
    assert {p for p in got if p[0][0] == "v"} == {p for p in brute(rows) if p[0][0] == "v"}


def test_nulls_copies_blanks(spark):
    rows = [("a", None, "Some Text here"), ("a", None, "Some Text here"), ("b", "", "some\ttext  HERE"), ("c", None, None), ("d", "t", " 　"), (None, "t", "some text here"), ("e", None, "abc"), ("f", None, "abc")]
    got = {(r.unit_id_a, r.unit_id_b) for r in N.near_duplicates(frame(spark, rows)).collect()}
    assert got == {("a", "b")}
    assert N.near_duplicates(frame(spark, rows).where("false")).count() == 0
    groups = {r.unit_id: (r.class_id, r.group_id, r.n_links) for r in N.duplicate_groups(frame(spark, rows)).collect()}
    assert groups == {"a": ("a", "a", 0), "b": ("a", "a", 0)}


def test_large_class_is_paired_with_its_representative(spark, monkeypatch):
    monkeypatch.setattr(N, "WRITTEN_OUT", 5)
    rows = [(f"u{i}", "t", "the very same text") for i in range(9)]
    got = {(r.unit_id_a, r.unit_id_b) for r in N.near_duplicates(frame(spark, rows)).collect()}
    assert got == {("u0", f"u{i}") for i in range(1, 9)}
    assert {r.class_id for r in N.duplicate_groups(frame(spark, rows)).collect()} == {"u0"}


def test_components(spark):
    rng = random.Random(7)
    pairs = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(40)]
    got = {r.node: r.component for r in N.components(spark.createDataFrame(pairs, "a bigint, b bigint"), Workspace(spark, "t")).collect()}
    parent = {}
    find = lambda x: x if parent.setdefault(x, x) == x else find(parent[x])
    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    want = {x: find(x) for p in pairs if p[0] != p[1] for x in p}
    assert got == want


def test_very_long_text_has_a_signature():
    s = "".join(chr(0x4E00 + i % 5000) + str(i) for i in range(60_000))
    assert N.signature(N.shingle_hashes(s)).shape == (N.HASHES,)


def test_branches_of_regions_miss_different_pairs(spark):
    """Two contents that differ in a value of each branch of one region still meet in the branches of others."""
    a = np.arange(N.HASHES, dtype=np.uint16)
    b = a.copy()
    b[N._BRANCHES[0].reshape(-1, N.FAN, N.DEPTH)[0, :, 0]] += 1000
    signed = spark.createDataFrame([(1, bytearray(a.tobytes()), 0, 0), (2, bytearray(b.tobytes()), 0, 0)], "cid bigint, values binary, s0 bigint, s1 bigint")
    crowded = np.random.default_rng(1).integers(0, 1 << 62, 64).tolist()
    rows = spark.createDataFrame([(r, c) for r in crowded for c in (1, 2)], "home bigint, cid bigint")
    assert N._branched(rows, signed, 0).groupBy("home", "label").count().where("count > 1").count() > 100


@pytest.mark.parametrize("n, most, parts, swept", [(3000, 4, 7, 200), (500, 16, 4, 10_000), (90, 8, 4, 10), (4000, 8, 3, 64), (1, 4, 2, 10), (0, 4, 2, 10)])
def test_partitions_change_no_region(spark, monkeypatch, n, most, parts, swept):
    """Sweeps over partitions and their edges find what one look at the whole order does."""
    rng = np.random.default_rng(n)
    label = N._packed(rng.geometric(0.4, (n, N.DEPTH)).astype(np.uint16))
    home = rng.integers(0, 3, n)
    order = np.lexsort((label, home))
    home, label, zero = home[order], label[order], np.zeros(n, np.int64)
    sketch = rng.integers(0, 1 << 18, (n, 2))
    whole = {"home": home, "label": label, "cid": np.arange(n), "s0": sketch[:, 0], "s1": sketch[:, 1]}
    first, crowded = N._regions(home, label, N.SHARED, most) if n else (zero, zero > 0)
    want = {(r["a"], r["b"]) for b in N._judged(whole, first, zero > 0) for r in b.to_pylist()} if n else set()
    size = np.bincount(first[first >= 0], minlength=n)
    assert size.max(initial=0) <= most and (n < 1000 or (len(want) > 50 and crowded.sum() > 50))
    monkeypatch.setattr(N, "SWEPT", swept)
    rows = spark.createDataFrame([tuple(int(whole[c][i]) for c in ("home", "label", "cid", "s0", "s1")) for i in range(n)], N._ORDER)
    pairs, left = N._swept(rows, 8 * most * parts, N.SHARED, most, Workspace(spark, "t"), 0)
    assert {(r.a, r.b) for r in pairs.collect()} == want
    assert {r.cid for r in left.collect()} == set(np.flatnonzero(crowded).tolist())


def test_depth_adapts_to_the_region():
    """A sparse prefix is one region; under a dense one, rows are told apart by further values."""
    label = N._packed(np.array([[1, 1, 1, 1], [1, 1, 2, 1], [2, 1, 1, 1], [2, 1, 1, 2], [2, 1, 2, 1], [2, 1, 2, 2], [3, 1, 1, 1], *[[4, 1, 1, 1]] * 4], np.uint16))
    first, crowded = N._regions(np.zeros(len(label), np.int64), label, 2, 3)
    assert first.tolist() == [0, 0, 2, 2, 4, 4, 6, -1, -1, -1, -1] and crowded.tolist() == [False] * 7 + [True] * 4


def test_signatures_agree_as_texts_do():
    """Also for texts of few shingles, where most bins borrow their value."""
    rng = np.random.default_rng(4)
    for n in (8, 40, 2000):
        shares = []
        for _ in range(60):
            x = rng.integers(0, 1 << 63, n + n // 4, dtype=np.uint64)
            shares.append((N.signature(x[: n]) == N.signature(x[n // 4 :])).mean())
        assert abs(np.mean(shares) - 0.6) < 0.03


def test_one_label_of_a_third_of_all_rows_is_spread(spark):
    """Rows that share a whole label fill several sorted partitions, and all of them are found crowded."""
    n, most = 3000, 8
    label = [7 if i % 3 == 0 else i * 65_536 * 65_536 for i in range(n)]
    rows = spark.createDataFrame([(0, label[i], i, 0, 0) for i in range(n)], N._ORDER)
    ws = Workspace(spark, "t")
    pairs, left = N._swept(rows, 8 * most * 4, N.SHARED, most, ws, 0)
    assert {r.cid for r in left.collect()} == set(range(0, n, 3)) and len({r.home for r in left.collect()}) == 1
    sizes = [r.place for r in spark.read.parquet(f"{ws.root}/swept0").where("kind = 2").collect()]
    assert len(sizes) == 4 and max(sizes) < 1.5 * n / 4
