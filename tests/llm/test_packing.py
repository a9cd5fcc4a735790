import random

import numpy as np
import pytest

from loomgraph.llm import packing as P
from loomgraph.llm.tokens import load


@pytest.mark.parametrize("seed", range(4))
def test_plans_use_every_piece_once_within_capacity(seed):
    rng = random.Random(seed)
    h = {}
    for _ in range(rng.choice([1, 50, 3000])):
        s = min(2048, max(1, int(rng.lognormvariate(5.5, 1.2))))
        h[s] = h.get(s, 0) + 1
    plan = P.plan_packing(h)
    used = {}
    for times, items in plan.patterns:
        assert sum(s * n for s, n in items) <= 2048
        for s, n in items:
            used[s] = used.get(s, 0) + times * n
    assert used == h
    total = sum(s * n for s, n in h.items())
    assert plan.containers <= max(-(-total // 2048) * 1.01 + 1, 1) or total < 2048 * 20


def test_plan_of_a_huge_corpus_stays_short():
    plan = P.plan_packing({s: 10**9 + s for s in range(1, 2049)})
    assert len(plan.patterns) < 6000


def test_documents(spark):
    texts = ["word " * n for n in (3, 10, 500, 2047, 2048, 5000, 7)] + [None, "", "塔板效率" * 200] + ["same length here"] * 400
    df = spark.createDataFrame([(i, t, 1, "q") for i, t in enumerate(texts)] + [(None, "x", 1, "q")], "doc_id bigint, text string, piece_no int, size string").repartition(5)
    got = P.pack_documents(df).collect()
    n = dict(enumerate(load().count([t or "" for t in texts]).tolist()))
    per, boxes = {}, {}
    for r in got:
        per.setdefault(r.doc_id, []).append((r.first_token, r.n_tokens))
        if r.n_tokens:
            boxes.setdefault(r.container_id, []).append((r.position, r.n_tokens))
    assert len(per) == len(texts) + 1
    for i, size in n.items():
        pieces = sorted(per[i])
        assert sum(k for _, k in pieces) == size and (len(pieces) == 1 or size > 2048)
        assert all(a + k == b for (a, k), (b, _) in zip(pieces, pieces[1:]))
    for items in boxes.values():
        items.sort()
        assert items[0][0] == 0 and items[-1][0] + items[-1][1] <= 2048
        assert all(a + k <= b for (a, k), (b, _) in zip(items, items[1:]))
    assert sorted(boxes) == list(range(len(boxes)))
    report = P.packing_report(P.pack_documents(df)).first()
    assert report.n_containers == len(boxes) and report.fullest <= 2048
    assert P.pack_documents(df.where("false")).count() == 0
    assert {(r.n_tokens, r.container_id) for r in P.pack_documents(df.where("text is null")).collect()} == {(0, 0)}
    exact = P.pack_documents(df.where("doc_id = 4"), capacity=64).collect()
    assert max(r.n_tokens for r in exact) == 64 and len({r.container_id for r in exact}) == len(exact)


def test_step_groups_are_even(spark):
    rng = random.Random(3)
    df = spark.createDataFrame([(i, "word " * max(1, int(rng.lognormvariate(5, 1)))) for i in range(1500)], "doc_id bigint, text string")
    work, boxes = {}, {}
    for r in P.pack_documents(df, group=8).collect():
        work[r.step_group] = work.get(r.step_group, 0) + r.n_tokens**2
        boxes.setdefault(r.step_group, set()).add(r.container_id)
    full = [work[g] for g in work if len(boxes[g]) == 8]
    assert len(full) >= 5 and max(full) <= 1.25 * min(full)
    assert max(map(len, boxes.values())) <= 8


def histogram(seed, n=3000):
    rng = random.Random(seed)
    h = {}
    for _ in range(n):
        s = min(2048, max(1, int(rng.lognormvariate(5.5, 1.2))))
        h[s] = h.get(s, 0) + 1
    return h


def test_tiers_change_the_plan():
    h = histogram(9)
    plans = [P.plan_packing(h, tiers=t) for t in (P.TIERS, (), (100, 300, 1500))]
    assert all(a.patterns != b.patterns for i, a in enumerate(plans) for b in plans[:i])
    assert P.plan_packing(h, tiers=(2048, 256, 512, 0, 1024, 256)) == plans[0]


def test_each_tier_is_packed_with_its_own_before_shorter_ones():
    """Windows come from the longest tier that has pieces; 700 + 548 + 800 is full without the shorter pieces that longest-first would take."""
    plan = P.plan_packing({1030: 1, 700: 1, 548: 1, 800: 1, 500: 2, 18: 1, 48: 1}, tiers=(512, 1024, 2048))
    assert [dict(items) for _, items in plan.patterns] == [{1030: 1, 500: 2, 18: 1}, {800: 1, 700: 1, 548: 1}, {48: 1}]


@pytest.mark.parametrize("seed", range(30))
def test_fullest_is_exact(seed):
    rng = random.Random(seed)
    left = np.zeros(200, np.int64)
    for _ in range(rng.randrange(1, 9)):
        left[rng.randrange(1, 90)] += rng.randrange(1, 4)
    room, low, high = rng.randrange(1, 199), rng.choice([0, 0, 20]), rng.choice([60, 150])
    sums = {0}
    for s in range(low + 1, high + 1):
        for _ in range(left[s]):
            sums |= {x + s for x in sums}
    got = P._fullest(room, left, low, high)
    assert sum(got) == max(x for x in sums if x <= room)
    assert all(low < s <= high and got.count(s) <= left[s] for s in got)


def test_room_left_is_the_least_possible():
    for seed in range(6):
        h = histogram(seed, 4000)
        assert P.plan_packing(h).containers == -(-sum(s * n for s, n in h.items()) // 2048)
