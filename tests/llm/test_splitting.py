from hypothesis import given, settings, strategies as st

from loomgraph.llm.splitting import BALANCED, plan_cuts, split_oversized

ENDS = "。！？!?；;.\n"


def greedy(text, n):
    out, s = [], 0
    while n - s > 600:
        e = next((s + k for k in range(600, 359, -1) if s + k <= len(text) and text[s + k - 1] in ENDS), s + 600)
        out.append((s, e))
        s = e - 60
    return out + [(s, n)]


@given(st.lists(st.sampled_from(["a" * 50, "b" * 7 + ".", "。", "x" * 130 + "\n", "y" * 700]), min_size=1, max_size=40))
@settings(max_examples=200, deadline=None)
def test_longest_first_is_the_greedy_rule(parts):
    text = "".join(parts)
    assert plan_cuts(text, len(text)) == greedy(text, len(text))


def cost(text, plan, n, limit, even):
    total = 0.0
    for a, b in plan:
        cut = 0.0 if b == n else BALANCED.forced if text[b - 1] not in ENDS else BALANCED.line if text[b - 1] == "\n" else BALANCED.sentence
        total += cut + ((b - a - even) / limit) ** 2
    return total


@given(st.text(alphabet="ab.\n", min_size=1, max_size=60))
@settings(max_examples=150, deadline=None)
def test_balanced_is_the_cheapest_plan(text):
    n, limit, overlap, least = len(text), 12, 2, 4
    pieces = max(1, -(-(n - overlap) // (limit - overlap)))
    even = (n + (pieces - 1) * overlap) / pieces

    def plans(s):
        if n - s <= limit:
            yield [(s, n)]
            return
        ends = [e for e in range(s + least, s + limit + 1) if text[e - 1] in ENDS] or [s + limit]
        for e in ends:
            for rest in plans(e - overlap):
                yield [(s, e), *rest]

    some = [p for _, p in zip(range(3000), plans(0))]
    got = plan_cuts(text, n, limit, overlap, least, BALANCED)
    assert got[0][0] == 0 and got[-1][1] == n and all(c == b - overlap for (_, b), (c, _) in zip(got, got[1:]))
    if len(some) < 3000:
        assert abs(cost(text, got, n, limit, even) - min(cost(text, p, n, limit, even) for p in some)) < 1e-9


def test_rows(spark):
    text = ("a" * 399 + "。") * 10
    units = [("u", text, None, "t"), ("u", text, None, "t"), ("n", None, None, "t"), (None, "x" * 700, None, "t")]
    u = spark.createDataFrame(units, "knowledge_unit_id string, text string, recorded_at timestamp_ntz, chunk_id string")
    rows = [("c1", "u", 0, 1500), ("c1", "u", 0, 1500), ("c2", "u", 100, 700), ("c3", "n", 0, 650), ("c4", "missing", 5, 1206), ("c5", "u", None, 900), ("c6", "u", 3900, 4700), (None, "u", 0, 601), ("c7", "u", -10, 700)]
    c = spark.createDataFrame([(*r, "y") for r in rows], "chunk_id string, knowledge_unit_id string, body_start int, body_end int, text string")
    got = {}
    for r in split_oversized(c, u).collect():
        got.setdefault(r.chunk_id, []).append((r.piece_no, r.body_start, r.body_end))
    got = {k: [x[1:] for x in sorted(v)] for k, v in got.items()}
    assert got["c1"] == [(a, b) for a, b in greedy(text[:1500], 1500)]
    assert got["c3"] == [(0, 600), (540, 650)] and got["c4"] == [(5, 605), (545, 1145), (1085, 1206)]
    assert got["c6"][0][0] == 3900 and got["c6"][-1][1] == 4700 and None in got and "c2" not in got and "c5" not in got
    assert got["c7"] == [(-10, 590), (530, 700)]
    assert split_oversized(c.where("false"), u).count() == 0 and split_oversized(c, u.where("false")).count() > 0
    even = split_oversized(c.where("chunk_id = 'c1'"), u, least=200, cost=BALANCED).orderBy("piece_no").collect()
    assert [r.piece_no for r in even] == list(range(even[0].piece_count))
    assert max(r.body_end - r.body_start for r in even) <= 600


def test_longest_first_weighs_the_first_piece_above_all_others():
    """The cheapest plan takes the longest first piece even where that costs the later ones most."""
    text = "x" * 599 + "." + "y" * 299 + "。" + "z" * 500
    assert plan_cuts(text, len(text)) == [(0, 600), (540, 900), (840, 1400)]
    text = "a" * 399 + "." + "b" * 199 + "." + "c" * 900
    assert plan_cuts(text, len(text))[0] == (0, 600)


def test_very_long_spans_of_many_ends():
    text = "ab." * 70_000
    plan = plan_cuts(text, len(text))
    assert plan == greedy(text, len(text)) and len(plan) > 380
