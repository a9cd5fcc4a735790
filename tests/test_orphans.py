from datetime import datetime

import pytest

from loomgraph.operators.orphans import find_orphans, orphans_per_period, references, targets

T = lambda m: datetime(2024, m, 5)
REF = "id string, key string, recorded_at timestamp_ntz, kind string, missing_key string"
TARGET = "key string, withdrawn_at timestamp_ntz, recorded_at timestamp_ntz, reason string"


def run(spark, refs, known, **kw):
    r = references(spark.createDataFrame(refs, REF), "t", "k", "id", "key")
    return find_orphans(r, targets(spark.createDataFrame(known, TARGET), "k", "key"), **kw)


KNOWN = [("a", None, T(1), "x"), ("a", None, T(1), "x"), ("gone", T(2), T(1), "x"), ("late", None, T(6), "x"), (None, None, T(1), "x"), ("untimed", None, None, "x")]


def test_reasons_nulls_and_repeats(spark):
    refs = [
        ("1", "a", T(3), "c", "c"), ("2", "nowhere", T(3), "c", "c"), ("2", "nowhere", T(3), "c", "c"), ("3", "gone", T(3), "c", "c"), ("4", "late", T(3), "c", "c"),
        ("5", "late", T(7), "c", "c"), ("6", "late", None, "c", "c"), ("7", None, T(3), "c", "c"), ("8", "", T(3), "c", "c"), (None, "nowhere", None, "c", "c"), ("9", "untimed", T(1), "c", "c"),
        ("5", "late", T(2), "c", "c"), ("10", "late", T(6), "c", "c"),
    ]
    got = {(r.ref_key, r.missing_key, r.reason, r.period) for r in run(spark, refs, KNOWN).collect()}
    assert got == {
        ("2", "nowhere", "missing", "2024-03"), ("3", "gone", "withdrawn", "2024-03"), ("4", "late", "later", "2024-03"), ("8", "", "missing", "2024-03"),
        (None, "nowhere", "missing", None), ("5", "late", "later", "2024-02"),
    }


def test_empty_tables(spark):
    assert run(spark, [], KNOWN).count() == 0
    assert [r.reason for r in run(spark, [("1", "a", T(1), "c", "c")], []).collect()] == ["missing"]


@pytest.mark.parametrize("hot", ["late", "nowhere", "a"])
def test_heavy_keys_take_the_other_way_to_the_same_result(spark, hot):
    refs = [(str(i), hot, T(1 + i % 9), "c", "c") for i in range(3000)] + [(f"x{i}", f"k{i}", T(2), "c", "c") for i in range(500)] + [("y", "gone", T(2), "c", "c")]
    light, heavy = run(spark, refs, KNOWN, heavy_parts=1), run(spark, refs, KNOWN, heavy_parts=50)
    assert sorted(map(repr, light.collect())) == sorted(map(repr, heavy.collect()))
    counts = orphans_per_period(heavy).collect()
    assert sum(r.n_orphans for r in counts) == heavy.count()


def test_both_ways_are_taken_on_the_test_tables(spark):
    """The hottest key of the tables is heavy whatever their size, and most keys are not."""
    from conftest import SF

    from loomgraph.plans import dealt

    plan = dealt.p1_found(spark, SF)._jdf.queryExecution().analyzed().toString()
    assert "LeftSemi" in plan and "LeftAnti" in plan
