"""What the plans of some queries must and must not hold."""

import pytest
from conftest import SF

from loomgraph.plans import registry

QUERIES = registry.queries()
#: They run jobs while they are built; their plans are those of tables already written.
EAGER = {n for n in QUERIES if n.startswith("p5_")}


def plan(spark, name):
    return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_cartesian_product(spark, name):
    assert "CartesianProduct" not in plan(spark, name)


def test_filters_and_columns_reach_the_scan(spark):
    p = plan(spark, "filter_source")
    assert "EqualTo(source,forum-north)" in p and "ReadSchema: struct<doc_id:bigint,source:string>" in p and "Exchange" not in p
    assert "text" not in plan(spark, "distinct_dimensions").split("ReadSchema")[1]
    assert "search_text" not in plan(spark, "exact_node_lookup").split("ReadSchema:")[-1]


def test_scores_stay_with_the_documents(spark):
    """Between the postings and the scores of a query there is no exchange but the one that spreads the documents."""
    p = plan(spark, "bm25_scores")
    postings = p[p.index("HashAggregate(keys=[query"):]
    assert postings.count("REPARTITION_BY_NUM") >= 1 and "hashpartitioning(query#" in p and "hashpartitioning(term" not in postings.split("BroadcastExchange")[0]


def test_top_k_is_cut_before_the_shuffle(spark):
    for name in ("bm25_topk", "dense_topk", "overlay_latest"):
        assert plan(spark, name).count("WindowGroupLimit") >= 2, name


def test_long_table_is_summed_before_it_is_joined(spark):
    p = plan(spark, "four_way_lineage_join")
    assert "partial_sum" in p[p.rindex("HashAggregate(keys=[l_suppkey"):]
