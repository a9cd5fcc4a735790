"""Reciprocal-rank fusion of ranked channels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from loomgraph.workspace import Workspace

RRF_K = 60


def numbered(df: DataFrame, *order: Column) -> DataFrame:
    """``df`` with ``position``, from 1, in a global order.

    Rows are ranged over many tasks and numbered in each; the sizes of the tasks before, one row per task, are added.
    """
    ws = Workspace(df.sparkSession, "numbered")
    ranged = ws.write(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranged")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    own = ranged.withColumn("position", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    return own.join(F.broadcast(base), "_part").withColumn("position", F.col("position") + F.col("_base")).drop("_part", "_base")


def rank_units(best: DataFrame, digits: int = 9) -> DataFrame:
    """Rank of every unit per query: highest score, then smallest id; ``best`` has ``query, unit, doc, score``."""
    w = Window.partitionBy("query").orderBy(F.round("score", digits).desc(), "unit")
    return best.withColumn("rank", F.row_number().over(w))


def first_places(lexical, dense, k: int, ws: Workspace) -> list[DataFrame]:
    """The first 60 + 2k units of each channel, written: what :func:`fuse_best` needs for the first ``k``."""
    return [ws.write(c.top(RRF_K + 2 * k), name) for c, name in ((lexical, "lexical"), (dense, "dense"))]


def fuse_best(lexical, dense, k: int, ws: Workspace, tops: list[DataFrame] | None = None) -> DataFrame:
    """:func:`fuse` of two prepared channels (``top`` and ``ranks``), the first ``k``, without ranking every unit.

    With m = 60 + 2k, a unit beyond place m in both channels has at most 2 / (61 + m) = 1 / (60.5 + k), less than the 1 / (60 + k) that k units
    of either channel reach alone; if neither has k units, both are listed whole.  So the first k are among the units of the first m
    places of either channel, and only the ranks that those lack in the other one are looked up.
    """
    tops = tops or first_places(lexical, dense, k, ws)
    keys = [t.select("query", "unit") for t in tops]
    on = lambda a, b: (a["query"] == b["query"]) & a["unit"].eqNullSafe(b["unit"])
    whole = []
    for c, own, other in ((lexical, 0, 1), (dense, 1, 0)):
        lacking = keys[other].join(keys[own], on(keys[other], keys[own]), "left_anti")
        whole.append(tops[own].unionByName(c.ranks(lacking)))
    return fuse(*whole, k)


def fuse(lexical: DataFrame, dense: DataFrame, k: int | None = None) -> DataFrame:
    """``query, unit, rrf, doc, channel_score, rank`` from two rankings of :func:`rank_units`.

    A unit's score is the sum of 1 / (60 + rank) over the channels that rank it; its chunk and channel score are
    the dense channel's where it has the unit.
    """
    side = lambda df, n: df.select("query", "unit", F.lit(n).alias("channel"), "rank", "doc", "score")
    both = side(lexical, 1).unionByName(side(dense, 0))
    fused = both.groupBy("query", "unit").agg(
        F.round(F.sum(1.0 / (RRF_K + F.col("rank"))), 12).alias("rrf"), F.min_by(F.struct("doc", "score"), "channel").alias("pick"),
    )
    ranked = fused.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("rrf"), "unit")))
    ranked = ranked if k is None else ranked.where(F.col("rank") <= k)
    return ranked.select("query", "unit", "rrf", F.col("pick.doc").alias("doc"), F.col("pick.score").alias("channel_score"), "rank")
