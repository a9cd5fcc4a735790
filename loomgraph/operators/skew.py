"""Joins with tables of unique keys that stay balanced where a key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: A key with so many rows is hot: what it is joined with is broadcast, and there are at most rows / HOT_ROWS of them.
HOT_ROWS = 200_000


def hot_keys(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> tuple[int, list]:
    """Number of rows, and the keys of at least ``hot_rows`` of them; one pass, summed per key before the shuffle."""
    per = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    r = per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.collect_list(F.when(F.col("n") >= hot_rows, F.col(key))).alias("hot")).first()
    return r["n"], r["hot"]


def attach(left: DataFrame, right: DataFrame, key: str, hot: list | None = None, how: str = "inner", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Join with a table whose keys are unique; rows of hot keys stay where they are and get theirs by broadcast.

    ``hot`` are the hot keys if they are known.  ``how`` is inner or left; null keys match nothing.
    """
    hot = hot_keys(left, key, hot_rows)[1] if hot is None else hot
    if not hot:
        return left.join(right, key, how)
    keys = F.broadcast(left.sparkSession.createDataFrame([(k,) for k in hot], left.select(key).schema))
    warm = left.join(keys, key, "left_semi").join(F.broadcast(right.join(keys, key, "left_semi")), key, how)
    return warm.unionByName(left.join(keys, key, "left_anti").join(right.join(keys, key, "left_anti"), key, how))
