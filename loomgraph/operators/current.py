"""The latest state of keyed rows, and combined tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


class IntegrityError(ValueError):
    """A table breaks a rule that a load demands."""


def latest(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """One row per key, the first by ``order``; rows with a null key are dropped.

    The group-limited window keeps one row per key and partition before the shuffle, so hot keys of
    repeated rows cost one row each.
    """
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    return df.withColumn("_place", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_place") == 1).drop("_place")


def current_units(units: DataFrame) -> DataFrame:
    """The latest row of each unit; of several at one time the smallest text hash, so texts need not be read to choose."""
    return latest(units, ["knowledge_unit_id"], F.desc_nulls_last("recorded_at"), F.asc_nulls_first("text_sha256"))


def current_chunks(chunks: DataFrame) -> DataFrame:
    """The latest row of each chunk; of several at one time the smallest text hash and span."""
    return latest(chunks, ["chunk_id"], F.desc_nulls_last("recorded_at"), F.asc_nulls_first("full_text_sha256"), F.asc_nulls_first("body_start"), F.asc_nulls_first("body_end"))


def collection(bundles: dict[str, DataFrame], key: str) -> DataFrame:
    """Union of bundles with their ``bundle_id``; a key that two bundles share is an error found by :func:`shared_keys`."""
    out = None
    for name, df in bundles.items():
        part = df.withColumn("bundle_id", F.lit(name))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def shared_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur in more than one bundle."""
    return df.groupBy(key).agg(F.count_distinct("bundle_id").alias("n_bundles")).where("n_bundles > 1")


def assert_empty(violations: DataFrame, what: str) -> None:
    first = violations.limit(1).collect()
    if first:
        raise IntegrityError(f"{what}: {first[0].asDict()}")
