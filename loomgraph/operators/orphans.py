"""References to records that do not exist, were withdrawn, or were recorded only later.

References are pre-aggregated per key and period before anything is joined, so a key that a third of
all rows name is a handful of rows by then.  Keys above ``total / heavy_parts`` references are heavy: at
most ``heavy_parts`` of them can exist, so their verdicts are broadcast; the other keys go through a
shuffled anti-join on key.  Both orphan sets are united, and only orphan keys are carried back to the
references that name them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from loomgraph.workspace import Workspace


def references(df: DataFrame, ref_table: str, kind: str, ref_key: str, missing_key: str) -> DataFrame:
    """References of one table in the common form; a null key is no reference, an empty string is one."""
    return df.select(
        F.lit(ref_table).alias("ref_table"), F.lit(kind).alias("kind"), F.col(ref_key).alias("ref_key"),
        F.col(missing_key).alias("missing_key"), F.col("recorded_at").alias("recorded_at"),
    ).where(F.col("missing_key").isNotNull())


def targets(df: DataFrame, kind: str, key: str) -> DataFrame:
    return df.select(F.lit(kind).alias("kind"), F.col(key).alias("missing_key"), "withdrawn_at", "recorded_at").where(F.col(key).isNotNull())


def _verdicts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("kind", "missing_key").agg(
        F.max(F.col("withdrawn_at").isNotNull()).alias("gone"), F.max("recorded_at").alias("known_at"),
    )


def _late(at: str) -> Column:
    return F.coalesce(F.col(at) < F.col("known_at"), F.lit(False))


def find_orphans(refs: DataFrame, known: DataFrame, heavy_parts: int | None = None) -> DataFrame:
    """Every orphan reference row: ``ref_table, ref_key, missing_key, period, reason``, without repeats.

    ``refs`` comes from :func:`references`, ``known`` from :func:`targets` (unions of them).  ``reason``
    is ``missing`` (no target has the key), ``withdrawn`` (a target row of it has ``withdrawn_at``) or
    ``later`` (a target row was recorded after the reference).  ``period`` is the month of the
    reference, null where its time is null; such a reference is never ``later``.  Null keys are no
    references, empty keys are; an empty target table makes every reference ``missing``; empty
    references give no rows; repeated rows count once; other columns play no part.
    """
    spark = refs.sparkSession
    ws = Workspace(spark, "orphans")
    parts = heavy_parts or 4 * max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    refs = refs.withColumn("period", F.date_format(F.date_trunc("month", "recorded_at"), "yyyy-MM"))
    per = ws.write(
        refs.groupBy("kind", "missing_key", "period").agg(F.count(F.lit(1)).alias("n"), F.min("recorded_at").alias("first_at")), "per_key_period",
    )
    total = per.agg(F.sum("n")).first()[0] or 0
    # fewer than `parts` keys can pass this bar, whatever the data hold
    heavy = (
        per.groupBy("kind", "missing_key").agg(F.sum("n").alias("n"))
        .where(F.col("n") * parts > total).select("kind", "missing_key")
    )
    heavy_rows = heavy.collect()

    def orphan_keys(groups: DataFrame, judged: DataFrame) -> DataFrame:
        return (
            groups.join(judged, ["kind", "missing_key"], "left")
            .withColumn("reason", F.when(F.col("gone").isNull(), "missing").when(F.col("gone"), "withdrawn").when(_late("first_at"), "later"))
            .where("reason is not null").select("kind", "missing_key", "reason", "known_at").distinct()
        )

    def carry_back(rows: DataFrame, keys: DataFrame) -> DataFrame:
        return (
            rows.join(keys, ["kind", "missing_key"])
            .where((F.col("reason") != "later") | _late("recorded_at"))
            .select("ref_table", "ref_key", "missing_key", "period", "reason")
        )

    if not heavy_rows:
        return carry_back(refs, orphan_keys(per, _verdicts(known))).distinct()
    hot = F.broadcast(spark.createDataFrame(heavy_rows, heavy.schema))
    on = ["kind", "missing_key"]
    hot_keys = orphan_keys(per.join(hot, on, "left_semi"), F.broadcast(_verdicts(known.join(hot, on, "left_semi"))))
    rest_keys = orphan_keys(per.join(hot, on, "left_anti"), _verdicts(known.join(hot, on, "left_anti")))
    found_hot = carry_back(refs.join(hot, on, "left_semi"), F.broadcast(hot_keys))
    found_rest = carry_back(refs.join(hot, on, "left_anti"), rest_keys)
    return found_hot.unionByName(found_rest).distinct()


def orphans_per_period(orphans: DataFrame) -> DataFrame:
    """Number of orphan references per table and month, split by reason."""
    one = orphans.select("ref_table", "period", "ref_key", "missing_key", "reason").distinct()
    count = lambda why: F.sum(F.when(F.col("reason") == why, 1).otherwise(0)).cast("bigint").alias(f"n_{why}")
    return one.groupBy("ref_table", "period").agg(F.count(F.lit(1)).alias("n_orphans"), count("missing"), count("withdrawn"), count("later"))
