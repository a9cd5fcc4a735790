"""Ranking metrics per query and per role.

``rankings``: query, rank (from 1), id.  ``queries``: query, role, and ``qrels``: query, id, kind with kinds
primary, context and must_not.  Roles: any_hit, all_relevant, negative, relation_only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from loomgraph.operators.current import IntegrityError

ROLES = ("any_hit", "all_relevant", "negative", "relation_only")


def diagnose(queries: DataFrame, qrels: DataFrame, rankings: DataFrame, k: int = 20, mrr_k: int = 10, ndcg_k: int = 10) -> DataFrame:
    """One row per query; metrics are null for the roles they don't apply to.

    Every query comes out, also without hits.  Repeated qrels count once.
    """
    if min(k, mrr_k, ndcg_k) <= 0:
        raise ValueError("metric cutoffs must be positive")
    rel = qrels.select("query", "id", "kind").distinct()
    hit = rankings.join(rel, ["query", "id"])
    at = lambda kind, cut: (F.col("kind") == kind) & (F.col("rank") <= cut)
    per = hit.groupBy("query").agg(
        F.min(F.when(at("primary", max(k, mrr_k)), F.col("rank"))).alias("first"),
        F.count(F.when(at("primary", k), 1)).alias("hits"),
        F.sum(F.when(at("primary", ndcg_k), 1.0 / F.log2(F.col("rank") + 1.0))).alias("dcg"),
        F.array_sort(F.collect_list(F.when(at("must_not", k), F.struct("rank", "id")))).alias("bad"),
        F.array_sort(F.collect_list(F.when(at("context", k), F.col("rank")))).alias("context_ranks"),
    )
    size = rel.where("kind = 'primary'").groupBy("query").agg(F.count(F.lit(1)).alias("n_primary"))
    d = queries.select("query", "role").join(per, "query", "left").join(size, "query", "left").withColumn("n_primary", F.coalesce("n_primary", F.lit(0)))
    positive, every, negative = F.col("role").isin("any_hit", "all_relevant"), F.col("role") == "all_relevant", F.col("role") == "negative"
    ideal = F.aggregate(F.sequence(F.lit(1), F.greatest(F.lit(1), F.least("n_primary", F.lit(ndcg_k)).cast("int"))), F.lit(0.0), lambda s, i: s + 1.0 / F.log2(i + 1.0))
    hits = F.coalesce("hits", F.lit(0))
    return d.select(
        "query", "role", "n_primary",
        F.when(positive, hits > 0).alias("hit"), F.when(positive, F.col("first")).alias("first_rank"),
        F.when(positive, F.when(F.col("first") <= mrr_k, 1.0 / F.col("first")).otherwise(0.0)).alias("mrr"),
        F.when(positive, F.coalesce(F.col("first") == 1, F.lit(False))).alias("rank1"),
        F.when(every & (F.col("n_primary") > 0), hits / F.col("n_primary")).alias("recall"),
        F.when(every & (F.col("n_primary") > 0), F.coalesce("dcg", F.lit(0.0)) / ideal).alias("ndcg"),
        F.when(negative, F.coalesce(F.size("bad") <= 0, F.lit(True))).alias("clean"),
        F.when(negative, F.coalesce(F.col("bad.id"), F.array().cast("array<string>"))).alias("violations"),
        F.coalesce("context_ranks", F.array().cast("array<int>")).alias("context_ranks"),
    )


def aggregate(diagnostics: DataFrame, *by: str) -> DataFrame:
    """Means over the queries a metric applies to, null over none."""
    share = lambda c: F.avg(F.col(c).cast("double"))
    return diagnostics.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_cases"), share("hit").alias("hit_at_k"), share("mrr").alias("mrr_at_k"), share("rank1").alias("rank1_rate"),
        share("recall").alias("recall_at_k"), share("ndcg").alias("ndcg_at_k"), share("clean").alias("clean_rate"),
    )


def role_counts(queries: DataFrame) -> DataFrame:
    """``role, n`` for every role, also those without a query."""
    roles = queries.sparkSession.createDataFrame([(r,) for r in ROLES], "role string")
    return roles.join(queries.groupBy("role").agg(F.count(F.lit(1)).alias("n")), "role", "left").select("role", F.coalesce("n", F.lit(0)).alias("n"))


def summary(results: DataFrame, *by: str) -> DataFrame:
    """Means over all queries: one without a valid result counts as a miss."""
    mean = lambda c: (F.sum(F.coalesce(F.col(c).cast("double"), F.lit(0.0))) / F.count(F.lit(1)))
    return results.groupBy(*by).agg(F.count(F.lit(1)).alias("n_cases"), mean("hit").alias("hit_rate"), mean("mrr").alias("mrr"), mean("rank1").alias("rank1_rate"))


def input_violations(queries: DataFrame, qrels: DataFrame, rankings: DataFrame) -> DataFrame:
    """``query, problem``: unknown roles, repeated queries, ids that are both primary and must_not, ranks given twice, rankings of unknown queries, queries without one."""
    rel = qrels.select("query", "id", "kind").distinct()
    both = rel.where("kind in ('primary', 'must_not')").groupBy("query", "id").count().where("count > 1")
    p = lambda df, what: df.select("query", F.lit(what).alias("problem")).distinct()
    parts = [
        p(queries.where(~F.col("role").isin(*ROLES) | F.col("role").isNull()), "unknown role"), p(queries.groupBy("query").count().where("count > 1"), "repeated query"),
        p(both, "primary and must_not"), p(rankings.groupBy("query", "id").count().where("count > 1"), "id ranked twice"),
        p(rankings.join(queries.select("query"), "query", "left_anti"), "unknown query"), p(queries.join(rankings.select("query").distinct(), "query", "left_anti"), "no ranking"),
    ]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


def over_limit(rankings: DataFrame, k: int, *by: str) -> DataFrame:
    """Requests that were given more than k results; such a ranking is invalid, and only its first k may be looked at."""
    return rankings.groupBy(*by).agg(F.count(F.lit(1)).alias("n_results")).where(F.col("n_results") > k)


def demand_valid(queries: DataFrame, qrels: DataFrame, rankings: DataFrame) -> None:
    """Raise on a judged set that contradicts itself; a query without a ranking is a miss, not a contradiction."""
    first = input_violations(queries, qrels, rankings).where("problem <> 'no ranking'").orderBy("problem", "query").limit(1).collect()
    if first:
        raise IntegrityError(f"{first[0]['problem']}: {first[0]['query']}")


def evaluate(queries: DataFrame, qrels: DataFrame, rankings: DataFrame, k: int = 20, **cutoffs: int) -> DataFrame:
    """:func:`diagnose` with ``error``, for a judged set that is valid; one that isn't is refused.

    A ranking of more than k results is an error and scores nothing.  If ``rankings`` has ``errors`` (an array, as :func:`verified` gives it),
    results with any are no hits.
    """
    demand_valid(queries, qrels, rankings)
    over = over_limit(rankings, k, "query").select("query", F.lit(f"more than {k} results").alias("error"))
    counted = rankings if "errors" not in rankings.columns else rankings.where(F.size("errors") == 0)
    scored = diagnose(queries, qrels, counted.join(over.select("query"), "query", "left_anti"), k=k, **cutoffs)
    return scored.join(over, "query", "left")


def verified(results: DataFrame, returned: str, units: DataFrame, fields: list[str], key: str = "knowledge_unit_id", text: str = "text", stored: str = "text_sha256") -> DataFrame:
    """``results`` with ``text_sha256`` and ``errors``: how the unit that came with each result departs from the unit of record.

    ``returned`` is a struct column with ``key`` and the fields.  An error is the name of a field that differs (null equals null), ``stored`` where
    the stored hash isn't that of the returned text, or "unknown unit".  The complete units stay behind: what comes out holds no body.
    """
    got = F.col(returned)
    truth = units.select(F.col(key).alias("_key"), F.struct(*fields).alias("_truth"))
    joined = results.withColumn("_key", got[key]).join(truth, "_key", "left")
    differs = [F.when(~got[f].eqNullSafe(F.col("_truth")[f]), F.lit(f)) for f in fields]
    hashed = F.when(~F.sha2(got[text], 256).eqNullSafe(F.lower(got[stored])), F.lit(stored))
    errors = F.when(F.col("_truth").isNull(), F.array(F.lit("unknown unit"))).otherwise(F.array_compact(F.array(*differs, hashed)))
    return joined.withColumn("text_sha256", F.lower(got[stored])).withColumn("errors", errors).drop("_key", "_truth", returned)


def regressions(baseline: DataFrame, candidate: DataFrame, by: list[str], metrics: list[str], tolerance: float = 1e-9) -> DataFrame:
    """``by, metric, baseline, candidate, regressed`` for every slice of the baseline; a slice that the candidate lacks has regressed."""
    long = lambda df, name: df.select(*by, F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias(name)) for m in metrics])).alias("x")).select(*by, "x.*")
    both = long(baseline, "baseline").join(long(candidate, "candidate"), [*by, "metric"], "left")
    worse = F.col("baseline").isNotNull() & ~F.coalesce(F.col("candidate") >= F.col("baseline") - tolerance, F.lit(False))
    return both.withColumn("regressed", worse)


def replay_diff(left: DataFrame, right: DataFrame, keys: list[str], k: int = 5) -> DataFrame:
    """Keys whose ranked id lists differ in the first k places, with both lists; a key on one side only differs."""
    lists = lambda df, name: df.where(F.col("rank") <= k).groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "id"))), lambda x: x.id).alias(name))
    return lists(left, "stored").join(lists(right, "recomputed"), keys, "full_outer").where(~F.col("stored").eqNullSafe(F.col("recomputed")))
