"""A typed property graph of a curated collection: building it and checking its closure."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from loomgraph.operators.skew import attach


SCOPE = ("subject_root", "source_id", "source_volume_id")


def build_nodes(units: DataFrame, outline: DataFrame | None = None) -> DataFrame:
    """Subject roots, source volumes, units and evidence of the units, each once.

    ``outline`` adds the chapters and support units: node_id, node_type and the scope columns.
    """
    node = lambda id_, kind, *own: [F.col(id_).alias("node_id"), F.lit(kind).alias("node_type")] + [
        (F.col(c) if c in own else F.lit(None).cast("string")).alias(c) for c in ("subject_root", "source_id", "source_volume_id", "knowledge_unit_id")
    ]
    scope = ("subject_root", "source_id", "source_volume_id")
    evidence = units.withColumn("ref", F.explode("evidence_refs"))
    parts = [
        units.select(*node("subject_root", "subject_root", "subject_root")), units.select(*node("source_volume_id", "source_volume", *scope)),
        units.select(*node("knowledge_unit_id", "knowledge_unit", *scope, "knowledge_unit_id")), evidence.select(*node("ref", "evidence", *scope)),
    ]
    if outline is not None:
        parts.append(outline.where(F.col("node_type").isin("chapter", "support_unit")).select("node_id", "node_type", *scope, F.lit(None).cast("string").alias("knowledge_unit_id")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.where("node_id is not null").distinct()


def build_edges(units: DataFrame, outline: DataFrame | None = None, members: DataFrame | None = None, related: DataFrame | None = None) -> DataFrame:
    """root contains volume, volume contains unit, unit supported_by evidence; ids are made of both ends.

    With ``outline`` (see :func:`build_nodes`, and ``chapter_refs``) volumes contain chapters, support units have their
    chapters as context, and a unit hangs from its group of ``members`` (group_id, knowledge_unit_id) in place of its volume if it has one.
    ``related`` (source_node_id, target_node_id) links units with each other or with nodes elsewhere.
    """
    edge = lambda df, a, rel, b: df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(
        F.concat(F.lit("edge:"), a, F.lit(f":{rel}:"), b).alias("edge_id"), F.col(a).alias("source_node_id"), F.col(b).alias("target_node_id"), F.lit(rel).alias("relation")
    )
    evidence = units.withColumn("ref", F.explode("evidence_refs"))
    out = edge(units, "subject_root", "contains", "source_volume_id").unionByName(edge(evidence, "knowledge_unit_id", "supported_by", "ref"))
    loose = units
    if members is not None:
        held = members.join(units.select("knowledge_unit_id"), "knowledge_unit_id", "left_semi")
        out = out.unionByName(edge(held, "group_id", "contains", "knowledge_unit_id"))
        loose = units.join(held.select("knowledge_unit_id"), "knowledge_unit_id", "left_anti")
    out = out.unionByName(edge(loose, "source_volume_id", "contains", "knowledge_unit_id"))
    if outline is not None:
        out = out.unionByName(edge(outline.where("node_type = 'chapter'"), "source_volume_id", "contains", "node_id"))
        out = out.unionByName(edge(outline.where("node_type = 'support_unit'").withColumn("ref", F.explode("chapter_refs")), "node_id", "has_chapter_context", "ref"))
    if related is not None:
        out = out.unionByName(edge(related, "source_node_id", "related_to", "target_node_id"))
    return out.distinct()


def normalized_relation(col: str = "relation"):
    return F.coalesce(F.lower(F.trim(F.regexp_replace(col, r"(?U)^\s+|\s+$", ""))), F.lit(""))


def dangling(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """``edge_id, side, node_id`` of edge ends that no node has.

    Names are told apart before they meet the nodes: a name that a third of all edges share is one row in that join, and only names
    without a node go back to the edges.
    """
    ends = edges.select("edge_id", F.explode(F.array(F.struct(F.lit("source").alias("side"), F.col("source_node_id").alias("node_id")), F.struct(F.lit("target").alias("side"), F.col("target_node_id").alias("node_id")))).alias("x")).select("edge_id", "x.*")
    ends = ends.where("node_id is not null").distinct()
    lost = ends.select("node_id").distinct().join(nodes.select("node_id").distinct(), "node_id", "left_anti")
    return attach(ends, lost, "node_id").select("edge_id", "side", "node_id")


#: Which relation may lead from which type to which (fixed values of the data model).
ALLOWED = [
    ("subject_root", "source_volume", "contains"), ("source_volume", "chapter", "contains"), ("source_volume", "support_unit", "contains"),
    ("chapter", "knowledge_unit", "contains"), ("support_unit", "chapter", "has_chapter_context"), ("support_unit", "knowledge_unit", "contains"),
    ("knowledge_unit", "evidence", "supported_by"), ("knowledge_unit", "knowledge_unit", "related_to"),
]


def layer_violations(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """``edge_id, source_type, target_type, relation`` of edges between known nodes that no rule allows."""
    kinds = nodes.where("node_id is not null").groupBy("node_id").agg(F.min("node_type").alias("kind"))
    rules = edges.sparkSession.createDataFrame(ALLOWED, "source_type string, target_type string, relation string")
    typed = edges.select("edge_id", "source_node_id", "target_node_id", normalized_relation().alias("relation")).distinct()
    for end in ("source", "target"):
        typed = attach(typed, kinds.select(F.col("node_id").alias(f"{end}_node_id"), F.col("kind").alias(f"{end}_type")), f"{end}_node_id")
    # eight rules
    return typed.join(F.broadcast(rules), ["source_type", "target_type", "relation"], "left_anti").select("edge_id", "source_type", "target_type", "relation").distinct()


def scope_mismatch(edges: DataFrame, nodes: DataFrame, column: str = "source_volume_id") -> DataFrame:
    """``contains`` edges whose two ends lie in different scopes."""
    scope = nodes.where("node_id is not null").groupBy("node_id").agg(F.min(column).alias("scope"))
    held = edges.where(normalized_relation() == "contains").select("edge_id", "source_node_id", "target_node_id").distinct()
    both = held.join(scope.select(F.col("node_id").alias("source_node_id"), F.col("scope").alias("a")), "source_node_id").join(scope.select(F.col("node_id").alias("target_node_id"), F.col("scope").alias("b")), "target_node_id")
    return both.where("a <> b").select("edge_id", F.col("a").alias("source_scope"), F.col("b").alias("target_scope"))


def dependency_violations(df: DataFrame, key: str, *depends: str) -> DataFrame:
    """Keys with more than one definition."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count_distinct(F.struct(*depends)).alias("n_definitions")).where("n_definitions > 1")


def relation_split(edges: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Edges with ``internal``: whether the target is one of the ids."""
    known = ids.select(F.col(key).alias("target_node_id")).where("target_node_id is not null").distinct().withColumn("known", F.lit(True))
    return attach(edges, known, "target_node_id", how="left").withColumn("internal", F.coalesce("known", F.lit(False))).drop("known")
