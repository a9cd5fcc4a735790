"""The p1_ and p5_ queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from loomgraph.operators.hierarchy import build_hierarchy, descendant_counts, descendants, links_of, paths
from loomgraph.operators.orphans import find_orphans, orphans_per_period, references, targets
from loomgraph.workspace import table


def _orphans(spark: SparkSession, d: str) -> DataFrame:
    refs = references(table(spark, d, "kg_edges"), "kg_edges", "node", "edge_id", "target_node_id")
    refs = refs.unionByName(references(table(spark, d, "chunk_to_kg"), "chunk_to_kg", "unit", "chunk_id", "knowledge_unit_id"))
    refs = refs.unionByName(references(table(spark, d, "external_references"), "external_references", "unit", "reference_id", "from_knowledge_unit_id"))
    known = targets(table(spark, d, "kg_nodes"), "node", "node_id").unionByName(targets(table(spark, d, "shared_nodes"), "node", "node_id"))
    return find_orphans(refs, known.unionByName(targets(table(spark, d, "knowledge_units"), "unit", "knowledge_unit_id")))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return _orphans(spark, d).select("ref_table", "ref_key", "missing_key").distinct()


def p1_orphans_per_month(spark: SparkSession, d: str) -> DataFrame:
    return orphans_per_period(_orphans(spark, d))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return build_hierarchy(links_of(table(spark, d, "kg_edges"))).select("node_id", "root_node_id", "depth")


def p5_paths(spark: SparkSession, d: str) -> DataFrame:
    rows = paths(build_hierarchy(links_of(table(spark, d, "kg_edges"))))
    return rows.select("node_id", "root_node_id", "depth", F.array_join("path", " > ").alias("path"))


def p5_descendants(spark: SparkSession, d: str) -> DataFrame:
    h = build_hierarchy(links_of(table(spark, d, "kg_edges")))
    return h.where("depth > 0").select("node_id", "descendants")


def p5_closure(spark: SparkSession, d: str) -> DataFrame:
    """Every node of a tree with each of its ancestors: the descendants of every node."""
    rows = paths(build_hierarchy(links_of(table(spark, d, "kg_edges"))))
    return descendants(rows.where("depth > 0"))


def p5_descendants_whole(spark: SparkSession, d: str) -> DataFrame:
    """Every node with the number of nodes below it: roots and nodes below a circle too.

    A circle has no above and below: a node on it has the trees that hang from it, not the others of its circle.
    """
    return descendant_counts(build_hierarchy(links_of(table(spark, d, "kg_edges"))))


def p5_closure_whole(spark: SparkSession, d: str) -> DataFrame:
    """Every node with each of its ancestors; below a circle they end with the circle's node above it."""
    return descendants(paths(build_hierarchy(links_of(table(spark, d, "kg_edges")))))


def p5_cycles(spark: SparkSession, d: str) -> DataFrame:
    h = build_hierarchy(links_of(table(spark, d, "kg_edges")))
    return h.where("depth = -1").select(F.col("root_node_id").alias("cycle_id"), "node_id", "parent_id")


QUERIES = {f.__name__: f for f in (p1_found, p1_orphans_per_month, p5_found, p5_paths, p5_descendants, p5_closure, p5_descendants_whole, p5_closure_whole, p5_cycles)}

_REFS = """
with refs as (
  select 'kg_edges' as ref_table, 'node' as kind, edge_id as ref_key, target_node_id as missing_key, recorded_at from kg_edges
  union all select 'chunk_to_kg', 'unit', chunk_id, knowledge_unit_id, recorded_at from chunk_to_kg
  union all select 'external_references', 'unit', reference_id, from_knowledge_unit_id, recorded_at from external_references),
known as (
  select kind, k, bool_or(withdrawn_at is not null) as gone, max(recorded_at) as known_at from (
    select 'node' as kind, node_id as k, withdrawn_at, recorded_at from kg_nodes
    union all select 'node', node_id, withdrawn_at, recorded_at from shared_nodes
    union all select 'unit', knowledge_unit_id, withdrawn_at, recorded_at from knowledge_units)
  group by kind, k),
judged as (
  select r.*, case when k.k is null then 'missing' when k.gone then 'withdrawn' when r.recorded_at < k.known_at then 'later' end as reason,
    strftime(r.recorded_at, '%Y-%m') as period
  from refs r left join known k on k.kind = r.kind and k.k = r.missing_key where r.missing_key is not null)
"""
_LINKS = """
with recursive links as (
  select target_node_id as child, min(source_node_id) as parent from kg_edges
  where lower(trim(relation)) = 'contains' and source_node_id is not null and target_node_id is not null group by 1),
up as (
  select child as node, child as v, parent as p, 1 as d, [child] as seen, parent || ' > ' || child as path from links
  union all
  select u.node, l.child, l.parent, u.d + 1, list_append(u.seen, l.child), l.parent || ' > ' || u.path
  from up u join links l on l.child = u.p where not list_contains(u.seen, u.p)),
ends as (
  select node, p, d, path, seen, list_contains(seen, p) as loops,
    case when list_contains(seen, p) then seen[list_position(seen, p):] end as circle
  from up u where list_contains(seen, p) or not exists (select 1 from links l where l.child = u.p)),
judged as (
  select node, d, path, loops, circle, case when loops then list_min(circle) else p end as root,
    case when not loops then d when list_contains(circle, node) then -1 else -2 end as depth,
    seen, p from ends)
"""
_ABOVE = _LINKS + """, above as (select node as node_id, unnest(case when depth > 0 then list_append(seen[2:], p) else seen[2:list_position(seen, p)] end) as ancestor_id,
        unnest(range(1, case when depth > 0 then len(seen) + 1 else list_position(seen, p) end)) as distance from judged where depth <> -1)"""
ORACLES = {
    "p1_found": _REFS + "select distinct ref_table, ref_key, missing_key from judged where reason is not null",
    "p1_orphans_per_month": _REFS + """select ref_table, period, count(*) as n_orphans, count(*) filter (reason = 'missing') as n_missing,
        count(*) filter (reason = 'withdrawn') as n_withdrawn, count(*) filter (reason = 'later') as n_later
      from (select distinct ref_table, period, ref_key, missing_key, reason from judged where reason is not null) group by 1, 2""",
    "p5_found": _LINKS + "select node as node_id, root as root_node_id, cast(depth as int) as depth from judged",
    "p5_paths": _LINKS + """select node as node_id, root as root_node_id, cast(depth as int) as depth,
        case when depth > 0 then path when depth = -1 then node
             else array_to_string(list_reverse(seen[1:list_position(seen, p)]), ' > ') end as path from judged""",
    "p5_descendants": _LINKS + """select j.node as node_id, (select count(*) from judged k where k.depth > 0 and k.node <> j.node and list_contains(k.seen, j.node)) as descendants
      from judged j where j.depth > 0""",
    "p5_closure": _LINKS + """select ancestor_id, node_id, cast(distance as int) as distance from (
      select node as node_id, unnest(list_append(seen[2:], p)) as ancestor_id, unnest(range(1, len(seen) + 1)) as distance from judged where depth > 0)""",
    "p5_descendants_whole": _ABOVE + """ select n.node_id, count(a.ancestor_id) as descendants from (select child as node_id from links union select parent from links) n
      left join above a on a.ancestor_id = n.node_id group by 1""",
    "p5_closure_whole": _ABOVE + " select ancestor_id, node_id, cast(distance as int) as distance from above",
    "p5_cycles": _LINKS + "select j.root as cycle_id, j.node as node_id, l.parent as parent_id from judged j join links l on l.child = j.node where depth = -1",
}
