"""Queries on tables with faults put in by the query, where the tables hold none; array checks, result checks and the whole graph.

A fault is put into the same rows by the SQL, so a rule that finds nothing fails the comparison.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from loomgraph.functions import arrays as A, text as T, vectors as V
from loomgraph.operators import evaluate as E, graph as G, identity as I, integrity as R, segment as S
from loomgraph.operators.hierarchy import rejected_links
from loomgraph.operators.search import Searcher
from loomgraph.plans import structure as st
from loomgraph.plans.retrieval import BEST, CHUNKS, TOKENS, UNITS, VECTORS, WAYS, _DENSE, _RANKED, both_ways, bm25_sql, chunk_vectors, chunks, units
from loomgraph.workspace import table

QUERIES, ORACLES = {}, {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# text scans

_SECRET = {0: " api_key = 'ABCDEFGHIJKL12'", 1: " see /home/bob/notes", 2: r" C:\Users\bob\x", 3: " ghp_ABCDEFGHIJKLMNOPQRSTUVWX", 4: ""}
_TAINTED = "(select doc_id, coalesce(text, '') || case doc_id % 5 " + " ".join(f"when {k} then {st._quoted(v)}" for k, v in _SECRET.items()) + " end as text from documents)"


def _tainted(spark, d):
    told = F.element_at(F.create_map(*[x for k, v in _SECRET.items() for x in (F.lit(k), F.lit(v))]), F.pmod(F.col("doc_id"), F.lit(5)).cast("int"))
    return table(spark, d, "documents").select("doc_id", F.concat(F.coalesce("text", F.lit("")), told).alias("text"))


@query("\nunion all ".join(f"select '{name}' as pattern, doc_id from {_TAINTED} where regexp_matches(text, {st._quoted(rx)})" for name, rx in T.SECRETS.items()))
def secret_scan_planted(spark, d):
    return _tainted(spark, d).select(F.explode(T.secrets(F.col("text"))).alias("pattern"), "doc_id")


@query(f"select doc_id from {_TAINTED} where regexp_matches(text, {st._quoted(T.ABSOLUTE_PATH)})")
def absolute_path_scan_planted(spark, d):
    return _tainted(spark, d).where(T.has_absolute_path(F.col("text"))).select("doc_id")


# joins, windows and sets


@query("select c_custkey from customer c where not exists (select 1 from orders o where o.o_custkey = c.c_custkey and o_custkey % 3 <> 0)")
def orphan_customers_planted(spark, d):
    """The orders of every third customer are lost."""
    o = table(spark, d, "orders").where("o_custkey % 3 <> 0").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, d, "customer").join(o, "c_custkey", "left_anti").select("c_custkey")


_INNER = "inner_ as (select chunk_id, knowledge_unit_id, body_start, body_end from chunks union all select chunk_id || ':inner', knowledge_unit_id, body_start + 1, body_end - 1 from chunks where body_end - body_start > 10)"


@query(f"""with {CHUNKS}, {_INNER} select a.chunk_id as inner_id, b.chunk_id as outer_id from inner_ a join inner_ b on a.knowledge_unit_id = b.knowledge_unit_id and a.chunk_id <> b.chunk_id
  and a.body_start >= b.body_start and a.body_end <= b.body_end""")
def interval_containment_planted(spark, d):
    """Each chunk has one inside it."""
    c = chunks(spark, d).select("chunk_id", "knowledge_unit_id", "body_start", "body_end")
    inner = c.where("body_end - body_start > 10").select(F.concat("chunk_id", F.lit(":inner")).alias("chunk_id"), "knowledge_unit_id", (F.col("body_start") + 1).alias("body_start"), (F.col("body_end") - 1).alias("body_end"))
    both = c.unionByName(inner)
    a = both.select("knowledge_unit_id", F.col("chunk_id").alias("inner_id"), F.col("body_start").alias("s"), F.col("body_end").alias("e"))
    b = both.select("knowledge_unit_id", F.col("chunk_id").alias("outer_id"), F.col("body_start").alias("lo"), F.col("body_end").alias("hi"))
    return a.join(b, "knowledge_unit_id").where("inner_id <> outer_id and s >= lo and e <= hi").select("inner_id", "outer_id")


_SHIFTED = "shifted as (select distinct chunk_id, knowledge_unit_id, segment_index, case when segment_index = 1 then 0 else body_start end as body_start from rag_chunks)"


@query(f"""with {_SHIFTED} select knowledge_unit_id, segment_index as location, chunk_id from (select *, lag(body_start) over (partition by knowledge_unit_id order by segment_index, chunk_id) as before from shifted)
  where before >= body_start""")
def order_violations_planted(spark, d):
    """Second segments are moved to the start of the text."""
    c = table(spark, d, "rag_chunks").select("chunk_id", "knowledge_unit_id", "segment_index", F.when(F.col("segment_index") == 1, 0).otherwise(F.col("body_start")).alias("body_start")).distinct()
    w = Window.partitionBy("knowledge_unit_id").orderBy("segment_index", "chunk_id")
    return c.withColumn("before", F.lag("body_start").over(w)).where("before >= body_start").select("knowledge_unit_id", F.col("segment_index").alias("location"), "chunk_id")


_FIELDS = ("title", "source_id", "source_chain_id", "subject_root", "node_id")


@query(f"""with {CHUNKS}, {UNITS},
  l as (select chunk_id, case when segment_index = 1 then title || '*' else title end as title, source_id, case when segment_index = 2 then null else source_chain_id end as source_chain_id, subject_root, node_id from chunks where segment_index <> 3 or segment_index is null),
  r as (select c.chunk_id, {", ".join(f"u.{f}" for f in _FIELDS)} from chunks c join units u using (knowledge_unit_id) where c.segment_index <> 4 or c.segment_index is null)
  select coalesce(l.chunk_id, r.chunk_id) as chunk_id, case when l.chunk_id is null then ['(missing)'] when r.chunk_id is null then ['(extra)'] else
    list_filter([{", ".join(f"case when l.{f} is distinct from r.{f} then '{f}' end" for f in _FIELDS)}], lambda x: x is not null) end as differing
  from l full join r on l.chunk_id = r.chunk_id where l.chunk_id is null or r.chunk_id is null or {" or ".join(f"l.{f} is distinct from r.{f}" for f in _FIELDS)}""")
def field_diff_planted(spark, d):
    """All fields that chunks share with their units, some of them changed, with chunks on one side only."""
    c = chunks(spark, d)
    there = lambda n: F.coalesce(F.col("segment_index") != n, F.lit(True))
    left = c.where(there(3)).select("chunk_id", F.when(F.col("segment_index") == 1, F.concat("title", F.lit("*"))).otherwise(F.col("title")).alias("title"), "source_id", F.when(there(2), F.col("source_chain_id")).alias("source_chain_id"), "subject_root", "node_id")
    right = c.where(there(4)).select("chunk_id", "knowledge_unit_id").join(units(spark, d).select("knowledge_unit_id", *_FIELDS), "knowledge_unit_id").drop("knowledge_unit_id")
    return R.field_diff(left, right, "chunk_id", list(_FIELDS), sides=True)


_GAPPED = "gapped as (select distinct chunk_id, knowledge_unit_id, body_start, body_end from rag_chunks where segment_index is distinct from 1)"


def _gapped(spark, d):
    c = table(spark, d, "rag_chunks").where(~F.col("segment_index").eqNullSafe(F.lit(1)))
    return c.select("chunk_id", "knowledge_unit_id", "body_start", "body_end").distinct()


@query(f"""with {_GAPPED} select chunk_id, body_start - prev as gap from (select *, coalesce(max(body_end) over (partition by knowledge_unit_id order by body_start, body_end rows between unbounded preceding and 1 preceding), 0) as prev from gapped) where body_start > prev""")
def segment_gaps_planted(spark, d):
    """Second segments are gone."""
    return S.coverage(_gapped(spark, d), "knowledge_unit_id").where("gap > 0").select("chunk_id", "gap")


@query(f"with {UNITS}, {_GAPPED}, e as (select knowledge_unit_id, max(body_end) as last, min(body_start) as first from gapped group by 1) select knowledge_unit_id, first, last, length(text) as length from e join units using (knowledge_unit_id) where last is distinct from length(text) or first <> 0")
def segment_coverage_planted(spark, d):
    e = _gapped(spark, d).groupBy("knowledge_unit_id").agg(F.max("body_end").alias("last"), F.min("body_start").alias("first"))
    j = e.join(units(spark, d).select("knowledge_unit_id", F.length("text").cast("bigint").alias("length")), "knowledge_unit_id")
    return j.where(~F.col("last").eqNullSafe(F.col("length")) | (F.col("first") != 0)).select("knowledge_unit_id", "first", "last", "length")


# graph

_CONTAINS = st._CONTAINS


@query(f"""with k as (select distinct knowledge_unit_id as id from knowledge_units where knowledge_unit_id is not null),
  e as (select target_node_id, source_node_id from kg_edges where {_CONTAINS} and not ends_with(target_node_id, '7') union all select target_node_id, source_node_id || '*' from kg_edges where {_CONTAINS} and ends_with(target_node_id, '3')),
  p as (select target_node_id as id, count(distinct source_node_id) as n from e group by 1)
  select id as location, cast(coalesce(n, 0) as varchar) as detail from k left join p using (id) where coalesce(n, 0) <> 1""")
def single_parent_violations_planted(spark, d):
    """Units whose id ends with 7 lose their parents, those with 3 have as many again."""
    e = table(spark, d, "kg_edges").where(G.normalized_relation() == "contains").where("source_node_id is not null and target_node_id is not null").select("target_node_id", "source_node_id")
    more = e.where(F.col("target_node_id").endswith("3")).withColumn("source_node_id", F.concat("source_node_id", F.lit("*")))
    e = e.where(~F.col("target_node_id").endswith("7")).unionByName(more)
    return R.exactly_one(table(spark, d, "knowledge_units").where("knowledge_unit_id is not null"), "knowledge_unit_id", e, "target_node_id", "source_node_id")


@query("""with k as (select distinct knowledge_unit_id as id from knowledge_units where knowledge_unit_id is not null), p as (select source_node_id as id, count(distinct target_node_id) as n from kg_edges where lower(trim(relation)) = 'supported_by' and target_node_id is not null group by 1)
  select id as location, cast(coalesce(n, 0) as varchar) as detail from k left join p using (id) where coalesce(n, 0) <> 1""")
def single_evidence_violations(spark, d):
    """Units that not exactly one piece of evidence supports."""
    e = table(spark, d, "kg_edges").where(G.normalized_relation() == "supported_by").where("target_node_id is not null")
    return R.exactly_one(table(spark, d, "knowledge_units").where("knowledge_unit_id is not null"), "knowledge_unit_id", e, "source_node_id", "target_node_id")


_MOVED = "case when ends_with(node_id, '5') then source_id || '*' else source_id end"


@query(f"select source_volume_id as key, count(distinct (subject_root, {_MOVED})) as n_definitions from kg_nodes where source_volume_id is not null and subject_root is not null and source_id is not null group by 1 having count(distinct (subject_root, {_MOVED})) > 1")
def fd_violations_planted(spark, d):
    """Nodes whose id ends with 5 name another source."""
    moved = F.when(F.col("node_id").endswith("5"), F.concat("source_id", F.lit("*"))).otherwise(F.col("source_id"))
    held = table(spark, d, "kg_nodes").where("subject_root is not null and source_id is not null").withColumn("source_id", moved)
    return G.dependency_violations(held, "source_volume_id", "subject_root", "source_id").withColumnRenamed("source_volume_id", "key")


_OTHER = "case when ends_with(node_id, '5') then {0} || '*' else {0} end"


@query(f"""with {st.NODES}, s as (select node_id, {", ".join(f"min({_OTHER.format(c)}) as {c}" for c in G.SCOPE)} from nodes where node_id is not null group by 1),
  e as (select distinct edge_id, source_node_id, target_node_id from kg_edges where lower(trim(relation)) = 'contains')
  {" union all ".join(f"select '{c}' as scope, edge_id, a.{c} as source_scope, b.{c} as target_scope from e join s a on a.node_id = source_node_id join s b on b.node_id = target_node_id where a.{c} <> b.{c}" for c in G.SCOPE)}""")
def scope_mismatch_planted(spark, d):
    """Subject root, source and volume of both ends of contains edges, other ones at nodes whose id ends with 5."""
    n = st.nodes(spark, d)
    n = n.withColumns({c: F.when(F.col("node_id").endswith("5"), F.concat(c, F.lit("*"))).otherwise(F.col(c)) for c in G.SCOPE})
    out = None
    for c in G.SCOPE:
        one = G.scope_mismatch(table(spark, d, "kg_edges"), n, c).withColumn("scope", F.lit(c))
        out = one if out is None else out.unionByName(one)
    return out


@query("""with l as (select distinct target_node_id as child, source_node_id as parent from kg_edges where lower(trim(relation)) = 'related_to' and source_node_id is not null and target_node_id is not null)
  select child, parent, kept as kept_parent from (select *, min(parent) over (partition by child) as kept from l) where parent <> kept""")
def second_parents(spark, d):
    """Links that a hierarchy leaves out because the child has a smaller parent, on the relation with many."""
    return rejected_links(table(spark, d, "kg_edges"), "related_to")


def _outline(spark, d):
    n = table(spark, d, "kg_nodes").where("node_id is not null and node_type in ('chapter', 'support_unit')")
    members = table(spark, d, "kg_edges").where(G.normalized_relation() == "contains").join(n.select(F.col("node_id").alias("source_node_id")), "source_node_id", "left_semi")
    related = table(spark, d, "kg_edges").where(G.normalized_relation() == "related_to").select("source_node_id", "target_node_id")
    return n, members.select(F.col("source_node_id").alias("group_id"), F.col("target_node_id").alias("knowledge_unit_id")).distinct(), related


@query(f"""with {UNITS}, n as (select subject_root as node_id, 'subject_root' as node_type, subject_root, null as source_id, null as source_volume_id, null as knowledge_unit_id from units
  union select source_volume_id, 'source_volume', subject_root, source_id, source_volume_id, null from units union select knowledge_unit_id, 'knowledge_unit', subject_root, source_id, source_volume_id, knowledge_unit_id from units
  union select unnest(evidence_refs), 'evidence', subject_root, source_id, source_volume_id, null from units
  union select node_id, node_type, subject_root, source_id, source_volume_id, null from kg_nodes where node_type in ('chapter', 'support_unit')) select * from n where node_id is not null""")
def kg_nodes_whole(spark, d):
    """All six types of nodes."""
    return G.build_nodes(units(spark, d), _outline(spark, d)[0])


@query(f"""with {UNITS}, o as (select * from kg_nodes where node_id is not null and node_type in ('chapter', 'support_unit')),
  m as (select distinct source_node_id as g, target_node_id as u from kg_edges where lower(trim(relation)) = 'contains' and source_node_id in (select node_id from o) and target_node_id in (select knowledge_unit_id from units)),
  e as (select subject_root as a, 'contains' as r, source_volume_id as b from units union select g, 'contains', u from m union select source_volume_id, 'contains', knowledge_unit_id from units where knowledge_unit_id not in (select u from m)
    union select knowledge_unit_id, 'supported_by', unnest(evidence_refs) from units union select source_volume_id, 'contains', node_id from o where node_type = 'chapter'
    union select node_id, 'has_chapter_context', unnest(chapter_refs) from o where node_type = 'support_unit' union select source_node_id, 'related_to', target_node_id from kg_edges where lower(trim(relation)) = 'related_to')
  select 'edge:' || a || ':' || r || ':' || b as edge_id, a as source_node_id, b as target_node_id, r as relation from e where a is not null and b is not null""")
def kg_edges_whole(spark, d):
    """All kinds of edges: outline, chapter context, evidence, relations."""
    return G.build_edges(units(spark, d), *_outline(spark, d))


# arrays and loosely typed fields


@query(f"""with {UNITS}, a as (select knowledge_unit_id, evidence_refs as e, applicability as p, case when ends_with(knowledge_unit_id, '1') then list_concat(forbidden_transfer, evidence_refs) else forbidden_transfer end as f from units)
  select knowledge_unit_id, coalesce(len(list_distinct(list_transform(e, lambda x: coalesce(x, '?')))) = len(e), false) as once, not (list_has_any(coalesce(e, []), coalesce(f, [])) or list_has_any(coalesce(e, []), coalesce(p, [])) or list_has_any(coalesce(p, []), coalesce(f, []))) as apart,
    coalesce(len(list_filter(p, lambda x: x is null or trim(x) = '')) = 0, false) as named, nullif(coalesce(list_position(e, list_extract(e, len(e))), 0), 0)::bigint as last_at from a""")
def array_checks(spark, d):
    """Arrays without repeats, arrays that share nothing (some made to), arrays of texts, first place of an element."""
    u = units(spark, d).withColumn("f", F.when(F.col("knowledge_unit_id").endswith("1"), F.concat("forbidden_transfer", "evidence_refs")).otherwise(F.col("forbidden_transfer")))
    e = F.col("evidence_refs")
    return u.select("knowledge_unit_id", A.duplicate_free(e).alias("once"), A.disjoint(e, F.col("applicability"), F.col("f")).alias("apart"), A.all_named(F.col("applicability")).alias("named"), A.place_of(e, F.try_element_at(e, F.lit(-1))).alias("last_at"))


_SPANS = "case knowledge_unit_id[-1] when '1' then '0-4' when '2' then '9-3' when '3' then '3-7, 12, 20–25' when '4' then 'p. 5' else regexp_replace(source_locator, '^[^0-9]*', '') end"


@query(rf"""with {UNITS}, s as (select knowledge_unit_id, {_SPANS} as t from units),
  i as (select *, case when regexp_full_match(t, '\s*\d{{1,18}}\s*(?:[-–]\s*\d{{1,18}}\s*)?(,\s*\d{{1,18}}\s*(?:[-–]\s*\d{{1,18}}\s*)?)*') then
    list_transform(string_split(t, ','), lambda x: [regexp_extract(x, '(\d+)', 1)::bigint, coalesce(nullif(regexp_extract(x, '(\d+)\s*[-–]\s*(\d+)', 2), ''), regexp_extract(x, '(\d+)', 1))::bigint]) end as a from s)
  select knowledge_unit_id, a as bounds, coalesce(len(a) > 0 and len(list_filter(a, lambda x: x[1] < 1 or x[2] < x[1])) = 0, false) as valid from i""")
def interval_lists(spark, d):
    """Page lists as intervals, some of them made wrong."""
    last = F.substring("knowledge_unit_id", -1, 1)
    t = F.when(last == "1", "0-4").when(last == "2", "9-3").when(last == "3", "3-7, 12, 20–25").when(last == "4", "p. 5").otherwise(F.regexp_replace("source_locator", "^[^0-9]*", ""))
    u = units(spark, d).withColumn("i", A.intervals(t))
    return u.select("knowledge_unit_id", F.transform("i", lambda x: F.array(x["start"], x["end"])).alias("bounds"), A.valid_intervals(F.col("i")).alias("valid"))


@query(f"""with {UNITS}, n as (select knowledge_unit_id, case when ends_with(knowledge_unit_id, '1') then to_json(applicability[1]) when ends_with(knowledge_unit_id, '2') then '7' else to_json(applicability) end::varchar as j,
    case when ends_with(knowledge_unit_id, '3') then to_json({{node_id: node_id, body: title}}) when ends_with(knowledge_unit_id, '4') then to_json({{kg_node_id: node_id, "text": null, body: title}}) else to_json({{knowledge_unit_id: knowledge_unit_id, "text": title, body: 'no'}}) end as o, applicability as a, title from units)
  select knowledge_unit_id, case when j[1] = '[' then json_extract_string(j, '$[*]') when j[1] = '"' then [json_extract_string(j, '$')] end as many,
    coalesce(json_extract_string(o, '$.knowledge_unit_id'), json_extract_string(o, '$.node_id'), json_extract_string(o, '$.kg_node_id')) as id, coalesce(json_extract_string(o, '$.text'), json_extract_string(o, '$.body')) as body from n""")
def loose_fields(spark, d):
    """A lone text where an array is expected, and fields under alternative names."""
    u, k = units(spark, d), F.col("knowledge_unit_id")
    j = F.when(k.endswith("1"), F.regexp_extract(F.to_json(F.struct(F.try_element_at("applicability", F.lit(1)).alias("x"))), r'(?s)\A\{"x":(.*)\}\z', 1)).when(k.endswith("2"), "7").otherwise(F.to_json("applicability"))
    o = F.when(k.endswith("3"), F.to_json(F.struct("node_id", F.col("title").alias("body")))).when(k.endswith("4"), F.to_json(F.struct(F.col("node_id").alias("kg_node_id"), F.col("title").alias("body")))).otherwise(F.to_json(F.struct(k, F.col("title").alias("text"), F.lit("no").alias("body"))))
    return u.select(k, A.as_array(j).alias("many"), A.first_named(o, ["knowledge_unit_id", "node_id", "kg_node_id"]).alias("id"), A.first_named(o, ["text", "body"]).alias("body"))


@query("""select m."row", round(sqrt(list_dot_product(e, e)), 4) as norm from (select distinct "row", embedding::double[] as e from vector_matrix where len(embedding) = 512 and list_count(embedding) = 512 and len(list_filter(embedding, lambda y: not isfinite(y))) = 0
  and len(list_filter(embedding, lambda y: y <> 0)) > 0) m where abs(sqrt(list_dot_product(e, e)) - 1) > 0.001""")
def norm_outliers(spark, d):
    """Vectors whose length is not 1 within the tolerance."""
    held = table(spark, d, "vector_matrix").where(V.is_valid(F.col("embedding"), 512)).distinct()
    return held.select("row", F.round(V.norm(F.col("embedding")), 4).alias("norm"), V.norm(F.col("embedding")).alias("n")).where("abs(n - 1) > 0.001").drop("n")


@query(f"with {UNITS}, c as (select knowledge_unit_id, max(segment_count) as declared, count(distinct chunk_id) as held from rag_chunks group by 1) select * from c where declared is distinct from held")
def declared_counts(spark, d):
    """Units whose chunks declare another number of segments than there are."""
    c = table(spark, d, "rag_chunks").groupBy("knowledge_unit_id").agg(F.max("segment_count").alias("declared"), F.count_distinct("chunk_id").alias("held"))
    return c.where(~F.col("declared").eqNullSafe(F.col("held")))


@query(f"""with n as (select distinct node_id from shared_nodes), a as (select node_id from n order by node_id limit 20)
  select 'rows' as location, count(*) || ' instead of 7' as detail from n having count(*) <> 7 union all select node_id, 'missing right' from n where node_id not in (select node_id from a) union all select 'nowhere', 'missing left'""")
def profile_departures(spark, d):
    """The shared nodes against a profile that expects seven rows, the first twenty of them and one that doesn't exist."""
    n = table(spark, d, "shared_nodes").select("node_id").distinct()
    first = [r["node_id"] for r in n.orderBy("node_id").limit(20).collect()]
    return R.against_profile(n, {"rows": 7, "ids": [*first, "nowhere"]}, "node_id")


@query("""select distinct "row", abs(sqrt(list_dot_product(e, e)) - 1) <= 0.00001 as unit from (select "row", embedding::double[] as e from vector_matrix where len(embedding) = 512 and list_count(embedding) = 512 and len(list_filter(embedding, lambda y: not isfinite(y))) = 0)""")
def unit_vectors(spark, d):
    """Which vectors have length 1 within the strictest tolerance."""
    e = F.col("embedding")
    whole = F.coalesce((F.size(e) == 512) & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))), F.lit(False))
    return table(spark, d, "vector_matrix").where(whole).select("row", V.is_unit(e).alias("unit")).distinct()


@query(f"""with {UNITS}, {st._PAGES}, s as (select source_id, knowledge_unit_id, lo, hi, max(hi) over (partition by source_id order by lo, hi, knowledge_unit_id rows between unbounded preceding and 1 preceding) as prev from spans where hi >= lo)
  select source_id, knowledge_unit_id, case when lo <= coalesce(prev, 0) then 'overlap' else 'gap' end as kind, least(coalesce(prev, 0) + 1, lo)::int as first, (case when lo <= coalesce(prev, 0) then least(prev, hi) else lo - 1 end)::int as last from s where lo <> coalesce(prev, 0) + 1""")
def page_cover(spark, d):
    """Where the page spans of a source's units don't follow one another without a gap or an overlap: the book is to be covered once."""
    w = Window.partitionBy("source_id").orderBy("lo", "hi", "knowledge_unit_id").rowsBetween(Window.unboundedPreceding, -1)
    s = st._pages(spark, d).where("hi >= lo").withColumn("prev", F.coalesce(F.max("hi").over(w), F.lit(0))).where("lo <> prev + 1")
    over = F.col("lo") <= F.col("prev")
    return s.select("source_id", "knowledge_unit_id", F.when(over, "overlap").otherwise("gap").alias("kind"), F.least(F.col("prev") + 1, F.col("lo")).alias("first"), F.when(over, F.least("prev", "hi")).otherwise(F.col("lo") - 1).alias("last"))


@query(f"""with recursive {UNITS}, src as (select knowledge_unit_id as id, text from units where text is not null and text <> ''), {st.SEGMENTS},
  c as (select id, i, s, e, u.*, concat_ws(chr(10), coalesce(u.title, ''), substr(seg.text, s + 1, e - s), coalesce(array_to_string(u.applicability, chr(10)), '')) as search_text from seg join units u on u.knowledge_unit_id = id)
  select format('{{}}:chunk:{{:03d}}', id, i + 1) as chunk_id, len({TOKENS % 'search_text'})::int as token_count, sha256(search_text) as embedding_sha256, node_id, source_chain_id, len(evidence_refs)::int as n_evidence, sha256(text) as unit_sha256,
    i::int as segment_index, (count(*) over (partition by id))::int as segment_count from c""")
def chunk_rows_whole(spark, d):
    """Chunks with their units' fields and the number of tokens."""
    u = units(spark, d)
    rows = S.whole_chunk_rows(u, S.segment(u, "knowledge_unit_id", "text", 400))
    k = F.col("knowledge_unit")
    return rows.select(
        "chunk_id", "token_count", F.sha2("embedding_text", 256).alias("embedding_sha256"), k["node_id"].alias("node_id"), k["source_chain_id"].alias("source_chain_id"),
        F.when(k["evidence_refs"].isNotNull(), F.size(k["evidence_refs"])).alias("n_evidence"), F.sha2(k["text"], 256).alias("unit_sha256"), "segment_index", "segment_count",
    )


_CANONICAL = st.ORACLES["canonical_json"]


@query(f"""with lines as ({_CANONICAL}), leaves as (select distinct ('0x' || substr(sha256(knowledge_unit_id), 1, 3))::int % 4096 as bucket, knowledge_unit_id || chr(9) || sha256(line) as leaf from lines where knowledge_unit_id is not null),
  b as (select bucket, count(*) as n, sha256(array_to_string(list(leaf order by leaf), chr(10))) as h from leaves group by 1)
  select sum(n)::bigint as n, sha256(array_to_string(list(h order by bucket), chr(10))) as root from b""")
def canonical_root(spark, d):
    """The root over the canonical JSON of all rows of a table, as a bundle's manifest holds it."""
    u = table(spark, d, "knowledge_units").where("knowledge_unit_id is not null")
    return I.corpus_identity(u, "knowledge_unit_id", I.canonical_json(u))


@query(None)
def segment_tokens(spark, d):
    """Units cut under a budget of tokens of what is embedded: title, segment and applicability."""
    return S.segment(units(spark, d), "knowledge_unit_id", "text", 512, counter=S.lexical_counter, title="title", applicability="applicability")


# collections and results

_ROOTS = ("reactor-practice", "separation-processes", "transport-phenomena")


def _collection(spark, d):
    c, v = chunks(spark, d), chunk_vectors(spark, d)
    bundles = {r: c.where(F.col("subject_root") == r) for r in _ROOTS}
    return Searcher.over(bundles, {r: v.join(b.select("chunk_id"), "chunk_id", "left_semi") for r, b in bundles.items()}, {r: {"name": "m", "dims": 512} for r in _ROOTS}, ("name", "dims"))


_BUNDLES = f"whole as (select * from chunks where subject_root in {_ROOTS})"
_IN = "join whole w2 on w2.chunk_id = x.doc"


def _collected(sql: str) -> str:
    """SQL over chunks as SQL over the collection."""
    return sql.replace("join chunks c", "join whole c")


@query(f"""with {CHUNKS}, {_BUNDLES}, {VECTORS}, {WAYS}, {_collected(_DENSE)} select query, unit, doc as chunk_id, bundle_id, rank, round(score, 6) as score
  from (select x.*, w2.subject_root as bundle_id from dense x {_IN}) where rank <= 5""")
def collection_dense_topk(spark, d):
    """Units of all bundles by one query encoding, each with its bundle."""
    found = _collection(spark, d).search(both_ways(spark, d), "dense")
    return found.select("query", "unit", F.col("doc").alias("chunk_id"), "bundle_id", F.col("rank").cast("bigint").alias("rank"), F.round("score", 6).alias("score"))


@query(f"""with {CHUNKS}, {_BUNDLES}, {VECTORS}, {WAYS}, {bm25_sql('whole', 'chunk_id', 'search_text', 'ways')}, {_collected(BEST)}, {_RANKED}
  select x.query, x.unit, x.doc as chunk_id, w2.subject_root as bundle_id, x.rank, round(x.score, 6) as score from ranked x {_IN} where rank <= 5""")
def collection_unit_topk(spark, d):
    found = _collection(spark, d).search(both_ways(spark, d), "lexical")
    return found.select("query", "unit", F.col("doc").alias("chunk_id"), "bundle_id", F.col("rank").cast("bigint").alias("rank"), F.round("score", 6).alias("score"))


@query(f"""with {CHUNKS}, {_BUNDLES}, {VECTORS}, {WAYS}, {_collected(_DENSE)}, {bm25_sql('whole', 'chunk_id', 'search_text', 'ways')}, {_collected(BEST)}, {_RANKED},
  both_ as (select query, unit, rank, doc, score, 1 as channel from ranked union all select query, unit, rank, doc, score, 0 from dense),
  fused as (select query, unit, round(sum(1.0 / (60 + rank)), 12) as rrf, arg_min(doc, channel) as doc from both_ group by 1, 2)
  select x.query, x.unit, x.doc as chunk_id, w2.subject_root as bundle_id, round(rrf, 9) as rrf, x.rank from (select *, row_number() over (partition by query order by rrf desc, unit) as rank from fused qualify rank <= 5) x {_IN}""")
def collection_hybrid_topk(spark, d):
    found = _collection(spark, d).search(both_ways(spark, d), "hybrid")
    return found.select("query", "unit", F.col("doc").alias("chunk_id"), "bundle_id", F.round("score", 9).alias("rrf"), F.col("rank").cast("bigint").alias("rank"))


def _returned(spark, d, k: int = 20) -> DataFrame:
    """Lexical results with the complete units as a careless index would return them: second places carry a changed title."""
    s = Searcher(chunks(spark, d))
    found = s.complete(s.search(both_ways(spark, d), "lexical", k), units(spark, d))
    unit = F.col("knowledge_unit")
    changed = F.when(F.col("rank") == 2, F.concat(unit["title"], F.lit("*"))).otherwise(unit["title"])
    return found.withColumn("knowledge_unit", unit.withField("title", changed)).withColumn("bundle_id", unit["subject_root"])


def _checked(spark, d, k: int = 20) -> DataFrame:
    fields = ["title", "text", "source_id", "subject_root", "applicability", "evidence_refs", "units_basis"]
    return E.verified(_returned(spark, d, k), "knowledge_unit", units(spark, d), fields)


_ERRORS = "list_filter([case when rank = 2 and u.title is not null then 'title' end, case when sha256(u.text) is distinct from lower(u.text_sha256) then 'text_sha256' end], lambda x: x is not null)"
_LEXICAL = f"with {CHUNKS}, {UNITS}, {VECTORS}, {WAYS}, {bm25_sql('chunks', 'chunk_id', 'search_text', 'ways')}, {BEST}, {_RANKED}"


@query(f"""{_LEXICAL} select query, rank, u.subject_root as bundle_id, unit, doc as chunk_id, c.body_start, c.body_end, c.token_count, c.segment_index, c.segment_count, lower(u.text_sha256) as text_sha256, round(score, 6) as score, {_ERRORS} as errors
  from ranked r join units u on u.knowledge_unit_id = r.unit join chunks c on c.chunk_id = doc where rank <= 5""")
def body_free_results(spark, d):
    """What a report holds of each result: no text, but the hash and every departure from the unit of record."""
    r = _checked(spark, d, 5)
    return r.select("query", F.col("rank").cast("bigint").alias("rank"), "bundle_id", "unit", F.col("doc").alias("chunk_id"), "body_start", "body_end", "token_count", "segment_index", "segment_count", "text_sha256", F.round("score", 6).alias("score"), "errors")


_VALID = st._EVAL.replace("from best where score > 0 qualify rank <= 20)", f"from best where score > 0 qualify rank <= 20), valid as (select r.* from run r join units u on u.knowledge_unit_id = r.id where len({_ERRORS}) = 0)").replace("hits as (select * from run join", "hits as (select * from valid join").replace(f"with {CHUNKS},", f"with {CHUNKS}, {UNITS},", 1)


@query(f"{_VALID} select query, role, hit, first::bigint as first_rank, mrr::double as mrr from diag where {st._POS}")
def eval_verified_hits(spark, d):
    """A target counts only where the unit that was returned is the unit of record."""
    q, qrels = st._judged(spark, d)
    found = E.evaluate(q, qrels, _checked(spark, d).select("query", "rank", F.col("unit").alias("id"), "errors"))
    return found.where("role in ('any_hit', 'all_relevant')").select("query", "role", "hit", F.col("first_rank").cast("bigint").alias("first_rank"), "mrr")


_LONG = st._EVAL.replace("hits as (select * from run join rel using (query, id))", "long as (select query from best where score > 0 and query % 40 = 0 group by 1 having count(*) > 20), hits as (select * from run join rel using (query, id) where query not in (select query from long))")


@query(f"{_LONG} select query, role, case when query in (select query from long) then 'more than 20 results' end as error, coalesce(hits, 0) > 0 as hit from roles left join per using (query) where {st._POS}")
def eval_over_limit(spark, d):
    """Rankings of some queries are longer than asked for: an error, and no score."""
    q, qrels = st._judged(spark, d)
    run = Searcher(chunks(spark, d)).search(both_ways(spark, d), "lexical", 25).where((F.col("rank") <= 20) | (F.col("query") % 40 == 0)).select("query", "rank", F.col("unit").alias("id"))
    found = E.evaluate(q, qrels, run)
    return found.where("role in ('any_hit', 'all_relevant')").select("query", "role", "error", "hit")


@query(f"""with s as ({st._METHODS.replace("%s", "method, role")}), l as (unpivot (select * exclude (n_cases) from s) on hit_rate, mrr, rank1_rate into name metric value v)
  select a.role, a.metric, a.v as baseline, b.v as candidate, not coalesce(b.v >= a.v - 1e-9, false) as regressed from l a left join l b on b.method = 'dense' and b.role = a.role and b.metric = a.metric where a.method = 'lexical'""")
def eval_regressions(spark, d):
    """Per slice, whether one method falls behind another."""
    s = st._by_method(spark, d, "method", "role").cache()
    side = lambda m: s.where(F.col("method") == m).drop("method")
    return E.regressions(side("lexical"), side("dense"), ["role"], ["hit_rate", "mrr", "rank1_rate"])


@query(f"""{st._EVAL}, a as (select query, list(id order by case when query % 40 = 0 and rank in (1, 2) then 3 - rank else rank end) as stored from run where rank <= 5 and (query % 100 <> 0 or rank <= 3) group by 1),
  b as (select query, list(id order by rank) as recomputed from run where rank <= 5 group by 1)
  select query, stored, recomputed from a full join b using (query) where stored is distinct from recomputed""")
def replay_planted(spark, d):
    """Stored rankings against recomputed ones; some of the stored were changed at their head or cut short."""
    again = st._lexical_run(spark, d)
    swapped = F.when((F.col("query") % 40 == 0) & F.col("rank").isin(1, 2), 3 - F.col("rank")).otherwise(F.col("rank"))
    stored = again.where((F.col("query") % 100 != 0) | (F.col("rank") <= 3)).withColumn("rank", swapped)
    return E.replay_diff(stored, again, ["query"])


@query("""with f as (select distinct source_volume_id || case when source_id < 'K' then '.txt' else '.bin' end as name, length(source_volume_id) as bytes, sha256(source_volume_id) as h from kg_nodes where node_type = 'source_volume' and source_volume_id is not null),
  m as (select name, bytes + case when ends_with(name, 's-1.txt') then 1 else 0 end as bytes, h from f where not name like '%k%' union all select 'gone.txt', 1, 'x')
  select 'manifest' as code, coalesce(f.name, m.name) as location, case when f.name is null then 'missing' when m.name is null then 'extra' when f.bytes <> m.bytes then 'size' end as detail from f full join m on f.name = m.name where f.name is null or m.name is null or f.bytes <> m.bytes
  union all select 'denied_file', name, 'suffix' from f where name like '%.bin'
  union all select 'unsafe_path', name, null from f where regexp_matches(name, '^[/\\\\]|^[A-Za-z]:|(?:^|[/\\\\])\\.\\.(?:[/\\\\]|$)')
  """ + "".join(f" union all select 'secret', 'documents:' || doc_id, '{name}' from {_TAINTED} where regexp_matches(text, {st._quoted(rx)})" for name, rx in T.SECRETS.items())
  + f" union all select 'private_path', 'documents:' || doc_id, null from {_TAINTED} where regexp_matches(text, {st._quoted(T.PRIVATE_PATH)})")
def release_gate_planted(spark, d):
    """The gate before publishing, on files named after the volumes and on texts with secrets put in."""
    v = table(spark, d, "kg_nodes").where("node_type = 'source_volume' and source_volume_id is not null")
    name = F.concat("source_volume_id", F.when(F.col("source_id") < "K", ".txt").otherwise(".bin"))
    f = v.select(name.alias("name"), F.length("source_volume_id").cast("bigint").alias("bytes"), F.sha2("source_volume_id", 256).alias("sha256")).distinct()
    m = f.where("name not like '%k%'").withColumn("bytes", F.col("bytes") + F.when(F.col("name").endswith("s-1.txt"), 1).otherwise(0))
    m = m.unionByName(spark.createDataFrame([("gone.txt", 1, "x")], "name string, bytes bigint, sha256 string"))
    return R.release_gate(f, m, [".bin"], {"documents": (_tainted(spark, d), "doc_id", ["text"])})
