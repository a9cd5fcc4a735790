"""Queries of scans, filters, joins, aggregates, sets, windows, segmentation, graph, integrity and evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from loomgraph.functions import text as T, vectors as V
from loomgraph.operators import evaluate as E, graph as G, identity as I, integrity as R, segment as S
from loomgraph.operators.current import latest
from loomgraph.operators.fusion import numbered
from loomgraph.operators.search import Searcher, filter_chunks
from loomgraph.plans.retrieval import BEST, CHUNKS, SOURCE, SUBJECT, UNITS, VECTORS, WAYS, _DENSE, _RANKED, bm25_sql, both_ways, chunk_vectors, chunks, units
from loomgraph.workspace import Workspace, table

QUERIES, ORACLES = {}, {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def nodes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "kg_nodes").unionByName(table(spark, d, "shared_nodes"), allowMissingColumns=True)


NODES = "nodes as (select * from kg_nodes union all by name select * from shared_nodes)"

# scans and filters


@query("select doc_id, length(text) as n, lang from documents")
def scan_documents(spark, d):
    return table(spark, d, "documents").select("doc_id", F.length("text").cast("bigint").alias("n"), "lang")


@query("select vec_id, len(embedding) as dims, label from embeddings")
def scan_embeddings(spark, d):
    return table(spark, d, "embeddings").select("vec_id", F.size("embedding").cast("bigint").alias("dims"), "label")


@query("select doc_id from documents where source = 'forum-north'")
def filter_source(spark, d):
    return table(spark, d, "documents").where("source = 'forum-north'").select("doc_id")


@query(f"with {CHUNKS} select chunk_id from chunks where source_id = '{SOURCE}' and subject_root = '{SUBJECT}'")
def filter_source_subject(spark, d):
    return filter_chunks(chunks(spark, d), SOURCE, SUBJECT).select("chunk_id")


@query("select doc_id from documents where text is null or regexp_full_match(text, '[\\s\\x{1C}-\\x{1F}\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}\\x{0B}]*') or contains(text, chr(0))")
def unsafe_text_filter(spark, d):
    return table(spark, d, "documents").where(T.is_unsafe(F.col("text"))).select("doc_id")


_PRIVATE = r"(?i)(?:^|[^A-Z0-9])[A-Z]:[\\/]|\\\\(?:users|home|private|documents)[\\/]"


@query(f"select doc_id, regexp_matches(coalesce(text, ''), '{_PRIVATE}') as private from documents")
def private_path_scan(spark, d):
    return table(spark, d, "documents").select("doc_id", T.has_private_path(F.col("text")).alias("private"))


def _quoted(rx: str) -> str:
    return "'" + rx.replace("'", "''") + "'"


@query("\nunion all ".join(f"select '{name}' as pattern, doc_id from documents where regexp_matches(text, {_quoted(rx)})" for name, rx in T.SECRETS.items()))
def secret_scan(spark, d):
    return table(spark, d, "documents").select(F.explode(T.secrets(F.col("text"))).alias("pattern"), "doc_id")


@query(f"select knowledge_unit_id from knowledge_units where regexp_matches(coalesce(text, ''), {_quoted(T.ABSOLUTE_PATH)}) or regexp_matches(coalesce(source_locator, ''), {_quoted(T.ABSOLUTE_PATH)})")
def absolute_path_scan(spark, d):
    u = table(spark, d, "knowledge_units")
    return u.where(T.has_absolute_path(F.col("text")) | T.has_absolute_path(F.col("source_locator"))).select("knowledge_unit_id")


@query("select distinct node_id, regexp_full_match(node_id, '[A-Za-z0-9][A-Za-z0-9._-]{0,127}') as valid from kg_nodes where node_id is not null")
def identifier_check(spark, d):
    return table(spark, d, "kg_nodes").where("node_id is not null").select("node_id", T.is_identifier(F.col("node_id")).alias("valid")).distinct()


@query(f"select doc_id, regexp_replace(text, {_quoted(T.PATH_IN_MESSAGE)}, '<path>', 'g') as text from documents where text is not null")
def redact_paths(spark, d):
    return table(spark, d, "documents").where("text is not null").select("doc_id", T.redact_paths(F.col("text")).alias("text"))


@query("select event_id, json_extract_string(props, '$.k')::bigint as k from events")
def json_field(spark, d):
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"))


# joins


@query(f"""with {CHUNKS}, {UNITS} select c.chunk_id, u.knowledge_unit_id is null as missing, coalesce(c.title is not distinct from u.title, false) as same_title,
  coalesce(c.source_id is not distinct from u.source_id, false) as same_source from chunks c left join units u using (knowledge_unit_id)""")
def chunk_unit_join(spark, d):
    u = units(spark, d).select("knowledge_unit_id", F.col("title").alias("t"), F.col("source_id").alias("s"), F.lit(True).alias("known"))
    j = chunks(spark, d).join(u, "knowledge_unit_id", "left")
    return j.select("chunk_id", F.col("known").isNull().alias("missing"), F.col("title").eqNullSafe(F.col("t")).alias("same_title"), F.col("source_id").eqNullSafe(F.col("s")).alias("same_source"))


@query(f"""with {CHUNKS}, m as (select distinct chunk_id, knowledge_unit_id as mapped from chunk_to_kg where chunk_id is not null)
  select coalesce(c.chunk_id, m.chunk_id) as chunk_id, c.knowledge_unit_id as unit, mapped from chunks c full join m on m.chunk_id = c.chunk_id where c.knowledge_unit_id is distinct from mapped""")
def chunk_map_mismatch(spark, d):
    m = table(spark, d, "chunk_to_kg").where("chunk_id is not null").select("chunk_id", F.col("knowledge_unit_id").alias("mapped")).distinct()
    c = chunks(spark, d).select("chunk_id", F.col("knowledge_unit_id").alias("unit"))
    return c.join(m, "chunk_id", "full_outer").where(~F.col("unit").eqNullSafe(F.col("mapped"))).select("chunk_id", "unit", "mapped")


@query("""with m as (select distinct "row", chunk_id from vector_manifest), x as (select "row", any_value(len(embedding)) as dims from vector_matrix where "row" is not null group by 1)
  select coalesce(m."row", x."row") as "row", chunk_id, m."row" is not null as listed, x."row" is not null as held, dims from m full join x on x."row" = m."row" """)
def vector_entry_join(spark, d):
    m = table(spark, d, "vector_manifest").select("row", "chunk_id", F.lit(True).alias("listed")).distinct()
    x = table(spark, d, "vector_matrix").where("row is not null").groupBy("row").agg(F.first(F.when(F.col("embedding").isNotNull(), F.size("embedding"))).cast("bigint").alias("dims")).withColumn("held", F.lit(True))
    return m.join(x, "row", "full_outer").select("row", "chunk_id", F.col("listed").isNotNull().alias("listed"), F.col("held").isNotNull().alias("held"), "dims")


@query("""select r_name, n_name, count(*) as n_lines, round(sum(l_extendedprice * (1 - l_discount)), 2) as revenue from lineitem join supplier on s_suppkey = l_suppkey
  join nation on n_nationkey = s_nationkey join region on r_regionkey = n_regionkey group by 1, 2""")
def four_way_lineage_join(spark, d):
    """The long table is summed per supplier before it meets the dimensions."""
    per = table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("r"))
    s, n, r = (table(spark, d, t) for t in ("supplier", "nation", "region"))
    j = per.join(s, per.l_suppkey == s.s_suppkey).join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    return j.groupBy("r_name", "n_name").agg(F.sum("n").alias("n_lines"), F.round(F.sum("r"), 2).alias("revenue"))


@query(f"""with {NODES}, ends as (select edge_id, 'source' as side, source_node_id as node_id from kg_edges union all select edge_id, 'target', target_node_id from kg_edges)
  select distinct edge_id, side, node_id from ends e where node_id is not null and not exists (select 1 from nodes n where n.node_id = e.node_id)""")
def dangling_edges(spark, d):
    return G.dangling(table(spark, d, "kg_edges"), nodes(spark, d)).select("edge_id", "side", "node_id")


@query("select c_custkey from customer c where not exists (select 1 from orders o where o.o_custkey = c.c_custkey)")
def orphan_customers(spark, d):
    c, o = table(spark, d, "customer"), table(spark, d, "orders")
    return c.join(o.select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti").select("c_custkey")


@query(f"with {CHUNKS} select chunk_id from chunks c where exists (select 1 from external_references r where r.from_knowledge_unit_id = c.knowledge_unit_id)")
def relevant_semi(spark, d):
    return chunks(spark, d).join(table(spark, d, "external_references").select(F.col("from_knowledge_unit_id").alias("knowledge_unit_id")), "knowledge_unit_id", "left_semi").select("chunk_id")


@query("""select lower(trim(coalesce(relation, ''))) as relation, target_node_id in (select knowledge_unit_id from knowledge_units where knowledge_unit_id is not null) as internal, count(*) as n
  from kg_edges where target_node_id is not null group by 1, 2""")
def relation_split(spark, d):
    split = G.relation_split(table(spark, d, "kg_edges").where("target_node_id is not null"), table(spark, d, "knowledge_units"), "knowledge_unit_id")
    return split.groupBy(G.normalized_relation().alias("relation"), "internal").agg(F.count(F.lit(1)).alias("n"))


@query(f"""with {CHUNKS} select a.chunk_id as inner_id, b.chunk_id as outer_id from chunks a join chunks b on a.knowledge_unit_id = b.knowledge_unit_id and a.chunk_id <> b.chunk_id
  and a.body_start >= b.body_start and a.body_end <= b.body_end""")
def interval_containment(spark, d):
    c = chunks(spark, d)
    a = c.select("knowledge_unit_id", F.col("chunk_id").alias("inner_id"), F.col("body_start").alias("s"), F.col("body_end").alias("e"))
    b = c.select("knowledge_unit_id", F.col("chunk_id").alias("outer_id"), F.col("body_start").alias("lo"), F.col("body_end").alias("hi"))
    return a.join(b, "knowledge_unit_id").where("inner_id <> outer_id and s >= lo and e <= hi").select("inner_id", "outer_id")


@query("""with refs as (select distinct node_id, unnest(chapter_refs) as ref from kg_nodes where chapter_refs is not null), ids as (
    select distinct node_id as chapter, unnest([node_id, split_part(node_id, '-', -1)]) as id from kg_nodes where node_type = 'chapter')
  select r.node_id, r.ref, min(chapter) as chapter from refs r join ids on ids.id = r.ref group by 1, 2 having count(distinct chapter) = 1""")
def suffix_join_unique(spark, d):
    """A reference names a chapter by its id or by the id's last part; it counts if just one chapter answers."""
    n = table(spark, d, "kg_nodes")
    refs = n.where("chapter_refs is not null").select("node_id", F.explode("chapter_refs").alias("ref")).distinct()
    ids = n.where("node_type = 'chapter'").select(F.col("node_id").alias("chapter"), F.explode(F.array("node_id", F.substring_index("node_id", "-", -1))).alias("ref")).distinct()
    return refs.join(ids, "ref").groupBy("node_id", "ref").agg(F.min("chapter").alias("chapter"), F.count_distinct("chapter").alias("n")).where("n = 1").drop("n")


@query(f"""with {NODES}, k as (select node_id, min(node_type) as kind from nodes where node_id is not null group by 1), rules(s, t, r) as (values
  {", ".join(str(x) for x in G.ALLOWED)})
  select distinct edge_id, a.kind as source_type, b.kind as target_type, lower(trim(coalesce(relation, ''))) as relation from kg_edges e join k a on a.node_id = source_node_id join k b on b.node_id = target_node_id
  where not exists (select 1 from rules where s = a.kind and t = b.kind and r = lower(trim(coalesce(relation, ''))))""")
def edge_layer_check(spark, d):
    return G.layer_violations(table(spark, d, "kg_edges"), nodes(spark, d))


@query(f"""with {CHUNKS}, {UNITS} select c.chunk_id, coalesce(lower(c.full_text_sha256) = sha256(u.text), false) as matches from chunks c join units u using (knowledge_unit_id)""")
def cross_table_hash_check(spark, d):
    u = units(spark, d).select("knowledge_unit_id", F.sha2("text", 256).alias("h"))
    return chunks(spark, d).join(u, "knowledge_unit_id").select("chunk_id", F.coalesce(F.lower("full_text_sha256") == F.col("h"), F.lit(False)).alias("matches"))


# aggregates


@query("select text, count(*) as n from documents where text is not null group by 1 having count(*) > 1")
def duplicate_bodies(spark, d):
    """Grouped by hash, so that long texts don't travel as keys; the text of each group goes along once."""
    g = table(spark, d, "documents").where("text is not null").groupBy(F.sha2("text", 256).alias("h")).agg(F.count(F.lit(1)).alias("n"), F.min("text").alias("text"))
    return g.where("n > 1").select("text", "n")


@query("select edge_id, count(*) as n from kg_edges where edge_id is not null group by 1 having count(*) > 1")
def duplicate_keys(spark, d):
    return table(spark, d, "kg_edges").where("edge_id is not null").groupBy("edge_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


_CONTAINS = "lower(trim(relation)) = 'contains' and source_node_id is not null and target_node_id is not null"


@query(f"select target_node_id as child, list_sort(list(distinct source_node_id)) as parents from kg_edges where {_CONTAINS} group by 1")
def parents_per_unit(spark, d):
    e = table(spark, d, "kg_edges").where(G.normalized_relation() == "contains").where("source_node_id is not null and target_node_id is not null")
    return e.groupBy(F.col("target_node_id").alias("child")).agg(F.array_sort(F.collect_set("source_node_id")).alias("parents"))


@query(f"""with k as (select distinct knowledge_unit_id as id from knowledge_units where knowledge_unit_id is not null), p as (select target_node_id as id, count(distinct source_node_id) as n from kg_edges where {_CONTAINS} group by 1)
  select id as location, cast(coalesce(n, 0) as varchar) as detail from k left join p using (id) where coalesce(n, 0) <> 1""")
def single_parent_violations(spark, d):
    e = table(spark, d, "kg_edges").where(G.normalized_relation() == "contains").where("source_node_id is not null and target_node_id is not null")
    return R.exactly_one(table(spark, d, "knowledge_units").where("knowledge_unit_id is not null"), "knowledge_unit_id", e, "target_node_id", "source_node_id")


@query("""select label, count(*) as n, round(max(abs(sqrt(list_dot_product(embedding::double[], embedding::double[])) - 1)), 6) as worst from embeddings group by 1""")
def vector_norm_stats(spark, d):
    return table(spark, d, "embeddings").groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.round(F.max(F.abs(V.norm(F.col("embedding")) - 1)), 6).alias("worst"))


@query("select source_id, count(distinct knowledge_unit_id) as n_units, count(distinct package_id) as n_packages, sum(length(text))::bigint as n_chars from knowledge_units group by 1")
def coverage_totals(spark, d):
    return table(spark, d, "knowledge_units").groupBy("source_id").agg(F.count_distinct("knowledge_unit_id").alias("n_units"), F.count_distinct("package_id").alias("n_packages"), F.sum(F.length("text")).alias("n_chars"))


@query(f"""with {UNITS}, leaves as (select distinct ('0x' || substr(sha256(knowledge_unit_id), 1, 3))::int % 4096 as bucket, knowledge_unit_id || chr(9) || sha256(coalesce(text, '')) as leaf from units),
  b as (select bucket, count(*) as n, sha256(array_to_string(list(leaf order by leaf), chr(10))) as h from leaves group by 1)
  select sum(n)::bigint as n, sha256(array_to_string(list(h order by bucket), chr(10))) as root from b""")
def corpus_identity(spark, d):
    return I.corpus_identity(units(spark, d), "knowledge_unit_id", F.col("text"))


@query("select distinct source_id, subject_root from rag_chunks")
def distinct_dimensions(spark, d):
    return table(spark, d, "rag_chunks").select("source_id", "subject_root").distinct()


@query("select text_hash, min(doc_id) as main, count(distinct doc_id) - 1 as n_aliases from (select sha256(text) as text_hash, doc_id from documents where text is not null) group by 1")
def alias_merge_by_hash(spark, d):
    return I.alias_merge(table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("text_hash")), "doc_id", "text_hash")


@query(r"select doc_id, sha256(replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10))) as h from documents where text is not null")
def canonical_text_hash(spark, d):
    return table(spark, d, "documents").where("text is not null").select("doc_id", F.sha2(T.unified_lines(F.col("text")), 256).alias("h"))


@query("""select edge_id, source_node_id, target_node_id, recorded_at from kg_edges where edge_id is not null
  qualify row_number() over (partition by edge_id order by recorded_at desc nulls last, source_node_id nulls last, target_node_id nulls last) = 1""")
def overlay_latest(spark, d):
    last = latest(table(spark, d, "kg_edges"), ["edge_id"], F.desc_nulls_last("recorded_at"), F.asc_nulls_last("source_node_id"), F.asc_nulls_last("target_node_id"))
    return last.select("edge_id", "source_node_id", "target_node_id", "recorded_at")


@query("""select knowledge_unit_id, to_json({applicability: applicability, content_available: content_available, current_project_authority: current_project_authority, embedding_eligibility_basis: case when embedding_eligibility_basis is not null then
    {content_type: embedding_eligibility_basis.content_type, public_scope: embedding_eligibility_basis.public_scope, source_review_proof_sha256: embedding_eligibility_basis.source_review_proof_sha256} end,
    embedding_eligible: embedding_eligible, embedding_exclusion_reason: embedding_exclusion_reason, evidence_refs: evidence_refs, forbidden_transfer: forbidden_transfer, knowledge_layer: knowledge_layer,
    knowledge_unit_id: knowledge_unit_id, node_id: node_id, package_id: package_id, project_value_transfer_allowed: project_value_transfer_allowed, recorded_at: strftime(recorded_at, '%Y-%m-%dT%H:%M:%S.%f'),
    retrieval_eligible: retrieval_eligible, source_chain_id: source_chain_id, source_id: source_id, source_locator: source_locator, source_sha256: source_sha256, source_volume_id: source_volume_id,
    subject_root: subject_root, text: text, text_sha256: text_sha256, title: title, units_basis: units_basis, withdrawn_at: strftime(withdrawn_at, '%Y-%m-%dT%H:%M:%S.%f')})::varchar as line from knowledge_units""")
def canonical_json(spark, d):
    """Rows of the unit table as canonical JSON lines."""
    u = table(spark, d, "knowledge_units")
    return u.select("knowledge_unit_id", I.canonical_json(u).alias("line"))


@query(None)
def vector_row_hashes(spark, d):
    return I.vector_hashes(table(spark, d, "embeddings"), "vec_id", "embedding")


# windows, order, sets


@query(f"with {CHUNKS} select c.chunk_id, row_number() over (order by list_position(['TS20', 'KP26', 'HD11'], source_id) nulls last, chunk_id) as position from chunks c where source_id in ('TS20', 'KP26', 'HD11')")
def custom_order(spark, d):
    """Chunks of three sources in a given order of the sources."""
    order = F.array(*[F.lit(x) for x in ("TS20", "KP26", "HD11")])
    some = chunks(spark, d).where(F.col("source_id").isin("TS20", "KP26", "HD11")).withColumn("at", F.array_position(order, F.col("source_id")))
    return numbered(some.select("chunk_id", "at"), F.col("at"), F.col("chunk_id")).select("chunk_id", "position")


@query(f"with {CHUNKS} select chunk_id, row_number() over (order by list_position(['TS20', 'KP26', 'HD11'], source_id) nulls last, source_id nulls last, chunk_id) as position from chunks")
def whole_custom_order(spark, d):
    """All chunks in a given order of the sources; sources outside it come last, by their names."""
    order = F.array(*[F.lit(x) for x in ("TS20", "KP26", "HD11")])
    every = chunks(spark, d).withColumn("at", F.nullif(F.array_position(order, F.col("source_id")), F.lit(0).cast("bigint")))
    order = [F.col("at").asc_nulls_last(), F.col("source_id").asc_nulls_last(), F.col("chunk_id")]
    return numbered(every.select("chunk_id", "source_id", "at"), *order).select("chunk_id", "position")


@query("""select knowledge_unit_id, segment_index as location, chunk_id from (select *, lag(body_start) over (partition by knowledge_unit_id order by segment_index, chunk_id) as before from (select distinct * exclude (recorded_at) from rag_chunks))
  where before >= body_start""")
def order_violations(spark, d):
    """Chunks that don't start after the chunk before them."""
    c = table(spark, d, "rag_chunks").drop("recorded_at").distinct()
    w = Window.partitionBy("knowledge_unit_id").orderBy("segment_index", "chunk_id")
    return c.withColumn("before", F.lag("body_start").over(w)).where("before >= body_start").select("knowledge_unit_id", F.col("segment_index").alias("location"), "chunk_id")


_BUILT = """built as (select distinct 'edge:' || subject_root || ':contains:' || source_volume_id as edge_id from units where subject_root is not null and source_volume_id is not null union
  select distinct 'edge:' || source_volume_id || ':contains:' || knowledge_unit_id from units where source_volume_id is not null union
  select distinct 'edge:' || knowledge_unit_id || ':supported_by:' || ref from (select knowledge_unit_id, unnest(evidence_refs) as ref from units) where ref is not null)"""


@query(f"""with {UNITS}, {_BUILT}, stored as (select distinct edge_id from kg_edges where lower(trim(relation)) = 'supported_by' and edge_id is not null)
  select coalesce(b.edge_id, s.edge_id) as location, case when b.edge_id is null then 'missing left' else 'missing right' end as detail
  from (select edge_id from built where contains(edge_id, ':supported_by:')) b full join stored s on s.edge_id = b.edge_id where b.edge_id is null or s.edge_id is null""")
def edge_set_diff(spark, d):
    built = G.build_edges(units(spark, d)).where("relation = 'supported_by'")
    stored = table(spark, d, "kg_edges").where(G.normalized_relation() == "supported_by").where("edge_id is not null")
    return R.same_sets(built, stored, ["edge_id"])


@query("""select chunk_id, 'missing' as what from (select chunk_id from rag_chunks except select chunk_id from vector_manifest) where chunk_id is not null
  union all select chunk_id, 'extra' from (select chunk_id from vector_manifest except select chunk_id from rag_chunks) where chunk_id is not null""")
def missing_extra_keys(spark, d):
    a, b = (table(spark, d, t).select("chunk_id").where("chunk_id is not null") for t in ("rag_chunks", "vector_manifest"))
    return a.subtract(b).withColumn("what", F.lit("missing")).unionByName(b.subtract(a).withColumn("what", F.lit("extra")))


@query("select knowledge_unit_id as id from rag_chunks intersect select from_knowledge_unit_id from external_references")
def overlap_ids(spark, d):
    return table(spark, d, "rag_chunks").select(F.col("knowledge_unit_id").alias("id")).intersect(table(spark, d, "external_references").select(F.col("from_knowledge_unit_id").alias("id")))


@query(f"""with {CHUNKS}, {UNITS} select chunk_id, list_filter([case when c.title is distinct from u.title then 'title' end, case when c.source_id is distinct from u.source_id then 'source_id' end,
  case when lower(c.full_text_sha256) is distinct from lower(u.text_sha256) then 'text_sha256' end], lambda x: x is not null) as differing from chunks c join units u using (knowledge_unit_id) where len(differing) > 0""")
def field_diff(spark, d):
    c = chunks(spark, d).select("chunk_id", "knowledge_unit_id", "title", "source_id", F.lower("full_text_sha256").alias("text_sha256"))
    u = units(spark, d).select("knowledge_unit_id", "title", "source_id", F.lower("text_sha256").alias("text_sha256"))
    per_chunk = c.select("chunk_id", "knowledge_unit_id").join(u, "knowledge_unit_id")
    return R.field_diff(c, per_chunk, "chunk_id", ["title", "source_id", "text_sha256"])


# segmentation

_SEGMENTS = """seg as (
    select id, text, 0 as i, 0 as s, e_of as e from (select id, text, {first} as e_of from src)
    union all
    select id, text, i + 1, nxt, {later} from (select id, text, i, s, e, case when e - s <= 1 then e else e - least(60, e - s - 1) end as nxt from seg where e < length(text)))"""


def _end(s: str) -> str:
    best = f"least(length(text), {s} + 400)"
    natural = f"list_max(list_filter(range({s} + greatest(greatest(1, (({best} - {s}) * 3 + 4) // 5), 2), {best} + 1), lambda p: contains('。！？!?；;.' || chr(10), substr(text, p, 1))))"
    return f"case when {best} = length(text) then {best} else coalesce({natural}, {best}) end"


SEGMENTS = _SEGMENTS.format(first=_end("0"), later=_end("nxt"))


def _segments(spark, d):
    return S.segment(table(spark, d, "documents"), "doc_id", "text", 400)


_DOC_SEG = f"with recursive src as (select doc_id as id, text from documents where text is not null and text <> ''), {SEGMENTS}"


@query(f"{_DOC_SEG} select id as doc_id, i::int as segment_index, s::int as body_start, e::int as body_end, (count(*) over (partition by id))::int as segment_count from seg")
def segment_documents(spark, d):
    return _segments(spark, d)


@query(f"""with recursive {UNITS}, src as (select knowledge_unit_id as id, text from units where text is not null and text <> ''), {SEGMENTS}
  select format('{{}}:chunk:{{:03d}}', id, i + 1) as chunk_id, id as knowledge_unit_id, sha256(concat_ws(chr(10), coalesce(u.title, ''), substr(seg.text, s + 1, e - s), coalesce(array_to_string(u.applicability, chr(10)), ''))) as search_sha256,
    s::int as body_start, e::int as body_end, (count(*) over (partition by id))::int as segment_count from seg join units u on u.knowledge_unit_id = id""")
def chunk_rows(spark, d):
    u = units(spark, d)
    rows = S.chunk_rows(u, S.segment(u, "knowledge_unit_id", "text", 400))
    return rows.select("chunk_id", "knowledge_unit_id", F.sha2("search_text", 256).alias("search_sha256"), "body_start", "body_end", "segment_count")


_COVER = "cover as (select *, coalesce(max(body_end) over (partition by knowledge_unit_id order by body_start, body_end rows between unbounded preceding and 1 preceding), 0) as prev from (select distinct chunk_id, knowledge_unit_id, body_start, body_end from rag_chunks))"


def _cover(spark, d):
    return S.coverage(table(spark, d, "rag_chunks").select("chunk_id", "knowledge_unit_id", "body_start", "body_end").distinct(), "knowledge_unit_id")


@query(f"with {_COVER} select chunk_id, body_start - prev as gap from cover where body_start > prev")
def segment_gaps(spark, d):
    return _cover(spark, d).where("gap > 0").select("chunk_id", "gap")


@query(f"with {_COVER} select chunk_id, prev - body_start as overlap from cover where prev - body_start > 60")
def segment_overlap(spark, d):
    return _cover(spark, d).where("overlap > 60").select("chunk_id", "overlap")


@query(f"with {UNITS}, e as (select knowledge_unit_id, max(body_end) as last, min(body_start) as first from rag_chunks group by 1) select knowledge_unit_id, first, last, length(text) as length from e join units using (knowledge_unit_id) where last is distinct from length(text) or first <> 0")
def segment_coverage(spark, d):
    """Units whose chunks don't reach from the start to the end of the text."""
    e = table(spark, d, "rag_chunks").groupBy("knowledge_unit_id").agg(F.max("body_end").alias("last"), F.min("body_start").alias("first"))
    j = e.join(units(spark, d).select("knowledge_unit_id", F.length("text").cast("bigint").alias("length")), "knowledge_unit_id")
    return j.where(~F.col("last").eqNullSafe(F.col("length")) | (F.col("first") != 0)).select("knowledge_unit_id", "first", "last", "length")


# graph


@query(f"""with {UNITS}, n as (select subject_root as node_id, 'subject_root' as node_type, subject_root, null as source_id, null as source_volume_id, null as knowledge_unit_id from units
  union select source_volume_id, 'source_volume', subject_root, source_id, source_volume_id, null from units union select knowledge_unit_id, 'knowledge_unit', subject_root, source_id, source_volume_id, knowledge_unit_id from units
  union select unnest(evidence_refs), 'evidence', subject_root, source_id, source_volume_id, null from units) select * from n where node_id is not null""")
def kg_nodes(spark, d):
    return G.build_nodes(units(spark, d))


@query(f"with {UNITS}, {_BUILT} select edge_id from built")
def kg_edges(spark, d):
    return G.build_edges(units(spark, d)).select("edge_id")


@query(f"with {UNITS} select distinct ref as evidence_id, knowledge_unit_id, source_id, text_sha256 as reviewed_text_sha256 from (select *, unnest(evidence_refs) as ref from units) where ref is not null")
def evidence_rows(spark, d):
    return units(spark, d).select(F.explode("evidence_refs").alias("evidence_id"), "knowledge_unit_id", "source_id", F.col("text_sha256").alias("reviewed_text_sha256")).where("evidence_id is not null").distinct()


@query("select source_volume_id as key, count(distinct (subject_root, source_id)) as n_definitions from kg_nodes where source_volume_id is not null and subject_root is not null and source_id is not null group by 1 having count(distinct (subject_root, source_id)) > 1")
def fd_violations(spark, d):
    held = table(spark, d, "kg_nodes").where("subject_root is not null and source_id is not null")
    return G.dependency_violations(held, "source_volume_id", "subject_root", "source_id").withColumnRenamed("source_volume_id", "key")


@query(f"""with {NODES}, s as (select node_id, min(source_volume_id) as scope from nodes where node_id is not null group by 1), e as (select distinct edge_id, source_node_id, target_node_id from kg_edges where lower(trim(relation)) = 'contains')
  select edge_id, a.scope as source_scope, b.scope as target_scope from e join s a on a.node_id = source_node_id join s b on b.node_id = target_node_id where a.scope <> b.scope""")
def scope_mismatch(spark, d):
    return G.scope_mismatch(table(spark, d, "kg_edges"), nodes(spark, d))


# integrity

#: Types of nodes and relations of the data model (fixed values).
NODE_TYPES = ("subject_root", "source_volume", "chapter", "section", "support_unit", "knowledge_unit", "evidence", "shared_term")
RELATIONS = ("contains", "supported_by", "has_chapter_context", "related_to")

RULES = [
    R.row_rule("unit_id_present", "units", "node_id", lambda: F.col("knowledge_unit_id").isNotNull()),
    R.row_rule("unit_is_node", "units", "knowledge_unit_id", lambda: F.col("knowledge_unit_id") == F.col("node_id")),
    R.row_rule("unit_text_present", "units", "knowledge_unit_id", lambda: ~T.is_blank(F.col("text"))),
    R.row_rule("unit_title_present", "units", "knowledge_unit_id", lambda: F.length("title") > 0),
    R.row_rule("unit_hash_shape", "units", "knowledge_unit_id", lambda: T.is_sha256(F.col("text_sha256"))),
    R.Rule("unit_hash", lambda t: R.hash_matches(t["units"], "knowledge_unit_id", "text", "text_sha256")),
    R.Rule("unit_repeated", lambda t: R.unique(t["units"], "knowledge_unit_id")),
    R.row_rule("unit_chain_id", "units", "knowledge_unit_id", lambda: F.substring_index("source_chain_id", ":", -1) == F.col("source_id")),
    R.row_rule("unit_applicability", "units", "knowledge_unit_id", lambda: F.forall("applicability", lambda x: F.length(x) > 0)),
    R.Rule("chunk_repeated", lambda t: R.unique(t["chunks"], "chunk_id")),
    R.Rule("chunk_unit_known", lambda t: R.refers(t["chunks"], "chunk_id", "knowledge_unit_id", t["units"], "knowledge_unit_id")),
    R.row_rule("chunk_id_form", "chunks", "chunk_id", lambda: F.col("chunk_id").rlike(r"\A.+:chunk:[0-9]{3}\z")),
    R.row_rule("chunk_interval", "chunks", "chunk_id", lambda: (F.col("body_start") >= 0) & (F.col("body_end") > F.col("body_start"))),
    R.Rule("map_unit_known", lambda t: R.refers(t["map"], "chunk_id", "knowledge_unit_id", t["units"], "knowledge_unit_id")),
    R.Rule("edge_source_known", lambda t: R.refers(t["edges"], "edge_id", "source_node_id", t["nodes"], "node_id")),
    R.Rule("edge_target_known", lambda t: R.refers(t["edges"], "edge_id", "target_node_id", t["nodes"], "node_id")),
    R.row_rule("edge_id_form", "edges", "edge_id", lambda: F.col("edge_id").startswith("edge:")),
    R.Rule("vector_chunk_known", lambda t: R.refers(t["manifest"], "row", "chunk_id", t["chunks"], "chunk_id")),
    R.row_rule("vector_valid", "matrix", "row", lambda: V.is_valid(F.col("embedding"), 512)),
    R.row_rule("chunk_segment_index", "chunks", "chunk_id", lambda: (F.col("segment_index") >= 0) & (F.coalesce("segment_count", F.col("segment_index") + 1) > F.col("segment_index"))),
    R.row_rule("chunk_token_count", "chunks", "chunk_id", lambda: F.col("token_count") > 0),
    R.row_rule("chunk_hash_shape", "chunks", "chunk_id", lambda: T.is_sha256(F.lower("full_text_sha256"))),
    R.row_rule("chunk_within_text", "chunk_texts", "chunk_id", lambda: F.col("body_end") <= F.col("length")),
    R.row_rule("chunk_title", "chunk_texts", "chunk_id", lambda: F.col("title").eqNullSafe(F.col("unit_title"))),
    R.row_rule("chunk_text_hash", "chunk_texts", "chunk_id", lambda: F.lower("full_text_sha256") == F.col("hash")),
    R.Rule("chunk_segment_count", lambda t: R.predicate(t["chunks"].where("segment_count is not null").join(t["chunks"].groupBy("knowledge_unit_id").agg(F.count_distinct("chunk_id").alias("held")), "knowledge_unit_id"), "chunk_id", F.col("segment_count") == F.col("held"))),
    R.Rule("map_matches_chunks", lambda t: R.same_sets(t["chunks"].where("chunk_id is not null"), t["map"].where("chunk_id is not null"), ["chunk_id"])),
    R.row_rule("manifest_hash_shape", "manifest", "row", lambda: T.is_sha256(F.col("input_sha256")) & T.is_sha256(F.col("vector_sha256"))),
    R.Rule("manifest_row_repeated", lambda t: R.unique(t["manifest"], "row")),
    R.Rule("manifest_matches_matrix", lambda t: R.same_sets(t["manifest"].where("row is not null"), t["matrix"].where("row is not null"), ["row"])),
    R.row_rule("node_type_known", "nodes", "node_id", lambda: F.col("node_type").isin(*NODE_TYPES)),
    R.Rule("node_label_present", lambda t: R.predicate(t["nodes"].where("node_type <> 'evidence'"), "node_id", ~T.is_blank(F.col("label")))),
    R.Rule("node_chapter_number", lambda t: R.predicate(t["nodes"].where("node_type = 'chapter'"), "node_id", F.col("chapter_number") >= 1)),
    R.Rule("node_of_unit", lambda t: R.predicate(t["nodes"].where("node_type in ('knowledge_unit', 'support_unit')"), "node_id", F.col("knowledge_unit_id") == F.col("node_id"))),
    R.Rule("node_repeated", lambda t: R.unique(t["nodes"].select("node_id", "node_type", "recorded_at").distinct(), "node_id")),
    R.row_rule("edge_relation_known", "edges", "edge_id", lambda: G.normalized_relation().isin(*RELATIONS)),
    R.Rule("edge_no_loop", lambda t: R.predicate(t["edges"].where("target_node_id is not null"), "edge_id", F.col("source_node_id") != F.col("target_node_id"))),
    R.Rule("edge_id_of_ends", lambda t: R.predicate(t["edges"].where("target_node_id is not null"), "edge_id", F.col("edge_id").startswith(F.concat(F.lit("edge:"), "source_node_id", F.lit(":"), G.normalized_relation(), F.lit(":"), "target_node_id")))),
    R.Rule("edge_link_repeated", lambda t: R.unique(t["edges"].withColumn("relation", G.normalized_relation()).select("edge_id", "source_node_id", "relation", "target_node_id").where("source_node_id is not null and target_node_id is not null").distinct(), "source_node_id", "relation", "target_node_id")),
    R.row_rule("external_complete", "external", "reference_id", lambda: F.col("target_project").isNotNull() & F.col("target_node_id").isNotNull() & F.col("relation").isNotNull()),
    R.Rule("external_from_known", lambda t: R.refers(t["external"], "reference_id", "from_knowledge_unit_id", t["units"], "knowledge_unit_id")),
    R.Rule("external_stays_external", lambda t: R.predicate(t["external"].where("target_node_id is not null").join(t["nodes"].select(F.col("node_id").alias("target_node_id")).distinct(), "target_node_id", "left_semi"), "reference_id", F.lit(False))),
    R.Rule("evidence_known", lambda t: R.refers(t["units"].select("knowledge_unit_id", F.explode("evidence_refs").alias("ref")), "knowledge_unit_id", "ref", t["nodes"], "node_id")),
]
_TABLES = {"units": "knowledge_units", "chunks": "rag_chunks", "map": "chunk_to_kg", "edges": "kg_edges", "manifest": "vector_manifest", "matrix": "vector_matrix", "external": "external_references"}
_BLANK = "regexp_full_match(text, '[\\s\\x{1C}-\\x{1F}\\x{85}\\x{A0}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}\\x{0B}]*')"
_WITH_TEXT = "(select c.*, u.title as unit_title, u.text from rag_chunks c join units u using (knowledge_unit_id))"
_RULE_SQL = {
    "unit_id_present": ("knowledge_units", "node_id", "knowledge_unit_id is not null"), "unit_is_node": ("knowledge_units", "knowledge_unit_id", "knowledge_unit_id = node_id"),
    "unit_text_present": ("knowledge_units", "knowledge_unit_id", f"text is not null and not {_BLANK}"), "unit_title_present": ("knowledge_units", "knowledge_unit_id", "length(title) > 0"),
    "unit_hash_shape": ("knowledge_units", "knowledge_unit_id", "regexp_full_match(text_sha256, '[0-9a-f]{64}')"), "unit_hash": ("knowledge_units", "knowledge_unit_id", "sha256(text) = lower(text_sha256)"),
    "unit_chain_id": ("knowledge_units", "knowledge_unit_id", "split_part(source_chain_id, ':', -1) = source_id"), "unit_applicability": ("knowledge_units", "knowledge_unit_id", "len(list_filter(applicability, lambda x: coalesce(length(x), 0) = 0)) = 0"),
    "chunk_id_form": ("rag_chunks", "chunk_id", "regexp_full_match(chunk_id, '(?s).+:chunk:[0-9]{3}')"), "chunk_interval": ("rag_chunks", "chunk_id", "body_start >= 0 and body_end > body_start"),
    "chunk_segment_index": ("rag_chunks", "chunk_id", "segment_index >= 0 and coalesce(segment_count, segment_index + 1) > segment_index"), "chunk_token_count": ("rag_chunks", "chunk_id", "token_count > 0"),
    "chunk_hash_shape": ("rag_chunks", "chunk_id", "regexp_full_match(lower(full_text_sha256), '[0-9a-f]{64}')"), "chunk_within_text": (_WITH_TEXT, "chunk_id", "body_end <= length(text)"),
    "chunk_title": (_WITH_TEXT, "chunk_id", "title is not distinct from unit_title"), "chunk_text_hash": (_WITH_TEXT, "chunk_id", "lower(full_text_sha256) = sha256(text)"),
    "chunk_segment_count": ("(select * from rag_chunks join (select knowledge_unit_id, count(distinct chunk_id) as held from rag_chunks group by 1) using (knowledge_unit_id) where segment_count is not null)", "chunk_id", "segment_count = held"),
    "manifest_hash_shape": ("vector_manifest", '"row"', "regexp_full_match(input_sha256, '[0-9a-f]{64}') and regexp_full_match(vector_sha256, '[0-9a-f]{64}')"),
    "node_type_known": ("nodes", "node_id", f"node_type in {NODE_TYPES}"), "node_label_present": ("(select * from nodes where node_type <> 'evidence')", "node_id", "label is not null and trim(label) <> ''"),
    "node_chapter_number": ("(select * from nodes where node_type = 'chapter')", "node_id", "chapter_number >= 1"), "node_of_unit": ("(select * from nodes where node_type in ('knowledge_unit', 'support_unit'))", "node_id", "knowledge_unit_id = node_id"),
    "edge_relation_known": ("kg_edges", "edge_id", f"lower(trim(coalesce(relation, ''))) in {RELATIONS}"), "edge_no_loop": ("(select * from kg_edges where target_node_id is not null)", "edge_id", "source_node_id <> target_node_id"),
    "edge_id_of_ends": ("(select * from kg_edges where target_node_id is not null)", "edge_id", "starts_with(edge_id, 'edge:' || source_node_id || ':' || lower(trim(coalesce(relation, ''))) || ':' || target_node_id)"),
    "external_complete": ("external_references", "reference_id", "target_project is not null and target_node_id is not null and relation is not null"),
    "external_stays_external": ("(select * from external_references where target_node_id in (select node_id from nodes))", "reference_id", "false"),
    "edge_id_form": ("kg_edges", "edge_id", "starts_with(edge_id, 'edge:')"),
    "vector_valid": ("vector_matrix", '"row"', "len(embedding) = 512 and list_count(embedding) = 512 and len(list_filter(embedding, lambda y: not isfinite(y))) = 0 and len(list_filter(embedding, lambda y: y <> 0)) > 0"),
}
_REFERS = {
    "chunk_unit_known": ("rag_chunks", "chunk_id", "knowledge_unit_id", "knowledge_units", "knowledge_unit_id"), "map_unit_known": ("chunk_to_kg", "chunk_id", "knowledge_unit_id", "knowledge_units", "knowledge_unit_id"),
    "edge_source_known": ("kg_edges", "edge_id", "source_node_id", "nodes", "node_id"), "edge_target_known": ("kg_edges", "edge_id", "target_node_id", "nodes", "node_id"),
    "external_from_known": ("external_references", "reference_id", "from_knowledge_unit_id", "knowledge_units", "knowledge_unit_id"),
    "vector_chunk_known": ("vector_manifest", '"row"', "chunk_id", "rag_chunks", "chunk_id"), "evidence_known": ("(select knowledge_unit_id, unnest(evidence_refs) as ref from knowledge_units)", "knowledge_unit_id", "ref", "nodes", "node_id"),
}
_REPORT = f"with {NODES}, {UNITS} " + "\nunion all ".join(
    [f"select '{c}' as code, cast({k} as varchar) as location, null::varchar as detail from {t} where not coalesce({p}, false)" for c, (t, k, p) in _RULE_SQL.items()]
    + [f"select '{c}', cast({k} as varchar), {r} from {t} x where {r} is not null and not exists (select 1 from {pt} y where y.{pk} = x.{r})" for c, (t, k, r, pt, pk) in _REFERS.items()]
    + [f"select '{c}', cast({k} as varchar), cast(count(*) as varchar) from {t} group by {k} having count(*) > 1" for c, t, k in (("unit_repeated", "knowledge_units", "knowledge_unit_id"), ("chunk_repeated", "rag_chunks", "chunk_id"), ("manifest_row_repeated", "vector_manifest", '"row"'), ("node_repeated", "(select distinct node_id, node_type, recorded_at from nodes)", "node_id"))]
    + ["""select 'edge_link_repeated', source_node_id || '|' || relation || '|' || target_node_id, cast(count(*) as varchar) from (select distinct edge_id, source_node_id, lower(trim(coalesce(relation, ''))) as relation, target_node_id from kg_edges
      where source_node_id is not null and target_node_id is not null) group by source_node_id, relation, target_node_id having count(*) > 1"""]
    + [f"""select '{c}', cast(coalesce(a.k, b.k) as varchar), case when a.k is null then 'missing left' else 'missing right' end from (select distinct {k} as k from {x} where {k} is not null) a
      full join (select distinct {k} as k from {y} where {k} is not null) b on a.k = b.k where a.k is null or b.k is null""" for c, k, x, y in (("map_matches_chunks", "chunk_id", "rag_chunks", "chunk_to_kg"), ("manifest_matches_matrix", '"row"', "vector_manifest", "vector_matrix"))]
)


@query(_REPORT)
def validation_report(spark, d):
    u = units(spark, d)
    texts = u.select("knowledge_unit_id", F.col("title").alias("unit_title"), F.length("text").alias("length"), F.sha2("text", 256).alias("hash"))
    held = {k: table(spark, d, t) for k, t in _TABLES.items()} | {"nodes": nodes(spark, d)}
    return R.report(held | {"chunk_texts": held["chunks"].join(texts, "knowledge_unit_id")}, RULES)


@query(_REPORT.replace("with nodes", "with r as (with nodes", 1) + ") select code, count(*) as n from r group by 1")
def validation_summary(spark, d):
    return validation_report(spark, d).groupBy("code").agg(F.count(F.lit(1)).alias("n"))


@query("select (select count(*) from rag_chunks) as n_chunks, (select count(*) from chunk_to_kg) as n_maps, (select count(*) from vector_manifest) as n_vectors, (select count(*) from vector_manifest) <= (select count(*) from rag_chunks) as vectors_within")
def count_inequality(spark, d):
    n = lambda t, name: table(spark, d, t).agg(F.count(F.lit(1)).alias(name))
    # three rows of one number each
    one = n("rag_chunks", "n_chunks").join(n("chunk_to_kg", "n_maps")).join(n("vector_manifest", "n_vectors"))
    return one.withColumn("vectors_within", F.col("n_vectors") <= F.col("n_chunks"))


# page ledgers: the physical pages of the source locators

_PAGES = r"""spans as (select source_id, knowledge_unit_id, regexp_extract(source_locator, '(\d+)\s*[–-]\s*(\d+)', 1)::int as lo, regexp_extract(source_locator, '(\d+)\s*[–-]\s*(\d+)', 2)::int as hi from units
  where regexp_matches(source_locator, '\d+\s*[–-]\s*\d+'))"""


def _pages(spark, d):
    rx = r"(\d+)\s*[–-]\s*(\d+)"
    u = units(spark, d).where(F.col("source_locator").rlike(rx))
    return u.select("source_id", "knowledge_unit_id", F.regexp_extract("source_locator", rx, 1).cast("int").alias("lo"), F.regexp_extract("source_locator", rx, 2).cast("int").alias("hi"))


@query(f"""with {UNITS}, {_PAGES}, p as (select source_id, unnest(range(lo, hi + 1)) as page from spans where hi >= lo), c as (select source_id, page, count(*) as n from p group by 1, 2),
  every as (select source_id, unnest(range(1, last + 1)) as page from (select source_id, max(hi) as last from spans group by 1))
  select source_id, page::int as page, coalesce(n, 0) as n from every left join c using (source_id, page) where coalesce(n, 0) <> 1""")
def page_ledger_exactly_once(spark, d):
    """Pages from 1 to the last of a source that no unit, or more than one, covers."""
    s = _pages(spark, d)
    n = s.where("hi >= lo").select("source_id", F.explode(F.sequence("lo", "hi")).alias("page")).groupBy("source_id", "page").agg(F.count(F.lit(1)).alias("n"))
    every = s.groupBy("source_id").agg(F.max("hi").alias("last")).where("last >= 1").select("source_id", F.explode(F.sequence(F.lit(1), F.col("last"))).alias("page"))
    return every.join(n, ["source_id", "page"], "left").withColumn("n", F.coalesce("n", F.lit(0))).where("n <> 1")


@query(f"with {UNITS}, {_PAGES} select source_id, knowledge_unit_id, prev as reached, lo from (select *, max(hi) over (partition by source_id order by lo, hi, knowledge_unit_id rows between unbounded preceding and 1 preceding) as prev from spans) where prev >= lo")
def range_overlap(spark, d):
    """Page spans that start before an earlier span of the source has ended: one pass with a running end, no pairs."""
    w = Window.partitionBy("source_id").orderBy("lo", "hi", "knowledge_unit_id").rowsBetween(Window.unboundedPreceding, -1)
    return _pages(spark, d).withColumn("reached", F.max("hi").over(w)).where("reached >= lo").select("source_id", "knowledge_unit_id", "reached", "lo")


@query("select node_id, unnest(range(len(chapter_refs)))::int as position, unnest(chapter_refs) as ref from (select distinct node_id, chapter_refs from kg_nodes where chapter_refs is not null)")
def ordered_relation(spark, d):
    return table(spark, d, "kg_nodes").where("chapter_refs is not null").select("node_id", "chapter_refs").distinct().select("node_id", F.posexplode("chapter_refs").alias("position", "ref"))


# evaluation: titles asked of their own chunks, the unit of the asked entry being the target


def _runs(spark, d, methods):
    c = chunks(spark, d)
    s, q = Searcher(c, chunk_vectors(spark, d)), both_ways(spark, d)
    out = None
    for m in methods:
        one = s.search(q, m, 20).select(F.lit(m).alias("method"), "query", "rank", F.col("unit").alias("id"))
        out = one if out is None else out.unionByName(one)
    return out


def _judged(spark, d):
    """Queries with roles, and what they should and should not find.

    A query of the first two roles is to find the asked entry's unit, and one of the second all units related to it too; a negative one must
    not find those related units; they are context for the others.
    """
    c = chunks(spark, d).select("chunk_id", "knowledge_unit_id", "source_id")
    q = both_ways(spark, d).select("query").join(table(spark, d, "vector_manifest").select(F.col("row").cast("bigint").alias("query"), "chunk_id").distinct(), "query").join(c, "chunk_id")
    queries = q.select("query", F.element_at(F.array(*[F.lit(r) for r in E.ROLES]), (F.pmod(F.col("query") / 20, F.lit(4)) + 1).cast("int")).alias("role"))
    related = table(spark, d, "kg_edges").where(G.normalized_relation() == "related_to").select(F.col("source_node_id").alias("knowledge_unit_id"), F.col("target_node_id").alias("id"))
    roles = q.join(queries, "query")
    own = roles.where("role in ('any_hit', 'all_relevant')").select("query", F.col("knowledge_unit_id").alias("id"), F.lit("primary").alias("kind"))
    near = roles.join(related, "knowledge_unit_id").where("id <> knowledge_unit_id")
    as_kind = F.when(F.col("role") == "all_relevant", "primary").when(F.col("role") == "negative", "must_not").otherwise("context")
    return queries.distinct(), own.unionByName(near.select("query", "id", as_kind.alias("kind"))).where("id is not null").distinct()


def _lexical_run(spark, d):
    """The lexical rankings, written once: they are checked, then scored."""
    return Workspace(spark, "run").write(_runs(spark, d, ("lexical",)).drop("method"), "lexical")


_EVAL = f"""with {CHUNKS}, {VECTORS}, {WAYS}, {bm25_sql('chunks', 'chunk_id', 'search_text', 'ways')}, {BEST},
  run as (select query, unit as id, row_number() over (partition by query order by round(score, 9) desc, unit) as rank from best where score > 0 qualify rank <= 20),
  q as (select distinct w.query, m.chunk_id, c.knowledge_unit_id from ways w join vector_manifest m on m."row" = w.query join chunks c using (chunk_id)),
  roles as (select distinct query, ['any_hit', 'all_relevant', 'negative', 'relation_only'][(query // 20 % 4 + 1)::int] as role from q),
  rel as (select query, knowledge_unit_id as id, 'primary' as kind from q join roles using (query) where role in ('any_hit', 'all_relevant') and knowledge_unit_id is not null
    union select query, target_node_id, case role when 'all_relevant' then 'primary' when 'negative' then 'must_not' else 'context' end
    from q join roles using (query) join kg_edges e on e.source_node_id = q.knowledge_unit_id and lower(trim(relation)) = 'related_to' where target_node_id <> knowledge_unit_id),
  hits as (select * from run join rel using (query, id)),
  per as (select query, min(rank) filter (kind = 'primary') as first, count(*) filter (kind = 'primary') as hits, coalesce(sum(1 / log2(rank + 1)) filter (kind = 'primary' and rank <= 10), 0) as dcg,
    list(id order by rank) filter (kind = 'must_not') as bad, list(rank::int order by rank) filter (kind = 'context') as ctx from hits group by 1),
  np as (select query, count(*) as n_primary from rel where kind = 'primary' group by 1),
  diag as (select query, role, n_primary, coalesce(hits, 0) > 0 as hit, first, case when first <= 10 then 1.0 / first else 0 end as mrr, coalesce(first = 1, false) as rank1, coalesce(hits, 0) / n_primary as recall,
    coalesce(dcg, 0) / list_sum(list_transform(range(1, least(n_primary, 10)::int + 1), lambda i: 1 / log2(i + 1))) as ndcg, coalesce(bad, []) as bad, coalesce(ctx, []) as ctx
    from roles left join per using (query) left join np using (query))"""
_POS = "role in ('any_hit', 'all_relevant')"


def _diagnosed(spark, d):
    queries, qrels = _judged(spark, d)
    return E.evaluate(queries, qrels, _lexical_run(spark, d))


@query(f"{_EVAL} select query, hit, first::bigint as first_rank, mrr::double as mrr, rank1 from diag where {_POS}")
def eval_hit_mrr(spark, d):
    return _diagnosed(spark, d).where("role in ('any_hit', 'all_relevant')").select("query", "hit", F.col("first_rank").cast("bigint").alias("first_rank"), "mrr", "rank1")


@query(f"{_EVAL} select query, round(recall, 9) as recall, round(ndcg, 9) as ndcg from diag where role = 'all_relevant'")
def eval_recall_ndcg(spark, d):
    return _diagnosed(spark, d).where("role = 'all_relevant'").select("query", F.round("recall", 9).alias("recall"), F.round("ndcg", 9).alias("ndcg"))


@query(f"{_EVAL} select query, len(bad) = 0 as clean, bad as violations from diag where role = 'negative'")
def eval_must_not(spark, d):
    return _diagnosed(spark, d).where("role = 'negative'").select("query", "clean", "violations")


@query(f"{_EVAL} select query, ctx as context_ranks from diag")
def eval_context_ranks(spark, d):
    return _diagnosed(spark, d).select("query", "context_ranks")


@query(f"""{_EVAL} select role, count(*) as n_cases, round(avg(hit::int) filter ({_POS}), 9) as hit_at_k, round(avg(mrr) filter ({_POS}), 9) as mrr_at_k, round(avg(rank1::int) filter ({_POS}), 9) as rank1_rate,
  round(avg(recall) filter (role = 'all_relevant'), 9) as recall_at_k, round(avg(ndcg) filter (role = 'all_relevant'), 9) as ndcg_at_k, round(avg((len(bad) = 0)::int) filter (role = 'negative'), 9) as clean_rate from diag group by 1""")
def eval_aggregate(spark, d):
    a = E.aggregate(_diagnosed(spark, d), "role")
    return a.select("role", "n_cases", *[F.round(c, 9).alias(c) for c in a.columns[2:]])


@query("with r(role) as (values ('any_hit'), ('all_relevant'), ('negative'), ('relation_only')), q as (select distinct doc_kind as role from documents) select role, 0::bigint as n from r union all select null, null where false")
def role_counts(spark, d):
    """Roles of a query set that uses none of them still come out, with 0."""
    return E.role_counts(table(spark, d, "documents").select(F.col("doc_kind").alias("role")))


@query(f"{_EVAL} select role, count(r.query) as n from (values ('any_hit'), ('all_relevant'), ('negative'), ('relation_only')) x(role) left join roles r using (role) group by 1")
def judged_role_counts(spark, d):
    """The roles of the judged queries."""
    return E.role_counts(_judged(spark, d)[0])


def _by_method(spark, d, *by):
    q, qrels = _judged(spark, d)
    run = Searcher(chunks(spark, d), chunk_vectors(spark, d)).compare(both_ways(spark, d), 5).withColumnRenamed("unit", "id")
    first = run.join(qrels.where("kind = 'primary'").select("query", "id").distinct(), ["query", "id"]).groupBy("method", "query").agg(F.min("rank").alias("first"))
    methods = spark.createDataFrame([("lexical",), ("dense",), ("hybrid",)], "method string")
    # three methods
    every = q.crossJoin(F.broadcast(methods)).join(first, ["method", "query"], "left")
    scored = every.select(*by, (F.col("first").isNotNull()).alias("hit"), (1.0 / F.col("first")).alias("mrr"), (F.col("first") == 1).alias("rank1"))
    s = E.summary(scored, *by)
    return s.select(*by, "n_cases", *[F.round(c, 9).alias(c) for c in ("hit_rate", "mrr", "rank1_rate")])


_METHODS = f"""{_EVAL}, {_RANKED}, {_DENSE},
  fused as (select query, unit, round(sum(1.0 / (60 + rank)), 12) as rrf from (select query, unit, rank from ranked union all select query, unit, rank from dense) group by 1, 2),
  m as (select 'lexical' as method, query, unit, rank from ranked union all select 'dense', query, unit, rank from dense
    union all select 'hybrid', query, unit, row_number() over (partition by query order by rrf desc, unit) from fused),
  f as (select method, m.query, min(rank) as first from m join rel on rel.query = m.query and rel.id = m.unit and kind = 'primary' where rank <= 5 group by 1, 2),
  scored as (select method, role, first from roles cross join (values ('lexical'), ('dense'), ('hybrid')) x(method) left join f using (method, query))
  select %s, count(*) as n_cases, round(avg((first is not null)::int), 9) as hit_rate, round(avg(coalesce(1.0 / first, 0)), 9) as mrr, round(avg((coalesce(first, 0) = 1)::int), 9) as rank1_rate from scored group by %s"""


@query(_METHODS.replace("%s", "method"))
def eval_by_method(spark, d):
    return _by_method(spark, d, "method")


@query(_METHODS.replace("%s", "method, role"))
def eval_by_slice(spark, d):
    return _by_method(spark, d, "method", "role")


@query(f"{_EVAL} select count(*) as n_cases, round(avg(coalesce(hit, false)::int), 9) as hit_rate, round(avg(coalesce(mrr, 0)), 9) as mrr, round(avg(rank1::int), 9) as rank1_rate from diag")
def eval_collection_summary(spark, d):
    q, qrels = _judged(spark, d)
    all_positive = E.diagnose(q.withColumn("role", F.lit("any_hit")), qrels, _lexical_run(spark, d))
    s = E.summary(all_positive.withColumn("every", F.lit(1)), "every").drop("every")
    return s.select("n_cases", *[F.round(c, 9).alias(c) for c in s.columns[1:]])


@query(f"""{_EVAL} select distinct query, problem from (select query, 'primary and must_not' as problem from rel where kind = 'primary' and query % 40 = 0
  union all select query, 'no ranking' from roles where query not in (select query from run where query % 100 <> 0) union all select query, 'unknown role' from roles where query % 60 = 0
  union all select -query, 'unknown query' from run where rank = 1 and query % 100 <> 0 and query > 0)""")
def eval_input_violations(spark, d):
    """A judged set with faults put in: roles nobody knows, targets that are forbidden too, rankings that are missing or of unknown queries."""
    q, qrels = _judged(spark, d)
    run = _lexical_run(spark, d).where("query % 100 <> 0")
    q = q.withColumn("role", F.when(F.col("query") % 60 == 0, "best").otherwise(F.col("role")))
    qrels = qrels.unionByName(qrels.where("kind = 'primary' and query % 40 = 0").withColumn("kind", F.lit("must_not")))
    return E.input_violations(q, qrels, run.unionByName(run.where("rank = 1 and query > 0").withColumn("query", -F.col("query"))))


@query(f"""{_EVAL}, dense as (select query, unit, score from (select w.query, c.knowledge_unit_id as unit, list_dot_product(w.e, v.e) as score, v.chunk_id from ways w, vecs v join chunks c using (chunk_id)
    qualify row_number() over (partition by w.query, c.knowledge_unit_id order by round(list_dot_product(w.e, v.e), 9) desc, v.chunk_id) = 1)),
  a as (select query, list(id order by rank) as stored from run where rank <= 5 group by 1),
  b as (select query, list(unit order by rank) as recomputed from (select query, unit, row_number() over (partition by query order by round(score, 9) desc, unit) as rank from dense qualify rank <= 5) group by 1)
  select query, stored, recomputed from a full join b using (query) where stored is distinct from recomputed""")
def replay_diff(spark, d):
    """Where the first five of two methods differ."""
    runs = _runs(spark, d, ("lexical", "dense"))
    return E.replay_diff(runs.where("method = 'lexical'"), runs.where("method = 'dense'"), ["query"])
