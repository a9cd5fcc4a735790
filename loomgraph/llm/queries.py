"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from loomgraph.llm import near_duplicates, neighbours, packing, splitting, tokens, toxicity
from loomgraph.workspace import table


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return splitting.split_oversized(table(spark, d, "rag_chunks"), table(spark, d, "knowledge_units")).drop("piece_count").distinct()


def p2_balanced(spark: SparkSession, d: str) -> DataFrame:
    """The same spans cut into pieces of even length; piece_no and piece_count are the segment_index and segment_count."""
    return splitting.split_oversized(table(spark, d, "rag_chunks"), table(spark, d, "knowledge_units"), least=200, cost=splitting.BALANCED)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return neighbours.neighbour_pairs(neighbours.nearest(table(spark, d, "vector_manifest"), table(spark, d, "vector_matrix")))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, d, "knowledge_units"))


def p4_groups(spark: SparkSession, d: str) -> DataFrame:
    return near_duplicates.duplicate_groups(table(spark, d, "knowledge_units"))


def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode_corpus(table(spark, d, "documents"))


def p7_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_documents(table(spark, d, "documents"))


def p7_report(spark: SparkSession, d: str) -> DataFrame:
    return packing.packing_report(p7_packing(spark, d))


def p7_kept(spark: SparkSession, d: str) -> DataFrame:
    """For each document: whether its tokens lie in containers once each, whether it was cut only because it exceeds one, and whether its containers hold no more than 2,048."""
    packed = p7_packing(spark, d)
    full = packed.groupBy("container_id").agg(F.sum("n_tokens").alias("load"), F.max(F.col("position") + F.col("n_tokens")).alias("reach"))
    rows = packed.join(full, "container_id")
    n = F.sum("n_tokens")
    return rows.groupBy("doc_id").agg(
        ((F.max(F.col("first_token") + F.col("n_tokens")) == n) & (F.count_distinct("first_token") == F.count(F.lit(1))) & (F.min("first_token") == 0)).alias("covered"),
        ((F.count(F.lit(1)) == 1) | (n > 2048) & (F.count(F.when(F.col("n_tokens") < 2048, 1)) <= 1)).alias("whole"),
        F.every((F.col("load") <= 2048) & (F.col("reach") <= 2048)).alias("fits"),
    )


def p8_scores(spark: SparkSession, d: str) -> DataFrame:
    return toxicity.score_documents(table(spark, d, "documents"), table(spark, d, "doc_labels"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return p8_scores(spark, d).where("offending").select("doc_id").distinct()


def p8_rates(spark: SparkSession, d: str) -> DataFrame:
    return toxicity.rates_per_source(p8_scores(spark, d))


QUERIES = {f.__name__: f for f in (p2_found, p2_balanced, p3_found, p4_found, p4_groups, p6_ids, p7_packing, p7_report, p7_kept, p8_found, p8_scores, p8_rates)}

_CONTENT = """
      with recursive c as (
        select distinct knowledge_unit_id as id, lower(regexp_replace(regexp_replace(coalesce(title, '') || ' ' || text, '[ \\t\\r\\n\\x{3000}]+', ' ', 'g'), '^ | $', '', 'g')) as t
        from knowledge_units where knowledge_unit_id is not null and regexp_matches(text, '[^\\s\\x{3000}\\x{A0}\\x{85}]')),
      g as (select distinct id, substr(t, i, 5) as g from (select id, t, unnest(range(1, length(t) - 3)) as i from c)),
      n as (select id, count(*) as n from g group by 1),
      met as (select a.id as a, b.id as b, count(*) as k from g a join g b on a.g = b.g and a.id < b.id group by 1, 2),
      pairs as (select a, b from met join n x on x.id = a join n y on y.id = b where k / (x.n + y.n - k) >= 0.7)"""

ORACLES = {
    "p7_kept": "select doc_id, true as covered, true as whole, true as fits from documents",
    "p4_found": _CONTENT + " select a as unit_id_a, b as unit_id_b from pairs",
    "p4_groups": _CONTENT + """,
      reach as (
        select id as u, id as v from n union
        select r.u, case when p.a = r.v then p.b else p.a end from reach r join pairs p on p.a = r.v or p.b = r.v),
      class as (select c.id, min(o.id) as class_id, any_value(c.t) as t from c join c o on o.t = c.t group by c.id)
      select n.id as unit_id, class_id, (select min(v) from reach where u = n.id) as group_id,
        (select count(distinct o.t) from pairs p join class o on o.id = case when p.a = n.id then p.b else p.a end where (p.a = n.id or p.b = n.id) and o.t <> class.t) as n_links
      from n join class using (id)""",
    "p2_found": """
      with recursive spans as (
        select distinct c.chunk_id, c.body_start as s, c.body_end as e, coalesce(u.text, '') as t from rag_chunks c
        left join (select knowledge_unit_id, max(struct_pack(r := recorded_at, t := text)).t as text from knowledge_units group by 1) u using (knowledge_unit_id)
        where c.body_end - c.body_start > 600),
      cut as (
        select chunk_id, s as span_start, e, t, 0 as piece_no, s as a,
          s + coalesce(list_max(list_filter(range(360, 601), lambda x: contains('。！？!?；;.' || chr(10), substr(t, s + x, 1)) and substr(t, s + x, 1) <> '')), 600) as b
        from spans
        union all
        select chunk_id, span_start, e, t, piece_no + 1, b - 60,
          case when e - (b - 60) <= 600 then e else b - 60
            + coalesce(list_max(list_filter(range(360, 601), lambda x: contains('。！？!?；;.' || chr(10), substr(t, b - 60 + x, 1)) and substr(t, b - 60 + x, 1) <> '')), 600) end
        from cut where b < e)
      select distinct chunk_id, cast(piece_no as int) as piece_no, a as body_start, cast(b as int) as body_end from cut""",
    "p2_balanced": """
      with recursive spans as (
        select distinct c.chunk_id, c.body_start as s, c.body_end - c.body_start as n, substr(coalesce(u.text, ''), c.body_start + 1, c.body_end - c.body_start) as t from rag_chunks c
        left join (select knowledge_unit_id, max(struct_pack(r := recorded_at, t := text)).t as text from knowledge_units group by 1) u using (knowledge_unit_id)
        where c.body_end - c.body_start > 600),
      aimed as (select *, (n + (p - 1) * 60) / p as even from (select *, ceil((n - 60) / 540.0) as p from spans)),
      plans as (
        select chunk_id, s, n, t, even, 0::bigint as a, 0.0::double as cost, []::bigint[] as ends from aimed
        union all
        (select chunk_id, s, n, t, even, case when x = n then n else x - 60 end as a,
          cost + pow((x - a - even) / 600, 2) + case when x = n then 0 when substr(t, x, 1) = chr(10) then 0 when contains('。！？!?；;.', substr(t, x, 1)) and substr(t, x, 1) <> '' then 0.05 else 1 end as cost, list_append(ends, x) as ends
        from (select *, unnest(case when n - a <= 600 then [n] when len(f) = 0 then [a + 600] else f end) as x
          from (select *, list_filter(range(a + 200, a + 601), lambda y: contains('。！？!?；;.' || chr(10), substr(t, y, 1)) and substr(t, y, 1) <> '') as f from plans where a < n))
        qualify row_number() over (partition by chunk_id, s, n, case when x = n then n else x - 60 end order by round(cost + pow((x - a - even) / 600, 2) + case when x = n then 0 when substr(t, x, 1) = chr(10) then 0 when contains('。！？!?；;.', substr(t, x, 1)) and substr(t, x, 1) <> '' then 0.05 else 1 end, 9), list_append(ends, x) desc) = 1)),
      best as (select chunk_id, s, ends from plans where a = n qualify row_number() over (partition by chunk_id, s, n order by round(cost, 9), ends desc) = 1)
      select distinct chunk_id, cast(i - 1 as int) as piece_no, cast(s + case when i = 1 then 0 else ends[i - 1] - 60 end as int) as body_start, cast(s + ends[i] as int) as body_end, cast(len(ends) as int) as piece_count
      from (select *, unnest(range(1, len(ends) + 1)) as i from best)""",
    "p3_found": """
      with v as (
        select m.chunk_id, any_value(cast(x.embedding as double[])) as e from (select chunk_id, min("row") as "row" from vector_manifest group by 1) m
        join vector_matrix x on x."row" = m."row"
        where len(x.embedding) = 512 and list_count(x.embedding) = 512 and len(list_filter(x.embedding, lambda y: not isfinite(y))) = 0
          and len(list_filter(x.embedding, lambda y: y <> 0)) > 0
        group by 1),
      s as (select a.chunk_id as a, b.chunk_id as b, list_cosine_similarity(a.e, b.e) as c from v a join v b on a.chunk_id <> b.chunk_id),
      r as (select a, b from s qualify row_number() over (partition by a order by round(c, 12) desc, b) <= 5)
      select distinct least(a, b) as chunk_id_a, greatest(a, b) as chunk_id_b from r""",
}
