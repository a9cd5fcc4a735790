"""Shape rules of single rows: conditions written once, read by Spark and by the SQL as they stand.

A row for which the condition is not true, null included, is a violation.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from loomgraph.operators import integrity as R
from loomgraph.plans.structure import NODES, nodes
from loomgraph.workspace import table

#: By table and key column: code and condition.
CONDITIONS = {
    ("knowledge_units", "knowledge_unit_id"): {
        "unit_source_present": "length(source_id) > 0", "unit_source_hash_length": "length(source_sha256) = 64", "unit_source_hash_lower": "source_sha256 = lower(source_sha256)",
        "unit_text_hash_lower": "text_sha256 = lower(text_sha256)", "unit_volume_form": "source_volume_id like 'volume:%'", "unit_subject_present": "length(subject_root) > 0", "unit_package_form": "package_id like 'PKG-%'",
        "unit_package_of_source": "package_id like concat('PKG-', source_id, '%')", "unit_id_of_source": "knowledge_unit_id like concat(source_id, '-%')", "unit_chain_form": "source_chain_id like '%:%'",
        "unit_locator_present": "length(source_locator) > 0", "unit_evidence_present": "evidence_refs is not null", "unit_applicability_present": "applicability is not null", "unit_forbidden_present": "forbidden_transfer is not null",
        "unit_basis_present": "length(units_basis) > 0", "unit_layer_present": "length(knowledge_layer) > 0", "unit_title_trimmed": "title not like ' %' and title not like '% '", "unit_title_one_line": "instr(title, chr(10)) = 0", "unit_text_trimmed": "text not like ' %' and text not like '% '",
        "unit_lines_unified": "instr(text, chr(13)) = 0", "unit_transfer_said": "project_value_transfer_allowed is not null", "unit_authority_said": "current_project_authority is not null", "unit_content_said": "content_available is not null",
        "unit_time_present": "recorded_at is not null", "unit_withdrawn_after": "withdrawn_at is null or withdrawn_at >= recorded_at",
    },
    ("rag_chunks", "chunk_id"): {
        "chunk_node_is_unit": "node_id = knowledge_unit_id", "chunk_id_of_unit": "chunk_id like concat(knowledge_unit_id, ':chunk:%')", "chunk_source_present": "length(source_id) > 0", "chunk_subject_present": "length(subject_root) > 0",
        "chunk_title_leads": "left(search_text, length(title)) = title", "chunk_embeds_what_is_searched": "embedding_text = search_text", "chunk_text_holds_span": "length(search_text) >= body_end - body_start", "chunk_span_limit": "body_end - body_start <= 600",
        "chunk_count_present": "segment_count >= 1", "chunk_time_present": "recorded_at is not null",
    },
    ("chunk_to_kg", "chunk_id"): {"map_unit_present": "length(knowledge_unit_id) > 0", "map_id_of_unit": "chunk_id like concat(knowledge_unit_id, ':chunk:%')", "map_time_present": "recorded_at is not null"},
    ("vector_manifest", "row"): {"manifest_unit_present": "length(knowledge_unit_id) > 0", "manifest_id_of_unit": "chunk_id like concat(knowledge_unit_id, ':chunk:%')", "manifest_input_hash_present": "length(input_sha256) = 64", "manifest_vector_hash_present": "length(vector_sha256) = 64"},
    ("nodes", "node_id"): {
        "node_subject_present": "length(subject_root) > 0", "node_source_present": "node_type in ('subject_root', 'shared_term') or length(source_id) > 0", "node_volume_present": "node_type in ('subject_root', 'shared_term', 'section') or length(source_volume_id) > 0",
        "node_volume_form": "node_type <> 'source_volume' or node_id like 'volume:%'", "node_evidence_form": "node_type <> 'evidence' or node_id like 'evidence:%'", "node_chapter_form": "node_type <> 'chapter' or node_id like concat(source_id, '-%')",
        "node_support_context": "node_type <> 'support_unit' or chapter_refs is not null", "node_chapter_alone": "node_type = 'chapter' or chapter_number is null", "node_label_trimmed": "label is null or label not like ' %' and label not like '% '", "node_withdrawn_after": "withdrawn_at is null or withdrawn_at >= recorded_at",
    },
    ("kg_edges", "edge_id"): {
        "edge_source_present": "length(source_node_id) > 0", "edge_target_present": "length(target_node_id) > 0", "edge_relation_spelled": "relation in ('contains', 'supported_by', 'has_chapter_context', 'related_to')", "edge_time_present": "recorded_at is not null",
        "edge_evidence_form": "relation not like '%supported_by%' or target_node_id like 'evidence:%'", "edge_context_form": "relation not like '%has_chapter_context%' or target_node_id like '%-CH%'", "edge_ends_trimmed": "source_node_id not like '% %' and target_node_id not like '% %'",
    },
    ("external_references", "reference_id"): {
        "external_from_present": "length(from_knowledge_unit_id) > 0", "external_project_present": "length(target_project) > 0", "external_target_present": "length(target_node_id) > 0", "external_relation_spelled": "relation in ('contains', 'supported_by', 'has_chapter_context', 'related_to')", "external_time_present": "recorded_at is not null",
    },
}
_SQL = f"with {NODES} " + " union all ".join(
    f"""select '{code}' as code, cast("{key}" as varchar) as location from {name} where not coalesce({cond}, false)""" for (name, key), rules in CONDITIONS.items() for code, cond in rules.items()
)


#: The same conditions as rules.
RULES = [R.row_rule(code, name, key, lambda c=cond: F.expr(c)) for (name, key), rules in CONDITIONS.items() for code, cond in rules.items()]


def shape_report(spark, d):
    """Violations of all conditions; each table is read once, whatever the number of its rules."""
    tables = {name: nodes(spark, d) if name == "nodes" else table(spark, d, name) for name, _ in CONDITIONS}
    return R.report(tables, RULES).select("code", "location")


def shape_summary(spark, d):
    return shape_report(spark, d).groupBy("code").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {"shape_report": shape_report, "shape_summary": shape_summary}
ORACLES = {"shape_report": _SQL, "shape_summary": f"select code, count(*) as n from ({_SQL}) group by 1"}
