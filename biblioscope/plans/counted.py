"""Queries: aggregation, windows and rollups (A, W)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from biblioscope.operators import aggregates as A
from biblioscope.operators import rules
from biblioscope.plans import graph
from biblioscope.plans.graph import with_views
from biblioscope.session import table

TRIPLE = ("subject_id", "predicate", "object_id")


def _totals(s, d):
    frames = {"papers": table(s, d, "papers"), "entities": table(s, d, "entities"), "relationships": graph.paper_relationships(s, d), "edges": table(s, d, "extraction_edges")}
    parts = [f.agg(F.count("*").alias("n")).select(F.lit(k).alias("what"), "n") for k, f in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _statistics(s, d):
    stats = A.graph_statistics(graph.papers(s, d), graph.entities(s, d), graph.relationships(s, d), graph.assertions(s, d))
    text = lambda c: F.array_join(F.transform(F.map_entries(c), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",")
    return stats.withColumn("entities_by", text("entities_by")).withColumn("relationships_by", text("relationships_by"))


def _resolution(s, d):
    """How the mentions of a run were resolved: found, matched to a canonical id, newly made."""
    m = graph.edge_mentions(s, d)
    new = F.startswith("entity_id", F.lit("prov:"))
    return m.agg(F.count_distinct("entity_id").alias("found"), F.count_distinct(F.when(~new, F.col("entity_id"))).alias("matched"), F.count_distinct(F.when(new, F.col("entity_id"))).alias("created"))


def _ranked(s, d):
    r = graph.relationships(s, d).where("predicate = 'treats'")
    w = Window.partitionBy("object_id").orderBy(F.desc("confidence"), "subject_id")
    return r.select("object_id", "subject_id", "confidence", F.row_number().over(w).cast("long").alias("place"), F.round(F.lag("confidence").over(w) - F.col("confidence"), 6).alias("drop_from_last")).where("place <= 3")


ends_by_paper = lambda s, d: table(s, d, "papers").select("paper_id", "publication_date").where("publication_date IS NOT NULL").distinct()

QUERIES = {
    "a1_totals": _totals,
    "a2_entities_by_type": lambda s, d: A.counts(graph.entities(s, d), "entity_type"),
    "a2_extracted_by_type": lambda s, d: A.counts(table(s, d, "entities"), "type"),
    "a3_by_predicate": lambda s, d: A.counts(graph.relationships(s, d), "predicate"),
    "a4_entities_in_relationships": lambda s, d: A.ends(graph.relationships(s, d)).agg(F.count_distinct("entity_id").alias("n")),
    "a6_papers_with_relationships": lambda s, d: graph.paper_relationships(s, d).agg(F.count_distinct("paper_id").alias("n")),
    "a7_graph_statistics": _statistics,
    "a8_predicates_of_entity": lambda s, d: A.counts(graph.relationships(s, d).where("subject_id = 'DRUG:4' OR object_id = 'DRUG:4'"), "predicate"),
    "a9_confidence_summary": lambda s, d: A.describe(table(s, d, "extraction_edges"), "confidence"),
    "a10_confidence_buckets": lambda s, d: A.confidence_buckets(graph.relationships(s, d)),
    "a11_histogram": lambda s, d: A.histogram(table(s, d, "lineitem"), "l_extendedprice"),
    "a12_evidence_by_study_type": lambda s, d: A.counts(graph.assertions(s, d), "study_type"),
    "a13_evidence_by_triple": lambda s, d: A.evidence_by_triple(graph.assertions(s, d)),
    "a15_mention_rollup": lambda s, d: A.mention_rollup(graph.edge_mentions(s, d)).withColumn("surface_forms", F.array_join("surface_forms", "|")),
    "a16_differential": lambda s, d: A.differential(graph.relationships(s, d), [f"SYMPTOM:{i}" for i in range(4)], 1),
    "a17_drugs_by_phase": lambda s, d: table(s, d, "papers").select(F.col("metadata.clinical_phase").alias("phase"), F.explode("entities").alias("e")).where("e.type = 'drug'").groupBy("phase").agg(F.count_distinct("e.id").alias("n_drugs")),
    "a18_recent_by_predicate": lambda s, d: graph.assertions(s, d).join(graph.papers(s, d).where("publication_date >= '2000-01-01'").select("paper_id"), "paper_id", "left_semi").groupBy("predicate").agg(F.count_distinct("paper_id").alias("n_papers"), F.count("*").alias("n")),
    "a19_run_totals": lambda s, d: table(s, d, "papers").agg(F.count("*").alias("found"), F.count_if((F.size("entities") > 0) | (F.size("relationships") > 0)).alias("processed"), F.sum(F.coalesce(F.array_size("entities"), F.lit(0))).alias("n_entities"), F.sum(F.coalesce(F.array_size("relationships"), F.lit(0))).alias("n_relationships")),
    "a20_resolution": _resolution,
    "a21_rollup": lambda s, d: A.rollup_counts(table(s, d, "documents").select("section", "lang"), "section", "lang"),
    "a21_cube": lambda s, d: A.cube_counts(graph.assertions(s, d), "predicate", "study_type"),
    "l6_journals_by_papers": lambda s, d: A.counts(table(s, d, "papers"), "journal", ordered=True),
    "e8_promotable": lambda s, d: A.promotable(graph.edge_mentions(s, d).where("NOT isnan(confidence) AND confidence BETWEEN 0 AND 1"), table(s, d, "entity_embeddings").where("embedding IS NOT NULL")),
    "w1_best_treatments": _ranked,
    "w2_running_papers": lambda s, d: A.running_counts(ends_by_paper(s, d).select(F.substring("publication_date", 1, 4).alias("year"), F.substring("publication_date", 6, 2).alias("month")), "year", "month"),
    "v6_edge_contract": lambda s, d: rules.edge_contract(table(s, d, "extraction_edges")),
}

_W = "CASE study_type WHEN 'rct' THEN 1.0 WHEN 'meta_analysis' THEN 0.95 WHEN 'cohort' THEN 0.8 WHEN 'case_control' THEN 0.7 WHEN 'observational' THEN 0.6 WHEN 'review' THEN 0.5 WHEN 'case_report' THEN 0.4 ELSE 0.5 END::DOUBLE"
_BAD = "confidence IS NULL OR isnan(confidence) OR confidence < 0 OR confidence > 1"
_TYPES = "('disease', 'gene', 'drug', 'protein', 'symptom', 'procedure', 'biomarker', 'pathway')"
SQL = {
    "a1_totals": with_views("paper_rels_v", sql="SELECT 'papers' AS what, count(*) AS n FROM papers UNION ALL SELECT 'entities', count(*) FROM entities UNION ALL SELECT 'relationships', count(*) FROM paper_rels_v UNION ALL SELECT 'edges', count(*) FROM extraction_edges"),
    "a2_entities_by_type": with_views("entities_v", sql="SELECT entity_type, count(*) AS n FROM entities_v GROUP BY 1"),
    "a2_extracted_by_type": "SELECT type, count(*) AS n FROM entities GROUP BY 1",
    "a3_by_predicate": with_views("relationships_v", sql="SELECT predicate, count(*) AS n FROM relationships_v GROUP BY 1"),
    "a4_entities_in_relationships": with_views("relationships_v", sql="SELECT count(DISTINCT e) AS n FROM (SELECT unnest([subject_id, object_id]) AS e FROM relationships_v)"),
    "a6_papers_with_relationships": with_views("paper_rels_v", sql="SELECT count(DISTINCT paper_id) AS n FROM paper_rels_v"),
    "a7_graph_statistics": with_views("entities_v", "relationships_v", sql="""
SELECT (SELECT count(*) FROM orders) AS total_papers, (SELECT count(*) FROM entities_v) AS total_entities, (SELECT count(*) FROM relationships_v WHERE predicate IS NOT NULL) AS total_relationships,
 (SELECT count(*) FROM assertions_v) AS total_evidence, (SELECT count(DISTINCT paper_id) FROM assertions_v) AS papers_with_relationships,
 (SELECT count(DISTINCT e) FROM (SELECT unnest([subject_id, object_id]) AS e FROM relationships_v)) AS entities_in_relationships,
 (SELECT string_agg(k || '=' || n, ',' ORDER BY k) FROM (SELECT entity_type AS k, count(*) AS n FROM entities_v GROUP BY 1)) AS entities_by,
 (SELECT string_agg(k || '=' || n, ',' ORDER BY k) FROM (SELECT predicate AS k, count(*) AS n FROM relationships_v GROUP BY 1)) AS relationships_by,
 (SELECT count(*) FROM orders) AS papers_with_entities"""),
    "a8_predicates_of_entity": with_views("relationships_v", sql="SELECT predicate, count(*) AS n FROM relationships_v WHERE subject_id = 'DRUG:4' OR object_id = 'DRUG:4' GROUP BY 1"),
    "a9_confidence_summary": "SELECT count(*) AS n, round(avg(confidence), 6) AS mean, round(stddev_samp(confidence), 6) AS std, min(confidence) AS min, round(quantile_cont(confidence, 0.25), 6) AS p25, round(quantile_cont(confidence, 0.5), 6) AS p50, round(quantile_cont(confidence, 0.75), 6) AS p75, max(confidence) AS max FROM extraction_edges WHERE confidence IS NOT NULL AND NOT isnan(confidence)",
    "a10_confidence_buckets": with_views("relationships_v", sql="SELECT count(*) FILTER (confidence >= 0.8::DOUBLE) AS high, count(*) FILTER (confidence >= 0.6::DOUBLE AND confidence < 0.8::DOUBLE) AS medium, count(*) FILTER (confidence < 0.6::DOUBLE) AS low FROM relationships_v"),
    "a11_histogram": "WITH b AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem WHERE NOT isnan(l_extendedprice)) SELECT least(floor((l_extendedprice - lo) / (hi - lo) * 20), 19)::BIGINT AS bin, count(*) AS n FROM lineitem, b WHERE l_extendedprice IS NOT NULL AND NOT isnan(l_extendedprice) GROUP BY 1",
    "a12_evidence_by_study_type": with_views("assertions_v", sql="SELECT study_type, count(*) AS n FROM assertions_v GROUP BY 1"),
    "a13_evidence_by_triple": with_views("assertions_v", sql=f"SELECT subject_id, predicate, object_id, count(*) AS n_items, count(DISTINCT paper_id) AS n_papers, round(sum({_W} * confidence) / sum({_W}), 6) AS weighted_confidence, max(sample_size) AS largest_sample FROM assertions_v GROUP BY 1, 2, 3"),
    "a15_mention_rollup": with_views("edge_mentions_v", sql="SELECT entity_id, count(*) AS mention_count, coalesce(array_to_string(list_sort(list(DISTINCT surface) FILTER (surface IS NOT NULL)), '|'), '') AS surface_forms, count(DISTINCT paper_id) AS n_papers FROM edge_mentions_v GROUP BY 1"),
    "a16_differential": with_views("relationships_v", sql="SELECT subject_id AS disease, count(DISTINCT object_id) AS n_match, round(avg(confidence), 6) AS mean_confidence FROM relationships_v WHERE predicate = 'causes' AND object_id IN ('SYMPTOM:0', 'SYMPTOM:1', 'SYMPTOM:2', 'SYMPTOM:3') GROUP BY 1 HAVING count(DISTINCT object_id) >= 1"),
    "a17_drugs_by_phase": "SELECT phase, count(DISTINCT e.id) AS n_drugs FROM (SELECT metadata.clinical_phase AS phase, unnest(entities) AS e FROM papers) WHERE e.type = 'drug' GROUP BY 1",
    "a18_recent_by_predicate": with_views("assertions_v", "papers_v", sql="SELECT predicate, count(DISTINCT paper_id) AS n_papers, count(*) AS n FROM assertions_v WHERE paper_id IN (SELECT paper_id FROM papers_v WHERE publication_date >= '2000-01-01') GROUP BY 1"),
    "a19_run_totals": "SELECT count(*) AS found, count(*) FILTER (len(entities) > 0 OR len(relationships) > 0) AS processed, sum(coalesce(len(entities), 0))::BIGINT AS n_entities, sum(coalesce(len(relationships), 0))::BIGINT AS n_relationships FROM papers",
    "a20_resolution": with_views("edge_mentions_v", sql="SELECT count(DISTINCT entity_id) AS found, count(DISTINCT entity_id) FILTER (NOT starts_with(entity_id, 'prov:')) AS matched, count(DISTINCT entity_id) FILTER (starts_with(entity_id, 'prov:')) AS created FROM edge_mentions_v"),
    "a21_rollup": "SELECT section, lang, count(*) AS n FROM documents GROUP BY ROLLUP (section, lang)",
    "a21_cube": with_views("assertions_v", sql="SELECT predicate, study_type, count(*) AS n FROM assertions_v GROUP BY CUBE (predicate, study_type)"),
    "l6_journals_by_papers": "SELECT journal, count(*) AS n FROM papers GROUP BY 1 ORDER BY n DESC, journal",
    "e8_promotable": with_views("edge_mentions_v", sql="SELECT entity_id, count(DISTINCT paper_id) AS usage, round(max(confidence), 6) AS best_confidence FROM edge_mentions_v WHERE NOT isnan(confidence) AND confidence BETWEEN 0 AND 1 AND entity_id IN (SELECT entity_id FROM entity_embeddings WHERE embedding IS NOT NULL) GROUP BY 1 HAVING count(DISTINCT paper_id) >= 2 AND max(confidence) >= 0.75::DOUBLE"),
    "w1_best_treatments": with_views("relationships_v", sql="SELECT object_id, subject_id, confidence, place, drop_from_last FROM (SELECT object_id, subject_id, confidence, row_number() OVER w AS place, round(lag(confidence) OVER w - confidence, 6) AS drop_from_last FROM relationships_v WHERE predicate = 'treats' WINDOW w AS (PARTITION BY object_id ORDER BY confidence DESC, subject_id)) WHERE place <= 3"),
    "w2_running_papers": "WITH p AS (SELECT DISTINCT paper_id, publication_date FROM papers WHERE publication_date IS NOT NULL), m AS (SELECT publication_date[1:4] AS year, publication_date[6:7] AS month, count(*) AS n FROM p GROUP BY 1, 2) SELECT year, month, n, sum(n) OVER (PARTITION BY year ORDER BY month)::BIGINT AS running FROM m",
    "v6_edge_contract": f"SELECT count(*) AS n_edges, count(*) FILTER (subject.id IS NULL OR object.id IS NULL) AS missing_id, count(*) FILTER (subject.type IS NULL OR object.type IS NULL OR subject.type NOT IN {_TYPES} OR object.type NOT IN {_TYPES}) AS bad_type, count(*) FILTER (NOT coalesce(contains(subject.id, ':'), false) OR NOT coalesce(contains(object.id, ':'), false)) AS no_prefix, count(*) FILTER ({_BAD}) AS bad_confidence, (SELECT count(*) FROM (SELECT id FROM extraction_edges GROUP BY id HAVING count(*) > 1)) AS repeated_ids FROM extraction_edges",
}
