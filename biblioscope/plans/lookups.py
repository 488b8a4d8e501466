"""Queries: point look-ups, filters, projections, order and pages (F, L)."""

from __future__ import annotations

from pyspark.sql import functions as F

from biblioscope.operators import lookup
from biblioscope.operators.lookup import GraphQuery
from biblioscope.plans import graph
from biblioscope.plans.graph import with_views
from biblioscope.session import table


def _query(s, d) -> GraphQuery:
    return GraphQuery({"entities": graph.entities(s, d), "relationships": graph.relationships(s, d), "evidence": graph.assertions(s, d)})


TRIPLE = ("subject_id", "predicate", "object_id")
REL = [*TRIPLE, "confidence", "evidence_count"]

QUERIES = {
    "f1_entity_by_id": lambda s, d: lookup.by_id(graph.entities(s, d), "entity_id", "DRUG:17"),
    "f2_gene_by_hgnc": lambda s, d: lookup.by_ontology_id(table(s, d, "reference_entities"), "gene", "HGNC:984143").select("entity_id", "name", "type"),
    "f3_synonym_index": lambda s, d: lookup.synonym_index(table(s, d, "reference_entities")),
    "f3_entity_synonym_index": lambda s, d: lookup.synonym_index(table(s, d, "entities").where("entity_id IS NOT NULL")),
    "f4_entities_of_type": lambda s, d: _query(s, d).entities("disease").filter(category="BUILDING").order_by("name").limit(20).frame(),
    "f4_events_by_property": lambda s, d: lookup.matching(table(s, d, "events").select("event_id", "user_id", "event_type", F.try_parse_json("props").alias("properties")), k=69).select("event_id", "user_id", "event_type"),
    "f5_filters_add_up": lambda s, d: _query(s, d).entities().filter(entity_type="drug").filter(category="ECONOMY").frame(),
    "f6_find_relationships": lambda s, d: lookup.find_relationships(graph.relationships(s, d), predicate="TREATS", object_id="").select(*REL),
    "f6_paper_relationships": lambda s, d: lookup.find_relationships(graph.paper_relationships(s, d), predicate="prevents").select("paper_id", "pos", *TRIPLE, "confidence"),
    "f7_min_confidence": lambda s, d: lookup.find_relationships(graph.relationships(s, d), predicate="treats", min_confidence=0.8).select(*REL),
    "f8_by_triple": lambda s, d: lookup.find_relationships(graph.relationships(s, d), "DISEASE:3", "causes").select(*REL),
    "f9_paper": lambda s, d: lookup.by_id(table(s, d, "papers"), "paper_id", "PMC90000003").select("paper_id", "title", "journal", "publication_date"),
    "f10_evidence_of_paper": lambda s, d: lookup.by_id(graph.assertions(s, d), "paper_id", "PMC7"),
    "f11_evidence_of_triples": lambda s, d: graph.assertions(s, d).groupBy(*TRIPLE).agg(F.count("*").alias("n_evidence")),
    "f12_name_search": lambda s, d: lookup.name_search(graph.entities(s, d), "MALL r", "drug"),
    "f12_reference_search": lambda s, d: lookup.name_search(table(s, d, "reference_entities").withColumnRenamed("type", "entity_type"), "edema", "disease", 25).select("entity_id", "name"),
    "f13_with_evidence": lambda s, d: _query(s, d).relationships("contraindicated_for").with_evidence("rct", "cohort").frame().select(*REL),
    "f14_known_predicates": lambda s, d: lookup.known_predicates(graph.paper_relationships(s, d), ["treats", "causes", "prevents"]).select("paper_id", "pos", *TRIPLE),
    "f15_json": lambda s, d: table(s, d, "reference_entities").select("entity_id", F.to_json(F.struct("entity_id", "type", "name")).alias("json")),
    "f15_projection": lambda s, d: table(s, d, "papers").select("paper_id", "title").distinct(),
    "f16_paper_properties": lambda s, d: table(s, d, "papers").select("paper_id", F.col("metadata.study_type").alias("study_type"), F.col("metadata.sample_size").alias("sample_size"), F.coalesce(F.array_size("metadata.mesh_terms"), F.lit(0)).cast("long").alias("n_mesh_terms")),
    "f17_relationships_of_subject": lambda s, d: _query(s, d).relationships(subject_id="GENE:5").frame().select(*REL),
    "l1_list_entities": lambda s, d: lookup.page(graph.entities(s, d), ["entity_type", "entity_id"], 50, 20),
    "l2_list_papers": lambda s, d: lookup.page(table(s, d, "papers").select("paper_id", "title").distinct(), ["paper_id", F.asc_nulls_first("title")], 40, 10),
    "l3_order_by": lambda s, d: _query(s, d).relationships("binds_to").order_by("object_id", descending=True).limit(30).frame().select(*REL),
    "l5_recent_papers": lambda s, d: lookup.page(graph.papers(s, d).select("paper_id", "publication_date"), [F.desc("publication_date"), "paper_id"], 10),
    "l7_top_confidence": lambda s, d: lookup.page(graph.relationships(s, d).select(*REL), [F.desc("confidence"), F.desc("evidence_count"), *TRIPLE], 25),
}

_REL = "subject_id, predicate, object_id, confidence, evidence_count"
_INDEX = "SELECT DISTINCT lower(key) AS key, entity_id, kind FROM ({}) WHERE key IS NOT NULL"
SQL = {
    "f1_entity_by_id": with_views("entities_v", sql="SELECT * FROM entities_v WHERE entity_id = 'DRUG:17'"),
    "f2_gene_by_hgnc": "SELECT entity_id, name, type FROM reference_entities WHERE type = 'gene' AND entity_id = 'HGNC:984143'",
    "f3_synonym_index": _INDEX.format("SELECT name AS key, entity_id, 'name' AS kind FROM reference_entities UNION ALL SELECT unnest(synonyms), entity_id, 'synonym' FROM reference_entities UNION ALL SELECT unnest(abbreviations), entity_id, 'abbreviation' FROM reference_entities"),
    "f3_entity_synonym_index": _INDEX.format("SELECT name AS key, entity_id, 'name' AS kind FROM entities WHERE entity_id IS NOT NULL UNION ALL SELECT unnest(synonyms), entity_id, 'synonym' FROM entities WHERE entity_id IS NOT NULL"),
    "f4_entities_of_type": with_views("entities_v", sql="SELECT * FROM entities_v WHERE entity_type = 'disease' AND category = 'BUILDING' ORDER BY name, entity_id LIMIT 20"),
    "f4_events_by_property": "SELECT event_id, user_id, event_type FROM events WHERE json_extract_string(props, '$.k') = '69'",
    "f5_filters_add_up": with_views("entities_v", sql="SELECT * FROM entities_v WHERE entity_type = 'drug' AND category = 'ECONOMY'"),
    "f6_find_relationships": with_views("relationships_v", sql=f"SELECT {_REL} FROM relationships_v WHERE predicate = 'treats'"),
    "f6_paper_relationships": with_views("paper_rels_v", sql="SELECT paper_id, pos, subject_id, predicate, object_id, confidence FROM paper_rels_v WHERE predicate = 'prevents'"),
    "f7_min_confidence": with_views("relationships_v", sql=f"SELECT {_REL} FROM relationships_v WHERE predicate = 'treats' AND confidence >= 0.8::DOUBLE"),
    "f8_by_triple": with_views("relationships_v", sql=f"SELECT {_REL} FROM relationships_v WHERE subject_id = 'DISEASE:3' AND predicate = 'causes'"),
    "f9_paper": "SELECT paper_id, title, journal, publication_date FROM papers WHERE paper_id = 'PMC90000003'",
    "f10_evidence_of_paper": with_views("assertions_v", sql="SELECT * FROM assertions_v WHERE paper_id = 'PMC7'"),
    "f11_evidence_of_triples": with_views("assertions_v", sql="SELECT subject_id, predicate, object_id, count(*) AS n_evidence FROM assertions_v GROUP BY 1, 2, 3"),
    "f12_name_search": with_views("entities_v", sql="SELECT * FROM entities_v WHERE entity_type = 'drug' AND contains(lower(name), 'mall r')"),
    "f12_reference_search": "SELECT entity_id, name FROM reference_entities WHERE type = 'disease' AND contains(lower(name), 'edema') ORDER BY entity_id LIMIT 25",
    "f13_with_evidence": with_views("relationships_v", sql=f"SELECT {_REL} FROM relationships_v r WHERE predicate = 'contraindicated_for' AND EXISTS (SELECT 1 FROM assertions_v a WHERE a.subject_id = r.subject_id AND a.predicate = r.predicate AND a.object_id = r.object_id AND study_type IN ('rct', 'cohort'))"),
    "f14_known_predicates": with_views("paper_rels_v", sql="SELECT paper_id, pos, subject_id, predicate, object_id FROM paper_rels_v WHERE predicate IN ('treats', 'causes', 'prevents')"),
    "f15_json": "SELECT entity_id, to_json({'entity_id': entity_id, 'type': type, 'name': name})::VARCHAR AS json FROM reference_entities",
    "f15_projection": "SELECT DISTINCT paper_id, title FROM papers",
    "f16_paper_properties": "SELECT paper_id, metadata.study_type AS study_type, metadata.sample_size AS sample_size, coalesce(len(metadata.mesh_terms), 0) AS n_mesh_terms FROM papers",
    "f17_relationships_of_subject": with_views("relationships_v", sql=f"SELECT {_REL} FROM relationships_v WHERE subject_id = 'GENE:5'"),
    "l1_list_entities": with_views("entities_v", sql="SELECT * FROM entities_v ORDER BY entity_type, entity_id LIMIT 50 OFFSET 20"),
    "l2_list_papers": "SELECT DISTINCT paper_id, title FROM papers ORDER BY paper_id, title NULLS FIRST LIMIT 40 OFFSET 10",
    "l3_order_by": with_views("relationships_v", sql=f"SELECT {_REL} FROM relationships_v WHERE predicate = 'binds_to' ORDER BY object_id DESC, subject_id LIMIT 30"),
    "l5_recent_papers": with_views("papers_v", sql="SELECT paper_id, publication_date FROM papers_v ORDER BY publication_date DESC, paper_id LIMIT 10"),
    "l7_top_confidence": with_views("relationships_v", sql=f"SELECT {_REL} FROM relationships_v ORDER BY confidence DESC, evidence_count DESC, subject_id, predicate, object_id LIMIT 25"),
}
