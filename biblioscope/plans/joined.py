"""Queries: joins over the graph (J)."""

from __future__ import annotations

from pyspark.sql import functions as F

from biblioscope.operators import joins, lookup
from biblioscope.operators.extraction import DOCUMENT_STOPWORDS, clean_mentions, evidence, first_mentions
from biblioscope.plans import graph, texts
from biblioscope.plans.graph import with_views
from biblioscope.session import table

TRIPLE = ("subject_id", "predicate", "object_id")


def _mentions(s, d):
    """Edge mentions by paper with a fixed order of places."""
    m = graph.edge_mentions(s, d).where("NOT isnan(confidence) AND confidence BETWEEN 0 AND 1")
    best = m.groupBy("paper_id", "entity_id").agg(F.max("confidence").alias("confidence"))
    return best.withColumn("pos", F.col("entity_id"))


def _audit(s, d):
    """Claims of papers to the evidence read from their texts and to the edges of the same paper and ends."""
    claims = graph.paper_relationships(s, d).select("paper_id", "pos", *TRIPLE, "evidence", "section").distinct()
    texts = claims.where("evidence IS NOT NULL").groupBy("paper_id", "pos").agg(F.max("evidence").alias("text"), F.max("section").alias("section"))
    read = evidence(texts.withColumn("paragraph_id", F.col("pos"))).withColumnRenamed("paragraph_id", "pos")
    return joins.audit(claims.select("paper_id", "pos", *TRIPLE).distinct(), read, table(s, d, "extraction_edges"))


def _document_mentions(s, d):
    """Mentions under the rules for documents, the first of each name in a paper."""
    m = graph.edge_mentions(s, d).where("surface IS NOT NULL").groupBy("paper_id", F.col("surface").alias("name")).agg(F.min("entity_id").alias("entity_id"), F.max(F.when(~F.isnan("confidence"), F.col("confidence"))).alias("confidence"))
    clean = clean_mentions(m, 0.5, DOCUMENT_STOPWORDS)
    return first_mentions(clean.withColumn("pos", F.struct("name", "entity_id"))).select("paper_id", "name", "entity_id")


QUERIES = {
    "j1_entities_with_vectors": lambda s, d: table(s, d, "entities").select("entity_id", "name", "type").distinct().join(table(s, d, "entity_embeddings").where("embedding IS NOT NULL").select("entity_id", "model_name").distinct(), "entity_id"),
    "j2_paragraphs_with_vectors": lambda s, d: table(s, d, "documents").select("paragraph_id", "section", "n_chars").join(table(s, d, "paragraph_embeddings").select("paragraph_id").distinct(), "paragraph_id"),
    "j3_paragraphs_of_papers": lambda s, d: table(s, d, "documents").select("paragraph_id", "paper_id", "section").join(table(s, d, "papers").select("paper_id").distinct(), "paper_id"),
    "j4_find_treatments": lambda s, d: joins.find_treatments(graph.entities(s, d), graph.relationships(s, d), graph.assertions(s, d), "#00000001", 20),
    "j5_related_genes": lambda s, d: joins.related(graph.entities(s, d), graph.relationships(s, d), "small ring", "gene"),
    "j6_co_occurrence": lambda s, d: joins.co_occurrence(_mentions(s, d)),
    "j7_recent_papers_of_triples": lambda s, d: joins.since(graph.relationships(s, d), graph.papers(s, d), "2001-06-01"),
    "j8_two_hops": lambda s, d: joins.two_hops(graph.relationships(s, d), "binds_to", "treats"),
    "j9_traverse": lambda s, d: joins.traverse(graph.relationships(s, d), graph.entities(s, d), "GENE:1", ["BINDS_TO:drug", "TREATS:disease", "CAUSES:symptom"]).select("end", F.array_join("path", ">").alias("path")),
    "j11_resolved_only": lambda s, d: joins.resolved_only(graph.paper_relationships(s, d), table(s, d, "reference_entities")).select("paper_id", "pos", *TRIPLE),
    "j12_orphans": lambda s, d: joins.orphans(graph.edge_mentions(s, d).select(F.upper(F.trim("entity_id")).alias("entity_id")).distinct(), table(s, d, "reference_entities").select(F.upper("entity_id").alias("entity_id")).union(table(s, d, "entities").select(F.upper("entity_id")))),
    "j13_name_lookup": lambda s, d: joins.name_lookup(table(s, d, "entities").where("name IS NOT NULL").select("name").distinct(), lookup.synonym_index(table(s, d, "reference_entities"))),
    "j16_contradictions": lambda s, d: joins.contradictions(graph.relationships(s, d), "treats", "contraindicated_for"),
    "j17_audit": _audit,
    "j18_mechanism_paths": lambda s, d: joins.reachable(graph.relationships(s, d), "DRUG:4", 2).select(F.array_join("path", ">").alias("path"), "end", F.col("hops").cast("long").alias("hops")),
    "j18_repurposing": lambda s, d: joins.repurposing(graph.relationships(s, d)),
    "c12_first_mentions": _document_mentions,
}


def _first_subject(s, d):
    """The subject that stands in most triples of papers."""
    top = graph.paper_relationships(s, d).groupBy(F.col("subject_id").alias("start")).agg(F.count_distinct("object_id").alias("n"))
    return top.where("start IS NOT NULL").orderBy(F.desc("n"), "start").limit(1).select("start")


QUERIES["j10_reachable"] = lambda s, d: joins.reachable(graph.paper_relationships(s, d), _first_subject(s, d).first()["start"], 3).select(F.array_join("path", ">").alias("path"), "end", F.col("hops").cast("long").alias("hops"))

SQL = {
    "j1_entities_with_vectors": "SELECT e.*, v.model_name FROM (SELECT DISTINCT entity_id, name, type FROM entities) e JOIN (SELECT DISTINCT entity_id, model_name FROM entity_embeddings WHERE embedding IS NOT NULL) v USING (entity_id)",
    "j2_paragraphs_with_vectors": "SELECT paragraph_id, section, n_chars FROM documents WHERE paragraph_id IN (SELECT paragraph_id FROM paragraph_embeddings)",
    "j3_paragraphs_of_papers": "SELECT paragraph_id, paper_id, section FROM documents WHERE paper_id IN (SELECT paper_id FROM papers)",
    "j4_find_treatments": with_views("entities_v", "relationships_v", sql="""
, dis AS (SELECT entity_id, name FROM entities_v WHERE entity_type = 'disease' AND contains(lower(name), '#00000001') ORDER BY entity_id LIMIT 5),
capped AS (SELECT g.name AS drug, dis.name AS disease, r.subject_id, r.object_id, r.confidence FROM relationships_v r JOIN dis ON r.object_id = dis.entity_id JOIN entities_v g ON g.entity_id = r.subject_id AND g.entity_type = 'drug' WHERE r.predicate = 'treats'
 QUALIFY row_number() OVER (PARTITION BY r.object_id ORDER BY r.confidence DESC, r.subject_id) <= 20)
SELECT drug, disease, c.subject_id, c.object_id, c.confidence, (SELECT count(*) FROM assertions_v a WHERE a.predicate = 'treats' AND a.subject_id = c.subject_id AND a.object_id = c.object_id) AS evidence_count FROM capped c ORDER BY confidence DESC, object_id, subject_id LIMIT 20"""),
    "j5_related_genes": with_views("entities_v", "relationships_v", sql="""
, a AS (SELECT entity_id FROM entities_v WHERE contains(lower(name), 'small ring')), g AS (SELECT entity_id FROM entities_v WHERE entity_type = 'gene')
SELECT subject_id AS entity_id, predicate, object_id AS other_id, confidence FROM relationships_v WHERE subject_id IN (FROM a) AND object_id IN (FROM g)
UNION ALL SELECT object_id, predicate, subject_id, confidence FROM relationships_v WHERE object_id IN (FROM a) AND subject_id IN (FROM g)"""),
    "j6_co_occurrence": with_views("edge_mentions_v", sql="""
, m AS (SELECT paper_id, entity_id, max(confidence) AS confidence FROM edge_mentions_v WHERE NOT isnan(confidence) AND confidence BETWEEN 0 AND 1 GROUP BY 1, 2)
SELECT a.paper_id, a.entity_id AS a, b.entity_id AS b, least(a.confidence, b.confidence) AS confidence FROM m a JOIN m b ON a.paper_id = b.paper_id AND a.entity_id < b.entity_id WHERE least(a.confidence, b.confidence) >= 0.9::DOUBLE"""),
    "j7_recent_papers_of_triples": with_views("relationships_v", "papers_v", sql="SELECT subject_id, predicate, object_id, p.paper_id, p.publication_date FROM (SELECT subject_id, predicate, object_id, unnest(source_papers) AS paper_id FROM relationships_v) r JOIN papers_v p USING (paper_id) WHERE p.publication_date >= '2001-06-01'"),
    "j8_two_hops": with_views("relationships_v", sql="SELECT a.subject_id AS start, a.object_id AS middle, b.object_id AS \"end\" FROM relationships_v a JOIN relationships_v b ON b.subject_id = a.object_id WHERE a.predicate = 'binds_to' AND b.predicate = 'treats'"),
    "j9_traverse": with_views("relationships_v", sql=", t AS MATERIALIZED (SELECT subject_id, predicate, object_id FROM relationships_v) SELECT c.object_id AS \"end\", concat_ws('>', a.subject_id, a.object_id, b.object_id, c.object_id) AS path FROM t a JOIN t b ON b.subject_id = a.object_id JOIN t c ON c.subject_id = b.object_id WHERE a.subject_id = 'GENE:1' AND a.predicate = 'binds_to' AND b.predicate = 'treats' AND c.predicate = 'causes'"),
    "j10_reachable": "WITH RECURSIVE paper_rels_v AS (" + graph.VIEWS["paper_rels_v"] + """), e AS (SELECT DISTINCT subject_id, object_id FROM paper_rels_v WHERE predicate IS NOT NULL),
first AS (SELECT subject_id AS start FROM paper_rels_v WHERE subject_id IS NOT NULL GROUP BY 1 ORDER BY count(DISTINCT object_id) DESC, 1 LIMIT 1),
walk AS (SELECT [start] AS path, start AS last, 0 AS hops FROM first UNION ALL SELECT list_append(w.path, e.object_id), e.object_id, w.hops + 1 FROM walk w JOIN e ON e.subject_id = w.last WHERE w.hops < 3 AND NOT list_contains(w.path, e.object_id))
SELECT array_to_string(path, '>') AS path, last AS "end", hops FROM walk WHERE hops > 0""",
    "j11_resolved_only": with_views("paper_rels_v", sql="SELECT paper_id, pos, subject_id, predicate, object_id FROM paper_rels_v WHERE subject_id IN (SELECT entity_id FROM reference_entities) AND object_id IN (SELECT entity_id FROM reference_entities)"),
    "j12_orphans": with_views("edge_mentions_v", sql="SELECT DISTINCT upper(trim(entity_id)) AS entity_id FROM edge_mentions_v WHERE upper(trim(entity_id)) NOT IN (SELECT upper(entity_id) FROM reference_entities UNION ALL SELECT upper(entity_id) FROM entities WHERE entity_id IS NOT NULL)"),
    "j13_name_lookup": "WITH x AS (SELECT lower(name) AS key, entity_id FROM reference_entities UNION ALL SELECT lower(unnest(synonyms)), entity_id FROM reference_entities UNION ALL SELECT lower(unnest(abbreviations)), entity_id FROM reference_entities), one AS (SELECT key, max(entity_id) AS entity_id FROM x GROUP BY 1) SELECT n.name, one.entity_id FROM (SELECT DISTINCT name FROM entities WHERE name IS NOT NULL) n LEFT JOIN one ON lower(n.name) = one.key",
    "j16_contradictions": with_views("relationships_v", sql="SELECT a.subject_id, a.object_id, a.evidence_count AS n_for, b.evidence_count AS n_against, a.confidence AS confidence_for, b.confidence AS confidence_against FROM relationships_v a JOIN relationships_v b ON a.subject_id = b.subject_id AND a.object_id = b.object_id WHERE a.predicate = 'treats' AND b.predicate = 'contraindicated_for'"),
    "j17_audit": with_views("paper_rels_v", sql=texts.evidence_sql("(SELECT paper_id, pos AS paragraph_id, max(evidence) AS text, max(section) AS section FROM paper_rels_v WHERE evidence IS NOT NULL GROUP BY 1, 2)") + """, e AS (SELECT provenance.source_id AS paper_id, subject.id AS subject_id, object.id AS object_id, count(DISTINCT id) AS n_edges, max(CASE WHEN NOT isnan(confidence) AND confidence BETWEEN 0 AND 1 THEN confidence END) AS best_edge FROM extraction_edges GROUP BY 1, 2, 3)
SELECT c.paper_id, c.pos, c.subject_id, c.predicate, c.object_id, v.sample_size, v.p_value, v.confidence AS strength, coalesce(n_edges, 0) AS n_edges, best_edge FROM (SELECT DISTINCT paper_id, pos, subject_id, predicate, object_id FROM paper_rels_v) c
LEFT JOIN found v ON v.paper_id = c.paper_id AND v.paragraph_id = c.pos LEFT JOIN e ON e.paper_id = c.paper_id AND e.subject_id = c.subject_id AND e.object_id = c.object_id"""),
    "j18_mechanism_paths": with_views("relationships_v", sql="""
, e AS (SELECT DISTINCT subject_id, object_id FROM relationships_v WHERE predicate IS NOT NULL), one AS (SELECT object_id AS last FROM e WHERE subject_id = 'DRUG:4' AND object_id <> 'DRUG:4')
SELECT 'DRUG:4>' || last AS path, last AS "end", 1::BIGINT AS hops FROM one UNION ALL SELECT 'DRUG:4>' || one.last || '>' || e.object_id, e.object_id, 2::BIGINT FROM one JOIN e ON e.subject_id = one.last WHERE e.object_id NOT IN ('DRUG:4', one.last)"""),
    "j18_repurposing": with_views("relationships_v", sql="SELECT l.subject_id AS drug, l.object_id AS disease, t.shared FROM relationships_v l JOIN (SELECT object_id AS drug, count(DISTINCT subject_id) AS shared FROM relationships_v WHERE predicate = 'binds_to' GROUP BY 1) t ON t.drug = l.subject_id WHERE l.predicate = 'associated_with' AND NOT EXISTS (SELECT 1 FROM relationships_v x WHERE x.predicate = 'treats' AND x.subject_id = l.subject_id AND x.object_id = l.object_id)"),
    "c12_first_mentions": with_views("edge_mentions_v", sql=f"""
, m AS (SELECT paper_id, surface, min(entity_id) AS entity_id, max(CASE WHEN NOT isnan(confidence) THEN confidence END) AS confidence FROM edge_mentions_v WHERE surface IS NOT NULL GROUP BY 1, 2),
c AS (SELECT paper_id, regexp_replace(surface, '^\\s+|\\s+$', '', 'g') AS name, entity_id FROM m WHERE confidence >= 0.5::DOUBLE)
SELECT paper_id, name, entity_id FROM c WHERE length(name) >= 3 AND NOT starts_with(name, '##') AND lower(name) NOT IN ({', '.join(repr(w) for w in DOCUMENT_STOPWORDS)}) QUALIFY row_number() OVER (PARTITION BY paper_id, lower(name) ORDER BY name, entity_id) = 1"""),
}
