"""Queries: validation, upserts and vector search (V, U, X)."""

from __future__ import annotations

from pyspark.sql import functions as F

from biblioscope.operators import joins, lookup, rules
from biblioscope.operators import similarity as S
from biblioscope.operators import vector_index as I
from biblioscope.plans import graph
from biblioscope.plans.graph import with_views
from biblioscope.session import table

TRIPLE = ("subject_id", "predicate", "object_id")


def _typed(s, d):
    """Triples of papers with the types of both ends, where both are reference entities."""
    kinds = table(s, d, "reference_entities").select("entity_id", "type")
    r = graph.paper_relationships(s, d)
    return r.join(kinds.select(F.col("entity_id").alias("subject_id"), F.col("type").alias("subject_type")), "subject_id").join(kinds.select(F.col("entity_id").alias("object_id"), F.col("type").alias("object_type")), "object_id")


def _vectors(s, d, name="embeddings", key="vec_id"):
    return table(s, d, name).select(F.col(key).alias("id"), "embedding")


def _entity_vectors(s, d):
    return table(s, d, "entity_embeddings").where("embedding IS NOT NULL AND size(embedding) = 64").groupBy(F.col("entity_id").alias("id")).agg(F.max("embedding").alias("embedding"))


def _first(s, d, name, key):
    """The lowest key of a table of vectors: something to ask for."""
    return table(s, d, name).where(f"embedding IS NOT NULL AND size(embedding) = 64 AND {key} IS NOT NULL AND exists(embedding, x -> x <> 0) AND forall(embedding, x -> NOT isnan(x))").agg(F.min(key).alias("k")).first()["k"]


def _similar_paragraphs(s, d):
    vectors = table(s, d, "paragraph_embeddings").where("embedding IS NOT NULL AND size(embedding) = 64").groupBy(F.col("paragraph_id").alias("id")).agg(F.max("embedding").alias("embedding"))
    near = S.nearest_to(vectors, _first(s, d, "paragraph_embeddings", "paragraph_id"), 5)
    docs = table(s, d, "documents").select(F.col("paragraph_id").alias("id"), "text")
    return docs.join(F.broadcast(near), "id").select("id", F.round("similarity", 6).alias("similarity"), S.preview(F.col("text")).alias("preview"))


def _hybrid(s, d):
    """Entities by similarity to one of them and by the papers that mention them: n papers score n / (n + 10)."""
    papers = graph.edge_mentions(s, d).groupBy(F.col("entity_id").alias("id")).agg(F.count_distinct("paper_id").alias("n"))
    structure = papers.select("id", (F.col("n") / (F.col("n") + 10.0)).alias("structural"))
    vectors = _entity_vectors(s, d)
    asked = vectors.where(F.col("id") == _first(s, d, "entity_embeddings", "entity_id")).first()
    found = S.hybrid(vectors.where(F.col("id") != asked["id"]), asked["embedding"], structure, 50)
    return found.select("id", *[F.round(c, 6).alias(c) for c in ("similarity", "structural", "score")])


def _similar_triples(s, d):
    """The edges most similar to the first one with stored vectors at both ends."""
    edges = table(s, d, "extraction_edges").select(F.col("subject.id").alias("subject_id"), F.col("object.id").alias("object_id"))
    fine = _entity_vectors(s, d).where("forall(embedding, x -> NOT isnan(x)) AND exists(embedding, x -> x <> 0)")
    vectors = S.triple_vectors(edges, fine).select(F.struct("subject_id", "object_id").alias("id"), "embedding")
    one = vectors.agg(F.min("id").alias("id")).first()["id"]
    near = S.nearest(vectors, vectors.where((F.col("id.subject_id") == one["subject_id"]) & (F.col("id.object_id") == one["object_id"])).first()["embedding"], 20, None)
    return near.select("id.subject_id", "id.object_id", F.round("similarity", 6).alias("similarity"))


def _text_search(s, d):
    """Evidence texts of papers nearest to a question."""
    triples = graph.paper_relationships(s, d).where("evidence IS NOT NULL").groupBy(F.concat_ws(":", "paper_id", "pos").alias("id")).agg(F.max("evidence").alias("text"))
    return S.text_search(triples, "which gene increases the risk of disease in older patients", 20).withColumn("similarity", F.round("similarity", 6))


def _approximate(s, d):
    """The 5 nearest of all vectors for every vector whose id is divisible by 20, by the index of cells."""
    every = _vectors(s, d)
    return I.search(every, every.where("id % 20 = 0"), 5).withColumn("similarity", F.round("similarity", 6))


def _resolved_names(s, d):
    """Extracted entities with a vector: what their name means in the reference, else the nearest entity whose name does."""
    vectors = _entity_vectors(s, d)
    named = table(s, d, "entities").where("name IS NOT NULL AND entity_id IS NOT NULL").groupBy(F.col("entity_id").alias("id")).agg(F.min("name").alias("name")).join(vectors, "id")
    keys = lookup.synonym_index(table(s, d, "reference_entities")).select("key", "entity_id")
    sure = joins.name_lookup(named, keys).where("entity_id IS NOT NULL").select("id", "embedding")
    return I.resolve_names(named, keys, sure, 0.85).withColumn("similarity", F.round("similarity", 6))


def _semantic_entities(s, d):
    """The fluent form: entities of one type nearest to the vector of one of them."""
    asked = _entity_vectors(s, d).where(F.col("id") == _first(s, d, "entity_embeddings", "entity_id")).first()
    kinds = table(s, d, "entities").where("entity_id IS NOT NULL").groupBy("entity_id").agg(F.min("type").alias("entity_type"))
    query = lookup.GraphQuery({"entities": kinds, "vectors": _entity_vectors(s, d)}).semantic_search(asked["embedding"], "disease", 15, 0.0)
    return query.execute().to_dataframe().withColumn("similarity", F.round("similarity", 6))


def _edge_versions(s, d):
    """Edges by arrival with their fields: the later version of an id replaces the earlier one whole."""
    c = F.col("confidence")
    e = table(s, d, "extraction_edges").where("id IS NOT NULL").select(
        "id", *[F.col(f"{x}.{y}").alias(f"{x}_{y}") for x in ("subject", "object") for y in ("id", "name", "type")], F.col("provenance.source_id").alias("source_id"), F.when(~F.isnan(c), c).alias("confidence"), "extracted_at",
    )
    e = e.withColumn("seq", F.struct("extracted_at", *[x for x in e.columns if x not in ("id", "extracted_at")]))
    half = F.col("extracted_at") < F.lit("2025-04-01").cast("timestamp_ntz")
    return rules.upsert(e.where(half), e.where(F.coalesce(~half, F.lit(True))), ["id"], "seq").drop("seq")


def _paper_versions(s, d):
    """Papers by id: of the rows of one the last by title, with all its fields."""
    fields = ["pmid", "doi", "title", "abstract", "journal", "publication_date"]
    p = table(s, d, "papers").select("paper_id", *fields).withColumn("seq", F.struct("title", "abstract", "journal", "publication_date", "doi", "pmid"))
    return rules.upsert(p.where("title IS NULL"), p.where("title IS NOT NULL"), ["paper_id"], "seq").drop("seq")


def _triple_versions(s, d):
    """Triples of papers: the one of the last paper and place replaces the others, evidence and all."""
    r = graph.paper_relationships(s, d).select(*TRIPLE, "paper_id", "pos", "confidence", "section", "evidence")
    r = r.withColumn("seq", F.struct("paper_id", "pos", "confidence", "section", "evidence"))
    return rules.upsert(r.where("pos > 0"), r.where("pos = 0"), list(TRIPLE), "seq").drop("seq")


def _vector_versions(s, d):
    """Vectors by key: the last one with its model, time and numbers."""
    sums = [F.size("embedding").alias("dim"), F.round(F.aggregate("embedding", F.lit(0.0), lambda t, x: t + F.coalesce(F.when(~F.isnan(x), x.cast("double")), F.lit(0.0))), 4).alias("total")]
    v = table(s, d, "entity_embeddings").select("entity_id", "model_name", "updated_at", "embedding", F.struct("updated_at", F.coalesce("model_name", F.lit("")), F.coalesce(F.size("embedding"), F.lit(-1))).alias("seq"))
    return rules.upsert(v.where("model_name IS NULL"), v.where("model_name IS NOT NULL"), ["entity_id"], "seq").select("entity_id", "model_name", "updated_at", *sums)


QUERIES = {
    "v1_faults": lambda s, d: rules.checked_relationships(graph.paper_relationships(s, d)).select("paper_id", "pos", F.array_join("faults", ",").alias("faults")),
    "v2_without_provenance": lambda s, d: graph.relationships(s, d).where((F.size("source_papers") == 0) & (F.col("evidence_count") == 0)).select(*TRIPLE),
    "v3_predicates_by_type": lambda s, d: _typed(s, d).select("paper_id", "pos", "predicate", F.array_join(rules.valid_predicates(F.col("subject_type"), F.col("object_type")), ",").alias("allowed"), F.array_contains(rules.valid_predicates(F.col("subject_type"), F.col("object_type")), F.col("predicate")).alias("valid")),
    "v4_registered": lambda s, d: graph.paper_relationships(s, d).groupBy("predicate").agg(F.count("*").alias("n")).withColumn("registered", F.coalesce(F.col("predicate").isin(rules.PREDICATES), F.lit(False))),
    "v5_valid_entities": lambda s, d: rules.checked_entities(table(s, d, "entities").select("entity_id", "type")).groupBy("type").agg(F.count_if("valid").alias("n_valid"), F.count("*").alias("n")),
    "u1_merged_relationships": lambda s, d: rules.merged(graph.assertions(s, d)).select(*TRIPLE, "confidence", F.array_join("source_papers", ",").alias("source_papers"), "evidence_count"),
    "u1_last_version_of_edges": _edge_versions,
    "u1_upserted_triples": _triple_versions,
    "u2_papers_by_id": _paper_versions,
    "u3_appended_evidence": lambda s, d: graph.assertions(s, d).select("paper_id", *TRIPLE, "confidence").unionByName(graph.paper_relationships(s, d).select("paper_id", *TRIPLE, "confidence")).groupBy("predicate").agg(F.count("*").alias("n"), F.count_distinct("paper_id").alias("n_papers")),
    "x1_nearest_to_vector": lambda s, d: S.nearest(_vectors(s, d), [1.0] * 64, 10, 0.0).withColumn("similarity", F.round("similarity", 6)),
    "x2_similar_entities": lambda s, d: S.nearest_to(_entity_vectors(s, d), _first(s, d, "entity_embeddings", "entity_id"), 5).withColumn("similarity", F.round("similarity", 6)),
    "x3_similar_paragraphs": _similar_paragraphs,
    "x4_similar_triples": _similar_triples,
    "x5_text_search": _text_search,
    "x6_semantic_search": _semantic_entities,
    "x7_approximate": _approximate,
    "e7_resolved_names": _resolved_names,
    "x6_nearest_of_label": lambda s, d: S.nearest_to(_vectors(s, d).join(table(s, d, "embeddings").where("label = 3").select(F.col("vec_id").alias("id")), "id", "left_semi").unionByName(_vectors(s, d).where("id = 0")).distinct(), 0, 10).withColumn("similarity", F.round("similarity", 6)),
    "x8_hybrid": _hybrid,
    "x9_last_vectors": _vector_versions,
}
_REF = "(SELECT entity_id, type FROM reference_entities)"
_ALLOWED = "CASE " + " ".join(f"WHEN a.type IN ({', '.join(repr(x) for x in r[0])}) AND b.type IN ({', '.join(repr(x) for x in r[1])}) THEN '{','.join(r[2])}'" for r in rules.TYPE_RULES) + " WHEN a.type <> b.type THEN 'associated_with' ELSE '' END"
_GOOD = "embedding IS NOT NULL AND len(embedding) = 64"
_ASKED = "{k} IS NOT NULL AND " + _GOOD + " AND list_max([abs(x) for x in embedding]) > 0 AND NOT list_bool_or([isnan(x) for x in embedding])"
_COS = "list_cosine_similarity(v.embedding::DOUBLE[], q.embedding::DOUBLE[])"
_BYTES = "[('0x' || sha256(lower({}))[2 * i + 1:2 * i + 2])::INT / 255.0::DOUBLE for i in range(32)]"
_IS_BAD = "confidence IS NULL OR isnan(confidence) OR confidence < 0 OR confidence > 1"


def _near(table_: str, key: str) -> str:
    one = f"SELECT {key} AS id, max(embedding) AS embedding FROM {table_} WHERE {_GOOD} GROUP BY 1"
    return f"WITH v AS ({one}), q AS (SELECT * FROM v WHERE id = (SELECT min({key}) FROM {table_} WHERE {_ASKED.format(k=key)})), n AS (SELECT v.id, {_COS} AS similarity FROM v, q WHERE v.id <> q.id), top AS (SELECT * FROM n WHERE similarity IS NOT NULL AND NOT isnan(similarity) ORDER BY similarity DESC, id LIMIT 5)"


SQL = {
    "v1_faults": with_views("paper_rels_v", sql=f"SELECT paper_id, pos, concat_ws(',', CASE WHEN predicate IS NULL OR predicate NOT IN ({', '.join(repr(p) for p in rules.PREDICATES)}) THEN 'predicate' END, CASE WHEN {_IS_BAD} THEN 'confidence' END, CASE WHEN coalesce(trim(subject_id) = '', true) THEN 'subject' END, CASE WHEN coalesce(trim(object_id) = '', true) THEN 'object' END, CASE WHEN coalesce(subject_id = object_id, false) THEN 'self' END) AS faults FROM paper_rels_v"),
    "v2_without_provenance": with_views("relationships_v", sql="SELECT subject_id, predicate, object_id FROM relationships_v WHERE len(source_papers) = 0 AND evidence_count = 0"),
    "v3_predicates_by_type": with_views("paper_rels_v", sql=f"SELECT paper_id, pos, predicate, allowed, list_contains(string_split(allowed, ','), predicate) AS valid FROM (SELECT r.paper_id, r.pos, r.predicate, {_ALLOWED} AS allowed FROM paper_rels_v r JOIN {_REF} a ON a.entity_id = r.subject_id JOIN {_REF} b ON b.entity_id = r.object_id)"),
    "v4_registered": with_views("paper_rels_v", sql=f"SELECT predicate, count(*) AS n, coalesce(predicate IN ({', '.join(repr(p) for p in rules.PREDICATES)}), false) AS registered FROM paper_rels_v GROUP BY 1"),
    "v5_valid_entities": f"SELECT type, count(*) FILTER (coalesce(type IN ({', '.join(repr(t) for t in rules.ENTITY_TYPES)}) AND trim(entity_id) <> '' AND NOT starts_with(entity_id, 'prov:'), false)) AS n_valid, count(*) AS n FROM entities GROUP BY 1",
    "u1_merged_relationships": with_views("assertions_v", sql="SELECT subject_id, predicate, object_id, max(confidence) AS confidence, array_to_string(list_sort(list(DISTINCT paper_id)), ',') AS source_papers, count(*) AS evidence_count FROM assertions_v GROUP BY 1, 2, 3"),
    "u1_last_version_of_edges": "SELECT * FROM (SELECT id, subject.id AS subject_id, subject.name AS subject_name, subject.type AS subject_type, object.id AS object_id, object.name AS object_name, object.type AS object_type, provenance.source_id AS source_id, CASE WHEN NOT isnan(confidence) THEN confidence END AS confidence, extracted_at FROM extraction_edges WHERE id IS NOT NULL) QUALIFY row_number() OVER (PARTITION BY id ORDER BY extracted_at DESC NULLS LAST, subject_id DESC NULLS LAST, subject_name DESC NULLS LAST, subject_type DESC NULLS LAST, object_id DESC NULLS LAST, object_name DESC NULLS LAST, object_type DESC NULLS LAST, source_id DESC NULLS LAST, confidence DESC NULLS LAST) = 1",
    "u1_upserted_triples": with_views("paper_rels_v", sql="SELECT subject_id, predicate, object_id, paper_id, pos, confidence, section, evidence FROM paper_rels_v QUALIFY row_number() OVER (PARTITION BY subject_id, predicate, object_id ORDER BY paper_id DESC NULLS LAST, pos DESC, confidence DESC NULLS LAST, section DESC NULLS LAST, evidence DESC NULLS LAST) = 1"),
    "u2_papers_by_id": "SELECT paper_id, pmid, doi, title, abstract, journal, publication_date FROM papers QUALIFY row_number() OVER (PARTITION BY paper_id ORDER BY title DESC NULLS LAST, abstract DESC NULLS LAST, journal DESC NULLS LAST, publication_date DESC NULLS LAST, doi DESC NULLS LAST, pmid DESC NULLS LAST) = 1",
    "u3_appended_evidence": with_views("assertions_v", "paper_rels_v", sql="SELECT predicate, count(*) AS n, count(DISTINCT paper_id) AS n_papers FROM (SELECT paper_id, predicate FROM assertions_v UNION ALL SELECT paper_id, predicate FROM paper_rels_v) GROUP BY 1"),
    "x1_nearest_to_vector": "SELECT vec_id AS id, round(s, 6) AS similarity FROM (SELECT vec_id, list_cosine_similarity(embedding::DOUBLE[], [1.0::DOUBLE for i in range(64)]) AS s FROM embeddings) WHERE s >= 0 ORDER BY s DESC, vec_id LIMIT 10",
    "x2_similar_entities": _near("entity_embeddings", "entity_id") + " SELECT id, round(similarity, 6) AS similarity FROM top",
    "x3_similar_paragraphs": _near("paragraph_embeddings", "paragraph_id") + " SELECT top.id, round(similarity, 6) AS similarity, CASE WHEN length(text) > 100 THEN text[1:100] || '...' ELSE text END AS preview FROM top JOIN documents d ON d.paragraph_id = top.id",
    "x4_similar_triples": f"WITH v AS (SELECT entity_id AS id, max(embedding)::DOUBLE[] AS e FROM entity_embeddings WHERE {_GOOD} GROUP BY 1), fine AS (SELECT * FROM v WHERE list_max([abs(x) for x in e]) > 0 AND NOT list_bool_or([isnan(x) for x in e])), t AS (SELECT DISTINCT subject.id AS subject_id, object.id AS object_id FROM extraction_edges), w AS (SELECT t.*, a.e AS vs, b.e AS vo FROM t JOIN fine a ON a.id = subject_id JOIN fine b ON b.id = object_id), q AS (SELECT vs AS qs, vo AS qo FROM w ORDER BY subject_id, object_id LIMIT 1) SELECT subject_id, object_id, round((list_cosine_similarity(vs, qs) + list_cosine_similarity(vo, qo)) / 2, 6) AS similarity FROM w, q ORDER BY similarity DESC, subject_id, object_id LIMIT 20",
    "x5_text_search": with_views("paper_rels_v", sql=""", d AS (SELECT concat_ws(':', paper_id, pos) AS id, max(evidence) AS text FROM paper_rels_v WHERE evidence IS NOT NULL GROUP BY 1),
t AS (SELECT id, word, count(*) AS tf FROM (SELECT id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) AS word FROM d) GROUP BY 1, 2),
i AS (SELECT word, ln(1.0::DOUBLE + (SELECT count(*) FROM d) / count(*)::DOUBLE) AS idf FROM t GROUP BY 1),
q AS (SELECT word, count(*) AS n FROM (SELECT unnest(string_split('which gene increases the risk of disease in older patients', ' ')) AS word) GROUP BY 1),
m AS (SELECT q.word, n * coalesce(idf, ln(1.0::DOUBLE + (SELECT count(*) FROM d))) AS w FROM q LEFT JOIN i USING (word))
SELECT id, round(sum(tf * idf * coalesce(w, 0)) / (sqrt(sum(tf * idf * tf * idf)) * (SELECT sqrt(sum(w * w)) FROM m)), 6) AS similarity FROM t JOIN i USING (word) LEFT JOIN m USING (word) GROUP BY 1 HAVING sum(tf * idf * coalesce(w, 0)) > 0 ORDER BY sum(tf * idf * coalesce(w, 0)) / sqrt(sum(tf * idf * tf * idf)) DESC, id LIMIT 20"""),
    "x6_semantic_search": _near("entity_embeddings", "entity_id") + f", k AS (SELECT entity_id, min(type) AS type FROM entities WHERE entity_id IS NOT NULL GROUP BY 1) SELECT id AS entity_id, round(s, 6) AS similarity FROM (SELECT v.id, {_COS} AS s FROM v, q WHERE v.id IN (SELECT entity_id FROM k WHERE type = 'disease')) WHERE s >= 0 AND NOT isnan(s) ORDER BY s DESC, id LIMIT 15",
    "x6_nearest_of_label": f"SELECT v.vec_id AS id, round({_COS}, 6) AS similarity FROM embeddings v, (SELECT embedding FROM embeddings WHERE vec_id = 0) q WHERE v.label = 3 AND v.vec_id <> 0 ORDER BY {_COS} DESC, v.vec_id LIMIT 10",
    "x8_hybrid": _near("entity_embeddings", "entity_id") + f", p AS (SELECT e.id AS id, count(DISTINCT source_id) AS n FROM (SELECT provenance.source_id AS source_id, unnest([subject, object]) AS e FROM extraction_edges) WHERE source_id IS NOT NULL AND e.id IS NOT NULL GROUP BY 1), h AS (SELECT v.id, {_COS} AS similarity, coalesce(p.n / (p.n + 10.0::DOUBLE), 0.0::DOUBLE) AS structural FROM q, v LEFT JOIN p ON p.id = v.id WHERE v.id <> q.id) SELECT id, round(similarity, 6) AS similarity, round(structural, 6) AS structural, round(0.7::DOUBLE * similarity + 0.3::DOUBLE * structural, 6) AS score FROM h WHERE similarity IS NOT NULL AND NOT isnan(similarity) ORDER BY 0.7::DOUBLE * similarity + 0.3::DOUBLE * structural DESC, id LIMIT 50",
    "x9_last_vectors": "SELECT entity_id, model_name, updated_at, len(embedding) AS dim, round(list_sum([CASE WHEN NOT isnan(x) THEN x::DOUBLE ELSE 0 END for x in embedding]), 4) AS total FROM entity_embeddings QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY updated_at DESC NULLS LAST, coalesce(model_name, '') DESC, coalesce(len(embedding), -1) DESC) = 1",
}
