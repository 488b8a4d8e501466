"""Queries: claims, evidence, mentions, packing and embedding texts (C, K, E, G)."""

from __future__ import annotations

from pyspark.sql import functions as F

from biblioscope.functions import text as T
from biblioscope.operators import extraction as X
from biblioscope.operators import lookup
from biblioscope.plans import graph
from biblioscope.plans.graph import with_views
from biblioscope.session import table


def _paragraphs(s, d):
    return graph.paragraphs(s, d)


def _edge_names(s, d):
    """Names of edges as mentions: one for each edge and end."""
    edges = table(s, d, "extraction_edges").select("id", F.col("provenance.source_id").alias("paper_id"), F.explode(F.array("subject", "object")).alias("e"), "confidence")
    return edges.where("e.name IS NOT NULL AND paper_id IS NOT NULL").select("paper_id", F.col("e.name").alias("name"), F.col("e.id").alias("hint"), F.when(~F.isnan("confidence"), F.col("confidence")).alias("confidence"))


def _edge_forms(s, d):
    """Disease names of edges with a fixed order: by paper, then name."""
    forms = table(s, d, "extraction_edges").select(F.col("provenance.source_id").alias("p"), F.explode(F.array("subject", "object")).alias("e")).where("p IS NOT NULL AND e.type = 'disease' AND e.name IS NOT NULL")
    return forms.select(T.strip(F.col("e.name")).alias("name"), F.concat_ws("|", "p", T.strip(F.col("e.name"))).alias("seq"))


def _dictionary(s, d):
    """Where names, synonyms and abbreviations of reference entities stand in paragraphs."""
    return X.dictionary_mentions(_paragraphs(s, d), lookup.synonym_index(table(s, d, "reference_entities")))


def _paired(s, d):
    """Claims with the reference entities their paragraphs name, by any of the keys, in order of the ids."""
    found = _dictionary(s, d).select("paragraph_id", "entity_id").distinct().withColumn("pos", F.col("entity_id"))
    keys = lookup.synonym_index(table(s, d, "reference_entities")).where(F.col("key").rlike(r"[\p{L}\p{N}\-]")).select("entity_id", F.col("key").alias("name")).distinct()
    return X.paired_claims(X.all_claims(_paragraphs(s, d)), found, keys)


def _chunks(s, d):
    """Paragraphs of each paper packed in order to chunks of 2000 characters; lengths of the chunks."""
    chunks = X.packed_chunks(_paragraphs(s, d), 2000)
    return chunks.select("paper_id", "no", F.length("text").cast("long").alias("n_chars"), F.md5("text").alias("digest"))


def _found_evidence(s, d):
    """Triples of papers with all their texts in order; what the first one gives is appended to their evidence."""
    r = graph.paper_relationships(s, d).where("evidence IS NOT NULL").select("subject_id", "predicate", "object_id", F.struct("paper_id", "pos", "evidence").alias("e"))
    triples = r.groupBy("subject_id", "predicate", "object_id").agg(F.transform(F.array_sort(F.collect_set("e")), lambda x: x["evidence"]).alias("evidence"))
    none = F.array().cast("array<struct<sample_size:bigint,p_value:double,confidence:double,text_span:string>>")
    found = X.with_found_evidence(triples.withColumn("items", none))
    return found.select("subject_id", "predicate", "object_id", F.size("evidence").cast("long").alias("n_texts"), F.size("items").cast("long").alias("n_items"), F.get("items", F.lit(0)).alias("i")).select("subject_id", "predicate", "object_id", "n_texts", "n_items", "i.sample_size", "i.p_value", "i.confidence", "i.text_span")


def _claims(s, d):
    return X.claims(_paragraphs(s, d)).select("subject_id", "predicate", F.round("confidence", 6).alias("confidence"), "paper_id", "section", "text_span")


QUERIES = {
    "c1_claims": _claims,
    "c1_claims_as_read": lambda s, d: X.claims(_paragraphs(s, d), as_read=True).groupBy("predicate").agg(F.count("*").alias("n")),
    "c1_sentences": lambda s, d: X.sentence_rows(_paragraphs(s, d)).select("paragraph_id", F.col("no").cast("long").alias("no"), "sentence"),
    "c4_all_claims": lambda s, d: X.all_claims(_paragraphs(s, d)).select("paragraph_id", F.col("no").cast("long").alias("no"), "predicate"),
    "c5_sample_sizes": lambda s, d: _paragraphs(s, d).select("paragraph_id", T.sample_size(F.col("text")).alias("n")).where("n IS NOT NULL"),
    "c6_rates": lambda s, d: _paragraphs(s, d).select("paragraph_id", T.percentage(F.col("text")).alias("rate")).where("rate IS NOT NULL"),
    "c7_p_values": lambda s, d: _paragraphs(s, d).select("paragraph_id", T.p_value(F.col("text")).alias("p")).where("p IS NOT NULL"),
    "c8_strengths": lambda s, d: graph.assertions(s, d).select("paper_id", "subject_id", "sample_size", "p_value", F.round(T.evidence_strength(F.col("sample_size"), F.col("p_value")), 6).alias("strength")),
    "c9_evidence": lambda s, d: X.evidence(_paragraphs(s, d)),
    "c10_relationship_evidence": lambda s, d: X.evidence(graph.paper_relationships(s, d).where("evidence IS NOT NULL").select(F.concat_ws(":", "paper_id", "pos").alias("paragraph_id"), "paper_id", "section", F.col("evidence").alias("text")).distinct()),
    "c10_upserted_evidence": _found_evidence,
    "c11_clean_mentions": lambda s, d: X.clean_mentions(_edge_names(s, d)).select("paper_id", "name", "confidence"),
    "c13_contexts": lambda s, d: _paragraphs(s, d).select("paragraph_id", F.explode(X.places(F.col("text"), "disease")).alias("at"), "text").select("paragraph_id", X.context(F.col("text"), F.col("at"), F.col("at") + 7).alias("context")),
    "c14_listed_mentions": lambda s, d: table(s, d, "papers").select("paper_id", F.posexplode("entities").alias("pos", "e")).select("paper_id", F.col("pos").cast("long").alias("pos"), F.col("e.name").alias("name"), F.lower("e.type").alias("type"), F.col("e.id").alias("hint"), F.lit(0.9).alias("confidence")),
    "j14_paired_claims": lambda s, d: _paired(s, d).select("paragraph_id", F.col("no").cast("long").alias("no"), "predicate", "subject_id", "object_id"),
    "k1_packed_chunks": _chunks,
    "k2_slices": lambda s, d: _paragraphs(s, d).select("paragraph_id", F.posexplode(X.slices(F.col("text"), 512)).alias("no", "slice")).select("paragraph_id", F.col("no").cast("long").alias("no"), "slice"),
    "e1_dictionary_mentions": lambda s, d: _dictionary(s, d).select("paragraph_id", F.col("pos").cast("long").alias("pos"), F.col("n_words").cast("long").alias("n_words"), "entity_id"),
    "e2_label_types": lambda s, d: table(s, d, "extraction_edges").select(F.upper("subject.type").alias("label")).where("label IS NOT NULL").groupBy("label").agg(F.count("*").alias("n")).withColumn("type", T.label_type(F.col("label"))),
    "e3_canonical_ids": lambda s, d: table(s, d, "entities").where("type = 'disease' AND name IS NOT NULL").select(T.canonical_id(F.col("name")).alias("canonical_id")).groupBy("canonical_id").agg(F.count("*").alias("n")),
    "e4_entities_from_mentions": lambda s, d: X.entities_from_mentions(_edge_forms(s, d)).withColumn("synonyms", F.array_join("synonyms", "|")),
    "e5_ontologies": lambda s, d: table(s, d, "reference_entities").select("entity_id", T.ontology_of(F.col("entity_id"), F.col("type")).alias("m")).select("entity_id", F.explode("m").alias("ontology", "id")),
    "e6_resolved_mentions": lambda s, d: X.resolve_mentions(_edge_names(s, d).groupBy("paper_id", "name", "hint").agg(F.max("confidence").alias("confidence")).withColumn("pos", F.col("name")), table(s, d, "reference_entities")).select("paper_id", "name", "entity_id", "confidence"),
    "e10_json_parts": lambda s, d: table(s, d, "paper_json").select("rec_id", F.variant_get(T.json_part(F.concat(F.lit("Here you are: "), "payload", F.lit(" Done."))), "$.paper_id", "string").alias("paper_id")).where("paper_id IS NOT NULL"),
    "g1_entity_texts": lambda s, d: table(s, d, "reference_entities").select("entity_id", T.entity_text(F.col("name"), F.col("synonyms"), F.col("abbreviations")).alias("text")),
    "g2_hash_vectors": lambda s, d: table(s, d, "reference_entities").select("entity_id", F.posexplode(T.hash_vector(F.col("name"), 8)).alias("i", "x")).select("entity_id", F.col("i").cast("long").alias("i"), F.round("x", 9).alias("x")),
    "g4_relationship_texts": lambda s, d: graph.paper_relationships(s, d).select("paper_id", "pos", F.coalesce("evidence", F.concat_ws(" ", "subject_id", "predicate", "object_id")).alias("text")),
}

_SENT = "SELECT paragraph_id, paper_id, section, no, sentence FROM (SELECT paragraph_id, paper_id, section, unnest(range(len(parts))) AS no, regexp_replace(unnest(parts), '^\\s+|\\s+$', '', 'g') AS sentence FROM (SELECT *, regexp_split_to_array(text, '[.!?]+') AS parts FROM paragraphs_v)) WHERE length(sentence) >= 20"


def _ascii(c: str) -> str:
    """Word boundaries are ASCII in that SQL: other letters, marks and digits are made to count as letters."""
    return f"regexp_replace({c}, '[^\\x00-\\x7F\\p{{P}}\\p{{S}}\\p{{Z}}\\p{{C}}\\p{{No}}\\p{{Nl}}]', 'x', 'g')"


def _says(p: str) -> str:
    return f"regexp_matches({_ascii('sentence')}, '(?i)" + "|".join(f"(?:{x})" for x in X.CLAIM_PATTERNS[p]) + "')"


_FIRST = "CASE " + " ".join(f"WHEN {_says(p)} THEN '{p}'" for p in X.CLAIM_PATTERNS) + " END"
_NUM = "nullif(regexp_extract(plain, '{}', {}), '')"
_N = f"coalesce(try_cast({_NUM.format('(?i)\\bn\\s*=\\s*(\\d+)', 1)} AS BIGINT), try_cast({_NUM.format('(?i)\\b(\\d+)\\s+(?:samples|patients|subjects|nodes|lymph nodes|individuals|cases)', 1)} AS BIGINT))"
_RATIO = "(\\d+)\\s*(?:/|of)\\s*(\\d+)"
_R = f"coalesce({_NUM.format('(\\d+(?:\\.\\d+)?)\\s*%', 1)}::DOUBLE / 100.0::DOUBLE, {_NUM.format(_RATIO, 1)}::DOUBLE / nullif({_NUM.format(_RATIO, 2)}::DOUBLE, 0))"
_VALUE = "\\s*[<>=]\\s*(0?\\.\\d+|[01](?:\\.\\d+)?)"
_P = f"coalesce({_NUM.format('(?i)\\bp' + _VALUE, 1)}::DOUBLE, {_NUM.format('(?i)p\\s*-\\s*value' + _VALUE, 1)}::DOUBLE)"
_PLAIN = f"(SELECT *, {_ascii('text')} AS plain FROM paragraphs_v)"


def _strength(n: str, p: str) -> str:
    return f"greatest(0.0, least(1.0, 0.5::DOUBLE + CASE WHEN {n} >= 1000 THEN 0.2 WHEN {n} >= 100 THEN 0.1 WHEN {n} < 10 AND {n} <> 0 THEN -0.1 ELSE 0.0 END::DOUBLE + CASE WHEN {p} < 0.001 AND {p} <> 0 THEN 0.2 WHEN {p} < 0.01 AND {p} <> 0 THEN 0.1 WHEN {p} >= 0.05 THEN -0.1 ELSE 0.0 END::DOUBLE))"


def evidence_sql(source: str) -> str:
    """CTEs that read evidence from texts: ``found`` has a row for each that gives some."""
    return f""", plain_texts AS (SELECT *, {_ascii('text')} AS plain FROM {source}), numbers AS (SELECT *, {_N} AS n, {_P} AS p, {_R} AS rate FROM plain_texts),
found AS (SELECT paragraph_id, paper_id, coalesce(section, 'results') AS section, n AS sample_size, p AS p_value, round({_strength('n', 'p')}, 6) AS confidence, substring(text, 1, 500) AS text_span FROM numbers WHERE coalesce(n <> 0, false) OR coalesce(p <> 0, false) OR coalesce(rate <> 0, false))"""


_WORDS = "regexp_extract_all(lower({}), '[\\p{{L}}\\p{{N}}\\-]+')"
_FORMS = "SELECT entity_id, name AS key FROM reference_entities UNION ALL SELECT entity_id, unnest(synonyms) FROM reference_entities UNION ALL SELECT entity_id, unnest(abbreviations) FROM reference_entities"
_KEYS = f"SELECT DISTINCT entity_id, array_to_string(w, ' ') AS run, len(w) AS n FROM (SELECT entity_id, {_WORDS.format('key')} AS w FROM ({_FORMS})) WHERE len(w) > 0"
# every run of words as long as some key
_RUNS = f"SELECT paragraph_id, i AS pos, n AS n_words, array_to_string(w[i + 1:i + n], ' ') AS run FROM (SELECT paragraph_id, w, unnest(range(len(w))) AS i FROM (SELECT paragraph_id, {_WORDS.format('text')} AS w FROM paragraphs_v)), (SELECT DISTINCT n FROM k) WHERE i + n <= len(w)"
_NAMES = "SELECT provenance.source_id AS paper_id, e.name AS name, e.id AS hint, CASE WHEN NOT isnan(confidence) THEN confidence END AS confidence FROM (SELECT provenance, unnest([subject, object]) AS e, confidence FROM extraction_edges) WHERE e.name IS NOT NULL AND provenance.source_id IS NOT NULL"
_STOP = ", ".join(f"'{w}'" for w in X.EDGE_STOPWORDS)
SQL = {
    "c1_claims": with_views("paragraphs_v", sql=f""", s AS ({_SENT}), m AS (SELECT *, {_FIRST} AS predicate FROM s), c AS (SELECT *, row_number() OVER (PARTITION BY paragraph_id ORDER BY no) - 1 AS k FROM m WHERE predicate IS NOT NULL)
SELECT 'PLACEHOLDER_SUBJECT_' || paragraph_id || '_claim_' || k AS subject_id, predicate, CASE WHEN section IN ('results', 'abstract') THEN 0.8 WHEN section = 'methods' THEN 0.6 ELSE 0.7 END::DOUBLE AS confidence, paper_id, section, sentence AS text_span FROM c"""),
    "c1_claims_as_read": with_views("paragraphs_v", sql=f", s AS ({_SENT}), m AS (SELECT *, {_FIRST} AS predicate FROM s), c AS (SELECT *, lag(sentence) OVER (PARTITION BY paragraph_id ORDER BY no) AS last FROM m WHERE predicate IS NOT NULL) SELECT predicate, count(*) AS n FROM c WHERE predicate = 'causes' OR last IS NULL OR last <> sentence GROUP BY 1"),
    "c1_sentences": with_views("paragraphs_v", sql=f", s AS ({_SENT}) SELECT paragraph_id, no, sentence FROM s"),
    "c4_all_claims": with_views("paragraphs_v", sql=f", s AS ({_SENT}) " + " UNION ALL ".join(f"SELECT paragraph_id, no, '{p}' AS predicate FROM s WHERE {_says(p)}" for p in X.CLAIM_PATTERNS)),
    "c5_sample_sizes": with_views("paragraphs_v", sql=f"SELECT * FROM (SELECT paragraph_id, {_N} AS n FROM {_PLAIN}) WHERE n IS NOT NULL"),
    "c6_rates": with_views("paragraphs_v", sql=f"SELECT * FROM (SELECT paragraph_id, {_R} AS rate FROM {_PLAIN}) WHERE rate IS NOT NULL"),
    "c7_p_values": with_views("paragraphs_v", sql=f"SELECT * FROM (SELECT paragraph_id, {_P} AS p FROM {_PLAIN}) WHERE p IS NOT NULL"),
    "c8_strengths": with_views("assertions_v", sql=f"SELECT paper_id, subject_id, sample_size, p_value, round({_strength('sample_size', 'p_value')}, 6) AS strength FROM assertions_v"),
    "c9_evidence": with_views("paragraphs_v", sql=evidence_sql("paragraphs_v") + " SELECT * FROM found"),
    "c10_relationship_evidence": with_views("paper_rels_v", sql=evidence_sql("(SELECT DISTINCT concat_ws(':', paper_id, pos) AS paragraph_id, paper_id, section, evidence AS text FROM paper_rels_v WHERE evidence IS NOT NULL)") + " SELECT * FROM found"),
    "c10_upserted_evidence": with_views("paper_rels_v", sql=", d AS (SELECT subject_id, predicate, object_id, count(DISTINCT (paper_id, pos, evidence)) AS n_texts, arg_min(evidence, (paper_id, pos, evidence)) AS text FROM paper_rels_v WHERE evidence IS NOT NULL GROUP BY 1, 2, 3), k AS (SELECT *, row_number() OVER () AS paragraph_id FROM d)" + evidence_sql("(SELECT paragraph_id, text, '' AS paper_id, '' AS section FROM k)") + " SELECT subject_id, predicate, object_id, n_texts, CASE WHEN f.paragraph_id IS NULL THEN 0 ELSE 1 END::BIGINT AS n_items, sample_size, p_value, confidence, text_span FROM k LEFT JOIN found f ON f.paragraph_id = k.paragraph_id"),
    "c11_clean_mentions": f"SELECT paper_id, n AS name, confidence FROM (SELECT *, regexp_replace(name, '^\\s+|\\s+$', '', 'g') AS n FROM ({_NAMES})) WHERE length(n) >= 3 AND NOT starts_with(n, '##') AND lower(n) NOT IN ({_STOP}) AND confidence >= 0.85::DOUBLE",
    "c13_contexts": with_views("paragraphs_v", sql=""", f AS (SELECT paragraph_id, text, string_split(text, 'disease') AS parts FROM paragraphs_v),
p AS (SELECT paragraph_id, text, length(array_to_string(parts[1:i], 'disease')) AS place FROM (SELECT *, unnest(range(1, len(parts))) AS i FROM f))
SELECT paragraph_id, substring(text, greatest(place - 50, 0) + 1, place + 57 - greatest(place - 50, 0)) AS context FROM p"""),
    "c14_listed_mentions": "SELECT paper_id, pos, e.name AS name, lower(e.type) AS type, e.id AS hint, 0.9::DOUBLE AS confidence FROM (SELECT paper_id, unnest(range(len(entities))) AS pos, unnest(entities) AS e FROM papers)",
    "j14_paired_claims": with_views("paragraphs_v", sql=f""", s AS ({_SENT}), c AS ({' UNION ALL '.join(f"SELECT paragraph_id, paper_id, no, sentence, '{p}' AS predicate FROM s WHERE {_says(p)}" for p in X.CLAIM_PATTERNS)}),
k AS ({_KEYS}), r AS ({_RUNS}), f AS (SELECT DISTINCT entity_id, lower(key) AS key FROM ({_FORMS}) WHERE regexp_matches(key, '[\\p{{L}}\\p{{N}}\\-]')),
m AS (SELECT DISTINCT paragraph_id, entity_id FROM r JOIN k USING (run)),
g AS (SELECT paragraph_id, no, predicate, list_sort(list(DISTINCT entity_id)) AS ids FROM c JOIN m USING (paragraph_id) JOIN f USING (entity_id) WHERE contains(lower(sentence), f.key) GROUP BY 1, 2, 3)
SELECT paragraph_id, no, predicate, ids[1] AS subject_id, ids[2] AS object_id FROM g WHERE len(ids) > 1"""),
    "k1_packed_chunks": "WITH RECURSIVE o AS (SELECT paper_id, text, length(text) AS n, row_number() OVER (PARTITION BY paper_id ORDER BY paragraph_id) AS k FROM documents WHERE paper_id IS NOT NULL AND text IS NOT NULL), f AS (SELECT paper_id, k, 0 AS no, n + 2 AS size FROM o WHERE k = 1 UNION ALL SELECT o.paper_id, o.k, CASE WHEN f.size + o.n > 2000 THEN f.no + 1 ELSE f.no END, CASE WHEN f.size + o.n > 2000 THEN o.n ELSE f.size + o.n + 2 END FROM f JOIN o ON o.paper_id = f.paper_id AND o.k = f.k + 1), c AS (SELECT paper_id, no, string_agg(text, chr(10) || chr(10) ORDER BY k) AS text FROM f JOIN o USING (paper_id, k) GROUP BY 1, 2) SELECT paper_id, no::BIGINT AS no, length(text) AS n_chars, md5(text) AS digest FROM c",
    "k2_slices": with_views("paragraphs_v", sql="SELECT paragraph_id, no, substring(text, no * 512 + 1, 512) AS slice FROM (SELECT paragraph_id, text, unnest(range(((length(text) + 511) / 512)::INT)) AS no FROM (SELECT paragraph_id, text FROM paragraphs_v WHERE length(text) > 0)) WHERE no * 512 < length(text)"),
    "e1_dictionary_mentions": with_views("paragraphs_v", sql=f", k AS ({_KEYS}), r AS ({_RUNS}) SELECT paragraph_id, pos, n_words, entity_id FROM r JOIN k USING (run)"),
    "e2_label_types": "SELECT label, n, CASE WHEN label LIKE '%DISEASE%' THEN 'disease' WHEN label LIKE '%GENE%' OR label LIKE '%PROTEIN%' THEN 'gene' WHEN label LIKE '%DRUG%' OR label LIKE '%CHEMICAL%' THEN 'drug' ELSE 'disease' END AS type FROM (SELECT upper(subject.type) AS label, count(*) AS n FROM extraction_edges WHERE subject.type IS NOT NULL GROUP BY 1)",
    "e3_canonical_ids": "SELECT 'DISEASE:' || replace(lower(name), ' ', '_') AS canonical_id, count(*) AS n FROM entities WHERE type = 'disease' AND name IS NOT NULL GROUP BY 1",
    "e4_entities_from_mentions": "WITH m AS (SELECT regexp_replace(e.name, '^\\s+|\\s+$', '', 'g') AS name, p FROM (SELECT provenance.source_id AS p, unnest([subject, object]) AS e FROM extraction_edges) WHERE p IS NOT NULL AND e.type = 'disease' AND e.name IS NOT NULL), f AS (SELECT 'DISEASE:' || replace(lower(name), ' ', '_') AS entity_id, name, min(p || '|' || name) AS seq, count(*) AS n FROM m GROUP BY 1, 2), l AS (SELECT entity_id, list(name ORDER BY seq, name) AS forms, sum(n)::BIGINT AS n FROM f GROUP BY 1) SELECT entity_id, forms[1] AS name, coalesce(array_to_string(forms[2:], '|'), '') AS synonyms, n FROM l",
    "e5_ontologies": "SELECT entity_id, ontology, entity_id AS id FROM (SELECT entity_id, CASE WHEN contains(entity_id, ':') THEN lower(split_part(entity_id, ':', 1)) WHEN type = 'disease' AND regexp_matches(entity_id, '^C[0-9]+$') THEN 'umls' WHEN type = 'gene' THEN 'hgnc' WHEN type = 'drug' THEN 'rxnorm' WHEN type = 'protein' AND regexp_matches(entity_id, '^[PQ]') THEN 'uniprot' END AS ontology FROM reference_entities) WHERE ontology IS NOT NULL",
    "e6_resolved_mentions": f"WITH m AS (SELECT paper_id, name, hint, max(confidence) AS confidence FROM ({_NAMES}) GROUP BY 1, 2, 3) SELECT paper_id, name, coalesce(e.entity_id, 'prov:' || sha256(paper_id || '|' || name)) AS entity_id, CASE WHEN e.entity_id IS NULL THEN m.confidence * 0.5 ELSE m.confidence END AS confidence FROM m LEFT JOIN (SELECT DISTINCT entity_id FROM reference_entities) e ON e.entity_id = m.hint",
    "e10_json_parts": "SELECT rec_id, json_extract_string(x, '$.paper_id') AS paper_id FROM (SELECT rec_id, ltrim(payload, chr(65279)) AS x FROM paper_json) WHERE json_valid(x) AND json_type(x) = 'OBJECT' AND json_extract_string(x, '$.paper_id') IS NOT NULL",
    "g1_entity_texts": "SELECT entity_id, array_to_string(list_concat(list_concat([name], coalesce(synonyms, [])[1:5]), coalesce(abbreviations, [])[1:3]), ' ') AS text FROM reference_entities",
    "g2_hash_vectors": "WITH b AS (SELECT entity_id, [('0x' || sha256(lower(name))[2 * i + 1:2 * i + 2])::INT / 255.0::DOUBLE for i in range(8)] AS raw FROM reference_entities) SELECT entity_id, unnest(range(8)) AS i, round(unnest(raw) / sqrt(list_sum([x * x for x in raw])), 9) AS x FROM b",
    "g4_relationship_texts": with_views("paper_rels_v", sql="SELECT paper_id, pos, coalesce(evidence, concat_ws(' ', subject_id, predicate, object_id)) AS text FROM paper_rels_v"),
}
