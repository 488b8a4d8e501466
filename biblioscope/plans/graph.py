"""The graph over the given tables: entities, assertions, triples, evidence and mentions, as DataFrames and as SQL.

Orders stand for papers, line items for what a paper asserts of a drug and a disease; customers are diseases,
parts drugs, suppliers genes, nations symptoms, regions pathways. The literature tables (papers, entities,
reference_entities, extraction_edges, documents) are used as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from biblioscope.operators import rules
from biblioscope.session import table

KINDS = {"drug": ("part", "p_partkey", "p_name", "p_type"), "gene": ("supplier", "s_suppkey", "s_name", None), "disease": ("customer", "c_custkey", "c_name", "c_mktsegment"), "symptom": ("nation", "n_nationkey", "n_name", None), "pathway": ("region", "r_regionkey", "r_name", None)}


def _id(kind: str, column: str):
    return F.concat(F.lit(kind.upper() + ":"), F.col(column).cast("string"))


def entities(spark: SparkSession, d: str) -> DataFrame:
    parts = [
        table(spark, d, t).select(_id(kind, key).alias("entity_id"), F.lit(kind).alias("entity_type"), F.col(name).alias("name"), (F.col(category) if category else F.lit(None).cast("string")).alias("category"))
        for kind, (t, key, name, category) in KINDS.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def papers(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(F.concat(F.lit("PMC"), "o_orderkey").alias("paper_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("publication_date"), F.col("o_orderpriority").alias("journal"), F.col("o_custkey").alias("custkey"))


def assertions(spark: SparkSession, d: str) -> DataFrame:
    """What each paper states of a drug and a disease, with the evidence given for it."""
    items = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_returnflag")
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    predicate = F.when(F.col("l_returnflag") == "R", "treats").when(F.col("l_returnflag") == "A", "contraindicated_for").otherwise("associated_with")
    study = F.get(F.array(*[F.lit(s) for s in ("rct", "cohort", "case_control", "observational", "review")]), F.pmod("l_linenumber", F.lit(5)))
    return items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        _id("drug", "l_partkey").alias("subject_id"), predicate.alias("predicate"), _id("disease", "o_custkey").alias("object_id"), (F.lit(1.0) - F.col("l_discount") * 5).alias("confidence"),
        F.concat(F.lit("PMC"), "l_orderkey").alias("paper_id"), (F.col("l_quantity") * F.col("l_quantity")).cast("long").alias("sample_size"), (F.col("l_tax") + 0.0).alias("p_value"), study.alias("study_type"),
    )


def relationships(spark: SparkSession, d: str) -> DataFrame:
    """One row for each triple: merged assertions, and what genes bind, diseases cause and genes take part in."""
    base = rules.merged(assertions(spark, d))
    empty = F.array().cast("array<string>")
    binds = table(spark, d, "lineitem").select(_id("gene", "l_suppkey").alias("subject_id"), F.lit("binds_to").alias("predicate"), _id("drug", "l_partkey").alias("object_id")).distinct()
    causes = table(spark, d, "customer").select(_id("disease", "c_custkey").alias("subject_id"), F.lit("causes").alias("predicate"), _id("symptom", "c_nationkey").alias("object_id"))
    nation = table(spark, d, "nation").select("n_nationkey", "n_regionkey")
    part = table(spark, d, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(_id("gene", "s_suppkey").alias("subject_id"), F.lit("participates_in").alias("predicate"), _id("pathway", "n_regionkey").alias("object_id"))
    rest = binds.unionByName(causes).unionByName(part).select("*", F.lit(0.5).alias("confidence"), empty.alias("source_papers"), F.lit(0).cast("long").alias("evidence_count"))
    return base.unionByName(rest)


def paper_relationships(spark: SparkSession, d: str) -> DataFrame:
    """The triples stored within ``papers``, one row for each paper row and place."""
    return table(spark, d, "papers").select("paper_id", F.posexplode("relationships").alias("pos", "r")).select("paper_id", F.col("pos").cast("long").alias("pos"), "r.subject_id", "r.predicate", "r.object_id", "r.confidence", "r.section", "r.evidence")


def edge_mentions(spark: SparkSession, d: str) -> DataFrame:
    """Entities named on the edges of a paper: (paper_id, entity_id, surface, confidence), repeats included."""
    edges = table(spark, d, "extraction_edges").select(F.col("provenance.source_id").alias("paper_id"), F.explode(F.array("subject", "object")).alias("e"), "confidence")
    return edges.where("paper_id IS NOT NULL AND e.id IS NOT NULL").select("paper_id", F.col("e.id").alias("entity_id"), F.col("e.name").alias("surface"), "confidence")


def paragraphs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").where("text IS NOT NULL").select("paragraph_id", "paper_id", "section", "text", "lang")


#: The same views in SQL; a query names those it needs.
VIEWS = {
    "entities_v": "SELECT 'DRUG:' || p_partkey AS entity_id, 'drug' AS entity_type, p_name AS name, p_type AS category FROM part UNION ALL SELECT 'GENE:' || s_suppkey, 'gene', s_name, NULL FROM supplier UNION ALL SELECT 'DISEASE:' || c_custkey, 'disease', c_name, c_mktsegment FROM customer UNION ALL SELECT 'SYMPTOM:' || n_nationkey, 'symptom', n_name, NULL FROM nation UNION ALL SELECT 'PATHWAY:' || r_regionkey, 'pathway', r_name, NULL FROM region",
    "papers_v": "SELECT 'PMC' || o_orderkey AS paper_id, strftime(o_orderdate, '%Y-%m-%d') AS publication_date, o_orderpriority AS journal, o_custkey AS custkey FROM orders",
    "assertions_v": "SELECT 'DRUG:' || l_partkey AS subject_id, CASE l_returnflag WHEN 'R' THEN 'treats' WHEN 'A' THEN 'contraindicated_for' ELSE 'associated_with' END AS predicate, 'DISEASE:' || o_custkey AS object_id, 1.0::DOUBLE - l_discount * 5 AS confidence, 'PMC' || l_orderkey AS paper_id, (l_quantity * l_quantity)::BIGINT AS sample_size, l_tax + 0.0::DOUBLE AS p_value, ['rct', 'cohort', 'case_control', 'observational', 'review'][l_linenumber % 5 + 1] AS study_type FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
    "relationships_v": "SELECT subject_id, predicate, object_id, max(confidence) AS confidence, list_sort(list(DISTINCT paper_id)) AS source_papers, count(*) AS evidence_count FROM assertions_v GROUP BY 1, 2, 3 UNION ALL SELECT DISTINCT 'GENE:' || l_suppkey, 'binds_to', 'DRUG:' || l_partkey, 0.5::DOUBLE, []::VARCHAR[], 0::BIGINT FROM lineitem UNION ALL SELECT 'DISEASE:' || c_custkey, 'causes', 'SYMPTOM:' || c_nationkey, 0.5::DOUBLE, []::VARCHAR[], 0::BIGINT FROM customer UNION ALL SELECT 'GENE:' || s_suppkey, 'participates_in', 'PATHWAY:' || n_regionkey, 0.5::DOUBLE, []::VARCHAR[], 0::BIGINT FROM supplier JOIN nation ON s_nationkey = n_nationkey",
    "paper_rels_v": "SELECT paper_id, unnest(range(len(relationships))) AS pos, unnest(relationships).subject_id AS subject_id, unnest(relationships).predicate AS predicate, unnest(relationships).object_id AS object_id, unnest(relationships).confidence AS confidence, unnest(relationships).section AS section, unnest(relationships).evidence AS evidence FROM papers",
    "edge_mentions_v": "SELECT paper_id, e.id AS entity_id, e.name AS surface, confidence FROM (SELECT provenance.source_id AS paper_id, unnest([subject, object]) AS e, confidence FROM extraction_edges) WHERE paper_id IS NOT NULL AND e.id IS NOT NULL",
    "paragraphs_v": "SELECT paragraph_id, paper_id, section, text, lang FROM documents WHERE text IS NOT NULL",
}
NEEDS = {"relationships_v": ("assertions_v",)}


def with_views(*names: str, sql: str) -> str:
    """``sql`` with the views it needs in front."""
    wanted: list[str] = []
    for n in names:
        wanted += [v for v in (*NEEDS.get(n, ()), n) if v not in wanted]
    return "WITH " + ", ".join(f"{v} AS ({VIEWS[v]})" for v in wanted) + " " + sql
