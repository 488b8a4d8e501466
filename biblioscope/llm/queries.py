"""Queries over the numbered problems of this subpackage, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from biblioscope.llm import canonical, cooccur, leaks, mixture, spans, topn, vectors
from biblioscope.session import table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cooccur.p1_pairs(table(spark, sf_dir, "extraction_edges"))


def p1_lift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same pairs with their counts and how much more often than chance they meet."""
    found = cooccur.pairs_together(cooccur.baskets_of(table(spark, sf_dir, "extraction_edges")))
    return found.withColumn("lift", F.round("lift", 6))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topn.top_edges(table(spark, sf_dir, "extraction_edges"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical.resolve(table(spark, sf_dir, "entities"), table(spark, sf_dir, "reference_entities"))


def p3_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every different name that denotes an entry, with how well it fits."""
    return canonical.canonical(table(spark, sf_dir, "entities"), table(spark, sf_dir, "reference_entities")).withColumn("score", F.round("score", 6))


def _similar(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = {"entity_embeddings": "entity_id", "paragraph_embeddings": "paragraph_id"}
    return vectors.similar_pairs({t: table(spark, sf_dir, t).select(F.col(k).alias("id"), "embedding") for t, k in keys.items()})


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _similar(spark, sf_dir).select("id_a", "id_b").distinct()


def p5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pairs with the table they stand in and their cosine."""
    return _similar(spark, sf_dir).withColumn("cosine", F.round("cosine", 6))


def _leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.leaked_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _leaks(spark, sf_dir).select("doc_id", "item_id").distinct()


def p6_removal_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stretches of each document to be removed, with the items they leak."""
    return leaks.removal_spans(_leaks(spark, sf_dir))


def p7_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixture.mixture(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))
    return mixed.withColumnRenamed("key", "doc_id").withColumnRenamed("name", "source")


def p7_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each source was to give and what it gave."""
    return mixture.shares_reached(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.sharing_pairs(table(spark, sf_dir, "documents"))


def p8_shared_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of every document stands elsewhere, with its class of copies."""
    return spans.shared_part(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": p1_found,
    "p1_lift": p1_lift,
    "p2_found": p2_found,
    "p3_found": p3_found,
    "p3_names": p3_names,
    "p5_found": p5_found,
    "p5_nearest": p5_nearest,
    "p6_found": p6_found,
    "p6_removal_spans": p6_removal_spans,
    "p7_mixture": p7_mixture,
    "p7_shares": p7_shares,
    "p8_found": p8_found,
    "p8_shared_part": p8_shared_part,
}

_ITEMS = r"""
WITH raw AS (
  SELECT provenance.source_id AS record, unnest([subject.id, object.id]) AS raw_id FROM extraction_edges
), baskets AS (
  SELECT DISTINCT record, upper(regexp_replace(raw_id, '^\s+|\s+$', '', 'g')) AS item FROM raw
  WHERE record IS NOT NULL AND regexp_replace(raw_id, '^\s+|\s+$', '', 'g') <> ''
), total AS (SELECT count(DISTINCT record) AS n FROM baskets),
counts AS (SELECT item, count(*) AS n FROM baskets GROUP BY item),
pairs AS (
  SELECT a.item AS item_a, b.item AS item_b, count(*) AS n_ab
  FROM baskets a JOIN baskets b ON a.record = b.record AND a.item < b.item
  GROUP BY 1, 2 HAVING count(*) >= 6
)
"""

_RUNS = """
WITH d AS (SELECT doc_id, text, length(text) AS n FROM documents WHERE text IS NOT NULL),
w AS (SELECT doc_id, i, hash(substring(text, i + 1, 400)) AS h FROM (SELECT doc_id, text, unnest(range(n - 399)) AS i FROM d WHERE n >= 400))
"""

SQL: dict[str, str] = {
    "p1_found": _ITEMS + """
SELECT item_a, item_b FROM pairs JOIN counts x ON x.item = item_a JOIN counts y ON y.item = item_b, total
WHERE n_ab * total.n >= 5.0 * x.n * y.n""",
    "p1_lift": _ITEMS + """
SELECT item_a, item_b, n_ab, x.n AS n_a, y.n AS n_b, round(n_ab * total.n / (x.n * y.n)::DOUBLE, 6) AS lift
FROM pairs JOIN counts x ON x.item = item_a JOIN counts y ON y.item = item_b, total
WHERE n_ab * total.n >= 5.0 * x.n * y.n""",
    "p2_found": r"""
WITH latest AS (
  SELECT id, subject.id AS sid, confidence FROM extraction_edges WHERE id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY extracted_at DESC NULLS LAST) = 1
), valid AS (
  SELECT id, upper(regexp_replace(sid, '^\s+|\s+$', '', 'g')) AS subject_id, confidence FROM latest
  WHERE NOT isnan(confidence) AND confidence BETWEEN 0 AND 1 AND regexp_replace(sid, '^\s+|\s+$', '', 'g') <> ''
), ranked AS (
  SELECT subject_id, id, row_number() OVER (PARTITION BY subject_id ORDER BY confidence + 0.0 DESC, id) AS rank_no,
         count(*) OVER (PARTITION BY subject_id) AS n FROM valid
)
SELECT subject_id, rank_no, id AS edge_id FROM ranked WHERE n > 5 AND rank_no <= 5""",
    "p8_found": _RUNS + "SELECT DISTINCT a.doc_id AS doc_a, b.doc_id AS doc_b FROM (SELECT DISTINCT doc_id, h FROM w) a JOIN (SELECT DISTINCT doc_id, h FROM w) b ON a.h = b.h AND a.doc_id < b.doc_id",
    "p8_shared_part": _RUNS + """, many AS (SELECT h FROM w GROUP BY h HAVING count(DISTINCT doc_id) > 1), hit AS (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS next FROM w WHERE h IN (FROM many)),
covered AS (SELECT doc_id, sum(least(400, coalesce(next - i, 400)))::BIGINT AS c FROM hit GROUP BY 1), copies AS (SELECT text, min(doc_id) AS class_id, count(*) AS n_copies FROM d WHERE n >= 400 GROUP BY 1)
SELECT d.doc_id AS doc, n AS n_chars, coalesce(c, 0) AS shared_chars, coalesce(round(coalesce(c, 0) / nullif(n, 0)::DOUBLE, 6), 0.0::DOUBLE) AS share, coalesce(class_id, d.doc_id) AS class_id, coalesce(n_copies, 1) AS n_copies
FROM d LEFT JOIN covered ON covered.doc_id = d.doc_id LEFT JOIN copies ON copies.text = d.text AND n >= 400""",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return QUERIES


def oracle_sql() -> dict[str, str]:
    return SQL
