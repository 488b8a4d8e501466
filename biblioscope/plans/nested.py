"""Queries over nested paper records (problem 4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from biblioscope.operators import nested
from biblioscope.session import table


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.mesh_terms(table(spark, sf_dir, "paper_json"))


def p4_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables and columns the records fall into, with their counts."""
    return nested.path_groups(nested.path_triples(table(spark, sf_dir, "paper_json"), "rec_id", "payload", text_at=nested.PAPER_TEXTS))


def p4_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The child table of ``relationships``, linked to its record by rec_id and place."""
    triples = nested.path_triples(table(spark, sf_dir, "paper_json"), "rec_id", "payload", under=("relationships",))
    names = ("subject_id", "predicate", "object_id", "confidence", "section")
    rows = nested.related_table(triples, "relationships[]", {n: n for n in names})
    return rows.select(F.col("key").alias("rec_id"), F.get("ordinals", F.lit(0)).cast("long").alias("rel_no"), "subject_id", "predicate", "object_id", F.col("confidence").try_cast("double").alias("confidence"), "section")


QUERIES = {
    "p4_found": p4_found,
    "p4_paths": p4_paths,
    "p4_relationships": p4_relationships,
    "p4_unreadable": lambda s, d: nested.unreadable(table(s, d, "paper_json"), "rec_id", "payload").withColumnRenamed("key", "rec_id"),
}

# a record without what encloses it: one layer less in each step
_STEP = """CASE WHEN NOT json_valid(j) THEN NULL
  WHEN json_type(j) = 'VARCHAR' THEN ltrim(json_extract_string(j, '$'), chr(65279))
  WHEN json_type(j) = 'ARRAY' AND json_array_length(j) = 1 THEN json_extract(j, '$[0]')::VARCHAR
  WHEN json_type(j) = 'OBJECT' AND NOT json_exists(j, '$.metadata') AND json_type(j, '$.record') IN ('OBJECT', 'VARCHAR') THEN json_extract(j, '$.record')::VARCHAR
  WHEN json_type(j) = 'OBJECT' AND NOT json_exists(j, '$.metadata') AND json_type(j, '$.data') IN ('OBJECT', 'VARCHAR') THEN json_extract(j, '$.data')::VARCHAR END"""
_OPEN = f"""WITH RECURSIVE o AS (
  SELECT rec_id, j, {_STEP} AS inside FROM (SELECT rec_id, ltrim(payload, chr(65279)) AS j FROM paper_json)
  UNION ALL SELECT rec_id, j, {_STEP} AS inside FROM (SELECT rec_id, inside AS j FROM o WHERE inside IS NOT NULL)
), records AS (SELECT rec_id, j::JSON AS j FROM o WHERE inside IS NULL AND json_valid(j) AND json_type(j) IN ('OBJECT', 'ARRAY'))"""
SQL = {
    "p4_relationships": _OPEN + """, r AS (
  SELECT rec_id, unnest(range(json_array_length(j, '$.relationships')::BIGINT)) AS rel_no, unnest(json_extract(j, '$.relationships[*]')) AS r
  FROM records WHERE json_type(j, '$.relationships') = 'ARRAY')
SELECT rec_id, rel_no, json_extract_string(r, '$.subject_id') AS subject_id, json_extract_string(r, '$.predicate') AS predicate, json_extract_string(r, '$.object_id') AS object_id,
  try_cast(json_extract_string(r, '$.confidence') AS DOUBLE) AS confidence, json_extract_string(r, '$.section') AS section FROM r""",
    "p4_unreadable": _OPEN + " SELECT rec_id, length(payload) AS n_chars FROM paper_json WHERE rec_id NOT IN (SELECT rec_id FROM records)",
}
