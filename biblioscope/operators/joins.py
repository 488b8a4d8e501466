"""Joins over the graph: treatments, neighbours, co-occurrence, hops, audits and checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from biblioscope.operators.blocks import in_blocks
from biblioscope.operators.lookup import name_search
from biblioscope.session import cut

TRIPLE = ["subject_id", "predicate", "object_id"]


def find_treatments(entities: DataFrame, relationships: DataFrame, evidence: DataFrame, disease: str, limit: int = 10, most_diseases: int = 5) -> DataFrame:
    """Drugs that treat the diseases with a name, with the evidence each triple has.

    At most ``most_diseases`` diseases by id, ``limit`` triples of each by confidence, and ``limit`` rows in all.
    """
    diseases = name_search(entities, disease, "disease", most_diseases).select(F.col("entity_id").alias("object_id"), F.col("name").alias("disease"))
    treats = relationships.where(F.col("predicate") == "treats").join(diseases, "object_id")
    drugs = entities.where(F.col("entity_type") == "drug").select(F.col("entity_id").alias("subject_id"), F.col("name").alias("drug"))
    place = F.row_number().over(Window.partitionBy("object_id").orderBy(F.desc("confidence"), "subject_id"))
    capped = treats.join(drugs, "subject_id").withColumn("place", place).where(F.col("place") <= limit).drop("place")
    items = evidence.join(capped.select(*TRIPLE), TRIPLE, "left_semi").groupBy(*TRIPLE).agg(F.count("*").alias("n_items"))
    joined = capped.join(items, TRIPLE, "left")
    return joined.select("drug", "disease", "subject_id", "object_id", "confidence", F.coalesce("n_items", F.lit(0)).cast("long").alias("evidence_count")).orderBy(F.desc("confidence"), "object_id", "subject_id").limit(limit)


def related(entities: DataFrame, relationships: DataFrame, name: str, other_type: str) -> DataFrame:
    """(entity_id, predicate, other_id, confidence): neighbours of one type on either end of any triple."""
    start = name_search(entities, name).select("entity_id")
    ends = entities.where(F.col("entity_type") == other_type).select(F.col("entity_id").alias("other_id"))
    out = relationships.select(F.col("subject_id").alias("entity_id"), "predicate", F.col("object_id").alias("other_id"), "confidence")
    into = relationships.select(F.col("object_id").alias("entity_id"), "predicate", F.col("subject_id").alias("other_id"), "confidence")
    return out.unionByName(into).where("predicate IS NOT NULL").join(start, "entity_id", "left_semi").join(ends, "other_id", "left_semi").select("entity_id", "predicate", "other_id", "confidence")


def co_occurrence(mentions: DataFrame, least: float = 0.9, block: int = 1000) -> DataFrame:
    """(paper_id, a, b, confidence) of two different entities in one paper, in order of their places.

    An edge's confidence is the lesser of two, so mentions below the bound are left out before they meet. A
    mention is joined only to those after it in its paper. The mentions of a paper with more than ``block`` meet in blocks
    of about so many, so such a paper is many tasks' work; the rows of the result still grow with the square.
    """
    sure = mentions.where(F.col("confidence") >= least).select("paper_id", "entity_id", "pos", "confidence")
    long = sure.groupBy("paper_id").agg(F.count("*").alias("n")).where(F.col("n") > block)
    left, right = in_blocks(sure.join(long, "paper_id", "left"), "pos", block)
    a = left.select("paper_id", "x", "y", F.col("entity_id").alias("a"), F.col("pos").alias("pa"), F.col("confidence").alias("ca"))
    b = right.select("paper_id", "x", "y", F.col("entity_id").alias("b"), F.col("pos").alias("pb"), F.col("confidence").alias("cb"))
    met = a.join(b, ["paper_id", "x", "y"]).where((F.col("pa") < F.col("pb")) & (F.col("a") != F.col("b")))
    return met.select("paper_id", "a", "b", F.least("ca", "cb").alias("confidence"))


def since(relationships: DataFrame, papers: DataFrame, date: str) -> DataFrame:
    """Triples with a paper published on or after a date, one row for each such paper."""
    recent = papers.where(F.col("publication_date") >= date).select("paper_id", "publication_date")
    return relationships.select(*TRIPLE, F.explode("source_papers").alias("paper_id")).join(recent, "paper_id")


def two_hops(relationships: DataFrame, first: str, second: str) -> DataFrame:
    """(start, middle, end) of triples with one predicate that lead to triples with another."""
    a = relationships.where(F.col("predicate") == first).select(F.col("subject_id").alias("start"), F.col("object_id").alias("middle"))
    b = relationships.where(F.col("predicate") == second).select(F.col("subject_id").alias("middle"), F.col("object_id").alias("end"))
    return a.join(b, "middle").select("start", "middle", "end")


def traverse(relationships: DataFrame, entities: DataFrame, start: str, steps: list[str]) -> DataFrame:
    """(path, end): paths from an entity along given steps, 'PREDICATE' or 'PREDICATE:type', one join a step."""
    at = relationships.sparkSession.createDataFrame([(start, [start])], "end string, path array<string>")
    for step in steps:
        predicate, _, kind = step.lower().partition(":")
        edges = relationships.where(F.col("predicate") == predicate).select(F.col("subject_id").alias("end"), F.col("object_id").alias("next"))
        at = edges.join(at, "end").where(~F.array_contains("path", F.col("next"))).select(F.col("next").alias("end"), F.concat("path", F.array("next")).alias("path"))
        if kind:
            at = at.join(entities.where(F.col("entity_type") == kind).select(F.col("entity_id").alias("end")), "end", "left_semi")
    return at.select("path", "end")


def reachable(relationships: DataFrame, start: str, most_hops: int) -> DataFrame:
    """(path, end, hops): every path without a cycle from an entity, up to a number of hops; one join a hop."""
    edges = cut(relationships.where("predicate IS NOT NULL").select(F.col("subject_id").alias("end"), F.col("object_id").alias("next")).distinct())
    at = relationships.sparkSession.createDataFrame([(start, [start])], "end string, path array<string>")
    found = None
    for hop in range(1, most_hops + 1):
        at = edges.join(at, "end").where(~F.array_contains("path", F.col("next"))).select(F.col("next").alias("end"), F.concat("path", F.array("next")).alias("path"))
        if hop < most_hops:
            at = cut(at)
        rows = at.select("path", "end", F.lit(hop).alias("hops"))
        found = rows if found is None else found.unionByName(rows)
    return found


def resolved_only(relationships: DataFrame, entities: DataFrame) -> DataFrame:
    """Triples both of whose ends are entities."""
    ids = entities.select("entity_id").distinct()
    return relationships.join(ids, F.col("subject_id") == F.col("entity_id"), "left_semi").join(ids, F.col("object_id") == F.col("entity_id"), "left_semi")


def orphans(ends: DataFrame, entities: DataFrame) -> DataFrame:
    """Rows of ``ends`` whose entity_id is no entity."""
    return ends.join(entities.select("entity_id").distinct(), "entity_id", "left_anti")


def name_lookup(names: DataFrame, index: DataFrame) -> DataFrame:
    """Every name with the entity it means: by key in lower case, the greatest id where keys are shared."""
    one = index.groupBy("key").agg(F.max("entity_id").alias("entity_id"))
    return names.join(one, F.lower("name") == F.col("key"), "left").drop("key")


def contradictions(relationships: DataFrame, positive: str, negative: str) -> DataFrame:
    """Pairs that stand under both predicates, with the count and best confidence of each."""
    both = relationships.where(F.col("predicate").isin(positive, negative)).groupBy("subject_id", "object_id")
    mine = lambda p, c: F.max(F.when(F.col("predicate") == p, F.col(c)))
    return both.agg(
        mine(positive, "evidence_count").alias("n_for"), mine(negative, "evidence_count").alias("n_against"), mine(positive, "confidence").alias("confidence_for"), mine(negative, "confidence").alias("confidence_against")
    ).where("n_for IS NOT NULL AND n_against IS NOT NULL")


def audit(claims: DataFrame, evidence: DataFrame, edges: DataFrame) -> DataFrame:
    """Claims (paper_id, pos, triple) followed to their evidence and on to the extraction edges they rest on.

    ``evidence`` is (paper_id, pos, sample_size, p_value, confidence), of which a claim may have none. Edges belong to a claim by
    its paper and both ends; they are added up before they meet the claims, so a paper with many edges is few rows."""
    c = F.col("confidence")
    sure = F.when(~F.isnan(c) & c.between(0, 1), c)
    ends = [F.col("provenance.source_id").alias("paper_id"), F.col("subject.id").alias("subject_id"), F.col("object.id").alias("object_id")]
    by_ends = edges.groupBy(*ends).agg(F.count_distinct("id").alias("n_edges"), F.max(sure).alias("best_edge"))
    items = evidence.select("paper_id", "pos", "sample_size", "p_value", F.col("confidence").alias("strength"))
    traced = claims.join(items, ["paper_id", "pos"], "left").join(by_ends, ["paper_id", "subject_id", "object_id"], "left")
    return traced.withColumn("n_edges", F.coalesce("n_edges", F.lit(0)).cast("long"))


def repurposing(relationships: DataFrame) -> DataFrame:
    """(drug, disease, shared): drugs that bind what a disease is associated with, and do not treat it yet."""
    binds = relationships.where(F.col("predicate") == "binds_to").select(F.col("subject_id").alias("target"), F.col("object_id").alias("drug"))
    linked = relationships.where(F.col("predicate") == "associated_with").select(F.col("subject_id").alias("drug"), F.col("object_id").alias("disease"))
    treated = relationships.where(F.col("predicate") == "treats").select(F.col("subject_id").alias("drug"), F.col("object_id").alias("disease"))
    targets = binds.groupBy("drug").agg(F.count_distinct("target").alias("shared"))
    return linked.distinct().join(targets, "drug").join(treated, ["drug", "disease"], "left_anti")
