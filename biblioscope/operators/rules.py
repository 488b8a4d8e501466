"""Validation of entities, triples and edges, and upserts by key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Predicates between entity types; other pairs of different types may be associated.
TYPE_RULES = [
    (("drug",), ("disease",), ["treats", "prevents", "manages", "contraindicated_for"]),
    (("disease",), ("symptom",), ["causes"]),
    (("drug",), ("symptom",), ["side_effect"]),
    (("gene",), ("disease",), ["increases_risk", "decreases_risk", "associated_with"]),
    (("gene",), ("protein",), ["encodes"]),
    (("drug",), ("drug",), ["interacts_with"]),
    (("disease",), ("procedure", "biomarker"), ["diagnosed_by"]),
    (("gene", "protein"), ("pathway",), ["participates_in"]),
]
#: The registered predicates and entity types.
PREDICATES = [
    "treats", "causes", "increases_risk", "decreases_risk", "associated_with", "interacts_with", "diagnosed_by",
    "side_effect", "encodes", "participates_in", "contraindicated_for", "prevents", "manages", "binds_to", "inhibits",
    "activates", "upregulates", "downregulates", "metabolizes", "diagnoses", "indicates", "precedes",
    "co_occurs_with", "located_in", "affects", "supports", "cites", "studied_in", "authored_by", "part_of",
    "predicts", "refutes", "tested_by", "generates",
]
ENTITY_TYPES = ["disease", "gene", "drug", "protein", "symptom", "procedure", "biomarker", "pathway"]


def valid_predicates(subject_type: Column, object_type: Column) -> Column:
    """The predicates that may stand between two types; an empty array for a pair of one type without a rule."""
    listed = lambda xs: F.array(*[F.lit(x) for x in xs])
    rules = reduce(lambda w, r: w.when(subject_type.isin(*r[0]) & object_type.isin(*r[1]), listed(r[2])), TYPE_RULES, F.when(F.lit(False), listed([""])))
    return rules.when(subject_type != object_type, listed(["associated_with"])).otherwise(F.array().cast("array<string>"))


def checked_relationships(relationships: DataFrame) -> DataFrame:
    """Adds ``faults``: the names of the constraints each triple breaks."""
    c = F.col("confidence")
    tests = {
        "predicate": ~F.coalesce(F.col("predicate").isin(PREDICATES), F.lit(False)),
        "confidence": c.isNull() | F.isnan(c) | (c < 0) | (c > 1),
        "subject": F.coalesce(F.trim("subject_id") == "", F.lit(True)),
        "object": F.coalesce(F.trim("object_id") == "", F.lit(True)),
        "self": F.coalesce(F.col("subject_id") == F.col("object_id"), F.lit(False)),
    }
    return relationships.withColumn("faults", F.filter(F.array(*[F.when(t, F.lit(n)) for n, t in tests.items()]), lambda x: x.isNotNull()))


def checked_entities(entities: DataFrame) -> DataFrame:
    """Adds ``valid``: a registered type, and an id that is neither blank nor provisional for canonical ones."""
    return entities.withColumn("valid", F.coalesce(F.col("type").isin(ENTITY_TYPES) & (F.trim("entity_id") != "") & ~F.startswith("entity_id", F.lit("prov:")), F.lit(False)))


def edge_contract(edges: DataFrame) -> DataFrame:
    """One row: how many edges break each part of the contract between stages."""
    typed = lambda e: F.coalesce(F.col(f"{e}.type").isin(ENTITY_TYPES), F.lit(False))
    with_colon = lambda e: F.coalesce(F.contains(F.col(f"{e}.id"), F.lit(":")), F.lit(False))
    c = F.col("confidence")
    faults = {
        "missing_id": F.col("subject.id").isNull() | F.col("object.id").isNull(),
        "bad_type": ~typed("subject") | ~typed("object"),
        "no_prefix": ~with_colon("subject") | ~with_colon("object"),
        "bad_confidence": c.isNull() | F.isnan(c) | (c < 0) | (c > 1),
    }
    by_id = edges.groupBy("id").agg(F.count("*").alias("n"), *[F.count_if(t).alias(k) for k, t in faults.items()])
    total = lambda k: F.coalesce(F.sum(k), F.lit(0)).cast("long")
    return by_id.agg(total("n").alias("n_edges"), *[total(k).alias(k) for k in faults], F.count_if(F.col("n") > 1).alias("repeated_ids"))


def upsert(current: DataFrame, changes: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Of the rows with a key the last by ``order``: a change replaces all columns of what it changes.

    Partial maxima are taken before the shuffle; ``order`` has to tell a key's rows apart."""
    every = current.unionByName(changes)
    rest = [c for c in every.columns if c not in keys]
    last = every.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_r"))
    return last.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*every.columns)


def merged(assertions: DataFrame) -> DataFrame:
    """Triples with all their papers, the best confidence and how many assertions they rest on."""
    return assertions.groupBy("subject_id", "predicate", "object_id").agg(F.max("confidence").alias("confidence"), F.array_sort(F.collect_set("paper_id")).alias("source_papers"), F.count("*").alias("evidence_count"))
