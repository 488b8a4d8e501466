"""Counts and summaries of the graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The documented weights of study types.
STUDY_WEIGHTS = {"rct": 1.0, "meta_analysis": 0.95, "cohort": 0.8, "case_control": 0.7, "observational": 0.6, "review": 0.5, "case_report": 0.4}


def counts(df: DataFrame, by: str, ordered: bool = False) -> DataFrame:
    """(by, n), most frequent first if ordered."""
    grouped = df.groupBy(by).agg(F.count("*").alias("n"))
    return grouped.orderBy(F.desc("n"), by) if ordered else grouped


def ends(relationships: DataFrame) -> DataFrame:
    """(entity_id) of every end of every triple."""
    return relationships.select(F.explode(F.array("subject_id", "object_id")).alias("entity_id"))


def graph_statistics(papers: DataFrame, entities: DataFrame, relationships: DataFrame, evidence: DataFrame) -> DataFrame:
    """One row with the totals and the counts by type and predicate as maps in order of their keys.

    Each table is read once; what meets are single rows of totals."""
    def tallied(df: DataFrame, by: str, name: str, *more: Column) -> DataFrame:
        by_key = df.groupBy(by).agg(F.count("*").alias("n"))
        return by_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias(f"total_{name}"), F.map_from_entries(F.array_sort(F.collect_list(F.struct(by, "n")))).alias(f"{name}_by"))

    one = F.lit(1).alias("_one")
    rows = [
        papers.agg(F.count("*").alias("total_papers")).select("*", one),
        tallied(entities, "entity_type", "entities").select("*", one),
        tallied(relationships.where("predicate IS NOT NULL"), "predicate", "relationships").select("*", one),
        evidence.agg(F.count("*").alias("total_evidence"), F.count_distinct("paper_id").alias("papers_with_relationships")).select("*", one),
        ends(relationships).agg(F.count_distinct("entity_id").alias("entities_in_relationships")).select("*", one),
    ]
    out = rows[0]
    for r in rows[1:]:
        out = out.join(r, "_one")
    return out.drop("_one").withColumn("papers_with_entities", F.when(F.col("total_entities") > 0, F.col("total_papers")).otherwise(F.lit(0)))


def quantiles(values: DataFrame, at: list[float], bins: int = 10_000) -> dict[float, float | None]:
    """Exact quantiles of the column ``x`` with linear interpolation, for numbers without null and NaN; None of nothing.

    Counts by equal bins say which bins hold the wanted places; only their values are counted one by one, so a task
    has the different values of one bin at most. Equal values meet as partial counts."""
    totals = values.agg(F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).first()
    n, lo, hi = totals["n"], totals["lo"], totals["hi"]
    if not n:
        return {q: None for q in at}
    if lo == hi:
        return {q: lo for q in at}
    places = sorted({p for q in at for p in (int(q * (n - 1)), min(int(q * (n - 1)) + 1, n - 1))})
    binned = values.select("x", F.least(F.floor((F.col("x") - lo) / (hi - lo) * bins), F.lit(bins - 1)).alias("bin"))
    # one row for each bin, at most ``bins``
    counts = sorted((r["bin"], r["k"]) for r in binned.groupBy("bin").agg(F.count("*").alias("k")).collect())
    wanted, before = [], 0
    for b, k in counts:
        if any(before <= p < before + k for p in places):
            wanted.append((int(b), before))
        before += k
    held = binned.where(F.col("bin").isin([b for b, _ in wanted])).groupBy("bin", "x").agg(F.count("*").alias("k"))
    start = F.element_at(F.create_map(*[F.lit(v) for bn in wanted for v in bn]), F.col("bin").cast("int"))
    upto = start + F.sum("k").over(Window.partitionBy("bin").orderBy("x"))
    hits = F.filter(F.array(*[F.lit(p) for p in places]), lambda p: (p >= F.col("upto") - F.col("k")) & (p < F.col("upto")))
    found = {r["p"]: r["x"] for r in held.withColumn("upto", upto).select("x", F.explode(hits).alias("p")).collect()}
    out = {}
    for q in at:
        low = int(q * (n - 1))
        out[q] = found[low] + (found[min(low + 1, n - 1)] - found[low]) * (q * (n - 1) - low)
    return out


def describe(df: DataFrame, column: str) -> DataFrame:
    """count, mean, std, min, quartiles by linear interpolation, and max; nulls and NaN take no part."""
    c = F.col(column)
    rows = df.where(c.isNotNull() & ~F.isnan(c)).select(c.cast("double").alias("x"))
    quartiles = quantiles(rows, [0.25, 0.5, 0.75])
    return rows.agg(
        F.count("*").alias("n"), F.round(F.avg("x"), 6).alias("mean"), F.round(F.stddev_samp("x"), 6).alias("std"), F.min("x").alias("min"),
        *[F.lit(None if v is None else round(v, 6)).cast("double").alias(f"p{int(q * 100)}") for q, v in quartiles.items()], F.max("x").alias("max"),
    )


def confidence_buckets(df: DataFrame) -> DataFrame:
    c = F.col("confidence")
    return df.agg(F.count_if(c >= 0.8).alias("high"), F.count_if((c >= 0.6) & (c < 0.8)).alias("medium"), F.count_if(c < 0.6).alias("low"))


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """(bin, n) over equal bins between the least and the greatest value, which falls in the last; nulls and NaN
    take no part. The bounds are one row, found in a pass of their own."""
    c = F.col(column)
    rows = df.where(c.isNotNull() & ~F.isnan(c)).select(c.alias("x"))
    bounds = rows.agg(F.min("x").alias("lo"), F.max("x").alias("hi")).first()
    if bounds["lo"] is None:
        return rows.select(F.lit(0).cast("long").alias("bin"), F.lit(0).cast("long").alias("n")).limit(0)
    width = (bounds["hi"] - bounds["lo"]) or 1.0
    bin_ = F.least(F.floor((F.col("x") - bounds["lo"]) / width * bins), F.lit(bins - 1)).cast("long")
    return rows.groupBy(bin_.alias("bin")).agg(F.count("*").alias("n"))


def evidence_by_triple(evidence: DataFrame) -> DataFrame:
    """Evidence of each triple over all papers, weighted by study type: sum of weight * confidence over weights."""
    weight = F.coalesce(F.create_map(*[F.lit(x) for kv in STUDY_WEIGHTS.items() for x in kv])[F.col("study_type")], F.lit(0.5))
    weighed = evidence.withColumn("w", weight)
    return weighed.groupBy("subject_id", "predicate", "object_id").agg(
        F.count("*").alias("n_items"), F.count_distinct("paper_id").alias("n_papers"), F.round(F.sum(F.col("w") * F.col("confidence")) / F.sum("w"), 6).alias("weighted_confidence"), F.max("sample_size").alias("largest_sample")
    )


def mention_rollup(mentions: DataFrame) -> DataFrame:
    """Per entity: mentions, the different ways it is written, and the papers that hold it."""
    return mentions.groupBy("entity_id").agg(F.count("*").alias("mention_count"), F.array_sort(F.collect_set("surface")).alias("surface_forms"), F.count_distinct("paper_id").alias("n_papers"))


def differential(relationships: DataFrame, symptoms: list[str], min_match: int) -> DataFrame:
    """Diseases by the number of given symptoms they cause, then by mean confidence."""
    hits = relationships.where((F.col("predicate") == "causes") & F.col("object_id").isin(symptoms))
    return hits.groupBy(F.col("subject_id").alias("disease")).agg(F.count_distinct("object_id").alias("n_match"), F.round(F.avg("confidence"), 6).alias("mean_confidence")).where(F.col("n_match") >= min_match)


def promotable(mentions: DataFrame, with_vector: DataFrame, min_usage: int = 2, min_confidence: float = 0.75) -> DataFrame:
    """Entities used in enough papers with enough confidence that have a vector."""
    used = mentions.groupBy("entity_id").agg(F.count_distinct("paper_id").alias("usage"), F.round(F.max("confidence"), 6).alias("best_confidence"))
    return used.where((F.col("usage") >= min_usage) & (F.col("best_confidence") >= min_confidence)).join(with_vector.select("entity_id").distinct(), "entity_id", "left_semi")


def running_counts(df: DataFrame, by: str, date: str) -> DataFrame:
    """(by, date, n, running): counts a date and their running total; dates are counted before they are summed."""
    daily = df.groupBy(by, date).agg(F.count("*").alias("n"))
    return daily.withColumn("running", F.sum("n").over(Window.partitionBy(by).orderBy(date).rowsBetween(Window.unboundedPreceding, 0)))


def rollup_counts(df: DataFrame, *by: str) -> DataFrame:
    return df.rollup(*by).agg(F.count("*").alias("n"))


def cube_counts(df: DataFrame, *by: str) -> DataFrame:
    return df.cube(*by).agg(F.count("*").alias("n"))
