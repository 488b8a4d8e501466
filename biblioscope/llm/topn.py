"""The N highest-scoring rows of every group, with a fixed order among ties.

Per-group score histograms give, for each group, the highest bin at or above which at least N rows stand.
Rows below that bin cannot be among the first N and are filtered out; the few left are ranked exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BINS = 1024
#: Groups of more rows than a limit are filtered before the shuffle, by thresholds that are broadcast. The limit is
#: a thousandth of all rows, at most HOT_ROWS, so that no other group is long; there are never more than MOST_HOT such
#: groups, as it is also at least 1/MOST_HOT of all rows.
HOT_SHARE, HOT_ROWS, MOST_HOT = 1000, 1_000_000, 200_000


def clean_id(col: Column) -> Column:
    """Without surrounding white space, in upper case; null where nothing is left."""
    bare = F.upper(F.regexp_replace(col, r"(?U)^\s+|\s+$", ""))
    return F.when(bare != "", bare)


def latest(df: DataFrame, key: str, time: str, columns: list[str]) -> DataFrame:
    """Of rows with the same ``key`` the one with the latest ``time`` (null counts as earliest; of equal
    times the greatest values, which is the same row where repeats are equal). Rows without a key are dropped.
    Partial maxima are built before the shuffle, so a key that is repeated often is no hot spot."""
    best = F.max(F.struct(F.col(time).alias("_t"), *[F.col(c) for c in columns]))
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(best.alias("_b")).select(key, *[F.col(f"_b.{c}").alias(c) for c in columns])


def top_n(df: DataFrame, group: str, score: str, tie: str, n: int, *, lo: float = 0.0, hi: float = 1.0, more_than: int = 0, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(group, rank_no, tie, score): the first ``n`` rows of each group by score descending, then tie ascending.

    Rows with a null group, a null or NaN score, or a score outside [lo, hi] take no part; -0.0 equals 0.
    Groups with at most ``more_than`` such rows give nothing. Rows equal in group, score and tie are all kept
    and rank next to each other. Other columns of ``df`` are ignored. An empty input gives an empty result.
    """
    value = F.col(score).cast("double")
    rows = (
        df.where(F.col(group).isNotNull() & value.isNotNull() & ~F.isnan(value) & (value >= lo) & (value <= hi))
        .select(F.col(group).alias("g"), (value + F.lit(0.0)).alias("s"), F.col(tie).alias("t"))
        .withColumn("bin", F.least(F.floor((F.col("s") - lo) / (hi - lo) * BINS), F.lit(BINS - 1)).cast("int"))
    )
    # a bin's rows meet as partial counts; no group is larger than BINS rows from here on
    histogram = rows.groupBy("g", "bin").agg(F.count("*").alias("k"))
    from_top = Window.partitionBy("g").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    summed = histogram.withColumn("above", F.sum("k").over(from_top))
    # the last bin reached before N rows are gathered is the one that holds the N-th
    bounds = summed.groupBy("g").agg(
        F.max(F.when(F.col("above") >= n, F.col("bin"))).alias("threshold"), F.sum("k").alias("total")
    ).where(F.col("total") > more_than).select("g", F.coalesce("threshold", F.lit(0)).alias("threshold"), "total")
    grand = rows.agg(F.count("*").alias("all")).first()["all"]
    limit = max(n, grand // MOST_HOT, min(grand // HOT_SHARE, hot_rows))
    hot = bounds.where(F.col("total") > limit).select("g", F.col("threshold").alias("hot_threshold"))
    marked = rows.join(F.broadcast(hot), "g", "left")
    # A hot group's rows leave by their broadcast threshold before any shuffle. Those that tie at it pass a
    # partial group limit on each map task, so none of its tasks gets more than N rows from a map task.
    order = Window.partitionBy("g").orderBy(F.desc("s"), F.asc("t"))
    from_hot = marked.where(F.col("bin") >= F.col("hot_threshold")).select("g", "s", "t").withColumn("rank_no", F.row_number().over(order)).where(F.col("rank_no") <= n)
    cold = bounds.where(F.col("total") <= limit)
    from_cold = (
        marked.where(F.col("hot_threshold").isNull())
        .select("g", "s", "t", "bin")
        .join(cold, "g")
        .where(F.col("bin") >= F.col("threshold"))
        .select("g", "s", "t")
        .withColumn("rank_no", F.row_number().over(order))
        .where(F.col("rank_no") <= n)
    )
    return from_hot.unionByName(from_cold).select(F.col("g").alias(group), F.col("rank_no").cast("long").alias("rank_no"), F.col("t").alias(tie), F.col("s").alias(score))


def top_edges(edges: DataFrame, n: int = 5) -> DataFrame:
    """(subject_id, rank_no, edge_id) of every subject with more than ``n`` valid edges."""
    flat = edges.select("id", F.col("subject.id").alias("sid"), "confidence", "extracted_at")
    valid = latest(flat, "id", "extracted_at", ["sid", "confidence"]).withColumn("subject_id", clean_id(F.col("sid")))
    ranked = top_n(valid, "subject_id", "confidence", "id", n, more_than=n)
    return ranked.select("subject_id", "rank_no", F.col("id").alias("edge_id"))
