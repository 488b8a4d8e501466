"""Cosine similarity of a query vector with every vector, as array expressions in the JVM."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _sum(x: Column) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda s, y: s + y)


def cosine(a: Column, b: Column) -> Column:
    """Cosine in double; null where either is null, has no length, or the lengths differ."""
    dot = _sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))
    norm = lambda v: F.sqrt(_sum(F.transform(v, lambda x: x.cast("double") * x.cast("double"))))
    return F.when(F.size(a) == F.size(b), F.try_divide(dot, norm(a) * norm(b)))


def nearest(vectors: DataFrame, query: list[float], k: int = 5, threshold: float | None = 0.85, key: str = "id") -> DataFrame:
    """(key, similarity): the k most similar to a vector, at least ``threshold``; equal ones by key. NaN takes no part."""
    scored = vectors.select(key, cosine(F.col("embedding"), F.array(*[F.lit(float(x)) for x in query])).alias("similarity"))
    fine = scored.where(F.col("similarity").isNotNull() & ~F.isnan("similarity"))
    if threshold is not None:
        fine = fine.where(F.col("similarity") >= threshold)
    return fine.orderBy(F.desc("similarity"), key).limit(k)


def nearest_to(vectors: DataFrame, value: object, k: int = 5, key: str = "id") -> DataFrame:
    """(key, similarity): the k most similar to the vector of a row, without the row; none for an unknown key.

    The one vector asked for passes the driver and becomes a literal of the scan: nothing is joined."""
    own = vectors.where(F.col(key) == value).select("embedding").first()
    if own is None or own["embedding"] is None:
        return vectors.select(key, F.lit(0.0).alias("similarity")).limit(0)
    return nearest(vectors.where(F.col(key) != value), own["embedding"], k, None, key)


def preview(text: Column, width: int = 100) -> Column:
    return F.when(F.length(text) > width, F.concat(F.substring(text, 1, width), F.lit("..."))).otherwise(text)


def triple_vectors(triples: DataFrame, vectors: DataFrame) -> DataFrame:
    """(subject_id, object_id, embedding): the unit vectors of both ends one after the other, of triples whose ends have
    a stored vector (``vectors`` is (id, embedding), one a key). Cosines of these are means of the cosines of the ends."""
    norm = F.sqrt(_sum(F.transform("embedding", lambda x: x.cast("double") * x.cast("double"))))
    unit = vectors.withColumn("n", norm).where("n > 0 AND NOT isnan(n)").select("id", F.transform("embedding", lambda x: x.cast("double") / F.col("n")).alias("v"))
    ends = triples.select("subject_id", "object_id").distinct()
    one = ends.join(unit.select(F.col("id").alias("subject_id"), F.col("v").alias("vs")), "subject_id")
    return one.join(unit.select(F.col("id").alias("object_id"), F.col("v").alias("vo")), "object_id").select("subject_id", "object_id", F.concat("vs", "vo").alias("embedding"))


def text_search(texts: DataFrame, query: str, k: int = 10, threshold: float = 0.0) -> DataFrame:
    """(id, similarity): texts by the cosine of TF-IDF with a question, at least ``threshold``; equal ones by id.

    Words are runs of letters and digits in lower case; a word counts how often it comes times log(1 + texts / texts
    that have it). Texts are (id, text), one row a key; null texts take no part. Only the question's words are a broadcast."""
    words = F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    tokens = texts.where("text IS NOT NULL").select("id", F.explode(words).alias("word")).groupBy("id", "word").agg(F.count("*").alias("tf"))
    total = texts.where("text IS NOT NULL").count()
    idf = tokens.groupBy("word").agg(F.log(F.lit(1.0) + F.lit(total) / F.count("*")).alias("idf"))
    asked = texts.sparkSession.createDataFrame([(w, float(n)) for w, n in sorted(Counter(re.findall(r"[^\W_]+", query.lower())).items())], "word string, asked double")
    mine = asked.join(idf, "word", "left").withColumn("w", F.col("asked") * F.coalesce("idf", F.log(F.lit(1.0 + total))))
    length = mine.agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("n")).first()["n"]
    weighed = tokens.join(idf, "word").withColumn("x", F.col("tf") * F.col("idf")).join(F.broadcast(mine.select("word", "w")), "word", "left")
    scored = weighed.groupBy("id").agg((F.sum(F.col("x") * F.coalesce("w", F.lit(0.0))) / (F.sqrt(F.sum(F.col("x") * F.col("x"))) * F.lit(length))).alias("similarity"))
    return scored.where((F.col("similarity") > 0) & (F.col("similarity") >= threshold)).orderBy(F.desc("similarity"), "id").limit(k)


def hybrid(vectors: DataFrame, query: list[float], structure: DataFrame, k: int = 10, share: float = 0.7) -> DataFrame:
    """(id, similarity, structural, score): all rows ranked by share * cosine + (1 - share) * structural score.

    ``structure`` is (id, structural) in 0..1; a row without one has 0. Equal scores rank by id."""
    scored = nearest_all(vectors, query)
    both = scored.join(structure, "id", "left").withColumn("structural", F.coalesce("structural", F.lit(0.0)))
    return both.withColumn("score", F.lit(share) * F.col("similarity") + F.lit(1 - share) * F.col("structural")).orderBy(F.desc("score"), "id").limit(k)


def nearest_all(vectors: DataFrame, query: list[float]) -> DataFrame:
    """(id, similarity) of every row that has one."""
    scored = vectors.select("id", cosine(F.col("embedding"), F.array(*[F.lit(float(x)) for x in query])).alias("similarity"))
    return scored.where(F.col("similarity").isNotNull() & ~F.isnan("similarity"))
