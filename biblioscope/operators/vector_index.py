"""Approximate search for query vectors: an index of cells around learned centres (inverted lists).

The centres are fitted on a bounded sample; every row is put in the cell of its nearest centre. A query looks into
the cells of its ``probes`` nearest centres. Cells are the join key, so Spark parts the index and the work.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows that the centres are fitted on, about: those with a low hash of their key. The index holds every row.
FIT_ROWS = 20_000
#: Rows of a part of a cell that one task multiplies with the queries that look into it.
PART_ROWS = 20_000


def usable(vectors: DataFrame, dim: int) -> DataFrame:
    """(id, embedding) with a key and ``dim`` finite numbers that are not all zero; of rows with one key one counts."""
    v = F.col("embedding").cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
    kept = vectors.where(F.col("id").isNotNull() & (F.size("embedding") == dim) & F.coalesce(fine, F.lit(False)))
    return kept.groupBy("id").agg(F.max(F.col("embedding").cast("array<float>")).alias("embedding"))


def _unit(vectors: pd.Series) -> np.ndarray:
    x = np.stack(vectors.to_numpy()).astype(np.float32)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit_centres(vectors: DataFrame, cells: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """``cells`` unit vectors (fewer for fewer rows) by spherical k-means over the sample; ``vectors`` has different keys."""
    n = vectors.count()
    low = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < math.ceil(FIT_ROWS / max(n, 1) * (1 << 30))
    sample = vectors.where(low).toPandas().sort_values("id")
    if not len(sample):
        return np.empty((0, 0), np.float32)
    x = _unit(sample["embedding"])
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(cells, len(x)), replace=False)]
    for _ in range(rounds):
        nearest = (x @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, x)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 0, sums / np.maximum(norms, 1e-12), centres)
    return centres


def with_cells(vectors: DataFrame, centres: np.ndarray, n: int = 1) -> DataFrame:
    """Adds ``cells``: the ``n`` nearest centres, the nearest first."""

    @F.pandas_udf("array<int>")
    def nearest(v: pd.Series) -> pd.Series:
        if not len(v):
            return pd.Series([], dtype=object)
        return pd.Series(list(np.argsort(-(_unit(v) @ centres.T), axis=1, kind="stable")[:, :n].astype(np.int32)))

    return vectors.withColumn("cells", nearest("embedding"))


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, *, dim: int = 64, cells: int = 64, probes: int = 16, threshold: float | None = None) -> DataFrame:
    """(query_id, id, similarity): about the k nearest of ``vectors`` for each query, itself (by key) left out.

    Both sides are (id, embedding); what is not usable takes no part. Equal similarities rank by id. With ``probes``
    equal to ``cells`` every row is compared and the result is exact. Empty sides give an empty result."""
    every = usable(vectors, dim)
    centres = fit_centres(every, cells)
    out = "query_id {0}, id {1}, similarity double".format(queries.schema["id"].dataType.simpleString(), vectors.schema["id"].dataType.simpleString())
    if not len(centres):
        return vectors.sparkSession.createDataFrame([], out)
    parts = max(1, math.ceil(every.count() / (len(centres) * PART_ROWS)))
    # both sides may come from one table: their columns are named anew, or the two could not be told apart
    indexed = with_cells(every, centres).select(F.col("id").alias("id"), F.col("embedding").alias("embedding"), F.get("cells", F.lit(0)).alias("cell"), F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias("part"))
    asking = with_cells(usable(queries, dim), centres, min(probes, len(centres)))
    asked = asking.select(F.col("id").alias("id"), F.col("embedding").alias("embedding"), F.explode("cells").alias("cell")).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

    def best(q: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        found: list[pd.DataFrame] = []
        if len(q) and len(rows):
            rows = rows.sort_values("id", ignore_index=True)
            x, ids = _unit(rows["embedding"]).astype(np.float64), rows["id"].to_numpy()
            for at in range(0, len(q), 256):
                some = q.iloc[at : at + 256]
                s = np.clip(_unit(some["embedding"]).astype(np.float64) @ x.T, -1.0, 1.0)
                s[some["id"].to_numpy()[:, None] == ids[None, :]] = -2.0
                top = np.argsort(-s, axis=1, kind="stable")[:, :k]
                value = np.take_along_axis(s, top, 1)
                keep = value >= (-1.0 if threshold is None else threshold)
                found.append(pd.DataFrame({"query_id": np.repeat(some["id"].to_numpy(), keep.sum(1)), "id": ids[top[keep]], "similarity": value[keep]}))
        return pd.concat(found) if found else pd.DataFrame({"query_id": [], "id": [], "similarity": []})

    near = asked.groupBy("cell", "part").cogroup(indexed.groupBy("cell", "part")).applyInPandas(best, out)
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("similarity"), "id"))
    return near.withColumn("place", place).where(F.col("place") <= k).drop("place")


def resolve_names(mentions: DataFrame, names: DataFrame, vectors: DataFrame, threshold: float = 0.85, **how) -> DataFrame:
    """(id, entity_id, by, similarity): what each mention denotes, by its name, else by the nearest vector.

    ``mentions`` is (id, name, embedding), ``names`` (key, entity_id) in lower case, ``vectors`` (id, embedding) of
    entities. A key that several entities share means the least. A mention that neither way finds has a null entity and 'none'."""
    key = F.lower(F.trim("name"))
    one = names.groupBy("key").agg(F.min("entity_id").alias("by_name"))
    met = mentions.withColumn("key", key).join(one, "key", "left")
    open_ = met.where("by_name IS NULL").select("id", "embedding")
    near = search(vectors, open_, 1, threshold=threshold, **how).select(F.col("query_id").alias("id"), F.col("id").alias("by_vector"), "similarity")
    both = met.select("id", "by_name").join(near, "id", "left")
    by = F.when(F.col("by_name").isNotNull(), "name").when(F.col("by_vector").isNotNull(), "vector").otherwise("none")
    return both.select("id", F.coalesce("by_name", "by_vector").alias("entity_id"), by.alias("by"), "similarity")
