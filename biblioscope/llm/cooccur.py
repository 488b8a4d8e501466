"""Items that appear together in a record more often than chance.

Records are the rows of a binary sparse matrix X, items its columns; the counts of pairs are the off-diagonal entries
of the Gram matrix X'X. X is cut into blocks: records by their hash, and items into ranges where a record holds too many of
them for one block. A task gets the cells of one block of records in two ranges of items and multiplies the
transpose of the one block by the other; Spark adds up the products over the blocks of records, and counts are normalised by
what the marginals would make them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from biblioscope.llm.topn import clean_id
from biblioscope.session import cut

#: Items of a record that one block takes; the range of items is halved until no record has more in a part.
BLOCK_ITEMS = 4096
#: Cells (record, item) of a block.
BLOCK_CELLS = 200_000
#: Partial products that a task holds before it adds up equal ones.
PAIRS_AT_ONCE = 2_000_000
#: Items that hold at least 1/HOT_SHARE of all cells get their number by a broadcast; there are at most HOT_SHARE.
HOT_SHARE = 10_000


def baskets_of(edges: DataFrame) -> DataFrame:
    """(record, item) of each paper's edges: every different id once. Null and blank ids and sources give none."""
    record = F.col("provenance.source_id")
    items = F.array(clean_id(F.col("subject.id")), clean_id(F.col("object.id")))
    return edges.select(record.alias("record"), F.explode(items).alias("item")).where(F.col("record").isNotNull() & F.col("item").isNotNull()).distinct()


def _add_up(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different (a, b) and how often each comes: in a dense block where it is filled well, else by sorting."""
    ids_a, at_a = np.unique(a, return_inverse=True)
    ids_b, at_b = np.unique(b, return_inverse=True)
    size = len(ids_a) * len(ids_b)
    codes = at_a * len(ids_b) + at_b
    if size <= 4 * len(codes):
        counts = np.bincount(codes, minlength=size)
        codes = np.flatnonzero(counts)
        counts = counts[codes]
    else:
        codes, counts = np.unique(codes, return_counts=True)
    return ids_a[codes // len(ids_b)], ids_b[codes % len(ids_b)], counts


def block_product(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray] | None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """X'Y of two binary sparse blocks over the same records, as (item of X, item of Y, count) with partial counts.

    A block is (row, item) of its cells, sorted by both. Without ``right`` it is the upper part of X'X. The cells of
    the transpose are taken column by column, each with the row of Y it meets."""
    rows, items = left
    if right is None:
        start, end = np.arange(1, len(rows) + 1), np.searchsorted(rows, rows, side="right")
        others = items
    else:
        start, end = np.searchsorted(right[0], rows), np.searchsorted(right[0], rows, side="right")
        others = right[1]
    column = np.argsort(items, kind="stable")
    met = (end - start)[column]
    total = np.cumsum(met)
    at = 0
    while at < len(column):
        stop = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PAIRS_AT_ONCE, side="right")))
        cells, n = column[at:stop], met[at:stop]
        first = np.repeat(cells, n)
        second = np.repeat(start[cells], n) + np.arange(len(first)) - np.repeat(np.cumsum(n) - n, n)
        if len(first):
            yield _add_up(items[first], others[second])
        at = stop


def _product_of_task(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """The product of one block of records in the ranges of items ``key`` names."""
    parts, i, j = int(key[0]), int(key[1]), int(key[2])
    row = pd.factorize(pdf["record"])[0]
    item, part = pdf["item"].to_numpy(np.int64), pdf["part"].to_numpy(np.int64)
    order = np.lexsort((item, row))
    row, item, part = row[order], item[order], part[order]
    right = None if parts == 1 or i == j else (row[part == j], item[part == j])
    found = list(block_product((row[part == i], item[part == i]), right))
    if not found:
        return pd.DataFrame({"a": [], "b": [], "n": []}, dtype="int64")
    return pd.DataFrame({c: np.concatenate([f[k] for f in found]) for k, c in enumerate("abn")})


def gram(entries: DataFrame, n_items: int, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """(a, b, n), a < b: in how many records two items stand together. ``entries`` is (record, item), the items numbered from 0.

    A record of k items takes the range of items in the least number of parts (1, 2, 4, ...) of about ``block_items``
    of its own; each of its cells goes to every pair of parts with its own, so a record with one part is sent once.
    No record, however long, is gathered in one task."""
    spark = entries.sparkSession
    parts = F.greatest(F.lit(1), F.pow(F.lit(2), F.ceil(F.log2(F.col("k") / block_items)))).cast("int")
    sized = entries.groupBy("record").agg(F.count("*").alias("k")).withColumn("parts", parts)
    # one row for each power of two
    cells = {r["parts"]: r["cells"] for r in sized.groupBy("parts").agg(F.sum("k").alias("cells")).collect()}
    if not cells:
        return entries.select(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"), F.lit(0).cast("long").alias("n")).where(F.lit(False))
    if set(cells) == {1}:
        placed = entries.withColumn("parts", F.lit(1))
    else:
        placed = entries.join(sized.where("parts > 1").select("record", "parts"), "record", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    tasks = max(spark.sparkContext.defaultParallelism, 1)
    blocks = {p: max(tasks if p == 1 else 1, -(-2 * c // (p * BLOCK_CELLS))) for p, c in cells.items()}
    n_blocks = F.element_at(F.create_map(*[F.lit(int(x)) for kv in blocks.items() for x in kv]), F.col("parts"))
    part = F.floor(F.col("item") * F.col("parts") / F.lit(n_items)).cast("int")
    others = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    sent = placed.select("record", "item", "parts", part.alias("part"), others).select(
        "parts", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), F.pmod(F.xxhash64("record"), n_blocks).alias("block"), "record", "item", "part"
    )
    products = sent.groupBy("parts", "i", "j", "block").applyInPandas(_product_of_task, "a bigint, b bigint, n bigint")
    return products.groupBy("a", "b").agg(F.sum("n").alias("n"))


def _numbered(items: DataFrame) -> DataFrame:
    """Adds ``i``, counting 0, 1, ... without gaps: the place in the partition plus the sizes of those before it.

    Only one number for each partition passes the driver."""
    placed = cut(items.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    sizes = sorted(placed.groupBy(part.alias("p")).agg(F.count("*").alias("k")).collect())
    starts = np.concatenate([[0], np.cumsum([r["k"] for r in sizes])]).astype(int)
    offsets = placed.sparkSession.createDataFrame([(int(r["p"]), int(s)) for r, s in zip(sizes, starts)], "p bigint, start bigint")
    local = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.join(F.broadcast(offsets), part == F.col("p")).withColumn("i", F.col("start") + local).drop("_at", "p", "start")


def pairs_together(baskets: DataFrame, *, min_count: int = 6, min_lift: float = 5.0, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """(item_a, item_b, n_ab, n_a, n_b, lift) of pairs with n_ab >= min_count and n_ab * N >= min_lift * n_a * n_b.

    ``baskets`` has (record, item), in any number of repeats; rows with a null are dropped. item_a < item_b by
    code point. Two bounds prune items without losing a pair: n_ab <= min(n_a, n_b), hence both are at least
    min_count, and neither may exceed N / min_lift. So an item in a third of all records leaves before any
    product.
    """
    baskets = cut(baskets.select("record", "item").where(F.col("record").isNotNull() & F.col("item").isNotNull()).distinct())
    sums = baskets.agg(F.count_distinct("record").alias("records"), F.count("*").alias("cells")).first()
    total = sums["records"]
    counts = baskets.groupBy("item").agg(F.count("*").alias("n"))
    numbered = _numbered(counts.where((F.col("n") >= min_count) & (F.col("n") * min_lift <= total)))
    n_items = numbered.count()
    # Items in more than 1 / min_lift of the records leave first, and those that hold many cells get their number by a
    # broadcast, so that no key of the join is hot. Of the former there are at most min_lift times as many as a record has
    # items on average, of the latter at most HOT_SHARE.
    frequent = counts.where(F.col("n") * min_lift > total).select("item", F.lit(-1).cast("long").alias("known"))
    hot = numbered.where(F.col("n") > sums["cells"] // HOT_SHARE).select("item", F.col("i").cast("long").alias("known"))
    marked = baskets.join(F.broadcast(frequent.unionByName(hot)), "item", "left")
    rest = marked.where("known IS NULL").select("record", "item").join(numbered.select("item", "i"), "item")
    entries = cut(marked.where("known >= 0").select("record", F.col("known").alias("item")).unionByName(rest.select("record", F.col("i").cast("long").alias("item"))))
    summed = gram(entries, n_items, block_items).where(F.col("n") >= min_count)
    one, two = (numbered.select(F.col("i").alias(k), F.col("item").alias(f"item_{k}"), F.col("n").alias(f"n_{k}")) for k in "ab")
    named = summed.withColumnRenamed("n", "n_ab").join(one, "a").join(two, "b").where(F.col("n_ab") * total >= F.lit(min_lift) * F.col("n_a") * F.col("n_b"))
    swap = F.col("item_a") > F.col("item_b")
    return named.select(
        F.when(swap, F.col("item_b")).otherwise(F.col("item_a")).alias("item_a"),
        F.when(swap, F.col("item_a")).otherwise(F.col("item_b")).alias("item_b"),
        "n_ab",
        F.when(swap, F.col("n_b")).otherwise(F.col("n_a")).alias("n_a"),
        F.when(swap, F.col("n_a")).otherwise(F.col("n_b")).alias("n_b"),
        (F.col("n_ab") * total / (F.col("n_a") * F.col("n_b"))).alias("lift"),
    )


def p1_pairs(edges: DataFrame) -> DataFrame:
    return pairs_together(baskets_of(edges)).select("item_a", "item_b")
