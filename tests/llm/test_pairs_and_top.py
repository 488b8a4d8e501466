"""Items that appear together and the first N of each group, against brute force."""

import itertools
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from biblioscope.llm import cooccur, topn


def brute_pairs(rows, min_count, lift):
    baskets = defaultdict(set)
    for r, i in rows:
        if r is not None and i is not None:
            baskets[r].add(i)
    n, pairs = Counter(), Counter()
    for items in baskets.values():
        n.update(items)
        pairs.update(itertools.combinations(sorted(items), 2))
    return {(a, b, k) for (a, b), k in pairs.items() if k >= min_count and k * len(baskets) >= lift * n[a] * n[b]}


@pytest.mark.parametrize("block_items", [1000, 12, 1])
def test_pairs_equal_brute_force(spark, block_items):
    """With few items to a block the range of items is parted for the long records, down to one item."""
    rng = random.Random(3)
    rows = []
    for r in range(150):
        size = 40 if r % 10 == 0 else 5
        rows += [(f"r{r}", f"i{int(60 * rng.random() ** 2)}") for _ in range(size)] + [(f"r{r}", "everywhere")]
        if r % 12 == 0:
            rows += [(f"r{r}", "x"), (f"r{r}", "Y"), (f"r{r}", "x")]
    rows += [(None, "x"), ("r1", None)]
    df = spark.createDataFrame(rows, "record string, item string")
    got = {(r.item_a, r.item_b, r.n_ab) for r in cooccur.pairs_together(df, min_count=3, min_lift=1.5, block_items=block_items).collect()}
    want = brute_pairs(rows, 3, 1.5)
    assert want and got == want
    assert all(a < b for a, b, _ in got)


def test_pairs_only_in_long_records(spark):
    rows = [(f"w{r}", f"i{i}") for r in range(8) for i in range(30)] + [(f"n{r}", f"z{r}") for r in range(400)]
    df = spark.createDataFrame(rows, "record string, item string")
    got = {(r.item_a, r.item_b, r.n_ab) for r in cooccur.pairs_together(df, block_items=10).collect()}
    assert got == brute_pairs(rows, 6, 5.0) and len(got) == 30 * 29 // 2


def test_product_of_blocks():
    rng = np.random.default_rng(1)
    x, y = rng.random((40, 30)) < 0.2, rng.random((40, 50)) < 0.1
    got = np.zeros((30, 50), int)
    for a, b, n in cooccur.block_product(np.nonzero(x), np.nonzero(y)):
        np.add.at(got, (a, b), n)
    assert (got == x.T.astype(int) @ y).all()
    got = np.zeros((30, 30), int)
    for a, b, n in cooccur.block_product(np.nonzero(x), None):
        np.add.at(got, (a, b), n)
    assert (got == np.triu(x.T.astype(int) @ x, 1)).all()


def test_one_record_with_most_cells(spark):
    """A record that holds a third of all rows is parted; its pairs count with those of the others."""
    rows = [("hot", f"i{i}") for i in range(1500)] + [(f"r{r}", f"i{(r * 7 + d) % 1500}") for r in range(1500) for d in (0, 1)]
    rows += [(f"q{r}", f"i{10 * (r % 9)}") for r in range(60)] + [(f"q{r}", f"i{10 * (r % 9) + 3}") for r in range(60)]
    df = spark.createDataFrame(rows, "record string, item string")
    got = {(r.item_a, r.item_b, r.n_ab) for r in cooccur.pairs_together(df, min_count=4, min_lift=2.0, block_items=100).collect()}
    want = brute_pairs(rows, 4, 2.0)
    assert want and got == want


def test_pairs_of_nothing(spark):
    assert cooccur.pairs_together(spark.createDataFrame([], "record string, item string")).count() == 0


EDGE = "id string, subject struct<id:string,name:string>, object struct<id:string,name:string>, provenance struct<source_id:string>, confidence double, extracted_at timestamp, g int, bin int"


def test_baskets_clean_their_ids(spark):
    import datetime as dt

    t = dt.datetime(2024, 1, 1)
    rows = [("1", (" a\t", None), ("B", None), ("P",), 0.5, t, 1, 1), ("2", ("A", None), ("  ", None), ("P",), 0.5, t, 1, 1), ("3", (None, None), ("c", None), (None,), 0.5, t, 1, 1), ("4", None, ("d", None), ("Q",), 0.5, t, 1, 1)]
    got = {(r.record, r["item"]) for r in cooccur.baskets_of(spark.createDataFrame(rows, EDGE)).collect()}
    assert got == {("P", "A"), ("P", "B"), ("Q", "D")}


def test_top_edges(spark):
    import datetime as dt

    rng = random.Random(5)
    rows, t = [], dt.datetime(2024, 1, 1)
    for i in range(4000):
        subject = "hot" if i % 3 == 0 else f"s{rng.randrange(300)}"
        score = rng.choice([0.9, 0.9, 0.9, rng.random(), float("nan"), None, -0.0, 0.0, 1.0, 1.5, -0.1])
        rows.append((f"e{i:05}" if i % 50 else None, (rng.choice([subject, f" {subject.upper()}\t"]), None), None, None, score, t + dt.timedelta(days=rng.randrange(5)), i, 7))
    rows += [(r[0], r[1], None, None, 0.25, r[5] + dt.timedelta(days=9), 0, 0) for r in rows[:300]]
    rows += rows[500:600] + [("nulltime", ("q", None), None, None, 0.5, None, 0, 0), ("blank", (" ", None), None, None, 0.5, t, 0, 0), ("nosubject", None, None, None, 0.5, t, 0, 0)]
    last = {}
    for r in rows:
        if r[0] is not None and (r[0] not in last or (r[5] or dt.datetime.min) > (last[r[0]][5] or dt.datetime.min)):
            last[r[0]] = r
    groups = defaultdict(list)
    for r in last.values():
        subject = ((r[1] or (None,))[0] or "").strip().upper()
        if subject and r[4] is not None and 0 <= r[4] <= 1:
            groups[subject].append((-(r[4] + 0.0), r[0]))
    want = {(s, n + 1, i) for s, v in groups.items() if len(v) > 5 for n, (_, i) in enumerate(sorted(v)[:5])}
    got = {(r.subject_id, r.rank_no, r.edge_id) for r in topn.top_edges(spark.createDataFrame(rows, EDGE)).collect()}
    assert got == want
    assert topn.top_edges(spark.createDataFrame([], EDGE)).count() == 0


def test_top_n_keeps_equal_rows_and_small_groups(spark):
    df = spark.createDataFrame([("g", 0.5, "a")] * 3 + [("h", 0.1, "z"), (None, 0.3, "n")], "k string, v double, t string")
    got = sorted((r.k, r.rank_no, r.t) for r in topn.top_n(df, "k", "v", "t", 2).collect())
    assert got == [("g", 1, "a"), ("g", 2, "a"), ("h", 1, "z")]


@pytest.mark.parametrize("hot_rows", [topn.HOT_ROWS, 3, 0])
def test_top_n_of_hot_groups(spark, hot_rows):
    """Whatever group counts as hot, the rows are the same; one group holds a third of them, with many ties."""
    rng = random.Random(8)
    rows = [("hot" if i % 3 == 0 else f"g{i % 90}", rng.choice([0.5, 0.9, rng.random()]), f"t{i:05}") for i in range(6000)]
    groups = defaultdict(list)
    for g, v, t in rows:
        groups[g].append((-v, t))
    want = {(g, n + 1, t) for g, v in groups.items() for n, (_, t) in enumerate(sorted(v)[:4])}
    df = spark.createDataFrame(rows, "k string, v double, t string")
    assert {(r.k, r.rank_no, r.t) for r in topn.top_n(df, "k", "v", "t", 4, hot_rows=hot_rows).collect()} == want
