"""Long exact spans shared between records.

Each different text is reduced to the k-mers that are least in some window of ``window`` k-mers (winnowing), so
two texts with an identical run of k + window - 1 code points share at least one of them. Texts are joined on
these seeds, the ordered matches of a pair are chained with gap costs (best predecessors from a Fenwick tree
over prefix maxima), and the chained part of both texts is aligned: every maximal identical run of the wanted
length comes out. Copies of one text are one record until the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from biblioscope.session import cut

BASE = (0x9E3779B97F4A7C15) | 1
INVERSE = pow(BASE, -1, 1 << 64)
SEED_K = 280
#: Records of one seed, and of one class of copies, that a task pairs with as many others.
PAIR_BLOCK = 256
#: Runs hashed at once.
BLOCK = 1_000_000


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


#: Powers of the base and of its inverse, as many as the longest text so far took.
_POWERS: list[np.ndarray] = []


def _powers(size: int) -> list[np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < size:
        _POWERS[:] = [np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, x, np.uint64)])) for x in (BASE, INVERSE)]
    return _POWERS


def kmer_hashes(points: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of every run of k code points (polynomial modulo 2**64, mixed)."""
    n = len(points)
    if n < k:
        return np.empty(0, np.uint64)
    power, inverse = _powers(1 << (n - 1).bit_length())
    power, inverse = power[:n], inverse[: n - k + 1]
    x = points.astype(np.uint64) + np.uint64(1)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x * power)])
    h = (total[k:] - total[:-k]) * inverse
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _sliding(values: np.ndarray, w: int, best: np.ufunc, fill: int) -> np.ndarray:
    """``best`` of each run of w values, from prefix and suffix bests of blocks of w."""
    n = len(values)
    padded = np.full(-(-n // w) * w, fill, values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, w)
    ahead = best.accumulate(blocks, axis=1).ravel()
    behind = best.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(behind[: n - w + 1], ahead[w - 1 : n])


def winnow(hashes: np.ndarray, w: int) -> np.ndarray:
    """Places whose hash is the least of some window of w hashes; of equal hashes side by side the first."""
    n = len(hashes)
    if n == 0:
        return np.empty(0, np.int64)
    if n <= w:
        return np.flatnonzero(hashes == hashes.min())[:1]
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    least = _sliding(hashes, w, np.minimum, int(top))  # of each window
    padded = np.concatenate([np.zeros(w - 1, np.uint64), least, np.zeros(w - 1, np.uint64)])
    chosen = hashes == _sliding(padded, w, np.maximum, 0)
    chosen[1:] &= hashes[1:] != hashes[:-1]
    return np.flatnonzero(chosen)


def _seeds_of_text(text: str, k: int, w: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first place, whether it comes again) of each different seed of one text. A long one is worked on in blocks that overlap by
    all but one of the places of a window, so that every window lies in one of them."""
    points = code_points(text)
    hashes, places, steady, start = [], [], [], 0
    while True:
        h = kmer_hashes(points[start : start + BLOCK + k - 1], k)
        at = winnow(h, w)
        hashes.append(h[at])
        places.append(at + start)
        steady.append(h[np.minimum(at + 1, len(h) - 1)] == h[at] if len(h) > 1 else at < 0)  # a run of one character
        if start + BLOCK + k - 1 >= len(points):
            break
        start += BLOCK - w + 1
    hashes, places, steady = np.concatenate(hashes), np.concatenate(places), np.concatenate(steady)
    distinct = np.unique(places, return_index=True)[1]  # of blocks that overlap
    values, first, times = np.unique(hashes[distinct], return_index=True, return_counts=True)
    return values.view(np.int64), places[distinct][first], (times > 1) | steady[distinct][first]


def seeds(texts: DataFrame, k: int, w: int) -> DataFrame:
    """(hash, i, pos, again) of every row of ``texts`` (i, text)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out: list[tuple] = []
            for i, text in zip(batch["i"], batch["text"]):
                values, at, again = _seeds_of_text(text, k, w)
                out.append((values, np.full(len(at), i), at, again))
            if out:
                yield pd.DataFrame({n: np.concatenate([o[j] for o in out]) for j, n in enumerate(("hash", "i", "pos", "again"))})

    return texts.mapInPandas(run, "hash bigint, i bigint, pos bigint, again boolean")


def chains(a: np.ndarray, b: np.ndarray, k: int, gap_cost: float = 0.5, drift_cost: float = 1.0) -> list[tuple[int, int, int, int]]:
    """Collinear chains of matches (a[i], b[i]) of length k: the (a_from, a_to, b_from, b_to) of each.

    Matches are taken by place in a; the best predecessor that ends before in b has the greatest
    score + gap_cost * (a + b), a prefix maximum kept in a Fenwick tree over the places in b. ``drift_cost`` is
    charged for the difference of the two gaps. Chains are cut where going on scores less than starting anew.
    """
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    ranks = np.unique(b, return_inverse=True)
    place, size = ranks[1] + 1, len(ranks[0])
    tree = np.full(size + 1, -1, np.int64)
    score, before = np.full(len(a), float(k)), np.full(len(a), -1)
    key = np.zeros(len(a))
    for i in range(len(a)):
        best, j = -1, place[i]
        while j:
            if tree[j] >= 0 and (best < 0 or key[tree[j]] > key[best]):
                best = tree[j]
            j &= j - 1
        if best >= 0:
            da, db = a[i] - a[best], b[i] - b[best]
            gained = min(k, da, db) - gap_cost * max(0, min(da, db) - k) / k - drift_cost * abs(da - db)
            if score[best] + gained > k:
                score[i], before[i] = score[best] + gained, best
        key[i] = score[i] + gap_cost * (a[i] + b[i])
        j = place[i]
        while j <= size:
            if tree[j] < 0 or key[i] > key[tree[j]]:
                tree[j] = i
            j += j & -j
    follows = set(before[before >= 0].tolist())
    found = []
    for i in range(len(a)):
        if i not in follows:
            j = i
            while before[j] >= 0:
                j = before[j]
            found.append((int(a[j]), int(a[i]) + k, int(b[j]), int(b[i]) + k))
    return found


def identical_runs(x: np.ndarray, y: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(place in x, place in y, length) of maximal identical runs that together cover every place of x that any
    identical run of ``least`` covers. Places found by hash are compared code point by code point."""
    hx, hy = kmer_hashes(x, least), kmer_hashes(y, least)
    if not len(hx) or not len(hy):
        return []
    sorted_y = np.argsort(hy, kind="stable")
    at = np.searchsorted(hy[sorted_y], hx)
    hit = np.flatnonzero((at < len(hy)) & (hy[sorted_y[np.minimum(at, len(hy) - 1)]] == hx))
    runs: list[tuple[int, int, int]] = []
    i = 0
    while i < len(hit):
        p = int(hit[i])
        q = int(sorted_y[at[p]])
        ahead = min(len(x) - p, len(y) - q)
        differ = np.flatnonzero(x[p : p + ahead] != y[q : q + ahead])
        ahead = int(differ[0]) if len(differ) else ahead
        if ahead < least:  # equal hashes of different runs
            i += 1
            continue
        back = min(p, q)
        differ = np.flatnonzero(x[p - back : p] != y[q - back : q])
        back = back - 1 - int(differ[-1]) if len(differ) else back
        runs.append((p - back, q - back, back + ahead))
        end = p + ahead
        # go on from the last hit that starts within the run, if it reaches beyond it
        j = int(np.searchsorted(hit, end, side="right")) - 1
        i = j + 1 if j <= i or int(hit[j]) + least <= end else j
    return runs


def _aligned(text_a: str, text_b: str, pos_a: np.ndarray, pos_b: np.ndarray, whole: bool, k: int, least: int) -> list[tuple[int, int, int]]:
    """Maximal identical runs within the chained parts of two texts, each part widened to where a run can reach;
    within the whole texts where one repeats a seed, as only its first place is known."""
    x, y = code_points(text_a), code_points(text_b)
    if whole:
        return sorted(set(identical_runs(x, y, least)) | {(p, q, n) for q, p, n in identical_runs(y, x, least)})
    parts = chains(np.asarray(pos_a), np.asarray(pos_b), k)
    found: set[tuple[int, int, int]] = set()
    for a0, a1, b0, b1 in parts:
        # along the diagonals at both ends a run may go on
        back = min(a0, b0)
        differ = np.flatnonzero(x[a0 - back : a0] != y[b0 - back : b0])
        back = back - 1 - int(differ[-1]) if len(differ) else back
        ahead = min(len(x) - a1, len(y) - b1)
        differ = np.flatnonzero(x[a1 : a1 + ahead] != y[b1 : b1 + ahead])
        ahead = int(differ[0]) if len(differ) else ahead
        left, right = max(back, min(a0, least)), max(ahead, min(len(x) - a1, least))
        left_b, right_b = max(back, min(b0, least)), max(ahead, min(len(y) - b1, least))
        for p, q, n in identical_runs(x[a0 - left : a1 + right], y[b0 - left_b : b1 + right_b], least):
            p, q = p + a0 - left, q + b0 - left_b
            back = min(p, q)
            differ = np.flatnonzero(x[p - back : p] != y[q - back : q])
            back = back - 1 - int(differ[-1]) if len(differ) else back
            ahead = min(len(x) - p - n, len(y) - q - n)
            differ = np.flatnonzero(x[p + n : p + n + ahead] != y[q + n : q + n + ahead])
            ahead = int(differ[0]) if len(differ) else ahead
            found.add((p - back, q - back, n + back + ahead))
    return sorted(found)


def in_blocks(df: DataFrame, member: str) -> tuple[DataFrame, DataFrame]:
    """Two sides of a join of every member of a group of ``n`` with every other, parted into blocks x and y of about
    PAIR_BLOCK members: a task never has more than the pairs of two blocks, and a small group is sent once."""
    blocks = F.ceil(F.col("n") / PAIR_BLOCK).cast("int")
    own = F.pmod(F.xxhash64(member), blocks).cast("int")
    sent = df.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return sent.withColumn("x", F.col("own")).withColumn("y", F.col("other")), sent.withColumn("x", F.col("other")).withColumn("y", F.col("own"))


def shared_spans(docs: DataFrame, id_col: str, text_col: str, *, least: int = 400, k: int = SEED_K) -> tuple[DataFrame, DataFrame]:
    """Two tables: spans (i, j, pos_i, pos_j, length) between different texts, and members (doc, i) by text.

    ``i`` numbers the different texts that have at least ``least`` code points; no link between them is lost.
    Null, empty and shorter texts share nothing. Keys of ``docs`` should be unique; repeats count as one record.
    ``k`` is the seed length, at most ``least``. Where a text repeats itself not all matches of a run are reported,
    but every place that a shared run covers is in some span.
    """
    long_enough = docs.where(F.length(text_col) >= least).select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"), F.sha2(text_col, 256).alias("digest"))
    # the lowest record of each text stands for it, and its key is the text's number
    members = cut(long_enough.groupBy("digest", "doc").agg(F.lit(1).alias("one")).select("digest", "doc"))
    lead = members.groupBy("digest").agg(F.min("doc").alias("i"))
    members = members.join(lead, "digest").select("doc", "i")
    texts = long_enough.join(lead, (F.col("doc") == F.col("i")), "left_semi").select(F.col("doc").alias("i"), "text").dropDuplicates(["i"])
    found = seeds(texts, k, least - k + 1)
    shared = found.groupBy("hash").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    linked = cut(found.join(shared, "hash"))
    left, right = in_blocks(linked, "i")
    left = left.select("hash", "x", "y", F.col("i"), F.col("pos").alias("pos_i"), F.col("again").alias("again_i"))
    right = right.select("hash", "x", "y", F.col("i").alias("j"), F.col("pos").alias("pos_j"), F.col("again").alias("again_j"))
    matches = left.join(right, ["hash", "x", "y"]).where(F.col("i") < F.col("j"))
    pairs = matches.groupBy("i", "j").agg(F.collect_list("pos_i").alias("pi"), F.collect_list("pos_j").alias("pj"), F.max(F.col("again_i") | F.col("again_j")).alias("whole"))
    with_text = pairs.join(texts.select("i", F.col("text").alias("ti")), "i").join(texts.select(F.col("i").alias("j"), F.col("text").alias("tj")), "j")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(i, j, *span) for i, j, *pair in zip(*(batch[c] for c in ("i", "j", "ti", "tj", "pi", "pj", "whole"))) for span in _aligned(*pair, k, least)]
            yield pd.DataFrame(rows, columns=["i", "j", "pos_i", "pos_j", "length"]).astype("int64")

    spans = with_text.select("i", "j", "ti", "tj", "pi", "pj", "whole").mapInPandas(run, "i bigint, j bigint, pos_i bigint, pos_j bigint, length bigint")
    return spans, members


def sharing_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 400) -> DataFrame:
    """(doc_a, doc_b), doc_a < doc_b: pairs of records whose texts share an identical run of ``least``.

    Pairs of classes of copies are found once and put back to their records at the end."""
    spans, members = shared_spans(docs, id_col, text_col, least=least)
    pairs = spans.select("i", "j").distinct()
    across = pairs.join(members.select(F.col("doc").alias("x"), "i"), "i").join(members.select(F.col("doc").alias("y"), F.col("i").alias("j")), "j").select("x", "y")
    # a class of copies may be large: its records are paired in blocks
    sizes = members.groupBy("i").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    left, right = in_blocks(members.join(sizes, "i"), "doc")
    within = left.select("i", "x", "y", F.col("doc").alias("a")).join(right.select("i", "x", "y", F.col("doc").alias("b")), ["i", "x", "y"]).where("a < b").select(F.col("a").alias("x"), F.col("b").alias("y"))
    return across.unionByName(within).select(F.least("x", "y").alias("doc_a"), F.greatest("x", "y").alias("doc_b"))


def _union_length(spans: pd.Series) -> pd.Series:
    def total(pairs: np.ndarray) -> int:
        got, end = 0, -1
        for s, e in sorted((int(p["s"]), int(p["e"])) for p in pairs):
            if e > end:
                got += e - max(s, end)
                end = e
        return got

    return pd.Series([total(p) for p in spans], dtype="int64")


def shared_part(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 400) -> DataFrame:
    """(doc, n_chars, shared_chars, share, class_id, n_copies): how much of every record stands elsewhere.

    Every record with a text has a row. One that has a copy is shared in full if it has ``least`` code points."""
    spans, members = shared_spans(docs, id_col, text_col, least=least)
    ends = spans.select("i", F.col("pos_i").alias("s"), (F.col("pos_i") + F.col("length")).alias("e")).unionByName(spans.select(F.col("j").alias("i"), F.col("pos_j").alias("s"), (F.col("pos_j") + F.col("length")).alias("e")))
    covered = ends.distinct().groupBy("i").agg(F.collect_list(F.struct("s", "e")).alias("spans")).select("i", F.pandas_udf(_union_length, "bigint")("spans").alias("covered"))
    copies = members.groupBy("i").agg(F.count("*").alias("n_copies"))
    by_class = members.join(copies, "i").join(covered, "i", "left")
    every = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("doc"), F.length(text_col).cast("long").alias("n_chars"))
    joined = every.join(by_class, "doc", "left")
    shared = F.when(F.col("n_copies") > 1, F.col("n_chars")).otherwise(F.coalesce("covered", F.lit(0)))
    return joined.select("doc", "n_chars", shared.alias("shared_chars"), F.coalesce(F.round(F.try_divide(shared, F.col("n_chars")), 6), F.lit(0.0)).alias("share"), F.coalesce("i", "doc").alias("class_id"), F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"))
