"""The most similar vectors of every vector, by multi-index hashing of learned binary codes.

Vectors are centred, rotated so that the signs of their coordinates lose least (iterative quantisation, with
several independent rotations), and reduced to a bit string. The string is split into substrings and every
substring is an index. If two codes differ in fewer than (radius + 1) bits for each substring, at least one
substring differs in at most ``radius`` bits, so probing every index within ``radius`` retrieves all of them.
Candidates are ranked again by the cosine of their floats.

Tasks work on cells: the rows of one space and one substring whose values share a prefix. A row is sent to its
own cell and to the cells a probe can lead to; in the cell all probes are array look-ups.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from biblioscope.session import cut

WORD = 64
SUB = 16
#: Rows of a cell before it is divided by a longer prefix; a cell that stays larger is worked on in chunks.
CELL_ROWS = 250_000
#: Rows of a space that the rotation is learned from, about (those with a low hash); the index holds every row.
FIT_ROWS = 20_000
#: Words of 64 bits in a code, and bits in which two codes may differ for each on average: in all three standard deviations
#: more than vectors of cosine 0.90 differ in. Pairs beyond are not ranked by their floats.
WORDS, MOST_BITS = 3, 14
#: Candidates up to this number are joined as a broadcast (16 bytes each).
BROADCAST_ROWS = 500_000


def usable(df: DataFrame, id_col: str, vec_col: str, dim: int) -> DataFrame:
    """(id, vec): rows with a key and a vector of ``dim`` finite numbers that are not all zero."""
    v = F.col(vec_col).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
    kept = df.where(F.col(id_col).isNotNull() & (F.size(vec_col) == dim) & F.coalesce(fine, F.lit(False)))
    return kept.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<float>").alias("vec"))


def one_a_key(df: DataFrame) -> DataFrame:
    return df.groupBy("id").agg(F.max("vec").alias("vec"))


def learn_rotations(df: DataFrame, words: int, seed: int = 7, rounds: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """(mean, rotations) for ``words`` * 64 bits, from about FIT_ROWS rows of ``df`` (id, vec).

    The rows whose hash is below FIT_ROWS / (number of different keys) are taken: they leave their tasks as one row a
    key, and no more of them reach the driver as the table grows."""
    keys = df.agg(F.approx_count_distinct("id", 0.02).alias("n")).first()["n"]
    low = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < math.ceil(FIT_ROWS / max(keys, 1) * (1 << 30))
    sample = one_a_key(df.where(low)).toPandas().sort_values("id")["vec"]
    if not len(sample):
        return np.zeros(0), np.zeros((words, 0, WORD))
    x = np.stack(sample.to_numpy()).astype(np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    mean = x.mean(0)
    x = x - mean
    dim = x.shape[1]
    _, axes = np.linalg.eigh(x.T @ x)
    axes = axes[:, ::-1]
    rng = np.random.default_rng(seed)
    found = []
    for _ in range(words):
        # more bits than dimensions: every word has a rotation of its own
        basis = axes[:, :WORD] if dim >= WORD else axes @ rng.standard_normal((dim, WORD)) / math.sqrt(dim)
        z = x @ basis
        r = np.linalg.qr(rng.standard_normal((WORD, WORD)))[0]
        for _ in range(rounds):
            u, _, vt = np.linalg.svd(np.sign(z @ r).T @ z)
            r = (u @ vt).T
        found.append(basis @ r)
    return mean, np.stack(found)


def with_codes(df: DataFrame, mean: np.ndarray, rotations: np.ndarray) -> DataFrame:
    """Adds ``codes``: the bit string as one long for each rotation."""
    weights = (np.uint64(1) << np.arange(WORD, dtype=np.uint64))

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def encode(vec: pd.Series) -> pd.Series:
        if not len(vec):
            return pd.Series([], dtype=object)
        x = np.stack(vec.to_numpy()).astype(np.float64)
        x = x / np.linalg.norm(x, axis=1, keepdims=True) - mean
        words = [((x @ r > 0).astype(np.uint64) * weights).sum(1, dtype=np.uint64).view(np.int64) for r in rotations]
        return pd.Series(list(np.stack(words, 1)))

    return df.withColumn("codes", encode("vec"))


def _flips(bits: int, most: int) -> list[int]:
    return [sum(1 << b for b in c) for k in range(most + 1) for c in itertools.combinations(range(bits), k)]


def _search_cell(key: tuple, pdf: pd.DataFrame, words: int, prefix_bits: int, radius: int, most_bits: int) -> pd.DataFrame:
    """Pairs (a, b), a < b, found in one cell; each pair only by the first substring that finds it."""
    sub, prefix = int(key[1]), int(key[2])
    word, shift = divmod(sub * SUB, WORD)
    low_bits = SUB - prefix_bits
    ids = pdf["i"].to_numpy(np.int64)
    codes = np.stack([pdf[f"c{w}"].to_numpy(np.int64) for w in range(words)], 1).view(np.uint64)
    value = ((codes[:, word] >> np.uint64(shift)) & np.uint64((1 << SUB) - 1)).astype(np.int64)
    low = value & ((1 << low_bits) - 1)
    away = np.bitwise_count(((value >> low_bits) ^ prefix).astype(np.uint64)).astype(np.int64)
    home = np.flatnonzero(pdf["home"].to_numpy(bool))
    home = home[np.argsort(low[home], kind="stable")]
    starts = np.searchsorted(low[home], np.arange((1 << low_bits) + 1))
    found = []

    def probes():
        """Rows that ask, with the stretch of ``home`` each probe reads: by flipped bits, or by the values there are."""
        values = np.unique(low[home])
        if sum(math.comb(low_bits, k) for k in range(radius + 1)) <= len(values):
            for mask in _flips(low_bits, radius):
                asks = np.flatnonzero(away + int(mask).bit_count() <= radius)
                yield asks, starts[low[asks] ^ mask], starts[(low[asks] ^ mask) + 1]
        else:
            for v in values.tolist():
                asks = np.flatnonzero(away + np.bitwise_count((low ^ v).astype(np.uint64)) <= radius)
                yield asks, np.full(len(asks), starts[v]), np.full(len(asks), starts[v + 1])

    for asks, lo, hi in probes():
        per = hi - lo
        step = 0
        while step < len(asks):  # at most about four million candidates at once
            total = np.cumsum(per[step:])
            stop = step + max(1, int(np.searchsorted(total, 4_000_000, side="right")))
            n = per[step:stop]
            q = np.repeat(asks[step:stop], n)
            hit = home[np.repeat(lo[step:stop], n) + np.arange(len(q)) - np.repeat(np.cumsum(n) - n, n)]
            keep = ids[q] < ids[hit]
            q, hit = q[keep], hit[keep]
            differ = codes[q] ^ codes[hit]
            near = np.bitwise_count(differ).sum(1) <= most_bits * words
            q, hit, differ = q[near], hit[near], differ[near]
            new = np.ones(len(q), bool)
            for earlier in range(sub):
                w, s = divmod(earlier * SUB, WORD)
                new &= np.bitwise_count((differ[:, w] >> np.uint64(s)) & np.uint64((1 << SUB) - 1)) > radius
            found.append(np.stack([ids[q[new]], ids[hit[new]]], 1))
            step = stop
    pairs = np.concatenate(found) if found else np.empty((0, 2), np.int64)
    return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})


def candidate_pairs(coded: DataFrame, n: int, words: int, radius: int, most_bits: int = MOST_BITS) -> DataFrame:
    """(a, b) of rows of ``coded`` (space, i, codes) whose codes lie near each other."""
    prefix_bits = min(12, max(0, math.ceil(math.log2(max(n, 1) / CELL_ROWS)))) if n > CELL_ROWS else 0
    subs = words * WORD // SUB
    value = lambda s: F.shiftright(F.get("codes", F.lit(s * SUB // WORD)), s * SUB % WORD).bitwiseAND(F.lit((1 << SUB) - 1))
    prefix = lambda s: F.shiftright(value(s), SUB - prefix_bits)
    sent = F.array(*[F.struct(F.lit(s).alias("sub"), prefix(s).bitwiseXOR(F.lit(f)).alias("prefix"), F.lit(f == 0).alias("home")) for s in range(subs) for f in _flips(prefix_bits, min(radius, prefix_bits))])
    base = coded.select("space", "i", *[F.get("codes", F.lit(w)).alias(f"c{w}") for w in range(words)], F.explode(sent).alias("at")).select("space", "at.*", "i", *[f"c{w}" for w in range(words)])
    # how many chunks a cell needs: one row for each of its rows' cells, at most spaces * subs * 2 ** prefix_bits
    cells = coded.select("space", F.explode(F.array(*[F.struct(F.lit(s).alias("sub"), prefix(s).alias("prefix")) for s in range(subs)])).alias("at")).groupBy("space", "at.sub", "at.prefix").agg(F.ceil(F.count("*") / (2 * CELL_ROWS)).cast("int").alias("chunks")).where("chunks > 1")
    own = F.pmod(F.xxhash64("i"), F.col("chunks"))
    chunked = base.join(F.broadcast(cells), ["space", "sub", "prefix"], "left").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("chunks"), F.lit(1)) - 1))).withColumn("home", F.col("home") & (F.col("chunks").isNull() | (own == F.col("chunk"))))
    return chunked.drop("chunks").groupBy("space", "sub", "prefix", "chunk").applyInPandas(lambda key, pdf: _search_cell(key, pdf, words, prefix_bits, radius, most_bits), "a bigint, b bigint")


def cosine(a: Column, b: Column) -> Column:
    total = lambda x: F.aggregate(x, F.lit(0.0), lambda s, y: s + y)
    dot = total(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))
    norm = lambda v: F.sqrt(total(F.transform(v, lambda x: x.cast("double") * x.cast("double"))))
    return F.try_divide(dot, norm(a) * norm(b))


def similar_pairs(spaces: dict[str, DataFrame], *, k: int = 5, min_cosine: float = 0.90, dim: int = 64, words: int = WORDS, radius: int = 1, most_bits: int = MOST_BITS) -> DataFrame:
    """(space, id_a, id_b, cosine): id_a < id_b, cosine >= min_cosine, one among the k nearest of the other.

    ``spaces`` names the collections, each with (id, embedding). Null, zero, not-a-number vectors, those of
    another length and rows without a key take no part; of rows with one key one counts. Equal cosines rank by
    id. Vectors equal in every element form a class: its k nearest are its own lowest ids, so only the k + 1
    lowest members are searched and the others are linked to the k lowest (no class is expanded into all its
    pairs). An empty collection gives no rows.

    Accuracy: every pair whose codes differ in less than (radius + 1) bits for each substring of SUB bits is a candidate, if
    it differs in at most ``most_bits`` for each word. Other pairs may be missed, and then a farther neighbour may come
    in among the k. More ``words`` or a larger ``radius`` find more; ``radius`` = SUB and ``most_bits`` = WORD compare all
    pairs of a collection, which is exact, and grows with its square.
    """
    coded = []
    for name, df in spaces.items():
        vectors = usable(df, "id", "embedding", dim)
        mean, rotations = learn_rotations(vectors, words)
        if not len(mean):
            continue
        coded.append(with_codes(one_a_key(vectors), mean, rotations).withColumn("space", F.lit(name)))
    if not coded:
        empty = next(iter(spaces.values()))
        return empty.select(F.lit("").alias("space"), F.col("id").alias("id_a"), F.col("id").alias("id_b"), F.lit(0.0).alias("cosine")).where(F.lit(False))
    union = coded[0]
    for c in coded[1:]:
        union = union.unionByName(c)
    base = cut(union.select("space", "id", "vec", "codes", F.monotonically_increasing_id().alias("i"), F.xxhash64("vec").alias("h1"), F.xxhash64(F.lit(1), "vec").alias("h2")))
    same = ["space", "h1", "h2"]
    sizes = base.groupBy("space", "h1", "h2").agg(F.count("*").alias("n"))
    crowded = cut(sizes.where(F.col("n") > k + 1))
    searched, linked = base, None
    if crowded.count():
        members = base.select("space", "id", "i", "h1", "h2").join(crowded.select(*same), same)
        place = F.row_number().over(Window.partitionBy(*same).orderBy("id"))
        lowest = cut(members.withColumn("place", place).where(F.col("place") <= k + 1))
        rest = members.join(lowest.select("i"), "i", "left_anti")
        searched = base.join(rest.select("i"), "i", "left_anti")
        first = lowest.where(F.col("place") <= k).groupBy(*same).agg(F.collect_list("id").alias("ids"))
        linked = rest.join(first, same).select("space", F.explode("ids").alias("id_a"), F.col("id").alias("id_b"), F.lit(1.0).alias("cosine"))
    candidates = cut(candidate_pairs(searched.select("space", "i", "codes"), searched.count(), words, radius, most_bits))
    needed = candidates.select(F.explode(F.array("a", "b")).alias("i")).distinct()
    if candidates.count() <= BROADCAST_ROWS:
        needed = F.broadcast(needed)
    vectors = base.join(needed, "i", "left_semi")
    one = vectors.select(F.col("i").alias("a"), "space", F.col("id").alias("id_a"), F.col("vec").alias("va"))
    two = vectors.select(F.col("i").alias("b"), F.col("id").alias("id_b"), F.col("vec").alias("vb"))
    ranked = candidates.join(one, "a").join(two, "b").select("space", "id_a", "id_b", cosine(F.col("va"), F.col("vb")).alias("cosine"))
    close = cut(ranked.where(F.col("cosine") >= min_cosine))
    both = close.select("space", F.col("id_a").alias("id"), F.col("id_b").alias("other"), "cosine").unionByName(close.select("space", F.col("id_b").alias("id"), F.col("id_a").alias("other"), "cosine"))
    rank = F.row_number().over(Window.partitionBy("space", "id").orderBy(F.desc("cosine"), "other"))
    nearest = both.withColumn("rank", rank).where(F.col("rank") <= k)
    pairs = nearest.groupBy("space", F.least("id", "other").alias("id_a"), F.greatest("id", "other").alias("id_b")).agg(F.max("cosine").alias("cosine"))
    return pairs if linked is None else pairs.unionByName(linked.select("space", F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"), "cosine"))
