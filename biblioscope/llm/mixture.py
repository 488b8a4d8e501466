"""Mixing records of several sources so that each gives its target share of all tokens.

Poisson replication: a record of a source with rate r is used as often as a Poisson variable with the mean that
gives r uses on average below the cap; the variable is the inverse of its distribution at a number hashed from
the record's key and a seed. So each record decides for itself, in any order, on any machine, the same way.
"""

from __future__ import annotations

import base64
import math
import re
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from biblioscope.session import cut

#: A public byte-level vocabulary as ranks; the path is a parameter.
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The split pattern that belongs to it (a fixed value of the public vocabulary).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: A run of white space from this length on is encoded by itself: the split pattern's look-ahead goes back over a run
#: place by place and fails on very long ones.
LONG_RUN = 50_000
SPACE_RUN = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % LONG_RUN)
#: Sources up to this number are joined as a broadcast (about 200 bytes each); more are joined by (source, salt).
MOST_BROADCAST = 10_000
SALTS = 32


@lru_cache(maxsize=4)
def _encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(text: str, ranks: str = RANKS) -> int:
    """Tokens of one text. The split pattern always breaks between a word and the white space after it, and parts a
    run of white space before a word into all but its last character and that one with the word; so a long run is
    taken out exactly there, and the count is that of the whole text."""
    encoding = _encoding(ranks)
    total, at = 0, 0
    for run in SPACE_RUN.finditer(text) if len(text) >= LONG_RUN else ():
        end = run.end() if run.end() == len(text) else run.end() - 1
        total += len(encoding.encode_ordinary(text[at : run.start()])) + len(encoding._encode_single_piece(text[run.start() : end]))
        at = end
    return total + len(encoding.encode_ordinary(text[at:]))


def token_count(text: Column, ranks: str = RANKS) -> Column:
    """Tokens of a text under a public vocabulary; 0 for null and empty texts. Texts are counted whole."""

    @F.pandas_udf("bigint")
    def count(texts: pd.Series) -> pd.Series:
        return pd.Series([count_tokens(t, ranks) if t else 0 for t in texts], dtype="int64")

    return F.coalesce(count(text), F.lit(0).cast("long"))


def source_name(col: Column) -> Column:
    """A source's name in one form: lower case, no white space around it, one '_' for runs of '-', '_' and white
    space. Null and blank names become null."""
    name = F.regexp_replace(F.lower(F.regexp_replace(col, r"(?U)^\s+|\s+$", "")), r"(?U)[\s_\-]+", "_")
    return F.when(name != "", name)


def _distribution(rate: float, cap: int) -> tuple[int, np.ndarray]:
    """(first, P(X <= first), P(X <= first + 1), ...) of a Poisson variable below ``cap``: the values at which its
    distribution leaves 0 and reaches 1 by more than a double can tell."""
    spread = 40 * math.sqrt(rate) + 60
    first, end = max(0, math.floor(rate - spread)), min(cap, math.ceil(rate + spread))
    if first >= end:
        return cap, np.empty(0)
    n = np.arange(first, end)
    log_p = n * math.log(rate) - rate - (math.lgamma(first + 1) + np.cumsum(np.log(np.maximum(n, 1))) - math.log(max(first, 1)))
    return first, np.minimum(1.0, np.cumsum(np.exp(log_p)))


def mean_uses(rate: float, cap: int) -> float:
    """E[min(X, cap)] of a Poisson variable X with mean ``rate``: the sum of P(X > n) below the cap."""
    first, below = _distribution(rate, cap)
    return first + float((1.0 - below).sum())


def poisson_steps(wanted: float, cap: int) -> tuple[int, list[float]]:
    """(sure, steps) for the rate at which min(X, cap) has mean ``wanted``: a record is used ``sure`` times, and once
    more for each of ``steps`` (P(X <= sure), P(X <= sure + 1), ...) that is at most its number in (0, 1)."""
    if wanted <= 0:
        return 0, []
    if wanted >= cap * (1 - 1e-9):
        return cap, []
    lo, hi = 0.0, 1.0
    while mean_uses(hi, cap) < wanted:
        hi *= 2
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if mean_uses(mid, cap) < wanted else (lo, mid)
    first, below = _distribution(hi, cap)
    return first, below[below < 1.0].tolist()


def clean_targets(targets: DataFrame) -> DataFrame:
    """(name, target_share, max_repeats) by source in one form; null and negative shares, and caps below 1, give
    none. Shares of names that become one are added, of their caps the greatest holds."""
    rows = targets.select(source_name(F.col("source")).alias("name"), F.col("target_share").cast("double").alias("target_share"), F.col("max_repeats").cast("int").alias("max_repeats"))
    fine = rows.where("name IS NOT NULL AND target_share > 0 AND NOT isnan(target_share) AND max_repeats >= 1")
    return fine.groupBy("name").agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))


def weigh(docs: DataFrame, *, id_col: str = "doc_id", source: str = "source", text: str = "text", ranks: str = RANKS) -> DataFrame:
    """(key, name, tokens) of every record."""
    return docs.select(F.col(id_col).alias("key"), source_name(F.col(source)).alias("name"), token_count(F.col(text), ranks).alias("tokens"))


def plan(weighed: DataFrame, targets: DataFrame, total_tokens: float | None = None) -> DataFrame:
    """(name, share, sure, steps): share of the sources present and Poisson steps, for each source that has a target and
    tokens; in any number.

    Shares are those of the sources present, scaled to add up to 1. Without ``total_tokens`` the mixture is the
    largest in which every source can give its share within its cap; with it, a source that cannot is used up to
    its cap. One row of totals passes the driver.
    """
    sums = weighed.where(F.col("name").isNotNull()).groupBy("name").agg(F.sum("tokens").alias("tokens"))
    rows = cut(clean_targets(targets).join(sums, "name").where("tokens > 0"))
    whole = rows.agg(F.sum("target_share").alias("w"), F.min(F.col("max_repeats") * F.col("tokens") / F.col("target_share")).alias("reach")).first()
    size = (whole["reach"] or 0.0) * (whole["w"] or 0.0) if total_tokens is None else float(total_tokens)

    @F.pandas_udf("sure bigint, steps array<double>")
    def steps(uses: pd.Series, cap: pd.Series) -> pd.DataFrame:
        found = [poisson_steps(float(u), int(c)) for u, c in zip(uses, cap)]
        return pd.DataFrame({"sure": [f[0] for f in found], "steps": [f[1] for f in found]})

    shared = rows.withColumn("share", F.col("target_share") / F.lit(whole["w"] or 1.0))
    uses = F.least(F.col("max_repeats").cast("double"), F.lit(size) * F.col("share") / F.col("tokens"))
    return cut(shared.withColumn("s", steps(uses, F.col("max_repeats").cast("bigint"))).select("name", "share", "s.sure", "s.steps"))


def unit(key: Column, seed: int) -> Column:
    """A number in (0, 1) hashed from a key."""
    return (F.shiftrightunsigned(F.xxhash64(F.lit(seed), key), 11).cast("double") + 0.5) / float(1 << 53)


def replicate(weighed: DataFrame, planned: DataFrame, seed: int = 42) -> DataFrame:
    """Adds ``copies``, how often each record of a source with a target is used; others are left out."""
    steps = planned.select("name", "sure", "steps")
    if steps.count() <= MOST_BROADCAST:
        met = weighed.join(F.broadcast(steps), "name")
    else:
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
        met = weighed.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int")).join(steps.select("*", salts), ["name", "salt"]).drop("salt")
    used = met.withColumn("u", unit(F.col("key"), seed))
    return used.withColumn("copies", F.col("sure") + F.size(F.filter("steps", lambda p: p <= F.col("u")))).drop("sure", "steps", "u").where("copies > 0")


def mixture(docs: DataFrame, targets: DataFrame, *, id_col: str = "doc_id", source: str = "source", text: str = "text", seed: int = 42, ranks: str = RANKS, total_tokens: float | None = None) -> DataFrame:
    """(key, name, copy_no, tokens, place): the mixture, one row for each use of a record, in random order.

    ``place`` is a hash of (key, copy) that orders the whole mixture; rows come sorted by it, in partitions of
    ranges of it. Records with a null or unknown source, or a source without target, are left out; records
    without text have 0 tokens and are used at their source's rate. Keys should be unique: records with equal
    keys are used equally often. Empty documents or targets give an empty mixture.
    """
    weighed = cut(weigh(docs, id_col=id_col, source=source, text=text, ranks=ranks))
    chosen = replicate(weighed, plan(weighed, targets, total_tokens), seed)
    each = chosen.withColumn("copy_no", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    placed = each.withColumn("place", F.xxhash64(F.lit(seed + 1), "key", "copy_no"))
    return placed.select("key", "name", "copy_no", "tokens", "place").orderBy("place", "key", "copy_no")


def shares_reached(docs: DataFrame, targets: DataFrame, *, id_col: str = "doc_id", source: str = "source", text: str = "text", seed: int = 42, ranks: str = RANKS, total_tokens: float | None = None) -> DataFrame:
    """(source, target_share, share_of_present, max_repeats, records, tokens, uses, tokens_used, share_reached,
    most_uses) of every source with a target or a record; '' stands for records without a source."""
    weighed = cut(weigh(docs, id_col=id_col, source=source, text=text, ranks=ranks))
    planned = plan(weighed, targets, total_tokens)
    used = cut(replicate(weighed, planned, seed).groupBy("name").agg(F.sum("copies").alias("uses"), F.sum(F.col("copies") * F.col("tokens")).alias("tokens_used"), F.max("copies").alias("most_uses")))
    held = weighed.withColumn("name", F.coalesce("name", F.lit(""))).groupBy("name").agg(F.count("*").alias("records"), F.sum("tokens").alias("tokens"))
    total = used.agg(F.sum("tokens_used").alias("total")).first()["total"]
    joined = clean_targets(targets).join(held, "name", "full").join(planned.select("name", F.col("share").alias("share_of_present")), "name", "left").join(used, "name", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return joined.select(
        F.col("name").alias("source"), F.coalesce("target_share", F.lit(0.0)).alias("target_share"), F.coalesce("share_of_present", F.lit(0.0)).alias("share_of_present"), "max_repeats",
        zero("records"), zero("tokens"), zero("uses"), zero("tokens_used"), F.coalesce(F.try_divide(F.col("tokens_used"), F.lit(total)), F.lit(0.0)).alias("share_reached"), zero("most_uses"),
    )
