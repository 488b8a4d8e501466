"""Joins of every member of a group with every other, where a group may be very large."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def in_blocks(df: DataFrame, member: str, size: int) -> tuple[DataFrame, DataFrame]:
    """Two sides of a join of the members of a group, of ``n`` in all, with each other, parted into blocks x and y of
    about ``size`` members: joined on (group, x, y) every ordered pair meets once, and no task has more than the pairs of two
    blocks. A group of one block is sent once. ``member`` tells a member's block and should differ within a group."""
    blocks = F.greatest(F.lit(1), F.ceil(F.coalesce(F.col("n"), F.lit(1)) / size)).cast("int")
    sent = df.withColumn("own", F.pmod(F.xxhash64(member), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    left = sent.withColumn("x", F.col("own")).withColumn("y", F.col("other"))
    right = sent.withColumn("x", F.col("other")).withColumn("y", F.col("own"))
    return left.drop("own", "other", "n"), right.drop("own", "other", "n")
