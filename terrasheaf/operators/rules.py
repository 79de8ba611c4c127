"""Violation rows: every rule that fails on a row becomes one output row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def violations(df: DataFrame, subject: list, rules: dict[str, Column]) -> DataFrame:
    """Subject columns plus ``code`` for each failing rule; NULL counts as not failing."""
    codes = F.array_compact(F.array(*[F.when(bad, F.lit(code)) for code, bad in rules.items()]))
    return df.select(*subject, F.explode(codes).alias("code"))


def repeated(df: DataFrame, keys: list[str], subject: Column, code: str) -> DataFrame:
    """One violation per key tuple that occurs more than once."""
    twice = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    return twice.select(subject.cast("string").alias("subject"), F.lit(code).alias("code"))


def union_all(*parts: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


RANK_BROKEN = "{rank} < 0 or {rank} >= n_group or n_same > 1"


def ranked_neighbours(rows: DataFrame, group: list[str], rank: str, key: Column) -> DataFrame:
    """Add ``own`` key, ``prev`` key at the rank before, and two rank counts.

    Ranks are 0..n-1 exactly when none is out of range and none repeats.  Keys
    meet their predecessor by an equi-join on rank + 1, so a group with most of
    the rows is not sorted in one task.
    """
    own = rows.withColumn("own", key)
    size = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("n_group"))
    at = own.groupBy(*group, rank).agg(F.count(F.lit(1)).alias("n_same"), F.max("own").alias("top"))
    before = at.select(*group, (F.col(rank) + 1).alias(rank), F.col("top").alias("prev"))
    return own.join(size, group).join(at.drop("top"), [*group, rank]).join(before, [*group, rank], "left")
