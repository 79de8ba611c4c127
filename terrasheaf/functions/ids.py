"""Derived identities: prefixed short ids, canonical fingerprints, dense ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import stage


def sha256(col: Column) -> Column:
    return F.sha2(col, 256)


def stable_id(prefix: str, *parts: Column) -> Column:
    """``prefix`` plus the first 24 hex digits of sha256 over ``a|b|c``."""
    text = F.concat_ws("|", *[p.cast("string") for p in parts])
    return F.concat(F.lit(prefix), F.substring(F.sha2(text, 256), 1, 24))


def canonical_json(**fields: Column) -> Column:
    """Compact JSON with sorted keys, for string and integer fields.

    A NULL field is written as ``null``, as it would be in a canonical document.
    """
    names = sorted(fields)
    return F.to_json(F.struct(*[fields[n].alias(n) for n in names]), {"ignoreNullFields": "false"})


def canonical_fingerprint(**fields: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(canonical_json(**fields), 256))


def fingerprint_lines(lines: Column) -> Column:
    """sha256 over the sorted lines, each closed by a newline; empty gives sha256('')."""
    body = F.array_join(F.transform(F.array_sort(lines), lambda x: F.concat(x, F.lit("\n"))), "")
    return F.concat(F.lit("sha256:"), F.sha2(body, 256))


def prefix_sums(rows: DataFrame, group: list[str], order: list[str], name: str, value: Column | None = None, parts: int | None = None) -> DataFrame:
    """``rows`` with ``name``: the sum of ``value`` (1 if none) over the earlier rows of the group in the order.

    Rows are dealt to ranges of (group, order), so a large group lies in many
    tasks.  Each task sums its own part of a group; where a group goes on in
    another task, it begins there with the total of the parts before.  Only those
    totals, one for each group and task, are put in order anew.  ``order``
    should tell all rows of a group apart; rows that it does not are in any order.
    """
    ranges = [parts] if parts else []
    dealt = rows.withColumn("_value", F.lit(1).cast("long") if value is None else value)
    held = stage(dealt.repartitionByRange(*ranges, *group, *order).withColumn("_part", F.spark_partition_id()), "prefix-parts")
    first = [F.lit(0).cast(held.schema["_value"].dataType)]
    totals = held.groupBy(*group, "_part").agg(F.sum("_value").alias("_total"))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(*[F.col(g).alias(f"_of_{g}") for g in group], F.col("_part").alias("_at"), F.coalesce(F.sum("_total").over(earlier), *first).alias("_before"))
    inside = Window.partitionBy("_part", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = held.withColumn("_inside", F.coalesce(F.sum("_value").over(inside), *first))
    same = F.col("_part") == F.col("_at")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_of_{g}"))
    out = summed.join(before, same).withColumn(name, F.col("_before") + F.col("_inside"))
    return out.select(*[c for c in rows.columns if c != name], name)


def dense_ids(keys: DataFrame, ordinal: str, tie: list[str], name: str = "id", parts: int | None = None) -> DataFrame:
    """Number rows 1..n in (ordinal, tie) order without a one-partition window.

    Rows of one ordinal may lie in several tasks; only one count a task is put in order.
    """
    counted = prefix_sums(keys, [], [ordinal, *tie], name, parts=parts)
    return counted.withColumn(name, (F.col(name) + 1).cast("long"))
