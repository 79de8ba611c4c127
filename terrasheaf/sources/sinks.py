"""Versioned outputs: packs and ledgers are written once and never replaced."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.rules import union_all


class VersionExists(ValueError):
    """The version folder is already there."""


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def write_pack(tables: dict[str, DataFrame], root: str, region: str, version: str, sort: dict[str, list[str]] | None = None) -> str:
    """Write pack tables as Parquet below root/region/version; refuse an existing version.

    ``sort`` names the columns to range-partition a table by, so that box filters
    can skip files by their column statistics.
    """
    base = f"{root.rstrip('/')}/{region}/{version}"
    spark = next(iter(tables.values())).sparkSession
    if _exists(spark, base):
        raise VersionExists(base)
    for name, table in tables.items():
        keys = (sort or {}).get(name)
        out = table.repartitionByRange(*keys).sortWithinPartitions(*keys) if keys else table
        out.write.mode("error").parquet(f"{base}/{name}")
    return base


def read_pack(spark: SparkSession, base: str, names: list[str]) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{base}/{name}") for name in names}


def write_ledgers(peers: DataFrame, unpaired: DataFrame, path: str) -> str:
    """Three gzip JSON ledgers in id order: peers and the unpaired edges of each side."""
    spark = peers.sparkSession
    if _exists(spark, path):
        raise VersionExists(path)

    def ledger(df: DataFrame, keys: list[str], name: str) -> None:
        ordered = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
        ordered.write.mode("error").json(f"{path}/{name}", compression="gzip")

    ledger(peers, ["from_graph_id", "to_graph_id"], "physical-peers")
    for side in ("from", "to"):
        ledger(unpaired.filter(F.col("side") == side).drop("side"), ["graph_id"], f"unpaired-{side}")
    return path


def ledger_counts(spark: SparkSession, path: str) -> DataFrame:
    """Rows of each written ledger, counted from the files."""
    parts = []
    for name in ("physical-peers", "unpaired-from", "unpaired-to"):
        rows = spark.read.schema("way_id bigint").json(f"{path}/{name}")
        parts.append(rows.agg(F.lit(name).alias("ledger"), F.count("way_id").alias("n")))
    return union_all(*parts)
