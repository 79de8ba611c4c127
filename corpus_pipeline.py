"""Corpus pipeline over ``documents``: filter, deduplicate, decontaminate, encode.

Each stage reads what its predecessor kept, as Parquet in the shared folder.
All stages but the last return the columns of ``documents``.  A stage begins by
deleting what earlier stages staged in the shared folder, except what it reads,
so the result of a stage must be written before the next one begins.

Defined cases are those of the operators: documents without words are rejected
by the rules; ties and repeated rows leave one row; empty tables pass through
every stage; extra columns of ``documents`` are kept until the last stage, which
returns doc_id, n_tokens, ids and decoded.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrasheaf.llm import bpe, decontamination, near_copies, quality_rules, span_dedup
from terrasheaf.llm.common import drop_staged, read_table, stage
from terrasheaf.llm.queries import vocabulary


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules' votes find good; the others go."""
    drop_staged(spark, docs)
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, on shingles of five words."""
    drop_staged(spark, docs)
    return near_copies.deduplicate(docs)


def repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that an earlier document has; n_chars follows the text."""
    drop_staged(spark, docs)
    # The row travels as one column, so that no column of ``documents`` meets one of the operator's.
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", "text")
    cut = span_dedup.remove_repeats(held)
    columns = {c: F.col(f"row.`{c}`") for c in docs.columns} | {"text": F.col("text")}
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        columns["n_chars"] = F.when(F.col("text") != F.col("row.text"), F.length("text").cast(kind)).otherwise(columns["n_chars"])
    return cut.select(*[column.alias(name) for name, column in columns.items()])


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark passage occurs; the others go."""
    drop_staged(spark, docs)
    return decontamination.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian unsigned 32-bit bytes) and the text decoded from them."""
    drop_staged(spark, docs)
    return bpe.encode(docs, vocabulary("word_bpe_49k.json"), decoded=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_spans", repeated_spans),
    ("decontaminated", decontaminated),
    ("encoded", encoded),
]

# The merges of the last stage cannot be expressed in SQL; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
