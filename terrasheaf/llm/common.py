"""Helpers shared by the operators: shipping, staging, text batches, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import run_dir, ship

BITS_PER_KEY, LANES, MOST_BLOCKS = 16, 8, 1 << 20
_STAGED: list[tuple[str, str]] = []

# White space that separates words (space, tab, LF, VT, FF, CR).
WORD_SPACE = " \t\n\x0b\x0c\r"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back."""
    path = run_dir(df.sparkSession, label)
    _STAGED.append((df.sparkSession.sparkContext.applicationId, path))
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession, kept: DataFrame) -> None:
    """Delete what was staged so far, except the files that ``kept`` reads."""
    app, read = spark.sparkContext.applicationId, [f.split(":", 1)[-1].lstrip("/") for f in kept.inputFiles()]
    for entry in [e for e in _STAGED if e[0] == app]:
        if not any(f.startswith(entry[1].split(":", 1)[-1].lstrip("/") + "/") for f in read):
            path = spark._jvm.org.apache.hadoop.fs.Path(entry[1])
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
            _STAGED.remove(entry)


def words_of(text: str | None) -> list[bytes]:
    """Words between WORD_SPACE of ``text`` with A-Z lower-cased; None has none."""
    return text.encode().lower().split() if text else []


def map_texts(
    docs: DataFrame,
    columns: dict[str, str],
    schema: str,
    make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]],
    most: int = 4 << 20,
) -> DataFrame:
    """Apply ``make()(batch)`` to every Arrow batch of the named columns.

    ``columns`` maps the names that the function sees to columns of ``docs``;
    nothing else of ``docs`` is read, so extra columns cannot clash.  ``make``
    runs once per task, so that tables and caches are set up there.  ``most``
    bounds the bytes of a batch, and so the memory of what is made from it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            # Arrow batches are counted in rows; long texts are cut further by bytes.
            for part in by_bytes(batch, most):
                out = step(part)
                if out.num_rows:
                    yield out

    ship(docs.sparkSession)
    chosen = docs.select(*[docs[c].alias(n) for n, c in columns.items()])
    return chosen.mapInArrow(run, schema)


def by_bytes(batch: pa.RecordBatch, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows of about ``most`` bytes; a longer row stands alone."""
    per_row = max(1, batch.nbytes // max(1, batch.num_rows))
    rows = max(1, most // per_row)
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def key_hashes(*key: Column) -> tuple[Column, Column]:
    """Two hashes of a key, as a filter takes them."""
    return F.xxhash64(*key), F.xxhash64(*key, F.lit(1))


def build_filter(hashes: DataFrame) -> np.ndarray:
    """Blocked Bloom filter of rows (h1, h2): blocks of eight 32-bit lanes.

    The number of blocks, and so what comes to the driver and goes to the tasks,
    is bounded by MOST_BLOCKS (32 MB); with more keys more lookups pass.
    """
    n, blocks = hashes.count(), 1
    while blocks * 32 * LANES < n * BITS_PER_KEY and blocks < MOST_BLOCKS:
        blocks *= 2
    bit = lambda k: F.shiftrightunsigned("h2", 5 * k).bitwiseAND(F.lit(31)).cast("int")
    lanes = [F.bit_or(F.call_function("shiftleft", F.lit(1), bit(k))).alias(f"l{k}") for k in range(LANES)]
    rows = hashes.groupBy(F.pmod("h1", F.lit(blocks)).cast("int").alias("block")).agg(*lanes).toPandas()
    table = np.zeros((blocks, LANES), np.uint32)
    if len(rows):
        table[rows["block"]] = rows[[f"l{k}" for k in range(LANES)]].to_numpy(np.int32).view(np.uint32)
    return table


def may_contain(table: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    block = table[h1 % len(table)]
    bit = (h2.astype(np.uint64)[:, None] >> (5 * np.arange(LANES, dtype=np.uint64))) & np.uint64(31)
    return ((block >> bit.astype(np.uint32)) & 1).all(axis=1)


def filter_test(spark: SparkSession, hashes: DataFrame):
    """A column function of (h1, h2): whether a key may be among ``hashes``; never false for one that is.

    Joins use it to move only rows that can have a partner.
    """
    ship(spark)
    sent = spark.sparkContext.broadcast(build_filter(hashes))

    @F.pandas_udf("boolean")
    def possible(h1: pd.Series, h2: pd.Series) -> pd.Series:
        return pd.Series(may_contain(sent.value, h1.to_numpy(), h2.to_numpy()))

    return possible


def _star(edges: DataFrame, large: bool, label: str) -> DataFrame:
    """One star step over edges (u, v) with u > v, written and read back."""
    if large:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges
    low = stage(both.groupBy("u").agg(F.min("v").alias("m")), f"{label}-low")
    low = low.select("u", F.least("u", "m").alias("m"))
    met = both.join(low, "u")
    if large:
        out = met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = met.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            low.where("u <> m").select("u", F.col("m").alias("v"))
        )
    return stage(out.where("u <> v").distinct(), label)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge (a, b); root is the smallest node.

    Alternating large and small stars: each step only aggregates minima and
    joins them back, so a hub is never gathered; minima are written first, which
    lets the adaptive planner split the join of a hub's edges.
    """
    ends = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    now = stage(ends.where("u <> v").distinct(), "cc-start")
    mark = None
    while True:
        now = _star(_star(now, True, "cc-large"), False, "cc-small")
        row = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(row) == mark:
            break
        mark = tuple(row)
        # A star forest has no node that is both a child and a root.
        if not now.join(now.select(F.col("u").alias("v")), "v", "left_semi").limit(1).count() and _flat(now):
            break
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


def _flat(edges: DataFrame) -> bool:
    """Whether every child has one root, so that no further step changes a thing."""
    return not edges.groupBy("u").count().where("count > 1").limit(1).count()


def merge_labels(lab: np.ndarray, i: np.ndarray, j: np.ndarray) -> bool:
    """Union the sets of ``i`` and ``j`` in place; ``lab`` holds each item's root."""
    changed = False
    while True:
        a, b = lab[i], lab[j]
        open_ = a != b
        if not open_.any():
            return changed
        changed = True
        i, j, a, b = i[open_], j[open_], a[open_], b[open_]
        np.minimum.at(lab, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = lab[lab]
            if np.array_equal(up, lab):
                break
            lab[:] = up
