"""Hard negatives by Fagin's threshold algorithm.

Candidates are dealt to shards of about SHARD_ROWS rows.  A shard keeps its
integer vectors and, for each dimension, the list of its rows sorted by that
component.  An anchor reads the lists from the end that its own component's sign
makes best (dimensions in which it is zero are left out).  Rows met on any list
are scored in full by random access.  The sum of the products at the current
depths bounds every row not met yet; a search stops once this threshold is
strictly below the k-th score of each of its windows (or below the window, if
it has fewer), or once all rows are met.

A window is a range of scores; the first k rows in it count.  The positives of
an anchor are its k best rows of the same label; each positive then sets a
window of scores for the rows of other labels.  The first k of a shard, merged
over all shards, are the first k of all, so the shards need no word of each
other.  Anchors go to the shards in blocks of bounded size; nothing is
broadcast or collected.

Scores are exact integer inner products.  Every score order ends with the
smaller vec_id.

Defined cases: rows with a null label, vec_id or vector, a null or non-finite
component, or one beyond MOST_COMPONENT (whose products 64 bits cannot hold)
take no part; shorter vectors count as padded with zeros; of rows that repeat a
vec_id one takes part, that with the least label and vector; equal vectors under
different ids are rows of their own; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import ship, stage

SHARD_ROWS, BLOCK_ROWS = 1 << 14, 1 << 11
SCALE = 256
MOST_COMPONENT = float(1 << 18)  # times SCALE squared, over 2^11 dimensions, stays below 2^63
FIRST_DEPTH = 16
_SHARD = "shard int, ids binary, labels binary, vectors binary, lists binary, width int"


def integer_rows(embeddings: DataFrame, vector: str = "embedding", label: Column | None = None) -> DataFrame:
    """(vec_id, label, q): rows that take part, with components floor(SCALE * x)."""
    x = F.col(f"`{vector}`")
    usable = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) <= MOST_COMPONENT))
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        (F.col("label") if label is None else label).cast("long").alias("label"),
        F.transform(x, lambda v: F.floor(v.cast("double") * SCALE).cast("int")).alias("q"),
        F.coalesce(usable, F.lit(False)).alias("ok"),
    )
    rows = rows.where("ok and vec_id is not null and label is not null").drop("ok")
    one = rows.groupBy("vec_id").agg(F.min(F.struct("label", "q")).alias("row"))
    return one.select("vec_id", "row.*")


def make_shards(rows: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row for each shard: its rows in order of vec_id and its sorted lists."""
    n = max(1, -(-rows.count() // shard_rows))

    def pack(key, table):
        table = table.combine_chunks().sort_by("vec_id")
        vectors = padded(table.column("q").combine_chunks())
        lists = np.argsort(vectors, axis=0, kind="stable").astype("<i4").T
        cells = [table.column(c).to_numpy().astype("<i8").tobytes() for c in ("vec_id", "label")]
        row = [key[0].as_py(), *cells, vectors.astype("<i4").tobytes(), np.ascontiguousarray(lists).tobytes(), vectors.shape[1]]
        return pa.table([pa.array([v], f.type) for v, f in zip(row, _schema(_SHARD))], schema=_schema(_SHARD))

    ship(rows.sparkSession)
    # Hashes spread the ids evenly, so a shard has about shard_rows rows.
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int"))
    return dealt.groupBy("shard").applyInArrow(pack, _SHARD)


def _schema(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "double": pa.float64()}
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split() for part in ddl.split(", "))])


def padded(arrays: pa.Array, width: int = 0) -> np.ndarray:
    """A list column as a matrix of int64, short rows filled with zeros."""
    sizes = np.diff(arrays.offsets.to_numpy())
    width = max(width, int(sizes.max(initial=0)))
    out = np.zeros((len(arrays), width), np.int64)
    at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[np.repeat(np.arange(len(arrays)), sizes), at] = arrays.flatten().to_numpy(zero_copy_only=False)
    return out


class Shard:
    """Candidates with one sorted list for each dimension."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, lists: np.ndarray | None = None):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        self.lists = np.argsort(vectors, axis=0, kind="stable").T if lists is None else lists
        self.met = np.zeros(len(ids), bool)
        self.doubles = vectors.astype(np.float64)
        self.most = int(np.abs(vectors).max(initial=0))

    def search(self, anchor: np.ndarray, allowed: np.ndarray, low: np.ndarray, high: np.ndarray, k: int) -> tuple[list[np.ndarray], np.ndarray, int]:
        """For each window [low, high] the first k allowed rows, the scores of all rows met, and their number."""
        n = len(self.ids)
        anchor = anchor[: self.vectors.shape[1]]
        used = np.flatnonzero(anchor)
        weights, up = anchor[used], anchor[used] > 0
        # Whole numbers below 2^53 are exact as doubles, whose products are fast; larger ones stay integers.
        exact = self.most * int(np.abs(anchor).max(initial=0)) * len(anchor) < 1 << 53
        table = self.doubles if exact else self.vectors
        factor = anchor.astype(table.dtype)
        scores = np.zeros(n, np.int64)
        met = self.met
        met[:] = False
        best: list[np.ndarray] = [np.empty(0, np.int64) for _ in low]
        depth, step = 0, FIRST_DEPTH
        while depth < n:
            stop = min(n, depth + step)
            if len(used):
                top, low_end = self.lists[used[up], n - stop : n - depth], self.lists[used[~up], depth:stop]
                fresh = np.zeros(n, bool)
                fresh[top] = True
                fresh[low_end] = True
                fresh = np.flatnonzero(fresh & ~met)
                threshold = int(weights[up] @ self.vectors[top[:, 0], used[up]] + weights[~up] @ self.vectors[low_end[:, -1], used[~up]])
            else:  # every score is zero
                fresh, stop, threshold = np.arange(n), n, 0
            met[fresh] = True
            scores[fresh] = (table[fresh][:, : len(anchor)] @ factor).astype(np.int64)
            fresh = fresh[allowed[fresh]]
            got = scores[fresh]
            open_ = False
            for w in range(len(low)):
                bar = scores[best[w][k - 1]] if len(best[w]) == k else low[w]
                near = (got >= bar) & (got <= high[w])
                if near.any():
                    best[w] = self._first(np.concatenate([best[w], fresh[near]]), scores, k)
                    bar = scores[best[w][k - 1]] if len(best[w]) == k else low[w]
                open_ |= threshold >= bar
            depth, step = stop, step * 2
            if not open_ or met.all():
                break
        return best, scores, int(met.sum())

    def _first(self, rows: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
        """The k first of ``rows`` in order of score and id."""
        if len(rows) > k:
            own = scores[rows]
            rows = rows[own >= np.partition(own, len(own) - k)[len(own) - k]]
        return rows[np.lexsort((self.ids[rows], -scores[rows]))[:k]]


def _search(tasks: DataFrame, same: bool, k: int, out: str) -> DataFrame:
    """Rows of ``tasks`` (a shard and a block of anchors) to the first k candidates of each window."""

    def run(key, table):
        task = table.to_pylist()[0]
        ids, width = np.frombuffer(task["ids"], "<i8"), task["width"]
        vectors = np.frombuffer(task["vectors"], "<i4").reshape(len(ids), width).astype(np.int64)
        lists = np.frombuffer(task["lists"], "<i4").reshape(width, len(ids))
        shard = Shard(ids, np.frombuffer(task["labels"], "<i8"), vectors, lists)
        found: list[list[np.ndarray]] = [[np.empty(0, np.int64)] * 5]
        for anchor in task["anchors"]:
            own = shard.labels == anchor["label"]
            allowed = own & (ids != anchor["vec_id"]) if same else ~own
            windows = anchor["windows"]
            low, high, names = (np.array([w[c] for w in windows], np.int64) for c in ("low", "high", "name"))
            best, scores, _ = shard.search(np.array(anchor["q"], np.int64), allowed, low, high, k)
            for w, rows in enumerate(best):
                n = len(rows)
                found.append([np.full(n, anchor["vec_id"]), np.full(n, names[w]), np.full(n, high[w]), ids[rows], scores[rows]])
        return pa.table([pa.array(np.concatenate(c), pa.int64()) for c in zip(*found)], schema=_schema(out))

    ship(tasks.sparkSession)
    # A group is one task: a shard and a block of anchors, so that no batch holds several shards.
    return tasks.groupBy("shard", "block").applyInArrow(run, out)


def first_in_windows(anchors: DataFrame, shards: DataFrame, same: bool, k: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(anchor_id, name, high, vec_id, score, nth): for each window the first k candidates of all shards.

    ``anchors``: vec_id, label, q, windows (an array of low, high, name).
    """
    blocks = max(1, -(-anchors.count() // block_rows))
    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block")
    # About block_rows anchors a block.
    held = anchors.groupBy(block).agg(F.collect_list(F.struct("vec_id", "label", "q", "windows")).alias("anchors"))
    meets = shards.select("shard").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    tasks = meets.join(held, "block").join(shards, "shard")
    found = _search(tasks, same, k, "anchor_id long, name long, high long, vec_id long, score long")
    order = Window.partitionBy("anchor_id", "name").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k)


def mine(
    rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low_percent: int = 50, high_percent: int = 95,
    shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows``: (vec_id, label, q) as from :func:`integer_rows`.  A negative n of a
    positive p has low_percent * p <= 100 * n <= high_percent * p, so a negative
    p can have negatives only if the percentages allow it.
    """
    rows = stage(rows, "negatives-rows")
    shards = stage(make_shards(rows, shard_rows), "negatives-shards")
    anchors = rows.where(is_anchor)
    far = 1 << 62
    every = F.array(F.struct(*[F.lit(v).cast("long").alias(c) for c, v in (("low", -far), ("high", far), ("name", 0))]))
    near = first_in_windows(anchors.withColumn("windows", every), shards, True, positives, block_rows)
    near = stage(near.select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "negatives-near")
    # The least and greatest whole score of a window; div rounds towards zero, so remainders are looked at.
    p = F.col("positive_score")
    down = lambda v: F.expr("{} div 100".format(v)) - F.when(F.expr(f"pmod({v}, 100) <> 0 and {v} < 0"), 1).otherwise(0)
    low, high = -down(f"(-{low_percent} * positive_score)"), down(f"({high_percent} * positive_score)")
    window = F.struct(low.alias("low"), high.alias("high"), F.col("positive_id").alias("name"))
    wanted = near.where(low <= high).groupBy("anchor_id").agg(F.collect_list(window).alias("windows"))  # at most ``positives``
    asked = anchors.join(wanted.withColumnRenamed("anchor_id", "vec_id"), "vec_id")
    found = first_in_windows(asked, shards, False, negatives, block_rows)
    pairs = near.withColumnRenamed("positive_id", "name")
    return found.join(pairs, ["anchor_id", "name"]).select(
        "anchor_id",
        F.col("name").alias("positive_id"),
        F.col("nth").alias("rank"),
        F.col("vec_id").alias("negative_id"),
        p.alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
