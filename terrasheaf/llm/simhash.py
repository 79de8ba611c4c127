"""SimHash near-dedup with a Gray-order hierarchical index.

Fingerprints are computed per document in Arrow batches, distinct fingerprints
are dealt to buckets in which a pair within the distance must meet, and each
bucket is searched through a hierarchical index: fingerprints in Gray order,
equal bits of neighbours factored into upper nodes, whole groups pruned by the
differences accumulated from the root.  Buckets yield spanning links only, so a
dense group never makes all its pairs.

Several fingerprints per document (``prints``) sharpen the estimate: two
documents link if one of their fingerprints differs in at most ``most`` bits and
all of them together in at most ``total``.  With one fingerprint the first
condition is all there is.

Defined cases: a null or empty text has no shingle and fingerprint zero, linked
like any other; a text with fewer words than a shingle is one shingle; repeated
rows have equal fingerprints and fall into one component; a null doc_id is
carried along and never is a component's name unless all of them are null; an
empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import connected_components, filter_test, key_hashes, map_texts, merge_labels, ship, stage, words_of

BITS, SEED = 64, 42
LEAF, FANOUT = 16, 8
FRONTIER = 1 << 21  # (query, leaf) pairs looked at together
BATCH_ROWS = 1 << 18  # bucket rows indexed together
BUCKET_ROWS = 1 << 16  # codes above which a bucket is dealt again


# ---------------------------------------------------------------- fingerprints


def fingerprint_of(text: str | None, shingle: int, prints: int = 1) -> list[int]:
    """The 64-bit fingerprints of a text as signed integers.

    The first takes the shingle hashes as they are, the others mix them anew.
    """
    words = words_of(text)
    if not words:
        return [0] * prints
    line = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    n = max(1, len(words) - shingle + 1)
    first, last = (ends - sizes)[:n].tolist(), ends[-n:].tolist()
    counts = np.zeros((prints, BITS), np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, 1 << 16):
        part = [digest(line[a:b], SEED) for a, b in zip(first[at : at + (1 << 16)], last[at : at + (1 << 16)])]
        hashes = np.array(part, "<u8")
        for k in range(prints):
            octets = (_mixed(hashes, k) if k else hashes).view(np.uint8).reshape(-1, 8)
            counts[k] += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(2 * counts > n, axis=1, bitorder="little").view("<i8").ravel().tolist()


def _mixed(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes that do not depend on each other for different ``k``."""
    x = hashes ^ np.uint64(0x9E3779B97F4A7C15 * k % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def fingerprints(
    docs: DataFrame, shingle: int = 4, prints: int = 1, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, fp, more): the first fingerprint and an array of the others, one row per input row."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            fps = [fingerprint_of(t, shingle, prints) for t in batch.column(1).to_pylist()]
            more = pa.array([f[1:] for f in fps], pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array([f[0] for f in fps], pa.int64()), more], ["doc_id", "fp", "more"])

        return step

    kind = docs.schema[id_col].dataType.simpleString()
    return map_texts(docs, {"doc_id": id_col, "text": text_col}, f"doc_id {kind}, fp long, more array<long>", make)


# ----------------------------------------------------------------------- index


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each code word in the binary-reflected Gray sequence."""
    rank = codes.copy()
    for s in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(s)
    return rank


class GrayIndex:
    """Hierarchical index over buckets of fingerprints.

    ``bucket`` numbers are non-decreasing and ``codes`` are in Gray order within
    a bucket.  ``levels[0]`` are leaves of LEAF codes, each further level groups
    FANOUT nodes, and the last has one node per bucket.  A node keeps the bits
    that all its codes share but its parent does not have yet.
    """

    def __init__(self, bucket: np.ndarray, codes: np.ndarray):
        self.codes = codes
        first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        ends = np.r_[first[1:], len(codes)]
        self.root = np.repeat(np.arange(len(first)), ends - first)
        starts, stops, width = first, ends, LEAF
        both, some, levels = codes, codes, []
        while True:
            count = -(-(stops - starts) // width)
            owner = np.repeat(np.arange(len(first)), count)
            nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
            lo = starts[owner] + nth * width
            hi = np.minimum(lo + width, stops[owner])
            both, some = np.bitwise_and.reduceat(both, lo), np.bitwise_or.reduceat(some, lo)
            levels.append({"lo": lo, "hi": hi, "mask": ~(both ^ some), "bits": both})
            if count.max() == 1:
                break
            stops = np.cumsum(count)
            starts, width = stops - count, FANOUT
        for low, up in zip(levels, levels[1:]):
            parent = np.repeat(np.arange(len(up["lo"])), up["hi"] - up["lo"])
            low["own"] = low["mask"] & ~up["mask"][parent]
            low["end"] = None
        levels[-1]["own"] = levels[-1]["mask"]
        levels[0]["end"] = levels[0]["hi"]
        for low, up in zip(levels, levels[1:]):
            up["end"] = low["end"][up["hi"] - 1]
        self.levels = levels
        self.leaves = np.bincount(self.root[levels[0]["lo"]], minlength=len(first))[self.root]

    def link(self, most: int, item: np.ndarray, lab: np.ndarray, whole: np.ndarray | None, total: int) -> None:
        """Union items whose codes differ in at most ``most`` bits (and all in ``whole`` in at most ``total``).

        ``item`` gives each code's place in ``lab``, the array of set roots.
        Groups that already are in the set of the query are skipped: they can
        add no connection.
        """
        load = np.cumsum(self.leaves)
        begin = 0
        while begin < len(self.codes):
            base = load[begin - 1] if begin else 0
            stop = max(begin + 1, int(np.searchsorted(load, base + FRONTIER, "right")))
            i, j = self._near(np.arange(begin, stop), most, item, lab)
            if whole is not None and len(i):
                near = np.bitwise_count(whole[i] ^ whole[j]).sum(axis=1) <= total
                i, j = i[near], j[near]
            if len(i):
                merge_labels(lab, item[i], item[j])
            begin = stop

    def _near(self, query, most, item, lab):
        """Pairs (i, j), i < j, of codes within the distance, for queries ``i``."""
        leaf = self.levels[0]
        sets = lab[item]
        low, high = np.minimum.reduceat(sets, leaf["lo"]), np.maximum.reduceat(sets, leaf["lo"])
        q, node, gone = query, self.root[query], np.zeros(len(query), np.uint8)
        for depth in range(len(self.levels) - 1, -1, -1):
            level = self.levels[depth]
            if depth < len(self.levels) - 1:
                up = self.levels[depth + 1]
                width = up["hi"][node] - up["lo"][node]
                start = np.repeat(up["lo"][node] - (np.cumsum(width) - width), width)
                q, gone = np.repeat(q, width), np.repeat(gone, width)
                node = start + np.arange(len(start))
            apart = np.bitwise_count((self.codes[q] ^ level["bits"][node]) & level["own"][node])
            gone = gone + apart
            keep = (gone <= most) & (level["end"][node] > q + 1)
            if depth == 0:
                keep &= (low[node] != sets[q]) | (high[node] != sets[q])
            q, node, gone = q[keep], node[keep], gone[keep]
        found = []
        for at in range(0, len(q), 1 << 16):
            a, n = q[at : at + (1 << 16)], node[at : at + (1 << 16)]
            places = leaf["lo"][n][:, None] + np.arange(LEAF)
            inside = (places < leaf["hi"][n][:, None]) & (places > a[:, None])
            places = np.minimum(places, len(self.codes) - 1)
            near = inside & (np.bitwise_count(self.codes[a][:, None] ^ self.codes[places]) <= most)
            r, c = np.nonzero(near)
            found.append((a[r], places[r, c]))
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def spanning_links(
    bucket: np.ndarray, codes: np.ndarray, most: int, node: np.ndarray, whole: np.ndarray | None = None, total: int = 0
) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, smaller node) that connect the same nodes as all links within buckets."""
    order = np.lexsort((gray_rank(codes), bucket))
    names, item = np.unique(node[order], return_inverse=True)
    lab = np.arange(len(names))
    GrayIndex(bucket[order], codes[order]).link(most, item, lab, None if whole is None else whole[order], total)
    child = np.flatnonzero(lab != np.arange(len(names)))
    return names[child], names[lab[child]]


def _block_keys(fp, most: int, salt):
    """One key per block of bits; codes within the distance share at least one.

    ``salt`` (the key of an earlier split, or none) is mixed into the keys.
    """
    edges = [round(BITS * k / (most + 1)) for k in range(most + 2)]
    parts = []
    for k, (lo, hi) in enumerate(zip(edges, edges[1:])):
        bits = F.shiftrightunsigned(fp, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1))
        parts.append(F.xxhash64(*([salt] if salt is not None else []), F.lit(k), bits))
    return F.array(*parts)


def links(codes: DataFrame, most: int = 4, total: int = 0, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Spanning links (a, b) between the distinct rows (node, fp, more) of ``codes``.

    By the pigeonhole rule two codes that differ in at most ``most`` bits agree
    in one of ``most + 1`` blocks of bits.  A bucket of more than
    ``bucket_rows`` codes is dealt again by the blocks of a rotated code, where
    the same rule holds, so nothing is lost by the split.
    """
    each = codes.select("node", F.array_insert("more", 1, F.col("fp")).alias("all"))
    each = each.select("node", "all", F.posexplode("all").alias("nth", "code"))
    keyed = each.select("node", "all", "code", F.explode(_block_keys(F.col("code"), most, F.col("nth"))).alias("key"))
    hot = stage(keyed.groupBy("key").count().where(F.col("count") > bucket_rows).select("key"), "simhash-hot")
    if hot.limit(1).count():
        turned = F.shiftleft("code", 5).bitwiseOR(F.shiftrightunsigned("code", BITS - 5))
        again = keyed.join(hot, "key", "left_semi").select(
            "node", "all", "code", F.explode(_block_keys(turned, most, F.col("key"))).alias("key")
        )
        keyed = keyed.join(hot, "key", "left_anti").select("node", "all", "code", "key").union(again)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[np.ndarray, ...]] = []
        rows = 0

        def flush(upto_last: bool):
            nonlocal kept, rows
            key, node, code, whole = (np.concatenate(c) for c in zip(*kept))
            cut = len(key) if upto_last else int(np.searchsorted(key, key[-1]))
            kept, rows = [(key[cut:], node[cut:], code[cut:], whole[cut:])], len(key) - cut
            if not cut:
                return None
            more = whole[:cut].view(np.uint64) if whole.shape[1] > 1 else None
            a, b = spanning_links(key[:cut], code[:cut].view(np.uint64), most, node[:cut], more, total)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            if batch.num_rows:
                n = batch.num_rows
                whole = batch.column(3).flatten().to_numpy().reshape(n, -1)
                kept.append((batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy(), whole))
                rows += n
            if rows > BATCH_ROWS and (out := flush(False)):
                yield out
        if rows and (out := flush(True)):
            yield out

    ship(codes.sparkSession)
    dealt = keyed.select("key", "node", "code", "all").repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(search, "a long, b long")


def components(prints: DataFrame, most: int = 4, total: int = 0, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(doc_id, fp, component_id) for rows (doc_id, fp, more).

    component_id is the smallest doc_id that links reach, the document's own included.
    """
    # A single fingerprint names itself; several are named by their hash.
    node = F.when(F.size("more") == 0, F.col("fp")).otherwise(F.xxhash64("fp", "more"))
    named = prints.select("doc_id", "fp", "more", node.alias("node"))
    codes = stage(named.groupBy("node", "fp", "more").agg(F.min("doc_id").alias("least")), "simhash-codes")
    tree = stage(connected_components(links(codes, most, total, bucket_rows)), "simhash-tree")
    return named_components(named, codes, tree).select("doc_id", "fp", "component_id")


def named_components(named: DataFrame, codes: DataFrame, tree: DataFrame) -> DataFrame:
    """Rows of ``named`` with component_id, the smallest ``least`` (of ``codes``) in their node's tree."""
    held = tree.join(codes.select("node", "least"), "node")
    least = stage(held.groupBy("root").agg(F.min("least").alias("component_id")), "simhash-least")
    linked = stage(tree.join(least, "root").select("node", "component_id"), "simhash-linked")
    names = stage(
        codes.join(linked, "node", "left").select("node", F.coalesce("component_id", "least").alias("component_id")),
        "simhash-names",
    )
    return named.join(names, "node").drop("node")


def keep_one(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay: one of each component of ``found`` (doc_id, component_id), with all columns.

    The document whose id names the component stays.  Rows that repeat one
    doc_id count as one document; of them the one with the smallest text hash
    stays.  Rows without a doc_id stay as they are.
    """
    # Ids to look at: those that go, and those on several rows, of which one stays.
    named = found.groupBy("doc_id").agg(F.count("*").alias("n"), F.max(F.col("doc_id") == F.col("component_id")).alias("stays"))
    odd = stage(named.where("n > 1 or not stays").select(F.col("doc_id").alias("_odd_id"), F.col("stays").alias("_stays")), "simhash-odd")
    names = docs.columns
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("whole"))
    h1, h2 = key_hashes(F.col("whole.doc_id"))
    possible = filter_test(docs.sparkSession, odd.select(*[h.alias(n) for h, n in zip(key_hashes(F.col("_odd_id")), ("h1", "h2"))]))
    # Only rows whose id may be odd are moved; all others pass where they are.
    tested = held.withColumn("maybe", possible(h1, h2))
    met = tested.where("maybe").join(odd, F.col("whole.doc_id") == F.col("_odd_id"), "left")
    by_id = W.partitionBy("whole.doc_id").orderBy(F.xxhash64("whole.text"), F.col("whole.text"))
    ranked = met.withColumn("nth", F.when(F.col("_odd_id").isNull(), 1).otherwise(F.row_number().over(by_id)))
    kept = ranked.where((F.col("nth") == 1) & F.coalesce("_stays", F.lit(True)))
    return tested.where("not maybe").select("whole.*").union(kept.select("whole.*"))
