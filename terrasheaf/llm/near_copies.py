"""Near copies: SimHash candidates from the Gray-order index, confirmed on shingle sets.

A document has PRINTS fingerprints of its set of shingles.  Each is cut into
BLOCKS blocks; documents that agree in a block meet in a bucket, where the
Gray-order index (``simhash.GrayIndex``) finds the codes at most MOST bits apart.
A pair is a candidate if this and the next four fingerprints together differ in at
most TOTAL bits and the sizes of its sets allow the similarity.  It links only if
the Jaccard similarity of the two whole shingle sets reaches ``least``.

A bucket proposes, for each set of documents linked so far, its nearest candidate
outside, and so at most some links a document and not all pairs of a group.
Where a proposal between two components of the confirmed links is refused, the
bucket is searched again with those components: rows that have a candidate in
another component meet with their whole sets, and all candidates between two
components are compared where they meet.  So a refused link hides no other, pairs
inside a component are never compared, and a search gives at most two links for a
row, however many pairs it compares.  The sets that meet are at most about
2 * PART_BYTES: those of a fuller bucket are dealt to parts, and each two parts meet.

Two documents at Jaccard similarity 0.8 (five-word shingles) differ in 15 % of
their bits, agree in one block of 16 bits with probability 0.07, and in one of the
40 blocks within MOST and TOTAL with probability 0.94; at 0.85 with 0.99.

Defined cases: a null or empty text has an empty set, equal to any other empty
one; a text with fewer words than a shingle is one shingle; texts are read whole,
whatever their length; repeated rows and copies have one fingerprint and are
compared once; rows without a doc_id take no part; an empty table gives an empty
result; columns other than doc_id and text are only carried along.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import simhash
from .common import connected_components, filter_test, key_hashes, map_texts, merge_labels, ship, stage, words_of

PRINTS, BLOCKS, MOST, TOTAL = 10, 4, 12, 57
TESTED = 5  # fingerprints that TOTAL adds up
LEAST = 0.8
FRONTIER = 1 << 18  # (code, leaf) pairs looked at together
PART_BYTES = 16 << 20  # bytes of the sets of a bucket above which they are dealt to parts
COMPARED = 1 << 12  # pairs compared before their links join the components of a bucket


# ---------------------------------------------------------------- shingle sets


def shingle_set(text: str | None, shingle: int = 5) -> np.ndarray:
    """Sorted distinct XXH64 hashes of the word shingles of a text."""
    words = words_of(text)
    if not words:
        return np.empty(0, np.uint64)
    line = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    n = max(1, len(words) - shingle + 1)
    digest, seed = xxhash.xxh64_intdigest, simhash.SEED
    places = zip((ends - sizes)[:n].tolist(), ends[-n:].tolist())
    return np.unique(np.fromiter((digest(line[a:b], seed) for a, b in places), np.uint64, n))


def fingerprints_of(sets: list[np.ndarray], prints: int = PRINTS) -> np.ndarray:
    """Fingerprints (signed, one row a set) of shingle sets.

    Bits are counted in eight byte lanes of a word at a time, so a set is summed in
    runs of at most 255 hashes first.
    """
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    out = np.zeros((len(sets), prints), np.int64)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    hashes, sizes = np.concatenate(sets), sizes[full]
    runs = -(-sizes // 255)
    first = np.cumsum(runs) - runs
    nth = np.arange(runs.sum()) - np.repeat(first, runs)
    start = np.repeat(np.cumsum(sizes) - sizes, runs) + 255 * nth
    lanes = np.uint64(0x0101010101010101)
    for k in range(prints):
        mixed = simhash._mixed(hashes, k) if k else hashes
        code = np.zeros(len(full), np.uint64)
        for bit in range(8):
            sums = np.add.reduceat(mixed >> np.uint64(bit) & lanes, start).astype("<u8").view(np.uint8).reshape(-1, 8)
            most = 2 * np.add.reduceat(sums, first, axis=0, dtype=np.int64) > sizes[:, None]
            code |= most.astype(np.uint8).view("<u8").ravel() << np.uint64(bit)
        out[full, k] = code.view(np.int64)
    return out


def marked(docs: DataFrame, shingle: int = 5) -> DataFrame:
    """(doc_id, ident, size, fps) of every row with a doc_id; ident names the row's id and text."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets = [shingle_set(t, shingle) for t in batch.column(2).to_pylist()]
            fps = fingerprints_of(sets)
            fps = pa.ListArray.from_arrays(np.arange(0, fps.size + 1, PRINTS, np.int32), fps.ravel())
            size = pa.array([len(s) for s in sets], pa.int32())
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), size, fps], ["doc_id", "ident", "size", "fps"])

        return step

    kind = docs.schema["doc_id"].dataType.simpleString()
    columns = {c: c for c in ("doc_id", "ident", "text")}
    return map_texts(_named_rows(docs), columns, f"doc_id {kind}, ident long, size int, fps array<long>", make)


def _named_rows(docs: DataFrame) -> DataFrame:
    return docs.where("doc_id is not null").select("doc_id", F.xxhash64("doc_id", "text").alias("ident"), "text")


def _whole_sets(docs: DataFrame, nodes: DataFrame, codes: DataFrame, shingle: int) -> DataFrame:
    """(node, hashes): the whole shingle set of each of ``nodes`` (node, each once).

    Only documents of these are read into sets; the Bloom filter keeps the others from moving.
    """
    wanted = stage(nodes.join(codes.select("node", "ident"), "node"), "near-wanted")
    possible = filter_test(docs.sparkSession, wanted.select(*[h.alias(n) for h, n in zip(key_hashes(F.col("ident")), ("h1", "h2"))]))

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets = [shingle_set(t, shingle).view(np.int64) for t in batch.column(1).to_pylist()]
            flat = np.concatenate([*sets, np.empty(0, np.int64)])
            offsets = np.cumsum([0, *map(len, sets)], dtype=np.int32)
            return pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, flat)], ["ident", "hashes"])

        return step

    met = _named_rows(docs).where(possible(*key_hashes(F.col("ident"))))
    sets = map_texts(met, {"ident": "ident", "text": "text"}, "ident long, hashes array<long>", make)
    return stage(wanted.join(sets, "ident").dropDuplicates(["node"]).select("node", "hashes"), "near-sets")


def _similar(docs: DataFrame, pairs: DataFrame, codes: DataFrame, shingle: int, least: float) -> DataFrame:
    """(a, b, similar) for pairs (a, b) of nodes: whether their whole shingle sets are similar enough."""
    sets = _whole_sets(docs, pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), codes, shingle)
    one, two = (sets.select(F.col("node").alias(n), F.col("hashes").alias(f"h{n}")) for n in ("a", "b"))
    both = F.size(F.array_intersect("ha", "hb"))
    # An empty set is like another empty one.
    judged = both >= F.lit(least) * (F.size("ha") + F.size("hb") - both)
    return pairs.join(one, "a").join(two, "b").select("a", "b", judged.alias("similar"))


# ------------------------------------------------------------------ candidates


def _near_pairs(
    bucket: np.ndarray, codes: np.ndarray, size: np.ndarray, lab: np.ndarray, least: float, most: int, total: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Candidates (i, j, bits apart) between two sets of ``lab``, a part of the rows at a time.

    Rows are in Gray order within a bucket.  The caller may join sets of ``lab`` between two parts.
    """
    n = len(bucket)
    index = simhash.GrayIndex(bucket, codes[:, 0])
    load = np.cumsum(index.leaves)
    item, begin = np.arange(n), 0
    while begin < n:
        stop = max(begin + 1, int(np.searchsorted(load, (load[begin - 1] if begin else 0) + FRONTIER, "right")))
        i, j = index._near(np.arange(begin, stop), most, item, lab)
        near = (np.minimum(size[i], size[j]) >= least * np.maximum(size[i], size[j])) & (lab[i] != lab[j])
        i, j = i[near], j[near]
        apart = np.zeros(len(i), np.int64)
        for k in range(codes.shape[1]):
            apart += np.bitwise_count(codes[i, k] ^ codes[j, k])
        near = apart <= total
        yield i[near], j[near], apart[near]
        begin = stop


def _set_roots(bucket: np.ndarray, label: np.ndarray) -> np.ndarray:
    """The place of one row of each (bucket, label), for each row."""
    n = len(bucket)
    by_label = np.lexsort((np.arange(n), label, bucket))
    fresh = np.r_[True, (np.diff(bucket[by_label]) != 0) | (np.diff(label[by_label]) != 0)]
    lab = np.empty(n, np.int64)
    lab[by_label] = by_label[np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
    return lab


def _barred(bucket: np.ndarray, node: np.ndarray, refused: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """The refused pairs (bucket, node, node) as lesser place * rows + greater place."""
    n, names = len(bucket), np.unique(node)
    buckets, rank = np.unique(bucket, return_inverse=True)
    at = rank * len(names) + np.searchsorted(names, node)
    by_node = np.argsort(at)
    place = np.searchsorted(buckets, refused[0]) * len(names)
    ends = [by_node[np.searchsorted(at[by_node], place + np.searchsorted(names, r))] for r in refused[1:]]
    return np.unique(np.minimum(*ends) * n + np.maximum(*ends))


def propose(
    bucket: np.ndarray,
    codes: np.ndarray,
    size: np.ndarray,
    label: np.ndarray,
    node: np.ndarray,
    refused: tuple[np.ndarray, np.ndarray, np.ndarray],
    width: int,
    least: float = LEAST,
    most: int = MOST,
    total: int = TOTAL,
) -> tuple[np.ndarray, np.ndarray]:
    """Candidate pairs (places of rows) that join the sets of each bucket, nearest first.

    ``codes`` has one row of fingerprints for each bucket row, the first being the
    bucket's; rows of one bucket and label are joined already; ``refused`` holds
    (bucket, node, node) not to be proposed again.  ``width`` is the greatest number
    of proposals a set at a time; with a width of 0 all candidates are proposed.
    """
    order = np.lexsort((simhash.gray_rank(codes[:, 0]), bucket))
    bucket, codes, size, label, node = bucket[order], codes[order], size[order], label[order], node[order]
    n, lab, barred, found = len(bucket), _set_roots(bucket, label), _barred(bucket, node, refused), []
    for i, j, apart in _near_pairs(bucket, codes, size, lab, least, most, total):
        near = ~np.isin(i * n + j, barred)
        i, j, apart = i[near], j[near], apart[near]
        if not width:
            found.append((i, j))
        while width:
            cross = lab[i] != lab[j]
            i, j, apart = i[cross], j[cross], apart[cross]
            if not len(i):
                break
            by = np.lexsort((apart, lab[i]))
            of = lab[i][by]
            first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
            nth = np.arange(len(by)) - np.repeat(first, np.diff(np.r_[first, len(by)]))
            picked = by[nth < width]
            found.append((i[picked], j[picked]))
            merge_labels(lab, i[picked], j[picked])
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(order[np.concatenate(side)] for side in zip(*found))


def contested(
    bucket: np.ndarray,
    codes: np.ndarray,
    size: np.ndarray,
    label: np.ndarray,
    node: np.ndarray,
    refused: tuple[np.ndarray, np.ndarray, np.ndarray],
    least: float = LEAST,
    most: int = MOST,
    total: int = TOTAL,
) -> np.ndarray:
    """Which rows have a candidate in another set of their bucket that is not ``refused`` (see ``propose``)."""
    order = np.lexsort((simhash.gray_rank(codes[:, 0]), bucket))
    bucket, codes, size, label, node = bucket[order], codes[order], size[order], label[order], node[order]
    n, lab, barred, met = len(bucket), _set_roots(bucket, label), _barred(bucket, node, refused), np.zeros(len(bucket), bool)
    for i, j, _ in _near_pairs(bucket, codes, size, lab, least, most, total):
        near = ~np.isin(i * n + j, barred)
        met[order[i[near]]] = met[order[j[near]]] = True
    return met


def shared(first: np.ndarray, hashes: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many hashes the sets ``i`` and ``j`` have in common; set k is hashes[first[k]:first[k + 1]].

    ``hashes`` are small numbers; those of one set are marked, and looked up for all its partners.
    """
    out = np.zeros(len(i), np.int64)
    if not len(i):
        return out
    by = np.argsort(i, kind="stable")
    heads = np.flatnonzero(np.r_[True, np.diff(i[by]) != 0])
    marks = np.zeros(int(hashes.max(initial=0)) + 1, bool)
    for lo, hi in zip(heads, np.r_[heads[1:], len(by)]):
        pairs = by[lo:hi]
        own = hashes[first[i[pairs[0]]] : first[i[pairs[0]] + 1]]
        marks[own] = True
        sizes = first[j[pairs] + 1] - first[j[pairs]]
        ends = np.cumsum(sizes)
        places = np.arange(ends[-1]) + np.repeat(first[j[pairs]] - (ends - sizes), sizes)
        sums = np.r_[0, np.cumsum(marks[hashes[places]])]
        out[pairs] = sums[ends] - sums[ends - sizes]
        marks[own] = False
    return out


def confirm(
    bucket: np.ndarray,
    codes: np.ndarray,
    size: np.ndarray,
    label: np.ndarray,
    first: np.ndarray,
    hashes: np.ndarray,
    least: float = LEAST,
    most: int = MOST,
    total: int = TOTAL,
) -> tuple[np.ndarray, np.ndarray]:
    """Links (places of rows) between the sets of each bucket: candidates whose shingle sets are similar.

    The set of row k is hashes[first[k]:first[k + 1]].  Every candidate that no link joined
    before is compared; of the similar ones those are given that join components.
    """
    order = np.lexsort((simhash.gray_rank(codes[:, 0]), bucket))
    bucket, codes, size, label = bucket[order], codes[order], size[order], label[order]
    lab, counts = _set_roots(bucket, label), np.diff(first)
    small = np.unique(hashes, return_inverse=True)[1]
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for i, j, _ in _near_pairs(bucket, codes, size, lab, least, most, total):
        while len(i):
            cross = lab[i] != lab[j]
            i, j = i[cross], j[cross]
            a, b, i, j = i[:COMPARED], j[:COMPARED], i[COMPARED:], j[COMPARED:]
            both = shared(first, small, order[a], order[b])
            like = both >= least * (counts[order[a]] + counts[order[b]] - both)
            a, b = a[like], b[like]
            while len(a):
                picked = np.unique(lab[a], return_index=True)[1]
                found.append((order[a[picked]], order[b[picked]]))
                merge_labels(lab, a[picked], b[picked])
                cross = lab[a] != lab[b]
                a, b = a[cross], b[cross]
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(side) for side in zip(*found))


def _deal(codes: DataFrame, bucket_rows: int) -> DataFrame:
    """(key, node, size, codes): every node once for each block of each fingerprint.

    A bucket of more than ``bucket_rows`` rows is dealt again by MOST + 1 blocks of
    the rotated code, so that pairs within MOST bits still meet.
    """
    around = F.concat("fps", F.slice("fps", 1, TESTED - 1))
    each = codes.select("node", "size", around.alias("around"), F.posexplode("fps").alias("nth", "code"))
    each = each.select("node", "size", F.slice("around", F.col("nth") + 1, TESTED).alias("codes"), "nth", "code")
    keyed = each.withColumn("key", F.explode(simhash._block_keys(F.col("code"), BLOCKS - 1, F.col("nth"))))
    hot = stage(keyed.groupBy("key").count().where(F.col("count") > bucket_rows).select("key"), "near-hot")
    if hot.limit(1).count():
        turned = F.shiftleft("code", 5).bitwiseOR(F.shiftrightunsigned("code", simhash.BITS - 5))
        again = keyed.join(hot, "key", "left_semi").withColumn("key", F.explode(simhash._block_keys(turned, MOST, F.col("key"))))
        keyed = keyed.join(hot, "key", "left_anti").unionByName(again)
    return keyed.select("key", "node", "size", "codes")


def _by_bucket(batches: Iterator[pa.RecordBatch], most_rows: int, most_bytes: int) -> Iterator[pa.Table]:
    """Rows in order of their first column, cut between two of its values where they are many."""
    kept: list[pa.RecordBatch] = []
    rows = held = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        kept.append(batch)
        rows, held = rows + batch.num_rows, held + batch.nbytes
        last = batch.column(0)[-1].as_py()
        # The last bucket may go on in the next batch.
        if (rows > most_rows or held > most_bytes) and last != kept[0].column(0)[0].as_py():
            whole = pa.Table.from_batches(kept)
            cut = int(np.searchsorted(whole.column(0).to_numpy(), last))
            yield whole.slice(0, cut)
            kept = whole.slice(cut).to_batches()
            rows, held = sum(b.num_rows for b in kept), sum(b.nbytes for b in kept)
    if rows:
        yield pa.Table.from_batches(kept)


def _arrays(table: pa.Table) -> tuple[np.ndarray, ...]:
    """Columns key, node, size, codes and label of bucket rows."""
    key, node, size, label = (table.column(c).to_numpy() for c in ("key", "node", "size", "label"))
    return key, node, size, table.column("codes").combine_chunks().flatten().to_numpy().reshape(len(key), -1), label


def _proposals(rows: DataFrame, least: float) -> DataFrame:
    """(key, a, b) from bucket rows (key, node, size, codes, label): a set's nearest candidate in another."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = (np.empty(0, np.int64),) * 3
        for table in _by_bucket(batches, simhash.BATCH_ROWS, 1 << 40):
            key, node, size, codes, label = _arrays(table)
            i, j = propose(key, codes.view(np.uint64), size, label, node, none, 1, least)
            low, high = np.minimum(node[i], node[j]), np.maximum(node[i], node[j])
            yield pa.RecordBatch.from_arrays([pa.array(key[i]), pa.array(low), pa.array(high)], ["key", "a", "b"])

    ship(rows.sparkSession)
    dealt = rows.select("key", "node", "size", "codes", "label").repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(search, "key long, a long, b long")


def _contested(rows: DataFrame, least: float) -> DataFrame:
    """The bucket rows that have a candidate in another set; rows of size -1 bar node and codes[0]."""

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _by_bucket(batches, simhash.BATCH_ROWS, 1 << 40):
            key, node, size, codes, label = _arrays(table)
            code = size >= 0
            bar = ~code & np.isin(key, key[code])  # of buckets that are searched again
            met = np.zeros(len(key), bool)
            met[code] = contested(key[code], codes[code].view(np.uint64), size[code], label[code], node[code], (key[bar], node[bar], codes[bar, 0]), least)
            yield from table.filter(pa.array(met)).to_batches()

    ship(rows.sparkSession)
    dealt = rows.select("key", "node", "size", "codes", "label").repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(choose, "key long, node long, size int, codes array<long>, label long")


def _links(rows: DataFrame, sets: DataFrame, least: float, part_bytes: int) -> DataFrame:
    """(a, b): links that join the sets of the buckets of ``rows``, whose shingle sets are ``sets`` (node, hashes).

    A bucket with more than ``part_bytes`` of sets is dealt to parts; every two of them are a bucket.
    """
    parts = stage(rows.groupBy("key").agg(F.ceil(F.sum(8.0 * F.col("size")) / part_bytes).cast("int").alias("parts")).where("parts > 1"), "near-parts")
    dealt = rows.join(parts, "key", "left").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")))
    others = F.expr("filter(sequence(0L, cast(parts - 1 as bigint)), p -> p <> part)")
    dealt = dealt.withColumn("other", F.explode(F.coalesce(others, F.array(F.lit(None).cast("long")))))
    two = F.when(F.col("parts").isNotNull(), F.xxhash64("key", F.least("part", "other"), F.greatest("part", "other"))).otherwise(F.col("key"))
    dealt = dealt.select(two.alias("key"), "node", "size", "codes", "label").join(sets, "node")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _by_bucket(batches, simhash.BATCH_ROWS, part_bytes):
            key, node, size, codes, label = _arrays(table)
            hashes = table.column("hashes").combine_chunks()
            first = np.r_[0, np.cumsum(np.diff(hashes.offsets.to_numpy()))]
            i, j = confirm(key, codes.view(np.uint64), size, label, first, hashes.flatten().to_numpy(), least)
            low, high = np.minimum(node[i], node[j]), np.maximum(node[i], node[j])
            yield pa.RecordBatch.from_arrays([pa.array(low), pa.array(high)], ["a", "b"])

    ship(rows.sparkSession)
    dealt = dealt.select("key", "node", "size", "codes", "label", "hashes").repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(compare, "a long, b long").distinct()


def _grown(tree: DataFrame | None, links: DataFrame) -> DataFrame:
    """(node, root) of the components that ``links`` (a, b) make of those of ``tree``.

    Links meet as links between roots, so that what was joined before is not joined again.
    """
    if tree is None:
        return stage(connected_components(links), "near-labels")
    for side in ("a", "b"):
        known = tree.select(F.col("node").alias(side), "root")
        links = links.join(known, side, "left").withColumn(side, F.coalesce("root", side)).drop("root")
    moved = stage(connected_components(links), "near-moved")
    old = tree.join(moved.select(F.col("node").alias("root"), F.col("root").alias("to")), "root", "left")
    fresh = moved.join(tree, "node", "left_anti")
    return stage(old.select("node", F.coalesce("to", "root").alias("root")).union(fresh.select("node", "root")), "near-labels")


def _between(pairs: DataFrame, tree: DataFrame) -> DataFrame:
    """The rows of ``pairs`` (a, b, more) whose nodes are not in one component of ``tree``."""
    named = pairs
    for side in ("a", "b"):
        known = tree.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}"))
        named = named.join(known, side, "left").withColumn(f"root_{side}", F.coalesce(f"root_{side}", side))
    return named.where("root_a <> root_b").select(*pairs.columns)


def confirmed_tree(
    docs: DataFrame, codes: DataFrame, shingle: int, least: float, bucket_rows: int, part_bytes: int = PART_BYTES
) -> DataFrame:
    """(node, root) of the components that all similar candidates make; nodes without a link have no row."""
    keyed = _deal(codes, bucket_rows)
    found = stage(_proposals(keyed.withColumn("label", F.col("node")), least), "near-found")
    judged = stage(_similar(docs, found.select("a", "b").distinct(), codes, shingle, least), "near-judged")
    tree = _grown(None, judged.where("similar").select("a", "b"))
    # A refused pair whose nodes other links have joined hides nothing.
    refused = found.join(judged.where("not similar"), ["a", "b"]).select("key", "a", "b")
    refused = stage(_between(refused, tree), "near-refused")
    if not refused.limit(1).count():
        return tree
    again = refused.select("key").distinct()
    rows = keyed.join(again, "key", "left_semi").join(tree, "node", "left").withColumn("label", F.coalesce("root", "node"))
    filler = F.array(F.col("b"), *[F.lit(0).cast("long")] * (TESTED - 1))
    barred = refused.select(
        "key", F.col("a").alias("node"), F.lit(-1).alias("size"), filler.alias("codes"), F.lit(0).cast("long").alias("label")
    )
    # Written before they are dealt: Spark 4.1 can take a union of two joins by key for dealt by key already,
    # and then the adaptive planner may part the two sides differently.
    rows = stage(rows.select("key", "node", "size", "codes", "label").union(barred), "near-open")
    rows = stage(_contested(rows, least), "near-contested")
    sets = _whole_sets(docs, rows.select("node").distinct(), codes, shingle)
    return _grown(tree, _links(rows, sets, least, part_bytes))


def near_copies(
    docs: DataFrame, shingle: int = 5, least: float = LEAST, bucket_rows: int = simhash.BUCKET_ROWS, part_bytes: int = PART_BYTES
) -> DataFrame:
    """(doc_id, component_id) of every row of ``docs`` with a doc_id; component_id is the smallest doc_id reached."""
    found = stage(marked(docs, shingle).withColumn("node", F.xxhash64("fps", "size")), "near-prints")
    codes = stage(found.groupBy("node", "size", "fps").agg(F.min("doc_id").alias("least"), F.min("ident").alias("ident")), "near-codes")
    tree = confirmed_tree(docs, codes, shingle, least, bucket_rows, part_bytes)
    return simhash.named_components(found.select("doc_id", "node"), codes, tree)


def deduplicate(docs: DataFrame, shingle: int = 5, least: float = LEAST) -> DataFrame:
    """The rows of ``docs`` that stay: one of each group of near copies, with all columns."""
    return simhash.keep_one(docs, near_copies(docs, shingle, least))
