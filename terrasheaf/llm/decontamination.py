"""Benchmark decontamination with suffix arrays over the training text.

The training text is cut into shards of whole documents.  Each task builds the
suffix array of its shard, over the suffixes that a benchmark window can match
at all, and binary-searches every benchmark suffix in it, one word deeper per
step; ranges give all verbatim matches, their places and the longest length.
Documents are read once and never shuffled.

Only the benchmark is sent to the tasks.  Its size is measured first: beyond
BLOCK_BYTES it is dealt into blocks, each searched in a pass of its own.

Defined cases: null and empty texts have no words and match nothing; an item of
fewer than ``window`` words is one window; repeated items count once; an item
without an id counts under the empty id; repeated documents are searched one by
one; empty tables give no match or no rows; other columns are not read.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts, stage

BLOCK_BYTES = 32 << 20
# Bytes of a word stay, A-Z are lowered, all others end a word.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_BUILT: dict[str, Benchmark] = {}


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_LETTERS).split() if text else []


class Benchmark:
    """Numbered words, items and window starts of one block of the benchmark."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.number: dict[bytes, int] = {}
        names: dict[str, int] = {}
        flat, starts, sizes, owner, left = [], [], [], [], []
        for name, text in items:
            words = words_of(text)
            if not words:
                continue
            item = names.setdefault(name, len(names))
            base, size = len(flat), min(window, len(words))
            flat += [self.number.setdefault(w, len(self.number) + 1) for w in words] + [0]
            for at in range(len(words) - size + 1):
                starts.append(base + at)
                sizes.append(size)
                owner.append(item)
                left.append(len(words) - at)
        self.names = list(names)
        self.flat = np.array(flat, np.int64)
        self.starts, self.sizes, self.owner, self.left = (np.array(x, np.int64) for x in (starts, sizes, owner, left))
        self.least = int(self.sizes.min()) if len(starts) else 0
        self.deepest = int(self.left.max()) if len(starts) else 0


def suffix_array(text: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """``places`` sorted by the ``depth`` words that follow each; 0 ends every match."""
    bits = max(1, int(text.max()).bit_length()) if len(text) else 1
    per = 62 // bits
    padded = np.r_[text, np.zeros(depth + per + 1, np.int64)]

    def packed(at: np.ndarray) -> np.ndarray:
        key = np.zeros(len(at), np.int64)
        for k in range(per):
            key = (key << bits) | padded[at + k]
        return key

    key = packed(places)
    order = np.argsort(key, kind="stable")
    places, key = places[order], key[order]
    group = np.cumsum(np.r_[False, key[1:] != key[:-1]]) if len(key) else key
    done = per
    while done < depth and len(places):
        same = np.r_[False, group[1:] == group[:-1]]
        tied = np.flatnonzero(same | np.r_[same[1:], False])
        # Suffixes that have ended are equal for every search; they need no order.
        tied = tied[padded[places[tied] + done - 1] > 0]
        if not len(tied):
            break
        key = packed(places[tied] + done)
        order = np.lexsort((key, group[tied]))
        places[tied], key = places[tied][order], key[order]
        sub = group[tied]
        fresh = np.zeros(len(places), bool)
        fresh[tied[1:]] = (key[1:] != key[:-1]) & (sub[1:] == sub[:-1])
        fresh[1:] |= group[1:] != group[:-1]
        group = np.cumsum(fresh)
        done += per
    return places


def _edge(text: np.ndarray, suffixes: np.ndarray, lo, hi, depth: int, word: np.ndarray, right: bool) -> np.ndarray:
    """In each sorted range, the first place whose word at ``depth`` is not below ``word``."""
    lo, hi = lo.copy(), hi.copy()
    while True:
        open_ = lo < hi
        if not open_.any():
            return lo
        mid = (lo + hi) >> 1
        at = np.minimum(suffixes[np.minimum(mid, len(suffixes) - 1)] + depth, len(text) - 1)
        below = (text[at] <= word) if right else (text[at] < word)
        lo = np.where(open_ & below, mid + 1, lo)
        hi = np.where(open_ & ~below, mid, hi)


def _spread(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges [lo, hi), and the range that each belongs to."""
    count = hi - lo
    at = np.repeat(lo - (np.cumsum(count) - count), count) + np.arange(count.sum())
    return at, np.repeat(np.arange(len(lo)), count)


def search_shard(texts: list[str | None], bench: Benchmark) -> list[tuple[int, list[tuple[int, int]], list[str], int]]:
    """For each document: words, hit spans (first word, end), items, longest match."""
    get = bench.number.get
    numbered, sizes = [], []
    for text in texts:
        words = words_of(text)
        sizes.append(len(words))
        numbered += [get(w, 0) for w in words]
        numbered.append(0)
    text = np.array(numbered, np.int64)
    first = np.cumsum([0, *[s + 1 for s in sizes]])[:-1]
    empty = [(s, [], [], 0) for s in sizes]
    if not len(text) or not len(bench.starts):
        return empty
    # Words of the benchmark in a row from each place on; shorter rows than the least window cannot match.
    stop = np.where(text == 0, np.arange(len(text)), len(text))
    row = np.minimum.accumulate(stop[::-1])[::-1] - np.arange(len(text))
    suffixes = suffix_array(text, np.flatnonzero(row >= bench.least), bench.deepest)
    if not len(suffixes):
        return empty
    hits = np.zeros(len(text) + 1, np.int64)
    pairs, longest, reach = [], np.zeros(len(sizes), np.int64), np.zeros(len(suffixes), np.int64)
    doc = np.repeat(np.arange(len(sizes)), np.array(sizes) + 1)
    query = np.arange(len(bench.starts))
    lo, hi = np.zeros(len(query), np.int64), np.full(len(query), len(suffixes), np.int64)
    for depth in range(bench.deepest):
        word = bench.flat[bench.starts[query] + depth]
        start = _edge(text, suffixes, lo, hi, depth, word, False)
        hi = _edge(text, suffixes, start, hi, depth, word, True)
        alive = (start < hi) & (bench.left[query] > depth)
        query, lo, hi = query[alive], start[alive], hi[alive]
        if not len(query):
            break
        deep = bench.sizes[query] <= depth + 1
        if deep.any():
            # Equal windows have equal ranges: each range is gone through once, whatever windows it answers.
            code, which = np.unique(lo[deep] * (len(suffixes) + 1) + hi[deep], return_inverse=True)
            at, _ = _spread(code // (len(suffixes) + 1), code % (len(suffixes) + 1))
            reach[at] = depth + 1
            now = bench.sizes[query[deep]] == depth + 1
            if now.any():
                ended, which = np.unique(which[now], return_inverse=True)
                at, nth = _spread(code[ended] // (len(suffixes) + 1), code[ended] % (len(suffixes) + 1))
                place = suffixes[at]
                np.add.at(hits, place, 1)
                np.add.at(hits, place + depth + 1, -1)
                # Distinct documents of each range with the distinct items of its windows.
                held = np.unique(nth * len(sizes) + doc[place])
                asked = np.unique(which * len(bench.names) + bench.owner[query[deep][now]])
                first_doc = np.searchsorted(held // len(sizes), np.arange(len(ended) + 1))
                rank = asked // len(bench.names)
                row_, of = _spread(first_doc[rank], first_doc[rank + 1])
                pairs.append(np.unique(held[row_] % len(sizes) * len(bench.names) + (asked % len(bench.names))[of]))
    if not pairs:
        return empty
    np.maximum.at(longest, doc[suffixes], reach)
    inside = np.r_[0, (np.cumsum(hits[:-1]) > 0).astype(np.int8), 0]
    begin, end = np.flatnonzero(np.diff(inside) == 1), np.flatnonzero(np.diff(inside) == -1)
    out = empty
    for d in np.unique(doc[begin]).tolist():
        out[d] = (sizes[d], [], [], int(longest[d]))
    for b, e in zip(begin.tolist(), end.tolist()):
        d = int(doc[b])
        out[d][1].append((b - int(first[d]), e - int(first[d])))
    for pair in np.unique(np.concatenate(pairs)).tolist():
        out[pair // len(bench.names)][2].append(bench.names[pair % len(bench.names)])
    return out


def _pass(docs: DataFrame, items: list[tuple[str, str]], window: int, key: str, text_col: str) -> DataFrame:
    sent, name = docs.sparkSession.sparkContext.broadcast(items), uuid.uuid4().hex

    def make():
        if name not in _BUILT:  # once per worker and block
            _BUILT.clear()
            _BUILT[name] = Benchmark(sent.value, window)
        bench = _BUILT[name]

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = search_shard(batch.column(1).to_pylist(), bench)
            spans = [[{"first": a, "end": b} for a, b in f[1]] for f in found]
            return pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([f[0] for f in found], pa.int64()),
                    pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))),
                    pa.array([sorted(f[2]) for f in found], pa.list_(pa.string())),
                    pa.array([f[3] for f in found], pa.int64()),
                ],
                ["doc_id", "n_words", "spans", "items", "longest"],
            )

        return step

    kind = docs.schema[key].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, spans array<struct<first:long,end:long>>, items array<string>, longest long"
    return map_texts(docs, {"doc_id": key, "text": text_col}, schema, make)


def matches(
    docs: DataFrame, bench: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """One row per document: n_words, hit word spans, item ids (as sorted strings), longest match.

    A span is a maximal row of words that occurrences of windows cover.
    """
    items = bench.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("i"), F.coalesce("text", F.lit("")).alias("t"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("t") + F.octet_length("i") + 64), F.lit(0))).first()[0]
    blocks = max(1, -(-size // block_bytes))
    if blocks == 1:
        return _pass(docs, [tuple(r) for r in items.collect()], window, id_col, text_col)
    items = stage(items.withColumn("b", F.pmod(F.xxhash64("i", "t"), F.lit(blocks))), "benchmark")
    held = stage(docs.select(F.monotonically_increasing_id().alias("row"), docs[id_col].alias("doc_id"), docs[text_col].alias("text")), "documents")
    each = None
    for b in range(blocks):
        block = [tuple(r) for r in items.where(F.col("b") == b).select("i", "t").collect()]
        part = _pass(held, block, window, "row", "text").withColumnRenamed("doc_id", "row")
        each = part if each is None else each.union(part)
    joined = each.groupBy("row").agg(
        F.max("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("parts"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.max("longest").alias("longest"),
    )
    return held.select("row", "doc_id").join(joined, "row").select("doc_id", "n_words", _merged("parts").alias("spans"), "items", "longest")


def _merged(parts: str):
    """Sorted spans with touching and overlapping ones joined."""

    def add(done, span):
        last = F.element_at(done, -1)
        joins = (F.size(done) > 0) & (span["first"] <= last["end"])
        wide = F.struct(last["first"].alias("first"), F.greatest(last["end"], span["end"]).alias("end"))
        return F.when(joins, F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(wide))).otherwise(
            F.concat(done, F.array(span))
        )

    return F.aggregate(parts, F.array().cast("array<struct<first:bigint,end:bigint>>"), add)


def decontaminate(docs: DataFrame, bench: DataFrame, window: int = 10) -> DataFrame:
    """The rows of ``docs`` without a benchmark match, with all their columns."""
    names = docs.columns
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("whole"), F.col("text"))
    found = matches(held, bench, window, "whole")
    return found.where(F.size("spans") == 0).select("doc_id.*")
