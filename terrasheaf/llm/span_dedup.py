"""Substring dedup by sliding sentence spans.

Every run of consecutive sentences is hashed; equal hashes meet in one shuffle;
of the places of a repeated run all but the first (the smallest doc_id, then the
earliest sentence) are later ones, and the sentences that they cover are removed.

A sentence ends with . ! ? or an ellipsis before white space, with its line, or
with its text.  A sentence of more than LONG words is cut further, after each
word for which :func:`cuts` holds: content-defined places, so that copies of a
passage inside longer sentences are cut alike wherever they stand.  Runs are
compared without regard to the kind and amount of white space.

At every sentence start there is a run of SENTENCES sentences, longer if it has
fewer than LEAST_WORDS words, until it has as many, and each shorter run of
WORDS words or more.  The length of a run depends on its own text only, so
copies make the same runs wherever they stand.  Short stock phrases (a licence
line, a heading) make no run of their own.

Hashing tasks tell places that are later within their own batch at once and send
on only the first of each hash, so a run that very many documents hold reaches
the task that compares it once a batch, not once a document.

Defined cases: null and empty texts have no sentences and stay as they are;
rows that repeat one doc_id and text are one document (all are cut alike, none
is first against the other), other rows with one doc_id are told apart by their
text; a null doc_id comes first; a text whose sentences all go becomes empty;
very long texts are hashed like any other, in time linear in their words; an
empty table gives an empty result; other columns pass through ``remove_repeats``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD_SPACE, by_bytes, filter_test, key_hashes, map_texts, ship, stage

SENTENCES, WORDS, LEAST_WORDS, LONG = 3, 40, 20, 24
CUT_ONE_IN = 8
_END = re.compile(rf"[.!?…]+[{WORD_SPACE}]+$|\n[{WORD_SPACE}]*$")
_TOKEN = re.compile(rf"[^{WORD_SPACE}]+[{WORD_SPACE}]*|^[{WORD_SPACE}]+")


def cuts(word: str) -> bool:
    """Whether a long sentence is cut after ``word``: about one word in CUT_ONE_IN, known from the word alone."""
    return (31 * ord(word[0]) + 7 * ord(word[-1]) + len(word)) % CUT_ONE_IN == 0


def sentences(text: str | None) -> list[str]:
    """The sentences of a text, each with the white space behind it."""
    out: list[str] = []
    held: list[str] = []
    tokens = _TOKEN.findall(text) if text else []
    for k, token in enumerate(tokens):
        held.append(token)
        if k == len(tokens) - 1 or token[-1] in WORD_SPACE and _END.search(token):
            out += _cut(held) if len(held) > LONG else ["".join(held)]
            held = []
    return out


def _cut(tokens: list[str]) -> list[str]:
    """A sentence, given by its words and their white space, cut at content-defined places if it is long."""
    words = [t.rstrip(WORD_SPACE) for t in tokens]
    if len(words) - (words[0] == "") <= LONG:
        return ["".join(tokens)]
    ends = [k + 1 for k, w in enumerate(words) if w and cuts(w)]
    if not ends or ends[-1] < len(tokens):
        ends.append(len(tokens))
    return ["".join(tokens[a:b]) for a, b in zip([0, *ends], ends)]


def runs(text: str | None) -> list[tuple[int, int, bytes]]:
    """(first sentence, number of sentences, digest) of each run."""
    split = [s.encode().split() for s in sentences(text)]
    sizes, plain = [len(s) for s in split], [b" ".join(s) for s in split]
    out = []
    for i in range(len(split)):
        n = words = 0
        while i + n < len(split) and (n < SENTENCES or words < LEAST_WORDS):
            words += sizes[i + n]
            n += 1
            if words >= WORDS or n >= SENTENCES and words >= LEAST_WORDS:
                out.append((i, n, xxhash.xxh3_128_digest(b"\n".join(plain[i : i + n]))))
    return out


def without(text: str, spans: list[dict]) -> tuple[str, int, int]:
    """(text, sentences, sentences removed) without the sentences of ``spans``."""
    whole = sentences(text)
    drop = {i for s in spans for i in range(s["first"], s["first"] + s["n"])}
    left = "".join(s for i, s in enumerate(whole) if i not in drop).rstrip(WORD_SPACE) if drop else text
    return left, len(whole), len(drop)


def equal_ids(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Where two columns are equal; nulls equal each other."""
    both_null = pc.and_(a.is_null(), b.is_null())
    return pc.or_(pc.fill_null(pc.equal(a, b), False), both_null).to_numpy(zero_copy_only=False)


def _spans(docs: DataFrame) -> DataFrame:
    """(h1, h2, doc_id, mark, first, n, later) of every run; ``mark`` is a hash of the whole text.

    ``later`` is true for places behind another one of their hash in the batch.
    """

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            order = batch.sort_by([("doc_id", "ascending"), ("mark", "ascending")])
            # Nulls come first, as in the order of places.
            order = pa.concat_batches([order.filter(order.column(0).is_null()), order.filter(order.column(0).is_valid())])
            found = [runs(t) for t in order.column(1).to_pylist()]
            rows = np.repeat(np.arange(len(found)), [len(f) for f in found])
            marks = np.frombuffer(b"".join([h for f in found for _, _, h in f]), "<i8").reshape(-1, 2)
            _, first, back = np.unique(marks.view("V16").ravel(), return_index=True, return_inverse=True)
            owner, text_mark = order.column(0).take(pa.array(rows)), order.column(2).to_numpy()[rows]
            nth = np.array([i for f in found for i, _, _ in f], np.int32)
            # A repeated row is the same document, and its places are as first as the row's.
            head = first[back]
            same = equal_ids(owner, owner.take(pa.array(head))) & (text_mark == text_mark[head]) & (nth == nth[head])
            columns = [pa.array(marks[:, 0]), pa.array(marks[:, 1]), owner, pa.array(text_mark), pa.array(nth)]
            columns += [pa.array([n for f in found for _, n, _ in f], pa.int32()), pa.array(~same)]
            return pa.RecordBatch.from_arrays(columns, ["h1", "h2", "doc_id", "mark", "first", "n", "later"])

        return step

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_texts(
        docs.select("doc_id", "text", F.xxhash64("text").alias("mark")),
        {"doc_id": "doc_id", "text": "text", "mark": "mark"},
        f"h1 long, h2 long, doc_id {kind}, mark long, first int, n int, later boolean",
        make,
    )


def repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, spans): for each document the (first, n) of runs that are no first ones.

    One shuffle deals the places by hash; those known to be later are dealt evenly
    and only pass through.
    """
    spans = _spans(docs)
    kind = spans.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # the hash of the last row, and the first place of that hash
        for batch in batches:
            if not batch.num_rows:
                continue
            h1, h2, mark, first = (batch.column(k).to_numpy() for k in (0, 1, 3, 4))
            names, later = batch.column(2), batch.column(6).to_numpy(zero_copy_only=False)
            new = np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1]) | (later[1:] != later[:-1])]
            group = np.cumsum(new) - 1
            head = np.flatnonzero(new)[group]
            same = equal_ids(names, names.take(pa.array(head))) & (mark == mark[head]) & (first == first[head])
            place = (names.slice(int(head[-1]), 1), mark[head[-1]], first[head[-1]])
            if held is not None and held[0] == (h1[0], h2[0], later[0]):
                n = int(np.searchsorted(group, 1))
                begin = held[1]
                same[:n] = equal_ids(names.slice(0, n), begin[0].take(pa.array(np.zeros(n, np.int64)))) & (mark[:n] == begin[1]) & (first[:n] == begin[2])
                place = begin if n == len(group) else place
            held = ((h1[-1], h2[-1], later[-1]), place)
            yield batch.filter(pa.array(later | ~same)).select([2, 3, 4, 5])

    ship(docs.sparkSession)
    even = F.xxhash64("doc_id", "mark", "first")
    dealt = spans.withColumn("deal", F.when(F.col("later"), even).otherwise(F.col("h1")))
    dealt = dealt.repartition("deal").sortWithinPartitions("later", "h1", "h2", "doc_id", "mark", "first").drop("deal")
    later = dealt.mapInArrow(run, f"doc_id {kind}, mark long, first int, n int")
    return later.groupBy("doc_id", "mark").agg(F.collect_set(F.struct("first", "n")).alias("spans"))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with later copies cut from ``text``, and ``n_sentences`` and ``n_removed`` added.

    Columns of those two names are replaced.
    """
    names = [c for c in docs.columns if c not in ("n_sentences", "n_removed")]
    found = stage(repeats(docs.select("doc_id", "text")), "spans-later")
    left = docs.select(
        F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_mark"), F.struct(*[F.col(f"`{c}`") for c in names]).alias("whole")
    )
    # Only documents that may have something to cut are moved.
    marks = [h.alias(n) for h, n in zip(key_hashes(F.col("doc_id"), F.col("mark")), ("h1", "h2"))]
    possible = filter_test(docs.sparkSession, found.select(*marks))
    tested = left.withColumn("maybe", possible(*key_hashes(F.col("_id"), F.col("_mark"))))
    hits = tested.where("maybe")
    met = hits.join(found, hits["_id"].eqNullSafe(found["doc_id"]) & (hits["_mark"] == found["mark"]), "left").select("whole", "spans")
    met = met.union(tested.where("not maybe").select("whole", F.lit(None).cast(found.schema["spans"].dataType).alias("spans")))
    met = met.select("whole", F.col("whole.text").alias("text"), "spans")

    def run(batches):
        for batch in batches:
            for part in by_bytes(batch):
                texts, counts, gone = [], [], []
                for text, spans in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    left, count, removed = without(text, spans or [])
                    texts.append(left)
                    counts.append(count)
                    gone.append(removed)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array(gone, pa.int64())],
                    ["whole", "text", "n_sentences", "n_removed"],
                )

    ship(docs.sparkSession)
    kind = met.schema["whole"].dataType.simpleString()
    cut = met.mapInArrow(run, f"whole {kind}, text string, n_sentences long, n_removed long")
    return cut.select(*[F.col("text") if c == "text" else F.col(f"whole.`{c}`") for c in names], "n_sentences", "n_removed")
