"""Quality by importance resampling.

Two generative models of hashed word unigrams and bigrams are counted, one over
target texts (labelled good and not toxic) and one over all raw text.  A
document's log weight is the mean log ratio of its n-grams, carried to a length
of TEMPER n-grams, so that long texts do not win by length; Gumbel noise is
added and the k documents with the largest keys are kept.  k is the share of
good documents among the labelled ones times the number of documents.

The target is a bounded sample: ``target_rows`` labelled rows at most, chosen by
hash.  Raw counts, weights and the choice of the k cover every document.  The
k-th key is found by refining histograms, so no keys are gathered or sorted.

Defined cases: a text without words has no weight and is not kept; documents
whose keys tie with the k-th (repeated rows) are all kept; without labels every
document that has words is kept; labels that repeat a doc_id count as they
stand; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_bytes, map_texts, ship, stage

BUCKETS, SMOOTH, TEMPER = 1 << 17, 4.0, 100.0
TARGET_ROWS, SEED, BINS, FEW = 20_000, 17, 1024, 1000
_TOKEN = re.compile(rb"[a-z0-9\x80-\xff]+|[^\x00-\x20a-z0-9\x80-\xff]+")


def features(text: str | None) -> np.ndarray:
    """Hashed unigrams and bigrams of the lower-cased words and marks of a text."""
    words = _TOKEN.findall(text.lower().encode()) if text else []
    one = np.array([zlib.crc32(w) for w in words], np.uint64)
    two = ((one[:-1] * np.uint64(0x9E3779B97F4A7C15) + one[1:]) * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(32)
    return (np.concatenate([one, two]) % np.uint64(BUCKETS)).astype(np.int64)


def ngram_counts(docs: DataFrame, target: DataFrame) -> DataFrame:
    """(bucket, raw, target) over all of ``docs``; ``target`` has the few doc_ids of the target."""
    ids = F.broadcast(target.select(F.col("doc_id").alias("id")).distinct().withColumn("hit", F.lit(1)))
    flagged = docs.join(ids, docs["doc_id"] == ids["id"], "left").select("text", F.coalesce("hit", F.lit(0)).alias("hit"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            for part in by_bytes(batch):
                hits = part.column(1).to_pylist()
                found = [features(t) for t in part.column(0).to_pylist()]
                both[0] += np.bincount(np.concatenate(found), minlength=BUCKETS)
                if any(hits):
                    chosen = np.concatenate([f for f, h in zip(found, hits) if h])
                    both[1] += np.bincount(chosen, minlength=BUCKETS)
        full = np.flatnonzero(both[0])
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(both[0][full]), pa.array(both[1][full])], ["bucket", "raw", "target"])

    ship(docs.sparkSession)
    parts = flagged.mapInArrow(run, "bucket long, raw long, target long")
    return parts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def log_ratios(counts: DataFrame) -> np.ndarray:
    """Log ratio of target to raw per bucket (at most BUCKETS rows come to the driver).

    Counts are smoothed towards a ratio of one, so buckets without evidence say nothing.
    """
    rows = counts.toPandas()
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    raw[rows["bucket"]], target[rows["bucket"]] = rows["raw"], rows["target"]
    expected = target.sum() * raw / max(1.0, raw.sum())
    return np.log((target + SMOOTH) / (expected + SMOOTH))


def log_weights(docs: DataFrame, ratios: np.ndarray) -> DataFrame:
    """(doc_id, log_weight) of every row; null where a text has no words."""
    sent = docs.sparkSession.sparkContext.broadcast(ratios)

    def make():
        table = sent.value

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [features(t) for t in batch.column(1).to_pylist()]
            weights = [float(TEMPER * table[f].mean()) if len(f) else None for f in found]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(weights, pa.float64())], ["doc_id", "log_weight"])

        return step

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_texts(docs, {"doc_id": "doc_id", "text": "text"}, f"doc_id {kind}, log_weight double", make)


def kth_largest(keys: DataFrame, k: int) -> float | None:
    """The k-th largest ``key``, by histograms of BINS bins over an ever smaller range."""
    keys = keys.where("key is not null")
    n, low, high = keys.agg(F.count("*"), F.min("key"), F.max("key")).first()
    if not n or k < 1:
        return None
    above, k = 0, min(k, n)
    while low < high and n > FEW:
        width = (high - low) / BINS
        inside = keys.where((F.col("key") >= low) & (F.col("key") <= high))
        nth = F.least(F.lit(BINS - 1), F.floor((F.col("key") - low) / width))
        bins = inside.groupBy(nth.alias("b")).agg(F.count("*").alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi"))
        for row in sorted(bins.collect(), key=lambda r: -r["b"]):
            if above + row["n"] >= k:
                n, low, high = row["n"], row["lo"], row["hi"]
                break
            above += row["n"]
    if low == high:
        return low
    rest = keys.where((F.col("key") >= low) & (F.col("key") <= high)).select("key").collect()
    return sorted((r["key"] for r in rest), reverse=True)[k - above - 1]


def resample(docs: DataFrame, labels: DataFrame, target_rows: int = TARGET_ROWS, seed: int = SEED) -> DataFrame:
    """(doc_id, log_weight, key, kept) of every row of ``docs``."""
    good = (F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)
    target = stage(
        labels.where(good & F.col("doc_id").isNotNull()).select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(target_rows),
        "importance-target",
    )
    share = labels.agg(F.avg((F.col("quality") == 1).cast("double"))).first()[0]
    ratios = log_ratios(ngram_counts(docs.select("doc_id", "text"), target))
    uniform = (F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    keyed = stage(
        log_weights(docs, ratios).withColumn("key", F.col("log_weight") - F.log(-F.log(uniform))), "importance-keys"
    )
    k = round((1.0 if share is None else share) * keyed.count())
    least = kth_largest(keyed.select("key"), k)
    kept = F.lit(False) if least is None else F.coalesce(F.col("key") >= least, F.lit(False))
    return keyed.withColumn("kept", kept)
