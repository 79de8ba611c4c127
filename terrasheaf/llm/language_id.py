"""Language identification with language-bitmask n-gram filters.

All languages share one bit-sliced Bloom filter: a slot holds one bit per
language, and the AND of an n-gram's slots tells every language that contains
it.  A text's n-grams are looked up once; per-language counts, corrected for the
language's rate of false positives, decide.

An n-gram belongs to a language if enough of its documents hold it, and not far
fewer than in the language where it is most usual.  Learning takes a bounded
sample, at most about ``rows_per_language`` labelled documents of each language,
chosen by hash; every text is predicted whole.

Defined cases: a null text or one without a letter is ``und`` with score 0; a
text of which no n-gram is known gets the most frequent language with score 0,
as do ties of equal counts by order of frequency, then name; without labelled
documents all are ``und``; repeated rows count as they stand; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_bytes, map_texts, ship, stage

SIZES, PROBES, SLOTS = (3, 4), 3, 1 << 20
ROWS_PER_LANGUAGE, LEAST_SHARE, LEAST_OF_BEST = 10_000, 0.005, 0.3
_LETTER: list[np.ndarray] = []
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def _letters() -> np.ndarray:
    """For each code point, whether it is a letter; made once per worker."""
    if not _LETTER:
        _LETTER.append(np.fromiter(map(str.isalpha, map(chr, range(sys.maxunicode + 1))), bool, sys.maxunicode + 1))
    return _LETTER[0]


def ngrams(text: str | None) -> np.ndarray | None:
    """Hashes of the letter n-grams of SIZES, word ends marked; None without a letter."""
    if not text:
        return None
    codes = np.frombuffer(text.lower().encode("utf-32-le"), "<u4")
    letter = _letters()[codes]
    if not letter.any():
        return None
    codes = np.r_[0, np.where(letter, codes, 0), 0].astype(np.uint64)
    codes = codes[np.r_[True, (codes[1:] != 0) | (codes[:-1] != 0)]]
    out = []
    for size in SIZES:
        n = len(codes) - size + 1
        if n < 1:
            continue
        mixed, inner = np.zeros(n, np.uint64), np.ones(n, bool)
        for k in range(size):
            part = codes[k : k + n]
            mixed = (mixed ^ part) * _MIX[k]
            if 0 < k < size - 1:
                inner &= part != 0
        mixed ^= mixed >> np.uint64(29)
        out.append((mixed * _MIX[3] ^ np.uint64(size))[inner])
    return np.concatenate(out) if out else np.empty(0, np.uint64)


@dataclass
class Model:
    """Languages by falling frequency, bit masks per slot (words of 64 languages), false-positive rates."""

    languages: list[str]
    masks: np.ndarray
    false_rates: np.ndarray

    def shares(self, grams: np.ndarray) -> np.ndarray:
        """For each language the corrected share of the n-grams that it contains."""
        counts = np.zeros(len(self.languages))
        for at in range(0, len(grams), 1 << 17):
            part = grams[at : at + (1 << 17)]
            found = self.masks[_slot(part, 0)]
            for probe in range(1, PROBES):
                found &= self.masks[_slot(part, probe)]
            for j in range(len(self.languages)):
                counts[j] += np.count_nonzero(found[:, j // 64] & np.uint64(1 << (j % 64)))
        raw = counts / max(1, len(grams))
        return np.clip((raw - self.false_rates) / np.maximum(1e-9, 1 - self.false_rates), 0, 1)

    def predict(self, text: str | None) -> tuple[str, float]:
        grams = ngrams(text)
        if grams is None or not self.languages:
            return "und", 0.0
        shares = self.shares(grams)
        best = int(np.argmax(shares))
        return self.languages[best], float(shares[best] / shares.sum()) if shares.sum() > 0 else 0.0


def _slot(grams: np.ndarray, probe: int) -> np.ndarray:
    return ((grams >> np.uint64(20 * probe)) & np.uint64(SLOTS - 1)).astype(np.int64)


def fit(docs: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE) -> Model:
    """A model from rows (doc_id, text, lang).

    What comes to the driver is bounded: one row per language and at most SLOTS slots.
    """
    docs = docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = sorted(((r["n"], r["lang"]) for r in docs.groupBy("lang").agg(F.count("*").alias("n")).collect()), key=lambda x: (-x[0], x[1]))
    languages = [lang for _, lang in sizes]
    words = max(1, -(-len(languages) // 64))
    masks = np.zeros((SLOTS, words), np.uint64)
    if not languages:
        return Model([], masks, np.zeros(0))
    share = F.create_map(*[x for n, lang in sizes for x in (F.lit(lang), F.lit(min(1.0, rows_per_language / n)))])
    number = F.create_map(*[x for j, lang in enumerate(languages) for x in (F.lit(lang), F.lit(j))])
    place = F.pmod(F.xxhash64(F.lit("language"), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    sample = docs.where(place < share[F.col("lang")]).select("text", number[F.col("lang")].alias("lang"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch):
                held: dict[int, list[np.ndarray]] = {}
                seen: dict[int, int] = {}
                for text, lang in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    seen[lang] = seen.get(lang, 0) + 1
                    if (grams := ngrams(text)) is not None:
                        held.setdefault(lang, []).append(np.unique(grams))
                for lang, all_grams in held.items():
                    grams, n = np.unique(np.concatenate(all_grams), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(grams), lang, np.int32)), pa.array(grams.view(np.int64)), pa.array(n.astype(np.int64))],
                        ["lang", "gram", "n"],
                    )

    ship(docs.sparkSession)
    counts = sample.mapInArrow(run, "lang int, gram long, n long").groupBy("gram", "lang").agg(F.sum("n").alias("n"))
    taken = {r["lang"]: r["n"] for r in sample.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    docs_of = F.create_map(*[F.lit(x) for j in range(len(languages)) for x in (j, float(max(1, taken.get(j, 0))))])
    usual = counts.withColumn("share", F.col("n") / docs_of[F.col("lang")]).where((F.col("share") >= LEAST_SHARE) & (F.col("n") > 1))
    best = usual.groupBy("gram").agg(F.max("share").alias("best"), F.collect_list(F.struct("lang", "share")).alias("all"))
    own = best.select("gram", F.explode("all").alias("x"), "best").where(F.col("x.share") >= LEAST_OF_BEST * F.col("best"))
    slots = F.array(*[F.shiftrightunsigned("gram", 20 * p).bitwiseAND(F.lit(SLOTS - 1)) for p in range(PROBES)])
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("x.lang") % 64)
    filled = own.select(F.explode(slots).alias("slot"), bit.alias("bit"), F.floor(F.col("x.lang") / 64).alias("word"))
    for row in stage(filled.groupBy("slot", "word").agg(F.bit_or("bit").alias("mask")), "language-slots").toPandas().itertuples():
        masks[row.slot, row.word] = np.uint64(row.mask & (2**64 - 1))
    fill = np.array([np.count_nonzero(masks[:, j // 64] & np.uint64(1 << (j % 64))) for j in range(len(languages))]) / SLOTS
    return Model(languages, masks, fill**PROBES)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) of every row of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        known = sent.value

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            told = [known.predict(t) for t in batch.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([t[0] for t in told], pa.string()), pa.array([t[1] for t in told], pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

        return step

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_texts(docs, {"doc_id": "doc_id", "text": "text"}, f"doc_id {kind}, lang_pred string, score double", make)


def held_out(doc_id: str) -> Column:
    """Whether a document is kept out of learning: crc32 of its id, as text, leaves 2 modulo 4."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(4)) == 2, F.lit(False))
