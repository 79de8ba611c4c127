"""BPE encoding and decoding in batched numpy merge rounds.

Text is normalised and cut into words; the words of a batch that are not known
yet are laid out as one flat array of symbols.  Each round looks up the ranks of
changed neighbour pairs by binary search over the sorted pair keys and merges,
in every word at once, the pairs of the word's lowest rank.  Known words stay in
a bounded table, so a frequent word is merged once per worker.

The vocabulary file is one of the ``tokenizers`` library with word-end marks;
its path is a parameter.  Ids are carried as little-endian unsigned 32-bit bytes.

Defined cases: a null text is an empty one and has no ids; special tokens that
stand in a text become their ids, as in the library; decoding joins tokens with
a space, as the library does where the file names no decoder; repeated rows are
encoded one by one; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import map_texts

# White space as the vocabulary's normaliser and splitter see it, and its split pattern.
SPACES = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPLIT = rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{SPACES}\p{{L}}\p{{N}}]+"

BATCH_BYTES = 1 << 20  # text cut into pieces together; a piece takes some ten times its bytes
LONG_WORD = 1024  # symbols; a longer word goes through a heap, whose cost is not rounds x length
KNOWN_PIECES, KNOWN_LENGTH = 200_000, 48
NONE = np.int64(1 << 40)

_LOADED: dict[str, WordBpe] = {}


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: its own, or the next free one from 256."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class WordBpe:
    """Encoder and decoder for one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        model = told["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int64)
        self.last = np.array([vocab[c + suffix] for c in letters], np.int64)
        self.span = 1 + max(vocab.values())
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        keys = np.array([vocab[a] * self.span + vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made
        self.tokens = {i: t.encode() for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in told["added_tokens"]}
        self.tokens |= {i: t.encode() for t, i in self.special.items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.words = regex.compile(SPLIT)
        self.space = re.compile(f"[{SPACES}]+")
        self.known: dict[str, bytes] = {}

    # ------------------------------------------------------------------ merging

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each neighbour pair; NONE where the pair is no merge."""
        key = left * self.span + right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.ranks[at], NONE) if len(self.keys) else np.full(len(key), NONE)

    def merge(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each (non-empty) word."""
        out: list = [None] * len(words)
        for i, w in enumerate(words):
            if len(w) > LONG_WORD:
                out[i] = self._merge_long(w)
        short = [i for i, w in enumerate(words) if out[i] is None]
        sizes = np.array([len(words[i]) for i in short], np.int64)
        if not len(sizes):
            return out
        octets = np.frombuffer(b"".join([words[i] for i in short]), np.uint8)
        symbol = self.inner[octets]
        ends = np.cumsum(sizes) - 1
        symbol[ends] = self.last[octets[ends]]
        word = np.repeat(np.arange(len(short)), sizes)
        rank = np.full(len(symbol), NONE)
        if len(symbol) > 1:
            rank[:-1] = np.where(word[:-1] == word[1:], self.rank_of(symbol[:-1], symbol[1:]), NONE)
        final: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbol):
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            least = np.minimum.reduceat(rank, first)
            counts = np.diff(np.r_[first, len(symbol)])
            spread = np.repeat(least, counts)
            over = spread == NONE
            if over.any():  # finished words leave the arrays
                final.append((word[over], symbol[over]))
                symbol, word, rank, spread = symbol[~over], word[~over], rank[~over], spread[~over]
                if not len(symbol):
                    break
            hit = rank == spread
            at = np.flatnonzero(hit)
            # In a run of overlapping hits (one repeated symbol) every second one merges, from the left.
            start = np.r_[True, np.diff(at) > 1]
            offset = at - at[np.maximum.accumulate(np.where(start, np.arange(len(at)), 0))]
            at = at[offset % 2 == 0]
            symbol[at] = self.made[rank[at]]
            keep = np.ones(len(symbol), bool)
            keep[at + 1] = False
            fresh = np.zeros(len(symbol), bool)
            fresh[at] = True
            symbol, word, rank, fresh = symbol[keep], word[keep], rank[keep], fresh[keep]
            if len(symbol) > 1:
                look = np.flatnonzero(fresh | np.r_[fresh[1:], False])
                look = look[look < len(symbol) - 1]
                rank[look] = np.where(
                    word[look] == word[look + 1], self.rank_of(symbol[look], symbol[look + 1]), NONE
                )
            if fresh[-1]:
                rank[-1] = NONE
        owner = np.concatenate([w for w, _ in final])
        ids = np.concatenate([s for _, s in final])
        order = np.argsort(owner, kind="stable")
        owner, ids = owner[order], ids[order].astype("<u4")
        for i, part in zip(short, np.split(ids, np.flatnonzero(np.diff(owner)) + 1)):
            out[i] = part
        return out

    def _merge_long(self, word: bytes) -> np.ndarray:
        """The same merges for one long word, by a heap over its pairs."""
        octets = np.frombuffer(word, np.uint8)
        symbol = self.inner[octets]
        symbol[-1] = self.last[octets[-1]]
        ranks = self.rank_of(symbol[:-1], symbol[1:]).tolist()
        symbol = symbol.tolist()
        after, before = list(range(1, len(symbol) + 1)), list(range(-1, len(symbol) - 1))
        heap = [(r, i, symbol[i], symbol[i + 1]) for i, r in enumerate(ranks) if r != NONE]
        heapq.heapify(heap)
        look = dict(zip(self.keys.tolist(), self.ranks.tolist()))

        def offer(i: int) -> None:
            j = after[i]
            if i >= 0 and j < len(symbol):
                r = look.get(symbol[i] * self.span + symbol[j])
                if r is not None:
                    heapq.heappush(heap, (r, i, symbol[i], symbol[j]))

        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if symbol[i] != a or j >= len(symbol) or symbol[j] != b:
                continue
            symbol[i], symbol[j] = int(self.made[r]), -1
            after[i] = after[j]
            if after[j] < len(symbol):
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return np.array([s for s in symbol if s >= 0], "<u4")

    # ----------------------------------------------------------------- encoding

    def normal(self, text: str) -> str:
        # The library lowers letter by letter, so a final capital sigma is no special case.
        return self.space.sub(" ", unicodedata.normalize("NFC", text)).replace("Σ", "σ").lower()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit bytes."""
        cut: list[list] = []
        wanted: set[str] = set()
        for text in texts:
            parts: list = []
            for k, part in enumerate(self.cut.split(text) if text and "<|" in text and self.cut else [text or ""]):
                if k % 2:
                    parts.append(self.special[part].to_bytes(4, "little"))
                elif part:
                    parts.append(pieces := self.normal(part).split(" "))
                    wanted.update(pieces)
            cut.append(parts)
        table = self._table(wanted)
        return [
            b"".join([p if isinstance(p, bytes) else b"".join(map(table.__getitem__, p)) for p in parts])
            for parts in cut
        ]

    def _table(self, wanted: set[str]) -> dict[str, bytes]:
        """Ids of the wanted pieces (text between spaces); short ones stay known."""
        if len(self.known) > KNOWN_PIECES:
            self.known.clear()
        missing = [p for p in wanted if p not in self.known]
        if not missing:
            return self.known
        split = [self.words.findall(p) for p in missing]
        distinct = list({w for ws in split for w in ws})
        ids = dict(zip(distinct, (x.tobytes() for x in self.merge([w.encode() for w in distinct]))))
        found = {p: b"".join([ids[w] for w in ws]) for p, ws in zip(missing, split)}
        long = any(len(p) > KNOWN_LENGTH for p in missing)
        self.known.update((p, i) for p, i in found.items() if len(p) <= KNOWN_LENGTH)
        return self.known | found if long else self.known

    def decode(self, ids: bytes) -> str:
        """Tokens joined with a space, special ones included; ids outside the vocabulary vanish."""
        get = self.tokens.get
        return b" ".join([t for i in np.frombuffer(ids, "<u4").tolist() if (t := get(i)) is not None]).decode()


def load(path: str) -> WordBpe:
    """The encoder for a file, read once per worker."""
    if path not in _LOADED:
        _LOADED[path] = WordBpe(path)
    return _LOADED[path]


# ------------------------------------------------------------------- operators


def encode(docs: DataFrame, path: str, decoded: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids[, decoded]): ``ids`` are little-endian unsigned 32-bit bytes.

    ``decoded`` asks for the text decoded from the ids in the same pass.
    """

    def make():
        coder = load(path)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids = coder.encode(batch.column(1).to_pylist())
            columns = [batch.column(0), pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary())]
            names = ["doc_id", "n_tokens", "ids"]
            if decoded:
                columns.append(pa.array(map(coder.decode, ids), pa.string()))
                names.append("decoded")
            return pa.RecordBatch.from_arrays(columns, names)

        return step

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids binary" + ", decoded string" * decoded
    return map_texts(docs, {"doc_id": id_col, "text": text_col}, schema, make, BATCH_BYTES)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, decoded) from rows (doc_id, ids); null ids give an empty text."""

    def make():
        coder = load(path)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [coder.decode(i or b"") for i in batch.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "decoded"])

        return step

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return map_texts(encoded, {"doc_id": "doc_id", "ids": "ids"}, f"doc_id {kind}, decoded string", make)
