"""Token-id files of patched frame-of-reference blocks.

Ids of all documents follow each other in ascending doc_id order.  They are cut
into blocks of BLOCK ids; a block stores its least id, the differences to it
packed at a width that PERCENTILE of them fit, and the rest of the larger ones
in an exception list.  A file holds the blocks of some documents, the start of
every block for random access, and the documents' ids and lengths:

    magic "PFB1", then unsigned 32-bit counts: documents, ids, blocks
    blocks + 1 unsigned 32-bit starts, counted in bytes from the first block
    the blocks:  u32 least, u8 width, u8 high width, u16 exceptions,
                 packed low bits, u16 exception places, packed high bits

Files are rows of a Parquet table, so that Spark commits them as a whole and a
task that is run again replaces its own output; nothing is written from Python.

Documents are range-partitioned by doc_id once, as text, and encoded in place;
``start`` comes from sums over the files, of which there are few.

Defined cases: a null or empty text is the end id alone; documents that repeat a
doc_id lie next to each other, ordered by text; a null doc_id comes first; an
empty table gives an empty table of files; other columns are not read.
"""

from __future__ import annotations

import itertools
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import by_bytes, ship, stage

MAGIC, BLOCK, PERCENTILE = b"PFB1", 4096, 0.9
FILE_IDS = 1 << 20
END_ID = 0
KNOWN_PIECES, KNOWN_LENGTH = 900_000, 48
# White space of the byte-level pre-tokeniser.
SPACES = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
FIRST = "\uffff"  # no character; texts that hold it go to the library whole
SPACE_SET = frozenset("\t\n\x0b\x0c\r \x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000") | frozenset(map(chr, range(0x2000, 0x200B)))
_LOADED: dict[str, Encoder] = {}


# ---------------------------------------------------------------------- format


def _pack(values: np.ndarray, width: int) -> bytes:
    """``values`` at ``width`` bits each, one after the other, lowest bit first."""
    if not width or not values.size:
        return b""
    lane = 2 if width <= 16 else 4
    bits = np.unpackbits(values.astype(f"<u{lane}").view(np.uint8).reshape(-1, lane), axis=1, bitorder="little")
    return np.packbits(bits[:, :width], bitorder="little").tobytes()


_PLACES: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}


def _unpack(data: np.ndarray, count: int, width: int) -> np.ndarray:
    """The reverse of ``_pack``: each value is cut out of the word that its first byte begins."""
    if not width or not count:
        return np.zeros(count, np.uint32)
    if (count, width) not in _PLACES:
        if len(_PLACES) > 256:
            _PLACES.clear()
        bit = np.arange(count, dtype=np.int64) * width
        _PLACES[count, width] = bit >> 3, (bit & 7).astype(np.uint64)
    byte, shift = _PLACES[count, width]
    lane = 4 if width <= 25 else 8
    padded = np.r_[data[: (count * width + 7) // 8], np.zeros(lane, np.uint8)]
    words = np.ndarray((len(padded) - lane + 1,), f"<u{lane}", padded, strides=(1,))
    return ((words[byte] >> shift.astype(f"<u{lane}")) & words.dtype.type((1 << width) - 1)).astype(np.uint32)


def pack_ids(ids: np.ndarray, block: int = BLOCK, percentile: float = PERCENTILE) -> tuple[bytes, np.ndarray]:
    """Packed blocks and their starts (one more than blocks) of unsigned 32-bit ids."""
    ids = np.ascontiguousarray(ids, np.uint32)
    n_blocks = -(-len(ids) // block)
    if not n_blocks:
        return b"", np.zeros(1, np.uint32)
    first = np.arange(0, len(ids), block)
    least = np.minimum.reduceat(ids, first)
    rest = ids - np.repeat(least, np.diff(np.r_[first, len(ids)]))
    size = np.full(n_blocks, block)
    size[-1] = len(ids) - first[-1]
    tops = _bits(np.maximum.reduceat(rest, first))
    at = np.ceil(percentile * size).astype(np.int64) - 1
    widths = np.empty(n_blocks, np.int64)
    full = len(ids) // block * block
    if full:
        widths[: full // block] = _bits(np.partition(rest[:full].reshape(-1, block), at[0], axis=1)[:, at[0]])
    if full < len(ids):
        widths[-1] = _bits(np.partition(rest[full:], at[-1])[at[-1] : at[-1] + 1])[0]
    parts: list[bytes] = [b""] * n_blocks
    # Blocks of equal width are packed together: their rows have equally many bits.
    for width in np.unique(widths[:-1]).tolist():
        rows = np.flatnonzero(widths[:-1] == width)
        if width and len(rows):
            values = rest[(first[rows][:, None] + np.arange(block))] & np.uint32((1 << width) - 1)
            whole = _pack(values.ravel(), width)
            step = block * width // 8
            for k, r in enumerate(rows.tolist()):
                parts[r] = whole[k * step : (k + 1) * step]
    last = rest[first[-1] :] & np.uint32((1 << int(widths[-1])) - 1)
    parts[-1] = _pack(last, int(widths[-1]))
    out = []
    for r in range(n_blocks):
        width, top = int(widths[r]), int(tops[r])
        head = int(least[r]).to_bytes(4, "little") + bytes((width, top - width))
        if top > width:
            values = rest[first[r] : first[r] + size[r]]
            places = np.flatnonzero(values >> np.uint32(width)) if width < 32 else np.empty(0, np.int64)
            high = _pack(values[places] >> np.uint32(width), top - width)
            out.append(head + len(places).to_bytes(2, "little") + parts[r] + places.astype("<u2").tobytes() + high)
        else:
            out.append(head + b"\0\0" + parts[r])
    starts = np.cumsum([0, *map(len, out)]).astype(np.uint32)
    return b"".join(out), starts


def _bits(values: np.ndarray) -> np.ndarray:
    """Bits that each value takes."""
    return np.ceil(np.log2(values.astype(np.float64) + 1)).astype(np.int64)


def unpack_block(data: bytes, count: int) -> np.ndarray:
    """The ``count`` ids of one block."""
    least, width, more = int.from_bytes(data[:4], "little"), data[4], data[5]
    n = int.from_bytes(data[6:8], "little")
    raw = np.frombuffer(data, np.uint8)
    end = 8 + (count * width + 7) // 8
    ids = _unpack(raw[8:end], count, width)
    if n:
        places = raw[end : end + 2 * n].copy().view("<u2").astype(np.int64)
        ids[places] |= _unpack(raw[end + 2 * n :], n, more) << np.uint32(width)
    return ids + np.uint32(least)


def write_file(ids: np.ndarray, lengths: np.ndarray) -> bytes:
    """One file: ids of documents of the given lengths (end ids included)."""
    blocks, starts = pack_ids(ids)
    head = np.array([len(lengths), len(ids), len(starts) - 1], "<u4")
    return MAGIC + head.tobytes() + starts.astype("<u4").tobytes() + lengths.astype("<u4").tobytes() + blocks


def read_file(data: bytes, first: int = 0, last: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(ids, lengths); ``first`` and ``last`` choose blocks, found through the index of starts."""
    if data[:4] != MAGIC:
        raise ValueError("not a token-id file")
    docs, n, blocks = np.frombuffer(data, "<u4", 3, 4).tolist()
    starts = np.frombuffer(data, "<u4", blocks + 1, 16).tolist()
    lengths = np.frombuffer(data, "<u4", docs, 16 + 4 * (blocks + 1))
    base = 16 + 4 * (blocks + 1) + 4 * docs
    last = blocks if last is None else min(last, blocks)
    parts = [
        unpack_block(data[base + starts[b] : base + starts[b + 1]], min(BLOCK, n - b * BLOCK)) for b in range(first, last)
    ]
    return np.concatenate(parts) if parts else np.empty(0, np.uint32), lengths


# -------------------------------------------------------------------- encoding


class Encoder:
    """Ids of whole texts through the tokenizers library, one call for many distinct pieces.

    A byte-level pre-tokeniser never joins a letter, digit or mark with white
    space behind it, so rows of white space with what follows them up to the next
    white space can be encoded on their own, and known ones are looked up.
    Texts that hold a special token's string are given to the library whole.

    Keys of ``known``: a piece as it stands, but "word" for " word", and FIRST
    before a text's first piece, which has no white space before it.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = [FIRST, *(t.content for t in self.library.get_added_tokens_decoder().values())]
        self.odd = re.compile("[" + SPACES.replace(" ", "").replace("\t-\r", "\t\x0b-\r") + "]")
        self.pieces = re.compile(f"[{SPACES}]*[^{SPACES}]+|[{SPACES}]+")
        self.known: dict[str, bytes] = {}
        self.long: list[str] = []
        # Tokens that begin with a space or line end; the library writes these bytes as the letters 0x120 and 0x10A.
        vocabulary = self.library.get_vocab()
        self.opens = {mark: np.zeros(1 + max(vocabulary.values()), bool) for mark in " \n"}
        for token, number in vocabulary.items():
            for mark, letter in ((" ", chr(0x120)), ("\n", chr(0x10A))):
                self.opens[mark][number] = token.startswith(letter)

    def _cut(self, text: str) -> list[str]:
        """Keys of the pieces of a text with any white space."""
        keys = [p[1:] if p[0] == " " and len(p) > 1 and p[1] not in SPACE_SET else p for p in self.pieces.findall(text)]
        if text[0] not in SPACE_SET:
            keys[0] = FIRST + keys[0]
        return keys

    def encode(self, texts: list[str | None], end: int) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text, ``end`` appended.

        Keys of all texts are numbered at once, each distinct key is looked up
        once, and the ids of all texts are gathered from those of the keys.
        """
        last = end.to_bytes(4, "little")
        out: list[bytes] = [last] * len(texts)
        rows: list[list[int]] = [[], []]
        plain: list[str] = []
        odd: list[list[str]] = []
        for i, text in enumerate(texts):
            if not text:
                continue
            if any(t in text for t in self.special):
                out[i] = self._ids([text])[0] + last
            elif "  " in text or "\n\n" in text or "\n " in text or " \n" in text or text[-1] in " \n" or self.odd.search(text):
                rows[1].append(i)
                odd.append(self._cut(text))
            else:
                # Single spaces and line ends only: pieces are what stands between them, a line end opens its piece.
                rows[0].append(i)
                text = text.replace("\n", " \n")
                plain.append(text[1:] if text[0] == " " else FIRST + text)
        cut = pc.split_pattern(pa.array(plain, pa.large_string()), " ")
        counts = np.r_[np.diff(cut.offsets.to_numpy()), np.array([len(k) for k in odd], np.int64)].astype(np.int64)
        keys = pa.concat_arrays([cut.flatten(), pa.array(itertools.chain.from_iterable(odd), pa.large_string())]).dictionary_encode()
        distinct = keys.dictionary.to_pylist()
        table = self._table(set(distinct))
        known = [table[k] for k in distinct]
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        ids, starts = np.frombuffer(b"".join(known), "<u4"), np.cumsum(sizes) - sizes
        nth = keys.indices.to_numpy()
        width = sizes[nth]
        ends = np.cumsum(width)
        places = np.repeat(starts[nth] - (ends - width), width) + np.arange(ends[-1] if len(ends) else 0)
        raw, edges = ids[places].tobytes(), np.r_[0, ends][np.r_[0, np.cumsum(counts)]] * 4
        for i, a, b in zip(rows[0] + rows[1], edges[:-1].tolist(), edges[1:].tolist()):
            out[i] = raw[a:b] + last
        return out

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _table(self, wanted: set[str]) -> dict[str, bytes]:
        """Ids of the wanted keys.  When too many are known, those of this batch stay."""
        known = self.known
        for p in self.long:  # rare long pieces of the last batch
            del known[p]
        self.long = []
        if len(known) > KNOWN_PIECES:
            self.known = known = {p: known[p] for p in wanted if p in known}
        missing = wanted.difference(known)
        if not missing:
            return known
        # A row of stops behind a letter or digit is a token of its own, so the rest is looked up without it.
        tails: list[tuple[str, str]] = []
        plain: set[str] = set()
        for p in missing:
            base = p.rstrip(".,;:!?")
            if base != p and base and base[-1].isalnum():
                tails.append((p, base))
                p = base
            plain.add(p)
        found = self._encode_keys(plain.difference(known))
        marks: dict[str, bytes] = {}
        for p, base in tails:
            stop = p[len(base) :]
            if stop not in marks:
                marks[stop] = self._ids([stop])[0]
            found[p] = (known.get(base) or found[base]) + marks[stop]
        known.update(found)
        self.long = [p for p in found if len(p) > KNOWN_LENGTH] if len(max(found, key=len)) > KNOWN_LENGTH else []
        return known

    def _encode_keys(self, keys: set[str]) -> dict[str, bytes]:
        """Ids of new keys; many pieces go to the library as one text, cut again where a piece's white space stands."""
        found: dict[str, bytes] = {}
        lists: dict[str, list[str]] = {" ": [], "\n": []}
        single: list[str] = []
        for k in keys:
            if k[0] == FIRST or len(k) > KNOWN_LENGTH:
                single.append(k)
            elif k[0] not in SPACE_SET:
                lists[" "].append(k)
            elif k[0] == "\n" and len(k) > 1 and k[1] not in SPACE_SET:
                lists["\n"].append(k)
            else:
                single.append(k)
        for mark, part_keys in lists.items():
            for at in range(0, len(part_keys), 8192):
                part = part_keys[at : at + 8192]
                text = "".join(part) if mark == "\n" else " " + " ".join(part)
                ids = np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
                begins = np.flatnonzero(self.opens[mark][ids])
                if len(begins) != len(part):
                    single += part
                    continue
                raw, edges = ids.tobytes(), [*(4 * begins).tolist(), 4 * len(ids)]
                found.update(zip(part, [raw[a:b] for a, b in zip(edges, edges[1:])]))
        texts = [k[1:] if k[0] == FIRST else k if k[0] in SPACE_SET else " " + k for k in single]
        found.update(zip(single, self._ids(texts)))
        return found


def _encoder(path: str) -> Encoder:
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]


# ------------------------------------------------------------------- operators


def write_token_files(docs: DataFrame, tokenizer: str, path: str, end_id: int = END_ID, file_ids: int = FILE_IDS) -> None:
    """Encode ``docs`` and write their files, in ascending doc_id order, to the table at ``path``.

    Columns: part and nth (order of the files), doc_ids, n_ids, data.  A file
    ends with the first document that fills ``file_ids`` ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, nth = _encoder(tokenizer), 0
        names: list[pa.Array] = []
        coded: list[bytes] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal nth, held
            ids = np.frombuffer(b"".join(coded), "<u4")
            data = write_file(ids, np.array([len(c) // 4 for c in coded]))
            owners = pa.concat_arrays(names)
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array([nth], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, len(owners)], pa.int32()), owners),
                    pa.array([len(ids)], pa.int64()),
                    pa.array([data], pa.binary()),
                ],
                ["nth", "doc_ids", "n_ids", "data"],
            )
            names.clear()
            coded.clear()
            nth, held = nth + 1, 0
            return out

        for batch in batches:
            for part in by_bytes(batch, 8 << 20):
                for at, ids in enumerate(coder.encode(part.column(1).to_pylist(), end_id)):
                    names.append(part.column(0).slice(at, 1))
                    coded.append(ids)
                    held += len(ids) // 4
                    if held >= file_ids:
                        yield flush()
        if coded:
            yield flush()

    ship(docs.sparkSession)
    dealt = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    files = dealt.mapInArrow(run, f"nth long, doc_ids array<{kind}>, n_ids long, data binary")
    files.select(F.spark_partition_id().cast("long").alias("part"), "*").write.parquet(path)


def read_token_files(spark: SparkSession, path: str, crc32: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document: ``start`` counts the ids of all documents before it.

    ``crc32`` asks for the checksum ``ids_crc32`` of the ids' bytes in place of the ids.
    """
    files = spark.read.parquet(path)
    sizes = files.select("part", "nth", "n_ids")
    # Files before this one in its part, and parts before it: sums over few rows, one a file and one a part.
    inner = F.sum("n_ids").over(W.partitionBy("part").orderBy("nth")) - F.col("n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("total"))
    outer = parts.select("part", (F.sum("total").over(W.orderBy("part")) - F.col("total")).alias("base"))
    offsets = sizes.withColumn("inner", inner).join(outer, "part")
    offsets = stage(offsets.select("part", "nth", (F.col("base") + F.col("inner")).alias("base")), "token-offsets")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                ids, lengths = read_file(batch.column(1)[at].as_py())
                ends = np.cumsum(lengths.astype(np.int64))
                raw = ids.astype("<u4").tobytes()
                starts = ends - lengths
                cut = [raw[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist())]
                held = pa.array(map(zlib.crc32, cut), pa.int64()) if crc32 else pa.array(cut, pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[at].values, pa.array(starts + batch.column(2)[at].as_py()), pa.array(ends - starts), held],
                    ["doc_id", "start", "n_tokens", "ids_crc32" if crc32 else "ids"],
                )

    ship(spark)
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()
    met = files.join(offsets, ["part", "nth"]).select("doc_ids", "data", "base")
    return met.mapInArrow(run, f"doc_id {kind}, start long, n_tokens long, " + ("ids_crc32 long" if crc32 else "ids binary"))
