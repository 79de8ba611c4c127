"""Merkle manifest of a table of documents, with leaf places from bitmap ranks.

Each row is a leaf.  The leaves of a source ascend by doc_id, every RUN of them
become a node, and so on up to the source's subroot; the subroots, in the order
of the sources, are reduced in the same way to one root.

Leaves get their places without a global or per-source sort.  The doc_ids of a
source are a bitmap of 64-bit words, of which only those with a bit are kept;
partial words are merged by OR.  Directories hold the row counts before each
word, one level for every RADIX_BITS bits of the word number, so no window has
more than 2^RADIX_BITS rows, however large a source is.  The rank of a doc_id is
the directory's count plus the bits below its own in its word.  A place
(source, rank) then gives a node's key and slot: nodes are grouped by
(source, rank / RUN) into arrays ordered by slot, level by level.

Going down again, each node hands its children the siblings on the way to the
root, so a row learns its proof from a parent that 16 rows share, and no row is
joined with every level.

Only hashes, ids and proofs are moved, never texts.  All of it is DataFrame code.

Defined cases: a null field is ``-`` in its leaf; rows without a doc_id come
before all others of their source; rows that repeat a doc_id in a source are
leaves of their own in the order of their leaf hashes (placed by bitmaps over
the hashes, so a doc_id on very many rows is never gathered); null sources are one
source; very long texts only make their own leaf's input longer; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage

RUN_BITS, WORD_BITS, RADIX_BITS = 4, 6, 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_FIRST_ID = -(1 << 63)
_NOTHING = "cast('' as binary)"


def sha(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def hex_of(value: Column) -> Column:
    return F.lower(F.hex(value))


def leaf_hash(fields: dict[str, Column]) -> Column:
    """Hash of FIELDS: each is its length in bytes, a colon and its value, or ``-``."""
    parts = []
    for name in FIELDS:
        value = fields[name].cast("string")
        parts += [F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))]
    return sha(*parts)


# ------------------------------------------------------------------- bitmap ranks


def directory(words: DataFrame, group: list[str]) -> DataFrame:
    """``words`` (group, word, n, ...) with ``before``: the rows of the group in smaller words."""
    row = words.agg(F.min("word"), F.max("word")).first()
    shifts = [0]
    while row[0] is not None and (row[1] >> shifts[-1]) - (row[0] >> shifts[-1]) >= 1 << RADIX_BITS:
        shifts.append(shifts[-1] + RADIX_BITS)
    names = [f"_p{k}" for k in range(len(shifts))]
    levels = [words.withColumn(names[0], F.col("word"))]
    for low, name in zip(names, names[1:]):
        up = levels[-1].groupBy(*group, F.shiftright(low, RADIX_BITS).alias(name)).agg(F.sum("n").alias("n"))
        levels.append(up)

    def counted(level: DataFrame, name: str) -> DataFrame:
        # Of the last level a group has few rows, all others are counted from the start of their range.
        ranges = [] if name == names[-1] else [F.shiftright(name, RADIX_BITS)]
        inside = Window.partitionBy(*group, *ranges).orderBy(name).rowsBetween(Window.unboundedPreceding, -1)
        return level.withColumn("before", F.coalesce(F.sum("n").over(inside), F.lit(0)))

    out = counted(levels[-1], names[-1])
    for k in range(len(levels) - 2, -1, -1):
        above = out.select(*group, F.col(names[k + 1]), F.col("before").alias("_above"))
        here = counted(levels[k], names[k]).withColumn(names[k + 1], F.shiftright(names[k], RADIX_BITS))
        out = here.join(above, [*group, names[k + 1]]).withColumn("before", F.col("before") + F.col("_above")).drop(names[k + 1], "_above")
    return out.drop(names[0])


def bitmap_ranks(rows: DataFrame, group: list[str], key: str, rank: str, tied: str) -> tuple[DataFrame, bool]:
    """``rows`` with ``rank`` (rows of the group with a smaller key) and ``tied`` (others share the key).

    ``group`` and ``key`` are not null, ``key`` is long.  Also tells whether any key is shared.
    """
    word, bit = F.shiftright(key, WORD_BITS), F.col(key).bitwiseAND(F.lit((1 << WORD_BITS) - 1)).cast("int")
    one = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
    words = rows.groupBy(*group, word.alias("word")).agg(F.bit_or(one).alias("bits"), F.count("*").alias("n"))
    words = stage(words, "bitmap-words")
    full = F.bit_count("bits") < F.col("n")
    some_tied = bool(words.where(full).limit(1).count())
    index = directory(words, group)
    extra = F.lit(0)
    if some_tied:
        places = rows.select(*group, key, word.alias("word"))
        doubled = places.join(words.where(full).select(*group, "word"), [*group, "word"], "left_semi")
        doubled = doubled.groupBy(*group, "word", key).agg((F.count("*") - 1).alias("more")).where("more > 0")
        # At most one entry for each of the 64 ids of a word.
        held = doubled.groupBy(*group, "word").agg(F.collect_list(F.struct(F.col(key).alias("id"), "more")).alias("repeats"))
        index = index.join(held, [*group, "word"], "left")
        below = F.filter(F.coalesce("repeats", F.array().cast("array<struct<id:bigint,more:bigint>>")), lambda r: r["id"] < F.col(key))
        extra = F.aggregate(below, F.lit(0).cast("long"), lambda n, r: n + r["more"])
    index = index.drop("n").hint("shuffle_hash")
    smaller = F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("long"), bit))
    lower = F.bit_count(F.col("bits").bitwiseAND(smaller))
    met = rows.withColumn("word", word).join(index, [*group, "word"])
    shared = F.coalesce(F.exists("repeats", lambda r: r["id"] == F.col(key)), F.lit(False)) if some_tied else F.lit(False)
    met = met.withColumns({rank: F.col("before") + lower + extra, tied: shared})
    return met.drop("word", "bits", "before", "repeats"), some_tied


def leaf_places(leaves: DataFrame) -> DataFrame:
    """``leaves`` (g1, g2, id, leaf, nth, ...) with ``idx``, the place within the source from 0."""
    placed, tied = bitmap_ranks(leaves, ["g1", "g2"], "id", "idx", "tied")
    if not tied:
        return placed.drop("tied")
    placed = stage(placed.withColumn("leaf_id", F.conv(F.substring(F.hex("leaf"), 1, 15), 16, 10).cast("long")), "merkle-tied")
    again, same = bitmap_ranks(placed.where("tied").drop("tied"), ["g1", "g2", "id"], "leaf_id", "by_leaf", "same")
    if same:  # equal rows, in any order
        again = stage(again, "merkle-same")
        last, _ = bitmap_ranks(again.where("same"), ["g1", "g2", "id", "leaf_id"], "nth", "by_row", "_never")
        again = again.where("not same").withColumn("by_row", F.lit(0).cast("long")).unionByName(last.drop("_never"))
        again = again.withColumn("by_leaf", F.col("by_leaf") + F.col("by_row")).drop("by_row")
    again = again.withColumn("idx", F.col("idx") + F.col("by_leaf")).drop("by_leaf", "same", "leaf_id")
    return placed.where("not tied").drop("tied", "leaf_id").unionByName(again)


# --------------------------------------------------------------------------- tree


def _runs(nodes: DataFrame, payload: list[str]) -> DataFrame:
    """Nodes (g1, g2, idx, hash) gathered into runs: g1, g2, run, kids (ordered by slot), lone."""
    slot = F.col("idx").bitwiseAND(F.lit((1 << RUN_BITS) - 1)).cast("int").alias("slot")
    runs = nodes.groupBy("g1", "g2", F.shiftright("idx", RUN_BITS).alias("run")).agg(
        F.array_sort(F.collect_list(F.struct(slot, "hash", *payload))).alias("kids")
    )
    # Places have no gaps, so a single node in the first run is its group's only one.
    return runs.withColumn("lone", (F.col("run") == 0) & (F.size("kids") == 1))


def _join(kids: Column) -> Column:
    return F.aggregate(kids, F.expr(_NOTHING), lambda got, kid: F.concat(got, kid["hash"]))


def climb(leaves: DataFrame, payload: list[str]) -> tuple[list[DataFrame], DataFrame]:
    """Runs of every level, and the tops (g1, g2, hash, level) of all groups.

    ``level`` counts from 1: a group of one leaf has its top there, unhashed.
    """
    levels = [stage(_runs(leaves, payload), "merkle-runs-0")]
    tops: DataFrame | None = None
    while True:
        # Of a level above the leaves only runs with something to hash are kept.
        whole = F.unhex(sha(hex_of(_join(F.col("kids")))))
        own = F.when(F.col("lone"), F.col("kids")[0]["hash"]).otherwise(whole)
        nodes = levels[-1].select("g1", "g2", F.col("run").alias("idx"), own.alias("hash"))
        runs = stage(_runs(nodes, []), f"merkle-runs-{len(levels)}")
        done = runs.where("lone").select("g1", "g2", F.col("kids")[0]["hash"].alias("hash"), F.lit(len(levels)).alias("level"))
        tops = done if tops is None else tops.unionByName(done)
        rest = runs.where("not lone")
        if not rest.limit(1).count():
            return levels, tops
        levels.append(rest)


def descend(levels: list[DataFrame], tops: DataFrame, payload: list[str]) -> DataFrame:
    """Leaves (g1, g2, idx, hash, payload, top, path).

    ``tops``: g1, g2, level, top, path (siblings above the top).  ``path`` has the
    hashes left and right of the node and of each node above it, from below.
    """
    parents = None
    for level in range(len(levels), 0, -1):
        own = tops.where(F.col("level") == level).select("g1", "g2", F.lit(0).cast("long").alias("run"), "top", "path")
        parents = own if parents is None else own.unionByName(parents)
        met = levels[level - 1].join(parents, ["g1", "g2", "run"])
        each = met.select("*", F.explode("kids").alias("kid"))
        sides = F.struct(
            _join(F.filter("kids", lambda k: k["slot"] < F.col("kid.slot"))).alias("left"),
            _join(F.filter("kids", lambda k: k["slot"] > F.col("kid.slot"))).alias("right"),
        )
        path = F.when(F.col("lone"), F.col("path")).otherwise(F.concat(F.array(sides), F.col("path")))
        idx = F.shiftleft("run", RUN_BITS) + F.col("kid.slot")
        held = payload if level == 1 else []
        below = each.select("g1", "g2", idx.alias("run"), "top", path.alias("path"), "kid.hash", *[f"kid.{c}" for c in held])
        if level == 1:
            return below.withColumnRenamed("run", "idx")
        parents = below.drop("hash")
    raise ValueError("a tree has a level of leaves at least")


def ordered(rows: DataFrame, *order: Column) -> DataFrame:
    """``rows`` with ``idx``: its place in the order, by ranges and their offsets."""
    cut = stage(rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranges")
    sizes = cut.groupBy("_part").agg(F.count("*").alias("n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each task
    offsets = sizes.select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_part").orderBy(*order)
    return cut.join(offsets, "_part").withColumn("idx", F.col("_before") + F.row_number().over(inside) - 1).drop("_part", "_before")


def manifest(docs: DataFrame, presented: dict[str, Column] | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, path, presented_leaf of every row of ``docs``.

    ``presented`` replaces fields of the rows that someone shows for checking;
    ``presented_leaf`` is the leaf of those.  Hashes are lowercase hex text, but
    binary in ``path``; see :func:`proof` and :func:`fold` for its use.
    """
    fields = {name: F.col(f"`{name}`") for name in FIELDS}
    source = fields["source"].cast("string")
    key = (source.isNull(), F.coalesce(source, F.lit("")))
    leaves = docs.select(
        F.xxhash64(*key).alias("g1"),
        F.xxhash64(*key, F.lit(1)).alias("g2"),
        source.alias("source"),
        F.col("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_FIRST_ID)).alias("id"),
        F.unhex(leaf_hash(fields)).alias("leaf"),
        F.unhex(leaf_hash(fields | (presented or {}))).alias("shown"),
        F.monotonically_increasing_id().alias("nth"),
    )
    leaves = stage(leaves, "merkle-leaves")
    payload = ["doc_id", "shown"]
    nodes = leaf_places(leaves.drop("source")).select("g1", "g2", "idx", F.col("leaf").alias("hash"), *payload)
    levels, tops = climb(nodes, payload)
    names = leaves.groupBy("g1", "g2").agg(F.min("source").alias("source"))
    tops = ordered(tops.join(names, ["g1", "g2"]), F.asc_nulls_first("source"))
    tops = stage(tops.select("idx", "hash", F.struct("g1", "g2", "level").alias("of")), "merkle-tops")
    zero = F.lit(0).cast("long")
    above, root = climb(tops.select(zero.alias("g1"), zero.alias("g2"), "idx", "hash", "of"), ["of"])
    nothing = F.array().cast("array<struct<left:binary,right:binary>>")
    roots = descend(above, root.select("g1", "g2", "level", F.col("hash").alias("top"), nothing.alias("path")), ["of"])
    # The root travels down as ``root``, the subroots as ``top``.
    first = roots.select("of.g1", "of.g2", "of.level", F.struct(F.col("hash").alias("subroot"), F.col("top").alias("root")).alias("top"), "path")
    rows = descend(levels, stage(first, "merkle-subroots"), payload)
    return rows.select(
        "doc_id",
        hex_of(F.col("hash")).alias("leaf"),
        hex_of(F.col("top.subroot")).alias("subroot"),
        hex_of(F.col("top.root")).alias("root"),
        "path",
        hex_of(F.col("shown")).alias("presented_leaf"),
    )


def proof(path: Column) -> Column:
    """Hash of all siblings of a path in order."""
    return sha(hex_of(F.aggregate(path, F.expr(_NOTHING), lambda got, side: F.concat(got, side["left"], side["right"]))))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf has with the siblings of a path."""
    return F.aggregate(path, leaf, lambda got, side: sha(hex_of(side["left"]), got, hex_of(side["right"])))


def tampered(text: Column, doc_id: Column) -> Column:
    """The text with A-Z lower-cased where 5 divides the CRC-32 of the decimal doc_id."""
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(F.crc32(doc_id.cast("string")) % 5 == 0, lower).otherwise(text)
