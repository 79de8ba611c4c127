"""Line dedup, hard negatives and the Merkle manifest against brute force."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrasheaf.llm import hard_negatives, line_dedup, merkle

DOCS = "doc_id long, text string, lang string, source string, n_chars long, n_lines string, id string, gone string, idx string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, n, "x", "x", "x", "x") for i, t, lang, s, n in rows], DOCS)


# ---------------------------------------------------------------------- line dedup


def texts():
    r = random.Random(3)
    pool = ["Alpha beta", " alpha BETA\t", "ÄRGER über alles", "ärger über alles", "", "  ", "one", "x" * 3000] + [f"line {k}" for k in range(12)]
    rows = [(i, "\n".join(r.choices(pool, k=r.randrange(9))), "en", "s", 1) for i in range(60)]
    rows += [(100, None, None, None, None), (101, "", "en", "s", 0), (None, "one\nline 3", "en", "s", 1), (None, "one\nline 3", "en", "s", 1), (7, "one\ntwice\ntwice", "en", "s", 1)]
    return rows + [(102, "\n".join(f"own {k}\nline 1" for k in range(20_000)), "en", "s", 1)]


def without_lines(rows, least):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    seen = Counter(k for r in rows for k in {key(x) for x in (r[1] or "").split("\n")} if k)
    out = []
    for r in rows:
        lines = (r[1] or "").split("\n")
        kept = [x for x in lines if seen[key(x)] < least]
        out.append((r[0], "\n".join(kept) if len(kept) < len(lines) else r[1], len(lines), len(lines) - len(kept)))
    return out


@pytest.mark.parametrize("least, fan_in, parts", [(3, 2, 5), (1, 3, 4), (4, 2, 1)])
def test_lines_against_brute_force(spark, least, fan_in, parts):
    rows = texts()
    batches = [frame(spark, rows[k::parts]) for k in range(parts)]
    got = line_dedup.drop_repeated(batches, least, fan_in)
    assert got.columns == [c for c in batches[0].columns if c != "n_lines"] + ["n_lines", "n_dropped"]
    got = got.select("doc_id", "text", "n_lines", "n_dropped").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, without_lines(rows, least)))


def test_runs_are_levelled_sorted_and_merged_in_place(spark):
    rows = texts()
    runs = line_dedup.LineRuns(spark, 1000, 2)
    sizes = []
    for k in range(7):
        runs.add(frame(spark, rows[k::7]))
        sizes.append([len(level) for level in runs.levels])
    assert sizes == [[1], [0, 1], [1, 1], [0, 0, 1], [1, 0, 1], [0, 1, 1], [1, 1, 1]]
    a, b = (spark.table(level[0][0]) for level in runs.levels[1:3])
    plan = a.hint("merge").join(b.withColumnRenamed("n", "m"), "mark", "full_outer")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    runs.compact()
    (level,) = [level for level in runs.levels if level]
    total = spark.table(level[0][0])
    assert total.count() == total.select("mark").distinct().count() and len(level) == 1
    runs.close()


def test_lines_of_empty_tables_and_refused_bounds(spark):
    assert line_dedup.drop_repeated([frame(spark, []), frame(spark, [])]).count() == 0
    with pytest.raises(ValueError):
        line_dedup.LineRuns(spark, 0)


# ------------------------------------------------------------------ hard negatives


def vectors():
    r = np.random.default_rng(4)
    centre = r.normal(size=(3, 8))
    rows = [(i, [float(x) for x in centre[i % 3] + r.normal(size=8) * 0.4], i % 3) for i in range(160)]
    rows += [(200 + i, rows[5][1], i % 2) for i in range(30)]  # copies: ties in every score
    rows += [(300, None, 1), (301, [1.0, None] * 4, 1), (302, [math.nan] * 8, 1), (303, [math.inf] * 8, 1), (304, rows[0][1], None)]
    rows += [(None, rows[0][1], 1), (305, [0.0] * 8, 1), (306, [0.5], 1), (306, [0.5], 1), (307, [], 2), (308, [1e30] * 8, 1)]
    return rows


def mined(rows, k, m):
    held = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or not all(x is not None and math.isfinite(x) and abs(x) <= hard_negatives.MOST_COMPONENT for x in v):
            continue
        held[i] = ([math.floor(256 * float(np.float32(x))) for x in v], label)
    score = lambda a, b: sum(x * y for x, y in zip(held[a][0], held[b][0]))
    out = []
    for a in (i for i in held if i % 5 == 0):
        order = sorted((-score(a, b), b) for b in held if b != a)
        for p, i in [(-s, b) for s, b in order if held[b][1] == held[a][1]][:k]:
            fits = [(-s, b) for s, b in order if held[b][1] != held[a][1] and 50 * p <= -100 * s <= 95 * p][:m]
            out += [(a, i, n + 1, b, p, s) for n, (s, b) in enumerate(fits)]
    return sorted(out)


@pytest.mark.parametrize("shard_rows, block_rows", [(1 << 14, 1 << 11), (40, 7)])
def test_negatives_against_brute_force(spark, shard_rows, block_rows):
    given = spark.createDataFrame([(i, v, label, 1, 2) for i, v, label in vectors()], "vec_id long, embedding array<float>, label int, name int, high int")
    rows = hard_negatives.integer_rows(given.unionByName(given.where("vec_id = 3")).repartition(5))
    got = hard_negatives.mine(rows, F.col("vec_id") % 5 == 0, shard_rows=shard_rows, block_rows=block_rows)
    want = mined(vectors(), 5, 3)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 100
    nothing = hard_negatives.mine(rows.limit(0), F.col("vec_id") % 5 == 0)
    assert nothing.columns == got.columns and nothing.count() == 0


def test_the_threshold_stops_a_search_early():
    r = np.random.default_rng(1)
    vectors_ = r.integers(-9, 10, (4000, 6)).astype(np.int64)
    vectors_[:20] += 200
    shard = hard_negatives.Shard(np.arange(4000), np.zeros(4000, np.int64), vectors_)
    anchor = np.array([5, 4, 3, 2, 1, 0])
    all_ = np.ones(4000, bool)
    (best,), scores, met = shard.search(anchor, all_, np.array([-(1 << 62)]), np.array([1 << 62]), 3)
    exact = vectors_ @ anchor
    assert best.tolist() == np.lexsort((np.arange(4000), -exact))[:3].tolist() and met < 400
    # A window that holds too few rows ends once the threshold is below it.
    (best,), _, met = shard.search(anchor, all_, np.array([2000]), np.array([1 << 62]), 50)
    assert len(best) == (exact >= 2000).sum() == 20 and met < 4000


# ------------------------------------------------------------------------ manifest


def leaf_rows():
    rows = [(i * 3 - 70, f"Text {i} Ä", "en" if i % 2 else None, ["a", "b", None, "Ö", "ab"][i % 5 if i < 200 else 0], i) for i in range(430)]
    rows += [(None, "No id", "en", "a", 1), (None, "No id", "en", "a", 1), (None, "Other", "en", "a", 1)]
    rows += [(5, "Same", "en", "b", None), (5, "Same", "en", "b", None), (5, "else", "en", "b", 2), (10**15, None, None, "far", None)]
    return rows + [(-(10**17), "A" * 100_000, "en", "a", 1), (2, "", "en", "", 0)]


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(i, text, lang, source, n):
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, text)))


def tree(hashes):
    levels = [hashes]
    while len(levels[-1]) > 1:
        levels.append([H("".join(levels[-1][i : i + 16])) for i in range(0, len(levels[-1]), 16)])
    return levels


def sides(levels, i):
    out = []
    for hashes in levels[:-1]:
        a = i - i % 16
        out.append(("".join(hashes[a:i]), "".join(hashes[i + 1 : a + 16])))
        i //= 16
    return out


def manifest_of(rows):
    by = {}
    for r in rows:
        by.setdefault(r[3], []).append(r)
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for s in order:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
    trees = {s: tree([leaf(*r) for r in by[s]]) for s in order}
    top = tree([trees[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for i, r in enumerate(by[s]):
            path = sides(trees[s], i) + sides(top, k)
            text = r[1].translate(LOWER) if r[0] is not None and r[1] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 else r[1]
            folded = leaf(r[0], text, *r[2:])
            for left, right in path:
                folded = H(left + folded + right)
            out.append((r[0], trees[s][0][i], trees[s][-1][0], top[-1][0], H("".join(a + b for a, b in path)), folded, folded == top[-1][0]))
    return out


def manifest_rows(docs):
    rows = merkle.manifest(docs, {"text": merkle.tampered(F.col("text"), F.col("doc_id"))})
    folded = merkle.fold(F.col("presented_leaf"), F.col("path"))
    return rows.select("doc_id", "leaf", "subroot", "root", merkle.proof(F.col("path")), folded, folded == F.col("root"))


def test_manifest_against_brute_force(spark):
    rows = leaf_rows()
    random.Random(2).shuffle(rows)
    got = manifest_rows(frame(spark, rows).repartition(7)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, manifest_of(rows)))
    assert {g[6] for g in got} == {True, False}


@pytest.mark.parametrize("n", [0, 1, 17])
def test_manifest_of_small_tables(spark, n):
    rows = [(i, "Text", "en", "only", 4) for i in range(n)]
    assert sorted(map(tuple, manifest_rows(frame(spark, rows)).collect())) == sorted(manifest_of(rows) if n else [])


def test_ranks_with_repeats_in_wide_and_dense_ids(spark):
    r = random.Random(9)
    ids = [r.randrange(-(1 << 62), 1 << 62) for _ in range(300)] + [r.randrange(2000) for _ in range(900)] + [63, 63, 64, -1, -64, -65]
    rows = [(k % 3, i) for k, i in enumerate(ids)]
    ranked, tied = merkle.bitmap_ranks(spark.createDataFrame(rows, "g long, id long"), ["g"], "id", "rank", "tied")
    assert tied
    for g, i, rank, shared in ranked.select("g", "id", "rank", "tied").collect():
        own = [x for h, x in rows if h == g]
        assert rank == sum(x < i for x in own) and shared == (own.count(i) > 1)
