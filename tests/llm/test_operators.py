"""Operators on small hand-made tables, against brute force: nulls, empty and long texts,
ties, repeated rows, empty tables, extra columns with clashing names."""

import hashlib
import os
import random
import re
import zlib

import numpy as np
import pytest
from brute import near_components
from pyspark.sql import functions as F

from terrasheaf.llm import (
    bpe,
    decontamination,
    html_text,
    importance,
    language_id,
    near_copies,
    quality_rules,
    simhash,
    span_dedup,
    token_files,
    url_filter,
)
from terrasheaf.llm.common import build_filter, connected_components, key_hashes, may_contain, merge_labels, stage
from terrasheaf.llm.queries import vocabulary

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, key string, whole string, mark string, spans string, given string, _id string, _keep_id string, _nth string, n_words string"
EXTRA = ("x",) * 9
WORDS = "the of and to in is that river stone garden letter window morning silver under quiet table winter bridge yellow".split()


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(
        (w.capitalize() if k % 9 == 0 else w) + ("." if k % 9 == 8 else "") for k, w in enumerate(r.choices(WORDS, k=n))
    )


@pytest.fixture(scope="module")
def rows():
    long = prose(5, 30_000)
    passage = prose(77, 63)
    return [
        (1, None), (2, ""), (3, "   \n\t "), (4, "word"), (5, prose(1, 80)), (6, prose(1, 80)), (6, prose(1, 80)), (7, long),
        (8, long + " Tail."), (None, prose(2, 60)), (None, prose(2, 60)), (9, "ÀÉ ßtraße 日本語 x<|endoftext|>y  z\n\n q's"),
        (10, prose(3, 36) + " " + passage), (11, passage + "\n" + prose(4, 40)), (12, "### " * 40), (13, "a" * 5000), (14, prose(6, 80)),
    ]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), *EXTRA, "x") for i, t in rows], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def same_rows(got, want):
    return sorted(map(repr, got)) == sorted(map(repr, want))


# ------------------------------------------------------------------ quality rules


def counts_of(text):
    ws = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = {}
    for i in range(len(ws) - 7):
        windows.setdefault(tuple(ws[i : i + 8]), []).append(i)
    hit = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(8)}
    return len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit)


def test_quality_counts(docs, rows):
    extra = [(20, "a b c d e f g h " * 3 + "tail"), (21, "one\none\n \none two"), (22, "x " * 30)]
    table = docs.select("doc_id", "text").union(docs.sparkSession.createDataFrame(extra, "doc_id long, text string"))
    got = quality_rules.measures(table).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()
    assert same_rows([tuple(r) for r in got], [(i, *counts_of(t)) for i, t in rows + extra])


def test_quality_keeps_columns_and_clean(spark, docs, empty):
    junk = spark.createDataFrame(
        [(100 + k, " ".join(w + "###" for w in prose(k, 60).split()), "en", "s", 1, *EXTRA, "x") for k in range(12)]
        + [(200 + k, prose(900 + k, 60), "en", "s", 1, *EXTRA, "x") for k in range(60)],
        SCHEMA,
    )
    kept = quality_rules.keep_good(docs.union(junk))
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert not [i for i in ids if i is not None and (i in (1, 2, 3, 4, 12) or 100 <= i < 112)]
    assert {200 + k for k in range(60)} <= set(ids) and ids.count(6) == 2 and ids.count(None) == 2
    assert quality_rules.keep_good(empty).count() == 0
    judged = quality_rules.judge(docs)
    assert judged.count() == docs.count() and judged.where("kept is null").count() == 0


# ------------------------------------------------------------------------ simhash


def test_fingerprint_against_plain_loop():
    import xxhash

    for text in (None, "", "One", "a B c D e f", prose(8, 300)):
        ws = [w.lower() for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
        shingles = [" ".join(ws[i : i + 4]) for i in range(max(1, len(ws) - 3))] if ws else []
        hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))
        assert simhash.fingerprint_of(text, 4)[0] % (1 << 64) == want


@pytest.mark.parametrize("most", [3, 6])
def test_index_finds_every_link(most):
    rng = np.random.default_rng(most)
    base = rng.integers(0, 2**63, 30, dtype=np.uint64)
    codes = base
    for _ in range(40):
        flips = np.uint64(1) << rng.integers(0, 64, len(base)).astype(np.uint64)
        codes = np.unique(np.r_[codes, base ^ flips, rng.choice(codes, 30) ^ flips])
    for buckets in (1, 4):
        bucket = np.sort(rng.integers(0, buckets, len(codes)))
        a, b = simhash.spanning_links(bucket, codes, most, codes)
        found, want = np.arange(len(codes)), np.arange(len(codes))
        merge_labels(found, np.searchsorted(codes, a), np.searchsorted(codes, b))
        merge_labels(want, *np.nonzero((np.bitwise_count(codes[:, None] ^ codes) <= most) & (bucket[:, None] == bucket)))
        assert np.array_equal(found, want) and len(a) < len(codes)


@pytest.mark.parametrize("bucket_rows", [1 << 16, 3])
def test_components_against_all_pairs(spark, bucket_rows):
    rng = random.Random(4)
    codes = [rng.getrandbits(64) for _ in range(40)] + [0]
    for _ in range(120):
        code = rng.choice(codes)
        for _ in range(rng.randrange(1, 4)):
            code ^= 1 << rng.randrange(64)
        codes.append(code)
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    ids = list(range(len(codes)))
    rng.shuffle(ids)
    table = spark.createDataFrame([(i, c, []) for i, c in zip(ids, signed)] + [(None, signed[0], [])], "doc_id long, fp long, more array<long>")
    got = {r["doc_id"]: r["component_id"] for r in simhash.components(table, 4, 0, bucket_rows).collect()}
    lab = np.arange(len(codes))
    arr = np.array(codes, np.uint64)
    merge_labels(lab, *np.nonzero(np.bitwise_count(arr[:, None] ^ arr) <= 4))
    least = {}
    for root, i in zip(lab, ids):
        least[root] = min(least.get(root, i), i)
    assert {i: least[root] for root, i in zip(lab, ids)} == {i: c for i, c in got.items() if i is not None}
    assert got[None] == least[lab[0]]


def test_deduplicate(docs, empty):
    kept = near_copies.deduplicate(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    # 1, 2 and 3 have no words and are one group; 5 and both 6 are copies; 7 and 8 near copies.
    assert sorted(i for i in ids if i) == [1, 4, 5, 7, 9, 10, 11, 12, 13, 14] and ids.count(None) == 2
    assert near_copies.deduplicate(empty).count() == 0


def edited(text, seed, share):
    r = random.Random(seed)
    return " ".join(w if r.random() >= share else f"new{r.randrange(10**6)}" for w in text.split())


@pytest.mark.parametrize("bucket_rows", [1 << 16, 20])
def test_near_copies_against_all_pairs(spark, bucket_rows):
    """Copies that are like their original but not like each other, copies of copies, and families that are near only."""
    texts = []
    for k in range(4):
        original = prose(500 + k, 400)
        texts += [original, original, *(edited(original, 10 * k + n, 0.018) for n in range(25))]
        chain = prose(700 + k, 300)
        for n in range(12):
            chain = edited(chain, n, 0.02)
            texts.append(chain)
        texts += [edited(prose(800 + k, 300), n, 0.035) for n in range(12)]
    texts += [None, "", "one two", "One TWO", "one"]
    order = random.Random(1).sample(range(len(texts)), len(texts))
    table = spark.createDataFrame([(i, texts[k]) for i, k in enumerate(order)] + [(None, texts[0])], "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_copies.near_copies(table, bucket_rows=bucket_rows).collect()}
    lab = near_components([texts[k] for k in order])
    assert got == {i: int(lab[i]) for i in range(len(order))}
    assert len(set(lab)) < len(texts) - 80  # the groups are found, not only candidates confirmed


def test_no_round_joins_links_of_the_round_before(spark, monkeypatch):
    """Each link meets the search for components once, whatever the number of rounds."""
    searched = []

    def counted(edges):
        searched.append([tuple(sorted(r)) for r in edges.where("a <> b").distinct().collect()])
        return connected_components(edges)

    monkeypatch.setattr(near_copies, "connected_components", counted)
    family = prose(901, 300)
    texts = [family, *(edited(family, n, 0.018) for n in range(12)), *(edited(prose(902, 300), n, 0.035) for n in range(12))]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_copies.near_copies(table).collect()}
    assert got == {i: int(k) for i, k in enumerate(near_components(texts))}
    links = [pair for round_ in searched for pair in round_]
    assert len(searched) > 1 and links and len(links) == len(set(links))


def test_proposals_go_past_refused_ones():
    codes = np.repeat(np.array([[0], [1], [3]], np.uint64), near_copies.TESTED, axis=1)
    size, node, bucket = np.full(3, 100), np.array([7, 8, 9]), np.zeros(3, np.int64)
    none = (np.empty(0, np.int64),) * 3
    pairs = lambda label, bars, width=1: {
        tuple(sorted((int(node[i]), int(node[j])))) for i, j in zip(*near_copies.propose(bucket, codes, size, label, node, bars, width))
    }
    assert pairs(node, none) == {(7, 8), (8, 9)}
    assert pairs(node, (np.array([0]), np.array([7]), np.array([8]))) == {(7, 9), (8, 9)}
    assert pairs(np.array([7, 7, 9]), (np.array([0]), np.array([8]), np.array([9]))) == {(7, 9)}
    assert pairs(np.array([7, 7, 7]), none) == set()
    # Without a width every pair that no refusal bars is proposed at once.
    assert pairs(node, none, 0) == {(7, 8), (7, 9), (8, 9)}
    assert pairs(np.array([7, 8, 8]), (np.array([0]), np.array([7]), np.array([8])), 0) == {(7, 9)}
    # Fewer than four fifths of the shingles cannot be similar.
    size[2] = 79
    assert pairs(node, none, 4) == {(7, 8)}


def test_refused_pairs_of_a_group_are_no_rows(spark, monkeypatch):
    """A family just below the similarity: all its pairs are compared, but no table of them is made."""
    made = {}

    def counted(df, label):
        kept = stage(df, label)
        made[label] = max(made.get(label, 0), kept.count())
        return kept

    monkeypatch.setattr(near_copies, "stage", counted)
    original = prose(903, 300)
    texts = [edited(original, n, 0.03) for n in range(300)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_copies.near_copies(table).collect()}
    assert got == {i: int(k) for i, k in enumerate(near_components(texts))}
    # A document is dealt to 40 buckets; two documents meet as candidates 9,382 times.
    assert max(n for label, n in made.items() if label not in ("near-open", "near-contested")) <= 12 * len(texts), made
    assert max(made.values()) <= 80 * len(texts)


@pytest.mark.parametrize("part_bytes", [1, 3000, 40_000])
def test_near_copies_with_sets_dealt_to_parts(spark, part_bytes):
    texts = []
    for k in range(3):
        original, other = prose(510 + k, 300), prose(810 + k, 300)
        texts += [original, original, *(edited(original, 10 * k + n, 0.018) for n in range(15)), *(edited(other, n, 0.035) for n in range(12))]
    texts += [None, "", "one two"]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_copies.near_copies(table, part_bytes=part_bytes).collect()}
    assert got == {i: int(k) for i, k in enumerate(near_components(texts))}


def test_confirmed_links_join_all_similar_rows():
    """Links of all similar candidates, no more than two a row, whatever labels they begin with."""
    rng = np.random.default_rng(3)
    base = rng.choice(10_000, 100, replace=False)
    sets = [np.unique(np.where(rng.random(100) < 0.05, rng.integers(10_000, 20_000, 100), base)) for _ in range(60)] + [np.empty(0, np.int64)] * 3
    first, hashes = np.cumsum([0, *map(len, sets)]), np.concatenate(sets)
    n = len(sets)
    bucket = np.repeat([5, 9], [40, n - 40])
    codes = np.repeat(np.arange(n, dtype=np.uint64)[:, None] % np.uint64(4), near_copies.TESTED, axis=1)
    size, label = np.diff(first), np.r_[np.zeros(5, np.int64), np.arange(5, n)]
    i, j = near_copies.confirm(bucket, codes, size, label, first, hashes)
    got, want = np.arange(n), np.arange(n)
    merge_labels(got, np.zeros(5, np.int64), np.arange(5))
    merge_labels(want, np.zeros(5, np.int64), np.arange(5))
    merge_labels(got, i, j)
    pairs = [(a, b) for a in range(n) for b in range(a) if bucket[a] == bucket[b]]
    common = near_copies.shared(first, hashes, *np.array(pairs).T)
    assert common.tolist() == [len(np.intersect1d(sets[a], sets[b])) for a, b in pairs]
    links = np.array([p for p, c in zip(pairs, common) if c >= 0.8 * (len(sets[p[0]]) + len(sets[p[1]]) - c)])
    merge_labels(want, *links.T)
    assert got.tolist() == want.tolist() and len(i) < 2 * n < len(links)
    # Rows that have no candidate in another set need no sets.
    none = (np.empty(0, np.int64),) * 3
    args = codes[:3], np.array([100, 100, 70]), np.array([1, 2, 3]), np.array([7, 8, 9])
    assert near_copies.contested(np.zeros(3, np.int64), *args, none).tolist() == [True, True, False]
    assert not near_copies.contested(np.zeros(3, np.int64), *args, tuple(np.array([k]) for k in (0, 8, 7))).any()


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 102), (100, 102)], "a long, b long")
    got = {r["node"]: r["root"] for r in connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 102: 100}


# ---------------------------------------------------------------------- span dedup


def test_span_dedup(docs, rows, empty):
    out = span_dedup.remove_repeats(docs)
    assert out.columns == [*docs.columns, "n_sentences", "n_removed"]
    got = [(r["doc_id"], r["text"]) for r in out.collect()]
    texts = {i: t for i, t in got if i is not None}
    want = {i: t for i, t in rows if i is not None}
    passage = prose(77, 63)
    assert passage in texts[10] and passage not in texts[11] and texts[11].strip() == prose(4, 40)
    assert texts[1] is None and texts[2] == "" and texts[5] == want[5] and texts[6] == "" and texts[14] == want[14]
    assert len(got) == len(rows) and [i for i, _ in got].count(6) == 2
    # Repeats inside one long text go too, its first places stay.
    assert "".join(span_dedup.sentences(want[7])) == want[7] and texts[8].endswith("Tail.") and len(texts[8]) < 100
    assert span_dedup.remove_repeats(empty).count() == 0


def test_runs_ignore_white_space_only():
    more = "eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty"
    a = span_dedup.runs(f"One two three four. Five six seven. Eight nine ten {more}. End.")
    b = span_dedup.runs(f"One two  three four.\nFive six seven.   Eight nine ten  {more}.\tEnd.")
    assert [x[2] for x in a] == [x[2] for x in b] and len(a) == 1
    assert not span_dedup.runs("A. B. C. D. E.")


def test_short_lines_make_runs(spark):
    lines = [f"w{k}" for k in range(60)]
    first, later = "\n".join(["Its own words stand here.", *lines]), "\n".join([*lines, "Other words end this one."])
    table = spark.createDataFrame([(1, first), (2, later), (3, first)], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in span_dedup.remove_repeats(table).collect()}
    assert got == {1: first, 2: "Other words end this one.", 3: ""}


def test_all_sentences_of_a_repeated_passage_go(spark):
    sentence = lambda mark, n: " ".join(f"{mark}{k}" for k in range(n)) + "."
    three, two = " ".join([sentence("a", 22), sentence("b", 22), sentence("c", 15)]), " ".join([sentence("d", 45), sentence("e", 5)])
    table = spark.createDataFrame([(1, f"{three} One end. {two} Two."), (2, f"{three} Other end. {two} Last.")], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in span_dedup.remove_repeats(table).collect()}
    assert got[2] == "Other end. Last."


def test_passages_inside_long_sentences_go(spark):
    word = lambda mark, n: " ".join(f"{mark}{k}" for k in range(n))
    passage = word("p", 51)
    texts = [(k, f"{word(f'a{k}x', 30 + k)} {passage} {word(f'b{k}x', 300)}.") for k in range(12)]
    table = spark.createDataFrame(texts + [(20, None), (21, word("q", 39))], "doc_id long, text string")
    got = {r["doc_id"]: r for r in span_dedup.remove_repeats(table).collect()}
    assert got[0]["text"] == texts[0][1] and got[20]["text"] is None and got[21]["text"] == word("q", 39)
    for k, text in texts[1:]:
        left, own = got[k]["text"].split(), [w for w in text.split() if w[0] != "p"]
        # Up to the first and from the last content-defined place of the passage words may stay.
        assert [w for w in left if w[0] != "p"] == own and len(left) - len(own) <= 20
        assert got[k]["n_sentences"] > 20 and got[k]["n_removed"] > 2


def test_long_sentences_are_cut_by_their_words():
    text = "  " + " ".join(f"word{k}" for k in range(200)) + ".\nShort one here.\n\n" + "x " * 24 + "y"
    cut = span_dedup.sentences(text)
    assert "".join(cut) == text and "Short one here.\n\n" in cut
    assert cut[-1].split()[-1] == "y" and all(len(c.split()) <= 25 or not any(map(span_dedup.cuts, c.split()[:-1])) for c in cut)
    assert span_dedup.sentences("x " * 24) == ["x " * 24] and span_dedup.sentences(None) == span_dedup.sentences("") == []


def test_a_run_of_very_many_documents_is_dealt_once_a_batch(spark):
    passage = prose(8, 70)
    table = spark.createDataFrame([(k, f"{prose(1000 + k, 30)}\n{passage}") for k in range(400)] + [(None, passage), (None, passage)], "doc_id long, text string")
    spans = span_dedup._spans(table.repartition(2)).toPandas()
    hot = spans.groupby(["h1", "h2"]).later.agg(["size", "sum"])
    assert hot["size"].max() >= 401 and (hot["size"] - hot["sum"]).max() <= 4
    got = span_dedup.remove_repeats(table).collect()
    assert sum(r["text"].endswith(passage) for r in got) == 2 and all(r["text"] == passage for r in got if r["doc_id"] is None)


# ----------------------------------------------------------------- decontamination


def test_repeated_words_are_gone_through_once():
    import time

    bench = decontamination.Benchmark([("a", "no " * 400), ("b", "no " * 400), ("c", "no " * 12 + "yes")], 10)
    start = time.process_time()
    (found,) = decontamination.search_shard(["no " * 20_000], bench)
    assert time.process_time() - start < 10  # 32 seconds when every window went through its range at every depth
    assert found[0] == 20_000 and found[1] == [(0, 20_000)] and sorted(found[2]) == ["a", "b", "c"] and found[3] == 400


def naive_hits(text, items, window=10):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    ws, hit, named = cut(text), set(), set()
    for name, item in items:
        iw = cut(item)
        n = min(window, len(iw))
        for s in range(len(iw) - n + 1 if n else 0):
            for i in range(len(ws) - n + 1):
                if ws[i : i + n] == iw[s : s + n]:
                    hit |= set(range(i, i + n))
                    named.add("" if name is None else str(name))
    return len(ws), sorted(hit), sorted(named)


@pytest.mark.parametrize("block_bytes", [1 << 25, 100])
def test_matches_against_plain_search(spark, block_bytes):
    rng = random.Random(9)
    letters = ["aa", "bb", "cc", "Dd", "é"]
    items = [(k, " ".join(rng.choices(letters, k=rng.randrange(1, 25)))) for k in range(12)]
    items += [(3, items[3][1]), (None, "qq rr"), (40, None), (41, "!!"), (42, "zz " * 30)]
    texts = [(k, " ".join(rng.choices(letters, k=rng.randrange(0, 120)))) for k in range(25)]
    texts += [(50, None), (51, ""), (52, "x QQ-rr y"), (53, "zz " * 45 + "aa"), (53, "zz " * 45 + "aa"), (54, items[5][1].upper())]
    docs = spark.createDataFrame([(i, t, "x") for i, t in texts], "doc_id long, text string, n_words string")
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, spans int")
    got = [
        (r["doc_id"], r["n_words"], [p for s in r["spans"] for p in range(s["first"], s["end"])], r["items"])
        for r in decontamination.matches(docs, bench, block_bytes=block_bytes).collect()
    ]
    assert same_rows(got, [(i, *naive_hits(t, items)) for i, t in texts])


def test_decontaminate(spark, docs, empty):
    bench = spark.createDataFrame([(1, prose(77, 63)), (2, None)], "item_id long, text string")
    kept = decontamination.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert 10 not in ids and 11 not in ids and len(ids) == docs.count() - 2
    assert decontamination.decontaminate(empty, bench).count() == 0
    assert decontamination.decontaminate(docs, bench.limit(0)).count() == docs.count()


def test_longest_match_and_suffix_order():
    bench = decontamination.Benchmark([("a", "w1 w2 w3 w4 w5")], 3)
    assert decontamination.search_shard(["x w2 w3 w4 w5 y w1 w2"], bench) == [(8, [(1, 5)], ["a"], 4)]
    text = np.random.default_rng(0).integers(0, 3, 400)
    places = np.arange(400)
    got = decontamination.suffix_array(text, places, 500)
    key = lambda p: [*text[p : p + int(np.argmax(np.r_[text[p:], 0] == 0))].tolist(), 0]
    assert [key(p) for p in got] == sorted(key(p) for p in places)


# ------------------------------------------------------------------------- tokens

ODD = ["", None, " ", "  ", "a  b", "a \n b", " a", "a\n", "x<|endoftext|>y <|startoftext|>", "it's 'S DON'T ΑΣ İ", "a\x85b\xa0c \x1c d", "é日本 ½²", "!!!...##", "b" * 3000 + " ab" * 400, "\n\n\na \n\tb"]


def odd_texts(n):
    r = random.Random(n)
    letters = "ab'sSdΣ01.,!\n\t  \xa0\x85é́日€😀<|>"
    return ODD + ["".join(r.choices(letters, k=r.randrange(1, 50))) for _ in range(n)]


def test_bpe_against_library():
    from tokenizers import Tokenizer

    path = vocabulary("word_bpe_49k.json")
    library, own = Tokenizer.from_file(path), bpe.WordBpe(path)
    texts = odd_texts(1500)
    for text, ids in zip(texts, own.encode(texts)):
        want = library.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want, text
        assert own.decode(ids) == library.decode(want, skip_special_tokens=False)
    # One long word takes the heap, which must merge as the rounds do.
    word = ("abcde" * 400).encode()
    rounds = own.merge([word[:1000]])[0].tolist()
    assert rounds == own._merge_long(word[:1000]).tolist()


def test_bpe_round_trip_on_table(docs, empty):
    path = vocabulary("word_bpe_49k.json")
    coded = bpe.encode(docs, path, decoded=True)
    again = bpe.decode(coded.select("doc_id", "ids"), path)
    assert same_rows([tuple(r) for r in again.collect()], [(r["doc_id"], r["decoded"]) for r in coded.collect()])
    assert bpe.encode(empty, path).count() == 0


def test_token_file_format():
    rng = np.random.default_rng(0)
    for n in (0, 1, 5, 4095, 4096, 4097, 9000):
        for high in (1, 2, 300, 50_000, 2**32):
            ids = rng.integers(0, high, n, dtype=np.uint64).astype(np.uint32)
            ids[rng.random(n) < 0.03] = 2**32 - 1
            data = token_files.write_file(ids, np.array([n]))
            back, lengths = token_files.read_file(data)
            assert np.array_equal(back, ids) and lengths.tolist() == [n]
            if n == 9000:
                assert np.array_equal(token_files.read_file(data, 1, 2)[0], ids[4096:8192])
    ids = np.r_[rng.integers(0, 100, 4000), rng.integers(2**20, 2**21, 96)].astype(np.uint32)
    assert len(token_files.pack_ids(ids)[0]) < 4500, "outliers go to the exception list"
    with pytest.raises(ValueError):
        token_files.read_file(b"no file at all!!")


def test_token_files_on_table(spark, docs, empty, tmp_path):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    texts = odd_texts(400)
    table = spark.createDataFrame([(1000 - k, t) for k, t in enumerate(texts)] + [(None, "x"), (7, "same"), (7, "same")], "doc_id long, text string")
    path = str(tmp_path / "files")
    token_files.write_token_files(table.repartition(5), vocabulary("byte_bpe_50k.json"), path, file_ids=2000)
    got = sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in token_files.read_token_files(spark, path, crc32=True).collect())
    want, start = [], 0
    order = [(None, "x"), (7, "same"), (7, "same"), *((1000 - k, t) for k, t in reversed(list(enumerate(texts))))]
    for i, t in order:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        want.append((start, i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want
    raw = {(r["start"], zlib.crc32(bytes(r["ids"]))) for r in token_files.read_token_files(spark, path).collect()}
    assert raw == {(w[0], w[3]) for w in want}
    token_files.write_token_files(empty, vocabulary("byte_bpe_50k.json"), str(tmp_path / "none"))
    assert token_files.read_token_files(spark, str(tmp_path / "none")).count() == 0


# --------------------------------------------------------------------- url filter


def test_url_filter(spark):
    rules = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow")]
    urls = [
        "http://WWW.Example.com/en/1", "http://a.example.com/en/1", "http://example.com/de", "http://example.com", "http://notexample.com/en/",
        None, "nothing", "http://bad.org/x/?utm_source=f&b=2&a=1#t", "https://www.bad.org:443/x?a=1&b=2", "http://bad.org/x?a=1", "http://fine.org/",
    ]
    pages = spark.createDataFrame([(k, u, "x", 1) for k, u in enumerate(urls + urls[7:9])], "page_id long, url string, host string, h1 int")
    listed = spark.createDataFrame([("http://bad.org/x?b=2&a=1",), (None,), ("http://bad.org/x?b=2&a=1",), ("bad",)], "url string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge(pages, rules, listed).collect()}
    assert got == {
        0: ("www.example.com", "/en/1", "www.example.com/en/", "allow"), 1: ("a.example.com", "/en/1", "example.com/en/", "block"),
        2: ("example.com", "/de", "com/", "allow"), 3: ("example.com", "", None, "allow"), 4: ("notexample.com", "/en/", "com/", "allow"),
        5: ("", "", None, "allow"), 6: ("", "", None, "allow"), 7: ("bad.org", "/x/", None, "block"), 8: ("www.bad.org:443", "/x", None, "block"),
        9: ("bad.org", "/x", None, "allow"), 10: ("fine.org", "/", None, "allow"), 11: ("bad.org", "/x/", None, "block"), 12: ("www.bad.org:443", "/x", None, "block"),
    }
    assert url_filter.judge(pages.limit(0), rules, listed).count() == 0
    assert url_filter.judge(pages, [], listed.limit(0)).where("verdict = 'block'").count() == 0


def test_bloom_filter_has_no_false_negative(spark):
    listed = spark.range(5000).select(F.concat(F.lit("h/"), "id").alias("canonical"))
    hashed = lambda df: df.select(*[h.alias(n) for h, n in zip(key_hashes(F.col("canonical")), ("h1", "h2"))])
    table, hashes = build_filter(hashed(listed)), lambda df: hashed(df).toPandas()
    inside = hashes(listed)
    outside = hashes(spark.range(5000, 25_000).select(F.concat(F.lit("h/"), "id").alias("canonical")))
    assert may_contain(table, inside["h1"].to_numpy(), inside["h2"].to_numpy()).all()
    assert may_contain(table, outside["h1"].to_numpy(), outside["h2"].to_numpy()).mean() < 0.02


# -------------------------------------------------------------------- language id


def test_language_id(spark):
    sets = {"xx": "kato meli suna".split(), "yy": "brent glosk windt".split(), "zz": "ûral éphi öttö".split()}
    r = random.Random(2)
    train = [(k, " ".join(r.choices(sets[lang], k=30)), lang) for k, lang in enumerate(["xx"] * 30 + ["yy"] * 20 + ["zz"] * 10)]
    model = language_id.fit(spark.createDataFrame(train + [(99, None, "xx"), (98, "kato", None)], "doc_id long, text string, lang string"))
    tests = [(1, "Suna KATO meli!", "xx"), (2, "windt glosk", "yy"), (3, "öttö éphi", "zz"), (4, None, "und"), (5, "", "und"), (6, "12 !?", "und"), (7, "日本", "xx"), (8, "meli " * 50_000, "xx"), (1, "glosk", "yy")]
    told = language_id.predict(spark.createDataFrame([(i, t, "s") for i, t, _ in tests], "doc_id long, text string, score string"), model)
    rows = [(r["doc_id"], r["lang_pred"]) for r in told.collect()]
    assert same_rows(rows, [(i, w) for i, _, w in tests])
    assert all(0 <= r["score"] <= 1 for r in told.collect())
    none = language_id.fit(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert none.predict("kato") == ("und", 0.0)
    assert language_id.predict(spark.createDataFrame([], "doc_id long, text string"), model).count() == 0


def test_many_languages_share_the_filter(spark):
    r = random.Random(1)
    words = {f"l{k:02}": ["".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(12)] for k in range(70)}
    train = [(k * 10 + j, " ".join(words[lang] * 2), lang) for k, lang in enumerate(words) for j in range(3)]
    model = language_id.fit(spark.createDataFrame(train, "doc_id long, text string, lang string"))
    assert model.masks.shape[1] == 2 and all(model.predict(" ".join(ws))[0] == lang for lang, ws in words.items())


# ----------------------------------------------------------------- html extraction


def lcs(a, b):
    d = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            d[i + 1][j + 1] = d[i][j] + 1 if x == y else max(d[i][j + 1], d[i + 1][j])
    return d[-1][-1]


def test_common_lines():
    r = random.Random(1)
    for _ in range(1500):
        a, b = ([r.randrange(4) for _ in range(r.randrange(12))] for _ in range(2))
        picked = [x for x, s in zip(a, html_text.common_lines(a, b)) if s]
        rest = iter(b)
        assert len(picked) == lcs(a, b) and all(x in rest for x in picked)
    a, b = ([r.randrange(3) for _ in range(400)] for _ in range(2))  # lines that repeat very often
    assert sum(html_text.common_lines(a, b)) == lcs(a, b)


def test_lines_of_very_long_pages_are_aligned_in_bounded_memory():
    import tracemalloc

    mine, other = list(range(30_000)), [k for k in range(40_000) if k % 7] + list(range(50))
    tracemalloc.start()
    shared = html_text.common_lines(mine, other)
    assert tracemalloc.get_traced_memory()[1] < 40e6  # a row for each line would take 100 MB and more
    tracemalloc.stop()
    assert shared == [k % 7 > 0 for k in mine]


def test_page_lines():
    page = (
        "<html><head><title>T</title></head><body><nav>m</nav><div class='cookie-notice'>c</div><article><h1>Head</h1><p>One &amp; <b>two</b>\n three"
        "<p>Four<br>five</p><script>if(a<b){'</p>'}</script><form>f</form><section id=comments><p>no</p></section><!-- x -->Six &#233;</article><footer>z</footer>"
    )
    assert html_text.main_text(page, None) == "Head\n\nOne & two three\n\nFour\n\nfive\n\nSix é"
    wrapped = "<div class='page with-sidebar'><div>side</div><article class='post has-header no-comments'><p>Real.</p><article class='comment'><p>no</p></article></article></div><div id='comments'><article><p>no</p></article></div>"
    assert html_text.main_text(wrapped, None) == "Real."
    assert html_text.main_text(None, None) == "" and html_text.main_text("", [1]) == "" and html_text.main_text("<p", None) == "<p"


def test_extract_pairs_by_nearest_url(spark):
    def page(url, body):
        return url, f"<body><div>Home About Contact</div>{body}<div>All rights reserved</div></body>"

    made = [page(f"http://h.org/a/{k}", f"<p>Own text number {k} is here.</p>") for k in range(9)]
    made += [page("http://alone.org/", "<p>Only.</p>"), (None, None), ("http://h.org/zz", ""), page("http://h.org/a/3", "<p>Own text number 3 is here.</p>")]
    pages = spark.createDataFrame([(k, u, h, "x") for k, (u, h) in enumerate(made)], "page_id long, url string, html string, host string")
    got = {r["page_id"]: r["text"] for r in html_text.extract(pages.repartition(4)).collect()}
    for k in (0, 1, 5, 8):
        assert got[k] == f"Own text number {k} is here."
    assert got[3] == got[12] == "Own text number 3 is here."
    assert got[9] == "Home About Contact\n\nOnly.\n\nAll rights reserved" and got[10] == "" and got[11] == ""
    assert html_text.extract(pages.limit(0)).count() == 0


def test_neighbours_have_longest_common_beginning(spark):
    r = random.Random(3)
    keys = [(f"h{r.randrange(3)}", "/" + "".join(r.choices("ab/", k=r.randrange(6))), k) for k in range(80)] + [("one", "/", 99)]
    got = {x["key"]: x["near"] for x in html_text.neighbours(spark.createDataFrame(keys, "host string, path string, key long").repartition(6)).collect()}
    by = {k: (h, p) for h, p, k in keys}
    common = lambda a, b: len(os.path.commonprefix([by[a][1], by[b][1]]))
    for h, _, k in keys:
        others = [o for g, _, o in keys if g == h and o != k]
        assert (k in got) == bool(others)
        if others:
            assert by[got[k]][0] == h and common(k, got[k]) == max(common(k, o) for o in others)


# ------------------------------------------------------------ importance resampling


def test_importance(spark, docs, empty):
    good = [(k, prose(k, 60)) for k in range(150)]
    bad = [(k, " ".join(random.Random(k).choices(["###", "$$$", "%%%", "&&&", "zq"], k=60))) for k in range(200, 250)]
    table = spark.createDataFrame([(i, t, "x") for i, t in good + bad + [(300, None), (301, "")]], "doc_id long, text string, key string")
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in good[:40]] + [(i, 0, None) for i, _ in bad[:13]] + [(None, 1, 0)], "doc_id long, quality int, toxic int")
    rows = {r["doc_id"]: r for r in importance.resample(table, labels).collect()}
    kept = {i for i, r in rows.items() if r["kept"]}
    assert {i for i, _ in good} <= kept and len(kept & {i for i, _ in bad}) <= 10 and not kept & {300, 301}
    assert len(kept) == round(41 / 54 * 202)
    assert importance.resample(docs, labels.limit(0)).where("kept").count() == docs.where("length(trim(text)) > 3").count()
    assert importance.resample(empty, labels).count() == 0


def test_kth_largest(spark):
    r = random.Random(5)
    keys = [r.gauss(0, 1) for _ in range(4000)] + [2.5] * 1500 + [1e9, -1e300]
    table = spark.createDataFrame([(k,) for k in keys] + [(None,)], "key double")
    ranked = sorted(keys, reverse=True)
    for k in (1, 2, 700, 3000, len(keys), len(keys) + 5):
        assert importance.kth_largest(table, k) == ranked[min(k, len(keys)) - 1]
    assert importance.kth_largest(table.limit(0), 3) is None


def test_sha_of_ids_matches(docs):
    coded = bpe.encode(docs.where("doc_id = 5"), vocabulary("word_bpe_49k.json")).select("ids", F.sha2("ids", 256).alias("h")).first()
    assert hashlib.sha256(bytes(coded["ids"])).hexdigest() == coded["h"]
