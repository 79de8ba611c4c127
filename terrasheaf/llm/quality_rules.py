"""Quality rules as weak supervision, in DataFrame functions only.

Each rule votes +1 (good), -1 (bad) or abstains (0).  Documents with the same
votes are counted together, expectation-maximisation over those counts (at most
3 ** rules rows) estimates the share of good documents and two accuracies of each
rule, on good documents and on bad ones, and a document stays if its posterior
probability of being good is at least a half.  An abstention tells nothing.
Nothing is trained on labels, and no document is shuffled: only vote patterns are.

Defined cases: a null or empty text has no words, fails the base rules and is
not kept; ties and repeated rows are judged one by one; an empty table gives an
empty result (the accuracies then stay at their start values); other columns of
the documents pass through ``keep_good`` untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_SPACE, stage

SPACE = r"[\x20\x09-\x0D]"
WINDOW = 8
ROUNDS = 40
# Start values and bounds: rules seldom err on good documents and catch some of the bad ones.
START_PRIOR, START_ON_GOOD, START_ON_BAD = 0.8, 0.95, 0.4
LEAST, MOST = 0.001, 0.999
# The start values count as this share of all documents, at least one: so a table in which most good
# documents trip one rule does not turn into two classes by that rule.
START_SHARE = 0.2

# Frequent function words of English, German, French and Spanish.
FUNCTION_WORDS = (
    "the of and to a in is that it for on as with was by this at from be are "
    "der die und das den mit von zu ist nicht ein eine im dem auf für "
    "de la le les et en un une des du que qui dans pour pas sur par est au "
    "el y los se del las por con no para una su lo como"
).split()

RULES = ("symbols", "function_words", "line_repeats", "window_repeats", "word_length", "line_ends")


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, counts): what the rules look at, one row per input row."""
    text = F.coalesce(docs[text_col], F.lit(""))
    bare = F.btrim(text, F.lit(WORD_SPACE))
    base = docs.select(
        docs[id_col].alias("doc_id"),
        F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, f"{SPACE}+")).alias("words"),
        F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(WORD_SPACE)) != "").alias("lines"),
        F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
    )
    common = F.array(*[F.lit(w) for w in FUNCTION_WORDS])
    counted = base.select(
        "doc_id",
        "n_symbols",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("lines", lambda x: F.rtrim(x).rlike(r"[.!?…]$"))).cast("long").alias("n_end_lines"),
        F.size(F.filter("words", lambda x: F.array_contains(common, F.lower(x)))).cast("long").alias("n_function_words"),
        F.transform("words", lambda x: F.xxhash64(x)).alias("marks"),
    )
    at = [lambda i, k=k: F.get("marks", i + k) for k in range(WINDOW)]
    windows = counted.withColumn(
        "windows",
        F.when(
            F.col("n_words") >= WINDOW,
            F.transform(F.sequence(F.lit(0), F.size("marks") - WINDOW), lambda i: F.xxhash64(*[f(i) for f in at])),
        ).otherwise(F.array().cast("array<bigint>")),
    ).drop("marks")
    plain = F.size(F.array_distinct("windows")) == F.size("windows")
    placed = windows.withColumn(
        "sorted",
        F.when(plain, F.array().cast("array<struct<h:bigint,p:int>>")).otherwise(
            F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
        ),
    ).drop("windows")
    met = placed.withColumn("places", F.sort_array(_repeated(F.col("sorted")))).drop("sorted")
    steps = F.transform("places", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("places", i + 1) - p, F.lit(WINDOW))))
    return met.withColumn(
        "n_repeat_words", F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)
    ).drop("places")


def _repeated(ranked: Column) -> Column:
    """Places of the windows whose hash stands beside an equal one in sorted order."""
    flagged = F.transform(
        ranked,
        lambda s, i: F.when(
            F.coalesce(F.get(ranked, i - 1)["h"] == s["h"], F.lit(False))
            | F.coalesce(F.get(ranked, i + 1)["h"] == s["h"], F.lit(False)),
            s["p"],
        ),
    )
    return F.filter(flagged, lambda p: p.isNotNull())


def votes() -> list[Column]:
    """One vote per rule of RULES, over the columns of ``measures``."""
    words, lines = F.greatest("n_words", F.lit(1)), F.greatest("n_lines", F.lit(1))

    def vote(bad: Column, good: Column) -> Column:
        return F.when(bad, -1).when(good, 1).otherwise(0)

    return [
        vote(10 * F.col("n_symbols") > words, 100 * F.col("n_symbols") <= words),
        vote(100 * F.col("n_function_words") < 8 * words, 100 * F.col("n_function_words") >= 15 * words),
        vote(100 * F.col("n_dup_lines") > 50 * lines, (F.col("n_dup_lines") == 0) & (F.col("n_lines") > 2)),
        vote(100 * F.col("n_repeat_words") > 30 * words, F.col("n_repeat_words") == 0),
        vote(F.col("word_chars") > 9 * words, (F.col("word_chars") >= 2 * words) & (F.col("word_chars") <= 8 * words)),
        vote(100 * F.col("n_end_lines") < 40 * lines, 100 * F.col("n_end_lines") >= 75 * lines),
    ]


def _posterior(given: Column, model: Column) -> Column:
    """Probability of being good, given votes and a model (prior, on_good, on_bad)."""
    told = F.transform(
        given,
        lambda v, j: F.when(v > 0, F.log(F.get(model["on_good"], j) / (1 - F.get(model["on_bad"], j))))
        .when(v < 0, F.log((1 - F.get(model["on_good"], j)) / F.get(model["on_bad"], j)))
        .otherwise(0.0),
    )
    odds = F.aggregate(told, F.log(model["prior"] / (1 - model["prior"])), lambda s, x: s + x)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def _clamp(x: Column, lo, hi) -> Column:
    return F.greatest(F.lit(lo) if isinstance(lo, float) else lo, F.least(F.lit(hi), x))


def _maximised(scored: Column) -> Column:
    """The model that fits patterns (given, n, q) and the start values best."""
    total = _sum(F.transform(scored, lambda x: x["n"]))
    held = F.greatest(F.lit(1.0), START_SHARE * total)

    def share(weight, j: int, sign: int, start: float) -> Column:
        vote = lambda x: F.get(x["given"], F.lit(j))
        right = F.transform(scored, lambda x: F.when(vote(x) == sign, weight(x)).otherwise(0.0))
        cast = F.transform(scored, lambda x: F.when(vote(x) != 0, weight(x)).otherwise(0.0))
        return (_sum(right) + held * start) / (_sum(cast) + held)

    good, bad = lambda x: x["n"] * x["q"], lambda x: x["n"] * (1 - x["q"])
    prior = _clamp((_sum(F.transform(scored, good)) + held * START_PRIOR) / (total + held), 0.01, 0.99)
    on_good = [_clamp(share(good, j, 1, START_ON_GOOD), 0.5, MOST) for j in range(len(RULES))]
    # A vote never counts against what it says: both accuracies together are 1 at least.
    on_bad = [
        _clamp(F.greatest(share(bad, j, -1, START_ON_BAD), 1 - on_good[j]), LEAST, MOST) for j in range(len(RULES))
    ]
    return F.struct(prior.alias("prior"), F.array(*on_good).alias("on_good"), F.array(*on_bad).alias("on_bad"))


def estimate(patterns: DataFrame) -> DataFrame:
    """One row (model) from rows (given: array of votes, n: documents).

    All rounds are one expression over the array of patterns, whose length
    3 ** rules bounds; no document is looked at here.
    """
    held = patterns.select(F.struct("given", F.col("n").cast("double").alias("n")).alias("p")).agg(
        F.sort_array(F.collect_list("p")).alias("all")
    )

    def again(model: Column, _: Column) -> Column:
        scored = F.transform(
            "all",
            lambda p: F.struct(p["given"].alias("given"), p["n"].alias("n"), _posterior(p["given"], model).alias("q")),
        )
        # An array of one element names the scored patterns, so they are computed once a round.
        return F.get(F.transform(F.array(scored), _maximised), F.lit(0))

    start = F.struct(
        F.lit(START_PRIOR).alias("prior"),
        F.array(*[F.lit(START_ON_GOOD)] * len(RULES)).alias("on_good"),
        F.array(*[F.lit(START_ON_BAD)] * len(RULES)).alias("on_bad"),
    )
    return held.select(F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, again).alias("model"))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, votes, posterior probability and verdict, one row per row of ``docs``."""
    found = measures(docs, id_col, text_col)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    voted = stage(found.withColumn("base_failed", failed).withColumn("given", F.array(*votes())), "quality-votes")
    patterns = voted.groupBy("given").agg(F.count("*").alias("n"))
    # One row by construction, so the side that is sent to every task is bounded.
    learned = stage(estimate(patterns), "quality-model")
    scored = voted.crossJoin(F.broadcast(learned)).withColumn(
        "quality", _posterior(F.col("given"), F.col("model"))
    )
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= 0.5)).drop("model")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns.

    Rows are written once with their votes: the model is learned from the votes
    and applied to the same rows, so no text is measured twice or shuffled, and
    repeated ids do no harm.
    """
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc_id"), "text")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    found = measures(held).select("doc_id", failed.alias("base_failed"), F.array(*votes()).alias("given"))
    voted = stage(found, "quality-rows")
    learned = stage(estimate(voted.groupBy("given").agg(F.count("*").alias("n"))), "quality-model")
    scored = voted.where(~F.col("base_failed")).crossJoin(F.broadcast(learned))
    return scored.where(_posterior(F.col("given"), F.col("model")) >= 0.5).select("doc_id.*")
