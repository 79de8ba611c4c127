"""Batch search: a table of queries against the place table.

A query row has query_id, text, category, lat, lon (origin or NULL).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.geo import haversine_m
from ..functions.text import normalize_text, query_tokens, words
from ..session import stage
from .places import ALTERNATE, HIERARCHY

# Weights of the two search contracts.
LOCAL_RADIUS_KM = 150.0
KM_PER_DEGREE = 111.32
MIN_COS_LAT = 0.15
DEFAULT_RESULTS = 8
EXACT, PREFIX, CONTAINS, BRAND_FIRST, PER_TOKEN = 4000, 2000, 1000, 2500, 250
CATEGORY_DIRECT, CATEGORY_LINKED, PROXIMITY = 1800, 1000, 900

# Parts that the places of one word are dealt to.
WORD_PARTS = 64


def prepare_queries(queries: DataFrame) -> DataFrame:
    """Add normal forms and tokens; queries no version may answer are in ``refused_queries``.

    The result is staged: every branch of a search reads it, and its size decides
    whether it is broadcast.
    """
    return stage(_normal_queries(queries).where("refusal is null").drop("refusal"), "queries")


def refused_queries(queries: DataFrame) -> DataFrame:
    """(query_id, refusal) of the queries that no version may answer."""
    return _normal_queries(queries).where("refusal is not null").select("query_id", "refusal")


def _normal_queries(queries: DataFrame) -> DataFrame:
    q = queries.withColumns(
        {
            "q_norm": normalize_text(F.col("text"), "query"),
            "cat_norm": normalize_text(F.col("category"), "query"),
        }
    )
    q = q.withColumn("tokens", query_tokens(F.col("q_norm"))).withColumn(
        "first_token", F.coalesce(F.get("tokens", F.lit(0)), F.col("q_norm"))
    )
    origin_ok = (F.col("lat").isNull() & F.col("lon").isNull()) | (
        F.col("lat").between(-90, 90) & F.col("lon").between(-180, 180)
    )
    asks = (F.char_length("q_norm") >= 2) | (F.col("cat_norm") != "")
    refusal = F.when(~F.coalesce(origin_ok, F.lit(False)), "ORIGIN_INCOMPLETE_OR_OUT_OF_RANGE").when(~asks, "NOTHING_ASKED")
    return q.withColumn("refusal", refusal)


def _fold_ascii(col: Column) -> Column:
    """The text match ignores ASCII case only."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _grams(word: Column) -> Column:
    """Distinct substrings of one, two and three characters."""

    def of(n: int) -> Column:
        last = F.char_length(word) - (n - 1)
        return F.when(last >= 1, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.substring(word, i, F.lit(n)))).otherwise(
            F.array().cast("array<string>")
        )

    return F.array_distinct(F.concat(of(1), of(2), of(3)))


def _token_pairs(prepared: DataFrame, places: DataFrame) -> DataFrame:
    """(query_id, place_id), with repeats, where a text contains a term of the query.

    "Text contains token" means "some word contains token", because tokens hold
    no space.  So tokens meet the distinct words of the corpus on a short gram
    (an equi-join, checked by ``contains``), and the places meet their words.
    Queries made of one-letter words search their whole phrase; those meet the
    texts on the letters around a word boundary.
    """
    terms = prepared.filter(F.col("q_norm") != "").select(
        "query_id",
        F.explode(F.when(F.size("tokens") > 0, F.col("tokens")).otherwise(F.array("q_norm"))).alias("term"),
    )
    terms = terms.select("query_id", _fold_ascii(F.col("term")).alias("term"))
    plain = terms.filter(~F.col("term").contains(" "))
    phrases = terms.filter(F.col("term").contains(" "))
    texts = places.select("place_id", _fold_ascii(F.col("name_norm")).alias("n"), _fold_ascii(F.col("address_norm")).alias("a"))
    postings = texts.select(
        "place_id", F.explode(F.array_distinct(F.concat(words(F.col("n")), words(F.col("a"))))).alias("word")
    )
    vocabulary = postings.select("word").distinct()
    anchored = vocabulary.select("word", F.explode(_grams(F.col("word"))).alias("gram"))
    keyed = plain.select("term").distinct().withColumn("gram", F.substring("term", 1, 3))
    word_terms = anchored.join(keyed, "gram").filter(F.col("word").contains(F.col("term"))).select("word", "term")
    word_queries = word_terms.join(plain, "term").select("word", "query_id").distinct()
    # A word that most places hold would make all its pairs in one task.
    dealt = postings.withColumn("part", F.pmod(F.xxhash64("place_id"), F.lit(WORD_PARTS)))
    each = word_queries.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(WORD_PARTS - 1)).cast("array<bigint>")))
    by_word = dealt.join(each, ["word", "part"]).select("query_id", "place_id")

    lines = texts.select("place_id", F.explode(F.array("n", "a")).alias("line"))
    joints = lines.filter(F.col("line").contains(" ")).select(
        "place_id",
        "line",
        F.explode(
            F.array_distinct(
                F.transform(
                    F.regexp_extract_all("line", F.lit(r"(?=(\S \S))"), F.lit(1)),
                    lambda x: x,
                )
            )
        ).alias("joint"),
    )
    by_phrase = (
        joints.join(phrases.withColumn("joint", F.substring("term", 1, 3)), "joint")
        .filter(F.col("line").contains(F.col("term")))
        .select("query_id", "place_id")
    )
    return by_word.unionByName(by_phrase)


def token_candidates(prepared: DataFrame, places: DataFrame) -> DataFrame:
    """(query_id, place_id) where name or address contains any term of the query."""
    return _token_pairs(prepared, places).distinct()


def _category_pairs(prepared: DataFrame, bridge: DataFrame, categories: DataFrame) -> DataFrame:
    asked = prepared.filter(F.col("cat_norm") != "").select("query_id", F.col("cat_norm").alias("name_norm"))
    ids = categories.select(F.col("id").alias("category_id"), "name_norm").join(asked, "name_norm")
    return bridge.join(ids, "category_id").select("query_id", "place_id")


def category_semi(prepared: DataFrame, bridge: DataFrame, categories: DataFrame) -> DataFrame:
    """(query_id, place_id) linked to the asked category by any relation."""
    return _category_pairs(prepared, bridge, categories).distinct()


def open_places(places: DataFrame) -> DataFrame:
    return places.filter(F.col("operating_status") != "permanently_closed")


def bbox_columns(lat: Column, lon: Column, km: float = LOCAL_RADIUS_KM) -> dict[str, Column]:
    """Bounds of the search box around an origin."""
    lat_span = F.lit(km / KM_PER_DEGREE)
    lon_span = F.lit(km) / (F.lit(KM_PER_DEGREE) * F.greatest(F.lit(MIN_COS_LAT), F.cos(F.radians(lat))))
    return {
        "min_lat": lat - lat_span,
        "max_lat": lat + lat_span,
        "min_lon": lon - lon_span,
        "max_lon": lon + lon_span,
    }


def bbox_filter(places: DataFrame, lat: float, lon: float, km: float = LOCAL_RADIUS_KM) -> DataFrame:
    """Places in the box; the bounds fold to literals and reach the file scan."""
    b = bbox_columns(F.lit(lat), F.lit(lon), km)
    return places.filter(
        F.col("latitude").between(b["min_lat"], b["max_lat"]) & F.col("longitude").between(b["min_lon"], b["max_lon"])
    )


def _text_class(name_norm: Column, first_token: Column) -> Column:
    prefix = F.startswith(_fold_ascii(name_norm), _fold_ascii(first_token))
    return F.when(name_norm == first_token, 0).when(prefix, 1).otherwise(2)


def _top(df: DataFrame, order: list[Column], limit: int, name: str) -> DataFrame:
    """First ``limit`` rows per query; Spark cuts groups before the shuffle too."""
    window = Window.partitionBy("query_id").orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= limit)


def retrieve_topk_v1(prepared: DataFrame, places: DataFrame, limit: int | None = None) -> DataFrame:
    """Per query the raw matches in order: exact first token, prefix, other; then confidence.

    Equal rows are ordered by place_id, the order the first contract leaves open.
    ``limit`` keeps that many per query and numbers them in ``pos``; without it all
    stay and ``pos`` is the sort key itself, so that no query's matches are gathered.
    """
    texts = prepared.filter(F.char_length("q_norm") >= 2)
    narrow = places.select("place_id", "name_norm", "confidence", "latitude", "longitude")
    found = token_candidates(texts, places).join(narrow, "place_id").join(texts.select("query_id", "first_token"), "query_id")
    key = F.struct(
        _text_class(F.col("name_norm"), F.col("first_token")).cast("double").alias("near"),
        (-F.col("confidence")).alias("confidence"),
        "place_id",
    )
    ranked = found.withColumn("pos", key) if limit is None else _top(found, [key], limit, "pos")
    finite = ~F.isnan("latitude") & ~F.isnan("longitude") & (F.abs("latitude") < float("inf")) & (F.abs("longitude") < float("inf"))
    return ranked.filter(finite).select("query_id", "place_id", "pos")


def candidates_v2(prepared: DataFrame, places: DataFrame, bridge: DataFrame, categories: DataFrame) -> DataFrame:
    """(query_id, place_id): open places that match the text and the category."""
    no, yes = F.lit(False), F.lit(True)
    pairs = (
        _token_pairs(prepared, places)
        .select("query_id", "place_id", yes.alias("by_text"), no.alias("by_category"))
        .unionByName(
            _category_pairs(prepared, bridge, categories).select(
                "query_id", "place_id", no.alias("by_text"), yes.alias("by_category")
            )
        )
    )
    # One partial aggregate both removes repeats and meets the two conditions.
    met = pairs.groupBy("query_id", "place_id").agg(F.max("by_text").alias("by_text"), F.max("by_category").alias("by_category"))
    asked = prepared.select("query_id", (F.col("q_norm") != "").alias("has_text"), (F.col("cat_norm") != "").alias("has_category"))
    return (
        met.join(asked, "query_id")
        .filter((F.col("by_text") | ~F.col("has_text")) & (F.col("by_category") | ~F.col("has_category")))
        .select("query_id", "place_id")
    )


def retrieve_topk_v2(
    prepared: DataFrame,
    places: DataFrame,
    bridge: DataFrame,
    categories: DataFrame,
    local_limit: int | None = None,
    overall_limit: int | None = None,
) -> DataFrame:
    """Nearest matches in the box around the origin, then the best matches anywhere.

    A place found by both keeps its local position.  The limits keep that many
    rows of either kind and number them in ``pos``; without them all stay and
    ``pos`` is the sort key itself, so that no query's matches are gathered.
    """
    narrow = open_places(places).select("place_id", "name_norm", "confidence", "latitude", "longitude")
    found = (
        candidates_v2(prepared, places, bridge, categories)
        .join(narrow, "place_id")
        .join(prepared.select("query_id", "q_norm", "first_token", "lat", "lon"), "query_id")
    )
    d_lat, d_lon = F.col("latitude") - F.col("lat"), F.col("longitude") - F.col("lon")
    b = bbox_columns(F.col("lat"), F.col("lon"))
    boxed = (
        F.col("lat").isNotNull()
        & F.col("latitude").between(b["min_lat"], b["max_lat"])
        & F.col("longitude").between(b["min_lon"], b["max_lon"])
    )
    klass = F.when(F.col("q_norm") == "", 0).otherwise(_text_class(F.col("name_norm"), F.col("first_token")))

    def key(part: int, near: Column) -> Column:
        return F.struct(F.lit(part).alias("part"), near.cast("double").alias("near"), (-F.col("confidence")).alias("confidence"), "place_id")

    local_key, overall_key = key(0, d_lat * d_lat + d_lon * d_lon), key(1, klass)
    cols = ["query_id", "place_id", "pos"]
    if local_limit is None or overall_limit is None:
        return found.withColumn("pos", F.when(boxed, local_key).otherwise(overall_key)).select(*cols)
    local = _top(found.filter(boxed), [local_key], local_limit, "pos")
    overall = _top(found, [overall_key], overall_limit, "pos").withColumn("pos", F.col("pos") + local_limit)
    return (
        local.select(*cols).unionByName(overall.select(*cols)).groupBy("query_id", "place_id").agg(F.min("pos").alias("pos"))
    )


def _score_columns(q_norm: Column, tokens: Column, title: Column, address: Column, confidence: Column) -> dict[str, Column]:
    """The six text parts of a score."""
    first = F.get(tokens, F.lit(0))
    has_text = q_norm != ""
    bag = F.split(F.concat_ws(" ", title, address), " ")

    def points(condition: Column, value: int) -> Column:
        return F.when(condition, value).otherwise(0)

    return {
        "s_confidence": F.floor(F.greatest(F.lit(0.0), F.least(F.lit(1.0), confidence)) * 100.0).cast("long"),
        "s_exact": points(has_text & (title == q_norm), EXACT),
        "s_prefix": points(has_text & F.startswith(title, q_norm), PREFIX),
        "s_contains": points(has_text & F.contains(title, q_norm), CONTAINS),
        "s_brand_first": points((F.size(tokens) > 1) & (title == first), BRAND_FIRST),
        "s_tokens": F.size(F.array_intersect(tokens, bag)) * PER_TOKEN,
    }


def _results(limit: int) -> int:
    if limit < 1:
        raise ValueError(f"a search returns at least one result, not {limit}")
    return limit


def rank_v1(retrieved: DataFrame, prepared: DataFrame, places: DataFrame, limit: int = DEFAULT_RESULTS) -> DataFrame:
    """Score, drop repeats of title and address, keep the best per query."""
    cols = places.select("place_id", "name", "address", "confidence")
    rows = retrieved.join(cols, "place_id").join(prepared.select("query_id", "q_norm"), "query_id")
    rows = rows.withColumns(
        {
            "title": normalize_text(F.col("name"), "query"),
            "addr": normalize_text(F.col("address"), "query"),
            "all_tokens": query_tokens(F.col("q_norm"), None),
        }
    )
    once = Window.partitionBy("query_id", "title", "addr").orderBy("pos")
    rows = rows.withColumn("_n", F.row_number().over(once)).filter(F.col("_n") == 1)
    parts = _score_columns(F.col("q_norm"), F.col("all_tokens"), F.col("title"), F.col("addr"), F.col("confidence"))
    rows = rows.withColumns(parts).withColumn("score", sum((F.col(c) for c in parts), F.lit(0)).cast("long"))
    best = _top(rows, [F.desc("score"), F.desc("confidence"), F.col("pos")], _results(limit), "rank")
    return best.select("query_id", "rank", "place_id", F.col("name").alias("title"), "address", "score", *parts)


def rank_v2(
    retrieved: DataFrame, prepared: DataFrame, places: DataFrame, limit: int = DEFAULT_RESULTS
) -> DataFrame:
    """Score with category and proximity parts, keep the best per query.

    ``places`` carries basic_category and taxonomy_primary names.
    """
    cols = places.select(
        "place_id", "name", "address", "confidence", "latitude", "longitude", "basic_category", "taxonomy_primary"
    )
    rows = retrieved.join(cols, "place_id").join(
        prepared.select("query_id", "q_norm", "cat_norm", "tokens", "lat", "lon"), "query_id"
    )
    rows = rows.withColumns(
        {
            "title": normalize_text(F.col("name"), "query"),
            "addr": normalize_text(F.col("address"), "query"),
            "basic": normalize_text(F.col("basic_category"), "query"),
            "prim": normalize_text(F.col("taxonomy_primary"), "query"),
            "distance_m": haversine_m(F.col("lat"), F.col("lon"), F.col("latitude"), F.col("longitude")),
        }
    )
    parts = _score_columns(F.col("q_norm"), F.col("tokens"), F.col("title"), F.col("addr"), F.col("confidence"))
    parts["s_category"] = (
        F.when(F.col("cat_norm") == "", 0)
        .when((F.col("basic") == F.col("cat_norm")) | (F.col("prim") == F.col("cat_norm")), CATEGORY_DIRECT)
        .otherwise(CATEGORY_LINKED)
    )
    away = F.floor(F.least(F.col("distance_m") / 1000.0, F.lit(100.0)) * 9.0)
    parts["s_proximity"] = F.when(F.col("lat").isNull(), F.lit(0).cast("long")).otherwise(
        F.greatest(F.lit(0).cast("long"), F.lit(PROXIMITY) - away)
    )
    rows = rows.withColumns(parts).withColumn("score", sum((F.col(c) for c in parts), F.lit(0)).cast("long"))
    best = _top(
        rows,
        [F.desc("score"), F.desc("confidence"), F.asc_nulls_last("distance_m"), F.col("pos")],
        _results(limit),
        "rank",
    )
    return best.select(
        "query_id", "rank", "place_id", F.col("name").alias("title"), "address", "distance_m", "score", *parts
    )


def hydrate_taxonomy(ranked: DataFrame, bridge: DataFrame, categories: DataFrame) -> DataFrame:
    """Add the ordered distinct hierarchy and alternates names of each ranked place."""
    wanted = ranked.select("place_id").distinct()
    links = (
        bridge.filter(F.col("relation").isin(HIERARCHY, ALTERNATE))
        .join(wanted, "place_id", "left_semi")
        .join(categories.select(F.col("id").alias("category_id"), F.col("name").alias("cat")), "category_id")
    )

    def names(relation: int) -> Column:
        pair = F.when(F.col("relation") == relation, F.struct("ordinal", "cat"))
        return F.array_distinct(F.transform(F.array_sort(F.collect_list(pair)), lambda s: s["cat"]))

    # A place has as many links as its own record lists, so the group is small.
    lists = links.groupBy("place_id").agg(names(HIERARCHY).alias("hierarchy"), names(ALTERNATE).alias("alternates"))
    empty = F.array().cast("array<string>")
    return ranked.join(lists, "place_id", "left").withColumns(
        {c: F.coalesce(c, empty) for c in ("hierarchy", "alternates")}
    )


def search_regression(targets: DataFrame, ranked: DataFrame) -> DataFrame:
    """First rank per target where the name is equal and the address holds a fragment.

    Targets: query_id, name_equals, fragments.  A target that is never matched
    comes back with rank NULL and passed false.
    """
    rows = targets.join(ranked.select("query_id", "rank", "title", "address"), "query_id", "left")
    fragments = F.filter(F.transform("fragments", lambda f: F.lower(f)), lambda f: F.trim(f) != "")
    same_name = F.lower(F.upper("title")) == F.lower(F.upper("name_equals"))
    in_address = (F.size(fragments) == 0) | F.exists(fragments, lambda f: F.contains(F.lower("address"), f))
    hit = F.when(same_name & in_address, F.col("rank"))
    out = rows.groupBy("query_id", "name_equals").agg(F.min(hit).alias("matched_rank"))
    return out.withColumn("passed", F.col("matched_rank").isNotNull())


def diff_places(a: DataFrame, b: DataFrame) -> DataFrame:
    """added / removed / changed place ids; equal places give no row."""
    compared = ["name", "address", "latitude", "longitude", "source_record_id", "operating_status"]

    def keyed(df: DataFrame, side: str) -> DataFrame:
        return df.select(F.col("id"), F.struct(*compared).alias(side))

    both = keyed(a, "a").join(keyed(b, "b"), "id", "full_outer")
    change = (
        F.when(F.col("a").isNull(), "added").when(F.col("b").isNull(), "removed").when(F.col("a") != F.col("b"), "changed")
    )
    return both.select("id", change.alias("change")).filter(F.col("change").isNotNull())


def diff_report(changes: DataFrame) -> DataFrame:
    """(change, id, n): every changed id with the number of ids that changed alike."""
    counts = changes.groupBy("change").agg(F.count(F.lit(1)).alias("n"))
    return changes.join(F.broadcast(counts), "change").select("change", "id", "n")  # one row a kind


def diff_categories(a_counts: DataFrame, b_counts: DataFrame) -> DataFrame:
    """Categories whose number of places differs."""
    both = a_counts.withColumnRenamed("places", "a").join(b_counts.withColumnRenamed("places", "b"), "name", "full_outer")
    both = both.select("name", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("a", "b")])
    return both.withColumn("delta", F.col("b") - F.col("a")).filter(F.col("delta") != 0)
