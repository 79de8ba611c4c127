"""Place feed -> search pack: filter, identity, dedup, dimensions, category links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.ids import canonical_fingerprint, dense_ids
from ..functions.lines import let
from ..functions.text import clean_list, clean_text, normalize_text
from ..session import stage
from .rules import violations

# Relation codes of a category link.
BASIC, HIERARCHY, ALTERNATE = 0, 1, 2


def _p(name: str) -> Column:
    return F.col(f"properties.{name}")


def full_address(address: Column) -> Column:
    """Five cleaned parts joined by comma; blanks and case-insensitive repeats drop out."""
    parts = F.array(*[clean_text(address[k]) for k in ("freeform", "postcode", "locality", "region", "country")])

    def fold(x: Column) -> Column:
        return F.lower(F.upper(x))

    def step(kept: Column, part: Column) -> Column:
        repeat = F.exists(kept, lambda k: fold(k) == fold(part))
        return F.when((part == "") | repeat, kept).otherwise(F.concat(kept, F.array(part)))

    return F.array_join(F.aggregate(parts, F.array().cast("array<string>"), step), ", ")


def taxonomy_fields(props: Column) -> Column:
    """basic, primary, hierarchy and alternates with the older layout as fallback."""
    primary = clean_text(props["taxonomy"]["primary"])
    found = F.struct(
        F.when(primary != "", primary).otherwise(clean_text(props["categories"]["primary"])).alias("prim"),
        clean_list(props["taxonomy"]["hierarchy"]).alias("hierarchy"),
        clean_list(props["taxonomy"]["alternates"]).alias("alternates"),
    )

    def finish(t: Column) -> Column:
        missing = (t["prim"] != "") & ~F.array_contains(t["hierarchy"], t["prim"])
        older = clean_list(props["categories"]["alternate"])
        return F.struct(
            clean_text(props["basic_category"]).alias("basic"),
            t["prim"].alias("prim"),
            F.when(missing, F.concat(t["hierarchy"], F.array(t["prim"]))).otherwise(t["hierarchy"]).alias("hierarchy"),
            F.when(F.size(t["alternates"]) > 0, t["alternates"]).otherwise(older).alias("alternates"),
        )

    return let(found, finish)


def preferred_source(sources: Column) -> Column:
    """Source with the greatest (confidence or -1, provider, dataset, record, version)."""

    def first_filled(a: Column, b: Column) -> Column:
        return clean_text(F.when(F.coalesce(a, F.lit("")) != "", a).otherwise(b))

    ranked = F.transform(
        F.filter(F.coalesce(sources, F.array()), lambda s: s.isNotNull()),
        lambda s: F.struct(
            F.coalesce(s["confidence"].try_cast("double"), F.lit(-1.0)).alias("score"),
            clean_text(s["provider"]).alias("provider"),
            first_filled(s["dataset"], s["resource"]).alias("dataset"),
            first_filled(s["record_id"], s["recordId"]).alias("record_id"),
            clean_text(s["version"]).alias("version"),
        ),
    )
    names = ("provider", "dataset", "record_id", "version")
    return let(F.array_max(ranked), lambda best: F.struct(*[F.coalesce(best[k], F.lit("")).alias(k) for k in names]))


def place_filter(features: DataFrame, country: str = "") -> DataFrame:
    """Usable features with their cleaned name, first address and numeric position.

    A blank country always passes; a place without name, address or coordinates does not.
    """
    addresses = F.filter(F.coalesce(_p("addresses"), F.array()), lambda a: a.isNotNull())
    confidence = F.when(F.coalesce(_p("confidence"), F.lit("")) == "", F.lit(0.0)).otherwise(
        _p("confidence").try_cast("double")
    )
    wide = features.select(
        "*",
        clean_text(_p("names.primary")).alias("name"),
        F.get(addresses, F.lit(0)).alias("address_parts"),
        F.get(F.col("geometry.coordinates"), F.lit(0)).try_cast("double").alias("longitude"),
        F.get(F.col("geometry.coordinates"), F.lit(1)).try_cast("double").alias("latitude"),
        confidence.alias("confidence"),
    )
    wide = wide.withColumn("address", full_address(F.col("address_parts")))
    own = F.upper(clean_text(F.col("address_parts.country")))
    keep = (
        (F.col("name") != "")
        & F.col("address_parts").isNotNull()
        & (F.col("address") != "")
        & F.col("longitude").isNotNull()
        & F.col("latitude").isNotNull()
        & F.col("confidence").isNotNull()
    )
    if country:
        keep = keep & ((own == "") | (own == country.upper()))
    return wide.filter(keep)


def place_key(features: DataFrame) -> DataFrame:
    """Add ``place_id``: own id, else feature id, else normalised name with position."""
    raw = F.when(F.coalesce(_p("id"), F.lit("")) != "", _p("id")).otherwise(F.col("id"))
    own = clean_text(raw)
    derived = F.concat(
        normalize_text(F.when(own == "", F.col("name"))),
        F.format_string(":%.6f:%.6f", F.col("latitude"), F.col("longitude")),
    )
    return features.withColumn("place_id", F.when(own != "", own).otherwise(derived))


def place_records(features: DataFrame, country: str = "") -> DataFrame:
    """Flat usable records, duplicates still in, in feed order by ``ord``."""
    kept = place_key(place_filter(features, country))
    a = F.col("address_parts")
    kept = kept.withColumn("tax", taxonomy_fields(F.col("properties"))).withColumn(
        "src", preferred_source(_p("sources"))
    )
    return kept.select(
        "ord",
        "place_id",
        "name",
        "address",
        "latitude",
        "longitude",
        "confidence",
        *[clean_text(a[k]).alias(k) for k in ("freeform", "postcode", "locality", "region", "country")],
        clean_text(_p("operating_status")).alias("operating_status"),
        "tax",
        "src",
    )


def place_dedup(records: DataFrame, key: str = "place_id", ordinal: str = "ord") -> DataFrame:
    """First row per key by input ordinal.

    The aggregate is partial: each task sends at most one row per key, so a key
    with very many copies costs no more than any other.
    """
    cols = [c for c in records.columns if c != key]
    first = records.groupBy(key).agg(F.min_by(F.struct(*cols), F.col(ordinal)).alias("r"))
    return first.select(key, *[F.col(f"r.{c}").alias(c) for c in cols]).select(*records.columns)


def _with_ids(keys: DataFrame, names: list[str], ids: str) -> DataFrame:
    if ids == "hash":
        return keys.withColumn("id", F.xxhash64(*names))
    return dense_ids(keys, "ord", ["slot", *names])


def build_dimensions(records: DataFrame, accepted: DataFrame, ids: str = "dense") -> dict[str, DataFrame]:
    """Address, category and source dimensions, ids in first-seen order.

    Address, basic, primary and source keys count for rejected duplicates too;
    hierarchy and alternate names only for accepted rows.  ``ids="hash"`` gives
    64-bit key hashes, which need no numbering pass and no lookup join.
    """
    address = (
        records.groupBy("postcode", "locality", "region", "country")
        .agg(F.min("ord").alias("ord"))
        .withColumn("slot", F.lit(0))
    )
    source = (
        records.select("ord", "src.provider", "src.dataset", "src.version")
        .filter((F.col("provider") != "") | (F.col("dataset") != "") | (F.col("version") != ""))
        .groupBy("provider", "dataset", "version")
        .agg(F.min("ord").alias("ord"))
        .withColumn("slot", F.lit(0))
    )
    every = records.select(
        "ord", F.posexplode(F.array(F.col("tax.basic"), F.col("tax.prim"))).alias("slot", "name")
    )
    lists = accepted.select(
        "ord", F.posexplode(F.concat("tax.hierarchy", "tax.alternates")).alias("slot", "name")
    ).withColumn("slot", F.col("slot") + 2)
    category = (
        every.unionByName(lists)
        .filter(F.col("name") != "")
        .groupBy("name")
        .agg(F.min(F.struct("ord", "slot")).alias("seen"))
        .select("name", "seen.ord", "seen.slot")
    )
    category = _with_ids(category, ["name"], ids).withColumn("name_norm", normalize_text(F.col("name")))
    return {
        "address_contexts": _with_ids(address, ["postcode", "locality", "region", "country"], ids).select(
            "id", "postcode", "locality", "region", "country"
        ),
        "search_categories": category.select("id", "name", "name_norm"),
        "search_sources": _with_ids(source, ["provider", "dataset", "version"], ids).select(
            "id", "provider", "dataset", "version"
        ),
    }


def build_bridge(accepted: DataFrame, categories: DataFrame) -> DataFrame:
    """(place, category, relation, ordinal); the first ordinal wins."""
    links = accepted.select(
        "place_id",
        F.explode(
            F.concat(
                F.array(F.struct(F.lit(BASIC).alias("relation"), F.lit(0).alias("ordinal"), F.col("tax.basic").alias("name"))),
                F.transform(
                    "tax.hierarchy",
                    lambda x, i: F.struct(F.lit(HIERARCHY).alias("relation"), i.alias("ordinal"), x.alias("name")),
                ),
                F.transform(
                    "tax.alternates",
                    lambda x, i: F.struct(F.lit(ALTERNATE).alias("relation"), i.alias("ordinal"), x.alias("name")),
                ),
            )
        ).alias("l"),
    ).select("place_id", "l.relation", "l.ordinal", "l.name")
    # Names in one cleaned list are distinct, so no further grouping is needed.
    return (
        links.filter(F.col("name") != "")
        .join(categories.select(F.col("id").alias("category_id"), "name"), "name")
        .select("place_id", "category_id", "relation", "ordinal")
    )


def build_pack(features: DataFrame, country: str = "", ids: str = "dense") -> dict[str, DataFrame]:
    """All five pack tables from a place feed."""
    # Both are read by several branches; the feed itself is parsed once.
    records = stage(place_records(features, country), "records")
    accepted = stage(place_dedup(records), "accepted")
    dims = build_dimensions(records, accepted, ids)
    ac, cat, src = dims["address_contexts"], dims["search_categories"], dims["search_sources"]
    named = cat.select("id", "name")
    places = (
        accepted.select("*", "src.provider", "src.dataset", "src.version", "src.record_id")
        .join(ac.withColumnRenamed("id", "address_context_id"), ["postcode", "locality", "region", "country"])
        .join(named.toDF("basic_category_id", "b_name"), F.col("tax.basic") == F.col("b_name"), "left")
        .join(named.toDF("taxonomy_primary_id", "p_name"), F.col("tax.prim") == F.col("p_name"), "left")
        .join(src.withColumnRenamed("id", "source_id"), ["provider", "dataset", "version"], "left")
        .select(
            F.col("place_id").alias("id"),
            "name",
            normalize_text(F.col("name")).alias("name_norm"),
            "address",
            normalize_text(F.col("address")).alias("address_norm"),
            "latitude",
            "longitude",
            "confidence",
            "freeform",
            "address_context_id",
            "operating_status",
            *[F.coalesce(c, F.lit(0)).alias(c) for c in ("basic_category_id", "taxonomy_primary_id", "source_id")],
            F.col("record_id").alias("source_record_id"),
        )
    )
    return {"places": places, **dims, "place_categories": build_bridge(accepted, cat)}


def place_star(places: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Places with their address, category and source names; '' where id is 0."""
    cat = dims["search_categories"].select("id", "name")
    out = (
        places.join(dims["address_contexts"].withColumnRenamed("id", "address_context_id"), "address_context_id", "left")
        .join(cat.toDF("basic_category_id", "basic_category"), "basic_category_id", "left")
        .join(cat.toDF("taxonomy_primary_id", "taxonomy_primary"), "taxonomy_primary_id", "left")
        .join(dims["search_sources"].withColumnRenamed("id", "source_id"), "source_id", "left")
    )
    blank = ["postcode", "locality", "region", "country", "basic_category", "taxonomy_primary", "provider", "dataset", "version"]
    return out.withColumns({c: F.coalesce(c, F.lit("")) for c in blank})


def orphan_links(bridge: DataFrame, places: DataFrame, categories: DataFrame) -> DataFrame:
    """Links whose place or category does not exist."""
    no_place = bridge.join(places.select(F.col("id").alias("place_id")), "place_id", "left_anti")
    no_cat = bridge.join(categories.select(F.col("id").alias("category_id")), "category_id", "left_anti")
    return no_place.unionByName(no_cat).distinct()


def pack_counts(places: DataFrame, contexts: DataFrame, bridge: DataFrame) -> DataFrame:
    """One row: records, categorised, structured-address and source-identified places."""
    structured = F.col("freeform") != ""
    for c in ("postcode", "locality", "region", "country"):
        structured = structured | (F.coalesce(c, F.lit("")) != "")
    per_place = places.join(contexts.withColumnRenamed("id", "address_context_id"), "address_context_id", "left").agg(
        F.count(F.lit(1)).alias("record_count"),
        F.count_if(structured).alias("structured_address_count"),
        F.count_if((F.col("source_id") != 0) | (F.col("source_record_id") != "")).alias("source_identified_count"),
    )
    linked = bridge.agg(F.count_distinct("place_id").alias("categorized_count"))
    return per_place.join(F.broadcast(linked))  # one row on both sides


def category_counts(bridge: DataFrame, categories: DataFrame) -> DataFrame:
    """Distinct places per category name."""
    per_id = bridge.groupBy("category_id").agg(F.count_distinct("place_id").alias("places"))
    return per_id.join(categories.select(F.col("id").alias("category_id"), "name"), "category_id").select(
        "name", "places"
    )


def table_fingerprint(table: DataFrame, columns: list[str]) -> DataFrame:
    """Order-free content fingerprint of a table, mergeable across partitions.

    Rows are hashed to two 64-bit values whose wrapping sums and count are hashed
    again, so no task ever holds the table.
    """
    text = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    parts = table.select(F.xxhash64(text).alias("a"), F.xxhash64(text, F.lit("second")).alias("b"))
    # Split into 32-bit halves: the sums cannot overflow a decimal.
    sums = parts.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("a").cast("decimal(20,0)")).alias("a"),
        F.sum(F.col("b").cast("decimal(20,0)")).alias("b"),
    )
    return sums.select(
        F.col("n").alias("row_count"),
        F.concat(
            F.lit("sha256:"),
            F.sha2(F.concat_ws("|", "n", F.coalesce("a", F.lit(0)), F.coalesce("b", F.lit(0))), 256),
        ).alias("fingerprint"),
    )


PACK_KEY = ["region_id", "pack_version"]


def _of_pack(packs: DataFrame, facts: DataFrame) -> DataFrame:
    """Facts beside their packs: by region and version, or one row for all where they carry neither."""
    if set(PACK_KEY) <= set(facts.columns):
        return packs.join(facts, PACK_KEY, "left")
    return packs.join(F.broadcast(facts))  # one row


def pack_manifest(counts: DataFrame, identity: DataFrame) -> DataFrame:
    """Manifest rows of packs: identity columns, source fingerprint, counts, capabilities.

    ``identity`` has one row a pack with region_id, pack_version, provider,
    data_release, client, client_version, input_sha256 and coverage.  ``counts``
    has a row a pack, with region_id and pack_version, or a single row without them.
    """
    source = {
        "provider": F.col("provider"),
        "dataRelease": F.col("data_release"),
        "client": F.col("client"),
        "clientVersion": F.col("client_version"),
        "inputSha256": F.col("input_sha256"),
        "coverage": F.col("coverage"),
    }
    return _of_pack(identity, counts).select(
        "*",
        canonical_fingerprint(**source).alias("source_fingerprint"),
        (F.col("categorized_count") > 0).alias("category_search"),
        (F.col("structured_address_count") > 0).alias("structured_address"),
        (F.col("source_identified_count") > 0).alias("source_identity"),
        F.lit(True).alias("proximity_ranking"),
    )


def validate_pack(
    manifest: DataFrame, counts: DataFrame, orphans: DataFrame, recorded: DataFrame, replayed: DataFrame
) -> DataFrame:
    """Violations of packs against their manifests.

    ``counts`` and ``orphans`` belong to the packs that their region_id and
    pack_version name; without these columns they belong to the single pack.
    ``recorded`` holds the search results noted in the manifest (query_id, rank,
    title, address, score); ``replayed`` the ranking computed now.
    """
    names = ["record_count", "categorized_count", "structured_address_count", "source_identified_count"]
    keys = [k for k in PACK_KEY if set(PACK_KEY) <= set(counts.columns)]
    own = [k for k in PACK_KEY if set(PACK_KEY) <= set(orphans.columns)]
    n_orphans = orphans.groupBy(*own).agg(F.count(F.lit(1)).alias("orphans"))
    row = _of_pack(_of_pack(manifest, counts.select(*keys, *[F.col(n).alias(f"now_{n}") for n in names])), n_orphans)
    row = row.withColumn("orphans", F.coalesce("orphans", F.lit(0)))
    source = {
        "provider": F.col("provider"),
        "dataRelease": F.col("data_release"),
        "client": F.col("client"),
        "clientVersion": F.col("client_version"),
        "inputSha256": F.col("input_sha256"),
        "coverage": F.col("coverage"),
    }
    rules = {f"{n}_mismatch": ~F.col(n).eqNullSafe(F.col(f"now_{n}")) for n in names}
    rules |= {f"{n}_not_positive": F.col(f"now_{n}") <= 0 for n in names[1:]}
    rules |= {
        "orphan_category_links": F.col("orphans") > 0,
        "source_fingerprint_mismatch": F.col("source_fingerprint") != canonical_fingerprint(**source),
        "client_version_not_semantic": ~F.col("client_version").rlike(r"^\d+\.\d+\.\d+$"),
        "input_sha_invalid": ~F.col("input_sha256").rlike("^[0-9a-f]{64}$"),
    }
    structural = violations(row, [F.col("region_id").alias("subject")], rules)
    now = replayed.select("query_id", "rank", *[F.col(c).alias(f"now_{c}") for c in ("title", "address", "score")])
    ranks = recorded.join(now, ["query_id", "rank"], "left")
    moved = F.lit(False)
    for c in ("title", "address", "score"):
        moved = moved | ~F.col(c).eqNullSafe(F.col(f"now_{c}"))
    gone = F.col("now_title").isNull()
    searches = violations(
        ranks,
        [F.concat(F.lit("query "), F.col("query_id").cast("string")).alias("subject")],
        {"recorded_rank_gone": gone, "recorded_result_changed": ~gone & moved},
    )
    return structural.unionByName(searches)
