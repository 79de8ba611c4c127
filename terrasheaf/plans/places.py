"""Queries over the place feed, the pack and batch search."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.ids import canonical_fingerprint, stable_id
from ..functions.text import clean_list, clean_text, normalize_text, query_tokens
from ..operators import places as P, search as S
from .registry import Tables, query


def nest(flat: DataFrame) -> DataFrame:
    """Give flat feature rows the nested layout of a place feed."""
    blank = F.lit(None).cast("string")
    address = F.struct(*[F.col(c) for c in ("freeform", "postcode", "locality", "region", "country")])
    source = "struct<provider:string,resource:string,dataset:string,record_id:string,recordId:string,version:string,confidence:string>"
    s1 = F.struct("s1_provider", blank, "s1_dataset", "s1_record", blank, F.lit("1"), "s1_conf").cast(source)
    s2 = F.struct("s2_provider", blank, blank, blank, "s2_record", blank, "s2_conf").cast(source)
    taxonomy = F.struct(
        F.col("prim").alias("primary"), F.array("hier1", "hier2").alias("hierarchy"), F.array("alt1").alias("alternates")
    )
    return flat.select(
        "ord",
        blank.alias("id"),
        F.struct(
            F.col("pid").alias("id"),
            F.struct(F.col("name").alias("primary")).alias("names"),
            F.when(F.col("has_address"), F.array(address)).alias("addresses"),
            F.col("conf").alias("confidence"),
            F.col("status").alias("operating_status"),
            F.col("basic").alias("basic_category"),
            taxonomy.alias("taxonomy"),
            F.struct(F.col("legacy_prim").alias("primary"), F.array("legacy_alt").alias("alternate")).alias("categories"),
            F.array(s2, s1).alias("sources"),
        ).alias("properties"),
        F.struct(
            F.lit("Point").alias("type"), F.when(F.col("has_position"), F.array("lon", "lat")).alias("coordinates")
        ).alias("geometry"),
    )


def feed(t: Tables) -> DataFrame:
    return nest(t("v_feature"))


def records(t: Tables) -> DataFrame:
    return P.place_records(feed(t), "AT")


@query("place_filter", "select ord, cname as name, latitude, longitude, confidence from d_kept")
def _(t):
    return P.place_filter(feed(t), "AT").select("ord", "name", "latitude", "longitude", "confidence")


@query("place_key", "select ord, place_id from d_rec")
def _(t):
    return P.place_key(P.place_filter(feed(t), "AT")).select("ord", "place_id")


@query("full_address", "select ord, address from d_kept")
def _(t):
    return P.place_filter(feed(t), "AT").select("ord", P.full_address(F.col("address_parts")).alias("address"))


@query(
    "taxonomy_fields",
    "select ord, basic, tprim as prim, array_to_string(thier, '|') as hierarchy, array_to_string(talts, '|') as alternates from d_tax",
)
def _(t):
    return records(t).select(
        "ord",
        "tax.basic",
        "tax.prim",
        F.array_join("tax.hierarchy", "|").alias("hierarchy"),
        F.array_join("tax.alternates", "|").alias("alternates"),
    )


@query("preferred_source", "select ord, provider, dataset, record_id, version from d_tax")
def _(t):
    return records(t).select("ord", "src.*")


@query("place_dedup", "select place_id, ord, cname as name from d_acc")
def _(t):
    return P.place_dedup(records(t)).select("place_id", "ord", "name")


@query(
    "build_dimensions",
    """select 'category' as dim, id, name as natural_key from d_catid
    union all select 'address', row_number() over (order by min(ord)), concat_ws('|', postcode, locality, region, country)
      from d_tax group by postcode, locality, region, country
    union all select 'source', row_number() over (order by min(ord)), concat_ws('|', provider, dataset, version)
      from d_tax group by provider, dataset, version""",
)
def _(t):
    r = records(t)
    d = P.build_dimensions(r, P.place_dedup(r))

    def out(name, table, cols):
        return d[table].select(F.lit(name).alias("dim"), "id", F.concat_ws("|", *cols).alias("natural_key"))

    return (
        out("category", "search_categories", ["name"])
        .unionByName(out("address", "address_contexts", ["postcode", "locality", "region", "country"]))
        .unionByName(out("source", "search_sources", ["provider", "dataset", "version"]))
    )


@query(
    "build_bridge",
    """select place_id, c.id as category_id, relation, ordinal from (
      select place_id, basic as name, 0 as relation, 0 as ordinal from d_acc where basic <> ''
      union all select place_id, unnest(thier), 1, generate_subscripts(thier, 1) - 1 from d_acc
      union all select place_id, unnest(talts), 2, generate_subscripts(talts, 1) - 1 from d_acc) l join d_catid c on c.name = l.name""",
)
def _(t):
    return P.build_pack(feed(t), "AT")["place_categories"]


@query(
    "build_pack",
    """select place_id as id, cname as name, lower(replace(cname, '_', ' ')) as name_norm, address, latitude, longitude, confidence, freeform,
      status as operating_status, coalesce(b.id, 0) as basic_category_id, coalesce(p.id, 0) as taxonomy_primary_id, record_id as source_record_id
    from d_acc left join d_catid b on b.name = basic left join d_catid p on p.name = tprim""",
)
def _(t):
    drop = ["address_norm", "address_context_id", "source_id"]
    return P.build_pack(feed(t), "AT")["places"].drop(*drop)


@query(
    "place_star",
    """select place_id as id, postcode, locality, region, country, basic as basic_category, tprim as taxonomy_primary, provider, dataset, version
    from d_acc""",
)
def _(t):
    pack = P.build_pack(feed(t), "AT")
    cols = "id postcode locality region country basic_category taxonomy_primary provider dataset version".split()
    return P.place_star(pack["places"], pack).select(*cols)


@query(
    "pack_counts",
    """select (select count(*) from d_acc) as record_count,
      (select count(*) from d_acc where freeform<>'' or postcode<>'' or locality<>'' or region<>'' or country<>'') as structured_address_count,
      (select count(*) from d_acc where provider<>'' or record_id<>'') as source_identified_count,
      (select count(*) from d_acc) as categorized_count""",
)
def _(t):
    pack = P.build_pack(feed(t), "AT")
    return P.pack_counts(pack["places"], pack["address_contexts"], pack["place_categories"])


@query(
    "orphan_links",
    """select distinct place_id, category_id, relation, ordinal from (
      select concat(place_id, case when category_id % 5 = 0 then 'q' else '' end) as place_id,
        category_id + case when category_id % 7 = 0 then 1000000 else 0 end as category_id, relation, ordinal from v_bridge) b
    where place_id not in (select place_id from v_places) or category_id not in (select id from v_cats)""",
)
def _(t):
    c = F.col("category_id")
    broken = t("v_bridge").withColumns(
        {
            "place_id": F.concat("place_id", F.when(c % 5 == 0, "q").otherwise("")),
            "category_id": c + F.when(c % 7 == 0, 1000000).otherwise(0),
        }
    )
    return P.orphan_links(broken, t("v_places").select(F.col("place_id").alias("id")), t("v_cats"))


@query(
    "category_counts",
    "select name, count(distinct place_id) as places from v_bridge join v_cats on id = category_id group by name",
)
def _(t):
    return P.category_counts(t("v_bridge"), t("v_cats"))


def _identity(t):
    return t.sql(
        """select r_name as region_id, concat('v', cast(r_regionkey as varchar(20))) as pack_version, 'Public places' as provider,
        '2024-01' as data_release, 'client' as client, concat('1.2.', cast(r_regionkey as varchar(20))) as client_version,
        repeat('a', 64) as input_sha256, concat('cover-', r_name) as coverage from region"""
    )


_SOURCE_JSON = """concat('{"client":"client","clientVersion":"1.2.', r_regionkey, '","coverage":"cover-', r_name,
  '","dataRelease":"2024-01","inputSha256":"', repeat('a', 64), '","provider":"Public places"}')"""


@query(
    "pack_manifest",
    f"""select r_name as region_id, concat('v', r_regionkey) as pack_version, concat('sha256:', sha256({_SOURCE_JSON})) as source_fingerprint,
      (select count(*) from d_acc) as record_count, (select count(*) from d_acc) as categorized_count, true as category_search from region""",
)
def _(t):
    pack = P.build_pack(feed(t), "AT")
    counts = P.pack_counts(pack["places"], pack["address_contexts"], pack["place_categories"])
    return P.pack_manifest(counts, _identity(t)).select(
        "region_id", "pack_version", "source_fingerprint", "record_count", "categorized_count", "category_search"
    )


@query("open_places", "select place_id from v_places where operating_status <> 'permanently_closed'")
def _(t):
    return S.open_places(t("v_places")).select("place_id")


@query(
    "bbox_filter",
    """select place_id from v_places where abs(latitude - 45.3e0) <= 40/111.32e0
      and abs(longitude - 11.7e0) <= 40/(111.32e0*greatest(0.15e0, cos(radians(45.3e0))))""",
)
def _(t):
    return S.bbox_filter(t("v_places"), 45.3, 11.7, 40.0).select("place_id")


@query("token_candidates", "select query_id, place_id from d_tokcand")
def _(t):
    return S.token_candidates(S.prepare_queries(t("v_queries")), t("v_places"))


@query("category_semi", "select query_id, place_id from d_catcand")
def _(t):
    return S.category_semi(S.prepare_queries(t("v_queries")), t("v_bridge"), t("v_cats"))


_ALL1 = """
  select t.query_id, p.place_id, row_number() over (partition by t.query_id order by
    case when name_norm = coalesce(toks[1], q_norm) then 0 when starts_with(name_norm, coalesce(toks[1], q_norm)) then 1 else 2 end,
    confidence desc, p.place_id) as pos
  from d_tokcand t join d_query q on q.query_id = t.query_id join v_places p on p.place_id = t.place_id where length(q_norm) >= 2"""
_RET1 = f"select query_id, place_id, pos from ({_ALL1}) r where pos <= 240"


@query("retrieve_topk_v1", _RET1)
def _(t):
    return S.retrieve_topk_v1(S.prepare_queries(t("v_queries")), t("v_places"), limit=240)


@query("retrieve_topk_v2", "select query_id, place_id, pos from d_ret2")
def _(t):
    return S.retrieve_topk_v2(S.prepare_queries(t("v_queries")), t("v_places"), t("v_bridge"), t("v_cats"), 3000, 900)


@query(
    "rank_v1",
    f"""select query_id, rank, place_id, title, address, score from (
      select *, row_number() over (partition by query_id order by score desc, confidence desc, pos) as rank from (
        select r.query_id, r.pos, p.place_id, p.name as title, p.address, confidence,
          floor(confidence*100.0e0)::bigint + case when name_norm = q_norm then 4000 else 0 end
          + case when starts_with(name_norm, q_norm) then 2000 else 0 end + case when contains(name_norm, q_norm) then 1000 else 0 end
          + case when len(toks) > 1 and name_norm = toks[1] then 2500 else 0 end
          + 250*len(list_filter(toks, lambda t: list_contains(string_split(concat(name_norm, ' ', address_norm), ' '), t))) as score
        from ({_ALL1}) r join d_query q on q.query_id = r.query_id join v_places p on p.place_id = r.place_id
        qualify row_number() over (partition by r.query_id, name_norm, address_norm order by r.pos) = 1) a) b
    where rank <= 99""",
)
def _(t):
    q, p = S.prepare_queries(t("v_queries")), t("v_places")
    out = S.rank_v1(S.retrieve_topk_v1(q, p), q, p, limit=99)
    return out.select("query_id", "rank", "place_id", "title", "address", "score")


def ranked(t: Tables) -> DataFrame:
    return t.held("ranked", lambda: _ranked(t))


def _ranked(t: Tables) -> DataFrame:
    q, p = S.prepare_queries(t("v_queries")), t("v_places")
    return S.rank_v2(S.retrieve_topk_v2(q, p, t("v_bridge"), t("v_cats")), q, p)


@query("rank_v2", "select * from d_rank2")
def _(t):
    return ranked(t).withColumn("distance_m", F.round("distance_m", 3))


@query(
    "hydrate_taxonomy",
    """select query_id, rank, r.place_id, case when basic_category = taxonomy_primary then basic_category
      else concat(basic_category, '|', taxonomy_primary) end as hierarchy, alt as alternates from d_rank2 r join v_places p on p.place_id = r.place_id""",
)
def _(t):
    out = S.hydrate_taxonomy(ranked(t).select("query_id", "rank", "place_id"), t("v_bridge"), t("v_cats"))
    return out.withColumns({c: F.array_join(c, "|") for c in ("hierarchy", "alternates")})


@query(
    "search_regression",
    """with tg as (select query_id, 'small ring NATION_' || (query_id - 100) as name_equals, query_id % 4 as f from v_queries where query_id >= 100)
    select tg.query_id, name_equals, min(case when lower(title) = lower(name_equals) and (f <> 0 or contains(lower(address), 'street 1')) then rank end) as matched_rank,
      count(case when lower(title) = lower(name_equals) and (f <> 0 or contains(lower(address), 'street 1')) then 1 end) > 0 as passed
    from tg left join d_rank2 r on r.query_id = tg.query_id group by tg.query_id, name_equals""",
)
def _(t):
    targets = t.sql(
        "select query_id, concat('small ring NATION_', cast(query_id - 100 as varchar(20))) as name_equals, query_id % 4 as f from v_queries where query_id >= 100"
    ).withColumn("fragments", F.when(F.col("f") == 0, F.array(F.lit("Street 1"))).otherwise(F.array().cast("array<string>")))
    return S.search_regression(targets, ranked(t))


def _pack_rows(t, view):
    return t(view).withColumnRenamed("place_id", "id")


_DIFF = """select coalesce(a.place_id, b.place_id) as id, case when a.place_id is null then 'added' when b.place_id is null then 'removed' else 'changed' end as change
  from v_places a full join v_places2 b on a.place_id = b.place_id
  where a.place_id is null or b.place_id is null or a.name <> b.name"""


@query("diff_places", _DIFF)
def _(t):
    return S.diff_places(_pack_rows(t, "v_places"), _pack_rows(t, "v_places2"))


@query("diff_report", f"select change, id, count(*) over (partition by change) as n from ({_DIFF}) d")
def _(t):
    return S.diff_report(S.diff_places(_pack_rows(t, "v_places"), _pack_rows(t, "v_places2")))


@query(
    "refused_queries",
    """select c_custkey as query_id, case when c_custkey % 3 = 0 then 'ORIGIN_INCOMPLETE_OR_OUT_OF_RANGE' else 'NOTHING_ASKED' end as refusal
    from customer where c_custkey % 3 = 0 or c_custkey % 5 = 0""",
)
def _(t):
    asked = t.sql(
        """select c_custkey as query_id, case when c_custkey % 5 = 0 then 'x' else c_name end as text, cast(null as string) as category,
        case when c_custkey % 3 = 0 then 45.5e0 end as lat, cast(null as double) as lon from customer"""
    )
    return S.refused_queries(asked)


@query(
    "diff_categories",
    """with a as (select alt as name, count(*) as n from v_places group by alt), b as (select alt as name, count(*) as n from v_places2 group by alt)
    select coalesce(a.name, b.name) as name, coalesce(a.n, 0) as a, coalesce(b.n, 0) as b, coalesce(b.n, 0) - coalesce(a.n, 0) as delta
    from a full join b on a.name = b.name where coalesce(a.n, 0) <> coalesce(b.n, 0)""",
)
def _(t):
    def counts(view):
        links = t(view).select("place_id", F.col("alt").alias("category_id"))
        return P.category_counts(links, links.select(F.col("category_id").alias("id"), F.col("category_id").alias("name")).distinct())

    return S.diff_categories(counts("v_places"), counts("v_places2"))


@query(
    "validate_pack",
    """with n as (select count(*) as n from v_places), o as (select count(*) as o from v_bridge where category_id % 7 = 0)
    select r_name as subject, code from region, n, o, unnest([case when r_regionkey % 2 = 1 then 'record_count_mismatch' end,
      case when o > 0 then 'orphan_category_links' end, case when r_regionkey = 3 then 'client_version_not_semantic' end,
      case when r_regionkey >= 3 then 'source_fingerprint_mismatch' end]) as u(code) where code is not null
    union all select concat('query ', query_id), 'recorded_result_changed' from d_rank2 where score % 3 = 0
    union all select concat('query ', query_id), 'recorded_rank_gone' from (select query_id, max(rank) from d_rank2 group by query_id) m""",
)
def _(t):
    places = t("v_places")
    counts = places.agg(
        F.count(F.lit(1)).alias("record_count"),
        F.count(F.lit(1)).alias("categorized_count"),
        F.count(F.lit(1)).alias("structured_address_count"),
        F.count(F.lit(1)).alias("source_identified_count"),
    )
    man = P.pack_manifest(counts, _identity(t))
    key = F.substring("pack_version", 2, 9).cast("int")
    man = man.withColumns(
        {
            "record_count": F.col("record_count") + key % 2,
            "client_version": F.when(key == 3, "x").otherwise(F.col("client_version")),
            "coverage": F.when(key >= 3, "moved").otherwise(F.col("coverage")),
        }
    )
    cats = t("v_cats").filter("id % 7 <> 0")
    orphans = P.orphan_links(t("v_bridge"), places.select(F.col("place_id").alias("id")), cats)
    now = ranked(t)
    recorded = now.select("query_id", "rank", "title", "address", F.when(F.col("score") % 3 == 0, F.col("score") + 1).otherwise(F.col("score")).alias("score"))
    gone = now.groupBy("query_id").agg(F.max("rank").alias("rank")).select(
        "query_id", F.col("rank") + 100, F.lit("").alias("title"), F.lit("").alias("address"), F.lit(0).cast("long").alias("score")
    )
    return P.validate_pack(man, counts, orphans, recorded.union(gone), now)


# --- scalar functions on the text tables ---------------------------------


@query(
    "normalize_text",
    # Compatibility letters (ligatures, wide forms) aside, stripping accents is the fold of the pack.
    "select doc_id, trim(regexp_replace(lower(strip_accents(coalesce(text, ''))), '[^\\p{L}\\p{N}]+', ' ', 'g')) as norm from documents",
)
def _(t):
    return t("documents").select("doc_id", normalize_text(F.col("text")).alias("norm"))


@query(
    "clean_text",
    """select doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) as cleaned, len(string_split(text, chr(10))) as lines,
     len(list_distinct(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(regexp_replace(x, '\\s+', ' ', 'g'))), lambda x: x <> ''))) as distinct_lines
     from documents""",
)
def _(t):
    lines = F.split("text", "\n")
    return t("documents").select(
        "doc_id",
        clean_text(F.col("text")).alias("cleaned"),
        F.size(lines).alias("lines"),
        F.size(clean_list(lines)).alias("distinct_lines"),
    )


@query(
    "query_tokens",
    """with w as (select conv_id, turn, unnest(string_split(n, ' ')) as tok, generate_subscripts(string_split(n, ' '), 1) as i from (
        select conv_id, turn, trim(regexp_replace(lower(strip_accents(text)), '[^\\p{L}\\p{N}]+', ' ', 'g')) as n from conversations) a),
      f as (select conv_id, turn, tok, min(i) as i from w where length(tok) >= 2 group by conv_id, turn, tok),
      r as (select *, row_number() over (partition by conv_id, turn order by i) as k from f)
    select conv_id, turn, string_agg(tok, ' ' order by k) as tokens from r group by conv_id, turn""",
)
def _(t):
    tokens = query_tokens(normalize_text(F.col("text"), "query"))
    out = t("conversations").select("conv_id", "turn", F.array_join(tokens, " ").alias("tokens"))
    return out.filter(F.col("tokens") != "")


@query(
    "stable_id",
    "select o_orderkey, concat('peer-', substr(sha256(concat_ws('|', o_orderkey, o_custkey, o_orderstatus)), 1, 24)) as id from orders",
)
def _(t):
    return t("orders").select("o_orderkey", stable_id("peer-", F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus")).alias("id"))


@query(
    "canonical_fingerprint",
    """select o_orderkey, concat('sha256:', sha256(concat('{"customer":', o_custkey, ',"priority":"', o_orderpriority, '","status":"', o_orderstatus, '"}'))) as fingerprint
    from orders""",
)
def _(t):
    fp = canonical_fingerprint(status=F.col("o_orderstatus"), priority=F.col("o_orderpriority"), customer=F.col("o_custkey"))
    return t("orders").select("o_orderkey", fp.alias("fingerprint"))
