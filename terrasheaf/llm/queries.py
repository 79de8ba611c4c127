"""Runnable queries of this subpackage, op1 to op13, with SQL where it can express them."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe,
    decontamination,
    hard_negatives,
    html_text,
    importance,
    language_id,
    line_dedup,
    merkle,
    quality_rules,
    simhash,
    span_dedup,
    token_files,
    url_filter,
)
from .common import read_table, run_dir, stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


# Vocabulary files of public tokenizers; they are read in place and never copied.
TOKENIZERS = os.environ.get("PUBLIC_TOKENIZERS", "/opt/tokenizers")


def vocabulary(name: str) -> str:
    try:
        import public_tokenizers
    except ModuleNotFoundError:
        return os.path.join(TOKENIZERS, name)
    return public_tokenizers.path(name)


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
# The list of blocked URLs is derived from the pages: all URLs of hosts that hold one of these names.
LISTED_HOSTS = r"(^|\.)(spam-farm|cheap-pills)\."


@query
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    listed = pages.select("url").where(url_filter.host_of(F.col("url")).rlike(LISTED_HOSTS))
    return url_filter.judge(pages, RULES, listed).select("page_id", "host", "path", "rule", "verdict")


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(read_table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query
def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode(read_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), decoded=True)
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


@query
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "token-files")
    token_files.write_token_files(read_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), path)
    return token_files.read_token_files(spark, path, crc32=True)


@query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.matches(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["first"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = language_id.fit(docs.where(~language_id.held_out("doc_id")))
    told = language_id.predict(docs, model)
    return told.select("doc_id", language_id.held_out("doc_id").alias("held_out"), "lang_pred", "score")


@query
def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.extract(read_table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


@query
def op8_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = stage(simhash.fingerprints(read_table(spark, sf_dir, "documents"), shingle=4), "simhash")
    return simhash.components(prints, most=4).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


@query
def op9_span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = span_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "text", "n_sentences", "n_removed")


@query
def op10_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query
def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_repeated(line_dedup.file_batches(read_table(spark, sf_dir, "documents")))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives.integer_rows(read_table(spark, sf_dir, "embeddings"), label=moved)
    return hard_negatives.mine(rows, F.col("vec_id") % 50 == 0)


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = {"text": merkle.tampered(F.col("text"), F.col("doc_id"))}
    rows = merkle.manifest(read_table(spark, sf_dir, "documents"), shown)
    folded = merkle.fold(F.col("presented_leaf"), F.col("path"))
    rows = rows.withColumns({"proof_sha256": merkle.proof(F.col("path")), "folded_root": folded})
    return rows.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


# ------------------------------------------------------------------ comparison SQL

_WS = r"[\x20\x09-\x0D]"

ORACLES["op5_decontamination"] = r"""
with low as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w
  from documents),
item as (
  select cast(item_id as varchar) item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w
  from benchmark),
win as (
  select distinct item_id, least(10, len(w)) n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') g
  from (select item_id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) i from item where len(w) > 0)),
sizes as (select distinct n from win),
runs as (
  select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') g
  from (select doc_id, n, w, unnest(generate_series(1, len(w) - n + 1)) i from low, sizes where len(w) >= n)),
met as (select r.doc_id, r.n, r.i, win.item_id from runs r join win on r.n = win.n and r.g = win.g),
spot as (select doc_id, count(distinct p) n_hit from (select doc_id, unnest(generate_series(i, i + n - 1)) p from met) group by doc_id),
named as (
  select doc_id, count(*) n_items, array_to_string(list(item_id order by item_id), ',') items
  from (select distinct doc_id, item_id from met) group by doc_id)
select l.doc_id, cast(len(w) as bigint) n_words, cast(coalesce(n_hit, 0) as bigint) n_hit, cast(coalesce(n_items, 0) as bigint) n_items,
  sha256(coalesce(items, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from low l left join spot using (doc_id) left join named using (doc_id)
"""


def _op2_sql() -> str:
    """The counts in plain SQL, and the rounds of the estimate as a recursive query."""
    q = quality_rules
    stop = ", ".join(f"'{w}'" for w in sorted(set(q.FUNCTION_WORDS)))
    rules = range(1, len(q.RULES) + 1)
    odds = "ln(prior / (1 - prior)) + " + " + ".join(
        f"case when v{j} > 0 then ln(g{j} / (1 - b{j})) when v{j} < 0 then ln((1 - g{j}) / b{j}) else 0 end" for j in rules
    )
    held = f"greatest(1, {q.START_SHARE} * sum(n))"
    good = {
        j: f"greatest(0.5, least({q.MOST}, (sum(case when v{j} > 0 then n * q else 0 end) + {q.START_ON_GOOD} * {held}) / (sum(case when v{j} <> 0 then n * q else 0 end) + {held})))"
        for j in rules
    }
    bad = {
        j: f"greatest({q.LEAST}, least({q.MOST}, greatest(1 - {good[j]}, (sum(case when v{j} < 0 then n * (1 - q) else 0 end) + {q.START_ON_BAD} * {held}) / (sum(case when v{j} <> 0 then n * (1 - q) else 0 end) + {held}))))"
        for j in rules
    }
    learn = ", ".join(f"{good[j]}, {bad[j]}" for j in rules)
    begin = ", ".join(f"cast({q.START_ON_GOOD} as double) g{j}, cast({q.START_ON_BAD} as double) b{j}" for j in rules)
    return rf"""
with recursive cut as (
  select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '{_WS}+'), lambda x: x <> '') w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) l,
    cast(length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) as bigint) n_symbols
  from documents),
runs as (
  select doc_id, i, array_to_string(w[i:i + 7], ' ') g
  from (select doc_id, w, unnest(generate_series(1, len(w) - 7)) i from cut where len(w) >= 8)),
twice as (select doc_id, g from runs group by doc_id, g having count(*) > 1),
spots as (select doc_id, count(distinct p) n from (select r.doc_id, unnest(generate_series(r.i, r.i + 7)) p from runs r join twice using (doc_id, g)) group by doc_id),
counts as (
  select c.doc_id, cast(len(w) as bigint) n_words, cast(length(array_to_string(w, '')) as bigint) word_chars, n_symbols,
    cast(len(l) - len(list_distinct(l)) as bigint) n_dup_lines, cast(coalesce(s.n, 0) as bigint) n_repeat_words, len(l) n_lines,
    len(list_filter(l, lambda x: regexp_matches(x, '[.!?…] *$'))) n_end_lines, len(list_filter(w, lambda x: lower(x) in ({stop}))) n_function_words
  from cut c left join spots s using (doc_id)),
voted as (
  select *, greatest(n_words, 1) ws, greatest(n_lines, 1) ls,
    case when 10 * n_symbols > ws then -1 when 100 * n_symbols <= ws then 1 else 0 end v1,
    case when 100 * n_function_words < 8 * ws then -1 when 100 * n_function_words >= 15 * ws then 1 else 0 end v2,
    case when 100 * n_dup_lines > 50 * ls then -1 when n_dup_lines = 0 and n_lines > 2 then 1 else 0 end v3,
    case when 100 * n_repeat_words > 30 * ws then -1 when n_repeat_words = 0 then 1 else 0 end v4,
    case when word_chars > 9 * ws then -1 when word_chars >= 2 * ws and word_chars <= 8 * ws then 1 else 0 end v5,
    case when 100 * n_end_lines < 40 * ls then -1 when 100 * n_end_lines >= 75 * ls then 1 else 0 end v6,
    n_words < 20 or 100 * n_repeat_words > 30 * n_words base_failed
  from counts),
patterns as (select {", ".join(f"v{j}" for j in rules)}, cast(count(*) as double) n from voted group by all),
em as (
  select 0 i, cast({q.START_PRIOR} as double) prior, {begin}
  union all
  select i + 1, greatest(0.01, least(0.99, (sum(n * q) + {q.START_PRIOR} * {held}) / (sum(n) + {held}))), {learn}
  from (select em.*, p.*, 1 / (1 + exp(-({odds}))) q from em, patterns p where i < {q.ROUNDS}) group by i),
model as (select * from em where i = {q.ROUNDS})
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and 1 / (1 + exp(-({odds}))) >= 0.5 kept
from voted, model
"""


ORACLES["op2_quality_rules"] = _op2_sql()

_SP = r"[^\x20\x09-\x0D]"
ORACLES["op9_span_dedup"] = rf"""
with tok as (
  select doc_id, unnest(t) token, unnest(generate_series(1, len(t))) k, len(t) size
  from (select doc_id, regexp_extract_all(text, '{_SP}+{_WS}*|^{_WS}+') t from documents) c),
word as (
  select *, regexp_replace(token, '{_WS}+$', '') w,
    k = size or regexp_matches(token, '[.!?…]+{_WS}+$') or regexp_matches(token, '\n{_WS}*$') ends
  from tok),
sen as (select *, coalesce(sum(cast(ends as int)) over (partition by doc_id order by k rows between unbounded preceding and 1 preceding), 0) s from word),
long as (select *, count(case when w <> '' then 1 end) over (partition by doc_id, s) words from sen),
piece as (
  select *, coalesce(sum(case when ends or (words > {span_dedup.LONG} and w <> '' and (31 * unicode(w) + 7 * unicode(right(w, 1)) + length(w)) % {span_dedup.CUT_ONE_IN} = 0) then 1 else 0 end)
    over (partition by doc_id order by k rows between unbounded preceding and 1 preceding), 0) c
  from long),
cut as (
  select doc_id, c + 1 i, string_agg(token, '' order by k) raw, coalesce(string_agg(case when w <> '' then w end, ' ' order by k), '') p, count(case when w <> '' then 1 end) z
  from piece group by doc_id, c),
held as (select doc_id, list(raw order by i) raw, list(p order by i) p, list(z order by i) z from cut group by doc_id),
sums as (select *, list_transform(generate_series(0, len(z)), lambda j: coalesce(list_sum(z[1:j]), 0)) acc from held),
starts as (select doc_id, p, acc, unnest(generate_series(1, len(p))) i from sums),
sized as (
  select *, 1 + len(list_filter(acc[i + 1:], lambda x: x - acc[i] < {span_dedup.LEAST_WORDS})) enough from starts),
lengths as (
  select *, unnest(list_distinct(list_filter([1, 2, greatest({span_dedup.SENTENCES}, enough)], lambda n: i + n - 1 <= len(p)
    and (n = greatest({span_dedup.SENTENCES}, enough) or acc[i + n] - acc[i] >= {span_dedup.WORDS} and n < {span_dedup.SENTENCES})))) n
  from sized),
runs as (select doc_id, i, n, array_to_string(p[i:i + n - 1], chr(10)) g from lengths),
ranked as (select *, row_number() over (partition by g order by doc_id, i) nth from runs),
gone as (select distinct doc_id, unnest(generate_series(i, i + n - 1)) i from ranked where nth > 1),
kept as (
  select c.doc_id, count(*) n_sentences, count(g.i) n_removed, string_agg(case when g.i is null then raw end, '' order by c.i) t
  from cut c left join gone g on g.doc_id = c.doc_id and g.i = c.i group by c.doc_id)
select d.doc_id, case when coalesce(k.n_removed, 0) > 0 then regexp_replace(coalesce(k.t, ''), '{_WS}+$', '') else d.text end as text,
  cast(coalesce(k.n_sentences, 0) as bigint) n_sentences, cast(coalesce(k.n_removed, 0) as bigint) n_removed
from documents d left join kept k on k.doc_id = d.doc_id
"""

ORACLES["op1_url_filter"] = r"""
with cut as (
  select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end rest from pages),
parts as (
  select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) path,
    list_sort(list_filter(string_split(regexp_extract(rest, '^[^?#]*\\?([^#]*)', 1), '&'),
      lambda p: p <> '' and not regexp_matches(p, '^(utm_[^=]*|ref|fbclid|gclid)(=|$)'))) asked
  from cut),
named as (
  select *, regexp_replace(regexp_replace(host, ':(80|443)$', ''), '^www\\.', '') || regexp_replace(path, '/+$', '')
    || case when len(asked) > 0 then '?' || array_to_string(asked, '&') else '' end canonical
  from parts),
listed as (select distinct canonical from named where canonical <> '' and regexp_matches(host, '(^|\\.)(spam-farm|cheap-pills)\\.')),
rules(host, path, verdict) as (
  values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fit as (
  select n.page_id, r.host || r.path as rule, r.verdict, row_number() over (partition by n.page_id order by length(r.host || r.path) desc) nth
  from named n join rules r on (n.host = r.host or ends_with(n.host, '.' || r.host)) and starts_with(n.path, r.path))
select n.page_id, n.host, n.path, f.rule, coalesce(f.verdict, case when l.canonical is not null then 'block' else 'allow' end) verdict
from named n left join fit f on f.page_id = n.page_id and f.nth = 1 left join listed l using (canonical)
""".replace("\\\\", "\\")

ORACLES["op11_line_dedup"] = r"""
with lines as (
  select row_number() over () r, doc_id, string_split(coalesce(text, ''), chr(10)) l from documents),
each as (select r, doc_id, unnest(l) line, unnest(generate_series(1, len(l))) i from lines),
keyed as (
  select *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') k
  from each),
often as (select k from keyed where k <> '' group by k having count(distinct r) >= 10)
select any_value(doc_id) doc_id, cast(count(*) as bigint) n_lines, cast(count(o.k) as bigint) n_dropped,
  sha256(coalesce(string_agg(case when o.k is null then line end, chr(10) order by i), '')) kept_sha256
from keyed left join often o using (k)
group by r
"""


def _op13_sql(most: int = 6) -> str:
    """The tree level by level: ``most`` levels, so up to 16^most documents a source and as many sources."""

    def field(value: str) -> str:
        return f"coalesce(strlen({value}) || ':' || {value}, '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join([*(field(f"cast({c} as varchar)") for c in ("doc_id", "source", "lang", "n_chars")), field(text)]) + ")"

    # CRC-32 bit by bit: polynomial and start value are those of the standard.
    crc = (
        "xor(list_reduce([4294967295] || list_transform(string_split(cast(doc_id as varchar), ''), lambda x: cast(ascii(x) as bigint)), "
        "lambda c, x: list_reduce([xor(c, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda d, y: xor(d >> 1, 3988292384 * (d & 1)))), 4294967295)"
    )
    parts = [
        f"""given as (
  select *, case when doc_id is not null and {crc} % 5 = 0 then translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') else text end seen from documents)""",
        f"""leaves as (select doc_id, coalesce('s' || cast(source as varchar), '') s, {leaf("text")} h, {leaf("seen")} shown from given)""",
        """a0 as (select *, row_number() over (partition by s order by doc_id nulls first, h) - 1 i, count(*) over (partition by s) n from leaves)""",
    ]

    def tree(name: str) -> None:
        for k in range(most):
            parts.append(
                f"""{name}{k + 1} as (
  select s, i // 16 i, (n + 15) // 16 n, case when n = 1 then any_value(h) else sha256(string_agg(h, '' order by i)) end h from {name}{k} group by s, i // 16, n)"""
            )
            over = f"partition by s, i // 16 order by i rows between"
            parts.append(
                f"""{name}{k}_sides as (
  select s, i, n > 1 more, coalesce(string_agg(h, '') over ({over} unbounded preceding and 1 preceding), '') l,
    coalesce(string_agg(h, '') over ({over} 1 following and unbounded following), '') r from {name}{k})"""
            )

    tree("a")
    parts.append(f"b0 as (select '' s, h, s as own, row_number() over (order by s) - 1 i, count(*) over () n from a{most})")
    tree("b")
    steps = [("a", k) for k in range(most)] + [("b", k) for k in range(most)]
    joins = " ".join(
        f"join {t}{k}_sides {t}s{k} on {t}s{k}.s = {'x.s' if t == 'a' else chr(39) * 2} and {t}s{k}.i = {'x' if t == 'a' else 'b0'}.i // {16**k}" for t, k in steps
    )
    proof = " || ".join(f"{t}s{k}.l || {t}s{k}.r" for t, k in steps)
    parts.append(f"held as (select x.doc_id, x.h leaf, x.shown, b0.h subroot, sha256({proof}) proof_sha256, [{', '.join(f'[cast({t}s{k}.more as varchar), {t}s{k}.l, {t}s{k}.r]' for t, k in steps)}] path from a0 x join b0 on b0.own = x.s {joins})")
    return (
        "with "
        + ",\n".join(parts)
        + f""",
folded as (
  select doc_id, leaf, subroot, (select h from b{most}) root, proof_sha256,
    list_reduce([['', shown, '']] || path, lambda c, p: ['', case when p[1] = 'true' then sha256(p[2] || c[2] || p[3]) else c[2] end, ''])[2] folded_root
  from held)
select *, folded_root = root verified from folded"""
    )


ORACLES["op13_merkle_manifest"] = _op13_sql()

ORACLES["op12_hard_negatives"] = r"""
with held as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end l,
    list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) q
  from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
anchors as (select * from held where vec_id % 50 = 0),
scored as (
  select a.vec_id anchor_id, h.vec_id other, a.l = h.l same, cast(list_sum(list_transform(list_zip(a.q, h.q), lambda p: p[1] * p[2])) as bigint) score
  from anchors a join held h on h.vec_id <> a.vec_id),
positives as (select anchor_id, other positive_id, score positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, other) <= 5)
select p.anchor_id, p.positive_id, cast(row_number() over w as integer) rank, s.other negative_id, p.positive_score, s.score negative_score
from positives p join scored s on s.anchor_id = p.anchor_id and not s.same and 50 * p.positive_score <= 100 * s.score and 100 * s.score <= 95 * p.positive_score
window w as (partition by p.anchor_id, p.positive_id order by s.score desc, s.other)
qualify row_number() over w <= 3
"""
