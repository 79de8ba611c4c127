"""URL filters: host and path rules, then a list of canonical URLs.

Listed URLs are kept in a blocked Bloom filter: each URL sets one bit in each of
eight lanes of one block, so a lookup touches 32 bytes.  Blocks are built by an
aggregate over the list; their number is bounded (32 MB), which bounds what is
sent to the tasks.  Possible hits are joined with the list by
their canonical URL, which removes false positives, so the verdict is exact for
every size of the list.

Defined cases: a null URL or one without "://" has an empty host, path and
canonical form and is allowed; of rules that fit, the longest wins; repeated
pages are judged one by one; repeated or null entries of the list do no harm; an
empty table gives an empty result, an empty list blocks nothing; other columns
of the pages are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import filter_test, key_hashes, stage

MOST_RULES = 1000
# Query parameters that only tell where a visitor came from.
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=|$)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    """What follows the first "://"; empty where there is none."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def canonical_of(url: Column) -> Column:
    """Host without www. and default port, path without its last slash, sorted query without tracking."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), r":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    asked = F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(asked, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """Struct (rule, verdict) of the longest rule (host, path, verdict) that fits, else null."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule_host, rule_path, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        found = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], listed_urls: DataFrame) -> DataFrame:
    """(page_id, url, host, path, rule, verdict, canonical, listed) of every page.

    ``listed_urls`` has a column ``url``.  A page without a fitting rule is
    blocked if its canonical URL is listed.
    """
    listed = listed_urls.where(F.col("url").isNotNull()).select(canonical_of(F.col("url")).alias("canonical"))
    listed = stage(listed.where(F.col("canonical") != "").distinct(), "listed")
    h1, h2 = key_hashes(F.col("canonical"))
    possible = filter_test(pages.sparkSession, listed.select(h1.alias("h1"), h2.alias("h2")))
    url = F.col("url")
    read = pages.select("page_id", "url", host_of(url).alias("host"), path_of(url).alias("path"), canonical_of(url).alias("canonical"))
    read = read.select(
        "page_id",
        "url",
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("host", "path", "canonical")],
    ).withColumn("fit", rule_of(F.col("host"), F.col("path"), rules))
    marked = stage(read.withColumn("maybe", possible(h1, h2)), "urls")
    names = ["page_id", "url", "host", "path", "fit", "canonical"]
    hits = marked.where("maybe").join(listed.withColumn("listed", F.lit(True)), "canonical", "left").select(*names, "listed")
    rest = marked.where("not maybe").select(*names, F.lit(None).cast("boolean").alias("listed"))
    judged = hits.union(rest).withColumn("listed", F.coalesce("listed", F.lit(False)))
    verdict = F.coalesce("fit.verdict", F.when(F.col("listed"), "block").otherwise("allow"))
    return judged.select("page_id", "url", "host", "path", F.col("fit.rule").alias("rule"), verdict.alias("verdict"), "canonical", "listed")
