"""HTML extraction by differencing with the nearest URL's page.

A page becomes lines: the text of its blocks, without elements that never hold
main text (menus, headers, footers, forms, scripts ...) and without blocks whose
class, id or role names furniture or reader comments.  Pages are paired with the
page of the same host whose URL path is nearest (longest common beginning in
path order); the lines of both are aligned by a longest common subsequence, and
lines shared with the partner are deleted.

Where a page marks its article (article, main or role=main), the lines outside
are furniture and go, and inside it paragraphs, headings, quotations, code and
table cells are kept even when the partner shares them: copied articles and
passages that many pages quote are real text, which differencing alone would
delete.  Other lines of an article (bare text, lists, divisions), and all lines
of a page that marks no article, are deleted when shared; if more than half of a
page's characters would go, the partner is a copy and only lines without a full
sentence go.

Only line hashes travel to the partner.  Neighbours in path order are found
without gathering a host: pages are range-partitioned by (host, path, page_id),
written once, and the ends of partitions are joined to each other.

Defined cases: null and empty pages give an empty text; broken markup is read as
browsers do in the cases named at ``lines``; pages without a host are one host;
repeated pages are neighbours of each other; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import html as entities
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import by_bytes, ship, stage
from .url_filter import host_of, path_of

# Element names of HTML by their part in a page.
DROPPED = frozenset("nav header footer aside form script style noscript template svg iframe object canvas button select textarea dialog menu head".split())
OFTEN = 64  # places of a line up to which its bits are set one by one
RAW = frozenset("script style textarea noscript template iframe svg".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html li main nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre td th dd dt figcaption".split())
ENDS_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
FURNITURE = re.compile(
    r"(^|[\s_-])(ads?|adsense|adsbygoogle|advert\w*|banner|sponsor\w*|promo\w*|cookies?|consent|notices?|newsletter|subscribe|subscription|sidebar|side|"
    r"menu|nav\w*|breadcrumbs?|header|masthead|footer|foot|comments?|commentlist|replies|respond|disqus|share|sharing|social|related|"
    r"recommended|popup|modal|toolbar|widget|pagination|pager|login|signup|search|skip|toc)($|[\s_-])",
    re.I,
)
COMMENTS = re.compile(r"(^|[\s_-])(comments?|commentlist|replies|respond|disqus)($|[\s_-])", re.I)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
LINES = pa.list_(pa.struct([("line", pa.string()), ("kept", pa.bool_())]))
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)


def _is_furniture(name: str, attributes: str, nested: bool) -> tuple[bool, bool, bool]:
    """(furniture, reader comment, main) of an element by its attributes.

    An article is furniture only as a reader comment inside another article:
    names such as ``with-sidebar`` on a page's own article tell its layout.
    """
    if not attributes or name in ("html", "body"):
        return False, False, False
    main = False
    if name in ("article", "main"):
        words = " ".join("".join(v) for k, *v in _ATTRIBUTE.findall(attributes) if k.lower() in ("class", "id"))
        comment = nested and bool(COMMENTS.search(words))
        return comment, comment, True
    for key, *values in _ATTRIBUTE.findall(attributes):
        value, key = "".join(values), key.lower()
        if key == "hidden" or key == "role" and value.lower() in ROLES or key in ("class", "id") and FURNITURE.search(value):
            return True, bool(COMMENTS.search(value)), False
        main = main or key == "role" and value.lower() == "main"
    return False, False, main


def lines(page: str | None) -> list[tuple[str, bool, bool]]:
    """(text, inside an article, prose) of the blocks of a page in order.

    A block start ends an open paragraph, li ends li, and an end tag ends what is
    open inside its element; an end tag of nothing open is passed over; scripts
    and the like run to their own end tag; unfinished elements end with the page.
    """
    if not page:
        return []
    out: list[tuple[str, bool, bool]] = []
    open_: list[tuple[str, int, bool, bool]] = []  # name, drops its text, is an article, drops articles too
    dropped = articles = hard = 0
    held: list[str] = []

    def flush() -> None:
        text = " ".join(entities.unescape("".join(held)).split()) if held else ""
        held.clear()
        if text:
            block = next((n for n, *_ in reversed(open_) if n in BLOCKS), "")
            out.append((text, articles > 0, block in PROSE))

    def close(upto: int) -> None:
        nonlocal dropped, articles, hard
        while len(open_) > upto:
            _, drops, article, firm = open_.pop()
            dropped -= drops
            articles -= article
            hard -= firm

    at, size = 0, len(page)
    while at < size:
        token = _TOKEN.search(page, at)
        if token is None:
            if not dropped:
                held.append(page[at:])
            break
        if token.start() > at and not dropped:
            held.append(page[at : token.start()])
        at = token.end()
        if token.group(2) is None:
            continue
        name = token.group(2).lower()
        if token.group(1):
            depth = next((k for k in range(len(open_) - 1, -1, -1) if open_[k][0] == name), None)
            if name in BLOCKS:
                flush()
            if depth is not None:
                close(depth)
            continue
        if name in BLOCKS:
            flush()
            if name in ENDS_P or name == "li":
                ends = "li" if name == "li" else "p"
                for k in range(len(open_) - 1, -1, -1):
                    if open_[k][0] == ends:
                        close(k)
                        break
                    if open_[k][0] in BLOCKS:
                        break
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            at = end.end() if end else size
            continue
        if name in VOID or token.group(3).endswith("/") and name not in BLOCKS:
            continue
        furniture, comment, main = _is_furniture(name, token.group(3), articles > 0)
        # A page's own header or footer goes; so does one inside the article.
        firm, article = name in DROPPED or comment, name in ("article", "main") or main
        drops = int(firm or furniture)
        if article and not drops and dropped and not hard:
            drops = -dropped  # an article inside a block that only looks like furniture is read all the same
        open_.append((name, drops, article, firm))
        dropped += drops
        articles += article
        hard += firm
    flush()
    return out


def candidates(page: str | None) -> list[tuple[str, bool]]:
    """(line, protected): the lines that compete, of the article where a page marks one."""
    found = lines(page)
    if any(inside for _, inside, _ in found):
        return [(text, prose) for text, inside, prose in found if inside]
    return [(text, False) for text, _, _ in found]


def line_mark(line: str) -> int:
    return int.from_bytes(hashlib.blake2b(line.encode(), digest_size=8).digest(), "little", signed=True)


def common_lines(mine: list[int], other: list[int]) -> list[bool]:
    """For each of my lines, whether it is in the longest common subsequence with the other's.

    Bit-parallel over the other's lines, one big integer a line of mine.  Lines
    that only one side has are left out first.  Of the integers only every
    ``block``-th is kept, and the others of a block are worked out again on the
    way back, so n lines against m hold about ``2 * sqrt(n) * m`` bits.
    """
    own, shared = set(mine), [False] * len(mine)
    columns = [mark for mark in other if mark in own]
    where: dict[int, list[int]] = {}
    for j, mark in enumerate(columns):
        where.setdefault(mark, []).append(j)
    places = [i for i, mark in enumerate(mine) if mark in where]
    often = {mark: _bits(at) for mark, at in where.items() if len(at) > OFTEN}
    full = (1 << len(columns)) - 1

    def mask(mark: int) -> int:
        return often[mark] if mark in often else _bits(where[mark])

    def step(row: int, k: int) -> int:
        hit = row & mask(mine[places[k]])
        return ((row + hit) | (row - hit)) & full

    block = max(1, math.isqrt(len(places)))
    row, kept = full, []
    for k in range(len(places)):
        if k % block == 0:
            kept.append(row)
        row = step(row, k)
    # A zero bit j after line k: the subsequence grows at column j.  Walk back from the end.
    j = len(columns)
    for start in range(block * (len(kept) - 1), -1, -block):
        rows = [kept.pop()]
        for k in range(start, min(start + block, len(places))):
            rows.append(step(rows[-1], k))
        for k in range(start + len(rows) - 2, start - 1, -1):
            before, after = rows[k - start], rows[k - start + 1]
            below = (1 << j) - 1
            grown = (~after & below).bit_count()
            if (~before & below).bit_count() < grown:
                shared[places[k]] = True
                at = mask(mine[places[k]])
                j = (at & below).bit_length() - 1
                # The match is at the largest column of mine where the count still drops.
                while j >= 0 and (~before & ((1 << j) - 1)).bit_count() + 1 < grown:
                    j = (at & ((1 << j) - 1)).bit_length() - 1
    return shared


def _bits(at: list[int]) -> int:
    """An integer with the bits ``at`` (ascending) set."""
    if len(at) <= OFTEN:
        out = 0
        for j in at:
            out |= 1 << j
        return out
    octets = bytearray(at[-1] // 8 + 1)
    for j in at:
        octets[j >> 3] |= 1 << (j & 7)
    return int.from_bytes(octets, "little")


def without_shared(found: list[tuple[str, bool]], partner: list[int] | None) -> str:
    """The text of candidate lines (line, protected), given the line marks of the nearest page."""
    if partner and any(not protected for _, protected in found):
        shared = common_lines([line_mark(text) for text, _ in found], partner)
        gone = [s and not p for s, (_, p) in zip(shared, found)]
        total = sum(len(text) for text, _ in found)
        if 2 * sum(len(text) for (text, _), g in zip(found, gone) if g) > total:
            gone = [g and not re.search(r"[.!?…][\"'”»)]*$", text) for (text, _), g in zip(found, gone)]
        found = [line for line, g in zip(found, gone) if not g]
    return "\n\n".join(text for text, _ in found)


def main_text(page: str | None, partner: list[int] | None) -> str:
    """The text of a page whose nearest page has the line marks ``partner``."""
    return without_shared(candidates(page), partner)


# ------------------------------------------------------------------- operators


def neighbours(pages: DataFrame) -> DataFrame:
    """(key, near): for each ``key`` the key of the page of its host that is nearest by path.

    ``pages`` has host, path, key (unique).  A page alone on its host has no row.
    """
    ranged = pages.select("host", "path", "key").repartitionByRange("host", "path", "key")
    held = stage(ranged.select(F.spark_partition_id().alias("part"), "*"), "html-order")
    here = F.struct("host", "path", "key")
    within = W.partitionBy("part").orderBy("host", "path", "key")
    placed = held.select(
        "part", "host", "path", "key", F.lag(here).over(within).alias("before"), F.lead(here).over(within).alias("after")
    )
    # One row per partition: its first and last page, and those of the partitions beside it.
    ends = held.groupBy("part").agg(F.min(here).alias("first"), F.max(here).alias("last"))
    beside = W.orderBy("part")
    ends = stage(ends.select("part", F.lag("last").over(beside).alias("prev"), F.lead("first").over(beside).alias("next")), "html-ends")
    met = placed.join(ends, "part").select(
        "host", "path", "key", F.coalesce("before", "prev").alias("before"), F.coalesce("after", "next").alias("after")
    )
    same = lambda other: F.col(f"{other}.host") == F.col("host")
    common = lambda other: F.when(same(other), _common_length(F.col("path"), F.col(f"{other}.path")))
    chosen = met.select("key", "before", "after", common("before").alias("b"), common("after").alias("a"))
    near = F.when(F.col("b").isNull() | (F.col("a") > F.col("b")), F.when(F.col("a").isNotNull(), F.col("after.key"))).otherwise(
        F.col("before.key")
    )
    return chosen.select("key", near.alias("near")).where("near is not null")


def _common_length(a, b):
    """Length of the common beginning of two paths, by halving the length in question."""
    low, high = F.lit(0), F.least(F.length(a), F.length(b))
    steps = F.sequence(F.lit(1), F.lit(24))

    def halve(s, _):
        mid = F.floor((s["low"] + s["high"] + 1) / 2).cast("int")
        same = F.substring(a, F.lit(1), mid) == F.substring(b, F.lit(1), mid)
        return F.struct(F.when(same, mid).otherwise(s["low"]).alias("low"), F.when(same, s["high"]).otherwise(mid - 1).alias("high"))

    return F.aggregate(steps, F.struct(low.cast("int").alias("low"), high.cast("int").alias("high")), halve)["low"]


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of every page.

    Pages are read and cut into lines once.  A page all of whose lines are
    protected is settled there; the others wait, as lines, for the marks of their
    partner, so that no markup is written or shuffled.
    """
    keyed = pages.select(
        F.monotonically_increasing_id().alias("key"),
        "page_id",
        "url",
        F.coalesce(host_of(F.col("url")), F.lit("")).alias("host"),
        F.coalesce(path_of(F.col("url")), F.lit("")).alias("path"),
        "html",
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch):
                found = [candidates(p) for p in part.column(5).to_pylist()]
                waits = [any(not protected for _, protected in f) for f in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns[:5],
                        pa.array([None if w else without_shared(f, None) for f, w in zip(found, waits)], pa.string()),
                        pa.array([[{"line": t, "kept": k} for t, k in f] if w else None for f, w in zip(found, waits)], LINES),
                        pa.array([[line_mark(t) for t, _ in f] for f in found], pa.list_(pa.int64())),
                    ],
                    ["key", "page_id", "url", "host", "path", "text", "lines", "marks"],
                )

    ship(pages.sparkSession)
    kind = pages.schema["page_id"].dataType.simpleString()
    schema = f"key long, page_id {kind}, url string, host string, path string, text string, lines array<struct<line:string,kept:boolean>>, marks array<long>"
    held = stage(keyed.mapInArrow(cut, schema), "html-lines")
    waiting = held.where("text is null").select("key", "page_id", "url", "lines")
    near = neighbours(held).join(waiting.select("key"), "key", "left_semi")
    marks = near.join(held.select(F.col("key").alias("near"), "marks"), "near").select("key", "marks")
    met = waiting.join(marks, "key", "left").select("page_id", "url", "lines", "marks")

    def delete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch):
                texts = [
                    without_shared([(x["line"], x["kept"]) for x in found], marks)
                    for found, marks in zip(part.column(2).to_pylist(), part.column(3).to_pylist())
                ]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    differed = met.mapInArrow(delete, f"page_id {kind}, url string, text string")
    return held.where("text is not null").select("page_id", "url", "text").union(differed)
