"""Main text of web pages: markup first, then repeated stretches per host for boilerplate.

Markup tells the article and the furniture (menus, footers, adverts, forms, comments). What stands outside
both is open. The token streams of whole pages, inside and outside the article, are cut into suffixes, grouped by
a hash of the host and of their first LONG tokens. A group that spans different pages marks a repeated long
substring on each of them, and markup settles how far it must spread to be boilerplate: in an open block
to another page, in an article to four different ones and half of the host's. Covered tokens go, unique runs stay.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import broadcast_up_to, row_key
from plumbline.llm.portions import portions
from plumbline.session import cut_lineage

#: Tokens of a long substring.
LONG = 8
#: Rows of repeated substrings that are broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 1_000_000
#: Boilerplate of an article stands on so many different pages, and on one of so many pages of the host.
SPREAD = 4
ONE_OF = 2
#: An article that is covered by more than so many quarters is a copy, which stays whole.
COPIED_QUARTERS = 3
#: Characters and pages whose repeats a task counts at a time.
COUNTED_CHARS = 32_000_000
COUNTED_ROWS = 10_000

#: How HTML's elements behave.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math select canvas object".split())
BREAKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre search section summary table tbody tfoot thead tr ul".split()
)
FURNITURE = frozenset("nav aside form footer menu dialog button search".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
#: Words in class or id that mark menus, headers, footers, sidebars, notices, adverts, forms and comments.
FURNITURE_NAMES = frozenset(
    "ad ads adbox advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus "
    "footer form gdpr header login masthead menu modal nav navbar navigation newsletter notice notices notification pager pagination popup "
    "promo promoted promotion recommended related replies reply responses share sharing sidebar signup skip social sponsor sponsored subscribe "
    "subscription toolbar widget".split()
)
ARTICLE, OPEN, FURNISHED = 0, 1, 2

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(>|\Z)", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
NAME = re.compile(r"[a-z]+")


def is_furniture(name: str, attributes: str, inside: bool) -> bool:
    """Whether an element is no part of an article. The header of an article holds its title."""
    if name in FURNITURE or (name == "header" and not inside):
        return True
    if "=" in attributes and name not in ("html", "body", "article", "main"):
        for key, value in ATTRIBUTE.findall(attributes):
            found = set(NAME.findall(value.lower()))
            if found & (ROLES if key.lower() == "role" else FURNITURE_NAMES) and not (inside and found == {"header"}):
                return True
    return False


def blocks(page: str) -> list[tuple[str, int]]:
    """The blocks of a page in order, as (text, ARTICLE | OPEN | FURNISHED)."""
    found: list[tuple[str, int]] = []
    held: list[str] = []
    stack: list[tuple[str, int]] = []
    furniture = article = 0
    at, end = 0, len(page)

    def close() -> None:
        if held:
            text = " ".join(entities.unescape("".join(held)).split())
            held.clear()
            if text:
                found.append((text, FURNISHED if furniture else ARTICLE if article else OPEN))

    def pop() -> None:
        nonlocal furniture, article
        _, kind = stack.pop()
        furniture -= kind == FURNISHED
        article -= kind == ARTICLE

    while at < end:
        m = TAG.search(page, at)
        if m is None:
            held.append(page[at:])
            break
        held.append(page[at : m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if name in BREAKS:
            close()
        elif name in ("br", "td", "th", "img", "option"):
            held.append(" ")
        if m[1]:
            if any(n == name for n, _ in stack):
                close() if name in ("article", "main") else None
                while stack[-1][0] != name:
                    pop()
                if stack[-1][1] == FURNISHED:
                    close()
                pop()
            continue
        if name in RAW and not m[3].endswith("/"):
            stop = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = stop.end() if stop else end
            continue
        if name in VOID or m[3].endswith("/"):
            continue
        if name in BREAKS and any(n == "p" for n, _ in stack[-3:]):
            while stack[-1][0] != "p":
                pop()
            pop()
        if name == "li" and stack and stack[-1][0] == "li":
            pop()
        kind = FURNISHED if is_furniture(name, m[3], article > 0) else ARTICLE if name in ("article", "main") else OPEN
        if kind == FURNISHED:
            close()
        stack.append((name, kind))
        furniture += kind == FURNISHED
        article += kind == ARTICLE
    close()
    return found


def host_of(url: str | None) -> str:
    """The host of an address, lower case; empty if there is none."""
    m = re.match(r"(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", (url or "").strip(), re.I)
    return m[1].lower() if m else ""


def prefixes(host: str, row: list[tuple[str, int]], article: bool = False) -> np.ndarray:
    """The suffixes of the token stream outside the article, or of the one inside it, as hashes of the host and
    their first LONG tokens; a shorter stream is one suffix. None without a host."""
    tokens = [t for text, kind in row if (kind == ARTICLE) == article for t in text.split(" ")] if host else []
    if len(tokens) < LONG:
        return np.array([xxhash.xxh3_64_intdigest(f"{host}\n{' '.join(tokens)}") >> 1] if tokens else [], dtype=np.int64)
    hashed = np.array([xxhash.xxh3_64_intdigest(t) for t in tokens], dtype=np.uint64)
    size = len(hashed) - LONG + 1
    mixed = np.full(size, xxhash.xxh3_64_intdigest(host), dtype=np.uint64)
    for k in range(LONG):
        mixed = (mixed ^ (mixed >> np.uint64(29)) ^ hashed[k : size + k]) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(1)).astype(np.int64)


def spread_here(sites: list[int], held: list[np.ndarray]) -> tuple[list[int | None], list[list[dict] | None]]:
    """Of some pages the number of the site's, and the prefixes on at least one of ONE_OF of them with their numbers of
    pages; both at the first page of a site. What spreads that far over all pages does so over some portion of them."""
    _, first, own, sizes = np.unique(np.array(sites, dtype=np.int64), return_index=True, return_inverse=True, return_counts=True)
    values, at, n = np.unique(np.concatenate(held), return_index=True, return_counts=True)
    holder = np.repeat(own, [len(h) for h in held])[at]
    wide = n * ONE_OF >= sizes[holder]
    pages, found = [None] * len(sites), [None] * len(sites)
    for k, size in zip(first.tolist(), sizes.tolist(), strict=True):
        pages[k], found[k] = size, []
    for value, k, count in zip(values[wide].tolist(), first[holder[wide]].tolist(), n[wide].tolist(), strict=True):
        found[k].append({"prefix": value, "n": count})
    return pages, found


def listed(row: list[tuple[str, int]]) -> list[dict]:
    """What ``compose`` needs of a page: of furniture only the number of tokens."""
    return [{"text": None if kind == FURNISHED else text, "kind": kind, "size": text.count(" ") + 1} for text, kind in row]


def open_blocks(row: list[tuple[str, int]]) -> list[dict] | None:
    """The blocks of a page with open ones."""
    return listed(row) if any(kind == OPEN for _, kind in row) else None


def keyed(pages: DataFrame) -> DataFrame:
    """page_id, url, html, and a key that names a row by all of them."""
    place = F.concat_ws(" ", F.coalesce(F.col("page_id").cast("string"), F.lit("null")), F.coalesce("url", F.lit("null")))
    return pages.select("page_id", "url", "html", row_key(place, F.col("html")).alias("key"))


def parsed_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, key (names the row), page (a hash of the whole text), site (of the host), the prefixes of its
    suffixes outside the article, what ``spread_here`` finds in both streams, and the blocks of those pages
    that have open ones; the texts of the others stay where they are."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in frames:
            for start, end in portions(whole["html"].fillna("").tolist(), COUNTED_CHARS, COUNTED_ROWS):
                frame = whole.iloc[start:end]
                cut = [blocks(h or "") for h in frame["html"]]
                hosts = [host_of(u) for u in frame["url"]]
                outside = [prefixes(host, row) for host, row in zip(hosts, cut, strict=True)]
                sites = [xxhash.xxh3_64_intdigest(host) >> 1 for host in hosts]
                held = [np.union1d(o, prefixes(host, row, True)) for o, host, row in zip(outside, hosts, cut, strict=True)]
                site_pages, spread = spread_here(sites, held)
                yield pd.DataFrame(
                    {
                        "page_id": frame["page_id"].to_numpy(),
                        "url": frame["url"].to_numpy(),
                        "key": frame["key"].to_numpy(),
                        "page": [page_hash(row) for row in cut],
                        "site": sites,
                        "prefixes": outside,
                        "site_pages": pd.array(site_pages, dtype="Int64"),
                        "spread": spread,
                        "blocks": [open_blocks(row) for row in cut],
                    }
                )

    kind = pages.schema["page_id"].dataType.simpleString()
    schema = f"page_id {kind}, url string, key binary, page long, site long, prefixes array<long>, "
    schema += "site_pages long, spread array<struct<prefix:long,n:long>>, blocks array<struct<text:string,kind:int,size:int>>"
    return cut_lineage(keyed(pages).mapInPandas(run, schema))


def page_hash(row: list[tuple[str, int]]) -> int:
    """Names the whole text of a page."""
    return xxhash.xxh3_64_intdigest("\n".join(t for t, _ in row)) >> 1


def articles(pages: DataFrame) -> DataFrame:
    """key, page, at, prefix of each suffix inside an article; ``new`` where the page holds the prefix first, and nowhere outside."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            cut = [(host_of(u), blocks(h or "")) for u, h in zip(frame["url"], frame["html"], strict=True)]
            inside = [prefixes(host, row, True) for host, row in cut]
            new = []
            for (host, row), found in zip(cut, inside, strict=True):
                first = np.zeros(len(found), dtype=bool)
                first[np.unique(found, return_index=True)[1]] = True
                new.append(first & ~np.isin(found, prefixes(host, row)))
            yield pd.DataFrame({"key": frame["key"], "page": [page_hash(row) for _, row in cut], "prefix": inside, "new": new})

    given = keyed(pages).mapInPandas(run, "key binary, page long, prefix array<long>, new array<boolean>")
    return given.select("key", "page", F.posexplode(F.arrays_zip("prefix", "new")).alias("at", "one")).select("key", "page", "at", "one.prefix", "one.new")


def far_spread(parsed: DataFrame) -> DataFrame:
    """(prefix, wide): the prefixes that may be boilerplate of articles, few, and on how many of the host's pages one then stands.

    A portion that does not list a prefix holds it on fewer than one of ONE_OF of the site's pages. That bounds what all portions hold.
    """
    unlisted = F.ceil(F.col("site_pages") / ONE_OF) - 1
    given = parsed.where("site_pages IS NOT NULL").select("site", "site_pages", unlisted.alias("unlisted"), "spread")
    sites = given.groupBy("site").agg(F.sum("site_pages").alias("site_pages"), F.sum("unlisted").alias("most_unlisted"))
    wide = F.greatest(F.lit(SPREAD), F.ceil(F.col("site_pages") / ONE_OF)).alias("wide")
    sites = cut_lineage(sites.select("site", "most_unlisted", wide))
    listed_here = given.select("site", "unlisted", F.inline("spread")).groupBy("site", "prefix")
    bounds = listed_here.agg(F.sum("n").alias("n"), F.sum("unlisted").alias("unlisted")).join(sites, "site")
    return cut_lineage(bounds.where(F.col("n") + F.col("most_unlisted") - F.col("unlisted") >= F.col("wide")).select("prefix", "wide"))


def open_spans(parsed: DataFrame) -> DataFrame:
    """(prefix, repeated): the prefixes outside articles on pages with open blocks, and whether different pages hold them there."""
    spans = parsed.select("page", F.col("blocks").isNotNull().alias("open"), F.explode("prefixes").alias("prefix")).groupBy("prefix")
    spans = spans.agg((F.min("page") != F.max("page")).alias("repeated"), F.max("open").alias("open"))
    return cut_lineage(spans.where("open").select("prefix", "repeated"))


def article_places(pages: DataFrame, possible: DataFrame, spans: DataFrame) -> DataFrame:
    """Where the articles hold prefixes of either table, as ``articles``; without any, no page is read."""
    sought = cut_lineage(possible.select("prefix").unionByName(spans.select("prefix")).distinct())
    read = pages.limit(0) if sought.isEmpty() else pages
    return cut_lineage(articles(read).join(broadcast_up_to(sought, BROADCAST_ROWS), "prefix"))


def covered_inside(parsed: DataFrame, possible: DataFrame, places: DataFrame) -> DataFrame:
    """(key, inside): where boilerplate of the host starts in the article of a page, counted exactly and on either side of articles."""
    held = places.join(broadcast_up_to(possible, BROADCAST_ROWS), "prefix")
    wanted = broadcast_up_to(cut_lineage(held.select("prefix", "wide").distinct()), BROADCAST_ROWS)
    outside = parsed.select("page", F.explode(F.array_distinct("prefixes")).alias("prefix")).join(wanted, "prefix")
    both = outside.select("prefix", "wide", "page").unionByName(held.where("new").select("prefix", "wide", "page"))
    per_page = both.groupBy("prefix", "wide", "page").agg(F.count(F.lit(1)).alias("n"))
    counted = per_page.groupBy("prefix", "wide").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("pages"))
    common = cut_lineage(counted.where((F.col("n") >= F.col("wide")) & (F.col("pages") >= SPREAD)).select("prefix"))
    covered = places.join(broadcast_up_to(common, BROADCAST_ROWS), "prefix").groupBy("key")
    return cut_lineage(covered.agg(F.sort_array(F.collect_set("at")).alias("inside")))


def covered_places(parsed: DataFrame, spans: DataFrame, places: DataFrame) -> DataFrame:
    """(key, places, quoted): where a repeated long substring of the host starts on a page with open blocks:
    one that repeats outside articles, and one that stands in the article of another page.

    Pages with the same text, article included, count as one page.
    """
    held = places.groupBy("prefix").agg(F.min("page").alias("low"), F.max("page").alias("high"))
    known = cut_lineage(spans.join(held, "prefix", "left").where("repeated OR low IS NOT NULL"))
    at = parsed.where("blocks IS NOT NULL").select("key", "page", F.posexplode("prefixes").alias("at", "prefix"))
    found = at.join(broadcast_up_to(known, BROADCAST_ROWS), "prefix")
    quoted = F.when((F.col("low") != F.col("page")) | (F.col("high") != F.col("page")), F.col("at"))
    return found.groupBy("key").agg(
        F.sort_array(F.collect_set(F.when(F.col("repeated"), F.col("at")))).alias("places"), F.sort_array(F.collect_set(quoted)).alias("quoted")
    )


def covered(total: int, places: np.ndarray) -> np.ndarray:
    """Which of so many tokens are in a long substring that starts at one of the places."""
    marks = np.zeros(total + LONG + 1, dtype=np.int32)
    np.add.at(marks, places, 1)
    np.add.at(marks, places + LONG, -1)
    return np.cumsum(marks)[:total] > 0


def compose(row: list, places: np.ndarray, quoted: np.ndarray, inside: np.ndarray) -> str:
    """The text of a page: article and open blocks without covered tokens. An article that is mostly covered
    stays whole, and what other articles hold stays if the page has nothing else."""
    total = sum(b["size"] for b in row if b["kind"] != ARTICLE)
    own = covered(sum(b["size"] for b in row if b["kind"] == ARTICLE), inside)
    if 4 * own.sum() > COPIED_QUARTERS * len(own):
        own[:] = False

    def left(gone: np.ndarray) -> str:
        kept, at = [], {ARTICLE: 0, OPEN: 0}
        for b in row:
            stream = ARTICLE if b["kind"] == ARTICLE else OPEN
            if b["kind"] != FURNISHED:
                here = (own if stream == ARTICLE else gone)[at[stream] : at[stream] + b["size"]]
                text = " ".join(t for t, out in zip(b["text"].split(" "), here, strict=True) if not out) if here.any() else b["text"]
                if text:
                    kept.append(text)
            at[stream] += b["size"]
        return "\n\n".join(kept)

    return left(covered(total, np.union1d(places, quoted))) or left(covered(total, places))


def main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of each row.

    One row per input row, repeated rows included. Character references are decoded, white
    space inside a block is one space, blocks are joined by an empty line in page order. NULL
    and empty html have an empty text; pages without a host are judged by markup alone.
    Markup that ends early counts as far as it goes. Other columns are ignored. ``pages`` is read
    several times: pages without open blocks are parsed again, so that their texts are not shuffled.
    """
    parsed = parsed_pages(pages)
    kind = pages.schema["page_id"].dataType.simpleString()
    schema = f"page_id {kind}, url string, text string, n_chars long"
    possible, spans = far_spread(parsed), open_spans(parsed)
    places = article_places(pages, possible, spans)
    inside = broadcast_up_to(covered_inside(parsed, possible, places), BROADCAST_ROWS // 10)

    def starts(places) -> np.ndarray:
        return np.asarray([] if places is None else places, dtype=np.int64)

    def decided(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            cut = [blocks(h or "") for h in frame["html"]]
            alone = [not any(kind == OPEN for _, kind in row) for row in cut]
            texts = [compose(listed(row), starts(None), starts(None), starts(at)) for row, at, own in zip(cut, frame["inside"], alone, strict=True) if own]
            rows = frame.loc[alone, ["page_id", "url"]]
            yield rows.assign(text=pd.Series(texts, index=rows.index, dtype=object), n_chars=[len(t) for t in texts])

    def searched(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            given = zip(frame["blocks"], frame["places"], frame["quoted"], frame["inside"], strict=True)
            texts = [compose(row, *map(starts, found)) for row, *found in given]
            yield pd.DataFrame(
                {"page_id": frame["page_id"], "url": frame["url"], "text": texts, "n_chars": [len(t) for t in texts]}
            )

    joined = parsed.where("blocks IS NOT NULL").join(covered_places(parsed, spans, places), "key", "left").join(inside, "key", "left")
    open_pages = joined.select("page_id", "url", "blocks", "places", "quoted", "inside").mapInPandas(searched, schema)
    others = keyed(pages).join(inside, "key", "left").select("page_id", "url", "html", "inside")
    return others.mapInPandas(decided, schema).unionByName(open_pages)
