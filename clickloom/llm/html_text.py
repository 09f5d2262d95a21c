"""Main text of web pages: site templates are found by counting element subtrees per host."""

from __future__ import annotations

import re
from functools import lru_cache
from html import unescape

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import checkpointed, map_columns

#: Fixed values of HTML: elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Fixed values of HTML: elements whose content is no text of the page.
HIDDEN = frozenset("script style noscript template svg math iframe object canvas audio video head title select textarea button datalist dialog".split())
#: Elements around the main text.
CHROME = frozenset("nav footer aside form menu search".split())
#: Fixed values of HTML: elements that start and end a block of text.
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Fixed values of HTML: an open element on the left is closed by a start tag on the right.
CLOSED_BY = {
    "p": BLOCK - {"body", "html", "caption", "dd", "dt", "li", "option", "tbody", "td", "tfoot", "th", "thead", "tr"},
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "option": frozenset(["option", "optgroup"]),
    "tr": frozenset(["tr", "tbody", "tfoot", "thead"]),
    "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
}
#: Words of a class or id that mark what is no main text.
MARKED = frozenset(
    "ad ads adsbygoogle advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist cookie cookies consent disclaimer "
    "disqus footer gdpr masthead menu modal nav navbar navigation newsletter notice notices pagination pager popup promo promoted "
    "related replies reply respond share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar topbar widget widgets".split()
)
#: Words that may stand beside those in a compound name such as site-footer or cookie_bar.
BESIDE = frozenset(
    "area articles bar block bottom box button buttons container content form global group header inner item items js left legal link links list main outer page "
    "panel post posts primary reader right row secondary section site slot stories thread top unit user wrap wrapper".split()
)
#: Words of a name that, with "header", name the header of the site and not that of a text.
SITE = frozenset("global header main page site top".split())
#: The marks of an article element that is a comment or an advert.
ASIDE = frozenset("ad ads advert advertisement comment comments promo promoted replies reply sponsored".split())
#: Fixed values of ARIA: roles of what is no main text.
ROLES = frozenset("alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())

#: Blocks that are pieces of a text, which an article may share with others of its site.
PARTS = frozenset("blockquote caption dd dt figcaption h1 h2 h3 h4 h5 h6 hgroup hr li optgroup option p pre tbody td tfoot th thead tr".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>script|style|textarea|title|noscript|template|svg|iframe)\b[^>]*+>.*?(?:</(?P=raw)\s*+>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|</?[a-zA-Z][^>]*+(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)",
    re.S | re.I,
)
_NAMED = re.compile(r"(?<![^\s\"'])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|(?=[\s/]|$))", re.I)
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_SPACE = re.compile(r"\s+")
_PARTS = re.compile(r"[-_]+|(?<=[a-z])(?=[A-Z])")
_NUMBER = re.compile(r"[0-9]+(?:x[0-9]+)?")
ARTICLE = frozenset(["article", "main"])


class Page:
    """A page as a list of events in page order: text, or the number of an element that starts (n) or ends (-n).

    Elements are numbered from 1, the page itself being 1. Lists by number: tags, attrs (the named ones), ends (place of the end in events),
    holds (whether an article or main element stands in it or is it).
    """

    __slots__ = ("attrs", "ends", "events", "holds", "tags")

    def __init__(self) -> None:
        self.events: list = [1]
        self.tags, self.attrs, self.ends, self.holds = ["", "html"], [(), ()], [0, 0], [False, False]


def parse(html: str) -> Page:
    """Elements and text of a page. Broken markup never fails: unknown ends are passed over, open elements end at the end.

    Elements may be nested to any depth; nothing here or below is recursive, and the work is linear in the page.
    """
    page = Page()
    events, tags, holds = page.events, page.tags, page.holds
    stack, blocks, opened, at = [1], [0], {}, 0  # blocks: places of block elements in the stack

    def close(to: int) -> None:
        while len(stack) > to:
            n = stack.pop()
            opened[tags[n]] -= 1
            page.ends[n] = len(events)
            events.append(-n)
        while blocks[-1] >= to > 0:
            blocks.pop()

    for m in _TOKEN.finditer(html):
        if m.start() > at:
            events.append(unescape(html[at : m.start()]))
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if m["end"]:
            if opened.get(tag):
                i = len(stack) - 1
                while tags[stack[i]] != tag:
                    i -= 1
                close(i)
            continue
        while len(stack) > 1 and tag in CLOSED_BY.get(tags[stack[-1]], ()):
            close(len(stack) - 1)
        if tag in BLOCK and blocks[-1] and tag in CLOSED_BY.get(tags[stack[blocks[-1]]], ()):
            close(blocks[-1])  # inline elements left open inside a paragraph end with it
        attrs, n = m["attrs"], len(tags)
        tags.append(tag)
        page.attrs.append(tuple((k.lower(), a or b or c) for k, a, b, c in _NAMED.findall(attrs)) if attrs and not attrs.isspace() else ())
        holds.append(tag in ARTICLE)
        page.ends.append(len(events) + 1)
        events.append(n)
        if tag in VOID or attrs.endswith("/"):
            events.append(-n)
            continue
        if tag in ARTICLE:
            for outer in reversed(stack):
                if holds[outer]:
                    break
                holds[outer] = True
        if tag in BLOCK:
            blocks.append(len(stack))
        stack.append(n)
        opened[tag] = opened.get(tag, 0) + 1
    if at < len(html):
        events.append(unescape(html[at:]))
    opened["html"] = opened.get("html", 0) + 1
    close(0)
    return page


@lru_cache(100_000)
def parts_of(name: str) -> tuple[str, ...]:
    """The words of a class or id name, without numbers and sizes."""
    return tuple(p for p in (_NUMBER.sub("", x).lower() for x in _PARTS.split(name)) if p)


def is_marked(name: str, words: frozenset[str] = MARKED) -> bool:
    """Whether a class or id name is one of ``words``, or made only of them, numbers and words that stand beside them."""
    parts = parts_of(name)
    return any(p in words for p in parts) and all(p in words or p in BESIDE for p in parts)


def is_site_header(name: str) -> bool:
    parts = parts_of(name)
    return "header" in parts and all(p in SITE for p in parts)


def frames(page: Page) -> dict[int, int]:
    """For each element with a name that has a marked word beside unknown ones: a hash of its way from the page's root.

    The way has tags, classes and ids without numbers, and no text: a box that stands in the same place of a host's
    pages has the same one, whatever it says. Such elements go where it recurs (``templates``); a name that is marked
    as a whole needs no count. Elements around an article, and pieces of a text in one, are never such.
    """
    found: dict[int, int] = {}
    way: list[int] = []
    inside = 0
    for e in page.events:
        if isinstance(e, str):
            continue
        n, tag = abs(e), page.tags[abs(e)]
        inside += 0 if tag not in ARTICLE else 1 if e > 0 else -1
        if e < 0:
            way.pop()
            continue
        way.append(n)
        if page.holds[n] or tag == "body" or inside and tag in PARTS:
            continue
        names = [x for key, value in page.attrs[n] if key in ("class", "id") for x in value.split()]
        if any(p in MARKED for x in names for p in parts_of(x)):
            step = lambda m: (page.tags[m], [(k, [parts_of(x) for x in v.split()]) for k, v in page.attrs[m] if k in ("class", "id")])
            found[n] = xxhash.xxh64_intdigest(repr([step(m) for m in way]).encode(), 1) - (1 << 63)
    return found


def is_chrome(page: Page, n: int, inside: bool) -> bool:
    """Whether tag, attributes or role say that element ``n`` is no main text; ``inside``: within article or main.

    Class and id names count as a whole, and never on an element around an article or main element.
    """
    tag = page.tags[n]
    if tag in HIDDEN:
        return True
    for key, value in page.attrs[n]:
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and _UNSEEN.search(value):
            return True
    if tag == "article":
        return any(key in ("class", "id") and any(is_marked(x, ASIDE) for x in value.split()) for key, value in page.attrs[n])
    if page.holds[n] or tag == "body":
        return False
    if tag in CHROME or tag == "header" and not inside:
        return True
    marked = lambda x: is_marked(x) or not inside and is_site_header(x)
    return any(value.strip().lower() in ROLES if key == "role" else key in ("class", "id") and any(map(marked, value.split())) for key, value in page.attrs[n])


def is_candidate(page: Page, n: int, inside: bool) -> bool:
    """Whether an element may be a site's template: any block, but within article or main no paragraph or part of a list or table."""
    tag = page.tags[n]
    return tag in BLOCK and tag != "body" and n > 1 and (not inside or tag not in PARTS)


def subtree_hashes(page: Page) -> tuple[int, dict[int, int]]:
    """(whole, found): a hash of the page's article and main elements, or of all of it where they have no text, and
    the hash of each element with text that may be a template. None of them holds an article or main element.
    """
    found: dict[int, int] = {}
    articles: list[bytes] = []
    stack: list[list[bytes]] = []
    inside, raw = 0, b""
    for e in page.events:
        if isinstance(e, str):
            if text := e.strip():
                stack[-1].append(text.encode())
        elif e > 0:
            stack.append([page.tags[e].encode(), repr(page.attrs[e]).encode()])
            inside += page.tags[e] in ARTICLE
        else:
            body, own = stack.pop(), page.tags[-e] in ARTICLE
            inside -= own
            if len(body) > 2:
                digest = xxhash.xxh64_intdigest(b"\x00".join(body)) - (1 << 63)
                raw = digest.to_bytes(8, "little", signed=True)
                if stack:
                    stack[-1].append(raw)
                if own and not inside:
                    articles.append(raw)
                if not page.holds[-e] and is_candidate(page, -e, inside > 0):
                    found[-e] = digest
    return xxhash.xxh64_intdigest(b"".join(articles) or raw) - (1 << 63), found


def main_text(html: str | None, template: frozenset[int] | set[int] = frozenset(), marks: bool = True) -> str:
    """Text blocks of the article joined by blank lines; ``template``: hashes of subtrees to delete.

    The site's templates go first, anywhere on the page. Of what is left, what tags and attributes mark as no main
    text goes (``marks``; scripts, styles and other unseen content always). Where article or main elements are left,
    only the main text counts (``chosen``). White space inside a block, also of character references, becomes one
    space (br too); empty blocks go.
    """
    if not html:
        return ""
    page = parse(html)
    gone = {n for found in (subtree_hashes(page)[1], frames(page)) for n, h in found.items() if h in template} if template else ()
    blocks: list[tuple[int, str]] = []
    parts: list[str] = []
    inside = at = outer = 0
    only = False

    def flush() -> None:
        if parts:
            text = _SPACE.sub(" ", "".join(parts)).strip()
            parts.clear()
            if text:
                blocks.append((outer if inside else 0, text))

    while at < len(page.events):
        e = page.events[at]
        at += 1
        if isinstance(e, str):
            parts.append(e)
            continue
        tag = page.tags[abs(e)]
        if e > 0 and (e in gone or (is_chrome(page, e, inside > 0) if marks else tag in HIDDEN)):
            if tag in BLOCK:
                flush()
            at = page.ends[e] + 1
        elif tag == "br":
            parts.append(" ")
        elif tag in BLOCK:
            flush()
            if tag in ARTICLE:
                outer = e if e > 0 and not inside else outer
                inside += 1 if e > 0 else -1
                only = only or marks
    flush()
    return "\n\n".join(text for _, text in (chosen(page, blocks) if only else blocks))


def chosen(page: Page, blocks: list[tuple[int, str]]) -> list[tuple[int, str]]:
    """The blocks (outermost article or main element, text) of the main text.

    A main element counts alone. Of several articles the longest counts, and with it those at least a quarter as
    long (parts of one text); shorter ones are teasers of other pages.
    """
    size: dict[int, int] = {}
    for n, text in blocks:
        if n:
            size[n] = size.get(n, 0) + len(text)
    if mains := {n for n in size if page.tags[n] == "main"}:
        return [x for x in blocks if x[0] in mains]
    most = max(size.values(), default=0)
    return [x for x in blocks if x[0] and 4 * size[x[0]] >= most]


def with_host(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url, html) with the lower-case host of its url, empty without one."""
    host = F.regexp_extract(F.coalesce("url", F.lit("")), r"://([^/?#]*)", 1)
    return pages.select("page_id", "url", "html", F.lower(host).alias("host"))


def templates(pages: DataFrame, least_pages: int = 5, least_share: float = 0.1, middle: int = 10_000) -> DataFrame:
    """host, hashes: subtrees and frames that stand on at least ``least_pages`` pages and a share of a host's pages.

    Of a host's n pages the least number is least_share * n / sqrt(1 + n / middle): nearly the share itself on a small
    host, and growing as the square root of the pages on a very large one, where a part of the site is enough. Copies,
    by the hash of ``subtree_hashes``, are one page, which counts once for a subtree. Counting is a partial
    aggregation, so one host may hold any share of all pages. A host has at most (subtrees of a page / least_share)
    hashes, times sqrt(1 + n / middle).
    """

    def step(hosts: list, htmls: list) -> dict:
        pages = [parse(h) if h else None for h in htmls]
        found = [(0, {}) if p is None else subtree_hashes(p) for p in pages]
        boxes = [set() if p is None else set(frames(p).values()) for p in pages]
        return {"host": hosts, "page": [p for p, _ in found], "hashes": [sorted({*x.values(), *b}) for (_, x), b in zip(found, boxes)]}

    seen = map_columns(with_host(pages).select("host", "html"), step, "host string, page long, hashes array<long>")
    seen = seen.groupBy("host", "page").agg(F.min("hashes").alias("hashes"))
    # the page itself is counted under a null hash
    counts = seen.select("host", F.explode(F.array_append("hashes", F.lit(None).cast("long"))).alias("hash")).groupBy("host", "hash").agg(F.count("*").alias("n"))
    counts = checkpointed(counts)
    total = counts.where("hash is null").select("host", F.col("n").alias("pages"))
    least = least_share * F.col("pages") / F.sqrt(1 + F.col("pages") / middle)
    often = counts.where(F.col("hash").isNotNull() & (F.col("n") >= least_pages)).join(total, "host").where(F.col("n") >= least)
    return often.groupBy("host").agg(F.collect_set("hash").alias("hashes"))


def extract(pages: DataFrame, least_pages: int = 5, least_share: float = 0.1, most_broadcast: int = 1_000_000) -> DataFrame:
    """page_id, url, text of every row of ``pages`` (page_id, url, html).

    Null and empty pages give an empty text; repeated rows are repeated, and are one page in the counts; null urls
    and ids stay; an empty table gives no rows; other columns are not read. The templates are broadcast once while they
    hold at most ``most_broadcast`` hashes in all (16 MB); beyond that they are joined by host.
    """
    known = checkpointed(templates(pages, least_pages, least_share))
    size = known.agg(F.sum(F.size("hashes"))).first()[0] or 0
    if size <= most_broadcast:
        of = pages.sparkSession.sparkContext.broadcast({r.host: frozenset(r.hashes) for r in known.collect()})  # at most most_broadcast hashes

        def step(ids: list, urls: list, htmls: list, hosts: list) -> dict:
            return {"page_id": ids, "url": urls, "text": [main_text(x, of.value.get(h, frozenset())) for x, h in zip(htmls, hosts)]}

        return map_columns(with_host(pages), step, "page_id long, url string, text string")

    def joined_step(ids: list, urls: list, htmls: list, hosts: list, hashes: list) -> dict:
        sets: dict = {}  # pages of a host in a batch share one set
        return {"page_id": ids, "url": urls, "text": [main_text(x, sets.get(h) or sets.setdefault(h, frozenset(t or ()))) for x, h, t in zip(htmls, hosts, hashes)]}

    return map_columns(with_host(pages).join(known, "host", "left").select("page_id", "url", "html", "host", "hashes"), joined_step, "page_id long, url string, text string")
