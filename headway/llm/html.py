"""Main text of pages by equivalence-class template deduction."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import per_row, shards, texts_of, unused
from headway.llm.urls import host_of
from headway.session import staged

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^"'>]|"[^"]*"|'[^']*')*)>|</?[a-zA-Z][^>]*(?:>|\Z)""", re.DOTALL)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
NAME_WORD = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z]+")

# Elements by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template noscript iframe textarea title svg math object canvas audio video".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head "
    "header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul caption".split()
)
NOT_TEXT = frozenset("nav header footer aside form head button select menu dialog".split()) | RAW
CLOSES_P = BLOCK - {"body", "html", "head", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("table ul ol dl article section div main nav aside header footer form body td th blockquote select menu".split())
NOT_TEXT_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alertdialog alert".split())
# Words of class names and ids that mark what is not the article.
COMMENT_WORDS = frozenset("comment comments commentlist commenter reply replies respond disqus discussion".split())
NOT_TEXT_WORDS = frozenset(
    "ad ads adbox adslot adunit advert adverts advertisement advertising banner breadcrumb breadcrumbs consent cookie cookies cookiebar copyright "
    "disclaimer footer gdpr hidden login masthead menu modal nav navbar navigation newsletter notice notices notification notifications outbrain "
    "overlay pager pagination paywall popup promo promoted promotion recommended related sharing share sidebar sidenav signup sitefooter siteheader "
    "skip social sponsor sponsored subnav subscribe subscription taboola toc toolbar topnav widget widgets".split()
)
# Elements that divide a page, and those that hold running text.
FRAMES = frozenset("html body main article section div center td".split())
PARAGRAPHS = frozenset("p blockquote pre h1 h2".split())
# Words that say nothing of what a class or id is about.
NEUTRAL_WORDS = frozenset(
    "a an area bar block body bottom box button buttons center col column container content contents count desktop form group heading home "
    "icon icons inline inner item items js label large left link links list lists main mobile module my outer page panel post posts primary right "
    "row secondary section set site small story stories tag tags text the title titles top unit view wrap wrapper zone".split()
)
# How surely an element is not the article: by a class or id, which an article
# inside it outweighs, or by its element, role, or as reader comments.
MAYBE, SURELY = 1, 2
# Elements nested deeper become siblings of the innermost one, as in browsers.
DEEPEST = 512


class Open(NamedTuple):
    """An open element; ``path`` is a running hash of names and classes, ``base`` tells
    whether the block it belongs to is skipped."""

    name: str
    path: int
    skipped: int
    base: int
    article: bool
    main: bool
    holder: int


class Page(NamedTuple):
    """Blocks of text with their place, and template tokens in page order.

    A token is a tag with its path or a text with its path. ``holders`` has the token
    number of the dividing tag around a block (-1: none), ``elements`` the names of these
    tags and ``parents`` the number of the one around each, in page order.
    """

    tokens: list[int]
    texts: list[str]
    article: list[bool]
    main: list[bool]
    holders: list[int]
    text_tokens: list[int]
    elements: dict[int, str]
    parents: dict[int, int]


def _attributes(raw: str) -> dict[str, str]:
    return {m[0].lower(): html.unescape(m[1] or m[2] or m[3]) for m in ATTRIBUTE.findall(raw)} if raw.strip() else {}


def _not_text(name: str, attributes: dict[str, str], behind: bool) -> int:
    if name in NOT_TEXT or attributes.get("role", "").lower() in NOT_TEXT_ROLES:
        return SURELY
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true" or "display:none" in attributes.get("style", "").lower().replace(" ", ""):
        return SURELY
    if name in ("html", "body", "main"):
        return 0
    about = [_about(attributes[k]) for k in ("class", "id") if k in attributes]
    if any(a & COMMENT_WORDS for a in about):
        # Comments stand in an article or behind one; before that the name means the article that takes them.
        return SURELY if behind else 0 if name == "article" else MAYBE
    return MAYBE if name != "article" and any(about) else 0


def _about(names: str) -> set[str]:
    """Telling words of those classes (or ids) that consist of such and neutral words only:
    ``related-posts`` is about related matter, ``related-work`` is a chapter, ``has-comments`` a state."""
    found = set()
    for name in names.split():
        words = {w.lower() for w in NAME_WORD.findall(name)}
        telling = words & (NOT_TEXT_WORDS | COMMENT_WORDS)
        if telling and all(w in telling or w in NEUTRAL_WORDS or w[0].isdigit() or len(w) == 1 for w in words):
            found |= telling
    return found


def parse(markup: str) -> Page:
    """Tolerant reading: end tags close what they match, unclosed blocks end with what holds them."""
    page = Page([], [], [], [], [], [], {}, {})
    stack = [Open("", 0, 0, 0, False, False, -1)]
    buffer: list[str] = []
    article_seen = False

    def step(path: int, label: str) -> int:
        return xxhash.xxh64_intdigest(label, path)

    def read(text: str) -> None:
        # Skipped elements inside a line of text leave no text and do not end it.
        if not stack[-1].skipped or stack[-1].base:
            buffer.append(text)

    def flush() -> None:
        text = " ".join(html.unescape("".join(buffer)).split()) if buffer else ""
        buffer.clear()
        if text:
            top = stack[-1]
            token = len(page.tokens)
            page.tokens.append(step(top.path, f"|{text}"))
            if not top.base:
                page.texts.append(text)
                page.article.append(top.article)
                page.main.append(top.main)
                page.holders.append(top.holder)
                page.text_tokens.append(token)

    def close(depth: int) -> None:
        flush()
        del stack[depth:]

    at, end = 0, len(markup)
    while at < end:
        found = TAG.search(markup, at)
        if found is None:
            read(markup[at:])
            break
        if found.start() > at:
            read(markup[at : found.start()])
        at = found.end()
        name = (found.group(2) or "").lower()
        if not name:
            continue
        if found.group(1):
            if name in BLOCK:
                flush()
            if name == "br":
                buffer.append(" ")
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].name == name:
                    close(depth) if name in BLOCK or any(s.name in BLOCK for s in stack[depth:]) else stack.__delitem__(slice(depth, None))
                    break
                if name not in BLOCK and stack[depth].name in BLOCK:
                    break
            continue
        if name in BLOCK:
            flush()
            if name in CLOSES_P:
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth].name == "p":
                        del stack[depth:]
                        break
                    if stack[depth].name in SCOPES:
                        break
            for depth in range(len(stack) - 1, 0, -1) if name in SIBLINGS else ():
                if stack[depth].name in SIBLINGS[name]:
                    del stack[depth:]
                    break
                if stack[depth].name in SCOPES and stack[depth].name not in ("td", "th"):
                    break
        elif name == "br":
            buffer.append(" ")
        raw = found.group(3)
        attributes = _attributes(raw)
        top = stack[-1]
        if len(stack) > DEEPEST and name not in VOID:
            if top.name in BLOCK:
                flush()
            stack.pop()
            top = stack[-1]
        path = step(top.path, f">{name}" + (f".{attributes['class']}" if "class" in attributes else ""))
        number = len(page.tokens)
        page.tokens.append(path)
        if name in VOID or raw.endswith("/") and name in RAW:
            continue
        is_main = name == "main" or attributes.get("role", "").lower() == "main"
        outside = 0 if (name == "article" or is_main) and top.skipped == MAYBE and not top.article else top.skipped
        skipped = max(outside, _not_text(name, attributes, article_seen))
        if name in ("button", "select"):
            read(" ")
        if name in RAW:
            over = re.compile(rf"</{re.escape(name)}\s*[^>]*(?:>|\Z)", re.IGNORECASE).search(markup, at)
            at = over.end() if over else end
            continue
        if name in BLOCK:
            page.elements[number], page.parents[number] = name, top.holder
        article_seen |= name == "article" and not skipped
        stack.append(
            Open(
                name,
                path,
                skipped,
                skipped if name in BLOCK else top.base,
                top.article or name == "article" and not skipped,
                top.main or is_main and not skipped,
                number if name in BLOCK else top.holder,
            )
        )
    close(1)
    return page


def main_blocks(page: Page, template: frozenset[int]) -> list[str]:
    """Texts of the slots that hold the article.

    Texts of the template are never kept, in article elements neither, unless they
    make up half of a page's article and more: then pages are copies. The article
    is what stands in article elements, else in main elements, and beside it the
    fullest place of the template (``best_slot``), if that is all there is or holds
    over twice the article. Where nothing is known of the host, flags decide alone,
    else any dividing tag counts as the template's.
    """
    volume_of = [len(x) for x in page.texts]
    known = [page.tokens[token] in template for token in page.text_tokens]
    flags = next((f for f in (page.article, page.main) if any(f)), [False] * len(known))
    if 2 * sum(n for n, k, a in zip(volume_of, known, page.article, strict=True) if k and a) >= sum(n for n, a in zip(volume_of, page.article, strict=True) if a):
        known = [k and not a for k, a in zip(known, page.article, strict=True)]
    rest = [i for i, k in enumerate(known) if not k]
    marked = {i for i in rest if flags[i]}
    others = [i for i in rest if i not in marked]
    if not others or marked and not template:
        return [page.texts[i] for i in rest if i in marked]
    slot = best_slot(page, others, template)
    if marked and sum(volume_of[i] for i in slot) <= 2 * sum(volume_of[i] for i in marked):
        slot = set()
    return [page.texts[i] for i in rest if i in marked or i in slot]


def best_slot(page: Page, blocks: list[int], template: frozenset[int]) -> set[int]:
    """Those of ``blocks`` in the lowest place of the template that holds the article's text.

    From the whole page it goes down to the dividing tags of one class path that
    hold three quarters of the text or more; all tags of that path stay together,
    so an article spread over siblings does. It stops where they hold less and,
    below the body, where running text stands beside them.
    """
    # The tree of dividing tags that count, parents first, with the text and the
    # running text below each; -1 is the whole page.
    own = {-1: -1}
    for number, name in page.elements.items():
        counts = name in FRAMES and (not template or page.tokens[number] in template)
        own[number] = number if counts else own[page.parents[number]]
    above = {n: own[page.parents[n]] for n, f in own.items() if n >= 0 and n == f}
    volume: Counter[int] = Counter()
    running: Counter[int] = Counter()
    for i in blocks:
        frame = own[page.holders[i]]
        volume[frame] += len(page.texts[i])
        running[frame] += page.elements.get(page.holders[i]) in PARAGRAPHS
    below: dict[int, list[int]] = {}
    for n in reversed(above):
        volume[above[n]] += volume[n]
        running[above[n]] += running[n]
    for n, parent in above.items():
        if volume[n]:
            below.setdefault(parent, []).append(n)

    places, inside = [-1], ""
    while True:
        paths: dict[int, list[int]] = {}
        for place in places:
            for n in below.get(place, ()):
                paths.setdefault(page.tokens[n], []).append(n)
        if not paths:
            break
        lower = max(paths.values(), key=lambda nodes: sum(volume[n] for n in nodes))
        if 4 * sum(volume[n] for n in lower) < 3 * sum(volume[n] for n in places):
            break
        beside = sum(running[n] for n in places) - sum(running[n] for n in lower)
        if inside not in ("", "html", "body") and beside:
            break
        places, inside = lower, page.elements[lower[0]]
    chosen = set(places)
    within = {-1: -1 in chosen}
    for n, parent in above.items():
        within[n] = within[parent] or n in chosen
    return {i for i in blocks if within[own[page.holders[i]]]}


def nest(classes: list[list[tuple[float, int]]]) -> list[int]:
    """Tokens of the template: classes that nest, taken in order of support and size.

    A class is a list of (place, token). It is valid if, against every class
    already taken, all its tokens lie in one slot between that class's tokens, or
    all of that class's tokens lie in one slot of its own.
    """

    def one_slot(inner: list[tuple[float, int]], outer: list[tuple[float, int]]) -> bool:
        places = sorted(p for p, _ in outer)
        return len({sum(q <= p for q in places) for p, _ in inner}) == 1

    taken: list[list[tuple[float, int]]] = []
    for tokens in classes:
        if all(one_slot(tokens, other) or one_slot(other, tokens) for other in taken):
            taken.append(tokens)
    return [token for tokens in taken for _, token in tokens]


def templates(pages: DataFrame, least_pages: int = 3, least_share: float = 0.6) -> DataFrame:
    """``host, template`` (tokens) for hosts with enough pages.

    ``pages`` has ``host, page_key, html``. A token's occurrence vector says how
    often it stands on each page of the host; vectors are compared by two 64-bit
    XORs over (page, count), so that they are partial aggregations at any number
    of pages. Tokens with equal vectors are one class. Only tokens on at least
    ``least_share`` of the host's pages (and ``least_pages``) take part, so a host's
    list is at most twice an average page.
    """

    def tokens_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in shards(batches, "html", 4 << 20):
            host, key, token, n, place = [], [], [], [], []
            for h, k, raw in zip(part.column("host").to_pylist(), part.column("page_key").to_pylist(), texts_of(part.column("html")), strict=True):
                tokens = parse(raw.decode("utf-8", "replace")).tokens
                first = {t: i for i, t in reversed(list(enumerate(tokens)))}
                for t, c in Counter(tokens).items():
                    host.append(h)
                    key.append(k)
                    token.append(t - (1 << 64) if t >> 63 else t)
                    n.append(c)
                    place.append(first[t])
            yield pa.RecordBatch.from_arrays(
                [pa.array(host, pa.string()), pa.array(key, pa.int64()), pa.array(token, pa.int64()), pa.array(n, pa.int32()), pa.array(place, pa.int32())],
                names=["host", "page_key", "token", "n", "place"],
            )

    seen = (
        pages.mapInArrow(tokens_of, "host string, page_key long, token long, n int, place int")
        .groupBy("host", "token")
        .agg(
            F.count(F.lit(1)).alias("pages"),
            F.bit_xor(F.xxhash64("page_key", "n")).alias("v1"),
            F.bit_xor(F.xxhash64(F.lit(1), "page_key", "n")).alias("v2"),
            F.avg("place").alias("place"),
        )
        .where(F.col("pages") >= least_pages)
    )
    size = pages.groupBy("host").agg(F.count(F.lit(1)).alias("host_pages"))
    frequent = seen.join(size, "host").where(F.col("pages") >= least_share * F.col("host_pages"))
    classes = frequent.groupBy("host", "pages", "v1", "v2").agg(F.sort_array(F.collect_list(F.struct("place", "token"))).alias("tokens"))
    hosts = classes.groupBy("host").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("pages")).alias("rank"), (-F.size("tokens")).alias("size"), "v1", "v2", "tokens"))).alias("classes")
    )

    def nested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [nest([[(x["place"], x["token"]) for x in c["tokens"]] for c in row]) for row in batch.column("classes").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(made, pa.list_(pa.int64()))], names=["host", "template"])

    return hosts.mapInArrow(nested, "host string, template array<long>")


def main_text(pages: DataFrame, id_col: str = "page_id", url: str = "url", markup: str = "html") -> DataFrame:
    """Append ``text`` and ``n_chars``: the main text of every page.

    Templates are deduced per host (``templates``) and joined back to the pages
    by host; a host that holds a large share of all pages is split by the
    adaptive join. Blocks are joined by one \\n; white space inside a block,
    ``br`` included, is one space; character references are decoded.

    Headings in a header go with it. Elements nested more than ``DEEPEST`` deep become
    siblings, so time and memory follow the markup's length, very long pages included.

    Null or empty markup gives an empty text. A null url, or one without a host,
    is a host of its own name (empty). Pages that repeat are read each; columns
    of ``pages`` named like new ones are replaced. An empty table gives no rows.
    """
    new = ("text", "n_chars")
    kept = pages.select(*[F.col(f"`{c}`") for c in pages.columns if c not in new or c == markup])
    host = host_of(F.col(f"`{url}`"))
    learnt = staged(templates(pages.select(host.alias("host"), F.xxhash64(id_col, url).alias("page_key"), F.col(markup).alias("html"))))
    own_host, own_template = unused(pages, "_host", "_template")
    rows = kept.withColumn(own_host, host).join(learnt.toDF(own_host, own_template), own_host, "left")

    def work(part: pa.RecordBatch) -> dict[str, pa.Array]:
        known: dict[str, frozenset[int]] = {}
        texts = []
        for name, raw, tokens in zip(part.column(own_host).to_pylist(), texts_of(part.column(markup)), part.column(own_template), strict=True):
            if name not in known:
                known[name] = frozenset(t % (1 << 64) for t in tokens.as_py() or ())
            texts.append("\n".join(main_blocks(parse(raw.decode("utf-8", "replace")), known[name])))
        return {"text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())}

    return per_row(rows, work, "text string, n_chars long", markup).drop(own_host, own_template)
