"""Operator 3: main-text extraction by consensus paths of a host.

A page is read into blocks (runs of text between block tags) and containers. Every container is scored by
the prose it holds itself plus half of what its inner containers hold; text in links counts against it. The best
container votes, for its host, on its generalised path: tags and classes from the root, digits
replaced. Spark counts the votes (combined before the shuffle, so a host with a third of all pages costs a
row per task and path). Before it votes, a container outside an article or main element is climbed up from while headings
or unmarked prose stand beside it, so an article in several containers is whole. Each host's leading paths are then applied to all its pages: a page
yields the blocks under the first leading path it has, else under its own best container. Menus, headers, footers,
sidebars, notices, adverts, forms, scripts, styles and reader comments are left out by tag, role
and class wherever they lie. Classes and ids don't drop what the page's only article or main elements lie in,
nor, without such elements, what holds more than half of the prose (unless they name comments or related pages,
which may be longer than the article), nor, for a weak word, a heading or paragraph inside the article that isn't mostly links. Of sibling
articles with prose all are taken. A page with prose that would come out empty by them is read without them.

In a block, character references are decoded and white space becomes one space; blocks are joined by one
line break. Defined results: a null or empty page, or one without prose, gives an empty text; a
page without a host goes by its own best container; unclosed tags end with their parent; rows with
a null or repeated id are all returned; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import once

LEADING = 3                      # paths that a host may use
BROADCAST_BYTES = 8 << 20        # the hosts' paths are broadcast up to this measured size

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
                    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?/][^>]*+(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_RAW = frozenset("script style textarea iframe noscript template title svg math object canvas audio video xmp noembed noframes".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody
tfoot thead tr ul option select button #""".split())          # "#" is the page itself
_HOLDS_TEXT = frozenset("p h1 h2 h3 h4 h5 h6 li dd dt pre blockquote figcaption caption tr td th summary legend address".split())
_PROSE = frozenset("p h1 h2 h3 h4 h5 h6 li dd dt pre blockquote figcaption caption td th".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_INLINE_SPACE = frozenset(("br", "td", "th", "img", "input", "wbr"))
_DROP_TAGS = frozenset("nav footer aside form button select head menu dialog fieldset label input".split())
# words of a class, id or role that mark what isn't the article
_DROP_WORDS = frozenset("""ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav
navbar navigation breadcrumb breadcrumbs footer cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe
subscription signup share sharing social related recommended recommendations comment comments commentlist reply replies respond
disqus widget toolbar topbar header masthead legal copyright outbrain taboola pagination pager login search hidden complementary contentinfo""".split())
_KEEP_WORDS = frozenset("article content main post entry story body text page".split())
_STRONG_DROP = frozenset("ad ads advert advertisement comment comments sidebar footer nav navbar menu".split())
_BULKY = frozenset("comment comments commentlist reply replies respond disqus related recommended recommendations".split())
_NEVER_DROPPED = frozenset(("html", "body", "article", "main"))
# an opening tag ends these when they are open
_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
         "th": ("td", "th"), "option": ("option",), "tbody": ("tr", "td", "th", "thead"), "body": ("head",)}
_SCOPE = frozenset("table ul ol dl div article section main body html nav aside footer header form blockquote".split())


class _Node:
    __slots__ = ("tag", "parent", "path", "dropped", "score", "link", "inner", "by_word", "strong")

    def __init__(self, tag, parent, path, dropped, link, by_word):
        self.tag, self.parent, self.path, self.dropped, self.link = tag, parent, path, dropped, link
        self.by_word = by_word                       # a word of class, id or role: 1 drops it, 2 also if it holds most prose
        self.strong = True                           # such a word is strong
        self.score = 0.0
        self.inner = False


def _labels(attributes: str) -> tuple[str, set[str], bool]:
    """Generalised classes, the words of class, id and role, and whether the element is hidden."""
    if "=" not in attributes:
        return "", set(), bool(re.search(r"\bhidden\b", attributes))
    got = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
    classes = ".".join(sorted({re.sub(r"\d+", "0", c.lower()) for c in got.get("class", "").split()}))
    words = {w.lower() for k in ("class", "id", "role") for w in _WORD.findall(got.get(k, ""))}
    hidden = (got.get("aria-hidden", "").lower() == "true" or "display:none" in got.get("style", "").replace(" ", "").lower()
              or bool(re.search(r"(?:^|\s)hidden(?:\s|/|$)", _ATTRIBUTE.sub("", attributes))))
    return classes, words, hidden


def _is_dropped(tag: str, hidden: bool, parent: _Node) -> bool:
    if parent.dropped or hidden or tag in _DROP_TAGS:
        return True
    return tag == "header" and parent.tag not in ("article", "main", "section")


def _drops_by_word(tag: str, words: set[str]) -> int:
    if tag in _NEVER_DROPPED or tag == "header" or not words & _DROP_WORDS:
        return 0
    if words & _KEEP_WORDS and not words & _STRONG_DROP:
        return 0
    return 2 if words & _BULKY else 1


def _up(node: _Node | None) -> Iterator[_Node]:
    while node is not None:
        yield node
        node = node.parent


def _drop_by_words(blocks: list[tuple[str, int, _Node]], nodes: list[_Node]) -> None:
    """Marks what a class, id or role drops, but for what holds an article, main element or most of the prose."""
    if not any(n.by_word for n in nodes):
        return
    named = [n for n in nodes if n.tag in ("article", "main") and not n.dropped]
    depth = [sum(up.by_word > 0 for up in _up(n)) for n in named]
    for node, k in zip(named, depth):
        if k == min(depth):                          # deeper ones may be comments
            for up in _up(node):
                up.by_word = 0
    for node in nodes:
        # a heading or paragraph of the article isn't boilerplate for a weak word alone ("header", "share-price")
        if node.by_word == 1 and not node.strong and node.tag in _PROSE and any(up.tag in ("article", "main") for up in _up(node.parent)):
            size = sum(len(t) for t, _, n in blocks if any(up is node for up in _up(n)))
            links = sum(k for _, k, n in blocks if any(up is node for up in _up(n)))
            if 2 * links <= size:
                node.by_word = 0
    prose: dict[int, int] = {}
    total = 0
    for text, linked, node in blocks:
        if not node.dropped:
            worth = max(len(text) - 3 * linked, 0)
            total += worth
            for up in _up(node):
                if up.by_word:
                    prose[id(up)] = prose.get(id(up), 0) + worth
    before = [n.dropped for n in nodes]
    for node in nodes:                               # parents come first
        by_word = node.by_word == 2 or node.by_word == 1 and (named or 2 * prose.get(id(node), 0) <= total)
        node.dropped = node.dropped or bool(by_word) or node.parent.dropped
    if total and not any(len(t) > 3 * k and not n.dropped for t, k, n in blocks):
        for node, dropped in zip(nodes, before):
            node.dropped = dropped


def read_page(html: str) -> list[tuple[str, int, _Node]]:
    """The blocks of a page in order: (text, characters inside links, element that holds it)."""
    root = _Node("#", None, "", False, False, 0)
    nodes: list[_Node] = []
    top, at, blocks = root, 0, []
    pieces: list[str] = []
    linked = 0
    length, last = len(html), html.rfind(">")
    lower = None

    def close_block():
        nonlocal pieces, linked
        if pieces:
            text = " ".join(unescape("".join(pieces)).split())
            if text:
                blocks.append((text, linked, top))
        pieces, linked = [], 0

    while at < length:
        m = _TOKEN.search(html, at) if at <= last else None      # no tag ends behind the last >
        text = html[at:m.start()] if m else html[at:]
        if text:
            pieces.append(text)
            if top.link:
                linked += len(text)
        if not m:
            break
        at = m.end()
        tag = m[2] or m[5]
        if not tag:
            continue
        tag, closing, attributes = tag.lower(), m[1] or m[4], m[3] or m[6] or ""
        if closing:
            node = top
            while node is not root and node.tag != tag:
                if node.tag in _SCOPE and tag not in _BLOCK:
                    node = root                      # an inline end tag doesn't end its container
                    break
                node = node.parent
            if tag in _BLOCK:
                close_block()
            elif tag in _INLINE_SPACE:
                pieces.append(" ")
            if node is not root:
                top = node.parent
            continue
        if tag in _RAW:
            if not attributes.endswith("/"):
                lower = lower if lower is not None else html.lower()
                end = lower.find("</" + tag, at)
                close = html.find(">", end) if end >= 0 else -1
                at = close + 1 if close >= 0 else length
            pieces.append(" ")
            continue
        if tag in _BLOCK:
            close_block()
            node = top                               # an open paragraph ends here, with what is open in it
            while node is not root and node.tag not in _SCOPE:
                if node.tag == "p":
                    top = node.parent
                    break
                node = node.parent
        elif tag in _INLINE_SPACE:
            pieces.append(" ")
        if tag in _ENDS:
            node = top
            while node is not root and (node.tag not in _SCOPE or node.tag in _ENDS[tag]):
                if node.tag in _ENDS[tag]:
                    top = node.parent
                    if tag not in ("tr", "tbody"):
                        break
                node = node.parent
        if tag in _VOID or attributes.endswith("/") and tag not in _BLOCK:
            continue
        classes, words, hidden = _labels(attributes) if attributes else ("", (), False)
        words = set(words)
        path = f"{top.path}>{tag}.{classes}" if classes else f"{top.path}>{tag}"
        top = _Node(tag, top, path if tag in _BLOCK else top.path, _is_dropped(tag, hidden, top),
                    top.link or tag == "a", _drops_by_word(tag, words))
        top.strong = bool(words & _STRONG_DROP)
        nodes.append(top)
    close_block()
    _drop_by_words(blocks, nodes)
    return blocks


def _container(node: _Node) -> _Node | None:
    while node is not None and (node.tag in _HOLDS_TEXT or node.tag not in _BLOCK):
        node = node.parent
    return node


def best_container(blocks: list[tuple[str, int, _Node]]) -> _Node | None:
    """The container with the highest score; inside an article or main element, that element."""
    seen: dict[int, _Node] = {}
    for text, linked, node in blocks:
        if node.dropped:
            continue
        home = _container(node)
        worth = len(text) - 3 * linked
        if node.tag not in _HOLDS_TEXT:
            worth *= 0.6
        share = float(worth)
        while home is not None:
            seen[id(home)] = home
            home.score += share
            share /= 2
            home = home.parent
            while home is not None and home.tag not in _BLOCK:
                home = home.parent
    best = None
    for node in seen.values():                       # first seen wins ties
        factor = {"#": 0.5, "html": 0.5, "body": 0.8}.get(node.tag, 1.0)
        node.score *= factor
        if node.score > 0 and (best is None or node.score > best.score):
            best = node
    for node in _up(best):
        if node.tag in ("article", "main"):
            return node
    return _climbed(best, blocks) if best is not None else None


SIBLING = 60                     # characters of prose for which a part beside the best container counts


def _parts(parent: _Node, blocks: list[tuple[str, int, _Node]]) -> dict[int, list]:
    """Of each child of ``parent`` that isn't dropped: [child, characters, characters in links]."""
    out: dict[int, list] = {}
    for text, linked, node in blocks:
        if node.dropped or node is parent:
            continue
        child = next((up for up in _up(node) if up.parent is parent), None)
        if child is not None:
            part = out.setdefault(id(child), [child, 0, 0])
            part[1] += len(text)
            part[2] += linked
    return out


def _climbed(best: _Node, blocks: list[tuple[str, int, _Node]]) -> _Node:
    """The container of the whole article: up from the best one while beside it stand headings or unmarked prose.

    The body is taken only for a heading or paragraph of its own, not for other containers.
    """
    node = best
    while node.parent is not None and node.parent.tag not in ("#", "html"):
        parent = node.parent
        if parent.tag not in _BLOCK or parent.tag in _HOLDS_TEXT:
            node = parent
            continue
        beside = [(c, n, k) for c, n, k in _parts(parent, blocks).values() if c is not node and 3 * k <= n]
        own = any(c.tag in _HEADINGS or c.tag in _HOLDS_TEXT and n >= SIBLING for c, n, k in beside)
        if not own and (parent.tag == "body" or not any(n >= SIBLING for _, n, _ in beside)):
            break
        node = best = parent
    return best


def _with_siblings(chosen: list[_Node], blocks: list[tuple[str, int, _Node]]) -> set[int]:
    """The chosen containers; beside an article element also its sibling articles with prose of their own."""
    out = {id(c) for c in chosen}
    for c in chosen:
        if c.tag == "article" and c.parent is not None:
            parts = _parts(c.parent, blocks)
            least = max(SIBLING, parts[id(c)][1] // 5) if id(c) in parts else SIBLING
            out |= {id(x) for x, n, k in parts.values() if x.tag == "article" and n - 3 * k >= least}
    return out


def host_of(url: str | None) -> str:
    m = re.match(r"\s*(?:[a-zA-Z][\w+.-]*:)?//(?:[^/?#@]*@)?([^/?#:\s]+)", url or "")
    return m[1].lower() if m else ""


def extract(html: str, leading: list[str]) -> str:
    """Text of the blocks under the first leading path the page has, else under its best container."""
    blocks = read_page(html)
    paths = {id(node): list(_up(node)) for _, _, node in blocks}

    def under(chosen: list[_Node]) -> list[str]:
        ids = _with_siblings(chosen, blocks)
        return [t for t, _, n in blocks if not n.dropped and any(id(c) in ids for c in paths[id(n)])]

    for path in leading:
        chosen = {id(c): c for _, _, n in blocks if not n.dropped for c in paths[id(n)] if c.path == path}
        texts = under(list(chosen.values())) if chosen else []
        if texts:
            return "\n".join(texts)
    best = best_container(blocks)
    return "\n".join(under([best])) if best is not None else ""


def _vote_batches(batches):
    for b in batches:
        out: dict[tuple[str, str], list[float]] = {}
        for url, html in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            host = host_of(url)
            best = best_container(read_page(html)) if html and host else None
            if best is not None:
                v = out.setdefault((host, best.path), [0, 0.0])
                v[0] += 1
                v[1] += best.score
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in out]), pa.array([k[1] for k in out]),
                 pa.array([v[0] for v in out.values()], pa.int64()), pa.array([int(v[1]) for v in out.values()], pa.int64())],
                ["host", "path", "votes", "score"])


def host_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, paths): up to LEADING paths with a fifth of the host's votes at least, most votes first."""
    votes = pages.select(F.col(url_col).alias("url"), F.col(html_col).alias("html")).mapInArrow(
        _vote_batches, "host string, path string, votes long, score long")
    votes = votes.groupBy("host", "path").agg(F.sum("votes").alias("votes"), F.sum("score").alias("score"))
    order = Window.partitionBy("host").orderBy(F.desc("votes"), F.desc("score"), "path")
    lead = (votes.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= LEADING)
            .groupBy("host").agg(F.sort_array(F.collect_list(F.struct("rank", "votes", "path"))).alias("all")))
    return lead.select("host", F.expr("transform(filter(all, x -> x.votes * 5 >= all[0].votes), x -> x.path)").alias("paths"))


def _extract_batches(batches):
    for b in batches:
        texts = [extract(html, paths or []) if html else "" for html, paths in
                 zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())], ["id", "url", "text"])


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text) of every row of ``pages``."""
    pages = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    winners = once(host_paths(pages))
    size = winners.select(F.sum(F.octet_length("host") + F.octet_length(F.array_join("paths", "")) + 64)).first()[0] or 0
    host = F.lower(F.regexp_extract("url", r"^\s*(?:[a-zA-Z][\w+.-]*:)?//(?:[^/?#@]*@)?([^/?#:\s]+)", 1))
    joined = pages.withColumn("host", host).join(F.broadcast(winners) if size <= BROADCAST_BYTES else winners, "host", "left")
    kind = pages.schema["id"].dataType.simpleString()
    return (joined.select("id", "url", "html", "paths").mapInArrow(_extract_batches, f"id {kind}, url string, text string")
            .withColumnRenamed("id", id_col).withColumnRenamed("url", url_col))
