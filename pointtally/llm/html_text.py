"""Main text of web pages by tree scoring.

A page becomes a tree of block elements.  Each paragraph passes points for its
length and commas, discounted by its link density, to its ancestors: all to
the parent, half to the next, then ever less.  The container with the most
points, discounted by its own link density, is kept with those siblings that
score near it, and, inside ``article`` or ``main``, the whole of that element.
Menus, headers, footers, sidebars, notices, adverts, forms and reader comments
are left out by element, role and class words before scoring.  Class words and
forms are judged by what they hold, measured in a first pass: an element around
``article``, ``main`` or most of the page's prose stays, at a lower score where
other text could be meant, and inside ``article`` or ``main`` only a whole
boilerplate name or a share of links drops one.  Lists that are
almost all links are menus too, but not inside ``article`` or ``main`` nor
after prose of the container they stand in.  An ``article`` or ``main`` that
stands in a menu, header, footer or sidebar counts where the page has no other.

Time and memory are linear in the page's size, however its elements nest and
whatever is left open: tags end at the next ``>`` at the latest, open elements
are found by name, and sums go from children to parents once.
"""

from __future__ import annotations

import html as _html
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointtally.llm.common import byte_slices

# Element names of HTML, by how they are treated.
RAW_TEXT = "script|style|noscript|iframe|textarea|title|xmp|noembed|noframes|template"
EMBEDDED = frozenset("svg select object canvas".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody "
    "td tfoot th thead tr ul".split()
)
PARAGRAPHS = frozenset("p pre li td th dd dt blockquote figcaption caption summary address legend".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PROSE = frozenset("p blockquote pre".split())
LISTS = frozenset("ul ol dl menu dir table".split())
DROPPED_TAGS = frozenset("nav aside footer form menu dialog head button".split())
SCOPES = frozenset("table td th caption html body article section div".split())
CLOSED_BY = {
    "li": (frozenset(["li"]), frozenset("ul ol menu dir".split())),
    "dd": (frozenset("dd dt".split()), frozenset(["dl"])),
    "dt": (frozenset("dd dt".split()), frozenset(["dl"])),
    "td": (frozenset("td th".split()), frozenset("table tr".split())),
    "th": (frozenset("td th".split()), frozenset("table tr".split())),
    "tr": (frozenset("tr td th".split()), frozenset(["table"])),
}
KEPT_WHOLE = frozenset("article main".split())
ROOTS = frozenset("html body article main".split())

# Class and id words of boilerplate, and roles that name it.
BOILERPLATE_WORDS = frozenset(
    "ad ads adbox advert adverts advertisement advertising adsense adsbygoogle sponsor sponsored promo promotion "
    "banner nav navbar navigation topnav menu menubar submenu breadcrumb breadcrumbs sidebar sidenav aside widget "
    "footer header masthead cookie cookies consent gdpr notice notices popup modal overlay toast newsletter subscribe "
    "subscription signup login social share sharing related recommended recommendations pagination pager comment "
    "comments commentlist commentform disqus respond replies reply discussion skip toolbar".split()
)
# Beginnings and ends of longer class words of the same kind.
BOILERPLATE_STEMS = (
    ("advert", "sponsor", "sidebar", "breadcrumb", "newsletter", "cookie", "navbar", "navigation", "subscri", "promo"),
    ("footer", "sidebar", "navbar", "menu", "banner", "comments", "adbox", "popup"),
)
BOILERPLATE_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split()
)
COMMENT_WORDS = frozenset("comment comments reply replies respond".split())
# Words that make no other thing of a boilerplate word beside them, words that
# deny or attach what follows them, and words that may name a section's subject.
NEUTRAL_WORDS = frozenset(
    "area bar block body box button buttons col container content group inner item items link links list panel post posts "
    "section slot unit wrap wrapper articles entries icons".split()
)
QUALIFIERS = frozenset("has no with without".split())
SUBJECT_WORDS = frozenset(["discussion"])
# Of the above, those that may name a part of the article itself when inside it.
ARTICLE_PARTS = frozenset("header masthead banner".split())

# Elements whose text is left out unless they hold the page's only article.
SPARED_TAGS = frozenset("nav aside footer header menu".split())
# Ancestors that a paragraph passes points to.
LEVELS = 16

SIBLING_SHARE = 0.2
MENU_LINKS = 0.8
# Links of an element inside an article that only partly has a boilerplate name;
# prose of a page that makes an element its main part, and its text for certain;
# and what the points of a doubtful element count.
NAMED_LINKS = 0.5
MOST_PROSE, NEARLY_ALL = 0.5, 0.75
DOUBTFUL = 0.25
MENU_ITEMS = 3

# The inside of a tag: quotes count after an equals sign only, and only in pairs.
_INSIDE = r"(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+"
_TOKENS = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW_TEXT})\b{_INSIDE}>.*?(?:</\1\s*>|\Z)"
    rf"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)({_INSIDE})>|<[!?/][^>]*>",
    re.S | re.I,
)
# One attribute after the other: the whole name, and a quoted or bare value.
_ATTR = re.compile(r"([^\s/>=][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_EMBEDS = re.compile(r"<(?:svg|select|object|canvas)\b", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


# How a class or id names boilerplate: not, in part, wholly, or as reader comments.
PART, WHOLE, COMMENTS = 1, 2, 3


def _attributes(attrs: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _ATTR.finditer(attrs):
        out.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    return out


def _name(value: str, tag: str, in_article: bool) -> int:
    """Which of the above a class or id value is, at most."""
    kind = 0
    for token in value.split():
        words = [w.lower() for w in _WORDS.findall(token)]
        words = words[: next((k for k, w in enumerate(words) if w in QUALIFIERS), len(words))]
        found = {
            w for w in words
            if w in BOILERPLATE_WORDS
            or w.startswith(BOILERPLATE_STEMS[0])
            or (w.endswith(BOILERPLATE_STEMS[1]) and not w.startswith(("no", "has", "with")))
        }
        if tag == "article":  # one of its own only where it is a reader's comment
            found &= COMMENT_WORDS
        if in_article:
            found -= ARTICLE_PARTS
        if found:
            whole = found - SUBJECT_WORDS and all(w in found or w in NEUTRAL_WORDS for w in words)
            kind = max(kind, (COMMENTS if found & COMMENT_WORDS else WHOLE) if whole else PART)
    return kind


def _boilerplate(tag: str, attrs: str, in_article: bool) -> tuple[bool, int]:
    """Whether the element is dropped whatever it holds, and how it is named (a form: wholly)."""
    if tag in EMBEDDED or (tag in DROPPED_TAGS and tag != "form") or (tag == "header" and not in_article):
        return True, 0
    if not attrs or tag in ROOTS - {"article"}:
        return False, WHOLE if tag == "form" else 0
    found = _attributes(attrs)
    role = found.get("role", "").lower()
    if (
        "hidden" in found
        or found.get("aria-hidden", "").lower() == "true"
        or _HIDDEN.search(found.get("style", ""))
        or (role in BOILERPLATE_ROLES and not (in_article and role in ARTICLE_PARTS) and not (tag == "form" and role == "form"))
    ):
        return True, 0
    if tag == "form":
        return False, WHOLE
    if tag in HEADINGS:
        return False, 0
    return False, max(_name(found.get(name, ""), tag, in_article) for name in ("class", "id"))


# Short attribute strings recur from page to page: their judgements are kept, up to a number.
KEPT_ATTRS, KEPT_JUDGEMENTS = 256, 8192
_judged: dict[tuple[str, str, bool], tuple[bool, int]] = {}


def _judge(tag: str, attrs: str, in_article: bool) -> tuple[bool, int]:
    if len(attrs) > KEPT_ATTRS:
        return _boilerplate(tag, attrs, in_article)
    key = (tag, attrs, in_article)
    if key not in _judged:
        if len(_judged) >= KEPT_JUDGEMENTS:
            _judged.clear()
        _judged[key] = _boilerplate(*key)
    return _judged[key]


class _Named:
    """An element with a boilerplate name, and what it holds."""

    def __init__(self, token: int, node: int, tag: str, kind: int, in_article: bool, outer: int, before: tuple):
        self.token, self.node, self.tag, self.kind = token, node, tag, kind
        self.in_article, self.outer, self.before = in_article, outer, before
        self.chars = self.links = self.wholes = 0
        self.may_be_text = tag in KEPT_WHOLE and kind != COMMENTS

    def verdict(self, page: _Page) -> str:
        """``drop``, ``doubt`` or ``keep``."""
        prose, total = self.chars - self.links, page.chars - page.linked
        itself = self.may_be_text and prose > 0
        elsewhere = page.wholes - self.wholes - self.outer - itself > 0
        if self.wholes:
            return "doubt" if elsewhere and self.tag != "form" else "keep"
        if prose > MOST_PROSE * total and not elsewhere:
            sure = self.tag == "form" or (prose > NEARLY_ALL * total and self.kind != COMMENTS)
            return "keep" if sure else "doubt"
        if self.in_article and self.kind == PART and self.links < NAMED_LINKS * self.chars:
            return "keep"
        return "drop"


def _embedded_ends(tokens: list) -> dict[int, int]:
    """Token of the end tag of every embedded element that is closed before the block around it is."""
    ends: dict[int, int] = {}
    opened: list[tuple[str, int]] = []
    count: dict[str, int] = {}
    for k, m in enumerate(tokens):
        tag = (m[3] or "").lower()
        if tag not in EMBEDDED and tag not in BLOCKS:
            continue
        if not m[2]:
            if tag in BLOCKS or not m[4].endswith("/"):
                opened.append((tag, k))
                count[tag] = count.get(tag, 0) + 1
        elif count.get(tag):
            while True:
                name, at = opened.pop()
                count[name] -= 1
                if name == tag:
                    break
            if tag in EMBEDDED:
                ends[at] = k
    return ends


class _Page:
    """Tree of block elements (``parent``, ``tag``) and text blocks ``(element, text, link characters)``.

    The tokens of ``dropped`` start elements that are left out; without it the
    elements with boilerplate names are measured (``named``).  The tokens of
    ``spared`` start elements that are not left out for their tag.
    """

    def __init__(self, source: str, dropped: frozenset | None = None, spared: frozenset = frozenset()):
        self.dropped, self.spared = dropped, spared
        self.named: list[_Named] = []
        self.lost: set[int] = set()  # elements left out for their tag that hold an article or main
        self.chars = self.linked = 0  # of the text so far
        self.outer = 0  # open article and main elements, comments aside
        self.wholes = 0  # closed article and main elements with prose, comments aside
        self.parent, self.tag = [-1], ["#root"]
        self.blocks: list[tuple[int, str, int]] = []
        # Open elements: (tag, node or -1 for inline, dropped, inside article, inside a link, measured or None)
        self.open = [("#root", 0, False, False, False, None)]
        self.depths: dict[str, list[int]] = {}  # of the open elements, by tag
        self.nodes = [(0, 0)]  # (depth, node) of the open block elements
        self.left_out: tuple[int, int] | None = None  # depth and token (or -1) of the outermost element left out
        self.pieces: list[str] = []
        self.links = 0
        at, last = 0, source.rfind(">") + 1  # no tag ends after the last one
        tokens = list(_TOKENS.finditer(source, 0, last))
        ends = _embedded_ends(tokens) if _EMBEDS.search(source) else {}
        skip = -1
        for k, m in enumerate(tokens):
            if k <= skip:
                at = m.end()
                continue
            if m.start() > at:
                self._text(source[at : m.start()])
            at = m.end()
            skip = ends.get(k, -1)
            tag = m[3]
            if skip >= 0:
                continue
            if tag is None:
                continue
            tag = tag.lower()
            if m[2]:
                self._end(tag)
            else:
                self._start(tag, m[4], k)
        if tokens and at == last and _runs_on(tokens[-1]):
            at = len(source)
        if at < len(source):
            self._text(source[at:])
        self._pop_to(1)
        self._flush()

    def _text(self, text: str) -> None:
        top = self.open[-1]
        if not top[2]:
            self.pieces.append(text)
            if top[4] or self.dropped is None:
                length = len(" ".join(text.split()))
                self.chars += length
                if top[4]:
                    self.links += length
                    self.linked += length

    def _flush(self) -> None:
        if self.pieces:
            text = " ".join(_html.unescape("".join(self.pieces)).split())
            if text:
                self.blocks.append((self.nodes[-1][1], text, min(self.links, len(text))))
            self.pieces = []
        self.links = 0

    def _pop_to(self, depth: int) -> None:
        if self.nodes[-1][0] >= depth:
            self._flush()
        while len(self.open) > depth:
            tag, node, _, _, _, got = self.open.pop()
            self.depths[tag].pop()
            if node >= 0:
                self.nodes.pop()
            if self.left_out is not None and self.left_out[0] >= len(self.open):
                self.left_out = None
            if got is not None:
                chars, linked, wholes = got.before
                got.chars, got.links, got.wholes = self.chars - chars, self.linked - linked, self.wholes - wholes
                self.outer -= got.may_be_text
                self.wholes += got.may_be_text and got.chars > got.links

    def _depth(self, names: frozenset) -> int:
        """Depth of the innermost open element of one of ``names``, 0 for none."""
        return max((d[-1] for d in map(self.depths.get, names) if d), default=0)

    def _close(self, names: frozenset, scopes: frozenset) -> None:
        """Close the open element of one of ``names``, unless one of ``scopes`` stands between."""
        depth = self._depth(names)
        if depth and (self.nodes[-1][0] if scopes is BLOCKS else self._depth(scopes)) <= depth:
            self._pop_to(depth)

    def _start(self, tag: str, attrs: str, token: int) -> None:
        if tag == "br" or tag == "hr" or tag in VOID:
            if tag == "hr":
                self._flush()
            elif not self.open[-1][2]:
                self.pieces.append(" " if tag == "br" else "")
            return
        if tag in BLOCKS:  # an embedded element that is never closed ends where a block begins
            self._close(EMBEDDED, BLOCKS)
        if tag in CLOSED_BY:
            self._close(*CLOSED_BY[tag])
        elif tag in BLOCKS:
            self._close(frozenset(["p"]), SCOPES)
        elif tag == "a":
            self._close(frozenset(["a"]), SCOPES)
        if attrs.endswith("/") and tag not in BLOCKS and tag != "a":
            return
        _, _, dropped, in_article, in_link, _ = self.open[-1]
        removed, kind = True, 0
        if not dropped:
            removed, kind = _judge(tag, attrs, in_article)
            if removed and token in self.spared:
                removed = False
            if removed:
                self.left_out = (len(self.open), token if tag in SPARED_TAGS else -1)
        elif tag in KEPT_WHOLE and self.left_out is not None and self.left_out[1] >= 0:
            hidden, named = _judge(tag, attrs, False)
            if not hidden and named != COMMENTS:
                self.lost.add(self.left_out[1])
        drop = removed or (self.dropped is not None and token in self.dropped)
        node = -1
        if tag in BLOCKS:
            self._flush()
            node = len(self.tag)
            self.parent.append(self.nodes[-1][1])
            self.tag.append(tag)
            self.nodes.append((len(self.open), node))
        elif drop and not dropped:
            self.pieces.append(" ")
        got = None
        if self.dropped is None and not drop and (kind or tag in KEPT_WHOLE):
            got = _Named(token, node, tag, kind, in_article, self.outer, (self.chars, self.linked, self.wholes))
            self.outer += got.may_be_text
            if kind:
                self.named.append(got)
        self.depths.setdefault(tag, []).append(len(self.open))
        self.open.append((tag, node, drop, in_article or tag in KEPT_WHOLE, in_link or tag == "a", got))

    def _end(self, tag: str) -> None:
        if tag == "br" or tag in VOID:
            return
        depth = self._depth((tag,))
        if depth and (tag in BLOCKS or self.nodes[-1][0] <= depth):
            self._pop_to(depth)


def _runs_on(token: re.Match) -> bool:
    """Whether a comment or raw text has no end, so that the rest of the page belongs to it."""
    text = token[0]
    if token[1]:
        return not re.search(rf"</{token[1]}\s*>\Z", text, re.I)
    return text.startswith("<!--") and not text.endswith("-->")


def _chosen(page: _Page, doubt: frozenset = frozenset()) -> list[str]:
    """Texts of the blocks in the best container and the siblings kept with it.

    Points under a node of ``doubt`` count less, and its text is left out where
    the best container lies elsewhere and has prose of its own.
    """
    parent, tag, blocks = page.parent, page.tag, page.blocks
    n = len(tag)
    size, links = [0.0] * n, [0.0] * n
    points = [0.0] * n
    items = [0] * n
    article_of = [False] * n
    for k in range(1, n):
        article_of[k] = tag[k] in KEPT_WHOLE or article_of[parent[k]]
    doubtful = [False] * n
    for k in range(1, n if doubt else 1):
        doubtful[k] = k in doubt or doubtful[parent[k]]
    prose_at: dict[int, int] = {}  # the first node with prose in a container
    for node, text, linked in blocks:
        length = len(text)
        if tag[node] in PROSE and linked < 0.25 * length:
            prose_at.setdefault(parent[node], node)
        size[node] += length
        links[node] += linked
        items[node] += 1
        if tag[node] in HEADINGS:
            continue
        gain = (1 + text.count(",") + min(length / 100, 3)) * (1 - linked / length)
        gain *= DOUBTFUL if doubtful[node] else 1
        at, level = (parent[node] if tag[node] in PARAGRAPHS else node), 0
        while at >= 0 and level < LEVELS:
            points[at] += gain / (1 if level == 0 else 2 if level == 1 else 3 * level)
            at, level = parent[at], level + 1
    for k in range(n - 1, 0, -1):  # children come after their parents
        size[parent[k]] += size[k]
        links[parent[k]] += links[k]
        items[parent[k]] += items[k]
    menu = [
        tag[k] in LISTS and items[k] >= MENU_ITEMS and links[k] >= MENU_LINKS * size[k] and not article_of[k] for k in range(n)
    ]
    for k in range(n):  # a list among the prose of its container belongs to it
        if menu[k] and prose_at.get(parent[k], k) < k:
            menu[k] = False
    score = [points[k] * (1 - links[k] / size[k]) if size[k] else 0.0 for k in range(n)]
    best = max(range(n), key=lambda k: (score[k], -k))
    kept = {best}
    if score[best] <= 0:
        whole = [k for k in range(n) if tag[k] in KEPT_WHOLE and size[k]]
        kept = {max(whole, key=lambda k: size[k])} if whole else {0}
    else:
        at, article = best, -1
        while at >= 0:
            if tag[at] in KEPT_WHOLE:
                article = at
                break
            at = parent[at]
        if article >= 0:
            kept = {article}
        elif parent[best] >= 0:
            for k in range(n):
                if parent[k] != parent[best] or not size[k] or k == best or k in doubt:
                    continue
                share = links[k] / size[k]
                near = score[k] >= SIBLING_SHARE * score[best]
                prose = tag[k] in PROSE and share < 0.25
                title = tag[k] in HEADINGS and k < best and share < 0.5
                if near or prose or title:
                    kept.add(k)
            for node, text, linked in blocks:  # text that stands loose beside it
                if node == parent[best] and linked < 0.25 * len(text):
                    kept.add(-1 - node)
    around = set()  # the best container and what it stands in
    at = best
    while at >= 0:
        around.add(at)
        at = parent[at]
    prose = sum(size[k] - links[k] for k in kept if k >= 0)
    left_out = {k for k in doubt if k not in around and size[k] - links[k] <= NEARLY_ALL * prose}
    # Whether a node stands in something kept, and in something left out below that.
    inside, gone = [False] * n, [False] * n
    for k in range(n):
        gone[k] = menu[k] or k in left_out
        if k in kept:
            inside[k] = True
        elif k:
            inside[k] = inside[parent[k]]
            gone[k] = gone[k] or gone[parent[k]]
    return [text for node, text, _ in blocks if (inside[node] or (-1 - node) in kept) and not gone[node]]


def extract(source: str | None) -> str:
    """Main text of one page: blocks in page order joined by a line break; empty where there is none."""
    if not source:
        return ""
    page, spared = _Page(source), frozenset()
    while page.lost - spared and not page.wholes:
        spared |= page.lost
        page = _Page(source, spared=spared)
    verdicts = [(named, named.verdict(page)) for named in page.named]
    dropped = frozenset(named.token for named, v in verdicts if v == "drop")
    doubt = frozenset(named.node for named, v in verdicts if v == "doubt" and named.node >= 0)
    out = _chosen(_Page(source, dropped, spared) if dropped else page, doubt)
    if not out:  # everything stood under a boilerplate word or a form: trust the elements alone
        out = _chosen(page)
    return "\n".join(out)


def _extract_fn():
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            pages = batch.column(2).to_pylist()
            for lo, hi in byte_slices([len(p or "") for p in pages], 4 << 20):
                texts = [extract(p) for p in pages[lo:hi]]
                yield pa.RecordBatch.from_pydict(
                    {
                        "page_id": batch.column(0).slice(lo, hi - lo),
                        "url": batch.column(1).slice(lo, hi - lo),
                        "text": pa.array(texts, pa.string()),
                        "n_chars": pa.array([len(t) for t in texts], pa.int64()),
                    }
                )

    return run


def extract_text(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every row of ``pages`` (``page_id``, ``url``, ``html``).

    One pass, no shuffle; other columns are ignored.  A null or empty page, or
    one without main text, has empty text; repeated rows give equal rows; null
    ids and URLs stay; an empty table gives no rows.  Of equally good
    containers the first in page order is kept.
    """
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    )
    return rows.mapInArrow(_extract_fn(), "page_id bigint, url string, text string, n_chars bigint")
