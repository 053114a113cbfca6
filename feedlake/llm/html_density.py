"""Main text of web pages by composite text density.

Every node of the page's tree has a density: characters per tag, lowered by the share of linked
characters and tags, both of the node itself and of the page. The density sum of a node is that of
its children. The node with the largest sum is the article; the least density on the way from it
up to the body is the threshold that other parts must reach to be counted in. Parts that say
what they are (navigation, footers, forms, adverts, comments ...) are taken out before.

Defined results: a null or empty page, or one without text, gives an empty text; broken markup
never fails; depth and size are not limited.
"""

from __future__ import annotations

import re
from html import unescape
from math import e, log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.rows import column, map_slices

# Elements by what the HTML standard says of them.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
BLOCK = set("address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead title tr ul".split())
CLOSES_P = set("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: A start tag ends an open element of the first set, unless one of the second lies between.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "a": ({"a"}, {"td", "th", "table", "li", "div", "section", "article"}),
} | {tag: ({"p"}, {"td", "th", "button", "li", "div", "section", "article", "blockquote"}) for tag in CLOSES_P}

#: Elements that are never part of an article.
OUTSIDE = set("head script style noscript template nav footer aside form button select textarea input iframe object embed svg canvas menu dialog xmp noembed noframes".split())
#: Words of class, id, role or aria-label that tell the same of any other element.
NAMED = set(
    "ad ads adv advert adverts advertisement advertising adbox adsense sponsor sponsored sponsors promo promotion promoted banner "
    "cookie cookies consent gdpr notice notices alert notification disclaimer newsletter subscribe subscription signup login paywall "
    "nav navbar navigation navigate menu menus breadcrumb breadcrumbs pagination pager toc sidebar sidebars rail aside complementary "
    "footer foot masthead topbar toolbar header contentinfo banner search comment comments commentlist disqus respond replies reply discussion "
    "share sharing social related recommended recommendations popular trending more teaser teasers widget widgets popup modal overlay skip tags".split()
)
HOLDS = {"article", "main", "h1"}
#: Those of them that name what readers say: an article element in there is one reader's.
TALK = set("comment comments commentlist disqus respond replies reply discussion".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?/][^a-zA-Z>][^>]*>|<[!?][^>]*>|</>"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)"
    r"(?P<attrs>[^>\"']*+(?:\"[^\"]*+\"[^>\"']*+|'[^']*+'[^>\"']*+)*+|[^>]*+)>",
    re.DOTALL,
)
_NAME = re.compile(r"(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.IGNORECASE)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Page:
    """The tree of a page as parallel lists, parents before children."""

    def __init__(self, html: str):
        #: ``named``: 0, 1 for something other than an article, 2 for readers' comments, 3 for what is hidden.
        self.parent, self.tag, self.named = [-1], ["#root"], [0]
        #: (node, block, text) in page order.
        self.texts: list[tuple[int, int, str]] = []
        self._read(html)

    def _read(self, html: str) -> None:
        stack, block, at = [0], 0, 0
        tags = self.tag
        while True:
            token = _TOKEN.search(html, at)
            stop = token.start() if token else len(html)
            if stop > at:
                self.texts.append((stack[-1], block, unescape(html[at:stop])))
            if token is None:
                return
            at = token.end()
            name = token["tag"]
            if name is None:
                if token["cdata"]:
                    self.texts.append((stack[-1], block, token["cdata"]))
                continue
            name = name.lower()
            block += name in BLOCK
            if token["end"]:
                for i in range(len(stack) - 1, 0, -1):
                    if tags[stack[i]] == name:
                        del stack[i:]
                        break
                    if tags[stack[i]] in ("article", "main", "body") and name not in ("body", "html"):
                        break  # a stray end tag does not close what holds the article
                continue
            if name in ("html", "body") and name in (tags[i] for i in stack):
                continue
            if name == "body" or (name in ("article", "main", "div", "p", "section") and len(stack) > 1 and tags[stack[-1]] == "head"):
                while tags[stack[-1]] == "head":
                    stack.pop()
            if name in ENDS:
                ended, keep = ENDS[name]
                i = len(stack) - 1
                while i > 0 and tags[stack[i]] not in keep:
                    if tags[stack[i]] in ended:
                        del stack[i:]
                        break
                    i -= 1
            node = len(tags)
            self.parent.append(stack[-1])
            tags.append(name)
            self.named.append(_says(token["attrs"]))
            if name in VOID or token["attrs"].endswith("/") and name not in BLOCK:
                continue
            if name in RAW:
                close = re.compile(rf"</{re.escape(name)}[\s/>]", re.IGNORECASE).search(html, at)
                if close is None:
                    return
                at = close.start()
            stack.append(node)


def _says(attrs: str) -> int:
    """Whether the attributes name the element as something other than an article (1), comments above all (2); 3 if hidden."""
    if "=" not in attrs and "hidden" not in attrs:
        return 0
    if _HIDDEN.search(attrs):
        return 3
    words = {word.lower() for m in _NAME.finditer(attrs) for word in _WORD.findall(m[1] or m[2] or m[3] or "")}
    return 2 if words & TALK else int(not words.isdisjoint(NAMED))


def densities(page: Page, out: list[bool]) -> tuple[list[float], list[float]]:
    """Composite text density of each node, and the sum of its children's; ``out`` counts nothing."""
    n = len(page.tag)
    chars, tags, linked, links = [0] * n, [0] * n, [0] * n, [0] * n
    inside = [False] * n
    for i in range(1, n):
        inside[i] = inside[page.parent[i]] or page.tag[i] == "a"
    for node, _, text in page.texts:
        if not out[node]:
            size = sum(map(len, text.split()))
            chars[node] += size
            linked[node] += size * inside[node]
    for i in range(n - 1, 0, -1):
        up = page.parent[i]
        chars[up] += chars[i]
        linked[up] += linked[i]
        if not out[i]:
            tags[up] += tags[i] + 1
            links[up] += links[i] + (page.tag[i] == "a")
    body_share = linked[0] / max(chars[0], 1)
    density, sums = [0.0] * n, [0.0] * n
    for i in range(n - 1, 0, -1):
        c, lc = chars[i], linked[i]
        if not out[i] and c:
            base = log(c / max(c - lc, 1) * lc + body_share * c + e)
            arg = c / max(lc, 1) * max(tags[i], 1) / max(links[i], 1)
            density[i] = c / max(tags[i], 1) * (log(arg) / log(base) if base > 1 else log(arg))
            sums[page.parent[i]] += density[i]
    return density, sums


def main_blocks(html: str | None) -> list[str]:
    """The blocks of the main text, white space folded, in page order."""
    page = Page(html or "")
    parent, tag, n = page.parent, page.tag, len(page.tag)
    # What says it is something else is out, unless it holds the article. Where its place tells
    # nothing (inside the article or main, or on a page without), only what is small or mostly links.
    named = [page.named[i] if tag[i] not in ("html", "body", "main") and tag[i] not in HEADINGS else 0 for i in range(n)]
    size, linked, plain = [0] * n, [0] * n, [0] * n
    talk, link, title = [False] * n, [False] * n, [False] * n
    for i in range(1, n):
        talk[i] = talk[parent[i]] or named[i] == 2
        link[i] = link[parent[i]] or tag[i] == "a"
        title[i] = title[parent[i]] or tag[i] in HEADINGS
    for node, _, text in page.texts:
        words = sum(map(len, text.split()))
        size[node] += words
        linked[node] += words * link[node]
        plain[node] += words * (not title[node])
    # An article element with a name counts where it has the title.
    titled = [t == "h1" for t in tag]
    for i in range(n - 1, 0, -1):
        titled[parent[i]] |= titled[i]
    marks = [tag[i] in HOLDS and not talk[i] and not (tag[i] == "article" and named[i] and not titled[i]) for i in range(n)]
    if not any(marks):
        marks = [tag[i] in HOLDS and named[i] < 2 and not talk[parent[i]] for i in range(n)]
    if not any(marks):
        marks = [t in HOLDS for t in tag]
    holds = list(marks)
    for i in range(n - 1, 0, -1):
        if tag[i] not in RAW and tag[i] not in OUTSIDE:
            up = parent[i]
            size[up] += size[i]
            linked[up] += linked[i]
            plain[up] += plain[i]
            holds[up] |= holds[i]
    semantic = [marks[i] and tag[i] != "h1" for i in range(n)]
    elsewhere = any(semantic[i] and plain[i] for i in range(n))
    out, within, inner = [False] * n, [False] * n, [False] * n
    for i in range(1, n):
        within[i] = within[parent[i]] or tag[i] in ("article", "main")
        inner[i] = inner[parent[i]] or semantic[i]
        # Beside the article its place tells; what is said by readers is no article wherever one is.
        sure = (elsewhere and not inner[i]) or (named[i] == 2 and holds[0]) or named[i] == 3
        veto = named[i] and not holds[i] and (sure or 2 * size[i] < size[0] or 2 * linked[i] > size[i])
        header = tag[i] == "header" and not within[i]
        out[i] = out[parent[i]] or tag[i] in OUTSIDE or header or bool(veto)
    density, sums = densities(page, out)
    best = max(range(n), key=lambda i: (sums[i], -i))
    if sums[best] <= 0:
        best = max(range(n), key=lambda i: (density[i], -i))
    # The semantic element around the densest part is the article as a whole.
    up = best
    while up > 0 and tag[up] not in ("article", "main"):
        up = parent[up]
    whole = up > 0
    best = up if whole else best
    least, up = density[best] if best else 0.0, best
    while up > 0 and tag[up] not in ("body", "html"):
        least = min(least, density[up])
        up = parent[up]
    if up > 0:
        least = min(least, density[up])
    # Largest sum below each node, then top down: a node that reaches the threshold brings it in.
    top = list(range(n))
    for i in range(n - 1, 0, -1):
        if not out[i] and sums[top[i]] > sums[top[parent[i]]]:
            top[parent[i]] = top[i]
    chosen = [False] * n
    chosen[best] = True
    if not whole:
        for i in range(1, n):
            if not out[i] and density[i] >= least > 0:
                chosen[top[i]] = True
    blocks: list[str] = []
    last = None
    for i in range(1, n):
        chosen[i] = chosen[i] or chosen[parent[i]]
    for node, block, text in page.texts:
        if chosen[node] and not out[node]:
            if block == last:
                blocks[-1] += text
            else:
                blocks.append(text)
                last = block
    return [b for b in (" ".join(x.split()) for x in blocks) if b]


def main_text(df: DataFrame, keys: list[str], html_col: str) -> DataFrame:
    """The key columns and blocks array<string> of every page."""
    pages = df.select(F.struct(*[column(df, k) for k in keys]).alias("keys"), column(df, html_col).alias("html"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        blocks = [main_blocks(html) for html in batch.column("html").to_pylist()]
        return pa.record_batch([batch.column("keys"), pa.array(blocks, pa.list_(pa.string()))], ["keys", "blocks"])

    kind = pages.schema["keys"].dataType.simpleString()
    return map_slices(pages, work, f"keys {kind}, blocks array<string>", "html").select("keys.*", "blocks")
