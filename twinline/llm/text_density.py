"""Main text of HTML pages by composite text density."""

from __future__ import annotations

import html as entities
import math
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

TOKEN = re.compile(
    r"""<!--.*?(?:--!?>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>?""", re.DOTALL
)
ATTRIBUTE = re.compile(r"""([^\s=/"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr b bdi bdo big cite code del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr br".split()
)
# Elements whose start ends an open paragraph.
ENDS_P = frozenset(
    """address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header
    hgroup hr main menu nav ol p pre search section table ul""".split()
)
# An open element of the value ends where the key starts, within the nearest of the scopes.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
# Elements that are never main text, and words in class, id or role that mark such parts (fixed values).
NEVER = frozenset(
    """head script style noscript template nav footer aside form button select option input textarea iframe object svg canvas audio
    video map dialog menu title xmp noembed noframes""".split()
)
MARKS = frozenset(
    """ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice
    notices popup modal overlay newsletter subscribe subscription signup sidebar sidebars widget widgets nav navbar navigation menu
    menus breadcrumb breadcrumbs footer masthead comment comments commentlist disqus reply replies respond discussion related
    recommended recommendations share sharing social toolbar login search pagination pager skip complementary contentinfo alert
    alertdialog""".split()
)
# Those that mean little beside other words, as in share-price or search-results.
VAGUE = frozenset(
    """alert discussion login menu menus navigation notice notices overlay pager related reply replies respond search share sharing skip
    social subscription toolbar widget widgets""".split()
)
# Names of reader comments: whole, or before a hyphen or underscore.
COMMENTS = re.compile(r"(?:comments?|comment-?list|disqus|replies|respond)(?:[-_].*)?", re.IGNORECASE)
# How sure a mark is: not at all, a vague word among others, another word, a whole class or role, reader comments, the tag of a
# page's head, in every case.
NOT_MARKED, BY_VAGUE_WORD, BY_WORD, BY_TOKEN, BY_COMMENT, BY_TAG, ALWAYS = range(7)
HEADS = frozenset(["header", "heading", "topbar"])
# Never dropped for their marks: they hold the page or the article.
HOLDERS = frozenset(["html", "body", "article", "main"])
CONTAINERS = frozenset("body article main section div td center blockquote figure details html dd li table tbody tr ul ol dl root".split())


class Page:
    """The elements of a page in page order, and the text blocks that are not marked as something else."""

    def __init__(self, html: str):
        self.tag, self.parent, self.dropped = ["root"], [-1], [False]
        self.marked, self.inside = [NOT_MARKED], [False]
        self.texts: list[tuple[int, str]] = []
        self.stack = [0]
        self.depths: defaultdict[str, list[int]] = defaultdict(list)  # where elements of a name are on the stack
        at, low = 0, None
        for token in iter(lambda: TOKEN.search(html, at), None):
            if token.start() > at:
                self._text(html[at : token.start()])
            at = token.end() if token.end() > token.start() else token.start() + 1
            name = token[2]
            if name is None:
                continue
            name = name.lower()
            if token[1]:
                self._end(name)
                continue
            self._start(name, token[3])
            if name in RAW:
                if low is None:
                    low = html.lower() if len(html.lower()) == len(html) else re.sub("[A-Z]+", lambda m: m[0].lower(), html)
                close = low.find(f"</{name}", at)
                at = close if close >= 0 else len(html)
        if at < len(html):
            self._text(html[at:])
        self._drop()

    def _text(self, text: str) -> None:
        self.texts.append((self.stack[-1], entities.unescape(text) if "&" in text else text))

    def _start(self, name: str, attributes: str) -> None:
        if name in ("html", "body") and self.depths[name]:
            return
        if name in ENDS_P:
            self._close({"p"}, {"td", "th", "button", "table", "article", "section", "div", "li", "blockquote"})
        if name in SIBLINGS:
            self._close(*SIBLINGS[name])
        up = self.stack[-1]
        node = len(self.tag)
        self.tag.append(name)
        self.parent.append(up)
        self.dropped.append(False)
        self.inside.append(self.inside[up] or self.tag[up] in ("article", "main"))
        self.marked.append(self._mark(name, attributes, self.inside[node]))
        if name not in VOID and not attributes.rstrip().endswith("/"):
            self.depths[name].append(len(self.stack))
            self.stack.append(node)
        if name == "br":
            self.texts.append((node, " "))
        elif name not in INLINE:
            self.texts.append((node, ""))  # text before and after it are blocks of their own

    def _mark(self, name: str, attributes: str, inside: bool) -> int:
        """How sure tag and attributes are that an element is no main text."""
        if name in NEVER:
            return BY_WORD if name == "form" else ALWAYS
        if name == "header" and not inside:
            return BY_TAG
        mark = NOT_MARKED
        for m in ATTRIBUTE.finditer(attributes) if attributes.strip() else ():
            key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
                return ALWAYS
            if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                return ALWAYS
            if key in ("class", "id", "role") and name not in ("html", "body", "main"):
                if any(map(COMMENTS.fullmatch, value.split())):
                    mark = BY_COMMENT
                if name == "article":
                    continue
                if key != "id" and MARKS.intersection(value.lower().split()):
                    mark = max(mark, BY_TOKEN)
                words = {w.lower() for w in WORD.findall(value)} & (MARKS if inside else MARKS | HEADS)
                if words:
                    mark = max(mark, BY_VAGUE_WORD if words <= VAGUE else BY_WORD)
        return mark

    def _drop(self) -> None:
        """Drop marked elements with all they hold.

        Reader comments go whatever their length, unless they hold an article (but a comment), main or h1. For words of other kinds
        nothing goes that holds one, or most of the page's unlinked characters. Vague words, and inside an article all that are
        not a whole class or role, count only where the element is mostly links or thinner than the article, or than the page.
        """
        n = len(self.tag)
        never = [False] * n
        for i in range(1, n):
            never[i] = never[self.parent[i]] or self.marked[i] == ALWAYS
        chars, tags, linked, holds, in_link = [0] * n, [1] * n, [0] * n, [False] * n, [False] * n
        for i in range(1, n):
            in_link[i] = in_link[self.parent[i]] or self.tag[i] == "a"
        for i, text in self.texts:
            if not never[i]:
                size = sum(map(len, text.split()))
                chars[i] += size
                linked[i] += size if in_link[i] else 0
        for i in range(n - 1, 0, -1):
            if not never[i]:
                up = self.parent[i]
                chars[up] += chars[i]
                linked[up] += linked[i]
                tags[up] += tags[i]
                own = self.tag[i] in ("article", "main", "h1") and self.marked[i] != BY_COMMENT
                holds[up] |= holds[i] or own
        article = [0] * n  # nearest article or main around each element
        for i in range(1, n):
            up = self.parent[i]
            article[i] = up if self.tag[up] in ("article", "main") else article[up]
            self.dropped[i] = self.dropped[up] or never[i]
            if self.dropped[i] or self.marked[i] == NOT_MARKED:
                continue
            if self.marked[i] == BY_TAG:
                self.dropped[i] = True
            elif self.marked[i] == BY_COMMENT:
                self.dropped[i] = not holds[i]
            elif not holds[i] and 2 * (chars[i] - linked[i]) <= chars[0] - linked[0]:
                sure = self.marked[i] == BY_TOKEN or self.tag[i] == "form" or not self.inside[i] and self.marked[i] == BY_WORD
                outer = article[i]
                thin = chars[i] * tags[outer] < chars[outer] * max(1, tags[i] - 1)  # its own tag does not make it thinner
                self.dropped[i] = sure or thin or 2 * linked[i] > chars[i]

    def _innermost(self, names: Iterable[str]) -> int:
        """Where the innermost open element of one of these names is on the stack; 0 if none is open."""
        return max((self.depths[name][-1] for name in names if self.depths.get(name)), default=0)

    def _cut(self, depth: int) -> None:
        """End the elements from this place of the stack on."""
        for node in self.stack[depth:]:
            self.depths[self.tag[node]].pop()
        del self.stack[depth:]

    def _close(self, names: set[str], scopes: set[str]) -> None:
        depth = self._innermost(names)
        if depth and depth > self._innermost(scopes - names):
            self._cut(depth)

    def _end(self, name: str) -> None:
        depth = self._innermost((name,))
        if depth:
            self._cut(depth)

    def densities(self) -> tuple[list[float], list[float]]:
        """Composite text density of each element, and the sum of its children's."""
        n = len(self.tag)
        chars, tags, linked, links = [0] * n, [0] * n, [0] * n, [0] * n
        in_link = [False] * n
        for i in range(1, n):
            in_link[i] = in_link[self.parent[i]] or self.tag[i] == "a"
        for i, text in self.texts:
            if not self.dropped[i]:
                size = sum(map(len, text.split()))
                chars[i] += size
                if in_link[i]:
                    linked[i] += size
        for i in range(n - 1, 0, -1):
            if self.dropped[i]:
                continue
            up = self.parent[i]
            chars[up] += chars[i]
            linked[up] += linked[i]
            tags[up] += tags[i] + 1
            links[up] += links[i] + (self.tag[i] == "a")
        total = max(1, chars[0])
        density, sums = [0.0] * n, [0.0] * n
        for i in range(n - 1, -1, -1):
            if chars[i] and not self.dropped[i]:
                c, t, lc, lt = chars[i], max(1, tags[i]), max(1, linked[i]), max(1, links[i])
                base = math.log(c / max(1, c - linked[i]) * linked[i] + linked[0] / total * c + math.e)
                spread = max(0.0, math.log(c / lc * t / lt))
                density[i] = c / t * (spread / math.log(base) if base > 1.001 else 1.0 + spread)
            if i:
                sums[self.parent[i]] += density[i]
        return density, sums

    def main(self) -> set[int]:
        """Roots of the main text: the container of the largest sum, and others as dense as its path to the root."""
        density, sums = self.densities()
        n = len(self.tag)
        able = [not self.dropped[i] and self.tag[i] in CONTAINERS for i in range(n)]
        top = max(range(n), key=lambda i: (able[i], sums[i], -i))
        while self.tag[top] not in ("article", "main", "body", "root") and self.tag[self.parent[top]] in ("article", "main"):
            top = self.parent[top]
        least, i = density[top], top
        while i > 0:
            least = min(least, density[i])
            i = self.parent[i]
        within = [-1] * n  # best container below each element
        for i in range(n - 1, -1, -1):
            if able[i] and (within[i] < 0 or sums[i] >= sums[within[i]]):
                within[i] = i
            up = self.parent[i]
            if i and within[i] >= 0 and (within[up] < 0 or sums[within[i]] > sums[within[up]]):
                within[up] = within[i]
        chosen = {top}
        for i in range(1, n):
            if able[i] and density[i] >= least and density[i] > 0 and within[i] >= 0:
                chosen.add(within[i])
        return chosen

    def text(self) -> str:
        chosen = self.main()
        inside = [False] * len(self.tag)
        block = [0] * len(self.tag)
        for i in range(len(self.tag)):
            up = self.parent[i]
            inside[i] = i in chosen or i > 0 and inside[up]
            block[i] = block[up] if self.tag[i] in INLINE and i else i
        blocks: list[list[str]] = []
        last = None
        for i, text in self.texts:
            if self.dropped[i]:
                last = None if self.tag[i] not in INLINE else last
                continue
            if not inside[i]:
                continue
            if block[i] != last:
                blocks.append([])
                last = block[i]
            blocks[-1].append(text)
        joined = (" ".join("".join(b).split()) for b in blocks)
        return "\n".join(b for b in joined if b)


def main_text(html: str | None) -> str:
    """Main text of a page, blocks joined by line feeds; empty for null and pages without text."""
    return Page(html).text() if html else ""


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages(page_id, url, html)``.

    Elements that say what they are (menus, footers, forms, scripts, adverts, comments and so on, by tag, class, id or role) are
    left out, reader comments whatever their length. A form or a word of class, id or role does not count where the element holds an
    article, a heading h1 or (comments aside) most of the page's unlinked text, nor, if the word is vague or part of a name inside an
    article, where the text is as dense as the rest. For the others the density of characters per tag, adjusted for links, is summed over children; the container of
    the largest sum and any other as dense as the thinnest element on its path to the root are the main text.

    Null html is empty, unclosed and cut tags end where HTML ends them, whole pages are read whatever their length. Rows are
    judged each on its own, nulls in other columns stay. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(F.col("page_id").cast("bigint"), "url", "html")
    return rows.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
