"""Main text of web pages by composite text density.

For every element of a page's DOM the density is its characters for each tag, adjusted by the characters
and tags that stand in links (Sun, Song and Liao, "DOM based content extraction via text density").  An
element's density sum adds up the densities of its children.  The element with the largest sum is the
core of the article; the smallest density on its path up to the body is the page's threshold.

* Elements that can't be article text go before densities are taken: scripts, styles, forms, ``nav``,
  ``footer``, ``aside`` and the like, hidden ones, and those whose class, id or role names a menu, header,
  sidebar, notice, advert or reader comments.  A header inside an article keeps its headings only.
* If a page has ``article`` elements with text (else ``main``), the core is searched in those, and the
  whole element around it is the article.  Otherwise the article is the core, the headings right above it,
  and those of its siblings with the same tag and class, or headings, that reach the threshold.
* Link lists below the threshold are left out of the article.

A page is parsed and measured inside one row; nothing is shuffled.  Tag soup is read as a browser would:
implied end tags, raw text of scripts, end tags that match nothing.  The work is linear in the page.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import map_batches

#: Fixed element lists of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
IN_HEAD = frozenset("title meta link style script base noscript template".split())
BLOCK = HEADINGS | frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
#: Elements that are never article text.
DROPPED = frozenset(
    "aside audio button canvas dialog embed footer form head iframe input menu nav noembed noframes noscript object "
    "script select style svg template textarea title video".split())
#: Words in a class, id or role that mark an element as no article text; the first set also on ``article``.
REMARKS = frozenset("ad ads advert advertisement adverts adsbygoogle comment comments disqus promo related reply replies "
                    "respond sponsor sponsored teaser".split())
MARKS = REMARKS | frozenset(
    "alert banner breadcrumb breadcrumbs complementary consent contentinfo cookie cookies copyright dialog footer gdpr "
    "login masthead menu menubar modal nav navbar navigation newsletter notice notices overlay pager pagination popular "
    "popup promotion rail recommended search share sharing sidebar signup skip social subscribe subscription toolbar "
    "topbar trending widget widgets".split())
HEADER = frozenset(["header"])
OWN_HEADER = frozenset("article content entry post story".split())
NEGATED = frozenset("has hide is no show with without".split())

_TAG = re.compile(r"""<(/?)([A-Za-z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+|))*+)>""")
_MARKED = re.compile(r"""(?:^|[\s"'/])(class|id|role|itemprop|hidden|aria-hidden|style)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?""",
                     re.IGNORECASE)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SPACE = re.compile(r"[\x20\x09-\x0D]+")
_CELLS = frozenset(["td", "th", "table"])
_LISTS = frozenset(["ul", "ol", "menu", "dir"])

#: What an end tag may not close across, and which open element a start tag closes (within which bounds).
_BOUNDS = {"p": BLOCK - {"p"}, "li": _LISTS, "dd": frozenset(["dl"]), "dt": frozenset(["dl"])} | {
    t: frozenset(["table"]) for t in ("td", "th", "tr", "tbody", "thead", "tfoot")}
_CLOSES = {"li": (["li"], _LISTS), "dd": (["dd", "dt"], frozenset(["dl"])), "dt": (["dd", "dt"], frozenset(["dl"])),
           "td": (["td", "th"], frozenset(["table", "tr"])), "th": (["td", "th"], frozenset(["table", "tr"])),
           "tr": (["tr"], frozenset(["table", "tbody", "thead", "tfoot"])), "option": (["option"], frozenset(["select"])),
           "tbody": (["tbody", "thead"], frozenset(["table"])), "tfoot": (["tbody", "thead"], frozenset(["table"]))}
_BREAK, _LINE = object(), object()


class Dom:
    """Elements in page order (so a subtree is a range), with the text items between their tags."""

    def __init__(self, page: str):
        self.name, self.parent, self.end, self.attrs = ["#root"], [0], [0], [""]
        self.first, self.last = [0], [0]            # range of an element's items
        self.items: list[tuple[int, object]] = []   # (element, text, block break or line break)
        self.stack, self.open = [0], Counter()
        self._read(page)
        self._close(0)

    def _close(self, depth: int) -> None:
        while len(self.stack) > depth:
            i = self.stack.pop()
            if self.name[i] in BLOCK:
                self.items.append((i, _BREAK))
            self.end[i], self.last[i] = len(self.name), len(self.items)
            self.open[self.name[i]] -= 1

    def _depth(self, names, bounds) -> int | None:
        """Depth of the innermost open element of ``names`` that no element of ``bounds`` hides."""
        if not any(self.open[n] > 0 for n in names):
            return None
        for depth in range(len(self.stack) - 1, 0, -1):
            at = self.name[self.stack[depth]]
            if at in names:
                return depth
            if at in bounds:
                return None
        return None

    def _start(self, tag: str, attrs: str) -> None:
        if tag in ("html", "body") and self.open[tag] > 0:
            return
        if self.open["head"] > 0 and tag not in IN_HEAD:
            self._end("head")
        if tag == "br":
            self.items.append((self.stack[-1], _LINE))
            return
        if tag in BLOCK and (depth := self._depth(("p",), _BOUNDS["p"])) is not None:
            self._close(depth)
        if tag in _CLOSES and (depth := self._depth(*_CLOSES[tag])) is not None:
            self._close(depth)
        i = len(self.name)
        for column, value in ((self.name, tag), (self.parent, self.stack[-1]), (self.end, i + 1), (self.attrs, attrs),
                              (self.first, len(self.items)), (self.last, len(self.items))):
            column.append(value)
        if tag in BLOCK:
            self.items.append((i, _BREAK))
        if tag not in VOID:
            self.stack.append(i)
            self.open[tag] += 1

    def _end(self, tag: str) -> None:
        if tag in ("html", "body"):                 # text behind them still belongs to the body
            return
        bounds = _BOUNDS.get(tag) or (_CELLS - {tag} if tag in BLOCK else BLOCK)
        if (depth := self._depth((tag,), bounds)) is not None:
            self._close(depth)

    def _text(self, text: str) -> None:
        if text:
            self.items.append((self.stack[-1], entities.unescape(text) if "&" in text else text))

    def _read(self, page: str) -> None:
        start = at = 0
        last = page.rfind(">")
        comments = True                             # a comment's end lies ahead
        while 0 <= (at := page.find("<", at)) < last:
            tag = None
            if page.startswith("<!--", at) and comments:
                to = page.find("-->", at + 4) + 3
                comments = to > 2
                if not comments:
                    continue
            elif (tag := _TAG.match(page, at)) is not None:
                to = tag.end()
            elif page[at + 1] in "!?/":
                to = page.find(">", at) + 1
            else:
                at += 1
                continue
            self._text(page[start:at])
            if tag is not None:
                name = tag[2].lower()
                if tag[1]:
                    self._end(name)
                else:
                    self._start(name, tag[3])
                    if name in RAW:
                        closing = re.compile(f"</{name}(?=[\\s/>])", re.IGNORECASE).search(page, to)
                        to = closing.start() if closing else len(page)
            start = at = to
        self._text(page[start:])


def _labels(attrs: str) -> tuple[frozenset, bool]:
    """Words of an element's class, id and role, and whether the element is hidden."""
    words, hidden = [], False
    for name, value in _MARKED.findall(attrs):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden":
            hidden |= value != "until-found"
        elif name == "aria-hidden":
            hidden |= value.lower() == "true"
        elif name == "style":
            hidden |= "display:none" in value.replace(" ", "").lower()
        else:
            for part in value.split():
                split = [w.lower() for w in _WORDS.findall(part)]
                words += [w for k, w in enumerate(split) if not (k and split[k - 1] in NEGATED)]
    return frozenset(words), hidden


def _dropped(dom: Dom, marks: bool) -> list[int]:
    """For each element: 0 article text is possible, 1 dropped, 2 in a header (headings only)."""
    n = len(dom.name)
    total, has_main, has_title = [0] * n, [False] * n, [False] * n
    for i, text in dom.items:
        if text is not _BREAK and text is not _LINE:
            total[i] += len(text.strip())
    for i in range(n - 1, 0, -1):
        p = dom.parent[i]
        if dom.name[i] in DROPPED and dom.name[i] != "form":
            total[i] = 0
        total[p] += total[i]
        has_main[p] |= has_main[i] or dom.name[i] == "main"
        has_title[p] |= has_title[i] or dom.name[i] in ("h1", "article")
    state, inside = [0] * n, [False] * n
    for i in range(1, n):
        p, tag = dom.parent[i], dom.name[i]
        inside[i] = inside[p] or tag in ("article", "main")
        if state[p] == 1:
            state[i] = 1
            continue
        state[i] = 0 if tag in HEADINGS else state[p]
        words, hidden = _labels(dom.attrs[i]) if marks and dom.attrs[i] else (frozenset(), False)
        wrapper = has_main[i] or (has_title[i] and 2 * total[i] > total[0] and not words & REMARKS)
        if tag in DROPPED:
            # a form around nearly all of the page is a frame of it, not a form to fill in
            state[i] = 0 if tag == "form" and (wrapper or 10 * total[i] >= 9 * total[0] > 0) else 1
        elif hidden and not wrapper:
            state[i] = 1
        elif tag == "header" or (words & HEADER and not wrapper):
            state[i] = 2 if inside[p] or words & OWN_HEADER else 1
        elif words & (REMARKS if tag in ("article", "main") else MARKS) and tag not in ("html", "body") and not wrapper:
            state[i] = 1
    return state


def _densities(dom: Dom, state: list[int]) -> tuple[list[int], list[int], list[int], list[float], list[float]]:
    """Characters, characters in links, links, composite density and density sum of every element."""
    n = len(dom.name)
    chars, linked, tags, links = [0] * n, [0] * n, [0] * n, [0] * n
    for i, text in dom.items:
        if not state[i] and text is not _BREAK and text is not _LINE:
            chars[i] += len(_SPACE.sub(" ", text).strip(" "))
    for i in range(n - 1, 0, -1):
        if state[i] == 1:
            continue
        p = dom.parent[i]
        if dom.name[i] == "a":
            linked[i] = chars[i]
            links[i] += 1
        chars[p] += chars[i]
        linked[p] += linked[i]
        tags[p] += tags[i] + 1
        links[p] += links[i]
    ratio = linked[0] / max(1, chars[0])
    density, added = [0.0] * n, [0.0] * n
    for i in range(n):
        c, t = chars[i], max(1, tags[i])
        if c and state[i] != 1:
            base = math.log(c / max(1, c - linked[i]) * linked[i] + ratio * c + math.e)
            inner = c / max(1, linked[i]) * t / max(1, links[i])
            density[i] = c / t * (math.log(max(1.0, inner)) / math.log(base) if base > 1 else math.log(max(1.0, inner)))
            if dom.end[i] == i + 1:
                added[i] = density[i]
    for i in range(n - 1, 0, -1):
        if state[i] != 1:
            added[dom.parent[i]] += density[i]
    return chars, linked, links, density, added


def _article(dom: Dom, state: list[int]) -> list[int]:
    """Elements whose subtrees are the article, with link lists marked as dropped in ``state``."""
    chars, linked, links, density, added = _densities(dom, state)
    if not chars[0]:
        return []
    n = len(dom.name)
    inside = [i for i in range(n) if state[i] == 0 and chars[i] and dom.name[i] == "article"]
    inside = inside or [i for i in range(n) if state[i] == 0 and chars[i] and dom.name[i] == "main"]
    outer, reach = [], 0
    for i in inside:
        if i >= reach:
            outer.append(i)
            reach = dom.end[i]
    best = max(((added[j], -j) for i in outer or [0] for j in range(i, dom.end[i]) if state[j] != 1))
    core = -best[1]
    path = [core]
    while path[-1] and dom.name[path[-1]] != "body":
        path.append(dom.parent[path[-1]])
    threshold = min(density[i] for i in path if density[i] > 0 or i == core)
    around = [i for i in outer if i <= core < dom.end[i]]
    if around or not core:
        found = around or [core]
    else:
        up, like = dom.parent[core], (dom.name[core], dom.attrs[core].strip())
        beside = [i for i in range(up + 1, dom.end[up]) if dom.parent[i] == up and chars[i] and state[i] == 0]
        found = [i for i in beside if i == core or (density[i] >= threshold and (
            (dom.name[i], dom.attrs[i].strip()) == like or dom.name[i] in HEADINGS))]
        k = beside.index(core) - 1
        while k >= 0 and dom.name[beside[k]] in HEADINGS:           # the headings right above it
            found.append(beside[k])
            k -= 1
        found = sorted(set(found))
    for root in found:
        for i in range(root + 1, dom.end[root]):
            if state[dom.parent[i]] == 1:
                state[i] = 1
            elif (dom.name[i] in ("ul", "ol", "div", "table") and links[i] >= 3 and 10 * linked[i] >= 9 * chars[i]
                    and density[i] < threshold):
                state[i] = 1
    return found


def _blocks(dom: Dom, state: list[int], roots: list[int]) -> Iterator[str]:
    for root in roots:
        pieces: list[str] = []
        line = False                                # a line break, and no text since
        for i, item in [*dom.items[dom.first[root]:dom.last[root]], (root, _BREAK)]:
            if item is _BREAK or (item is _LINE and line):
                if block := _SPACE.sub(" ", "".join(pieces)).strip(" "):
                    yield block
                pieces, line = [], False
            elif item is _LINE:
                pieces.append("\n")
                line = True
            elif state[i] == 0:
                pieces.append(item)
                line = line and not _SPACE.sub("", item)


def main_text(page: str | None) -> str:
    """Main text of one page, its blocks joined by line feeds; empty for null and for pages without text."""
    if not page:
        return ""
    dom = Dom(page)
    for marks in (True, False):                     # marks that leave nothing are not believed
        state = _dropped(dom, marks)
        if text := "\n".join(_blocks(dom, state, _article(dom, state))):
            return text
    return ""


def extract(pages: DataFrame, html_col: str = "html", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (default ``page_id``, ``url``) of every row, then ``text`` and ``n_chars``.

    Null and empty html, and pages without any text, give an empty text and 0.  Rows with equal html give
    equal texts; repeated rows all stay.  Line breaks (``br``) are white space inside a block, two in a row
    end it.  An empty table gives no rows; other columns aren't read.
    """
    keep = ["page_id", "url"] if keep is None else keep
    source = pages.select(*keep, F.col(html_col).alias("_html"))
    schema = source.select(*keep, F.lit("").alias("text"), F.lit(0).cast("long").alias("n_chars")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*keep, "text", "n_chars"]
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(len(keep))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(keep)], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names)

    return map_batches(source, run, schema)


def oracle() -> str:
    """DuckDB SQL that cuts the texts out of pages whose article is one bare ``article`` element with ``h1``,
    ``p``, ``b`` and ``br`` only, as in the driver's tables; other pages need the DOM."""
    return r"""
WITH a AS (SELECT page_id, url, regexp_replace(regexp_replace(regexp_extract(coalesce(html, ''), '<article>(.*?)</article>', 1, 's'),
                  '</?b>', '', 'g'), '<br>', ' ', 'g') AS a FROM pages),
b AS (SELECT page_id, url, list_transform(string_split_regex(a, '</?(?:p|h1)>'), lambda x:
        trim(regexp_replace(regexp_replace(replace(replace(replace(replace(x, '&quot;', '"'), '&#x27;', chr(39)), '&lt;', '<'), '&gt;', '>'),
             '&amp;?', '&', 'g'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ')) AS b FROM a),
t AS (SELECT page_id, url, array_to_string(list_filter(b, lambda x: x <> ''), chr(10)) AS text FROM b)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM t"""
