"""Main text of web pages by tag-path ratios.

A page is cut into blocks of text, each with its root-to-leaf path of block tags. Per
path, text length and punctuation are summed and divided by the path's blocks; links
count as no text. Along the page both ratios are smoothed over neighbouring blocks and
fused by product; paths whose mean reaches a share of the spread are content paths.
Blocks in the element that holds the content paths (an article or main element, or
else the parents of content blocks) are the text if their path is a content path, or if
they follow or precede such blocks without links or cues between. A cue word in class, id
or role of a block element lowers the score of all paths through it. Menus, footers, forms
and the like by tag, hidden elements and inline elements with a cue are no candidates.

Every page is one row of one task: no page depends on another, so nothing shuffles.

Defined results: null html is empty; a page without content gives an empty text;
unclosed and crossed tags close as browsers close them; repeated rows give repeated
rows; an empty table gives an empty result. Columns named like a new one are replaced.
"""

from __future__ import annotations

import html
import math
import re
from statistics import pstdev

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presswork.llm.common import carried, read

#: Share of the scores' spread that a content path's mean must reach.
LAMBDA = 0.5
#: Factor of a path's score for every cue word's element on it; share of the best path's mean that content must reach.
CUED, SHARE = 0.1, 0.15
#: Weights of a block and its neighbours at distance one and two.
KERNEL = (0.5, 0.2, 0.05)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup.
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section "
    "select summary table tbody td tfoot th thead tr ul".split()
)
NO_TEXT = frozenset(
    "aside button dialog footer form head iframe menu nav noscript object option script select style svg template "
    "textarea title".split()
)
#: A start tag closes open elements of these names, up to the nearest element of the second set.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"table"}), "th": ({"td", "th"}, {"table"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
CUES = frozenset(
    "ad ads advert adverts advertisement adslot banner sponsor sponsored promo promotion sidebar menu nav navbar "
    "navigation breadcrumb breadcrumbs footer cookie cookies consent gdpr notice alert popup modal overlay newsletter "
    "subscribe signup login share sharing social related recommended comment comments commentlist disqus respond reply "
    "replies widget toolbar masthead pagination pager complementary contentinfo search".split()
)
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S
)
_CUE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_HIDDEN = re.compile(r"\bhidden\b(?!\s*-)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_WORDS = re.compile(r"[^a-z0-9]+")
_PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？]")


class Block:
    """Text between two block boundaries."""

    __slots__ = ("path", "parent", "home", "cues", "pieces", "linked", "text")

    def __init__(self, path: tuple, parent: int, home: int, cues: int) -> None:
        self.path, self.parent, self.home, self.cues, self.pieces, self.linked = (cues, *path), parent, home, cues, [], 0


def _excluded(name: str, attributes: str, inside: bool) -> bool:
    if name in NO_TEXT or name == "header" and not inside:
        return True
    if not attributes or name in ("html", "body", "article", "main") and not _HIDDEN.search(attributes):
        return name == "article" and _cued(attributes, {"comment", "reply"})
    return bool(_HIDDEN.search(attributes)) or name not in BLOCK and _cued(attributes, CUES)


def _cued(attributes: str, cues) -> bool:
    for match in _CUE.finditer(attributes):
        value = match[2] or match[3] or match[4] or ""
        if not cues.isdisjoint(_WORDS.split(value.lower())):
            return True
    return False


def blocks(page: str) -> list[Block]:
    """The candidate blocks of a page, in page order."""
    out: list[Block] = []
    # open elements: name, number, excluded, block path, nearest block's number, home (article or main), cues
    stack = [("", 0, False, (), 0, 0, 0)]
    number, at, links, now = 0, 0, 0, None

    def text(piece: str) -> None:
        nonlocal now
        _, _, gone, path, parent, home, cues = stack[-1]
        if gone:
            return
        if now is None:
            if not piece or piece.isspace():
                return
            now = Block(path, stack_parent(), home, cues)
        now.pieces.append(piece)
        if links:
            now.linked += len(piece.strip())

    def stack_parent() -> int:
        """Number of the block element around the innermost one."""
        seen = 0
        for name, n, *_ in reversed(stack):
            if name in BLOCK:
                seen += 1
                if seen == 2:
                    return n
        return 0

    def close() -> None:
        nonlocal now
        if now is not None:
            now.text = " ".join(html.unescape("".join(now.pieces)).split())
            if 2 * now.linked >= len(now.text):
                now.path = (*now.path, "a")
            if now.text:
                out.append(now)
            now = None

    def pop(name: str, until=frozenset()) -> bool:
        nonlocal links
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] == name:
                if any(x[0] in BLOCK for x in stack[i:]):
                    close()
                links -= sum(x[0] == "a" for x in stack[i:])
                del stack[i:]
                return True
            if stack[i][0] in until:
                return False
        return False

    size = len(page)
    while at < size:
        start = page.find("<", at)
        if start < 0:
            text(page[at:])
            break
        match = _TAG.match(page, start)
        if match is None:
            # a lone "<" is text; an unfinished tag ends at the next ">"
            end = page.find(">", start) if page[start + 1 : start + 2].isalpha() or page[start + 1 : start + 2] == "/" else -1
            if end < 0:
                text(page[at : start + 1])
                at = start + 1
            else:
                text(page[at:start])
                at = end + 1
            continue
        if start > at:
            text(page[at:start])
        at = match.end()
        name = match[2]
        if name is None:
            continue
        name = name.lower()
        if match[1]:
            if name == "p" and not any(x[0] == "p" for x in stack):
                close()
            elif name == "br":
                text(" ")
            else:
                pop(name, frozenset() if name in BLOCK else BLOCK)
            continue
        if name in BLOCK:
            pop("p", BLOCK - {"p"})
            if name in CLOSES:
                names, until = CLOSES[name]
                for other in names:
                    pop(other, until)
            close()
        if name in VOID:
            if name == "br" or name == "hr":
                text(" ")
            continue
        if match[3].endswith("/") and name not in BLOCK and name not in RAW:
            continue
        if name == "a":
            pop("a", BLOCK)
            links += 1
        number += 1
        _, _, gone, path, parent, home, cues = stack[-1]
        gone = gone or _excluded(name, match[3], home > 0)
        if not gone and not home and (name in ("article", "main") or _cued(match[3], {"articlebody"}) or 'role="main"' in match[3]):
            home = number
        if name in BLOCK:
            path = (*path[-30:], name)
            cues += name not in ("html", "body", "article", "main") and _cued(match[3], CUES)
        if name in RAW:
            end = re.compile(rf"</{name}\s*>?", re.I).search(page, at)
            at = end.end() if end else size
            links -= name == "a"
            continue
        stack.append((name, number, gone, path, number if name in BLOCK else parent, home, cues))
    close()
    return out


def _smooth(values: list[float]) -> list[float]:
    out = []
    for i in range(len(values)):
        total = weight = 0.0
        for d in range(-2, 3):
            if 0 <= i + d < len(values):
                total += KERNEL[abs(d)] * values[i + d]
                weight += KERNEL[abs(d)]
        out.append(total / weight)
    return out


def _with_neighbours(inside: list[Block], content: set[tuple]) -> list[Block]:
    """Blocks of content paths, and those between or beside them up to links or deeper cues."""
    least = min((b.cues for b in inside if b.path in content), default=0)
    keep = [b.path in content for b in inside]
    for order in (range(len(inside)), range(len(inside) - 1, -1, -1)):
        near = False
        for i in order:
            near = keep[i] or near and 2 * inside[i].linked < len(inside[i].text) and inside[i].cues <= least
            keep[i] = near
    return [b for b, k in zip(inside, keep) if k]


def main_text(page: str) -> str:
    found = blocks(page)
    if not found:
        return ""
    sums: dict[tuple, list[float]] = {}
    for b in found:
        mine = sums.setdefault(b.path, [0, 0.0, 0.0])
        own = max(0, len(b.text) - b.linked)
        mine[0] += 1
        mine[1] += own
        mine[2] += len(_PUNCTUATION.findall(b.text)) * own / len(b.text)
    ratio = _smooth([math.log1p(sums[b.path][1] / sums[b.path][0]) for b in found])
    points = _smooth([math.log1p(sums[b.path][2] / sums[b.path][0]) for b in found])
    fused = [r * (0.5 + p) * CUED**b.cues if sums[b.path][1] else 0.0 for b, r, p in zip(found, ratio, points)]
    means: dict[tuple, list[float]] = {}
    for b, s in zip(found, fused):
        means.setdefault(b.path, []).append(s)
    mean = {p: sum(each) / len(each) for p, each in means.items()}
    threshold = max(LAMBDA * pstdev(fused), SHARE * max(mean.values()))
    content = {p for p, m in mean.items() if m > 0 and m >= threshold}
    weight: dict[int, float] = {}
    for b, s in zip(found, fused):
        if b.path in content:
            weight[b.home] = weight.get(b.home, 0.0) + len(b.text)
    if not weight:
        return ""
    homes = {h: w for h, w in weight.items() if h}
    if homes:
        best = max(homes, key=lambda h: (homes[h], -h))
        chosen = _with_neighbours([b for b in found if b.home == best], content)
    else:
        parents = {b.parent for b in found if b.path in content}
        least = min(b.cues for b in found if b.path in content)
        chosen = [
            b for b in found
            if b.path in content or b.parent in parents and b.linked < len(b.text) / 2 and b.cues <= least
        ]
    return "\n\n".join(b.text for b in chosen)


def extract(pages: DataFrame, source: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with the main text of every page."""

    def work(column):
        yield 0, len(column), pa.array([main_text(x or "") for x in column.to_pylist()], pa.string())

    return carried(pages, source, out, "string", work)


def query(spark, folder: str) -> DataFrame:
    made = extract(read(spark, folder, "pages").select("page_id", "url", "html"))
    return made.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
