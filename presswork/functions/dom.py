"""HTML pages as trees in document order.

Python walks the markup and answers what depends on the tree: which elements lie in
which, in time linear in the page. Rules about texts, addresses and dates are Column
code on what is found.
"""

from __future__ import annotations

import html
from html.parser import HTMLParser

# Fixed values of HTML: elements without content, and those whose text is not
# page text.
VOID_TAGS = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex keygen link "
    "menuitem meta nextid param source spacer track wbr".split()
)
SILENT_TAGS = frozenset("script style template rt rp".split())

class _Walker(HTMLParser):
    """Open elements are closed by an end tag of their name and by nothing else:
    there are no implied end tags, and stray end tags are ignored."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tags, self.parents, self.attrs, self.ends, self.t0, self.t1 = [], [], [], [], [], []
        self.texts, self.open, self.piece = [], [], []
        self.silent, self.counts = 0, {}  # open elements by name: stray end tags cost nothing

    def updatepos(self, i, j):
        return j  # nobody asks for line numbers

    def flush(self):
        if self.piece:
            text = "".join(self.piece).strip()
            self.piece.clear()
            if text and not self.silent:
                self.texts.append(html.unescape(text))

    def handle_starttag(self, tag, attrs, void_closes=True):
        self.flush()
        node = len(self.tags)
        self.tags.append(tag)
        self.parents.append(self.open[-1] if self.open else -1)
        self.attrs.append(attrs)
        self.ends.append(node)
        self.t0.append(len(self.texts))
        self.t1.append(len(self.texts))
        if not (void_closes and tag in VOID_TAGS):
            self.open.append(node)
            self.counts[tag] = self.counts.get(tag, 0) + 1
            self.silent += tag in SILENT_TAGS

    def close_last(self):
        node = self.open.pop()
        self.ends[node] = len(self.tags) - 1
        self.t1[node] = len(self.texts)
        self.counts[self.tags[node]] -= 1
        self.silent -= self.tags[node] in SILENT_TAGS

    def handle_endtag(self, tag):
        self.flush()
        if self.counts.get(tag):
            while self.tags[self.open[-1]] != tag:
                self.close_last()
            self.close_last()

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs, void_closes=False)
        self.handle_endtag(tag)

    def handle_data(self, data):
        self.piece.append(data)

    def handle_comment(self, data):
        self.flush()

    handle_decl = handle_pi = handle_comment

    def unknown_decl(self, data):
        self.flush()
        if data.upper().startswith("CDATA["):
            self.piece.append(data[6:])
            self.flush()

    def finish(self):
        self.flush()
        while self.open:
            self.close_last()


class Tree:
    """A walked page: elements in document order, numbered from 0.

    ``parents`` (-1: none), ``ends`` (number of the last descendant) and the range of
    text pieces inside each element, ``t0`` up to ``t1``. What an element takes from
    those around it or inside it is found in one pass over all of them.
    """

    def __init__(self, payload: bytes | None) -> None:
        walker, page = _Walker(), (payload or b"").decode("utf-8", errors="replace")
        # no tag ends behind the last '>': the rest is text, which the parser would search
        # again from every '<' of it
        end = page.rfind(">") + 1
        walker.feed(page[:end])
        walker.close()
        walker.handle_data(html.unescape(page[end:]))
        walker.finish()
        self.tags, self.parents, self.ends = walker.tags, walker.parents, walker.ends
        self.t0, self.t1, self.texts = walker.t0, walker.t1, walker.texts
        self.attrs = [{k: html.unescape(v or "") for k, v in attrs} if attrs else {} for attrs in walker.attrs]
        self.ids = [dict(attrs).get("id") or "" if attrs else "" for attrs in walker.attrs]
        self.classes = [(dict(attrs).get("class") or "").split() if attrs else [] for attrs in walker.attrs]

    def within(self, marks: list) -> list[bool]:
        """Is the element, or one around it, marked?"""
        out = []
        for parent, mark in zip(self.parents, marks):
            out.append(bool(mark) or (parent >= 0 and out[parent]))
        return out

    def holding(self, marks: list) -> list[bool]:
        """Is there a marked element inside the element?"""
        out = [False] * len(marks)
        for n in range(len(marks) - 1, 0, -1):
            parent = self.parents[n]
            if parent >= 0 and (marks[n] or out[n]):
                out[parent] = True
        return out

    def around(self, marks: list) -> list[int]:
        """The nearest marked element around each, -1 if there is none."""
        out = []
        for parent in self.parents:
            out.append(-1 if parent < 0 else parent if marks[parent] else out[parent])
        return out

    def outermost(self, marks: list, first: int, last: int) -> list[int]:
        """Marked elements from ``first`` to ``last`` that lie in no other of them."""
        out, n = [], first
        while n <= last:
            if marks[n]:
                out.append(n)
                n = self.ends[n]
            n += 1
        return out

    def blank(self, nodes: list[int]) -> None:
        """Empties the text pieces inside some elements; the others keep their places."""
        for n in nodes:
            a, b = self.t0[n], self.t1[n]
            self.texts[a:b] = [""] * (b - a)

    def text(self, n: int) -> str:
        """Text of an element, its pieces apart by blanks."""
        return " ".join(filter(None, self.texts[self.t0[n] : self.t1[n]]))
