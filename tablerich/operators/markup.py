"""HTML to markdown in one pass over the tags of a page, in Arrow batches.

Scripts, styles, the title and comments are left out; headings, list items (nested ones set in), table rows with their
cells side by side, links as ``[text](address)``, images as ``![text](address)`` and preformatted text keep their
form. Tags that are not closed end with the tag around them. All named and numbered entities are read, once. White
space is closed up, but for preformatted text. With ``main`` only blocks are kept that hold more text than links: the
words of a block outside links against all its words, as menus and lists of related pages are links for the most part.
"""

from __future__ import annotations

import html
import re

import pandas as pd
from pyspark.sql import Column, functions as F

#: A comment, a tag with quoted attributes, or the rest of an open one.
_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^>"'])*)>""", re.DOTALL)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_SPACES = re.compile(r"[ \t\r\f]+")
_BREAKS = re.compile(r" ?\n[ \n]*")
# Elements whose content is no text, and elements that stand on lines of their own.
_HIDDEN = {"script", "style", "title"}
_BLOCKS = {"p", "div", "br", "tr", "ul", "ol", "table", "article", "section", "nav", "header", "footer", "h1", "h2", "h3", "h4", "h5", "h6", "pre",
           "li", "blockquote", "main", "aside"}
#: Blocks that are judged as a whole when only the main text is wanted.
_PARTS = {"p", "ul", "ol", "table", "pre", "nav", "blockquote"}
#: Words outside links, of a hundred, that make a block main text.
MAIN_SHARE = 50
_INDENT = "\x00"


def _text(raw: str) -> str:
    return html.unescape(raw.replace("&nbsp;", " ")) if "&" in raw else raw


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): _text(m[2] or m[3] or m[4] or "") for m in reversed(list(_ATTRIBUTE.finditer(raw)))}


class _Page:
    """What has been written, and the elements that are open."""

    def __init__(self, main: bool):
        self.main = main
        self.out: list[str] = []
        self.lists = self.pre = 0
        #: Open links: where their text begins, and the address.
        self.links: list[tuple[int, str]] = []
        #: Open parts: where they begin, words in links, all words.
        self.parts: list[list[int]] = []
        self.cell = False

    def write(self, raw: str) -> None:
        text = _text(raw)
        if self.main:
            words = len(text.split())
            for part in self.parts:
                part[1] += words if self.links else 0
                part[2] += words
        if self.pre:
            # Kept as it is: blanks and breaks get marks that the tidying does not know.
            text = text.replace(" ", "\x02").replace("\t", "\x03").replace("\n", "\x04")
        self.out.append(text)

    def open(self, name: str, raw: str) -> None:
        if name == "a":
            self.links.append((len(self.out), _attributes(raw).get("href", "")))
        elif name == "img":
            found = _attributes(raw)
            if found.get("src"):
                self.out.append(f"![{found.get('alt', '')}]({found['src']})")
        elif name in ("td", "th"):
            self.out.append(" | " if self.cell else "")
            self.cell = True
        elif name in _BLOCKS:
            self.out.append("\n")
            if name in ("ul", "ol"):
                self.lists += 1
            elif name == "tr":
                self.cell = False
            elif name == "li":
                self.out.append(_INDENT * max(0, self.lists - 1) + "- ")
            elif len(name) == 2 and name[0] == "h":
                self.out.append("#" * int(name[1]) + " ")
            elif name == "pre":
                self.pre += 1
        if self.main and name in _PARTS:
            self.parts.append([len(self.out), 0, 0])

    def close(self, name: str) -> None:
        if name == "a" and self.links:
            begin, address = self.links.pop()
            text = "".join(self.out[begin:])
            if address and text.strip():
                self.out[begin:] = [f"[{text.strip()}]({address})"]
        if self.main and name in _PARTS and self.parts:
            begin, linked, words = self.parts.pop()
            if (words - linked) * 100 < MAIN_SHARE * words:
                del self.out[begin:]
        if name in _BLOCKS and name != "li":
            self.out.append("\n")
            if name in ("ul", "ol"):
                self.lists = max(0, self.lists - 1)
            elif name == "pre":
                self.pre = max(0, self.pre - 1)

    def done(self) -> str:
        text = _BREAKS.sub("\n", _SPACES.sub(" ", "".join(self.out))).strip()
        return text.replace(_INDENT, "  ").replace("\x02", " ").replace("\x03", "\t").replace("\x04", "\n")


def markdown(page: str | None, main: bool = False) -> str | None:
    """The text of one page."""
    if page is None:
        return None
    found, at = _Page(main), 0
    while (m := _TOKEN.search(page, at)) is not None:
        if m.start() > at:
            found.write(page[at : m.start()])
        at, name = m.end(), (m[2] or "").lower()
        if not name:
            found.out.append(" ")
        elif m[1]:
            found.close(name)
        elif name in _HIDDEN:
            # Nothing in it is markup but its end.
            end = re.compile(rf"</{name}\b[^>]*>", re.IGNORECASE).search(page, at)
            at = len(page) if end is None else end.end()
            found.out.append(" ")
        else:
            found.open(name, m[3] or "")
    if at < len(page):
        found.write(page[at:])
    return found.done()


def to_markdown(page: Column, main: bool = False) -> Column:
    """The text of a column of pages."""

    @F.pandas_udf("string")
    def text(pages: pd.Series) -> pd.Series:
        return pages.map(lambda p: markdown(p, main))

    return text(page)
