"""HTML -> Markdown (the preferred body conversion), a defined subset.

Links are kept as ``[text](href)``, images dropped, headings become ``#``
lines, list items ``* `` lines, ``<b>/<strong>`` ``**``, ``<i>/<em>`` ``_``,
paragraphs and block ends blank lines, ``<br>`` a line break; script and
style content is dropped; no line wrapping.  Runs as a row UDF, whose worker
holds a hundred pages at a time, over the stdlib ``html.parser`` - a per-row
helper, not a library port; no byte equality with any other converter is claimed.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BLOCK = {"p", "div", "section", "article", "header", "footer", "nav", "table", "tr", "ul", "ol",
          "blockquote", "pre", "h1", "h2", "h3", "h4", "h5", "h6"}
_SKIP = {"script", "style", "head", "title"}


class _Converter(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.skip = 0
        self.href: list[str | None] = []
        self.link_text: list[list[str]] = []

    def _emit(self, s: str):
        if self.link_text:
            self.link_text[-1].append(s)
        else:
            self.out.append(s)

    def handle_starttag(self, tag, attrs):
        if tag in _SKIP:
            self.skip += 1
            return
        if self.skip:
            return
        a = dict(attrs)
        if tag in _BLOCK:
            self._emit("\n\n")
        if tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            self._emit("#" * int(tag[1]) + " ")
        elif tag == "li":
            self._emit("\n* ")
        elif tag == "br":
            self._emit("\n")
        elif tag in ("b", "strong"):
            self._emit("**")
        elif tag in ("i", "em"):
            self._emit("_")
        elif tag == "a":
            self.href.append(a.get("href"))
            self.link_text.append([])

    def handle_endtag(self, tag):
        if tag in _SKIP:
            self.skip = max(0, self.skip - 1)
            return
        if self.skip:
            return
        if tag == "a" and self.link_text:
            label = "".join(self.link_text.pop()).strip()
            href = self.href.pop()
            self._emit(f"[{label}]({href})" if href else label)
        elif tag in ("b", "strong"):
            self._emit("**")
        elif tag in ("i", "em"):
            self._emit("_")
        elif tag in _BLOCK:
            self._emit("\n\n")

    def handle_data(self, data):
        if not self.skip:
            self._emit(re.sub(r"\s+", " ", data))

    def text(self) -> str:
        while self.link_text:       # unclosed anchors keep their text
            self.out.extend(self.link_text.pop(0))
        s = "".join(self.out)
        s = re.sub(r"[ \t]+\n", "\n", s)
        s = re.sub(r"\n{3,}", "\n\n", s)
        return s.strip()


def convert(html: str | None) -> str | None:
    if html is None:
        return None
    c = _Converter()
    try:
        c.feed(html)
        c.close()
    except Exception:
        return html
    return c.text()


_markdown_udf = F.udf(convert, T.StringType(), useArrow=False)


def html_to_markdown(c: Column) -> Column:
    return _markdown_udf(c)
