"""HTML to ordered text spans, and tables to rows, with the standard library's event parser in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame

# Elements that break a line, and elements whose content isn't text.
_BREAKS = frozenset("address article aside blockquote br dd div dl dt figcaption footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table td th tr ul".split())
_SILENT = frozenset(("script", "style", "head", "template", "noscript", "ix:header", "ix:hidden", "xbrli:context", "xbrli:unit"))
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


class _Spans(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.spans: list[tuple[str, str]] = []
        self.parts: list[str] = []
        self.kind, self.hidden = "text", 0
        self.open: list[str] = []

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.spans.append((self.kind, text))
        self.parts = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        a = {k: v or "" for k, v in attrs}
        if tag in _BREAKS:
            self.flush()
            self.kind = "heading" if tag in ("h1", "h2", "h3", "h4", "h5", "h6") else "text"
        if tag in _VOID:
            return
        if self.hidden:
            self.hidden += tag == self.open[-1]
        elif tag in _SILENT or "hidden" in a or a.get("aria-hidden") == "true" or "display:none" in a.get("style", "").replace(" ", "").lower():
            self.hidden = 1
            self.open.append(tag)

    def handle_endtag(self, tag: str) -> None:
        if self.hidden:
            self.hidden -= tag == self.open[-1]
            if not self.hidden:
                self.open.pop()
            return
        if tag in _BREAKS:
            self.flush()
            self.kind = "text"

    def handle_data(self, data: str) -> None:
        if not self.hidden:
            self.parts.append(data)


def spans(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """(key, span, kind, text): a page's visible text spans in order; kind is heading or text."""
    kind = dict(pages.dtypes)[key]

    def make(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for k, page in zip(f[key], f[html], strict=True):
                reader = _Spans()
                reader.feed(page or "")
                reader.close()
                reader.flush()
                rows += [(k, i, name, text) for i, (name, text) in enumerate(reader.spans)]
            yield pd.DataFrame(rows, columns=[key, "span", "kind", "text"])

    return pages.select(key, html).mapInPandas(make, f"{key} {kind}, span int, kind string, text string")
