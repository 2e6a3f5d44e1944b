"""HTML pages as document items, by the standard library's parser; other converters can be put in its place."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_BLOCKS = {"p", "div", "li", "h1", "h2", "h3", "h4", "h5", "h6", "td", "th", "tr", "table", "article", "section", "ul", "ol", "footer", "nav", "header", "br", "title"}
_SILENT = {"script", "style", "noscript"}


class _Reader(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.items: list[tuple[str, int | None, str]] = []
        self.parts: list[str] = []
        self.label, self.level, self.silent = "text", None, 0

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.items.append((self.label, self.level, text))
        self.parts, self.label, self.level = [], "text", None

    def handle_starttag(self, tag, attrs):
        if tag in _SILENT:
            self.silent += 1
        if tag in _BLOCKS:
            self.flush()
            if len(tag) == 2 and tag[0] == "h" and tag[1].isdigit():
                self.label, self.level = "section_header", int(tag[1])
            elif tag == "li":
                self.label = "list_item"
            elif tag == "title":
                self.label = "title"
            elif tag in ("td", "th"):
                self.label = "cell"

    def handle_endtag(self, tag):
        if tag in _SILENT and self.silent:
            self.silent -= 1
        if tag in _BLOCKS:
            self.flush()

    def handle_data(self, data):
        if not self.silent:
            self.parts.append(data)


def html_items(html: str) -> list[tuple[str, int | None, str]]:
    """(label, level, text) of each block in reading order."""
    reader = _Reader()
    reader.feed(html)
    reader.close()
    reader.flush()
    return reader.items


def convert(pages: DataFrame, key: str, html: str, converter: Callable[[str], list[tuple[str, int | None, str]]] = html_items) -> DataFrame:
    """key, pos, item_id, label, level, text of each item of each page; null pages have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(k, pos, f"#/texts/{pos}", *item) for k, h in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if h is not None for pos, item in enumerate(converter(h))]
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            kinds = [batch.schema.field(0).type, pa.int32(), pa.string(), pa.string(), pa.int32(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=[key, "pos", "item_id", "label", "level", "text"])

    kind = pages.schema[key].dataType.simpleString()
    return pages.select(key, html).mapInArrow(run, f"{key} {kind}, pos int, item_id string, label string, level int, text string")


def page_title(html) -> F.Column:
    """The title element's text with the named references of markup resolved, or null."""
    raw = F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)
    for code, plain in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        raw = F.replace(raw, F.lit(code), F.lit(plain))
    return F.nullif(F.trim(raw), F.lit(""))
