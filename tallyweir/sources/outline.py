"""What a page holds, whatever kind of page it is: texts by id, tables, labelled cards and notices, in one pass over the markup.

Nothing here knows what a tender is. The result is one nested row per page, from which plain column expressions pick.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: tags without an end; and of each tag those that it ends where they were left open
EMPTY = frozenset("area base br col embed hr img input link meta source track wbr".split())
ENDS = {"tr": "tr td th", "td": "td th", "th": "td th", "tbody": "thead tr td th", "li": "li", "p": "p"}
LINK = pa.struct([("href", pa.string()), ("text", pa.string())])
LINE = pa.struct([("names", pa.list_(pa.string())), ("cells", pa.list_(pa.string())), ("links", pa.list_(pa.string()))])
GRID = pa.struct([("heading", pa.string()), ("inside", pa.list_(pa.string())), ("head", pa.list_(pa.string())), ("lines", pa.list_(LINE))])
PAIR = pa.struct([("part", pa.string()), ("label", pa.string()), ("value", pa.string())])
CARD = pa.struct([("links", pa.list_(LINK)), ("pairs", pa.list_(PAIR))])
NOTICE = pa.struct([("inside", pa.list_(pa.string())), ("text", pa.string())])
OUTLINE = pa.schema([("key", pa.string()), ("marks", pa.map_(pa.string(), pa.string())), ("grids", pa.list_(GRID)), ("cards", pa.list_(CARD)), ("notices", pa.list_(NOTICE))])
DDL = (
    "key string, marks map<string,string>, grids array<struct<heading:string,inside:array<string>,head:array<string>,lines:array<struct<names:array<string>,cells:array<string>,links:array<string>>>>>, "
    "cards array<struct<links:array<struct<href:string,text:string>>,pairs:array<struct<part:string,label:string,value:string>>>>, notices array<struct<inside:array<string>,text:string>>"
)


class _Open:
    """An element that has not ended: where its text begins, and what it collects."""

    __slots__ = ("tag", "id", "kinds", "href", "start", "data")

    def __init__(self, tag: str, attrs: dict[str, str], start: int):
        self.tag, self.id, self.kinds, self.href, self.start = tag, attrs.get("id", ""), attrs.get("class", "").split(), attrs.get("href", ""), start
        self.data: dict[str, list] | None = None


class Outline(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.pieces: list[str] = []
        self.stack: list[_Open] = []
        self.heading = ""
        self.page: dict[str, list | dict] = {"marks": {}, "grids": [], "cards": [], "notices": []}

    def handle_starttag(self, tag: str, attrs: list) -> None:
        while self.stack and self.stack[-1].tag in ENDS.get(tag, "").split():
            self._end(self.stack.pop())
        e = _Open(tag, {k: v or "" for k, v in attrs}, len(self.pieces))
        if tag == "table":
            e.data = {"head": [], "lines": [], "heading": self.heading, "inside": self._ids()}
            self.page["grids"].append(e.data)  # in the order they begin
        elif tag == "tr":
            e.data = {"names": [], "cells": [], "links": []}
        elif "custom-cards" in e.kinds:
            e.data = {"links": [], "pairs": []}
            self.page["cards"].append(e.data)
        elif {"cards-row", "col-header"} & {*e.kinds}:
            e.data = {"part": "header" if "col-header" in e.kinds else "row", "label": None, "value": None}
        if tag not in EMPTY:
            self.stack.append(e)

    def handle_endtag(self, tag: str) -> None:
        if any(e.tag == tag for e in self.stack):
            while (e := self.stack.pop()).tag != tag:
                self._end(e)
            self._end(e)

    def handle_data(self, data: str) -> None:
        if not self.stack or self.stack[-1].tag not in ("script", "style"):
            self.pieces.append(data)

    def close(self) -> None:
        super().close()
        while self.stack:
            self._end(self.stack.pop())

    def _ids(self) -> list[str]:
        return [e.id for e in self.stack if e.id]

    def _around(self, *keys: str) -> Iterator[dict]:
        """What the open elements collect, innermost first, where it has all the keys."""
        return (e.data for e in reversed(self.stack) if e.data is not None and {*keys} <= {*e.data})

    def _end(self, e: _Open) -> None:
        """Hands what an element was to what is open around it."""
        text = " ".join(" ".join(self.pieces[e.start :]).split())
        if e.id:
            self.page["marks"].setdefault(e.id, text)
        if re.fullmatch("h[2-5]", e.tag):
            self.heading = text
        if any("alert" in k for k in e.kinds):
            self.page["notices"].append({"inside": self._ids(), "text": text})
        if e.tag in ("td", "th"):
            for row in self._around("cells"):
                row["cells" if e.tag == "td" else "names"].append(text)
                break
        elif e.tag == "tr":
            for grid in self._around("lines"):
                if e.data["cells"]:
                    grid["lines"].append(e.data)
                else:
                    grid["head"] += e.data["names"]
                break
        elif e.tag == "a":
            for row in self._around("cells"):
                row["links"].append(e.href)
                break
            for card in self._around("pairs"):
                card["links"].append({"href": e.href, "text": text})
                break
        elif e.data is not None and "part" in e.data:
            for card in self._around("pairs"):
                card["pairs"].append(e.data)
                break
        field = "label" if "card-label" in e.kinds else "value" if "card-title" in e.kinds else None
        if field:
            for pair in self._around("part"):
                if pair[field] is None:
                    pair[field] = text


def outline(html: str | None) -> dict:
    parser = Outline()
    parser.feed(html or "")
    parser.close()
    return parser.page | {"marks": [*parser.page["marks"].items()]}


def outlines(pages: DataFrame) -> DataFrame:
    """key, marks, grids, cards, notices of each page (key, html); a map, no shuffle. Null and empty pages hold nothing."""

    def read(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for at in range(0, batch.num_rows, 50):
                part = batch.slice(at, 50)
                rows = [{"key": key, **outline(html)} for key, html in zip(part.column(0).to_pylist(), part.column(1).to_pylist())]
                yield pa.RecordBatch.from_pylist(rows, schema=OUTLINE)

    return pages.select(F.col("key").cast("string").alias("key"), F.col("html").cast("string").alias("html")).mapInArrow(read, DDL)
