"""Tables out of HTML pages held in a column."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from laurel.functions.text import strip_or_null

cloudpickle.register_pickle_by_value(sys.modules[__name__])

AWARD_SCHEMA = (
    "page_id bigint, season string, month string, date string, conference string, player string, tie int"
)

# Words of the link description that mark a conference → its letter, in page order.
CONFERENCE_MARKS = (("Eastern", "E"), ("Western", "W"))


class _AwardPage(HTMLParser):
    """Collects (season, month, date, links) of the paragraphs of an award page."""

    VOID = {"br", "img", "hr", "meta", "link", "input", "wbr", "area", "base", "col", "embed", "source", "track"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, str]] = []
        self.text: list[str] | None = None
        self.season = self.month = self.date = None
        self.mark = ""
        self.links: list[tuple[str, str]] = []
        self.found: list[tuple] = []

    def inside(self, name: str) -> bool:
        return any(name == c for _, classes in self.open for c in classes.split())

    def handle_starttag(self, tag, attrs):
        if tag in self.VOID:
            return
        values = dict(attrs)
        classes = values.get("class") or ""
        if tag == "p":
            self.end_paragraph()
        if "data_grid_group" in classes.split():
            self.season = self.month = None
        elif "data_grid_box" in classes.split():
            self.month = None
        self.open.append((tag, classes))
        if tag in ("h3", "strong", "a") or "gridtitle" in classes.split():
            self.text = []
            self.mark = values.get("data-desc") or ""

    def handle_data(self, data):
        if self.text is not None:
            self.text.append(data)

    def handle_endtag(self, tag):
        while self.open:
            name, classes = self.open.pop()
            self.close(name, classes)
            if name == tag:
                return

    def close(self, tag, classes):
        value = "".join(self.text).strip() or None if self.text is not None else None
        if tag == "h3" and self.inside("data_grid_group"):
            self.season = self.season or value
        elif "gridtitle" in classes.split():
            self.month = self.month or value
        elif tag == "strong" and self.inside("data_grid_box"):
            self.date = self.date or value
        elif tag == "a" and value and self.inside("data_grid_box"):
            self.links.append((self.mark, value))
        elif tag == "p":
            self.end_paragraph()
        if tag in ("h3", "strong", "a") or "gridtitle" in classes.split():
            self.text = None

    def end_paragraph(self):
        if self.season and self.month and self.date:
            self.found.append((self.season, self.month, self.date, self.links))
        self.date, self.links = None, []


def _award_rows(html: str) -> list[tuple]:
    page = _AwardPage()
    page.feed(html or "")
    page.end_paragraph()
    rows = []
    for season, month, date, links in page.found:
        marked = [(letter, [n for mark, n in links if word in mark]) for word, letter in CONFERENCE_MARKS]
        named = [(letter, names) for letter, names in marked if names]
        for letter, names in named or [("A", [n for _, n in links])]:
            rows += [(season, month, date, letter, n, int(len(names) > 1)) for n in names]
    return rows


def extract_award_rows(pages: DataFrame) -> DataFrame:
    """Award rows (season, month, date, conference, player, tie) of `pages(page_id, html)`.

    One row per named winner; `tie` is 1 when a paragraph names several; the conference is `A` where
    the page marks none. Pages are independent, so the parser runs on batches of any partition.
    """

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["page_id", "season", "month", "date", "conference", "player", "tie"]
        for batch in batches:
            rows = [(i, *row) for i, html in zip(batch["page_id"], batch["html"]) for row in _award_rows(html)]
            yield pd.DataFrame(rows, columns=names)

    return pages.select("page_id", "html").mapInPandas(parse, AWARD_SCHEMA)


def extract_links(pages: DataFrame, block: str = "nav") -> DataFrame:
    """Heading of each page and the link texts of its first `block` element with their position.

    Regular markup needs no parser: everything stays in built-in expressions.
    """
    inner = F.regexp_extract("html", f"(?s)<{block}>(.*?)</{block}>", 1)
    heading = F.regexp_extract("html", "(?s)<h1>(.*?)</h1>", 1)
    links = F.regexp_extract_all(inner, F.lit('(?s)<a href="[^"]*">(.*?)</a>'), F.lit(1))
    return pages.select(
        "page_id", strip_or_null(heading).alias("heading"), F.posexplode(links).alias("position", "link")
    )
