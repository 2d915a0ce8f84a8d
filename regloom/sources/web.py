"""HTML to rows: links, titles, visible text and table cells, parsed in Arrow batches within tasks."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def links(pages: DataFrame, key: str, html: str) -> DataFrame:
    """key, pos, href, text of anchors, by one pattern: for well-formed pages."""
    anchors = F.regexp_extract_all(html, F.lit(r"(?is)<a\s[^>]*?href\s*=\s*[\"'][^\"']*[\"'][^>]*>.*?</a>"), F.lit(0))
    a = pages.select(key, F.posexplode(anchors).alias("pos", "a"))
    href = F.regexp_extract("a", r"(?is)href\s*=\s*[\"']([^\"']*)[\"']", 1)
    text = F.trim(F.regexp_replace(F.regexp_replace("a", "(?s)<[^>]*>", " "), r"(?U)\s+", " "))
    return a.select(key, "pos", href.alias("href"), text.alias("text"))


def title(html: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1), r"(?U)\s+", " "))


#: Elements whose content is not shown, and elements that begin and end a line.
HIDDEN = frozenset(("script", "style", "noscript", "svg"))
BLOCKS = frozenset(("p", "div", "section", "article", "header", "footer", "main", "aside", "li", "br", "h1", "h2", "h3", "h4", "h5", "h6", "tr", "table"))


def _plain(x: str) -> str:
    return " ".join(x.split())


class _Visible(HTMLParser):
    """Text lines and tables of a page. A table within a table takes its place; rows without text and empty tables are left out."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.hidden, self.text, self.tables = 0, [], []
        self.rows = self.row = self.cell = None

    def handle_starttag(self, tag, attrs):
        if tag in HIDDEN:
            self.hidden += 1
        if self.hidden:
            return
        if tag in BLOCKS:
            self.text.append("\n")
        match tag:
            case "table":
                self.rows = []
            case "tr" if self.rows is not None:
                self.row = []
            case "td" | "th" if self.row is not None:
                self.cell = []

    def handle_endtag(self, tag):
        if tag in HIDDEN:
            self.hidden = max(0, self.hidden - 1)
            return
        if self.hidden:
            return
        match tag:
            case "td" | "th" if self.cell is not None and self.row is not None:
                self.row.append(_plain(" ".join(self.cell)))
                self.cell = None
            case "tr" if self.row is not None and self.rows is not None:
                self.rows += [self.row] if any(self.row) else []
                self.row = None
            case "table" if self.rows is not None:
                self.tables += [self.rows] if self.rows else []
                self.rows = None
        if tag in BLOCKS:
            self.text.append("\n")

    def handle_data(self, data):
        shown = "" if self.hidden else _plain(data)
        if shown:
            self.text += [shown, " "]
            if self.cell is not None:
                self.cell.append(shown)


def blocks(pages: DataFrame, key: str, html: str) -> DataFrame:
    """key, body (visible lines), tables array<array<array<string>>>."""
    kind = pages.schema[key].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for k, h in zip(f[key], f[html], strict=True):
                p = _Visible()
                p.feed(h or "")
                lines = map(_plain, "".join(p.text).splitlines())
                out.append((k, "\n".join(x for x in lines if x), p.tables))
            yield pd.DataFrame(out, columns=[key, "body", "tables"])

    return pages.select(key, html).mapInPandas(run, f"{key} {kind}, body string, tables array<array<array<string>>>")


def table_rows(tables: DataFrame, key: str, column: str, needles: dict[str, str], within: int = 6) -> DataFrame:
    """Rows of the tables whose header, among the first rows, holds all needles: key and a column for each needle."""
    t = tables.select(key, F.posexplode(column).alias("table", "rows"))
    has = lambda row: F.forall(F.array(*map(F.lit, needles.values())), lambda n: F.exists(row, lambda c: F.lower(c).contains(n)))
    head = F.array_position(F.transform(F.slice("rows", 1, within), has), True).cast("int")
    t = t.withColumn("head", head).where("head > 0")
    at = {n: F.array_position(F.transform(F.get("rows", F.col("head") - 1), _holds(needle)), True).cast("int") for n, needle in needles.items()}
    t = t.withColumns({f"_{n}": c for n, c in at.items()})
    body = F.posexplode(F.slice("rows", F.col("head") + 1, F.size("rows")))
    r = t.select(key, "table", *[f"_{n}" for n in needles], body.alias("row", "cells"))
    return r.select(key, "table", "row", *[F.get("cells", F.col(f"_{n}") - 1).alias(n) for n in needles])


def _holds(needle: str):
    return lambda c: F.lower(c).contains(needle)


def preferred_attachment(urls: Column, allowed: str, number: Column) -> Column:
    """An allowed url that names the number, else the first allowed one, else the first."""
    good = F.filter(urls, lambda u: u.rlike(allowed))
    named = F.filter(good, lambda u: u.contains(number))
    return F.coalesce(F.get(named, F.lit(0)), F.get(good, F.lit(0)), F.get(urls, F.lit(0)))
