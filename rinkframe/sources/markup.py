"""Tables of HTML pages as nested columns, for native expressions to read."""

from __future__ import annotations

from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

_LINK = pa.struct([("text", pa.string()), ("href", pa.string()), ("classes", pa.list_(pa.string()))])
_CELL = pa.struct([("tag", pa.string()), ("text", pa.string()), ("tight", pa.string()), ("spans", pa.bool_()), ("links", pa.list_(_LINK))])
_ROW = pa.struct([("id", pa.string()), ("body", pa.int32()), ("cells", pa.list_(_CELL))])
_HEADER = pa.struct([("text", pa.string()), ("tight", pa.string())])
_TABLE = pa.struct([("classes", pa.list_(pa.string())), ("heading", pa.string()), ("text", pa.string()), ("has_head", pa.bool_()), ("has_body", pa.bool_()), ("headers", pa.list_(_HEADER)), ("rows", pa.list_(_ROW))])

#: Tables of a page: classes, the heading before it, all its text, header cells, and rows with their cells and links.
#: `text` is stripped as a whole, `tight` text node by text node. `body` counts a table's bodies; rows outside have none.
TABLES = (
    "array<struct<classes: array<string>, heading: string, text: string, has_head: boolean, has_body: boolean, headers: array<struct<text: string, tight: string>>, "
    "rows: array<struct<id: string, body: int, cells: array<struct<tag: string, text: string, tight: string, spans: boolean, links: array<struct<text: string, href: string, classes: array<string>>>>>>>>>"
)


#: Pages that a task holds as Python objects at once.
PAGES = 32


class _Tables(HTMLParser):
    """Tables in the order in which they begin. Broken markup closes what is open; nested tables are tables of their own."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tables: list[dict] = []
        self.open: list[dict] = []
        self.heading: list[str] | None = None
        self.in_heading, self.hidden = False, 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        a = dict(attrs)
        classes = (a.get("class") or "").split()
        table = self.open[-1] if self.open else None
        if tag == "table":
            table = {"classes": classes, "heading": self.heading, "text": [], "heads": 0, "bodies": 0, "part": None, "headers": [], "rows": [], "row": None, "cell": None, "link": None}
            self.tables.append(table)
            self.open.append(table)
        elif tag in ("script", "style"):
            self.hidden += 1
        elif tag in ("h2", "h3", "h4"):
            self.heading, self.in_heading = [], True
        elif table is None:
            return
        elif tag in ("thead", "tbody", "tfoot"):
            self._close_row(table)
            table["part"] = tag
            table["heads"] += tag == "thead"
            table["bodies"] += tag == "tbody"
        elif tag == "tr":
            self._close_row(table)
            table["row"] = {"id": a.get("id"), "body": table["bodies"] - 1 if table["part"] == "tbody" else None, "cells": []}
            table["rows"].append(table["row"])
        elif tag in ("td", "th"):
            if table["row"] is None:
                self.handle_starttag("tr", [])
            table["cell"], table["link"] = {"tag": tag, "parts": [], "spans": "colspan" in a, "links": []}, None
            table["row"]["cells"].append(table["cell"])
            if tag == "th" and table["part"] == "thead" and table["heads"] == 1:
                table["headers"].append(table["cell"])
        elif tag == "a" and table["cell"] is not None:
            table["link"] = {"parts": [], "href": a.get("href"), "classes": classes}
            table["cell"]["links"].append(table["link"])

    def handle_endtag(self, tag: str) -> None:
        table = self.open[-1] if self.open else None
        if tag in ("script", "style"):
            self.hidden = max(0, self.hidden - 1)
        elif tag in ("h2", "h3", "h4"):
            self.in_heading = False
        elif table is None:
            return
        elif tag == "table":
            self.open.pop()
        elif tag in ("thead", "tbody", "tfoot"):
            self._close_row(table)
            table["part"] = None
        elif tag == "tr":
            self._close_row(table)
        elif tag in ("td", "th"):
            table["cell"] = table["link"] = None
        elif tag == "a":
            table["link"] = None

    def _close_row(self, table: dict) -> None:
        table["row"] = table["cell"] = table["link"] = None

    def handle_data(self, data: str) -> None:
        if self.hidden:
            return
        if self.in_heading:
            self.heading.append(data)
        for table in self.open:
            table["text"].append(data)
            if table["cell"] is not None:
                table["cell"]["parts"].append(data)
            if table["link"] is not None:
                table["link"]["parts"].append(data)


def _tight(parts: list[str]) -> str:
    return "".join(p.strip() for p in parts)


def _page(html: str | None) -> list[dict]:
    if not html:
        return []
    reader = _Tables()
    reader.feed(html)
    reader.close()
    link = lambda x: {"text": _tight(x["parts"]), "href": x["href"], "classes": x["classes"]}
    cell = lambda c: {"tag": c["tag"], "text": "".join(c["parts"]).strip(), "tight": _tight(c["parts"]), "spans": c["spans"], "links": [link(x) for x in c["links"]]}
    row = lambda r: {"id": r["id"], "body": r["body"], "cells": [cell(c) for c in r["cells"]]}
    head = lambda c: {"text": "".join(c["parts"]).strip(), "tight": _tight(c["parts"])}
    return [
        {"classes": t["classes"], "heading": None if t["heading"] is None else _tight(t["heading"]), "text": "".join(t["text"]), "has_head": t["heads"] > 0, "has_body": t["bodies"] > 0, "headers": [head(c) for c in t["headers"]], "rows": [row(r) for r in t["rows"]]}
        for t in reader.tables
    ]


def tables_of(html: Column) -> Column:
    """The tables of a page (TABLES), parsed page by page in Arrow batches; a null page has none."""

    @F.arrow_udf(TABLES)
    def parse(pages: pa.Array) -> pa.Array:
        # Only few pages at a time are Python objects.
        few = [pa.array([_page(x.as_py()) for x in pages.slice(k, PAGES)], pa.list_(_TABLE)) for k in range(0, len(pages), PAGES)]
        return pa.concat_arrays(few) if few else pa.array([], pa.list_(_TABLE))

    return parse(html)


def with_class(tables: Column, *names: str) -> Column:
    """The tables that have one of the classes."""
    return F.filter(tables, lambda t: F.arrays_overlap(t["classes"], F.array(*[F.lit(n) for n in names])))


def body_rows(table: Column) -> Column:
    """Rows of a table's first body, or all its rows where it has none."""
    return F.when(table["has_body"], F.filter(table["rows"], lambda r: r["body"] == 0)).otherwise(table["rows"])


def cells(row: Column, *tags: str) -> Column:
    return F.filter(row["cells"], lambda c: c["tag"].isin(*tags))


def link_with_class(cell: Column, name: str) -> Column:
    """Text of the first link of a class in a cell; null where there is none."""
    return F.get(F.filter(cell["links"], lambda x: F.array_contains(x["classes"], name)), F.lit(0))["text"]


def columns_of(headers: Column) -> Column:
    """A map from header to column; of equal headers the last counts."""
    names = F.array_distinct(headers)
    return F.map_from_arrays(names, F.transform(names, lambda n: (F.size(headers) - F.array_position(F.reverse(headers), n)).cast("int")))


def join_url(base: Column, href: Column) -> Column:
    """An address relative to a page's, without resolving of dots."""
    origin = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    folder = F.when(F.rlike(base, F.lit(r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*/")), F.regexp_extract(base, r"^([^?#]*/)", 1)).otherwise(F.concat(origin, F.lit("/")))
    return (
        F.when(F.rlike(href, F.lit(r"^[a-zA-Z][a-zA-Z0-9+.-]*:")), href)
        .when(F.startswith(href, F.lit("//")), F.concat(F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*:)", 1), href))
        .when(F.startswith(href, F.lit("/")), F.concat(origin, href))
        .when(href == "", base)
        .otherwise(F.concat(folder, href))
    )
