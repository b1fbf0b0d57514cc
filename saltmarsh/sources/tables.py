"""Rows of HTML tables as a table, and daily flows of investors out of them."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of pages that a Python worker gets at once, and cells that it gives at once.
AT_ONCE, CELLS = 4 << 20, 1 << 16
#: Cells of a flow row at least, the places of its numbers, and its date.
LEAST, INST, FOREIGN, DATE = 9, 5, 6, r"^\d{4}\.\d{2}\.\d{2}$"
#: What a page or a row ends with it where its own end is missing.
CLOSES = {"td": ("td", "th"), "th": ("td", "th"), "tr": ("td", "th", "tr")}


#: What a page of bare tags of tables and text hasn't: references, comments, attributes, other tags. And its parts: whole rows of texts, or a tag.
OTHER = re.compile(r"&|<(?!/?(?:table|tr|td|th)>)")
PART = re.compile(r"<tr>((?:<td>[^<]*</td>|<th>[^<]*</th>)*)</tr>|<(/?)(table|tr|td|th)>")
CELL = re.compile(r"<(t[dh])>([^<]*)<")


class _Walk(HTMLParser):
    """Rows in the order in which they begin: the texts of all cells below a row, nested tables' too, and its own cells with their spans."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[dict] = []
        self.open: list[tuple[str, dict]] = []
        self.tables = 0

    def read(self, html: str) -> None:
        """The whole page. One of bare tags is cut into rows and tags without the parser, which takes many times as long; the rows are the same."""
        if OTHER.search(html):
            self.feed(html)
            self.close()
            return
        at = 0
        for m in PART.finditer(html):
            if m.start() > at:
                self.handle_data(html[at : m.start()])
            at = m.end()
            if m[3]:
                self.handle_endtag(m[3]) if m[2] else self.handle_starttag(m[3], [])
            elif self.tables:
                self._row(CELL.findall(m[1]))
            elif m[1]:
                self.handle_data("".join(text for _, text in CELL.findall(m[1])))
        self.handle_data(html[at:])

    def _row(self, own: list[tuple[str, str]]) -> None:
        """A row that begins and ends here, of cells that do; their texts stand for them."""
        while self.open and self.open[-1][0] in CLOSES["tr"]:
            self.open.pop()
        texts = [" ".join(text.split()) for _, text in own]
        cells = [text for (tag, _), text in zip(own, texts, strict=True) if tag == "td"]
        table = next((n["table"] for t, n in reversed(self.open) if t == "table"), 0)
        self.rows.append({"cells": cells, "own": texts, "table": table})
        for tag, node in self.open:
            if tag == "tr":
                node["cells"].extend(cells)
            elif tag != "table":
                node["parts"].extend(filter(None, texts))

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "table":
            self.tables += 1
            self.open.append((tag, {"table": len(self.rows)}))
        elif self.tables and tag in ("tr", "td", "th"):
            while self.open and self.open[-1][0] in CLOSES[tag]:
                self.open.pop()
            node = {"parts": [], "tag": tag} | {k: max(1, min(1000, int(v))) for k, v in attrs if k in ("colspan", "rowspan") and v and v.strip().isdigit()}
            if tag == "tr":
                node |= {"cells": [], "own": [], "table": next((n["table"] for t, n in reversed(self.open) if t == "table"), 0)}
                self.rows.append(node)
            else:
                rows = [n for t, n in self.open if t == "tr"]
                for row in rows if tag == "td" else ():
                    row["cells"].append(node)
                for row in rows[-1:]:
                    row["own"].append(node)
            self.open.append((tag, node))

    def handle_endtag(self, tag: str) -> None:
        # within the innermost table only, unless it is the table that ends
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                del self.open[k:]
                self.tables -= tag == "table"
                return
            if self.open[k][0] == "table":
                return

    def handle_data(self, data: str) -> None:
        if text := " ".join(data.split()):
            for tag, node in self.open:
                if tag in ("td", "th"):
                    node["parts"].append(text)


def _text(cell: dict | str) -> str:
    return cell if isinstance(cell, str) else " ".join(cell["parts"])


def _spread(rows: list[dict]) -> Iterator[list[str]]:
    """Each row's own cells in the columns that they cover, those that reach down from rows above among them."""
    down: dict[int, dict[int, list]] = {}
    for row in rows:
        reach, out = down.setdefault(row["table"], {}), []
        for cell in [*row["own"], None]:
            while len(out) in reach:  # a cell from above stands here
                left = reach[len(out)]
                left[0] -= 1
                if not left[0]:
                    del reach[len(out)]
                out.append(left[1])
            if cell is not None:
                text, spans = _text(cell), {} if isinstance(cell, str) else cell
                for _ in range(spans.get("colspan", 1)):
                    if spans.get("rowspan", 1) > 1:
                        reach[len(out)] = [spans["rowspan"] - 1, text]
                    out.append(text)
        yield out


def table_rows(pages: DataFrame, grid: bool = True) -> DataFrame:
    """id, row (from 0, in a page), cells and (with ``grid``) grid of every table row of pages (id, html).

    ``cells``: texts of all data cells below the row, a nested table's too; text between tags is stripped and joined by blanks. ``grid``: its own cells, data and
    heads, each in every column and row that it spans. Ends that are missing are supplied. Pages without rows, null ones too, give none.
    """
    kind = pages.schema["id"].dataType.simpleString()
    form = f"id {kind}, row int, cells array<string>" + ", grid array<string>" * grid
    texts = pa.list_(pa.string())

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            at, number, cells, spread, size = [], [], [], [], 0

            def given() -> pa.RecordBatch:
                columns = {"id": batch.column("id").take(pa.array(at, pa.int64())), "row": pa.array(number, pa.int32()), "cells": pa.array(cells, texts)} | ({"grid": pa.array(spread, texts)} if grid else {})  # noqa: B023
                return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

            for k, html in enumerate(batch.column("html").to_pylist()):
                walk = _Walk()
                walk.read(html)
                owns = _spread(walk.rows) if grid else [()] * len(walk.rows)
                for i, (row, own) in enumerate(zip(walk.rows, owns, strict=True)):
                    at.append(k)
                    number.append(i)
                    cells.append([_text(c) for c in row["cells"]])
                    spread.append(own)
                    size += len(cells[-1]) + len(own)
                    if size > CELLS:
                        yield given()
                        at, number, cells, spread, size = [], [], [], [], 0
            if at:
                yield given()

    # most pages have no table: they don't go to Python
    return pages.where(F.lower("html").rlike(r"<tr[\s>]")).select("id", "html").mapInArrow(run, form)


def whole_number(c: Column) -> Column:
    """A number with separators, signs and percent signs; empty and dashes are 0, anything else is null."""
    bare = F.regexp_replace(F.trim(c), r"[,% +]", "")
    return F.when(bare.isin("", "-", "--"), F.lit(0).cast("long")).when(bare.rlike(r"^-?\d+$"), bare.try_cast("long"))


def flow_rows(pages: DataFrame) -> DataFrame:
    """id, row, date, inst, corp, indiv, foreign, total of pages' (id, html) flow tables: rows with a date in front and at least nine cells.

    The page states institutions and foreigners; individuals are taken to hold what those sell, the rest is 0. A row whose date or number is none is left out.
    """
    rows = table_rows(pages, grid=False).where((F.size("cells") >= LEAST) & F.get("cells", F.lit(0)).rlike(DATE))
    inst, foreign = (whole_number(F.get("cells", F.lit(k))) for k in (INST, FOREIGN))
    day = F.try_to_timestamp(F.get("cells", F.lit(0)), F.lit("yyyy.MM.dd")).cast("date")
    rows = rows.select("id", "row", day.alias("date"), inst.alias("inst"), foreign.alias("foreign")).where("date is not null and inst is not null and foreign is not null")
    zero = F.lit(0).cast("long")
    return rows.select("id", "row", "date", "inst", zero.alias("corp"), (-(F.col("inst") + F.col("foreign"))).alias("indiv"), "foreign", zero.alias("total"))
