"""Tables: HTML and GFM tables as headers and rows; CSV dialects."""

from __future__ import annotations

import difflib
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRID = "headers array<string>, rows array<array<string>>"


class _Reader(HTMLParser):
    """Cells of one table; a cell, row or section ends where the next begins."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[list[tuple[str, int, int, bool]]] = []
        self.cell: list[str] | None = None
        self.span = (1, 1, False)

    def close_cell(self) -> None:
        if self.cell is not None and self.rows:
            self.rows[-1].append((" ".join("".join(self.cell).split()), *self.span))
        self.cell = None

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "tr":
            self.close_cell()
            self.rows.append([])
        elif tag in ("td", "th"):
            self.close_cell()
            if not self.rows:
                self.rows.append([])
            of = lambda k: int(v) if (v := (dict(attrs).get(k) or "1")).isdigit() and 0 < int(v) < 1000 else 1
            self.cell, self.span = [], (of("colspan"), of("rowspan"), tag == "th")
        elif tag == "br" and self.cell is not None:
            self.cell.append(" ")

    def handle_endtag(self, tag: str) -> None:
        if tag in ("td", "th", "tr", "table"):
            self.close_cell()

    def handle_data(self, data: str) -> None:
        if self.cell is not None:
            self.cell.append(data)


def html_grid(source: str) -> tuple[list[str], list[list[str]]]:
    """(headers, rows), all of one width; spans are repeated. The header is the row of th cells, else the first row."""
    reader = _Reader()
    reader.feed(source)
    reader.close()
    reader.close_cell()
    grid: list[list[str]] = []
    head = None
    hanging: dict[int, tuple[int, str]] = {}
    for row in reader.rows:
        cells: list[str] = []
        todo = iter(row)
        while True:
            if (left := hanging.get(len(cells))) and left[0] > 0:
                hanging[len(cells)] = (left[0] - 1, left[1])
                cells.append(left[1])
                continue
            nxt = next(todo, None)
            if nxt is None:
                break
            text, wide, high, _ = nxt
            for _ in range(wide):
                hanging[len(cells)] = (high - 1, text)
                cells.append(text)
        if cells:
            if head is None and row and all(c[3] for c in row):
                head = len(grid)
            grid.append(cells)
    if not grid:
        return [], []
    width = max(map(len, grid))
    grid = [r + [""] * (width - len(r)) for r in grid]
    at = head or 0
    return grid[at], grid[:at] + grid[at + 1 :]


def markdown_tables(text: str) -> list[tuple[list[str], list[list[str]]]]:
    """Pipe tables of a text: a header over a delimiter row of the same width; short rows are filled, long ones kept."""
    cells = lambda line: [c.strip().replace("\\|", "|") for c in re.split(r"(?<!\\)\|", line.strip().strip("|"))]
    lines, out, i = text.split("\n"), [], 0
    while i + 1 < len(lines):
        mark = cells(lines[i + 1])
        if "|" in lines[i] and all(re.fullmatch(r":?-+:?", c) for c in mark) and len(mark) == len(cells(lines[i])):
            head, rows, i = cells(lines[i]), [], i + 2
            while i < len(lines) and "|" in lines[i] and lines[i].strip():
                r = cells(lines[i])
                rows.append(r + [""] * (len(head) - len(r)))
                i += 1
            out.append((head, rows))
        else:
            i += 1
    return out


def cell_texts(table_html: Column) -> Column:
    """The texts of a table's cells, without what tags stand in them; a cell ends where it, its row or the table is closed or the next one begins."""
    bodies = F.regexp_extract_all(table_html, F.lit(r"(?is)<t[dh]\b[^>]*>(.*?)(?=</?(?:t[dhr]|thead|tbody|tfoot|table)\b|\z)"), F.lit(1))
    return F.transform(bodies, lambda x: F.trim(F.regexp_replace(x, r"(?s)<!--.*?-->|</?[A-Za-z][^>]*>", "")))


def completeness(table_html: Column) -> list[Column]:
    """``cells``, ``filled`` and ``completeness`` of a table."""
    texts = cell_texts(table_html)
    filled, n = F.size(F.filter(texts, lambda x: x != "")), F.size(texts)
    share = F.when(n == 0, F.lit(0.0)).when(~table_html.rlike(r"(?i)<td\b"), F.when(filled > 0, 0.5).otherwise(0.0)).otherwise(filled / n)
    return [n.alias("cells"), filled.alias("filled"), F.round(share, 3).alias("completeness")]


def match_cells(cells: list[str], lines: list[str], least: float = 0.85) -> list[tuple[int, int, float]]:
    """(cell, line, ratio): cells with the line that says the same, the most alike first, each cell and line once. Equal ratios go to the earlier cell and line."""
    bare = [["".join(t.lower().split()) for t in side] for side in (cells, lines)]
    pairs = []
    for i, a in enumerate(bare[0]):
        for j, b in enumerate(bare[1]):
            # the ratio cannot exceed twice the shorter length over both
            if a and b and 2 * min(len(a), len(b)) >= least * (len(a) + len(b)) and (r := difflib.SequenceMatcher(None, a, b, autojunk=False).ratio()) >= least:
                pairs.append((-r, i, j))
    out, taken_cells, taken_lines = [], set(), set()
    for r, i, j in sorted(pairs):
        if i not in taken_cells and j not in taken_lines:
            taken_cells.add(i)
            taken_lines.add(j)
            out.append((i, j, round(-r, 6)))
    return sorted(out)


def cell_lines(fragments: DataFrame, lines: DataFrame) -> DataFrame:
    """(fragment_no, cell, line_id, ratio, before, after): cells of tables that a line of their page says otherwise, to be taken from the line.

    ``fragments``: fragment_no, s3_fileid, position.page, structured_payload.table_html; ``lines``: line_id, s3_fileid, page, text. A page's lines are gathered as one array, bounded by
    the page; tables and pages without a partner give no rows.
    """
    page = lines.filter("text is not null").groupBy("s3_fileid", "page").agg(F.sort_array(F.collect_list(F.struct("line_id", "text"))).alias("l"))
    cells = fragments.filter("structured_payload.table_html is not null").select("fragment_no", "s3_fileid", F.col("position.page").alias("page"), cell_texts(F.col("structured_payload.table_html")).alias("c"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for no, c, l in zip(pdf["fragment_no"], pdf["c"], pdf["l"], strict=True):
                texts = [x["text"] for x in l]
                out += [(no, i, l[j]["line_id"], r, c[i], texts[j]) for i, j, r in match_cells(list(c), texts) if c[i] != texts[j].strip()]
            yield pd.DataFrame(out, columns=["fragment_no", "cell", "line_id", "ratio", "before", "after"])

    return cells.join(page, ["s3_fileid", "page"]).select("fragment_no", "c", "l").mapInPandas(run, "fragment_no long, cell int, line_id long, ratio double, before string, after string")


def grids(df: DataFrame, table_html: str) -> DataFrame:
    """The other columns with headers and rows of the table in ``table_html``; null tables give no rows."""
    keep = [c for c in df.columns if c not in (table_html, "headers", "rows")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [html_grid(t) for t in pdf[table_html]]
            yield pdf[keep].assign(headers=[g[0] for g in got], rows=[g[1] for g in got])

    types = dict(df.dtypes)
    return df.filter(F.col(table_html).isNotNull()).select(*keep, table_html).mapInPandas(run, ", ".join([*(f"`{c}` {types[c]}" for c in keep), GRID]))
