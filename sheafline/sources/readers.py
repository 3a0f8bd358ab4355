"""File readers: bytes to blocks. Text, Markdown, CSV, DOCX, XLSX, ODS and DXF with the standard library.

``read_files`` lists a folder with ``binaryFile``; names and sizes are filtered before any content is read, and each file is parsed where it lies. A file
that cannot be read gives one block of type ``error`` and never fails the job. Formats that need outside binaries (PDF, images, BIFF, DWG) go to providers.
"""

from __future__ import annotations

import csv
import io
import re
import zipfile
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafline.functions.files import extension
from sheafline.operators.tables import html_grid, markdown_tables

MOST_CELLS = 5_000_000
ENCODINGS = ("utf-8-sig", "cp1251", "koi8-r")
Block = dict

BLOCKS = "path string, block_no int, type string, text string, headers array<string>, rows array<array<string>>, sheet string, section_path array<string>"
_EMPTY = {"type": "text", "text": None, "headers": None, "rows": None, "sheet": None, "section_path": None}


class TooLarge(ValueError):
    """A table over the cell budget: refused, never cut."""


def budget(cells: int) -> None:
    if cells > MOST_CELLS:
        raise TooLarge(f"{cells} cells are more than {MOST_CELLS}")


def decode(data: bytes) -> str:
    """UTF-8 (with or without mark), else the single-byte Cyrillic encoding that gives more lower-case words."""
    try:
        return data.decode("utf-8-sig")
    except UnicodeDecodeError:
        texts = [data.decode(e, "replace") for e in ENCODINGS[1:]]
        return max(texts, key=lambda t: len(re.findall(r"(?<![А-Яа-яЁё])[А-ЯЁ]?[а-яё]{2,}(?![А-Яа-яЁё])", t)))


def grid_block(grid: list[list[str]], sheet: str | None = None) -> Iterator[Block]:
    rows = [r for r in grid if any(c.strip() for c in r)]
    if rows:
        width = max(map(len, rows))
        rows = [r + [""] * (width - len(r)) for r in rows]
        yield {"type": "table", "headers": rows[0], "rows": rows[1:], "sheet": sheet}


def read_csv(data: bytes) -> Iterator[Block]:
    text = decode(data)
    sample = "\n".join(text.splitlines()[:20])
    try:
        dialect: type[csv.Dialect] | csv.Dialect = csv.Sniffer().sniff(sample, ",;\t|")
    except csv.Error:
        dialect = csv.excel
    grid = list(csv.reader(io.StringIO(text, newline=""), dialect))
    budget(sum(map(len, grid)))
    yield from grid_block(grid)


def read_text(data: bytes, markdown: bool = False) -> Iterator[Block]:
    """Paragraphs between blank lines; Markdown headings give the section path, pipe tables become tables."""
    path: list[str] = []
    for part in re.split(r"\n[ \t]*\n", decode(data).replace("\r\n", "\n")):
        lines = part.strip("\n")
        if not lines.strip():
            continue
        if markdown:
            for head in re.finditer(r"(?m)^(#{1,6})\s+(.*?)\s*#*$", lines):
                path = [*path[: len(head[1]) - 1], head[2]]
            lines = re.sub(r"(?m)^#{1,6}\s+", "", lines)
            for headers, rows in (found := markdown_tables(lines)):
                yield {"type": "table", "headers": headers, "rows": rows, "section_path": list(path)}
            if found:
                continue
        yield {"type": "text", "text": lines.strip(), "section_path": list(path) or None}


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def read_docx(data: bytes) -> Iterator[Block]:
    """Paragraphs and tables in the order of the body; heading styles give the section path."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        body = next(e for e in ElementTree.fromstring(z.read("word/document.xml")) if _local(e.tag) == "body")
    text_of = lambda e: "".join(x.text or "" if _local(x.tag) == "t" else "\t" if _local(x.tag) == "tab" else "\n" if _local(x.tag) == "br" else "" for x in e.iter())
    path: list[str] = []
    for e in body:
        if _local(e.tag) == "p":
            text = text_of(e).strip()
            style = next((v for x in e.iter() if _local(x.tag) == "pStyle" for k, v in x.attrib.items() if _local(k) == "val"), "")
            if text and (m := re.fullmatch(r"(?i)(?:heading|заголовок)\s*(\d)", style)):
                path = [*path[: int(m[1]) - 1], text]
            if text:
                yield {"type": "text", "text": text, "section_path": list(path) or None}
        elif _local(e.tag) == "tbl":
            grid = [[text_of(c).strip() for c in r if _local(c.tag) == "tc"] for r in e if _local(r.tag) == "tr"]
            yield from grid_block(grid)


def read_xlsx(data: bytes) -> Iterator[Block]:
    """Each sheet one table; the stored value of a cell, else its formula."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = set(z.namelist())
        shared = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(t.text or "" for t in si.iter() if _local(t.tag) == "t") for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml"))]
        book = ElementTree.fromstring(z.read("xl/workbook.xml"))
        titles = [e.attrib.get("name") for e in book.iter() if _local(e.tag) == "sheet"]
        files = sorted((n for n in names if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)), key=lambda n: int(re.findall(r"\d+", n)[-1]))
        total = 0
        for title, name in zip(titles, files, strict=False):
            grid: list[list[str]] = []
            for row in (e for e in ElementTree.fromstring(z.read(name)).iter() if _local(e.tag) == "row"):
                cells: list[str] = []
                for c in row:
                    letters = re.match("[A-Z]+", c.attrib.get("r", ""))
                    at = len(cells)
                    if letters:
                        at = 0
                        for x in letters[0]:
                            at = at * 26 + ord(x) - 64
                        at -= 1
                    budget(total + at)
                    cells += [""] * (at - len(cells))
                    parts = {_local(x.tag): x for x in c}
                    value = parts["v"].text if "v" in parts else "".join(t.text or "" for t in parts["is"].iter() if _local(t.tag) == "t") if "is" in parts else f"={parts['f'].text}" if "f" in parts else ""
                    cells.append(shared[int(value)] if c.attrib.get("t") == "s" and value else value or "")
                total += len(cells)
                budget(total)
                grid.append(cells)
            yield from grid_block(grid, title)


def read_ods(data: bytes) -> Iterator[Block]:
    """Each sheet one table; repeated cells and rows are spelled out, repeated blanks at the end are not."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        root = ElementTree.fromstring(z.read("content.xml"))
    attr = lambda e, name: next((v for k, v in e.attrib.items() if _local(k) == name), None)
    total = 0
    for sheet in (e for e in root.iter() if _local(e.tag) == "table"):
        grid: list[list[str]] = []
        for row in (e for e in sheet.iter() if _local(e.tag) == "table-row"):
            cells: list[str] = []
            blanks = 0
            for c in (e for e in row if _local(e.tag) in ("table-cell", "covered-table-cell")):
                text = "\n".join("".join(p.itertext()) for p in c if _local(p.tag) == "p")
                n = int(attr(c, "number-columns-repeated") or 1)
                if not text:
                    blanks += n
                    continue
                budget(total + len(cells) + blanks + n)
                cells += [""] * blanks + [text] * n
                blanks = 0
            n = int(attr(row, "number-rows-repeated") or 1) if cells else 1
            total += n * len(cells)
            budget(total)
            grid += [list(cells) for _ in range(n)]
        yield from grid_block(grid, attr(sheet, "name"))


def read_dxf(data: bytes) -> Iterator[Block]:
    """Texts of the entities of an ASCII drawing: TEXT, MTEXT, ATTRIB, DIMENSION with an own text; the layer as the sheet."""
    lines = decode(data).replace("\r\n", "\n").split("\n")
    pairs = [(lines[i].strip(), lines[i + 1].rstrip("\n")) for i in range(0, len(lines) - 1, 2)]
    kind, values, inside = "", {}, False
    for code, value in [*pairs, ("0", "EOF")]:
        if code != "0":
            if code == "2" and kind == "SECTION":
                inside = value == "ENTITIES"
            values.setdefault(code, []).append(value)
            continue
        if inside and kind in ("TEXT", "MTEXT", "ATTRIB", "ATTDEF", "DIMENSION"):
            text = "".join([*values.get("3", []), *values.get("1", [])])
            text = re.sub(r"\\P", "\n", re.sub(r"\\[A-OQ-Za-z][^;\\]*;|[{}]", "", text)).replace("%%c", "⌀").replace("%%d", "°").replace("%%p", "±").strip()
            if text and text != "<>":
                yield {"type": "text", "text": text, "sheet": values.get("8", [None])[0]}
        kind, values = value.strip(), {}


def read_html(data: bytes) -> Iterator[Block]:
    for m in re.finditer(r"(?is)<table\b.*?</table>", decode(data)):
        headers, rows = html_grid(m[0])
        yield {"type": "table", "headers": headers, "rows": rows}


READERS: dict[str, Callable[[bytes], Iterator[Block]]] = {
    "csv": read_csv,
    "txt": read_text,
    "md": lambda d: read_text(d, True),
    "docx": read_docx,
    "xlsx": read_xlsx,
    "xlsm": read_xlsx,
    "ods": read_ods,
    "dxf": read_dxf,
    "html": read_html,
}


def zip_format(data: bytes) -> str | None:
    """Which office format a zip holds, by its parts."""
    try:
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            names = set(z.namelist())
            if "xl/vbaProject.bin" in names:
                return "xlsm"
            if "xl/workbook.xml" in names:
                return "xlsx"
            if "word/document.xml" in names:
                return "docx"
            if "mimetype" in names and b"spreadsheet" in z.read("mimetype"):
                return "ods"
    except (zipfile.BadZipFile, KeyError, OSError):
        return None
    return None


def blocks_of(name: str, data: bytes) -> list[Block]:
    """The blocks of one file, by its content where a zip says what it is, else by its extension."""
    ext = name.rsplit(".", 1)[-1].lower() if "." in name else ""
    if data[:4] == b"PK\x03\x04":
        ext = zip_format(data) or ext
    reader = READERS.get(ext)
    if reader is None:
        return [{**_EMPTY, "type": "error", "text": f"no reader for {ext or 'a name without extension'}"}]
    try:
        return [{**_EMPTY, **b} for b in reader(data)]
    except (TooLarge, zipfile.BadZipFile, ElementTree.ParseError, KeyError, StopIteration, ValueError, csv.Error) as e:
        return [{**_EMPTY, "type": "error", "text": f"{type(e).__name__}: {e}"}]


def parse(files: DataFrame) -> DataFrame:
    """Blocks of files given as (path, content)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                got = blocks_of(path, bytes(content))
                yield pd.DataFrame([{"path": path, "block_no": i, **b} for i, b in enumerate(got)], columns=["path", "block_no", *_EMPTY])

    return files.select("path", "content").mapInPandas(run, BLOCKS)


def read_files(spark: SparkSession, folder: str, extensions: tuple[str, ...] | None = None, most_bytes: int = 200 << 20) -> DataFrame:
    """Blocks of the files under ``folder``; extension and size are filtered on the listing, before content is read."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).filter(F.col("length") <= most_bytes)
    if extensions:
        listing = listing.filter(extension(F.col("path")).isin(*extensions))
    return parse(listing)
