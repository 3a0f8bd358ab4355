"""Names, types and sizes of files as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Extension, kind and mime of the formats that are read, and whether they are supported.
FILE_TYPES: tuple[tuple[str, str, str, bool], ...] = (
    ("pdf", "pdf", "application/pdf", True),
    ("jpg", "image", "image/jpeg", True),
    ("jpeg", "image", "image/jpeg", True),
    ("png", "image", "image/png", True),
    ("tiff", "image", "image/tiff", True),
    ("tif", "image", "image/tiff", True),
    ("bmp", "image", "image/bmp", True),
    ("docx", "office_text", "application/vnd.openxmlformats-officedocument.wordprocessingml.document", True),
    ("doc", "office_text", "application/msword", True),
    ("xlsx", "spreadsheet", "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet", True),
    ("xlsm", "spreadsheet", "application/vnd.ms-excel.sheet.macroEnabled.12", True),
    ("xls", "spreadsheet", "application/vnd.ms-excel", True),
    ("ods", "spreadsheet", "application/vnd.oasis.opendocument.spreadsheet", True),
    ("csv", "spreadsheet", "text/csv", True),
    ("txt", "plain_text", "text/plain", True),
    ("md", "plain_text", "text/markdown", True),
    ("dxf", "cad", "image/vnd.dxf", True),
    ("dwg", "cad", "image/vnd.dwg", False),
)
#: The order in which extensions are tried for an id without one.
PROBE_ORDER = tuple("pdf png jpg jpeg tiff tif bmp docx doc xlsx xlsm xls ods csv txt md dxf".split())
ALIASES = {"jpeg": "jpg", "tif": "tiff"}


def file_name(file_id: Column) -> Column:
    """The last path part, percent escapes read."""
    return F.element_at(F.split(F.try_url_decode(file_id), "/"), -1)


def extension(file_id: Column) -> Column:
    """Lower-case extension without the dot; empty where there is none."""
    return F.lower(F.regexp_extract(file_name(file_id), r"\.([A-Za-z0-9]{1,8})$", 1))


def lookup(value: Column, pairs: dict[str, str], default: str | None = None) -> Column:
    """A small literal map as an expression; unknown keys give the default."""
    table = F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])
    return F.coalesce(F.try_element_at(table, value), F.lit(default))


def kind(ext: Column) -> Column:
    return lookup(ext, {e: k for e, k, _, _ in FILE_TYPES}, "unknown")


def mime(ext: Column) -> Column:
    return lookup(ext, {e: m for e, _, m, _ in FILE_TYPES}, "application/octet-stream")


def canonical_extension(ext: Column) -> Column:
    return F.coalesce(lookup(ext, ALIASES), ext)


def refusal(ext: Column) -> Column:
    """Why a file of this extension is not read; null if it is."""
    known = F.array(*[F.lit(e) for e, _, _, ok in FILE_TYPES if ok])
    closed = F.array(*[F.lit(e) for e, _, _, ok in FILE_TYPES if not ok])
    return F.when(ext == "", F.lit("no extension")).when(F.array_contains(closed, ext), F.lit("needs converter")).when(~F.array_contains(known, ext), F.lit("unknown type"))


def magic(head: Column) -> Column:
    """The format by the first bytes: pdf, png, jpg, tiff, bmp, dwg, ole, zip, dxf or null."""
    h = F.hex(F.substring(head, 1, 8))
    text = F.decode(F.substring(head, 1, 64), "ISO-8859-1")
    return (
        F.when(h.startswith("255044462D"), "pdf")
        .when(h.startswith("89504E470D0A1A0A"), "png")
        .when(h.startswith("FFD8FF"), "jpg")
        .when(h.startswith("49492A00") | h.startswith("4D4D002A"), "tiff")
        .when(h.startswith("424D"), "bmp")
        .when(text.rlike(r"^AC\d{4}"), "dwg")
        .when(h.startswith("D0CF11E0A1B11AE1"), "ole")
        .when(h.startswith("504B0304"), "zip")
        .when(text.rlike(r"^\s*0\s+SECTION|^\s*999"), "dxf")
    )


def ole_format(head: Column) -> Column:
    """Which office format a compound file holds, by the stream names in its first 64 KiB (UTF-16)."""
    h = F.hex(F.substring(head, 1, 65536))
    name = lambda s: F.lit(s.encode("utf-16-le").hex().upper())
    return F.when(h.contains(name("WordDocument")), "doc").when(h.contains(name("Workbook")) | h.contains(name("Book")), "xls")


def has_any(text: Column, marks: tuple[str, ...]) -> Column:
    low = F.lower(text)
    out = F.lit(False)
    for m in marks:
        out = out | F.contains(low, F.lit(m))
    return out
