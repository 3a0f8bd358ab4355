"""Chunking of texts: fixed windows, packed paragraphs, sections.

A text is a list of paragraphs (blank-line separated, else lines). Cutting is sequential, so it runs in an Arrow-fed generator that
emits spans; nothing crosses documents, so it needs no shuffle. Spans are exact: ``text[start:end]`` is the chunk before trimming.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafline.operators.facts import slices

SIZE, OVERLAP, LEAST = 500, 50, 30
#: How far back a cut looks for the end of a sentence.
REACH = 120
SENTENCE, BLANK = re.compile(r"[.!?]\s|\n\n"), re.compile(" ")
# Words that open a numbered part, and names that open a standard's title.
PART_WORDS = frozenset("глава раздел приложение chapter section appendix".split())
STANDARD_WORDS = frozenset("ГОСТ ОСТ ТУ СНиП СП".split())
LONGEST_HEADING = 200

Span = tuple[int, int]


def split_positions(text: str, size: int, overlap: int) -> list[Span]:
    """Windows of at most ``size`` characters: cut after the last sentence that ends in their last 120 characters, else after the last blank, else hard.

    The places after sentences and after blanks are two sorted arrays; a cut is a binary search in them. A window begins ``overlap`` before the end of the one before, and always
    later than it began.
    """
    size = max(1, size)
    overlap = min(max(0, overlap), size - 1)
    sentences, blanks = [m.end() for m in SENTENCE.finditer(text)], [m.end() for m in BLANK.finditer(text)]
    out: list[Span] = []
    start = 0
    while len(text) - start > size:
        limit = start + size
        end = limit
        for places, low in ((sentences, max(start + 1, limit - REACH)), (blanks, start + 1)):
            k = bisect_left(places, limit) - 1
            if k >= 0 and places[k] > low:
                end = places[k]
                break
        out.append((start, end))
        start = end - overlap if end - overlap > start else end
    if start < len(text):
        out.append((start, len(text)))
    return out


def paragraphs_of(text: str) -> list[Span]:
    """Spans of the paragraphs: between blank lines if there are any, else lines."""
    gap = r"\n[ \t]*\n\s*" if re.search(r"\n[ \t]*\n", text) else r"\n+"
    out, at = [], 0
    for m in re.finditer(gap, text):
        out.append((at, m.start()))
        at = m.end()
    out.append((at, len(text)))
    return [(a, b) for a, b in out if text[a:b].strip()]


def is_header(text: str) -> bool:
    """A heading by its look: short, and a numbered title, a part word with a number, a standard's name, or seven letters and more in capitals only."""
    words = text.split(None, 2)
    if not words or len(text.strip()) > LONGEST_HEADING:
        return False
    first, more = words[0], len(words) > 1
    number = first.rstrip(".").split(".")
    if more and all(n.isdigit() for n in number):
        return True
    if more and (first in STANDARD_WORDS or first.lower() in PART_WORDS and words[1][:1].isdigit()):
        return True
    letters = [c for c in text if not c.isspace() and c != "-"]
    return len(letters) > 6 and all(c.isalpha() and c.isupper() for c in letters)


def packed(text: str, size: int, overlap: int, sections: bool, least: int) -> Iterator[tuple[int, int, str | None]]:
    """Paragraphs packed up to ``size``; with ``sections`` a heading opens a new chunk and names it, without it short chunks join their forerunner."""
    chunks: list[list] = []  # start, end, title, whether it may grow
    title: str | None = None
    for a, b in paragraphs_of(text):
        body = text[a:b]
        head = sections and is_header(body)
        if head:
            title = body.strip()
        if b - a > size:
            chunks += [[a + s, a + e, title, False] for s, e in split_positions(body, size, overlap) if body[s:e].strip()]
            continue
        last = chunks[-1] if chunks else None
        if last and last[3] and not head and b - last[0] <= size:
            last[1] = b
        elif last and last[3] and not sections and (b - a < least or last[1] - last[0] < least) and b - last[0] <= size + least:
            last[1] = b
        else:
            chunks.append([a, b, title, True])
    for a, b, t, _ in chunks:
        yield a, b, t


def chunk_text(text: str, strategy: str, size: int = SIZE, overlap: int = OVERLAP, least: int = LEAST) -> list[tuple[int, int, str | None]]:
    if strategy == "fixed":
        return [(a, b, None) for a, b in split_positions(text, size, overlap) if text[a:b].strip()]
    if strategy in ("paragraph", "semantic"):
        return list(packed(text, size, overlap, strategy == "semantic", least))
    raise ValueError(f"unknown chunking strategy {strategy!r}; there are fixed, paragraph, semantic")


STRATEGIES = ("fixed", "paragraph", "semantic")
# The strategy of a kind of document, and of a source, where none is named.
BY_TYPE, BY_SOURCE = {"regulation": "semantic", "manual": "semantic", "letter": "paragraph", "table": "fixed"}, {"tesseract": "paragraph", "text_layer": "semantic"}


def strategy_of(explicit: str | None = None, doc_type: str | None = None, source: str | None = None) -> str:
    """The strategy that is named, else that of the document's type, else of its source, else paragraphs; an unknown name raises."""
    if explicit is not None:
        if explicit not in STRATEGIES:
            raise ValueError(f"unknown chunking strategy {explicit!r}; there are {', '.join(STRATEGIES)}")
        return explicit
    return BY_TYPE.get(doc_type or "") or BY_SOURCE.get(source or "") or "paragraph"


def chunks(df: DataFrame, id_col: str, text: str, strategy: str, size: int = SIZE, overlap: int = OVERLAP, least: int = LEAST) -> DataFrame:
    """(id, chunk, char_start, char_end, section, text). Null and blank texts give no rows; an unknown strategy raises at once."""
    chunk_text("", strategy)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = ((i, n, a, b, s, t[a:b].strip()) for i, t in zip(pdf["id"], pdf["text"], strict=True) for n, (a, b, s) in enumerate(chunk_text(t, strategy, size, overlap, least)))
            yield from slices(rows, [id_col, "chunk", "char_start", "char_end", "section", "text"])

    source = df.select(F.col(id_col).alias("id"), F.col(text).alias("text")).filter("text is not null")
    kind = dict(df.dtypes)[id_col]
    return source.mapInPandas(run, f"{id_col} {kind}, chunk int, char_start int, char_end int, section string, text string")
