import html
import re
from collections import Counter, defaultdict

import oracle
import pytest

from sheafline.operators import chunking
from sheafline.plans import catalog
from sheafline.session import table


@pytest.fixture(scope="module")
def con(data):
    return oracle.connect(data)


def chunks(spark, data, rows, size=500, most=500):
    """Chunks are exact spans of their documents, in order, none longer than allowed, and nothing but blanks lies outside of them."""
    texts = {r.doc_id: r.text for r in table(spark, data, "documents").filter("text is not null").collect()}
    by = defaultdict(list)
    for r in rows:
        t = texts[r.doc_id]
        assert r.text == t[r.char_start : r.char_end].strip() and r.text and r.char_end - r.char_start <= most
        by[r.doc_id].append((r.chunk, r.char_start, r.char_end))
    assert set(by) == {d for d, t in texts.items() if t.strip()}
    for d, spans in by.items():
        spans.sort()
        assert [s[0] for s in spans] == list(range(len(spans)))
        bare, at = "", 0
        for _, a, b in spans:
            assert not texts[d][at:a].strip() and b > at
            bare, at = bare + texts[d][max(a, at) : b], max(at, b)
        assert not texts[d][at:].strip()


def sections(spark, data, rows):
    chunks(spark, data, rows)
    texts = {r.doc_id: r.text for r in table(spark, data, "documents").collect()}
    for r in rows:
        if r.section is not None:
            assert chunking.is_header(r.section) and r.section in texts[r.doc_id][: r.char_end]


def facts(spark, data, rows):
    """Values lie in their text in order; every number with a known unit that stands alone is found with its value."""
    texts = {r.doc_id: r.text for r in table(spark, data, "documents").filter("text is not null").collect()}
    by = defaultdict(list)
    for r in rows:
        assert r.raw in texts[r.doc_id] and r.raw == r.raw.strip()
        assert (r.number is not None) == (r.kind == "number" or r.kind == "duration" and r.low is None)
        assert r.low is None or r.low <= r.high
        by[r.doc_id].append((r.fact, r.number, r.unit))
    found = 0
    for d, t in texts.items():
        assert [f[0] for f in sorted(by[d])] == list(range(1, len(by[d]) + 1))
        have = {(n, u) for _, n, u in by[d]}
        for m in re.finditer(r"(?<![\w.,±–—-])(?<!\d )(?:при давлении|pressure of|зазором|clearance of) (\d+(?:,\d+)?) (МПа|MPa|мм|mm)(?![\w²³])", t):
            found += 1
            assert (float(m[1].replace(",", ".")), "MPa" if m[2] in ("МПа", "MPa") else "mm") in have
    assert found > 20


def cells(spark, data, rows):
    """Facts name their cell; without tables there are none."""
    tables = {r[0]: r[1] for r in table(spark, data, "fragments").select("fragment_no", "structured_payload.table_html").filter("table_html is not null").collect()}
    assert rows and all(r.fragment_no in tables and r.row >= 0 and r.column >= 0 for r in rows)
    for r in rows:
        plain = html.unescape(re.sub(r"<[^>]*>", " ", tables[r.fragment_no]))
        assert "".join(r.raw.split()) in "".join(plain.split())
    assert sum(r.number is not None and r.label != "" for r in rows) > 0.5 * len(rows)


def grids(spark, data, rows):
    """Grids are rectangles that hold each cell's text at least once."""
    tables = {r[0]: r[1] for r in table(spark, data, "fragments").select("fragment_no", "structured_payload.table_html").filter("table_html is not null").collect()}
    assert {r.fragment_no for r in rows} == set(tables)
    for r in rows:
        assert len({len(r.headers), *map(len, r.rows)}) == 1
        want = Counter("".join(html.unescape(re.sub(r"<[^>]*>", "", c)).split()) for c in re.split(r"(?i)<t[dh]\b[^>]*>", tables[r.fragment_no])[1:])
        have = Counter("".join(c.split()) for line in [r.headers, *r.rows] for c in line)
        assert not {c for c in want if c} - set(have)


def unglued(spark, data, rows):
    """Only blanks are added, and only between words of the list."""
    lines = {r.line_id: r.text for r in table(spark, data, "text_lines").filter("method = 'text_layer'").collect()}
    words = {r[0].lower() for r in table(spark, data, "word_list").select("word").filter("word is not null").collect()}
    assert len(rows) == len(lines)
    for r in rows:
        before = lines[r.line_id]
        assert r.changed == (r.text != before)
        if r.changed:
            assert r.text.replace(" ", "") == before.replace(" ", "")
            new = Counter(re.findall(r"[^\W\d_]+", r.text)) - Counter(re.findall(r"[^\W\d_]+", before))
            assert new and all(w.lower() in words for w in new)


def repaired(spark, data, rows):
    """Repairs keep the look: folded look-alikes of changed texts are what they were, but for dimension signs."""
    texts = {r.change_id: r.before for r in table(spark, data, "text_changes").collect()}
    assert {r.change_id for r in rows} == set(texts) and any(r.changed for r in rows)
    alike = str.maketrans("АВЕКМНОРСТУХаеорсухОЗбl", "ABEKMHOPCTYXaeopcyx0361")
    for r in rows:
        assert r.changed == (r.text != texts[r.change_id])
        if r.changed and not re.search(r"[øØ∅×⌀±]|10\^", r.text + texts[r.change_id]):
            assert len(r.text) == len(texts[r.change_id]) or re.sub(r"\s", "", r.text.translate(alike)).lower() == re.sub(r"\s", "", texts[r.change_id].translate(alike)).lower()


def prose(spark, data, rows):
    """True formulas stay; what is read as prose holds no command."""
    formulas = {r.fragment_no: r.formula for r in table(spark, data, "fragments").filter("formula is not null").collect()}
    assert {r.fragment_no for r in rows} == set(formulas)
    for r in rows:
        assert r.changed == (r.text != formulas[r.fragment_no])
        assert not r.changed or "\\" not in r.text
        assert not (r.changed and "=" in formulas[r.fragment_no])


CHECKS = {
    "chunks_fixed": chunks, "chunks_paragraph": lambda *a: chunks(*a, most=530), "chunks_semantic": sections, "facts_from_documents": facts, "facts_from_tables": cells,
    "table_grids": grids, "unglued_lines": unglued, "repaired_changes": repaired, "formula_prose": prose,
}


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, data, con, name):
    df = catalog.QUERIES[name](spark, data)
    if name in catalog.SQL:
        assert not oracle.differences(df, con, catalog.SQL[name])
    else:
        CHECKS[name](spark, data, df.collect())


def test_entry_points(spark):
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert set(catalog.QUERIES) <= names and set(entry.oracle_sql()) <= names
