from collections import defaultdict

import oracle
import pytest

from sheafline.llm import dedup, leakage, markup, packing, scans, splitting
from sheafline.llm import queries as Q
from sheafline.llm.glyphs import fold_words
from sheafline.session import table


def rows_of(spark, data, name, *columns):
    return table(spark, data, name).select(*columns).collect()


def found_markup(spark, data, rows):
    """The kinds of every document and fragment, read one by one; lines of plain prose are no cases."""
    want = set()
    for r in rows_of(spark, data, "documents", "doc_id", "text"):
        want |= {("documents", r.doc_id, k) for k in markup.clean_text(r.text)[1]}
        if r.text and all(c.isalnum() or c in " .,\n" for c in r.text):
            assert not any(x[:2] == ("documents", r.doc_id) for x in want)
    for r in rows_of(spark, data, "fragments", "fragment_no", "text", "formula", "structured_payload.table_html"):
        kinds = {*markup.clean_text(r.text)[1], *markup.kinds_of_cells(r.table_html)}
        if r.formula and markup.formula_prose(r.formula)[0]:
            kinds.add("mangled")
        want |= {("fragments", r.fragment_no, k) for k in kinds}
    assert {tuple(r) for r in rows} == want and len(rows) == len(want)


def clean(spark, data, rows):
    """Cleaning twice changes nothing more, but for what text shows literally; words of prose survive."""
    texts = {r.doc_id: r.text for r in rows_of(spark, data, "documents", "doc_id", "text")}
    assert {r.doc_id for r in rows} == set(texts)
    for r in rows:
        text = texts[r.doc_id]
        if not text or not markup.SUSPECTED.search(text):
            assert r.clean == text
        else:
            assert not {"<p>", "</p>", "<b>", "</b>", "''", "**", "&nbsp;", "\\section"} & set(r.clean.split())
            assert 0 < len(r.clean) <= len(text)


def pairs(spark, data, rows):
    files = [(r.file_no, " ".join(sorted(fold_words(r.text_sample)))) for r in dedup.accepted(table(spark, data, "intake_files")).orderBy("file_no").collect()]
    files = [(i, w) for i, w in files if w]
    want = {(next(a for a, wa in files[:k] if dedup.bag_distance(wa, wb) <= dedup.LIMIT), b) for k, (b, wb) in enumerate(files) if any(dedup.bag_distance(wa, wb) <= dedup.LIMIT for _, wa in files[:k])}
    assert {tuple(r) for r in rows} == want


def newest_pairs(spark, data, rows):
    newest = max(r.batch_no for r in rows_of(spark, data, "intake_files", "batch_no") if r.batch_no is not None)
    batch = {r.file_no for r in rows_of(spark, data, "intake_files", "file_no", "batch_no") if r.batch_no == newest}
    everything = {tuple(r) for r in dedup.found(table(spark, data, "intake_files")).collect()}
    assert {tuple(r) for r in rows} == {p for p in everything if p[1] in batch}


def defects(spark, data, rows):
    """Every unit without pieces that is too long is there, and none whose pieces tile it within the limit."""
    by = defaultdict(set)
    for r in rows:
        by[r.unit_no].add(r.defect)
    limits = {r.profile: r for r in table(spark, data, "size_limits").collect()}
    pieces = {r.source_unit_id: [(p.char_start, p.char_end) for p in r.pieces] for r in splitting.stored_pieces(table(spark, data, "fragments")).collect()}
    for u in rows_of(spark, data, "source_units", "unit_no", "source_unit_id", "profile", "text"):
        lim = limits.get(u.profile)
        if u.text is None or lim is None:
            assert u.unit_no not in by
            continue
        size = len(u.text) if lim.unit == "chars" else len(splitting.TOKEN.findall(u.text))
        own = sorted(pieces.get(u.source_unit_id, []))
        if not own:
            assert by.get(u.unit_no, set()) == ({"unsplit"} if size > lim.max_size else set())
        elif lim.unit == "chars":
            over = any(b - a > lim.max_size for a, b in own)
            outside = "".join(u.text[max([b for _, b in own[:k]], default=0) : a] for k, (a, _) in enumerate(own)) + u.text[max(b for _, b in own) :]
            assert ("over" in by[u.unit_no]) == over and ("gap" in by[u.unit_no]) == bool(outside.strip())
    assert set().union(*by.values()) <= {"unsplit", "over", "gap", "overlap", "midword"}


def pieces(spark, data, rows):
    texts = {r.unit_no: r for r in rows_of(spark, data, "source_units", "unit_no", "profile", "text")}
    limits = {r.profile: r for r in table(spark, data, "size_limits").collect()}
    by = defaultdict(list)
    for r in rows:
        assert r.text == texts[r.unit_no].text[r.char_start : r.char_end]
        by[r.unit_no].append((r.char_start, r.char_end))
    for u, spans in by.items():
        lim, text = limits[texts[u].profile], texts[u].text
        if len(spans) > 1:
            assert splitting.audit(text, lim.max_size, lim.overlap, spans, lim.unit) == []
        assert min(a for a, _ in spans) == 0 and max(b for _, b in spans) == len(text)


def repairs(spark, data, rows):
    wrong = {r.unit_no for r in splitting.found(table(spark, data, "source_units"), table(spark, data, "fragments"), table(spark, data, "size_limits")).collect()}
    assert {r.unit_no for r in rows} == wrong


def disguised(spark, data, rows):
    """Every line with a full-width form, an invisible character or an odd space is there; a plain one-alphabet line is not."""
    got = {r.rec_id for r in rows if r.rec_table == "text_lines"}
    for r in table(spark, data, "text_lines").filter("method = 'text_layer' and text is not null").collect():
        if any(c in "​‌‍­⁠﻿  " or "！" <= c <= "～" for c in r.text):
            assert r.line_id in got
        letters = [c for c in r.text if c.isalpha()]
        if all(c in " .,-0123456789" or "а" <= c.lower() <= "я" or c in "ёЁ" for c in r.text) and letters:
            assert r.line_id not in got
    same = {r.change_id for r in table(spark, data, "text_changes").collect() if r.before is None or r.after is None or r.before == r.after}
    assert not same & {r.rec_id for r in rows if r.rec_table == "text_changes"}


def forms(spark, data, rows):
    lines = {r.line_id: r.text for r in table(spark, data, "text_lines").filter("method = 'text_layer' and text is not null").collect()}
    assert {r.line_id for r in rows} == set(lines)
    assert not any(c in r.form for r in rows for c in "​­ ﻿") and sum(r.form != lines[r.line_id] for r in rows) > 0


def noise(spark, data, rows):
    """Hyphens and page numbers against a plain reading of the lines."""
    lines = {r.line_id: r for r in table(spark, data, "text_lines").filter("method = 'tesseract' and text is not null").collect()}
    kinds = defaultdict(set)
    for r in rows:
        kinds[r.kind].add(r.line_id)
    assert set(kinds) <= {"hyphen", "misread", "header", "pageno"} and set().union(*kinds.values()) <= set(lines)
    ends = {i for i, r in lines.items() if len(r.text.strip()) > 1 and r.text.strip()[-1] in scans.MARKS and r.text.strip()[-2].isalnum()}
    assert kinds["hyphen"] <= ends and len(kinds["hyphen"]) > 0.8 * len(ends - kinds["header"] - kinds["pageno"])
    assert all(scans.page_number(lines[i].text) is not None for i in kinds["pageno"]) and not kinds["pageno"] & kinds["header"]


def paragraphs(spark, data, rows):
    """No line of furniture is left, no line of the body is lost: the words of both sides agree but for cut and misread ones."""
    assert len({(r.s3_fileid, r.page, r.paragraph) for r in rows}) == len(rows) and all(r.text.strip() for r in rows)
    furniture = {r.line_id for r in scans.found(table(spark, data, "text_lines"), table(spark, data, "word_list")).filter("kind in ('header', 'pageno')").collect()}
    body = table(spark, data, "text_lines").filter("method = 'tesseract' and text is not null").collect()
    once = {(r.s3_fileid, r.page, r.line_no): r for r in sorted(body, key=lambda r: r.line_id) if r.line_id not in furniture}
    have, want = sum(len(r.text.split()) for r in rows), sum(len(r.text.split()) for r in once.values())
    assert 0.93 * want < have <= want


def packed(spark, data, rows):
    profiles = packing.profiles_of(table(spark, data, "size_limits"))
    docs = {r.doc_id for r in rows_of(spark, data, "documents", "doc_id")}
    sizes = {(r.doc_id): r.n for r in table(spark, data, "documents").select("doc_id", packing.token_count(packing.F.col("text")).alias("n")).collect()}
    for p, cap in profiles.items():
        mine = [r for r in rows if r.profile == p]
        assert {r.doc_id for r in mine} == docs
        fill, tokens = defaultdict(int), defaultdict(int)
        for r in mine:
            tokens[r.doc_id] += r.tokens
            if r.container is not None:
                fill[r.container] += r.tokens
        assert max(fill.values()) <= cap and dict(tokens) == sizes


def fill(spark, data, rows):
    assert {r.profile for r in rows} == set(packing.profiles_of(table(spark, data, "size_limits")))
    # nearly as few containers as the tokens need
    assert all(r.filled <= 1 and r.containers <= 1.02 * r.tokens / r.capacity + 1 for r in rows)


def leaks(spark, data, rows):
    items = [(r.item_id, fold_words(r.text or "")) for r in rows_of(spark, data, "eval_items", "item_id", "text")]
    want = set()
    for d in rows_of(spark, data, "documents", "doc_id", "text"):
        body = leakage.Document(d.text or "")
        for i, w in items:
            for k in range(len(w) - leakage.RUN + 1):
                part = "".join(w[k : k + leakage.RUN])
                if part in body.stream and any(o in body.starts and o + len(part) in body.ends for o in body.places(part)):
                    want.add((d.doc_id, i))
                    break
    assert {tuple(r) for r in rows} == want


def aligned(spark, data, rows):
    assert all(0 <= r.score <= 1 and r.run >= 0 and (r.verdict == "copy") == (r.run >= leakage.RUN) for r in rows)
    copies = {tuple(r) for r in Q.p7_found(spark, data).collect()}
    assert {(r.doc_id, r.item_id) for r in rows if r.verdict == "copy"} == copies


def levels(spark, data, rows):
    """Levels agree with most of the valid grades; nobody has two."""
    own = {r.doc_id: r.reading_level for r in rows}
    assert len(own) == len(rows) and set(own.values()) <= {1, 2, 3, 4}
    grades = [r for r in table(spark, data, "doc_levels").collect() if r.reading_level in (1, 2, 3, 4) and r.doc_id in own]
    assert sum(own[r.doc_id] == r.reading_level for r in grades) > 0.6 * len(grades)


CHECKS = {
    "p1_found": found_markup, "p1_clean": clean, "p2_found": pairs, "p2_last_batch": newest_pairs, "p3_found": defects, "p3_pieces": pieces, "p3_repaired": repairs, "p4_found": disguised, "p4_forms": forms,
    "p5_found": noise, "p5_paragraphs": paragraphs, "p6_pack": packed, "p6_fill": fill, "p7_found": leaks, "p7_aligned": aligned, "p8_found": levels,
}


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_query(spark, data, name):
    df = Q.QUERIES[name](spark, data)
    if name in Q.SQL:
        assert not oracle.differences(df, oracle.connect(data), Q.SQL[name])
    if name not in CHECKS:
        return
    rows = df.collect()
    if name.endswith("_found"):
        assert len(set(rows)) == len(rows)
    CHECKS[name](spark, data, rows)
