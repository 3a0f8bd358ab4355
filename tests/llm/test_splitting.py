from hypothesis import given, settings
from hypothesis import strategies as st

from sheafline.llm import splitting as S


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="аб d.\n\u0306😀", max_size=300), st.integers(1, 60), st.integers(0, 70), st.sampled_from(["chars", "tokens"]))
def test_pieces_cover_the_text_and_keep_the_limit(text, limit, overlap, unit):
    spans = S.split(text, limit, overlap, unit)
    if not text:
        assert spans == []
        return
    assert spans[0][0] == 0 and spans[-1][1] == len(text)
    for (a, b), (c, d) in zip(spans, spans[1:], strict=False):
        assert a < c <= b < d
    if unit == "chars":
        assert all(b - a <= limit for a, b in spans)
        if overlap < limit:
            assert all(b - c <= overlap for (_, b), (c, _) in zip(spans, spans[1:], strict=False))


def test_natural_boundaries():
    text = "One sentence here. " * 40
    spans = S.split(text, 200, 20)
    assert all(text[:b].rstrip().endswith(".") for _, b in spans)
    assert S.split("a" * 1000, 100, 10)[1][0] == 90
    assert S.split("abc", 0, 0) == [] and S.split("abc", 3, 0) == [(0, 3)]


def test_defects():
    text = "word " * 40  # 200 characters
    ok = [(0, 100), (90, 200)]
    assert S.audit(text, 100, 10, []) == ["unsplit"]
    assert S.audit(text, 120, 10, ok) == []
    assert S.audit(text, 105, 10, [(0, 100), (90, 200)]) == ["over"]
    assert S.audit(text, 120, 10, [(0, 100), (110, 200)]) == ["gap"]
    assert S.audit(text, 120, 10, [(0, 100), (80, 200)]) == ["overlap"]
    assert S.audit(text, 120, 10, [(0, 100), (100, 200)]) == ["overlap"]
    assert S.audit(text, 120, 10, [(0, 102), (95, 200)]) == ["midword"]
    assert S.audit(text, 120, 10, [(0, 100)]) == ["gap"]
    assert S.audit(None, 10, 0, []) == [] and S.audit("a", None, 0, []) == [] and S.audit("", 10, 0, []) == []


UNIT = "unit_no long, source_unit_id string, profile string, text string"
LIMIT = "profile string, unit string, max_size int, overlap int"
FRAGMENT = "fragment_no long, fragment_id string, updated_at timestamp, position struct<source_spans: array<struct<source_unit_id: string, char_start: int, char_end: int>>>"


def test_tables(spark):
    from datetime import datetime

    units = spark.createDataFrame([(1, "u1", "p", "word " * 40), (2, "u2", "p", None), (3, "u3", "p", ""), (4, "u4", "none", "x"), (1, "u1", "p", "word " * 40)], UNIT)
    limits = spark.createDataFrame([("p", "chars", 120, 10), ("p", "chars", 120, 10)], LIMIT)
    old, new = datetime(2025, 1, 1), datetime(2025, 1, 2)
    frags = spark.createDataFrame([(1, "f1", old, ([("u1", 0, 50)],)), (2, "f1", new, ([("u1", 0, 100)],)), (3, "f2", new, ([("u1", 90, 200), (None, 1, 2)],)), (4, "f3", new, None)], FRAGMENT)
    assert S.found(units, frags, limits).collect() == []
    assert {tuple(r) for r in S.found(units, frags.limit(0), limits).collect()} == {(1, "unsplit")}
    pieces = S.split_units(units, limits).collect()
    assert {r.unit_no for r in pieces} == {1} and len(pieces) == 2 * pieces[0].pieces
    assert S.split_units(units.limit(0), limits).count() == 0
    assert S.repaired(units, frags.limit(0), limits).count() == len(pieces)


def test_a_piece_starts_with_a_whole_token():
    assert S.split("dd.d", 2, 1, "tokens") == [(0, 3), (2, 4)]
    assert S.split("aa bb cc dd", 2, 1, "tokens") == [(0, 6), (3, 9), (6, 11)]
    assert S.split("ab" * 50, 1, 5, "tokens") == [(0, 100)]


def test_repaired_units_pass_the_audit(spark, data):
    from sheafline.session import table

    units, frags, limits = (table(spark, data, n) for n in ("source_units", "fragments", "size_limits"))
    by_unit = {}
    for r in S.repaired(units, frags, limits).collect():
        by_unit.setdefault(r.unit_no, []).append((r.char_start, r.char_end))
    assert by_unit
    rows = S.with_limits(units, limits).filter("text is not null and max_size is not null").collect()
    bad = [r.unit_no for r in rows if r.unit_no in by_unit and S.audit(r.text, r.max_size, r.overlap, by_unit[r.unit_no], r.unit)]
    assert not bad
