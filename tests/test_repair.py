from hypothesis import given, settings
from hypothesis import strategies as st

from sheafline.operators import layout, repair, sheets

WORDS = frozenset("насос опора вал клапан сборочный чертёж the pump".split())


def test_mixed_words():
    assert repair.mixed_words("нacoc и опоpa", WORDS) == "насос и опора"
    assert repair.mixed_words("pump вал Ra", WORDS) == "pump вал Ra"
    assert "насос" in repair.readings("нacoc") and repair.readings("x" * 40) == ["x" * 40]


def test_designations_and_dimensions():
    assert repair.designations("HPУЕ.4556З4.84l см.") == "НРУЕ.455634.841 см."
    assert repair.designations("по rOCT 2.104-2006") == "по ГОСТ 2.104-2006"
    assert repair.dimensions("ø20 +/-0.5, М12х1,5, 20Н7, Rа 3,2, масштаб 7:2, 10⁻³") == "⌀20 ±0,5, M12×1,5, 20H7, Ra 3,2, масштаб 1:2, 10^-3"
    assert repair.dimensions("обычный текст 5 мм") == "обычный текст 5 мм"


def test_glued_words():
    assert repair.split_glued("Сборочныйчертёж", WORDS) == ["Сборочный", "чертёж"]
    assert repair.split_glued("насос", WORDS) == ["насос"] and repair.split_glued("неведомое", WORDS) == ["неведомое"]
    assert repair.unglue("насосопора, вал", WORDS) == "насос опора, вал"


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(sorted(WORDS)), min_size=1, max_size=5))
def test_splitting_gives_the_token_back(words):
    token = "".join(words)
    assert "".join(repair.split_glued(token, WORDS)) == token


def test_formulas_and_json():
    assert repair.mangled_prose(r"\mathrm { н а с о с } \text{стоит}") == "насос стоит"
    assert repair.mangled_prose(r"a = \frac{b}{c}") == r"a = \frac{b}{c}"
    assert repair.salvage_json('x {"a": [1, {"b": 2}]} tail') == '{"a": [1, {"b": 2}]}'
    assert repair.salvage_json('[{"a": 1}, {"a": 2}, {"a"') == '[{"a": 1}, {"a": 2}]'
    assert repair.salvage_json('{"a": 1, "b": "cut') == '{"a": 1}'
    assert repair.salvage_json("none") is None and repair.salvage_json(None) is None
    assert repair.containment("насос опора", "старый насос, опора") > 0.8 and repair.containment("", "x") == 0


def test_apply(spark):
    df = spark.createDataFrame([("нacoc",), (None,), ("",)], "t string")
    got = [tuple(r.repaired) for r in repair.apply(df, "t", lambda t: repair.mixed_words(t, WORDS)).collect()]
    assert got == [("насос", True), (None, False), ("", False)]


def test_sheets(spark):
    cells = spark.createDataFrame([("f", 1, r, c) for r, c in [(0, 0), (0, 1), (1, 1), (5, 5), (5, 6)]], "s3_fileid string, page int, r int, c int")
    assert sorted((r.component, r.cells, r.r2, r.c2) for r in sheets.components(cells).collect()) == [(0, 3, 1, 1), (1, 2, 5, 6)]
    v = lambda t, c, box: {"text": t, "kind": "size", "confidence": c, "box": box}
    got = sheets.merge_readings([v("⌀20", 0.5, [0, 0, 1, 1]), v("ø20", 0.9, [0, 0, 1, 0.9]), v("⌀20", 0.5, [3, 3, 4, 4])], lambda t: t.replace("ø", "⌀"))
    assert [(o["text"], o["confidence"]) for o in got] == [("ø20", 0.9), ("⌀20", 0.5)]
    assert sheets.best_run("Насос центробежный 12 шт", ["другое", "Насос центробежиый", "12 шт", "конец"])[:2] == (1, 3)
    assert sheets.best_run("коротко", ["коротко"]) is None
    assert sheets.stale_tokens("вал 25 мм тест", "вал 26 мм") == {"repeat": ["вал", "мм"], "variant": ["25"], "own": ["тест"]}


LINE = "line_id long, s3_fileid string, page int, rotation double, confidence double, text string, bbox struct<x1: double, y1: double, x2: double, y2: double>"


def test_layout(spark):
    rows = [(1, "f", 1, 0.0, 0.5, "a", (0.1, 0.10, 0.4, 0.12)), (2, "f", 1, 0.0, 0.9, "b", (0.1, 0.125, 0.4, 0.145)), (3, "f", 1, 0.0, 0.9, "c", (0.6, 0.30, 0.9, 0.32)), (4, "f", 1, 90.0, 0.9, "d", (0.1, 0.325, 0.4, 0.345)), (5, "f", 1, 0.0, None, "e", None)]
    lines = spark.createDataFrame(rows, LINE)
    assert {r.line_id: r.paragraph for r in layout.paragraphs(lines).collect()} == {1: 1, 2: 1, 3: 2, 4: 3}
    assert [(r.x1, r.x2, r.lines) for r in layout.columns(lines).orderBy("column_no").collect()] == [(0.1, 0.4, 3), (0.6, 0.9, 1)]
    again = spark.createDataFrame([(9, "f", 1, 0.0, 0.8, "A", (0.1, 0.101, 0.4, 0.121)), (8, "f", 1, 0.0, 0.51, "A", (0.1, 0.1, 0.4, 0.12))], LINE)
    assert [tuple(r) for r in layout.better_reading(lines, again).collect()] == [(1, 9)]
    assert layout.paragraphs(lines.limit(0)).count() == 0


def test_transcripts(spark):
    lines = spark.createDataFrame([(i, "f", 1, i, t) for i, t in enumerate(["шапка", "Насос центробежиый", "12 шт", None])], "line_id long, s3_fileid string, page int, line_no int, text string")
    frags = spark.createDataFrame([(7, "f", "text", "Насос центробежный 12 шт", (1,)), (8, "f", "text", None, (1,)), (9, "g", "text", "Насос центробежный 12 шт", (1,))], "fragment_no long, s3_fileid string, fragment_type string, text string, position struct<page: int>")
    got = sheets.transcript_runs(lines, frags).collect()
    assert [(r.fragment_no, r.first_line, r.lines) for r in got] == [(7, 1, 2)]
    assert sheets.transcript_runs(lines.limit(0), frags).count() == 0


def test_long_words_have_two_readings_and_long_pieces():
    long = "аеосрхухaeocpxyx" * 4
    assert len(repair.pure_readings(long)) == 2 and repair.mixed_words("насос" * 9 + "o", frozenset(["насос" * 9 + "о"])) == "насос" * 9 + "о"
    piece = "а" * 40
    assert repair.split_glued(piece + "вал", frozenset([piece, "вал"])) == [piece, "вал"]
