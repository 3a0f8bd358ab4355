import pytest

from sheafline.llm import lookalikes as L

WORDS = [(w, "ru") for w in "насос оса ухо включает питает опорный вал сера регулятор стойка клапан мотор медный корпус".split()] + [(w, "en") for w in "the pump opens valve a rotor cover main sensor oil fan shaft near".split()]


@pytest.fixture(scope="module")
def reader():
    return L.Reader(WORDS, {"XXXX.9.9@0": [0, 90, 0], "°X@0": [90, 0, 0], "XX9@0": [50, 0, 0]})


@pytest.mark.parametrize("text, form", [("опopный вал", "опорный вал"), ("Здесь oca питает вал", "Здесь оса питает вал"), ("thе рumр opens", "the pump opens"), ("ＩＰ５ вал", "IP5 вал"), ("ва\u200bл\u00a0и", "вал и"), ("опорныи\u0306 вал", "опорный вал"), ("HPУE.455684.841", "НРУЕ.455684.841"), ("ﬁlter", "filter"), ("the νalve", "the valve")])
def test_disguised(reader, text, form):
    got, changed, foreign = reader.line(text)
    assert got == form and (changed or foreign)


@pytest.mark.parametrize("text", ["Ra 39; α = 12°.", "LED 66 µm ± 5", "«вал» № 3, 4², ½ — …", "50 °C в корпусе", "DN55, IP33.", "a pump", "", "оса", "См. ⌀ и ≥ в корпусе", "МПа", "ЕАСК.455684.841 the pump"])
def test_proper_text_stays(reader, text):
    assert reader.line(text) == (text, False, False)


def test_columns(spark):
    words = spark.createDataFrame([*WORDS, (None, "ru")], "word string, lang string")
    lines = spark.createDataFrame([(1, "text_layer", "опopный вал"), (2, "text_layer", None), (3, "text_layer", ""), (4, "tesseract", "опopный"), (1, "text_layer", "опopный вал")], "line_id long, method string, text string")
    edits = spark.createDataFrame(
        [(1, "опopный вал", "опорный вал"), (2, "вал", "Вал"), (3, "вал", "вал"), (4, None, "вал"), (5, "вал", None), (6, "еж", "ёж"), (7, "вал 1", "вал 7"), (8, "вал", "вал."), (9, "ва\u00adл", "вал"), (10, "4²", "42")], "change_id long, before string, after string"
    )
    assert {tuple(r) for r in L.found(lines, edits, words).collect()} == {("text_lines", 1), ("text_changes", 1), ("text_changes", 9)}
    assert L.found(lines.limit(0), edits.limit(0), words).count() == 0
    clash = L.one_form(lines.withColumn("one", lines.line_id), L.fit(lines, words))
    assert clash.columns == ["line_id", "method", "text", "one"] and clash.count() == 5


@pytest.mark.parametrize("text, form", [("Aλφα βήτα γάμμα", "Αλφα βήτα γάμμα"), ("κιλo βάρος", "κιλο βάρος"), ("ΔT = 5, µm", "ΔT = 5, µm")])
def test_greek(reader, text, form):
    assert reader.line(text)[0] == form


def test_habits_of_long_shapes_stay_apart(spark):
    # two designations whose first sixteen signs have one pattern
    a, b = "ВК.1.2.3.4.5.6.7.8.9-АВ-ЖЖ", "BK.1.2.3.4.5.6.7.8.9-AB-ZZ-TX"
    lines = [(i, t) for i, t in enumerate([a] * 5 + [b] * 5 + ["ВK.1.2.3.4.5.6.7.8.9-АВ-ЖЖ", "BК.1.2.3.4.5.6.7.8.9-AB-ZZ-TX"])]
    df = spark.createDataFrame(lines, "line_id long, text string")
    words = spark.createDataFrame([("насос", "ru"), ("pump", "en")], "word string, lang string")
    got = {r.line_id: r.one for r in L.one_form(df, L.fit(df, words)).collect()}
    assert got[10].form == a and got[11].form == b and got[10].disguised and not got[0].disguised and not got[5].disguised


def test_lines_by_the_table_and_in_memory_agree(spark):
    texts = ["опopный вал", "Здесь oca питает вал", "thе рumр opens", "HPУE.455684.841", "НРУЕ.455684.842", "НРУЕ.455684.843", "рыьiба", "", "Ra 39; α = 12°.", "ваl oca oca"] * 2
    df = spark.createDataFrame(list(enumerate(texts)), "line_id long, text string")
    words = spark.createDataFrame(WORDS, "word string, lang string")
    fitted = L.fit(df, words)
    local = L.Reader(WORDS, {r.key: [r.s0, r.s1, r.s2] for r in fitted.table.collect()})
    for r in L.one_form(df, fitted).collect():
        form, changed, foreign = local.line(r.text)
        assert (r.one.form, r.one.disguised) == (form, changed or foreign), r.text
