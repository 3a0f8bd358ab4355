import random

import pytest

from sheafline.llm import scans as S


def test_misreadings():
    assert S.misreadings("контрольного", "контропьного") == 1
    assert S.misreadings("термоприбор", "терniоприбор") == 1
    assert S.misreadings("trolley", "tr0lley") == 1 and S.misreadings("turning", "tuming") == 1
    assert S.misreadings("вал", "вол") == -1
    assert S.skeleton("контрольного") == S.skeleton("контропьного") and S.skeleton("conveyor") == S.skeleton("coriveyor")
    assert S.where_misread("контрольного", "контропьного", 4) == (False, True)


@pytest.mark.parametrize("text, number", [("стр. 1 из 8", 1), ("- 7 -", 7), ("[l]", 1), ("Page 12", 12), ("9 / 9", 9), ("Лист lО", 10), ("клапан 5", None), ("", None), ("5 мм", None)])
def test_page_numbers(text, number):
    assert S.page_number(text) == number


@pytest.mark.parametrize("token, form", [("16o", "9y"), ("СГУТ.6297б5.012", "X.9y9.9"), ("упл0тняет", "x9x"), ("lО", "m"), ("DN55", "X9"), ("4,5", "9,9"), ("Вал", "C"), ("I", "Y")])
def test_shapes(token, form):
    assert S.shape(token) == form


def test_readings():
    assert ("упл0тняет".replace("0", "о"), "x") in S.readings("упл0тняет") and ("160", "9") in S.readings("16o")
    assert S.readings("СГУТ.6297б5.0З2")[-1][0] == "СГУТ.629765.032" and ("АБВГ.123456.789", "X.9.9") in S.readings("А6ВГ.123456.789")
    assert S.readings("3мм") == [] and S.readings("4,5") == [] and S.readings("") == []
    assert ("mandrel", "x") in S.readings("mandre1") and ("shifts", "x") in S.readings("sh|fts") and ("Промежуточный", "C") in S.readings("Промеж<уточный")
    assert len(S.readings("1О." * 2000)) <= 4002


def test_tokens_give_way_to_the_shapes_of_the_corpus(spark):
    odd = [(f"{k}", 5) for k in range(40)] + [(f"СГУТ.{100000 + k}.012", 3) for k in range(9)] + [("DN55", 40), ("16o", 1), ("lО", 1), ("СГУТ.6297б5.012", 1), ("упл0тняет", 2), ("3мм", 1), ("sh|fts", 1), ("DN5О", 1)]
    words = [("shifts", 3), ("уплотняет", 50), ("вал", 100)]
    got = dict(tuple(r) for r in S.token_fixes(spark.createDataFrame(odd, "tok string, n long"), spark.createDataFrame(words, "word string, n long")).collect())
    assert got == {"16o": "160", "lО": "10", "СГУТ.6297б5.012": "СГУТ.629765.012", "упл0тняет": "уплотняет", "sh|fts": "shifts", "DN5О": "DN50"}
    # with ten times the rows the same tokens are found
    more = spark.createDataFrame([(t, 10 * n) for t, n in odd], "tok string, n long")
    assert {r.tok for r in S.token_fixes(more, spark.createDataFrame([(w, 10 * n) for w, n in words], "word string, n long")).collect()} == set(got)


def test_skeleton_as_an_expression(spark):
    words = ["контропьного", "терniоприбор", "алlоминий", "l0ж<ка", "рьiчаг", "conveyor", "coriveyor", "tuming", "liouse", "rrious", "sh|fts", "", "ёж", "123"]
    rows = spark.createDataFrame([(w,) for w in words], "w string").select("w", S.skeleton_of(S.F.col("w"))).collect()
    assert {r[0]: r[1] for r in rows} == {w: S.skeleton(w) for w in words}


LINE = "line_id long, s3_fileid string, page int, line_no int, text string, bbox struct<x1: double, y1: double, x2: double, y2: double>, confidence double, method string"


def page(file, number, body, start, header="ВАЛЫ И ОПОРЫ"):
    rows = [(header, 0.03), *[(t, 0.11 + 0.04 * i) for i, t in enumerate(body)], (f"- {number} -", 0.97)]
    return [(start + i, file, number, i + 1, t, (0.1, y, 0.7, y + 0.01), 0.9, "tesseract") for i, (t, y) in enumerate(rows)]


@pytest.fixture(scope="module")
def tables(spark):
    words = "насос включает контрольного вала опора питает стойку мотора закрывает клапан красной тёмно".split()
    body1 = ["насос включает вала контро-", "льного мотора. Опора тёмно-", "красной стойки питает контропьного", "мотора тёмно-красной насос закры-"]
    body2 = ["вает клапан контрольного вала", "опора закрывает контрольного."]
    rows = page("f", 1, body1, 1) + page("f", 2, body2, 20) + page("f", 3, ["насос питает контрольного вала"] * 2, 40)
    rows.append((99, "f", 1, 2, "насос включает вала контро-", None, None, "tesseract"))
    rows.append((100, "f", 1, None, None, None, None, "tesseract"))
    return spark.createDataFrame(rows, LINE), spark.createDataFrame([(w, "ru") for w in words], "word string, lang string")


def test_kinds(spark, tables):
    lines, words = tables
    got = {tuple(r) for r in S.defects(lines, words).collect()}
    by = lambda k: {i for i, x in got if x == k}
    assert by("pageno") == {6, 23, 43} and by("header") == {1, 20, 40}
    assert by("hyphen") == {2, 5, 99} and by("misread") == {4}
    assert S.defects(lines.limit(0), words).count() == 0


def test_paragraphs(spark, tables):
    lines, words = tables
    text = " ".join(r.text for r in S.paragraphs(lines, words).orderBy("page", "paragraph").collect())
    assert "контрольного мотора" in text and "контро-" not in text and "контропьного" not in text
    assert "ВАЛЫ" not in text and "- 1 -" not in text and "закрывает клапан" in text


def test_headers_by_recurrence_not_by_a_fixed_band(spark):
    def sheet(file, number, head, at, body, start, foot=None):
        rows = [(head, at), *[(t, at + 0.03 * (i + 1)) for i, t in enumerate(body)], *([(foot, 0.94)] if foot else [])]
        return [(start + i, file, number, i + 1, t, None if y is None else (0.1, y, 0.7, y + 0.01), 0.9, "tesseract") for i, (t, y) in enumerate(rows)]

    rng = random.Random(4)
    text = lambda: ["".join(rng.choices("абвгдежзклмнопрст", k=30)) for _ in range(8)]
    # a header and a number line inside the old cuts; the number beside the header differs on each page
    rows = [r for n in (1, 2, 3) for r in sheet("a", n, f"Регламент насоса {n + 2}", 0.08, text(), 100 * n, f"- {n} -")]
    # body that starts inside the top band, at the pitch of the page, and recurs nowhere
    rows += sheet("b", 1, "первая строка текста", 0.05, text(), 500) + sheet("b", 2, "другое начало", 0.05, text(), 600)
    # a file whose lines have no place
    for n in (1, 2):
        rows += [(*r[:5], None, *r[6:]) for r in sheet("c", n, f"ОПОРЫ И ВАЛЫ {n}", 0.03, text(), 700 + 100 * n)]
    lines = spark.createDataFrame(rows, LINE)
    got = {r.line_id: r.place for r in S.margins(lines.drop("confidence", "method")).collect()}
    assert {i for i, p in got.items() if p == "header"} == {100, 200, 300, 800, 900}
    assert len([i for i, p in got.items() if p == "pageno"]) == 3 and got[500] == got[600] == "body"


def test_a_listed_form_wins_whatever_the_counts(spark):
    listed = spark.createDataFrame([("контрольного", "ru"), ("толстого", "ru")], "word string, lang string")
    fixes = lambda rows, used: {tuple(r) for r in S.corrections(spark.createDataFrame(rows, "word string, n long"), listed, spark.createDataFrame(used, "word string, left string")).collect()}
    for times in (1, 10):
        assert fixes([("контрольного", 2 * times), ("контропьного", 3 * times)], [("контрольного", "")]) == {("контропьного", "контрольного")}
    # three misread glyphs in a short word: the word beside it decides
    counts = [("толстого", 2), ("гопсгого", 1)]
    assert fixes(counts, [("толстого", "слоя"), ("гопсгого", "слоя")]) == {("гопсгого", "толстого")}
    assert fixes(counts, [("толстого", "слоя"), ("гопсгого", "вала")]) == set()


def test_paragraphs_go_on_over_pages(spark):
    words = spark.createDataFrame([("насос", "ru")], "word string, lang string")
    wide = "насос питает стойку мотора и закрывает клапан"
    rows = []
    names = iter("вал опора стенка ротор муфта сальник".split())
    line = lambda: wide.replace("насос", next(names))
    pages = {1: [line(), line(), "насос питает"], 2: [line(), line(), "насос питает стойку мотора и закры-"], 3: ["вает клапан."]}
    for n, body in pages.items():
        rows += [(10 * n + i, "f", n, i + 1, t, None, None, "tesseract") for i, t in enumerate(body)]
    rows += [(100 + i, "g", None, 600 * i, f"{wide} {i}", None, None, "tesseract") for i in range(4)]
    got = {(r.s3_fileid, r.page, r.paragraph): r.text for r in S.paragraphs(spark.createDataFrame(rows, LINE), words).collect()}
    assert got["f", 1, 1] == " ".join([*pages[1], *pages[2][:2], "насос питает стойку мотора и закрывает", "клапан."])
    assert {k for k in got if k[0] == "f"} == {("f", 1, 1)} and {k[1] for k in got if k[0] == "g"} == {0}
    assert sum(len(t.split()) for k, t in got.items() if k[0] == "g") == 4 * len(wide.split()) + 4


def test_chains_are_carried_over_stretches(spark):
    pages = [("f", u, u not in (3, 40), 1 if u % 50 else 2) for u in range(3, 260)]
    want, start = {}, None
    for _, u, goes_on, n in pages:
        if goes_on:
            want[u] = start
        if not goes_on or n > 1:
            start = u
    got = S.page_chains(spark.createDataFrame(pages, "s3_fileid string, unit int, goes_on boolean, n int"), stretch=20)
    assert {r.unit: r.from_unit for r in got.collect()} == want


def test_a_paragraph_goes_on_over_any_number_of_pages(spark):
    words = spark.createDataFrame([("насос", "ru")], "word string, lang string")
    rng = random.Random(6)
    text = lambda: " ".join("".join(rng.choices("абвгдежзклмнопрст", k=7)) for _ in range(6))
    # no sentence ends before the last page, in files with pages and in one without
    rows = [(10 * n + i, "f", n, i, text(), None, None, "tesseract") for n in range(1, 132) for i in (1, 2, 3)]
    rows += [(5000 + i, "g", 0, 250 * i, text(), None, None, "tesseract") for i in range(270)]
    # sentences that end in the middle of a paragraph: the second one at a stretch's last line
    rows += [(9000 + i, "h", None, i, text() + "." * (i in (500, 999)), None, None, "tesseract") for i in (499, 500, 501, 999, 1000)]
    got = {(r.s3_fileid, r.page, r.paragraph): r.text for r in S.paragraphs(spark.createDataFrame(rows, LINE), words).collect()}
    assert {k[0]: k[1] for k in got} == {"f": 1, "g": 0, "h": 0} and len(got) == 3
    assert {k[0]: t for k, t in got.items()} == {f: " ".join(r[4] for r in rows if r[1] == f) for f in "fgh"}
