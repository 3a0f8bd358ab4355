import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sheafline.functions import files, hashes, texts, units
from sheafline.operators import chunking, facts, fields, parts, ranks, rules, tables


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab .\n", max_size=400), st.integers(-1, 80), st.integers(-2, 90))
def test_windows_cover_and_move_on(text, size, overlap):
    spans = chunking.split_positions(text, size, overlap)
    assert (not text) == (not spans)
    if spans:
        assert spans[0][0] == 0 and spans[-1][1] == len(text)
        assert all(b - a <= max(1, size) for a, b in spans)
        assert all(a < c <= b and d >= b for (a, b), (c, d) in zip(spans, spans[1:], strict=False))


def test_chunk_strategies():
    text = "1. Head\n\nshort\n\n" + "A sentence of some words. " * 40 + "\n\n2. Next\n\nend"
    sections = chunking.chunk_text(text, "semantic", 200, 20)
    assert {s for _, _, s in sections} == {"1. Head", "2. Next"}
    assert all(text[a:b].strip() and b - a <= 230 for a, b, _ in chunking.chunk_text(text, "paragraph", 200, 20))
    with pytest.raises(ValueError):
        chunking.chunk_text("", "other")


def one(text):
    return [(f[0], f[2], f[3], f[4], f[5], f[6], f[7]) for f in facts.facts_of(text)]


def test_facts():
    assert one("Давление не более 1 200,5 МПа") == [("number", 1200.5, None, None, "MPa", "<=", "давление")]
    assert one("Зазор 0,4-0,6 мм") == [("range", None, 0.4, 0.6, "mm", "range", "зазор")]
    assert one("Диаметр 20 ±0,5 мм") == [("range", None, 19.5, 20.5, "mm", "range", "диаметр")]
    assert one("Температура от 5 до 40 °C") == [("range", None, 5.0, 40.0, "°C", "range", "температура")]
    assert one("Срок хранения — не более 30 суток по ГОСТ 2.104-2006")[0] == ("duration", 30.0, None, None, "d", "<=", "срок хранения")
    assert [f[0] for f in facts.facts_of("по ГОСТ 2.104-2006 от 2025-03-01, АБВГ.123456.001")] == ["identifier", "date", "identifier"]
    assert one("") == [] and one("без чисел") == []


def test_fact_tables(spark):
    df = spark.createDataFrame([(1, "п 5 мм"), (2, None), (3, "")], "id long, text string")
    assert [(r.id, r.fact, r.number, r.unit) for r in facts.extract(df, "id", "text").collect()] == [(1, 1, 5.0, "mm")]
    assert facts.extract(df, "id", "text", most=0).count() == 0 and facts.extract(df.limit(0), "id", "text").count() == 0


def test_html_grids():
    head, rows = tables.html_grid("<TABLE><TR><TD colspan=2>Title<TR><TH>A<TH>B<TR><TD rowspan=2>x<TD>1<TR><TD>2</TABLE>")
    assert head == ["A", "B"] and rows == [["Title", "Title"], ["x", "1"], ["x", "2"]]
    assert tables.html_grid("<table></table>") == ([], []) and tables.html_grid("text") == ([], [])
    assert tables.markdown_tables("a | b\n--|--\n1 | x\\|y\n2") == [(["a", "b"], [["1", "x|y"]])]


def test_columns(spark):
    df = spark.createDataFrame([("dir/a%20b.PDF",), ("x",), ("y.dwg",), ("z.foo",)], "id string")
    ext = files.extension(F.col("id"))
    got = df.select(ext, files.file_name(F.col("id")), files.kind(ext), files.refusal(ext)).collect()
    assert [tuple(r) for r in got] == [("pdf", "a b.PDF", "pdf", None), ("", "x", "unknown", "no extension"), ("dwg", "y.dwg", "cad", "needs converter"), ("foo", "z.foo", "unknown", "unknown type")]
    heads = spark.createDataFrame([(bytearray(b"%PDF-1.7"),), (bytearray(b"\x89PNG\r\n\x1a\n"),), (bytearray(b"PK\x03\x04"),), (bytearray(b"AC1015"),), (bytearray(b""),), (None,)], "b binary")
    assert [r[0] for r in heads.select(files.magic(F.col("b"))).collect()] == ["pdf", "png", "zip", "dwg", None, None]
    n = spark.createDataFrame([("1 200,5",), ("−3",), ("x",), (None,)], "t string").select(texts.to_number(F.col("t"))).collect()
    assert [r[0] for r in n] == [1200.5, -3.0, None, None]
    u = spark.createDataFrame([("МПа",), (" кг ",), ("foo",), (None,)], "t string").select(units.canonical(F.col("t"))).collect()
    assert [r[0] for r in u] == ["MPa", "kg", "foo", None]
    d = spark.createDataFrame([("Сут.",), ("мин",), ("foo.",), (None,)], "t string").select(units.canonical_duration(F.col("t"))).collect()
    assert [r[0] for r in d] == ["d", "min", "foo.", None]


def test_simhash_pairs(spark):
    base = 0x0F0F_1234_5678_9ABC
    rows = [(1, base), (2, base ^ 0b111111), (3, base ^ (0b1111111 << 20)), (4, base), (5, 0), (6, 0), (7, base ^ (1 << 62 | 1 << 40 | 1 << 30 | 1 << 20 | 1 << 10 | 1))]
    got = {tuple(r) for r in hashes.near_pairs(spark.createDataFrame(rows, "id long, fingerprint long"), "id").collect()}
    want = {(a, b, (x ^ y).bit_count()) for a, x in rows for b, y in rows if a < b and x and y and a != 4 and b != 4 and 0 < (x ^ y).bit_count() <= 6}
    assert got == want and (1, 2, 6) in got and (1, 7, 6) in got
    # every key is crowded: the second keys give the same pairs
    assert {tuple(r) for r in hashes.near_pairs(spark.createDataFrame(rows, "id long, fingerprint long"), "id", crowd=1).collect()} == want
    classes = {r.id: (r.class_id, r.links, r.nearest_id, r.distance) for r in hashes.near_classes(spark.createDataFrame(rows, "id long, fingerprint long"), "id").collect()}
    assert classes[1] == classes[4] == (1, 2, 2, 6) and classes[5] == (5, 0, None, None) and classes[3] == (3, 0, None, None)
    same = hashes.simhash(spark.createDataFrame([(1, "один два три четыре"), (2, "три один четыре два"), (3, None), (4, "")], "id long, t string"), "id", "t").collect()
    by = {r.id: r.fingerprint for r in same}
    assert by[1] == by[2] != 0 and by[3] == by[4] == 0


def test_rules(spark):
    df = spark.createDataFrame([("Откройте клапан. Закройте клапан.",), ("",), (None,)], "text string")
    got = [r.rules for r in rules.score(df, "text").collect()]
    assert got[0].category == "instruction" and math.isclose(got[0].score, 1.5 * 2) and got[1].category is None and got[2].confidence == 0


def test_label_tails(spark):
    schema = "fragment_no long, s3_fileid string, fragment_type string, text string, section_title string, confidence double, completeness double, position struct<page: int, sheet: string, order: int>"
    rows = [(1, "f", "text", "Имеется:", None, 0.9, 0.8, (1, None, 1)), (2, "f", "text", "насос", None, 0.5, None, (1, None, 2)), (3, "f", "text", "далее", "B", 0.7, 0.7, (1, None, 3)), (4, "f", "text", "4.1.", "A", 0.7, 0.7, (2, None, 4)), (5, "f", "text", "x", "B", 0.7, 0.7, (2, None, 5)), (6, "f", "text", None, None, None, None, (2, None, 6))]
    got = {(r.fragment_no, r.text, r.joined, r.confidence) for r in parts.join_label_tails(spark.createDataFrame(rows, schema)).collect()}
    assert got == {(1, "Имеется:\nнасос", 2, 0.5), (3, "далее", 1, 0.7), (4, "4.1.", 1, 0.7), (5, "x", 1, 0.7)}


def test_multisets_and_fields(spark):
    rows = [("s", 0, 0, "a"), ("s", 0, 1, "a"), ("s", 0, 2, "b"), ("s", 1, 0, "a"), ("s", 1, 1, "b"), ("s", 1, 2, "b")]
    got = fields.merge_multisets(spark.createDataFrame(rows, "g string, part int, pos int, line string"), ["g"], "part", "line", "pos").collect()
    assert sorted((r.line, r.part, r.pos) for r in got) == [("a", 0, 0), ("a", 0, 1), ("b", 0, 2), ("b", 1, 2)]
    df = spark.createDataFrame([("g", " A ", 0.5, 1), ("g", "a", 0.9, 2), ("g", "b", None, 3)], "g string, value string, confidence double, pos int")
    best = {(r.value.strip().lower(), r.confidence, r.first_position, r.seen) for r in fields.dedupe(df, ["g"], "value", "confidence", "pos").collect()}
    assert best == {("a", 0.9, 1, 2), ("b", None, 3, 1)}
    kinds = spark.createDataFrame([("M12x1,5",), ("R 5",), ("Ra 3,2",), ("⌀20 ±0,1",), ("сталь 45",), ("прочее",)], "t string").select(fields.kind(F.col("t")), fields.tolerance(F.col("t"))).collect()
    assert [tuple(r) for r in kinds] == [("thread", None), ("radius", None), ("roughness", None), ("size", "±0,1"), ("material", None), ("note", None)]


def test_numbers_within_a_key(spark):
    rows = [("hot" if i % 3 else None if i % 2 else "cold", i * 7 % 101) for i in range(101)]
    got = ranks.numbered(spark.createDataFrame(rows, "k string, o long"), "k", "o", width=9).collect()
    assert len(got) == len(rows)
    for key in ("hot", "cold", None):
        mine = sorted((r.o, r.n) for r in got if r.k == key)
        assert [n for _, n in mine] == list(range(1, len(mine) + 1))
    assert ranks.numbered(spark.createDataFrame([], "k string, o long"), "k", "o").count() == 0


def test_discount(spark):
    df = spark.createDataFrame([(0.8, 0.5), (0.8, 0.1), (0.8, 0.0), (0.8, None)], "c double, i double")
    assert [round(r[0], 6) for r in df.select(rules.discount(F.col("c"), F.col("i"))).collect()] == [0.8, 0.4, 0.08, 0.8]


def test_table_completeness_reads_inner_tags_and_knows_headers_only(spark):
    from sheafline.operators import tables

    html = ["<table><tr><th>a</th><td><b>5</b></td><td> <i></i> </td><td>x<br>y</tr></table>", "<tr><th>a<th><b>b</b></tr>", "<tr><th></th></tr>", "", "<td><p>1 < 2</p>"]
    df = spark.createDataFrame([(i, h) for i, h in enumerate(html)], "i int, h string")
    got = [tuple(r)[1:] for r in df.select("i", *tables.completeness(df.h)).orderBy("i").collect()]
    assert got == [(4, 3, 0.75), (2, 2, 0.5), (1, 0, 0.0), (0, 0, 0.0), (1, 1, 1.0)]


def test_runs_within_a_key(spark):
    import itertools
    import random

    rng = random.Random(2)
    rows = [("hot" if rng.random() < 0.8 else "cold", i, rng.choice("ab"), rng.choice([1, None])) for i in range(120)]
    want = set()
    for key in ("hot", "cold"):
        mine = [r for r in rows if r[0] == key]
        for n, (_, part) in enumerate(itertools.groupby(mine, key=lambda r: r[2:]), 1):
            part = list(part)
            want.add((key, n, len(part), part[0][1], part[-1][1], part[0][2], part[0][3]))
    got = ranks.runs(spark.createDataFrame(rows, "k string, o long, a string, b int"), "k", "o", ["a", "b"], width=7).collect()
    assert {tuple(r) for r in got} == want
    assert ranks.runs(spark.createDataFrame([], "k string, o long, a string"), "k", "o", ["a"]).count() == 0


def test_clusters_without_a_shared_folder_are_refused(spark):
    from sheafline import session

    class Cluster:
        class conf:
            get = staticmethod(lambda *a: None)

        class sparkContext:
            master = "spark://host:7077"
            getConf = staticmethod(lambda: Cluster.conf)

    with pytest.raises(ValueError):
        session.shared_dir(Cluster)


def test_headings_and_labels(spark):
    heads = ["1. Введение", "2.3 Насосы и валы", "Глава 2", "ОПОРЫ И ВАЛЫ", "Имеется следующее:"]
    plain = ["1. введение в курс", "обычная строка", "Насос. Он качает:", "", "x" * 201, "12"]
    df = spark.createDataFrame([(t,) for t in heads + plain], "t string")
    assert [r[0] for r in df.select(texts.is_header(F.col("t"))).collect()] == [True] * len(heads) + [False] * len(plain)
    labels = ["Имеется:", "a\nв составе —", "текст\n4.1.", "2) ", "12.3)"]
    none = ["текст", "4.1", "1234.", "текст:\nдалее", "—"]
    df = spark.createDataFrame([(t,) for t in labels + none], "t string")
    assert [r[0] for r in df.select(parts.ends_in_label(F.col("t"))).collect()] == [True] * len(labels) + [False] * len(none)
    assert chunking.is_header("Глава 1 Насосы") and chunking.is_header("2.1. Насосы") and chunking.is_header("ОБЩИЕ ПОЛОЖЕНИЯ") and not chunking.is_header("обычный текст") and not chunking.is_header("ГОСТ")


def test_comparison_words_are_words():
    assert one("Мотор отдаёт домкрату 5 кг")[0][5] == "=" and one("масса до 5 кг")[0][5] == "<=" and one("не должна превышать 7 мм")[0][5] == "<="
    assert one("более 5 мм")[0][5] == "=" and one("t < 5 мм")[0][5] == "<" and one("макс ≥ 5 мм")[0][5] == ">="
    assert one("5-10 ±1 мм")[-1][2:4] == (9.0, 11.0) and one("от 1 000 до 2 000,5 кг") == [("range", None, 1000.0, 2000.5, "kg", "range", "")]
    assert one("DN55 и 3…5 мм")[-1] == ("range", None, 3.0, 5.0, "mm", "range", "")


def test_cells_take_the_text_of_the_line_that_says_the_same(spark):
    assert tables.match_cells(["Насос 5", "вал", "вал"], ["вал", "Насос5.", "прочее"]) == [(0, 1, 0.923077), (1, 0, 1.0)]
    assert tables.match_cells([], ["a"]) == [] and tables.match_cells(["", "a"], ["", "b"]) == []
    position, payload = "position struct<page: int>", "structured_payload struct<table_html: string>"
    frags = spark.createDataFrame([(1, "f", (1,), ("<table><tr><td>Насос НЦ-5О</td><td>вал</td></tr></table>",)), (2, "f", (2,), (None,)), (3, "g", (1,), ("<td>x</td>",))], f"fragment_no long, s3_fileid string, {position}, {payload}")
    lines = spark.createDataFrame([(7, "f", 1, "Насос НЦ-50"), (8, "f", 1, "вал"), (9, "f", 1, None)], "line_id long, s3_fileid string, page int, text string")
    assert [tuple(r)[:3] + tuple(r)[4:] for r in tables.cell_lines(frags, lines).collect()] == [(1, 0, 7, "Насос НЦ-5О", "Насос НЦ-50")]


def test_strategies_by_name_type_and_source():
    assert chunking.strategy_of("fixed", "manual") == "fixed" and chunking.strategy_of(None, "manual", "tesseract") == "semantic"
    assert chunking.strategy_of(None, "other", "tesseract") == "paragraph" and chunking.strategy_of() == "paragraph"
    with pytest.raises(ValueError):
        chunking.strategy_of("other")
