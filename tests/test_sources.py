import io
import zipfile

from pyspark.sql import functions as F

from sheafline.providers import base
from sheafline.sources import readers, sinks
from sheafline.streaming import jobs


def packed(**files):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, body in files.items():
            z.writestr(name.replace("__", "/").replace("_dot_", "."), body)
    return out.getvalue()


XLSX = packed(
    xl__workbook_dot_xml='<workbook xmlns="m"><sheets><sheet name="S"/></sheets></workbook>',
    xl__sharedStrings_dot_xml='<sst xmlns="m"><si><t>код</t></si><si><t>имя</t></si></sst>',
    xl__worksheets__sheet1_dot_xml='<worksheet xmlns="m"><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="C1" t="s"><v>1</v></c></row><row><c r="A2"><v>5</v></c><c r="B2"><f>A2*2</f></c></row></sheetData></worksheet>',
)
DOCX = packed(
    word__document_dot_xml='<w:document xmlns:w="w"><w:body><w:p><w:pPr><w:pStyle w:val="Heading1"/></w:pPr><w:r><w:t>Глава</w:t></w:r></w:p><w:p><w:r><w:t>текст</w:t></w:r></w:p><w:tbl><w:tr><w:tc><w:p><w:r><w:t>a</w:t></w:r></w:p></w:tc><w:tc><w:p><w:r><w:t>b</w:t></w:r></w:p></w:tc></w:tr></w:tbl></w:body></w:document>'
)
ODS = packed(
    mimetype="application/vnd.oasis.opendocument.spreadsheet",
    content_dot_xml='<d xmlns:t="t" xmlns:x="x"><t:table t:name="L"><t:table-row t:number-rows-repeated="2"><t:table-cell t:number-columns-repeated="2"><x:p>v</x:p></t:table-cell><t:table-cell t:number-columns-repeated="16000"/></t:table-row></t:table></d>',
)
DXF = b"0\nSECTION\n2\nENTITIES\n0\nTEXT\n8\nL1\n1\n%%c20 H7\n0\nLINE\n8\nL1\n0\nENDSEC\n0\nEOF\n"


def test_readers():
    of = readers.blocks_of
    assert [(b["headers"], b["rows"], b["sheet"]) for b in of("a.xlsx", XLSX)] == [(["код", "", "имя"], [["5", "=A2*2", ""]], "S")]
    doc = of("a.docx", DOCX)
    assert [(b["type"], b["text"], b["section_path"]) for b in doc] == [("text", "Глава", ["Глава"]), ("text", "текст", ["Глава"]), ("table", None, None)] and doc[2]["headers"] == ["a", "b"]
    assert [(b["headers"], b["rows"]) for b in of("a.ods", ODS)] == [(["v", "v"], [["v", "v"]])]
    assert [(b["text"], b["sheet"]) for b in of("a.dxf", DXF)] == [("⌀20 H7", "L1")]
    assert [(b["headers"], b["rows"]) for b in of("a.csv", "﻿код;имя\n1;x\n\n2;y\n".encode())] == [(["код", "имя"], [["1", "x"], ["2", "y"]])]
    assert of("a.txt", "Привет, мир. Это текст".encode("koi8-r"))[0]["text"] == "Привет, мир. Это текст"
    assert of("a.txt", "Привет, мир. Это текст".encode("cp1251"))[0]["text"] == "Привет, мир. Это текст"
    md = of("a.md", b"# A\n\ntext\n\n## B\n\na | b\n--|--\n1 | 2\n")
    assert [(b["type"], b["section_path"]) for b in md] == [("text", ["A"]), ("text", ["A"]), ("text", ["A", "B"]), ("table", ["A", "B"])]
    assert of("bad.xlsx", b"PK\x03\x04junk")[0]["type"] == "error" and of("a.pdf", b"%PDF-")[0]["type"] == "error" and of("a.csv", b"") == []


def test_budget(monkeypatch):
    monkeypatch.setattr(readers, "MOST_CELLS", 3)
    assert readers.blocks_of("a.csv", b"a,b\n1,2\n")[0]["text"].startswith("TooLarge")


def test_folder(spark, tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "a.csv").write_text("a,b\n1,2\n")
    (tmp_path / "x" / "b.xlsx").write_bytes(XLSX)
    (tmp_path / "x" / "c.pdf").write_bytes(b"%PDF-1.7")
    got = readers.read_files(spark, str(tmp_path), ("csv", "xlsx")).collect()
    assert sorted(r.type for r in got) == ["table", "table"]


def test_sinks(spark, tmp_path):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 5)], "id int, v string, t int")
    new = spark.createDataFrame([(1, "c", 1), (2, "d", 4), (3, "e", 1)], "id int, v string, t int")
    assert {tuple(r) for r in sinks.upsert(old, new, ["id"], "t").collect()} == {(1, "c", 1), (2, "b", 5), (3, "e", 1)}
    assert sinks.append_unseen(old, new, "id").count() == 3
    path = str(tmp_path / "t")
    sinks.replace_partitions(old.withColumn("k", F.col("id")), path, "k")
    sinks.replace_partitions(new.filter("id = 1").withColumn("k", F.col("id")), path, "k")
    assert {(r.id, r.v) for r in spark.read.parquet(path).collect()} == {(1, "c"), (2, "b")}
    sinks.write_json(old, str(tmp_path / "j"))
    assert sinks.read_json(spark, str(tmp_path / "j"), "id int, v string").count() == 2


def test_providers(spark):
    df = spark.createDataFrame([(1, bytearray(b"x")), (2, bytearray(b"x")), (3, None)], "id int, content binary")
    assert {r.answer for r in base.ask(df, "content").collect()} == {None}
    asked = base.ask(df, "content", lambda xs: ['{"kind": "drawing"}' for _ in xs])
    got = asked.select("id", base.answer_or(F.col("answer"), "kind string", F.struct(F.lit("rules").alias("kind"))).alias("k")).collect()
    assert {r.id: r.k.kind for r in got} == {1: "drawing", 2: "drawing", 3: "rules"}


def test_stream_goes_on_where_it_stopped(spark, tmp_path):
    events = lambda a, b: spark.createDataFrame([(i, i % 3, "click") for i in range(a, b)], "event_id long, user_id long, event_type string")
    folder, data = str(tmp_path / "s"), str(tmp_path / "data")
    events(10, 20).write.parquet(data)
    first = {tuple(r) for r in jobs.run_first_claims(spark, data, folder).collect()}
    assert first == {(0, "click", 12), (1, "click", 10), (2, "click", 11)}
    events(0, 10).write.mode("append").parquet(data)
    assert {tuple(r) for r in jobs.run_first_claims(spark, data, folder).collect()} == {(0, "click", 0), (1, "click", 1), (2, "click", 2)}


def test_claims_leave_the_state_and_the_smallest_stays(spark, tmp_path, monkeypatch):
    from datetime import datetime, timedelta

    from sheafline.streaming import jobs

    monkeypatch.setattr(jobs, "HELD_MS", 1000)
    monkeypatch.setattr(jobs, "LATENESS", "1 second")
    path, folder = str(tmp_path / "data"), str(tmp_path / "job")
    start = datetime(2025, 1, 1)
    for day, event in ((0, 5), (10, 9), (20, 3), (30, 8)):
        rows = [(event, 1, "a", start + timedelta(days=day)), (100 + event, 2, "a", start + timedelta(days=day))]
        spark.createDataFrame(rows, "event_id long, user_id long, event_type string, ts timestamp").write.mode("append").parquet(path)
        got = {tuple(r) for r in jobs.run_first_claims(spark, path, f"file://{folder}").collect()}
    assert got == {(1, "a", 3), (2, "a", 103)}
