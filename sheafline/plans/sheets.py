"""Queries that put layer, blocks and sheets together: rebuilt blocks, reconciled pages, tables from lines, drawing signals, title rows, view titles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sheafline.functions import texts as X
from sheafline.operators import fields, layout, tables
from sheafline.plans import documents, geometry
from sheafline.plans.geometry import _KINDS
from sheafline.plans.registry import Registry
from sheafline.session import table

R = Registry()

_IN_BLOCKS = geometry.R.sql["lines_in_blocks"]
_THERE = geometry.R.sql["lines_already_there"]
_BARE = r"length(regexp_replace(coalesce({0}, ''), '[\s\p{{Z}}\x{{85}}]', '', 'g'))"
KEEP = 0.6


@R.query(
    f"""WITH a AS ({_IN_BLOCKS}), j AS (SELECT a.fragment_no, string_agg(l.text, chr(10) ORDER BY round(l.bbox.y1, 3), round(l.bbox.x1, 3), l.line_id) AS made, count(*) AS lines FROM a JOIN text_lines l USING (line_id) WHERE a.fragment_no IS NOT NULL GROUP BY 1)
    SELECT fragment_no, lines, {_BARE.format('made')} >= {KEEP} * {_BARE.format('text')} AS replaced, CASE WHEN {_BARE.format('made')} >= {KEEP} * {_BARE.format('text')} THEN made ELSE text END AS text FROM j JOIN fragments USING (fragment_no)"""
)
def rebuilt_blocks(spark: SparkSession, root: str) -> DataFrame:
    """The text of each block from the lines in it, in reading order, unless that would lose two fifths of what it holds."""
    lines, fragments = table(spark, root, "text_lines"), table(spark, root, "fragments")
    inside = layout.assign(lines, fragments).filter("fragment_no is not null")
    placed = lines.select("line_id", F.col("text").alias("t"), F.round("bbox.y1", 3).alias("y"), F.round("bbox.x1", 3).alias("x"))
    made = inside.join(placed, "line_id").groupBy("fragment_no").agg(F.expr("listagg(t, '\n') within group (order by y, x, line_id)").alias("made"), F.count("*").alias("lines"))
    df = made.join(fragments.select("fragment_no", "text"), "fragment_no")
    keeps = X.nonspace_chars(F.col("made")) >= KEEP * X.nonspace_chars(F.col("text"))
    return df.select("fragment_no", "lines", keeps.alias("replaced"), F.when(keeps, F.col("made")).otherwise(F.col("text")).alias("text"))


@R.query(
    f"""WITH a AS ({_IN_BLOCKS}), d AS ({_THERE}) SELECT s3_fileid, page, count(*) AS lines, count(a.fragment_no) AS placed, count(DISTINCT a.fragment_no) AS blocks,
      count(*) FILTER (WHERE a.fragment_no IS NULL AND coalesce(d.duplicate, FALSE)) AS repeated, count(*) FILTER (WHERE a.fragment_no IS NULL AND NOT coalesce(d.duplicate, FALSE)) AS recovered
    FROM text_lines LEFT JOIN a USING (line_id) LEFT JOIN d USING (line_id) WHERE method = 'text_layer' GROUP BY s3_fileid, page"""
)
def reconciled_pages(spark: SparkSession, root: str) -> DataFrame:
    """Each page's layer against its blocks: lines that lie in a block, lines outside whose words are there already, and lines to recover."""
    lines = table(spark, root, "text_lines").filter("method = 'text_layer'").select("line_id", "s3_fileid", "page")
    inside = layout.assign(table(spark, root, "text_lines"), table(spark, root, "fragments"))
    there = geometry.lines_already_there(spark, root).select("line_id", "duplicate")
    df = lines.join(inside, "line_id", "left").join(there, "line_id", "left")
    out, again = F.col("fragment_no").isNull(), F.coalesce("duplicate", F.lit(False))
    return df.groupBy("s3_fileid", "page").agg(F.count("*").alias("lines"), F.count("fragment_no").alias("placed"), F.countDistinct("fragment_no").alias("blocks"), F.count_if(out & again).alias("repeated"), F.count_if(out & ~again).alias("recovered"))


_COMPLETE = documents.R.sql["table_completeness"]


@R.query(
    f"""SELECT fragment_no, cells, filled, round(coalesce(abs(position.bbox.x2 - position.bbox.x1) * abs(position.bbox.y2 - position.bbox.y1), 0.0), 6) AS area, cells >= 4 AND filled >= 0.2 * cells AND coalesce(abs(position.bbox.x2 - position.bbox.x1) * abs(position.bbox.y2 - position.bbox.y1), 0.0) < 0.8 AS structured
      FROM ({_COMPLETE}) JOIN fragments USING (fragment_no)"""
)
def structured_tables(spark: SparkSession, root: str) -> DataFrame:
    """Tables that are tables: four cells and more, a fifth of them filled, and not the frame of a whole sheet."""
    b = F.col("position.bbox")
    area = F.coalesce(F.abs(b["x2"] - b["x1"]) * F.abs(b["y2"] - b["y1"]), F.lit(0.0))
    df = table(spark, root, "fragments").filter("structured_payload.table_html is not null").select("fragment_no", *tables.completeness(F.col("structured_payload.table_html")), area.alias("a"))
    real = (F.col("cells") >= 4) & (F.col("filled") >= 0.2 * F.col("cells")) & (F.col("a") < 0.8)
    return df.select("fragment_no", "cells", "filled", F.round("a", 6).alias("area"), real.alias("structured"))


_LAYER = "(SELECT line_id, s3_fileid, page, text, bbox FROM text_lines WHERE bbox IS NOT NULL AND method = 'text_layer')"


@R.query(
    f"""WITH r AS (SELECT line_id, sum(f) OVER (PARTITION BY s3_fileid, page ORDER BY cy, line_id) AS row_no FROM (SELECT *, CASE WHEN cy - lag(cy) OVER (PARTITION BY s3_fileid, page ORDER BY cy, line_id) <= 0.5 * m THEN 0 ELSE 1 END AS f FROM (
        SELECT line_id, s3_fileid, page, (bbox.y1 + bbox.y2) / 2 AS cy, median(bbox.y2 - bbox.y1) OVER (PARTITION BY s3_fileid, page) AS m FROM {_LAYER}))),
      c AS (SELECT line_id, sum(f) OVER (PARTITION BY s3_fileid, page ORDER BY x1, line_id) AS column_no FROM (SELECT *, CASE WHEN reach IS NULL OR x1 > reach + 0.02 THEN 1 ELSE 0 END AS f FROM (
        SELECT line_id, s3_fileid, page, bbox.x1 AS x1, max(bbox.x2) OVER (PARTITION BY s3_fileid, page ORDER BY bbox.x1, line_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM {_LAYER}))),
      g AS (SELECT s3_fileid, page, max(row_no)::BIGINT AS n_rows, max(column_no)::BIGINT AS n_columns, count(*) AS lines, count(DISTINCT (row_no, column_no)) AS filled FROM {_LAYER} JOIN r USING (line_id) JOIN c USING (line_id) GROUP BY s3_fileid, page)
    SELECT *, n_rows >= 2 AND n_columns >= 2 AND filled >= 0.5 * n_rows * n_columns AS is_table FROM g"""
)
def line_tables(spark: SparkSession, root: str) -> DataFrame:
    """A page's lines as a grid of row bands and column corridors; a table if it has two of both and half of the places are filled."""
    lines = table(spark, root, "text_lines").filter("bbox is not null and method = 'text_layer'")
    page = Window.partitionBy("s3_fileid", "page")
    df = lines.select("line_id", "s3_fileid", "page", F.col("bbox.x1").alias("x1"), F.col("bbox.x2").alias("x2"), ((F.col("bbox.y1") + F.col("bbox.y2")) / 2).alias("cy"), F.median(F.col("bbox.y2") - F.col("bbox.y1")).over(page).alias("m"))
    down, across = page.orderBy("cy", "line_id"), page.orderBy("x1", "line_id")
    df = df.withColumn("rf", F.when(F.col("cy") - F.lag("cy").over(down) <= 0.5 * F.col("m"), 0).otherwise(1)).withColumn("row_no", F.sum("rf").over(down))
    reach = F.max("x2").over(across.rowsBetween(Window.unboundedPreceding, -1))
    df = df.withColumn("cf", F.when(reach.isNull() | (F.col("x1") > reach + 0.02), 1).otherwise(0)).withColumn("column_no", F.sum("cf").over(across))
    by = df.groupBy("s3_fileid", "page").agg(F.max("row_no").alias("n_rows"), F.max("column_no").alias("n_columns"), F.count("*").alias("lines"), F.countDistinct("row_no", "column_no").alias("filled"))
    return by.withColumn("is_table", (F.col("n_rows") >= 2) & (F.col("n_columns") >= 2) & (F.col("filled") >= 0.5 * F.col("n_rows") * F.col("n_columns")))


_NUMERIC, _SIZE, _CODE = r"[0-9]+([.,][0-9]+)?", r"⌀ ?[0-9]|[0-9] ?[×x] ?[0-9]|±|R[az] ?[0-9]", r"[А-Я]{4}\.[0-9]{6}\.[0-9]{3}"


@R.query(
    f"""SELECT s3_fileid, page, round(numeric_share, 6) AS numeric_share, round(CASE WHEN numeric_share >= 0.3 THEN 0.35 WHEN numeric_share >= 0.1 THEN 0.15 ELSE 0.0 END + CASE WHEN turned THEN 0.25 ELSE 0.0 END + CASE WHEN sizes >= 10 THEN 0.25 WHEN sizes >= 3 THEN 0.1 ELSE 0.0 END + CASE WHEN codes > 0 THEN 0.15 ELSE 0.0 END, 6)::DOUBLE AS score
      FROM (SELECT s3_fileid, page, sum(len(list_filter(w, lambda x: regexp_full_match(x, '{_NUMERIC}')))) / greatest(sum(len(w)), 1) AS numeric_share, coalesce(bool_or(abs(rotation) > 45), FALSE) AS turned, sum(len(regexp_extract_all(text, '{_SIZE}'))) AS sizes, sum(len(regexp_extract_all(text, '{_CODE}'))) AS codes
        FROM (SELECT *, regexp_extract_all(text, '[^ ]+') AS w FROM text_lines WHERE text IS NOT NULL) GROUP BY s3_fileid, page)"""
)
def drawing_scores(spark: SparkSession, root: str) -> DataFrame:
    """How much a page looks like a drawing: share of bare numbers, turned lines, dimensions, a designation."""
    df = table(spark, root, "text_lines").filter("text is not null").withColumn("w", F.regexp_extract_all("text", F.lit("[^ ]+"), F.lit(0)))
    numbers = F.size(F.filter("w", lambda x: x.rlike(rf"\A{_NUMERIC}\z")))
    by = df.groupBy("s3_fileid", "page").agg(
        (F.sum(numbers) / F.greatest(F.sum(F.size("w")), F.lit(1))).alias("share"), F.coalesce(F.max(F.abs("rotation") > 45), F.lit(False)).alias("turned"), F.sum(F.regexp_count("text", F.lit(_SIZE))).alias("sizes"), F.sum(F.regexp_count("text", F.lit(_CODE))).alias("codes")
    )
    part = lambda c, v, *more: F.when(c, v) if not more else F.when(c, v).when(*more)
    score = part(F.col("share") >= 0.3, 0.35, F.col("share") >= 0.1, 0.15).otherwise(0.0) + part(F.col("turned"), 0.25).otherwise(0.0) + part(F.col("sizes") >= 10, 0.25, F.col("sizes") >= 3, 0.1).otherwise(0.0) + part(F.col("codes") > 0, 0.15).otherwise(0.0)
    return by.select("s3_fileid", "page", F.round("share", 6).alias("numeric_share"), F.round(score, 6).alias("score"))


@R.query(rf"SELECT * FROM (SELECT line_id, {_KINDS} AS kind, nullif(regexp_extract(t, '±\s?(\d+(?:[.,]\d+)?)', 1), '') AS plus_minus FROM (SELECT line_id, text AS t FROM text_lines WHERE method = 'text_layer' AND text IS NOT NULL)) WHERE kind <> 'note'")
def line_fields(spark: SparkSession, root: str) -> DataFrame:
    """Lines of the text layer that are fields of a drawing."""
    t = F.col("text")
    df = table(spark, root, "text_lines").filter("method = 'text_layer' and text is not null")
    return df.select("line_id", fields.kind(t).alias("kind"), F.nullif(F.regexp_extract(t, r"±\s?(\d+(?:[.,]\d+)?)", 1), F.lit("")).alias("plus_minus")).filter("kind <> 'note'")


#: What speaks for a drawing in a text, with its weight; counted three times at most.
EVIDENCE = ((2.0, _CODE), (1.0, _SIZE), (0.5, "МПа|MPa|°C"), (-1.0, "Инструкция|Регламент|Instruction|Procedure"))
_WEIGHT = " + ".join(f"{w} * least(len(regexp_extract_all(text, '{p}')), 3)" for w, p in EVIDENCE)


@R.query(f"SELECT doc_id, chars::INTEGER AS chars, weight::DOUBLE AS weight, chars >= 120 AND weight < 2 AS demoted FROM (SELECT doc_id, {_BARE.format('text')} AS chars, {_WEIGHT} AS weight FROM documents WHERE text IS NOT NULL)")
def genre_gate(spark: SparkSession, root: str) -> DataFrame:
    """Documents with text enough to judge and too little that speaks for a drawing are not treated as one."""
    weight = sum((F.lit(w) * F.least(F.regexp_count("text", F.lit(p)), F.lit(3)) for w, p in EVIDENCE), F.lit(0.0))
    df = table(spark, root, "documents").filter("text is not null").select("doc_id", X.nonspace_chars(F.col("text")).alias("chars"), weight.alias("weight"))
    return df.withColumn("demoted", (F.col("chars") >= 120) & (F.col("weight") < 2))


_PARAGRAPHS = geometry.R.sql["line_paragraphs"]


@R.query(f"SELECT s3_fileid, page, paragraph, string_agg(text, ' ' ORDER BY bbox.y1, bbox.x1, line_id) AS text, count(*) AS lines FROM ({_PARAGRAPHS}) JOIN text_lines USING (line_id) GROUP BY s3_fileid, page, paragraph")
def layer_paragraphs(spark: SparkSession, root: str) -> DataFrame:
    """A file read from its lines alone: paragraphs of each page."""
    df = layout.paragraphs(table(spark, root, "text_lines")).select("s3_fileid", "page", "paragraph", "line_id", "text", F.col("bbox.y1").alias("y"), F.col("bbox.x1").alias("x"))
    return df.groupBy("s3_fileid", "page", "paragraph").agg(F.expr("listagg(text, ' ') within group (order by y, x, line_id)").alias("text"), F.count("*").alias("lines"))


@R.query(
    f"""SELECT s3_fileid, position.page AS page, count(*) AS fragments, bool_and(fragment_type = 'image') AS picture_only, coalesce(bool_or(position.bbox.x1 <= 0.02 AND position.bbox.y1 <= 0.02 AND position.bbox.x2 >= 0.98 AND position.bbox.y2 >= 0.98), FALSE) AS whole_sheet,
      sum({_BARE.format('text')})::BIGINT AS chars FROM fragments GROUP BY ALL"""
)
def sheet_pages(spark: SparkSession, root: str) -> DataFrame:
    """Pages that came back as pictures only, or with a block over the whole sheet: those a drawing reader has to read."""
    b = F.col("position.bbox")
    whole = (b["x1"] <= 0.02) & (b["y1"] <= 0.02) & (b["x2"] >= 0.98) & (b["y2"] >= 0.98)
    by = table(spark, root, "fragments").groupBy("s3_fileid", F.col("position.page").alias("page"))
    return by.agg(F.count("*").alias("fragments"), F.min(F.col("fragment_type") == "image").alias("picture_only"), F.coalesce(F.max(whole), F.lit(False)).alias("whole_sheet"), F.sum(X.nonspace_chars(F.col("text"))).alias("chars"))


_ANGLE, _DIAMETER, _LINEAR = r"^ *[0-9]+([.,][0-9]+)? ?°( |$)", r"^ *[⌀Øø]", r"^ *[0-9]+([.,][0-9]+)?( ?(мм|mm))?( ?±.*)?$"


@R.query(f"SELECT change_id, CASE WHEN kind IN ('thread', 'radius', 'roughness', 'designation', 'material') THEN kind WHEN regexp_matches(t, '{_DIAMETER}') THEN 'diameter' WHEN regexp_matches(t, '{_ANGLE}') THEN 'angle' WHEN regexp_matches(t, '{_LINEAR}') THEN 'linear' WHEN kind = 'tolerance' THEN 'tolerance' END AS value_kind FROM (SELECT change_id, t, {_KINDS} AS kind FROM (SELECT change_id, before AS t FROM text_changes WHERE before IS NOT NULL))")
def value_kinds(spark: SparkSession, root: str) -> DataFrame:
    """What a value measures; null for a text that is no value."""
    t = F.col("before")
    kind = fields.kind(t)
    named = kind.isin("thread", "radius", "roughness", "designation", "material")
    out = F.when(named, kind).when(t.rlike(_DIAMETER), "diameter").when(t.rlike(_ANGLE), "angle").when(t.rlike(_LINEAR), "linear").when(kind == "tolerance", "tolerance")
    return table(spark, root, "text_changes").filter("before is not null").select("change_id", out.alias("value_kind"))


#: How the labels of a title block begin.
STAMP_LABELS = ("разраб", "пров", "н. контр", "н.контр", "т. контр", "т.контр", "утв", "изм", "лист", "лит", "масса", "масштаб", "подп", "дата", "№ док", "обозначение", "наименование")
_LABEL = " OR ".join(f"starts_with(lower(x), '{w}')" for w in STAMP_LABELS)


@R.query(f"SELECT fragment_no, cells::INTEGER AS cells, labels::INTEGER AS labels, labels >= 4 AND labels * 3 >= cells AS stamp FROM (SELECT fragment_no, len(c) AS cells, len(list_filter(list_transform(c, lambda x: trim(regexp_replace(x, '(?s)<!--.*?-->|</?[A-Za-z][^>]*>', '', 'g'))), lambda x: {_LABEL})) AS labels FROM (SELECT fragment_no, {documents._CELLS} AS c FROM fragments WHERE structured_payload.table_html IS NOT NULL))")
def stamp_tables(spark: SparkSession, root: str) -> DataFrame:
    """Tables that are title blocks: four label cells and more, a third of all cells."""

    def label(x):
        low, out = F.lower(x), F.lit(False)
        for w in STAMP_LABELS:
            out = out | F.startswith(low, F.lit(w))
        return out

    cells = tables.cell_texts(F.col("structured_payload.table_html"))
    df = table(spark, root, "fragments").filter("structured_payload.table_html is not null").select("fragment_no", F.size(cells).alias("cells"), F.size(F.filter(cells, label)).alias("labels"))
    return df.withColumn("stamp", (F.col("labels") >= 4) & (F.col("labels") * 3 >= F.col("cells")))


_ROLE = r"^ *(разраб|пров|н\. ?контр|т\. ?контр|утв|designed|checked|approved)[^ ]* +([\p{L}-]{2,})( +[\p{L}]\. ?[\p{L}]\.)?( +([0-9]{2}\.[0-9]{2}\.[0-9]{2,4}))?"


@R.query(f"SELECT line_id, role, name, nullif(signed, '') AS signed FROM (SELECT line_id, lower(regexp_extract(text, '(?i){_ROLE}', 1)) AS role, regexp_extract(text, '(?i){_ROLE}', 2) AS name, regexp_extract(text, '(?i){_ROLE}', 5) AS signed FROM text_lines) WHERE role <> ''")
def title_signers(spark: SparkSession, root: str) -> DataFrame:
    """Rows of a title block: who signed in which role, and when."""
    part = lambda k: F.regexp_extract("text", "(?iu)" + _ROLE, k)
    return table(spark, root, "text_lines").select("line_id", F.lower(part(1)).alias("role"), part(2).alias("name"), F.nullif(part(5), F.lit("")).alias("signed")).filter("role <> ''")


_JUNK = r"[|_=~^*#<>/\\-]{2,}"


@R.query(f"SELECT line_id, array_to_string(kept, ' ') AS text, (len(w) - len(kept))::INTEGER AS dropped FROM (SELECT line_id, w, list_filter(w, lambda x: NOT regexp_full_match(x, '{_JUNK}')) AS kept FROM (SELECT line_id, string_split(text, ' ') AS w FROM text_lines WHERE method = 'tesseract' AND text IS NOT NULL))")
def junk_free_lines(spark: SparkSession, root: str) -> DataFrame:
    """Recognised lines without what is left of a grid: tokens of nothing but bars and dashes."""
    words = F.split("text", " ")
    kept = F.filter(words, lambda x: ~x.rlike(rf"\A{_JUNK}\z"))
    return table(spark, root, "text_lines").filter("method = 'tesseract' and text is not null").select("line_id", F.array_join(kept, " ").alias("text"), (F.size(words) - F.size(kept)).alias("dropped"))


_VIEW = r"^ *([Вв]ид|[Рр]азрез|[Сс]ечение|[Vv]iew|[Ss]ection)? *([А-ЯA-Z])(-([А-ЯA-Z]))?( *\(([0-9]+:[0-9]+)\))? *$"


@R.query(f"SELECT line_id, CASE WHEN b <> '' THEN a || '-' || b ELSE a END AS view_name, CASE WHEN b <> '' THEN 'section' ELSE 'view' END AS kind, nullif(s, '') AS scale FROM (SELECT line_id, w, regexp_extract(text, '{_VIEW}', 2) AS a, regexp_extract(text, '{_VIEW}', 4) AS b, regexp_extract(text, '{_VIEW}', 6) AS s FROM (SELECT line_id, text, lower(regexp_extract(text, '{_VIEW}', 1)) AS w FROM text_lines)) WHERE a <> '' AND (w <> '' OR b = a)")
def view_titles(spark: SparkSession, root: str) -> DataFrame:
    """Titles of views and sections: a letter after a word for it, or a letter twice."""
    part = lambda k: F.regexp_extract("text", _VIEW, k)
    df = table(spark, root, "text_lines").select("line_id", F.lower(part(1)).alias("w"), part(2).alias("a"), part(4).alias("b"), part(6).alias("s")).filter("a <> '' and (w <> '' or b = a)")
    both = F.col("b") != ""
    return df.select("line_id", F.when(both, F.concat_ws("-", "a", "b")).otherwise(F.col("a")).alias("view_name"), F.when(both, "section").otherwise("view").alias("kind"), F.nullif("s", F.lit("")).alias("scale"))
