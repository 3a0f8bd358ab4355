"""Queries on lines, boxes and fields."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafline.functions import texts as X
from sheafline.operators import fields, layout, repair, sheets
from sheafline.plans.registry import Registry
from sheafline.session import table

R = Registry()


@R.query(
    """SELECT line_id, sum(f) OVER (PARTITION BY s3_fileid, page ORDER BY y1, x1, line_id)::BIGINT AS paragraph FROM (
      SELECT *, CASE WHEN lag(line_id) OVER w IS NULL OR y1 - lag(y2) OVER w > greatest(0.004, 0.85 * m) OR lag(rotation) OVER w IS DISTINCT FROM rotation THEN 1 ELSE 0 END AS f FROM (
        SELECT line_id, s3_fileid, page, rotation, bbox.y1 AS y1, bbox.x1 AS x1, bbox.y2 AS y2, median(bbox.y2 - bbox.y1) OVER (PARTITION BY s3_fileid, page) AS m FROM text_lines WHERE bbox IS NOT NULL)
      WINDOW w AS (PARTITION BY s3_fileid, page ORDER BY y1, x1, line_id))"""
)
def line_paragraphs(spark: SparkSession, root: str) -> DataFrame:
    return layout.paragraphs(table(spark, root, "text_lines")).select("line_id", "paragraph")


@R.query(
    r"""WITH v AS (SELECT s3_fileid, page, (floor(rotation / 90 + 0.5)::INT % 4) * 90 AS turn, sum(length(regexp_replace(text, '[^\p{L}]', '', 'g'))) AS n FROM text_lines WHERE rotation IS NOT NULL GROUP BY ALL)
    SELECT s3_fileid, page, CASE WHEN max(n) >= 0.6 * sum(n) THEN arg_max(turn, n * 1000 - turn) ELSE 0 END AS turn, sum(n)::BIGINT AS letters FROM v GROUP BY s3_fileid, page"""
)
def page_turns(spark: SparkSession, root: str) -> DataFrame:
    return layout.page_turn(table(spark, root, "text_lines"))


@R.query(
    """WITH l AS (SELECT line_id, s3_fileid, page, (bbox.x1 + bbox.x2) / 2 AS cx, (bbox.y1 + bbox.y2) / 2 AS cy FROM text_lines WHERE bbox IS NOT NULL),
      b AS (SELECT fragment_no, s3_fileid, position.page AS page, position.bbox AS r FROM fragments WHERE position.bbox IS NOT NULL)
    SELECT l.line_id, h.fragment_no FROM l LEFT JOIN (
      SELECT line_id, fragment_no FROM (SELECT l.line_id, b.fragment_no, row_number() OVER (PARTITION BY l.line_id ORDER BY (r.x2 - r.x1) * (r.y2 - r.y1), fragment_no) AS k FROM l JOIN b USING (s3_fileid, page)
        WHERE cx BETWEEN r.x1 - 0.004 AND r.x2 + 0.004 AND cy BETWEEN r.y1 - 0.004 AND r.y2 + 0.004) WHERE k = 1) h USING (line_id)"""
)
def lines_in_blocks(spark: SparkSession, root: str) -> DataFrame:
    return layout.assign(table(spark, root, "text_lines"), table(spark, root, "fragments"))


@R.query(
    """SELECT s3_fileid, page, count(*) AS lines, sum(length(text))::BIGINT AS chars, round(sum(confidence * length(text)) / sum(length(text)) FILTER (WHERE confidence IS NOT NULL), 6) AS confidence,
      round(coalesce(sum(length(text)) FILTER (WHERE confidence < 0.35), 0) / sum(length(text)), 6) AS unreadable,
      CASE WHEN coalesce(sum(length(text)) FILTER (WHERE confidence < 0.35), 0) > 0.6 * sum(length(text)) THEN 'unreadable' WHEN sum(confidence * length(text)) / sum(length(text)) FILTER (WHERE confidence IS NOT NULL) < 0.65 THEN 'doubtful' ELSE 'readable' END AS verdict
    FROM text_lines WHERE method = 'tesseract' AND length(text) > 0 GROUP BY s3_fileid, page"""
)
def page_confidence(spark: SparkSession, root: str) -> DataFrame:
    """Confidence of recognised pages weighted by length, and the share of text below 0.35."""
    df = table(spark, root, "text_lines").filter("method = 'tesseract' and length(text) > 0").withColumn("w", F.length("text"))
    by = df.groupBy("s3_fileid", "page").agg(
        F.count("*").alias("lines"), F.sum("w").alias("chars"), F.sum(F.col("confidence") * F.col("w")).alias("s"), F.sum(F.when(F.col("confidence").isNotNull(), F.col("w"))).alias("k"), F.coalesce(F.sum(F.when(F.col("confidence") < 0.35, F.col("w"))), F.lit(0)).alias("bad")
    )
    mean = F.col("s") / F.col("k")
    verdict = F.when(F.col("bad") > 0.6 * F.col("chars"), "unreadable").when(mean < 0.65, "doubtful").otherwise("readable")
    return by.select("s3_fileid", "page", "lines", "chars", F.round(mean, 6).alias("confidence"), F.round(F.col("bad") / F.col("chars"), 6).alias("unreadable"), verdict.alias("verdict"))


@R.query("SELECT s3_fileid, page, string_agg(text, chr(10) ORDER BY round(bbox.y1, 3), round(bbox.x1, 3), line_id) AS text FROM text_lines WHERE bbox IS NOT NULL AND method = 'text_layer' GROUP BY s3_fileid, page")
def page_reading_text(spark: SparkSession, root: str) -> DataFrame:
    return layout.reading_text(table(spark, root, "text_lines").filter("method = 'text_layer'"))


@R.query(
    """SELECT s3_fileid, page, column_no, min(x1) AS x1, max(x2) AS x2, count(*) AS lines FROM (
      SELECT *, sum(f) OVER (PARTITION BY s3_fileid, page ORDER BY x1, line_id)::BIGINT AS column_no FROM (
        SELECT *, CASE WHEN reach IS NULL OR x1 > reach + 0.02 THEN 1 ELSE 0 END AS f FROM (
          SELECT line_id, s3_fileid, page, bbox.x1 AS x1, bbox.x2 AS x2, max(bbox.x2) OVER (PARTITION BY s3_fileid, page ORDER BY bbox.x1, line_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM text_lines WHERE bbox IS NOT NULL)))
    GROUP BY s3_fileid, page, column_no"""
)
def page_columns(spark: SparkSession, root: str) -> DataFrame:
    return layout.columns(table(spark, root, "text_lines"))


@R.query(
    """SELECT s3_fileid, page, line_no, max_by(line_id, (read_at, line_id)) AS line_id, count(*) AS readings FROM text_lines GROUP BY s3_fileid, page, line_no"""
)
def latest_readings(spark: SparkSession, root: str) -> DataFrame:
    """Lines read again: the last reading of each place."""
    return table(spark, root, "text_lines").groupBy("s3_fileid", "page", "line_no").agg(F.max_by("line_id", F.struct("read_at", "line_id")).alias("line_id"), F.count("*").alias("readings"))


@R.query(
    r"""WITH t AS (SELECT DISTINCT s3_fileid, page, line_id, unnest(regexp_extract_all(lower(text), '\p{L}{3,}')) AS w FROM text_lines WHERE method = 'text_layer'),
      c AS (SELECT DISTINCT s3_fileid, position.page AS page, unnest(regexp_extract_all(lower(coalesce(text, '') || ' ' || coalesce(structured_payload.table_html, '')), '\p{L}{3,}')) AS w FROM fragments)
    SELECT line_id, count(*) AS words, count(c.w) AS known, count(*) >= 4 AND count(c.w) >= 0.8 * count(*) AS duplicate FROM t LEFT JOIN c ON t.s3_fileid = c.s3_fileid AND t.page = c.page AND t.w = c.w GROUP BY line_id"""
)
def lines_already_there(spark: SparkSession, root: str) -> DataFrame:
    """Lines of the layer whose words stand in the page's fragments already (four words or more, four in five known)."""
    words = lambda c: F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit(r"\p{L}{3,}"), F.lit(0)))
    lines = table(spark, root, "text_lines").filter("method = 'text_layer'").select("s3_fileid", "page", "line_id", F.explode(words(F.col("text"))).alias("w"))
    text = F.concat_ws(" ", F.coalesce("text", F.lit("")), F.coalesce("structured_payload.table_html", F.lit("")))
    there = table(spark, root, "fragments").select("s3_fileid", F.col("position.page").alias("page"), F.explode(words(text)).alias("w")).distinct().withColumn("k", F.lit(1))
    by = lines.join(there, ["s3_fileid", "page", "w"], "left").groupBy("line_id").agg(F.count("*").alias("words"), F.count("k").alias("known"))
    return by.withColumn("duplicate", (F.col("words") >= 4) & (F.col("known") >= 0.8 * F.col("words")))


_KINDS = "CASE " + " ".join(f"WHEN regexp_matches(t, '{p}') THEN '{k}'" for k, p in fields.KINDS) + " ELSE 'note' END"


@R.query(
    rf"""SELECT change_id, {_KINDS} AS kind, CASE WHEN regexp_extract(t, '±\s?(\d+(?:[.,]\d+)?)', 1) <> '' THEN '±' || regexp_extract(t, '±\s?(\d+(?:[.,]\d+)?)', 1)
      WHEN regexp_extract(t, '\d([HhgfeEk]\d{{1,2}})(?:\W|$)', 1) <> '' THEN regexp_extract(t, '\d([HhgfeEk]\d{{1,2}})(?:\W|$)', 1) END AS tolerance FROM (SELECT change_id, before AS t FROM text_changes)"""
)
def annotation_kinds(spark: SparkSession, root: str) -> DataFrame:
    t = F.col("before")
    return table(spark, root, "text_changes").select("change_id", fields.kind(t).alias("kind"), fields.tolerance(t).alias("tolerance"))


@R.query(
    f"""SELECT s3_fileid, count(*) AS fields, count(*) FILTER (WHERE k <> 'note') AS structured, round(count(*) FILTER (WHERE k <> 'note') / count(*), 6) AS ratio FROM (SELECT s3_fileid, {_KINDS} AS k FROM (SELECT s3_fileid, before AS t FROM text_changes)) GROUP BY s3_fileid"""
)
def structure_ratio(spark: SparkSession, root: str) -> DataFrame:
    by = table(spark, root, "text_changes").groupBy("s3_fileid").agg(F.count("*").alias("fields"), F.count_if(fields.kind(F.col("before")) != "note").alias("structured"))
    return by.withColumn("ratio", F.round(F.col("structured") / F.col("fields"), 6))


@R.query(
    """SELECT s3_fileid, line_id, first_no, seen FROM (
      SELECT *, min(line_no) OVER k AS first_no, count(*) OVER k AS seen, row_number() OVER (PARTITION BY s3_fileid, lower(trim(text)) ORDER BY coalesce(confidence, -1.0) DESC, line_id) AS r FROM text_lines WHERE method = 'tesseract'
      WINDOW k AS (PARTITION BY s3_fileid, lower(trim(text)))) WHERE r = 1"""
)
def surest_lines(spark: SparkSession, root: str) -> DataFrame:
    """Of equal lines of a file the surest, with where the text was first seen."""
    df = table(spark, root, "text_lines").filter("method = 'tesseract'")
    by = df.groupBy("s3_fileid", F.lower(F.trim("text")).alias("key")).agg(F.max_by("line_id", F.struct(F.coalesce("confidence", F.lit(-1.0)), -F.col("line_id"))).alias("line_id"), F.min("line_no").alias("first_no"), F.count("*").alias("seen"))
    return by.drop("key")


@R.query(
    r"""WITH l AS (SELECT s3_fileid, page, line_no, line_id, text, regexp_replace(translate(lower(text), '⌀ø∅,−–—', 'ooo.---'), '[ \t\n\x0b\f\r]+', '', 'g') AS k FROM text_lines WHERE method = 'text_layer'),
      n AS (SELECT *, row_number() OVER (PARTITION BY s3_fileid, page, k ORDER BY line_no NULLS FIRST, line_id) AS nth FROM l)
    SELECT s3_fileid, arg_min(page, row(page, line_no, line_id)) AS page, arg_min(text, row(page, line_no, line_id)) AS text, arg_min(line_no, row(page, line_no, line_id)) AS line_no FROM n GROUP BY s3_fileid, k, nth"""
)
def merged_lines(spark: SparkSession, root: str) -> DataFrame:
    """Lines of a file's pages merged as multisets: repeated lines as often as the page that holds them most often."""
    df = table(spark, root, "text_lines").filter("method = 'text_layer'").select("s3_fileid", "page", "text", F.struct("line_no", "line_id").alias("position"))
    return fields.merge_multisets(df, ["s3_fileid"], "page", "text", "position").select("s3_fileid", "page", "text", F.col("position.line_no").alias("line_no"))


@R.query(
    """SELECT s3_fileid, tile::INTEGER AS tile, greatest(0.0, (tile % 3) / 3.0 - 0.1 / 3) AS x1, greatest(0.0, (tile // 3) / 2.0 - 0.1 / 2) AS y1, least(1.0, (tile % 3 + 1) / 3.0 + 0.1 / 3) AS x2, least(1.0, (tile // 3 + 1) / 2.0 + 0.1 / 2) AS y2
      FROM (SELECT DISTINCT s3_fileid FROM text_lines), (SELECT unnest(generate_series(0, 5)) AS tile)"""
)
def tile_boxes(spark: SparkSession, root: str) -> DataFrame:
    return layout.tile_boxes(table(spark, root, "text_lines").select("s3_fileid").distinct())


@R.query(
    r"""SELECT line_id, length(regexp_replace(text, '[^\p{L}]', '', 'g'))::INTEGER AS letters, len(regexp_extract_all(text, '(?:[a-zA-Z][а-яёА-ЯЁ]|[а-яёА-ЯЁ][a-zA-Z])'))::INTEGER AS seams, lower(translate(text, 'АВЕКМНОРСТУХаеорсух', 'ABEKMHOPCTYXaeopcyx')) AS folded FROM text_lines WHERE method = 'text_layer'"""
)
def folded_lines(spark: SparkSession, root: str) -> DataFrame:
    df = table(spark, root, "text_lines").filter("method = 'text_layer'")
    return df.select("line_id", F.length(F.regexp_replace("text", r"[^\p{L}]", "")).alias("letters"), X.mixed_script_words(F.col("text")).alias("seams"), X.fold_homoglyphs(F.col("text")).alias("folded"))


@R.query(
    """WITH l AS (SELECT line_id, s3_fileid, page, bbox AS a FROM text_lines WHERE bbox IS NOT NULL), b AS (SELECT fragment_no, s3_fileid, position.page AS page, position.bbox AS b FROM fragments WHERE position.bbox IS NOT NULL),
      d AS (SELECT line_id, fragment_no, round(greatest(0.0, b.x1 - a.x2, a.x1 - b.x2, b.y1 - a.y2, a.y1 - b.y2), 9) AS distance FROM l JOIN b USING (s3_fileid, page)),
      r AS (SELECT *, row_number() OVER (PARTITION BY line_id ORDER BY distance, fragment_no) AS k, lead(distance) OVER (PARTITION BY line_id ORDER BY distance, fragment_no) AS second FROM d)
    SELECT line_id, fragment_no, distance FROM r WHERE k = 1 AND distance <= 0.02 AND (second IS NULL OR second >= distance + 0.02)"""
)
def nearest_blocks(spark: SparkSession, root: str) -> DataFrame:
    return sheets.nearest(table(spark, root, "text_lines"), table(spark, root, "fragments"))


@R.query(
    """SELECT s3_fileid, page, count(*) AS cells FROM (SELECT DISTINCT s3_fileid, page, r, c FROM (SELECT s3_fileid, page, r, unnest(generate_series(c1, c2)) AS c FROM (SELECT s3_fileid, page, unnest(generate_series(r1, greatest(r1, r2))) AS r, c1, greatest(c1, c2) AS c2 FROM (
      SELECT s3_fileid, page, least(49, greatest(0, floor(bbox.y1 * 50)))::INT AS r1, least(49, greatest(0, floor(bbox.y2 * 50)))::INT AS r2, least(49, greatest(0, floor(bbox.x1 * 50)))::INT AS c1, least(49, greatest(0, floor(bbox.x2 * 50)))::INT AS c2 FROM text_lines WHERE bbox IS NOT NULL)))) GROUP BY s3_fileid, page"""
)
def occupied_cells(spark: SparkSession, root: str) -> DataFrame:
    return sheets.cells(table(spark, root, "text_lines")).groupBy("s3_fileid", "page").agg(F.count("*").alias("cells"))


@R.query(
    """WITH RECURSIVE g AS (SELECT DISTINCT s3_fileid, page, r, c FROM (SELECT s3_fileid, page, r, unnest(generate_series(c1, c2)) AS c FROM (SELECT s3_fileid, page, unnest(generate_series(r1, greatest(r1, r2))) AS r, c1, greatest(c1, c2) AS c2 FROM (
      SELECT s3_fileid, page, least(49, greatest(0, floor(bbox.y1 * 50)))::INT AS r1, least(49, greatest(0, floor(bbox.y2 * 50)))::INT AS r2, least(49, greatest(0, floor(bbox.x1 * 50)))::INT AS c1, least(49, greatest(0, floor(bbox.x2 * 50)))::INT AS c2 FROM text_lines WHERE bbox IS NOT NULL)))),
      s AS (SELECT * FROM g WHERE NOT EXISTS (SELECT 1 FROM g o WHERE o.s3_fileid = g.s3_fileid AND o.page = g.page AND (o.r = g.r - 1 AND o.c = g.c OR o.r = g.r AND o.c = g.c - 1))),
      t AS (SELECT s3_fileid, page, r, c, r * 50 + c AS root FROM s
        UNION SELECT g.s3_fileid, g.page, g.r, g.c, t.root FROM t JOIN g ON g.s3_fileid = t.s3_fileid AND g.page = t.page AND abs(g.r - t.r) + abs(g.c - t.c) = 1),
      m AS (SELECT s3_fileid, page, r, c, min(root) AS root FROM t GROUP BY ALL)
    SELECT s3_fileid, page, (dense_rank() OVER (PARTITION BY s3_fileid, page ORDER BY root) - 1)::INTEGER AS component, cells::INTEGER AS cells, r1::INTEGER AS r1, c1::INTEGER AS c1, r2::INTEGER AS r2, c2::INTEGER AS c2 FROM (SELECT s3_fileid, page, root, count(*) AS cells, min(r) AS r1, min(c) AS c1, max(r) AS r2, max(c) AS c2 FROM m GROUP BY ALL)"""
)
def grid_components(spark: SparkSession, root: str) -> DataFrame:
    return sheets.components(sheets.cells(table(spark, root, "text_lines")))


@R.query()
def repaired_changes(spark: SparkSession, root: str) -> DataFrame:
    """The ``before`` texts of changes through the repairs for alphabets, designations and dimensions."""
    words = repair.vocabulary_of(table(spark, root, "word_list"))
    df = table(spark, root, "text_changes").select("change_id", "before")
    return repair.apply(df, "before", lambda t: repair.mixed_words(t, words), repair.designations, repair.dimensions).select("change_id", "repaired.text", "repaired.changed")


@R.query()
def unglued_lines(spark: SparkSession, root: str) -> DataFrame:
    words = repair.vocabulary_of(table(spark, root, "word_list"))
    df = table(spark, root, "text_lines").filter("method = 'text_layer'").select("line_id", "text")
    return repair.apply(df, "text", lambda t: repair.unglue(t, words)).select("line_id", F.col("repaired.text").alias("text"), "repaired.changed")


@R.query()
def formula_prose(spark: SparkSession, root: str) -> DataFrame:
    df = table(spark, root, "fragments").filter("formula is not null").select("fragment_no", "formula")
    return repair.apply(df, "formula", repair.mangled_prose).select("fragment_no", "repaired.text", "repaired.changed")


@R.query(
    """SELECT fragment_no, concat_ws(chr(10), CASE WHEN trim(section_title) <> '' THEN 'section: ' || section_title END, CASE WHEN trim(text) <> '' THEN 'text: ' || text END, CASE WHEN trim(formula) <> '' THEN 'formula: ' || formula END,
      CASE WHEN trim(structured_payload.table_html) <> '' THEN 'table: ' || structured_payload.table_html END) AS record FROM fragments"""
)
def fragment_records(spark: SparkSession, root: str) -> DataFrame:
    parts = [("section", F.col("section_title")), ("text", F.col("text")), ("formula", F.col("formula")), ("table", F.col("structured_payload.table_html"))]
    return table(spark, root, "fragments").select("fragment_no", sheets.record_text(parts).alias("record"))


@R.query(
    """SELECT s3_fileid, page, count(*) AS tokens, count(f.w) AS repeated FROM (SELECT DISTINCT s3_fileid, page, unnest(regexp_extract_all(lower(text), '\\S+')) AS w FROM text_lines WHERE method = 'tesseract') t
      LEFT JOIN (SELECT DISTINCT s3_fileid, position.page AS page, unnest(regexp_extract_all(lower(text), '\\S+')) AS w FROM fragments WHERE text IS NOT NULL) f USING (s3_fileid, page, w) GROUP BY s3_fileid, page"""
)
def repeated_tokens(spark: SparkSession, root: str) -> DataFrame:
    """How many distinct recognised tokens of a page its fragments hold already."""
    words = lambda c: F.explode(F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit(r"\S+"), F.lit(0))))
    mine = table(spark, root, "text_lines").filter("method = 'tesseract'").select("s3_fileid", "page", words("text").alias("w")).distinct()
    there = table(spark, root, "fragments").filter("text is not null").select("s3_fileid", F.col("position.page").alias("page"), words("text").alias("w")).distinct().withColumn("k", F.lit(1))
    return mine.join(there, ["s3_fileid", "page", "w"], "left").groupBy("s3_fileid", "page").agg(F.count("*").alias("tokens"), F.count("k").alias("repeated"))


@R.query(
    """SELECT line_id FROM (SELECT *, sum(length(text)) FILTER (WHERE confidence >= 0.65 OR confidence IS NULL) OVER (PARTITION BY s3_fileid, page) AS sure FROM text_lines WHERE method = 'tesseract') WHERE NOT (coalesce(sure, 0) >= 200 AND coalesce(confidence < 0.35, FALSE))"""
)
def kept_lines(spark: SparkSession, root: str) -> DataFrame:
    """Recognised lines without the unreadable ones, on pages that have 200 sure characters or more; other pages keep all."""
    df = table(spark, root, "text_lines").filter("method = 'tesseract'")
    sure = F.when((F.col("confidence") >= 0.65) | F.col("confidence").isNull(), F.length("text"))
    pages = df.groupBy("s3_fileid", "page").agg(F.sum(sure).alias("sure"))
    drop = (F.coalesce("sure", F.lit(0)) >= 200) & F.coalesce(F.col("confidence") < 0.35, F.lit(False))
    return df.join(pages, ["s3_fileid", "page"]).filter(~drop).select("line_id")
