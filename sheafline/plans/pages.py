"""Queries on pages, labels, fields and event properties."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sheafline.functions import texts as X
from sheafline.operators import fields
from sheafline.plans.documents import _LATEST, latest
from sheafline.plans.registry import Registry
from sheafline.session import table
from sheafline.sources import sinks

R = Registry()


@R.query(
    """SELECT s3_fileid, first_page, last_page, size FROM (SELECT s3_fileid, min(page) AS first_page, max(page) AS last_page, min(size) AS size FROM (
      SELECT *, (row_number() OVER (PARTITION BY s3_fileid, island ORDER BY page) - 1) // 4 AS batch FROM (
        SELECT *, sum(f) OVER (PARTITION BY s3_fileid ORDER BY page) AS island FROM (
          SELECT *, CASE WHEN lag(size) OVER w = size AND lag(page) OVER w = page - 1 THEN 0 ELSE 1 END AS f FROM (SELECT s3_fileid, page, round(median(font_size))::INT AS size FROM text_lines WHERE font_size IS NOT NULL GROUP BY ALL) WINDOW w AS (PARTITION BY s3_fileid ORDER BY page)))) GROUP BY s3_fileid, island, batch)"""
)
def page_batches(spark: SparkSession, root: str) -> DataFrame:
    """Consecutive pages of one rounded size, at most four a batch: the windows run over one row a page."""
    pages = table(spark, root, "text_lines").filter("font_size is not null").groupBy("s3_fileid", "page").agg(F.round(F.median("font_size")).cast("int").alias("size"))
    w = Window.partitionBy("s3_fileid").orderBy("page")
    same = (F.lag("size").over(w) == F.col("size")) & (F.lag("page").over(w) == F.col("page") - 1)
    islands = pages.withColumn("f", F.when(same, 0).otherwise(1)).withColumn("island", F.sum("f").over(w))
    batch = F.floor((F.row_number().over(Window.partitionBy("s3_fileid", "island").orderBy("page")) - 1) / 4)
    return islands.withColumn("batch", batch).groupBy("s3_fileid", "island", "batch").agg(F.min("page").alias("first_page"), F.max("page").alias("last_page"), F.min("size").alias("size")).drop("island", "batch")


@R.query(
    f"""SELECT s3_fileid, count(*) AS pages, sum(chars)::BIGINT AS chars, max(chars)::BIGINT AS fullest, sum(tables)::BIGINT AS tables, sum(chars) / count(*) >= 400 AS is_text FROM (
      SELECT s3_fileid, position.page AS page, sum(length(regexp_replace(coalesce(text, ''), '[\\s\\p{{Z}}\\x{{85}}]', '', 'g'))) AS chars, count(*) FILTER (WHERE fragment_type = 'table') AS tables FROM {_LATEST} GROUP BY ALL) GROUP BY s3_fileid"""
)
def volume_by_file(spark: SparkSession, root: str) -> DataFrame:
    """Characters and tables by page, then by file; a text document has 400 characters a page or more."""
    by = latest(table(spark, root, "fragments")).groupBy("s3_fileid", F.col("position.page").alias("page")).agg(F.sum(X.nonspace_chars(F.col("text"))).alias("chars"), F.count_if(F.col("fragment_type") == "table").alias("tables"))
    files = by.groupBy("s3_fileid").agg(F.count("*").alias("pages"), F.sum("chars").alias("chars"), F.max("chars").alias("fullest"), F.sum("tables").alias("tables"))
    return files.withColumn("is_text", F.col("chars") / F.col("pages") >= 400)


_KEY = "s3_fileid || '|' || coalesce(position.page, 0) || '|' || fragment_type || '|' || coalesce(text, formula, structured_payload.table_html, '')"


@R.query(
    f"""SELECT fragment_no, method FROM (SELECT fragment_no, method, {_KEY} AS k FROM fragments WHERE method <> 'tesseract') UNION ALL
      SELECT fragment_no, method FROM (SELECT fragment_no, method, {_KEY} AS k FROM fragments WHERE method = 'tesseract') t WHERE NOT EXISTS (SELECT 1 FROM (SELECT {_KEY} AS k FROM fragments WHERE method <> 'tesseract') o WHERE o.k = t.k)"""
)
def reserve_appended(spark: SparkSession, root: str) -> DataFrame:
    """Fragments of the main reading, and those of recognition whose content it does not hold."""
    key = F.concat_ws("|", "s3_fileid", F.coalesce("position.page", F.lit(0)).cast("string"), "fragment_type", F.coalesce("text", "formula", "structured_payload.table_html", F.lit("")))
    df = table(spark, root, "fragments").select("fragment_no", "method", key.alias("k"))
    return sinks.append_unseen(df.filter("method <> 'tesseract'"), df.filter("method = 'tesseract'"), "k").select("fragment_no", "method")


@R.query(
    """SELECT fragment_no, concat_ws(',', CASE WHEN completeness IS NULL THEN 'no completeness' END, CASE WHEN completeness < 0.5 THEN 'incomplete' END, CASE WHEN confidence < 0.65 THEN 'unsure' END, CASE WHEN position.bbox IS NULL THEN 'no place' END,
      CASE WHEN position.bbox.x1 = 0 AND position.bbox.y1 = 0 AND position.bbox.x2 = 1 AND position.bbox.y2 = 1 THEN 'whole sheet' END) AS reasons FROM fragments"""
)
def review_reasons(spark: SparkSession, root: str) -> DataFrame:
    b = F.col("position.bbox")
    whole = (b["x1"] == 0) & (b["y1"] == 0) & (b["x2"] == 1) & (b["y2"] == 1)
    say = lambda c, t: F.when(c, F.lit(t))
    reasons = F.array_compact(F.array(say(F.col("completeness").isNull(), "no completeness"), say(F.col("completeness") < 0.5, "incomplete"), say(F.col("confidence") < 0.65, "unsure"), say(b.isNull(), "no place"), say(whole, "whole sheet")))
    return table(spark, root, "fragments").select("fragment_no", F.concat_ws(",", reasons).alias("reasons"))


@R.query(
    """SELECT s3_fileid, unnest(generate_series(1, m))::INTEGER AS page FROM (SELECT s3_fileid, max(page) AS m FROM text_lines WHERE page > 0 GROUP BY 1) EXCEPT SELECT s3_fileid, position.page FROM fragments WHERE position.page IS NOT NULL"""
)
def unread_pages(spark: SparkSession, root: str) -> DataFrame:
    """Pages up to the last with lines that no fragment is there for."""
    last = table(spark, root, "text_lines").filter("page > 0").groupBy("s3_fileid").agg(F.max("page").alias("m"))
    every = last.select("s3_fileid", F.explode(F.sequence(F.lit(1), "m")).alias("page"))
    return every.join(table(spark, root, "fragments").select("s3_fileid", F.col("position.page").alias("page")), ["s3_fileid", "page"], "left_anti")


# Label beginnings and their canonical names; the longest that fits names a title.
LABELS = (("инструкция", "instruction"), ("instruction of", "instruction"), ("регламент", "procedure"), ("procedure of", "procedure"), ("проверка", "inspection"), ("inspection of", "inspection"), ("хранение", "storage"), ("storage of", "storage"), ("storage of the", "storage"), ("настройка", "setting"), ("setting of", "setting"))


@R.query(
    f"""SELECT d.doc_id, min_by(l.name, -length(l.p)) AS label FROM documents d LEFT JOIN (VALUES {", ".join(f"('{p}', '{n}')" for p, n in LABELS)}) l(p, name) ON starts_with(lower(trim(d.title)), l.p) GROUP BY d.doc_id"""
)
def title_labels(spark: SparkSession, root: str) -> DataFrame:
    t = F.lower(F.trim("title"))
    label = F.lit(None).cast("string")
    for p, name in sorted(LABELS, key=lambda x: len(x[0])):
        label = F.when(F.startswith(t, F.lit(p)), name).otherwise(label)
    return table(spark, root, "documents").select("doc_id", label.alias("label"))


def sane(b: Column, k: str, other: str) -> Column:
    """A coordinate in 0..1 and in order; boxes in pixels are taken for the whole sheet."""
    pixels = F.greatest(b["x1"], b["y1"], b["x2"], b["y2"]) > 1.5
    low = k.endswith("1")
    ordered = F.least(b[k], b[other]) if low else F.greatest(b[k], b[other])
    return F.when(b.isNull() | pixels, F.lit(0.0 if low else 1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), ordered)))


_B = "position.bbox"
_PX = f"({_B} IS NULL OR greatest({_B}.x1, {_B}.y1, {_B}.x2, {_B}.y2) > 1.5)"


@R.query(
    "SELECT fragment_no, "
    + ", ".join(f"CASE WHEN {_PX} THEN {d} ELSE least(1.0, greatest(0.0, {f}({_B}.{a}1, {_B}.{a}2))) END AS {a}{n}" for a in "xy" for n, f, d in (("1", "least", "0.0"), ("2", "greatest", "1.0")))
    + " FROM fragments"
)
def sane_boxes(spark: SparkSession, root: str) -> DataFrame:
    b = F.col("position.bbox")
    return table(spark, root, "fragments").select("fragment_no", *[sane(b, f"{a}{n}", f"{a}{3 - n}").alias(f"{a}{n}") for a in "xy" for n in (1, 2)])


@R.query(
    """SELECT request_id, count(*) AS files, string_agg(s3_fileid, ',' ORDER BY file_no) FILTER (WHERE outcome = 'accept') AS accepted, string_agg(s3_fileid, ',' ORDER BY file_no) FILTER (WHERE outcome = 'quarantine') AS quarantined,
      string_agg(s3_fileid, ',' ORDER BY file_no) FILTER (WHERE outcome = 'reject') AS rejected, bool_or(outcome = 'accept') AS forwarded FROM intake_files WHERE request_id IS NOT NULL GROUP BY request_id"""
)
def intake_buckets(spark: SparkSession, root: str) -> DataFrame:
    """The files of each request by outcome, in the order of arrival; a request's files are bounded by the intake's limit."""
    of = lambda o: F.expr(f"listagg(case when outcome = '{o}' then s3_fileid end, ',') within group (order by file_no)")
    df = table(spark, root, "intake_files").filter("request_id is not null")
    return df.groupBy("request_id").agg(F.count("*").alias("files"), of("accept").alias("accepted"), of("quarantine").alias("quarantined"), of("reject").alias("rejected"), F.bool_or(F.col("outcome") == "accept").alias("forwarded"))


@R.query(
    """SELECT s3_fileid, page, row_no, string_agg(text, ' | ' ORDER BY x1, line_id) AS cells, count(*) AS n FROM (SELECT *, sum(f) OVER (PARTITION BY s3_fileid, page ORDER BY cy, line_id)::BIGINT AS row_no FROM (
      SELECT *, CASE WHEN cy - lag(cy) OVER (PARTITION BY s3_fileid, page ORDER BY cy, line_id) <= 0.5 * m THEN 0 ELSE 1 END AS f FROM (
        SELECT line_id, s3_fileid, page, text, bbox.x1 AS x1, (bbox.y1 + bbox.y2) / 2 AS cy, median(bbox.y2 - bbox.y1) OVER (PARTITION BY s3_fileid, page) AS m FROM text_lines WHERE bbox IS NOT NULL AND method = 'text_layer'))) GROUP BY s3_fileid, page, row_no"""
)
def row_bands(spark: SparkSession, root: str) -> DataFrame:
    """Rows of a page: lines whose centres follow within half of the median height, their texts from left to right."""
    page = Window.partitionBy("s3_fileid", "page")
    df = table(spark, root, "text_lines").filter("bbox is not null and method = 'text_layer'")
    df = df.select("line_id", "s3_fileid", "page", "text", F.col("bbox.x1").alias("x1"), ((F.col("bbox.y1") + F.col("bbox.y2")) / 2).alias("cy"), F.median(F.col("bbox.y2") - F.col("bbox.y1")).over(page).alias("m"))
    order = page.orderBy("cy", "line_id")
    df = df.withColumn("f", F.when(F.col("cy") - F.lag("cy").over(order) <= 0.5 * F.col("m"), 0).otherwise(1)).withColumn("row_no", F.sum("f").over(order))
    return df.groupBy("s3_fileid", "page", "row_no").agg(F.expr("listagg(text, ' | ') within group (order by x1, line_id)").alias("cells"), F.count("*").alias("n"))


@R.query(
    r"""SELECT change_id, CASE WHEN n IS NULL THEN 'text' WHEN d IS NOT NULL THEN 'range' ELSE 'number' END AS kind, n AS number, n - d AS low, n + d AS high FROM (
      SELECT change_id, try_cast(replace(nullif(regexp_extract(before, '(\d+(?:,\d+)?)\D*$', 1), ''), ',', '.') AS DOUBLE) AS n, try_cast(replace(nullif(regexp_extract(before, '±\s?(\d+(?:,\d+)?)', 1), ''), ',', '.') AS DOUBLE) AS d FROM text_changes)"""
)
def field_values(spark: SparkSession, root: str) -> DataFrame:
    """The last number of an annotation with its tolerance as a range."""
    n = X.to_number(F.regexp_extract("before", r"(\d+(?:,\d+)?)\D*$", 1))
    d = X.to_number(F.regexp_replace(fields.tolerance(F.col("before")), "^±", ""))
    df = table(spark, root, "text_changes").select("change_id", n.alias("number"), d.alias("d"))
    kind = F.when(F.col("number").isNull(), "text").when(F.col("d").isNotNull(), "range").otherwise("number")
    return df.select("change_id", kind.alias("kind"), "number", (F.col("number") - F.col("d")).alias("low"), (F.col("number") + F.col("d")).alias("high"))


# Upper bounds of the timing histogram.
BOUNDS = (10.0, 25.0, 50.0, 100.0, 250.0, 500.0)


@R.query(
    f"""SELECT event_type, bucket, count(*) AS events FROM (SELECT event_type, CASE {" ".join(f"WHEN value <= {b} THEN {b}" for b in BOUNDS)} ELSE 1e9 END AS bucket FROM events WHERE value IS NOT NULL) GROUP BY ALL"""
)
def value_histogram(spark: SparkSession, root: str) -> DataFrame:
    bucket = F.lit(1e9)
    for b in reversed(BOUNDS):
        bucket = F.when(F.col("value") <= b, F.lit(b)).otherwise(bucket)
    return table(spark, root, "events").filter("value is not null").groupBy("event_type", bucket.alias("bucket")).agg(F.count("*").alias("events"))


@R.query(
    """SELECT s3_fileid, trim(part) AS mark, count(*) AS n FROM (SELECT s3_fileid, unnest(string_split(replace(coalesce(section_title, ''), ',', ';'), ';')) AS part FROM fragments) WHERE trim(part) <> '' GROUP BY ALL"""
)
def section_marks(spark: SparkSession, root: str) -> DataFrame:
    parts = F.transform(F.split(F.translate(F.coalesce("section_title", F.lit("")), ",", ";"), ";"), F.trim)
    return table(spark, root, "fragments").select("s3_fileid", F.explode(parts).alias("mark")).filter("mark <> ''").groupBy("s3_fileid", "mark").agg(F.count("*").alias("n"))
