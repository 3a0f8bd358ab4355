"""Queries on the finished record: fragments in contract order, parts and their contiguity, quality, annotations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sheafline.functions import hashes as H
from sheafline.functions import texts as X
from sheafline.operators import fields, ranks, sheets
from sheafline.plans import documents
from sheafline.plans.documents import _BASE, _LATEST, _SIGN, _UNITS, latest, signature
from sheafline.plans.geometry import _KINDS
from sheafline.plans.registry import Registry
from sheafline.session import table

R = Registry()

_RECORD = """concat_ws(chr(10), CASE WHEN trim(section_title) <> '' THEN 'section: ' || section_title END, CASE WHEN trim(text) <> '' THEN 'text: ' || text END, CASE WHEN trim(formula) <> '' THEN 'formula: ' || formula END,
      CASE WHEN trim(structured_payload.table_html) <> '' THEN 'table: ' || structured_payload.table_html END)"""
_CLEAN = "regexp_replace(replace(text, chr(0), ''), '[øØ∅] ?([0-9])', '⌀\\1', 'g')"
_ORDER = "coalesce(position.page, 0)::BIGINT * 1000000000 + coalesce(position.\"order\", 0)"


@R.query(
    rf"""WITH c AS (SELECT * REPLACE ({_CLEAN} AS text) FROM {_LATEST}), k AS (SELECT * FROM c WHERE NOT (fragment_type = 'text' AND trim(coalesce(text, '')) = '')),
      b AS (SELECT fragment_no, s3_fileid, {_ORDER} AS ord, completeness, {_BASE} AS base, {_RECORD} AS record, len(regexp_extract_all(coalesce(text, ''), '\d+(?:,\d+)? (?:{_UNITS})')) AS facts FROM k)
    SELECT fragment_no, CASE WHEN n = 1 THEN base ELSE base || '-' || n END AS stable_id, place, completeness IS NULL OR completeness < 0.5 AS needs_review, facts::INTEGER AS facts, sha256(record) AS record_hash FROM (
      SELECT *, row_number() OVER (PARTITION BY base ORDER BY fragment_no) AS n, dense_rank() OVER (PARTITION BY s3_fileid ORDER BY ord) AS place FROM b)"""
)
def finished_fragments(spark: SparkSession, root: str) -> DataFrame:
    """The last delivered fragments in the contract's order of steps: signs that are no characters dropped, dimensions repaired, empty texts left out, then quality, id, place, facts, record."""
    df = latest(table(spark, root, "fragments")).withColumn("text", F.regexp_replace(F.translate("text", "\x00", ""), r"[øØ∅] ?([0-9])", "⌀$1"))
    df = df.filter(~((F.col("fragment_type") == "text") & (F.trim(F.coalesce("text", F.lit(""))) == "")))
    parts = [("section", F.col("section_title")), ("text", F.col("text")), ("formula", F.col("formula")), ("table", F.col("structured_payload.table_html"))]
    base = H.fragment_base(F.col("s3_fileid"), F.col("position.page"), F.col("fragment_type"), signature())
    order = F.coalesce("position.page", F.lit(0)).cast("long") * 1_000_000_000 + F.coalesce("position.order", F.lit(0))
    facts = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(rf"\d+(?:,\d+)? (?:{_UNITS})"))
    review = F.col("completeness").isNull() | (F.col("completeness") < 0.5)
    done = df.select("fragment_no", "s3_fileid", order.alias("ord"), base.alias("base"), review.alias("needs_review"), facts.alias("facts"), F.sha2(sheets.record_text(parts), 256).alias("record_hash"))
    # the places of a file: its distinct orders, numbered over stretches of pages
    places = ranks.numbered(done.select("s3_fileid", "ord").distinct(), "s3_fileid", "ord", "place", width=100_000_000_000)
    done = ranks.numbered(done, "base", "fragment_no").join(places, ["s3_fileid", "ord"])
    return done.select("fragment_no", F.when(F.col("n") == 1, F.col("base")).otherwise(F.concat_ws("-", "base", "n")).alias("stable_id"), "place", "needs_review", "facts", "record_hash")


_PIECES = f"""(SELECT DISTINCT s.source_unit_id AS source_unit_id, s.char_start AS a, s.char_end AS b FROM (SELECT unnest(position.source_spans) AS s FROM {_LATEST}) WHERE s.source_unit_id IS NOT NULL)"""


@R.query(
    f"""SELECT source_unit_id, part::INTEGER AS part, a AS char_start, b AS char_end, coalesce(a <= top, a = 0) AS contiguous FROM (
      SELECT *, row_number() OVER w AS part, max(b) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM {_PIECES} WINDOW w AS (PARTITION BY source_unit_id ORDER BY a, b))"""
)
def part_index(spark: SparkSession, root: str) -> DataFrame:
    """The stored parts of each source unit in order, and whether each begins where the ones before it end, or earlier."""
    spans = latest(table(spark, root, "fragments")).select(F.explode("position.source_spans").alias("s")).select("s.source_unit_id", F.col("s.char_start").alias("char_start"), F.col("s.char_end").alias("char_end"))
    w = Window.partitionBy("source_unit_id").orderBy("char_start", "char_end")
    top = F.max("char_end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    df = spans.filter("source_unit_id is not null").distinct()
    return df.select("source_unit_id", F.row_number().over(w).alias("part"), "char_start", "char_end", F.coalesce(F.col("char_start") <= top, F.col("char_start") == 0).alias("contiguous"))


@R.query(
    f"""SELECT fragment_no, CASE WHEN confidence >= 0.95 THEN 'confirmed' WHEN completeness IS NULL OR completeness < 0.5 THEN 'review' WHEN confidence IS NULL THEN 'unknown' ELSE 'read' END AS state,
      array_to_string(list_filter(['no_place', 'low_confidence', 'incomplete', 'unknown_completeness'], lambda x: CASE x WHEN 'no_place' THEN position.bbox IS NULL WHEN 'low_confidence' THEN coalesce(confidence < 0.5, FALSE) WHEN 'incomplete' THEN coalesce(completeness < 0.5, FALSE) ELSE completeness IS NULL END), ',') AS flags
    FROM {_LATEST}"""
)
def fragment_quality(spark: SparkSession, root: str) -> DataFrame:
    """The state of each fragment and what speaks against it."""
    c, k = F.col("confidence"), F.col("completeness")
    state = F.when(c >= 0.95, "confirmed").when(k.isNull() | (k < 0.5), "review").when(c.isNull(), "unknown").otherwise("read")
    flags = F.concat_ws(",", F.when(F.col("position.bbox").isNull(), "no_place"), F.when(c < 0.5, "low_confidence"), F.when(k < 0.5, "incomplete"), F.when(k.isNull(), "unknown_completeness"))
    return latest(table(spark, root, "fragments")).select("fragment_no", state.alias("state"), flags.alias("flags"))


@R.query(
    f"""WITH s AS (SELECT s3_fileid, page, count(*) FILTER (WHERE method = 'tesseract') AS transcribed FROM text_lines WHERE page > 0 GROUP BY ALL), r AS (SELECT DISTINCT s3_fileid, position.page AS page FROM {_LATEST})
    SELECT s3_fileid, count(*) AS pages, count(r.page) AS read, count(*) FILTER (WHERE r.page IS NULL AND transcribed > 0) AS transcribed, count(*) FILTER (WHERE r.page IS NULL AND transcribed = 0) AS lost,
      CASE WHEN count(*) FILTER (WHERE r.page IS NULL AND transcribed = 0) = 0 THEN 'whole' WHEN count(r.page) = 0 THEN 'lost' ELSE 'partial' END AS state FROM s LEFT JOIN r USING (s3_fileid, page) GROUP BY s3_fileid"""
)
def document_quality(spark: SparkSession, root: str) -> DataFrame:
    """How whole a file's record is: pages without fragments are lost unless their lines were transcribed."""
    source = table(spark, root, "text_lines").filter("page > 0").groupBy("s3_fileid", "page").agg(F.count_if(F.col("method") == "tesseract").alias("n"))
    read = latest(table(spark, root, "fragments")).select("s3_fileid", F.col("position.page").alias("page")).distinct().withColumn("there", F.lit(True))
    df = source.join(read, ["s3_fileid", "page"], "left")
    gone = F.col("there").isNull()
    by = df.groupBy("s3_fileid").agg(F.count("*").alias("pages"), F.count("there").alias("read"), F.count_if(gone & (F.col("n") > 0)).alias("transcribed"), F.count_if(gone & (F.col("n") == 0)).alias("lost"))
    return by.withColumn("state", F.when(F.col("lost") == 0, "whole").when(F.col("read") == 0, "lost").otherwise("partial"))


@R.query(
    f"""SELECT change_id, CASE WHEN a <> 'note' THEN a ELSE b END AS kind, CASE WHEN a = b AND a <> 'note' THEN 0.9 WHEN a = 'note' AND b = 'note' THEN 0.5 WHEN a = 'note' OR b = 'note' THEN 0.75 ELSE 0.6 END::DOUBLE AS confidence
      FROM (SELECT x.change_id, a, b FROM (SELECT change_id, {_KINDS} AS a FROM (SELECT change_id, after AS t FROM text_changes)) x JOIN (SELECT change_id, {_KINDS} AS b FROM (SELECT change_id, before AS t FROM text_changes)) y USING (change_id))"""
)
def reconciled_kinds(spark: SparkSession, root: str) -> DataFrame:
    """Two readings of an annotation reconciled: agreement is surest, one that says nothing leaves the other, a conflict keeps the first with less confidence."""
    a, b = fields.kind(F.col("after")), fields.kind(F.col("before"))
    df = table(spark, root, "text_changes").select("change_id", a.alias("a"), b.alias("b"))
    sure = F.when((F.col("a") == F.col("b")) & (F.col("a") != "note"), 0.9).when((F.col("a") == "note") & (F.col("b") == "note"), 0.5).when((F.col("a") == "note") | (F.col("b") == "note"), 0.75).otherwise(0.6)
    return df.select("change_id", F.when(F.col("a") != "note", F.col("a")).otherwise(F.col("b")).alias("kind"), sure.alias("confidence"))


#: Words of a field schema that a model repeats instead of reading.
SCHEMA_WORDS = ("text", "value", "category", "bbox", "confidence", "unit", "null", "none", "string")
_BOX = r"\[?[0-9]+([.][0-9]+)?([,;] *[0-9]+([.][0-9]+)?){3}\]?"


@R.query(f"SELECT change_id, CASE WHEN trim(before) = '' THEN 'empty' WHEN lower(trim(before)) IN ({', '.join(repr(w) for w in SCHEMA_WORDS)}) THEN 'schema' WHEN regexp_full_match(trim(before), '{_BOX}') THEN 'box' END AS fault FROM text_changes WHERE before IS NOT NULL")
def annotation_faults(spark: SparkSession, root: str) -> DataFrame:
    """What makes a text no annotation: nothing in it, a word of the schema, or the numbers of a box."""
    t = F.trim("before")
    fault = F.when(t == "", "empty").when(F.lower(t).isin(*SCHEMA_WORDS), "schema").when(t.rlike(rf"\A{_BOX}\z"), "box")
    return table(spark, root, "text_changes").filter("before is not null").select("change_id", fault.alias("fault"))


#: How steel grades are written.
GRADES = r"[0-9]{2}[ХГНМСТЮФ][0-9]{0,2}[А-Я0-9]*|Ст ?[0-9](?:кп|пс|сп)?|[Сс]таль [0-9]{2}"


@R.query(
    f"""SELECT change_id, len(m)::INTEGER AS grades, list_reduce(list_prepend(t, m), lambda a, x: replace(a, x, repeat('#', length(x)))) AS masked FROM (SELECT change_id, before AS t, regexp_extract_all(before, '{GRADES}') AS m FROM text_changes WHERE before IS NOT NULL)"""
)
def masked_grades(spark: SparkSession, root: str) -> DataFrame:
    """Steel grades masked by as many signs, so that places in the text stay."""
    grades = F.regexp_extract_all("before", F.lit(GRADES), F.lit(0))
    masked = F.aggregate(grades, F.col("before"), lambda a, x: F.replace(a, x, F.repeat(F.lit("#"), F.length(x))))
    return table(spark, root, "text_changes").filter("before is not null").select("change_id", F.size(grades).alias("grades"), masked.alias("masked"))


def sign_key() -> Column:
    return X.sign_key(F.col("text"))


_KEY = r"regexp_replace(translate(lower(text), '⌀ø∅,−–—', 'ooo.---'), '[ \t\n\x0b\f\r]+', '', 'g')"


@R.query(
    f"""WITH t AS (SELECT s3_fileid, {_KEY} AS k, min(text) AS adopted FROM text_lines WHERE method = 'text_layer' AND trim(text) <> '' GROUP BY ALL)
    SELECT line_id, adopted FROM (SELECT line_id, s3_fileid, text, {_KEY} AS k FROM text_lines WHERE method = 'tesseract' AND trim(text) <> '') l JOIN t USING (s3_fileid, k) WHERE l.text <> t.adopted"""
)
def adopted_signs(spark: SparkSession, root: str) -> DataFrame:
    """Recognised lines that differ from a transcript line of the file in signs only take the transcript's."""
    lines = table(spark, root, "text_lines").filter("trim(text) <> ''").select("line_id", "s3_fileid", "method", "text", sign_key().alias("k"))
    # each distinct key once, so a line that recurs through a file meets one row
    said = lines.filter("method = 'text_layer'").groupBy("s3_fileid", "k").agg(F.min("text").alias("adopted"))
    return lines.filter("method = 'tesseract'").join(said, ["s3_fileid", "k"]).filter("text <> adopted").select("line_id", "adopted")


@R.query(
    """WITH l AS (SELECT line_id, s3_fileid, page, lower(trim(text)) AS t, (bbox.x1 + bbox.x2) / 2 AS x, (bbox.y1 + bbox.y2) / 2 AS y FROM text_lines WHERE bbox IS NOT NULL AND trim(text) <> '')
    SELECT line_id FROM l WHERE NOT EXISTS (SELECT 1 FROM l o WHERE o.s3_fileid = l.s3_fileid AND o.page = l.page AND o.t = l.t AND o.line_id < l.line_id AND abs(o.x - l.x) < 0.05 AND abs(o.y - l.y) < 0.05)"""
)
def merged_annotations(spark: SparkSession, root: str) -> DataFrame:
    """Annotations of overlapping tiles: of equal texts closer than 0.05 on a page the first stays."""
    mid = lambda k: (F.col(f"bbox.{k}1") + F.col(f"bbox.{k}2")) / 2
    df = table(spark, root, "text_lines").filter("bbox is not null and trim(text) <> ''").select("line_id", "s3_fileid", "page", F.lower(F.trim("text")).alias("t"), mid("x").alias("x"), mid("y").alias("y"))
    a, b = df.alias("a"), df.alias("b")
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("s3_fileid", "page", "t")]
    near = (F.abs(F.col("a.x") - F.col("b.x")) < 0.05) & (F.abs(F.col("a.y") - F.col("b.y")) < 0.05)
    return a.join(b, same[0] & same[1] & same[2] & (F.col("b.line_id") < F.col("a.line_id")) & near, "left_anti").select("line_id")


@R.query(
    """SELECT s3_fileid, page, row_y, segment::INTEGER AS segment, min(x1) AS x1, max(x2) AS x2, count(*) AS lines FROM (SELECT *, sum(f) OVER (PARTITION BY s3_fileid, page, row_y ORDER BY x1, line_id) AS segment FROM (
      SELECT *, CASE WHEN x1 - max(x2) OVER (PARTITION BY s3_fileid, page, row_y ORDER BY x1, line_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) <= 0.02 THEN 0 ELSE 1 END AS f FROM (
        SELECT line_id, s3_fileid, page, floor(bbox.y1 * 100)::INTEGER AS row_y, bbox.x1 AS x1, bbox.x2 AS x2 FROM text_lines WHERE bbox IS NOT NULL))) GROUP BY ALL"""
)
def row_segments(spark: SparkSession, root: str) -> DataFrame:
    """Lines of one row of a page joined, and split where the gap between them is wide."""
    df = table(spark, root, "text_lines").filter("bbox is not null").select("line_id", "s3_fileid", "page", F.floor(F.col("bbox.y1") * 100).cast("int").alias("row_y"), F.col("bbox.x1").alias("x1"), F.col("bbox.x2").alias("x2"))
    w = Window.partitionBy("s3_fileid", "page", "row_y").orderBy("x1", "line_id")
    reach = F.max("x2").over(w.rowsBetween(Window.unboundedPreceding, -1))
    df = df.withColumn("f", F.when(F.col("x1") - reach <= 0.02, 0).otherwise(1)).withColumn("segment", F.sum("f").over(w).cast("int"))
    return df.groupBy("s3_fileid", "page", "row_y", "segment").agg(F.min("x1").alias("x1"), F.max("x2").alias("x2"), F.count("*").alias("lines"))


@R.query(
    """WITH l AS (SELECT s3_fileid, page, lower(regexp_extract(text, '^[ ]*([\\p{L}][\\p{L} .]+):', 1)) AS label, trim(regexp_extract(text, '^[ ]*[\\p{L}][\\p{L} .]+:(.*)$', 1)) AS value, bbox.x1 >= 0.5 AND bbox.y1 >= 0.7 AS stamp, line_id FROM text_lines)
    SELECT s3_fileid, page, label, arg_min(value, (NOT coalesce(stamp, FALSE), line_id)) AS value, count(*) AS seen, coalesce(bool_or(stamp), FALSE) AS from_stamp FROM l WHERE label <> '' AND value <> '' GROUP BY ALL"""
)
def merged_title_fields(spark: SparkSession, root: str) -> DataFrame:
    """Labelled values of a sheet: those of the title block (bottom right) win over those elsewhere."""
    df = table(spark, root, "text_lines").select(
        "s3_fileid", "page", "line_id", F.lower(F.regexp_extract("text", "^[ ]*([\\p{L}][\\p{L} .]+):", 1)).alias("label"), F.trim(F.regexp_extract("text", "^[ ]*[\\p{L}][\\p{L} .]+:(.*)$", 1)).alias("value"),
        F.coalesce((F.col("bbox.x1") >= 0.5) & (F.col("bbox.y1") >= 0.7), F.lit(False)).alias("stamp"),
    )
    own = df.filter("label <> '' and value <> ''")
    return own.groupBy("s3_fileid", "page", "label").agg(F.min_by("value", F.struct(~F.col("stamp"), F.col("line_id"))).alias("value"), F.count("*").alias("seen"), F.max("stamp").alias("from_stamp"))


@R.query(
    f"""WITH l AS (SELECT s3_fileid, position.page AS page, length(text) AS n, confidence, coalesce(method, '?') AS method, position.bbox AS b FROM {_LATEST} WHERE fragment_type = 'text' AND length(text) > 0),
      m AS (SELECT s3_fileid, page, method, sum(n) AS chars FROM l GROUP BY ALL)
    SELECT l.s3_fileid, l.page, count(*) AS fragments, sum(n)::BIGINT AS chars, round(sum(confidence * n) / sum(n) FILTER (WHERE confidence IS NOT NULL), 6) AS confidence, any_value(k.method) AS method, min(b.x1) AS x1, min(b.y1) AS y1, max(b.x2) AS x2, max(b.y2) AS y2
    FROM l JOIN (SELECT s3_fileid, page, arg_max(method, row(chars, method)) AS method FROM m GROUP BY ALL) k ON k.s3_fileid = l.s3_fileid AND k.page IS NOT DISTINCT FROM l.page GROUP BY l.s3_fileid, l.page"""
)
def chunk_profiles(spark: SparkSession, root: str) -> DataFrame:
    """A page's texts as one chunk: confidence weighted by length, the method that gave most characters, the union of the boxes."""
    df = latest(table(spark, root, "fragments")).filter("fragment_type = 'text' and length(text) > 0").select("s3_fileid", F.col("position.page").alias("page"), F.length("text").alias("n"), "confidence", F.coalesce("method", F.lit("?")).alias("method"), F.col("position.bbox").alias("b"))
    # by method first: the second aggregation sees few rows
    sums = [F.count("*").alias("fragments"), F.sum("n").alias("chars"), F.sum(F.col("confidence") * F.col("n")).alias("s"), F.sum(F.when(F.col("confidence").isNotNull(), F.col("n"))).alias("w"), F.min("b.x1").alias("x1"), F.min("b.y1").alias("y1"), F.max("b.x2").alias("x2"), F.max("b.y2").alias("y2")]
    by = df.groupBy("s3_fileid", "page", "method").agg(*sums)
    out = by.groupBy("s3_fileid", "page").agg(
        F.sum("fragments").alias("fragments"), F.round(F.sum("s") / F.sum("w"), 6).alias("confidence"), F.max_by("method", F.struct("chars", "method")).alias("method"), F.sum("chars").alias("chars"), F.min("x1").alias("x1"), F.min("y1").alias("y1"), F.max("x2").alias("x2"), F.max("y2").alias("y2")
    )
    return out.select("s3_fileid", "page", "fragments", "chars", "confidence", "method", "x1", "y1", "x2", "y2")


_RECALL, _COVER = documents.R.sql["layer_recall"], documents.R.sql["page_coverage"]


@R.query(f"SELECT c.s3_fileid, c.page, coalesce(r.recall, c.coverage)::DOUBLE AS completeness, CASE WHEN r.recall IS NULL THEN 'coverage' ELSE 'recall' END AS measure FROM ({_COVER}) c LEFT JOIN ({_RECALL}) r ON r.s3_fileid = c.s3_fileid AND r.page = c.page")
def text_completeness(spark: SparkSession, root: str) -> DataFrame:
    """How complete a page's text is: measured against its text layer where it has one, else by the area that its blocks cover."""
    cover, recall = documents.page_coverage(spark, root).select("s3_fileid", "page", "coverage"), documents.layer_recall(spark, root).select("s3_fileid", "page", "recall")
    df = cover.join(recall, ["s3_fileid", "page"], "left")
    return df.select("s3_fileid", "page", F.coalesce("recall", "coverage").alias("completeness"), F.when(F.col("recall").isNull(), "coverage").otherwise("recall").alias("measure"))


@R.query(
    f"""SELECT fragment_no, coalesce(len(position.source_spans), 0)::INTEGER AS spans, coalesce(len(list_distinct(list_transform(position.source_spans, lambda s: s.source_unit_id))), 0)::INTEGER AS units,
      array_to_string(list_filter(['no_source', 'inexact', 'unordered', 'empty_span'], lambda w: CASE w WHEN 'no_source' THEN coalesce(len(position.source_spans), 0) = 0 WHEN 'inexact' THEN coalesce(NOT position.text_offsets_exact, FALSE)
        WHEN 'unordered' THEN coalesce(len(list_filter(position.source_spans, lambda s: s.char_end < s.char_start)), 0) > 0 ELSE coalesce(len(list_filter(position.source_spans, lambda s: s.char_end = s.char_start)), 0) > 0 END), ',') AS warnings
    FROM {_LATEST}"""
)
def attached_sources(spark: SparkSession, root: str) -> DataFrame:
    """What each fragment says about its sources, and what is to be said against it."""
    spans = F.coalesce("position.source_spans", F.array().cast(dict(table(spark, root, "fragments").select("position.source_spans").dtypes)["source_spans"]))
    has = lambda c: F.exists("s", c)
    df = latest(table(spark, root, "fragments")).select("fragment_no", spans.alias("s"), F.col("position.text_offsets_exact").alias("exact"))
    warnings = F.concat_ws(",", F.when(F.size("s") == 0, "no_source"), F.when(~F.col("exact"), "inexact"), F.when(has(lambda x: x["char_end"] < x["char_start"]), "unordered"), F.when(has(lambda x: x["char_end"] == x["char_start"]), "empty_span"))
    units = F.size(F.array_distinct(F.filter(F.transform("s", lambda x: x["source_unit_id"]), lambda u: u.isNotNull())))
    return df.select("fragment_no", F.size("s").alias("spans"), units.alias("units"), warnings.alias("warnings"))
