"""Queries of the text operators over the whole tables of a folder, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafline.llm import dedup, leakage, lookalikes, markup, packing, reading, scans, splitting
from sheafline.session import spread, table

Query = Callable[[SparkSession, str], DataFrame]


def p1_found(spark: SparkSession, root: str) -> DataFrame:
    return markup.found(spread(table(spark, root, "documents").select("doc_id", "text")), table(spark, root, "fragments"))


def p1_clean(spark: SparkSession, root: str) -> DataFrame:
    """Every document's clean text and how many blocks of each role it has."""
    docs = markup.clean_markup(spread(table(spark, root, "documents").select("doc_id", "text")))
    of = lambda role: F.size(F.filter("markup.blocks", lambda b: b["role"] == role))
    return docs.select("doc_id", F.col("markup.clean").alias("clean"), of("heading").alias("headings"), of("item").alias("items"), of("code").alias("codes"), of("formula").alias("formulas"), of("row").alias("table_rows"))


def p2_found(spark: SparkSession, root: str) -> DataFrame:
    return dedup.found(table(spark, root, "intake_files"))


def p2_last_batch(spark: SparkSession, root: str) -> DataFrame:
    return dedup.last_batch(table(spark, root, "intake_files"))


def p3_found(spark: SparkSession, root: str) -> DataFrame:
    return splitting.found(table(spark, root, "source_units"), table(spark, root, "fragments"), table(spark, root, "size_limits"))


def p3_pieces(spark: SparkSession, root: str) -> DataFrame:
    return splitting.split_units(table(spark, root, "source_units"), table(spark, root, "size_limits"))


def p3_repaired(spark: SparkSession, root: str) -> DataFrame:
    return splitting.repaired(table(spark, root, "source_units"), table(spark, root, "fragments"), table(spark, root, "size_limits"))


def p4_found(spark: SparkSession, root: str) -> DataFrame:
    return lookalikes.found(table(spark, root, "text_lines"), table(spark, root, "text_changes"), table(spark, root, "word_list"))


def p4_forms(spark: SparkSession, root: str) -> DataFrame:
    """Every text-layer line in its one form."""
    lines = table(spark, root, "text_lines").filter("method = 'text_layer' and text is not null").select("line_id", "text")
    return lookalikes.one_form(lines, lookalikes.fit(lines, table(spark, root, "word_list"))).select("line_id", F.col("one.form").alias("form"))


def p5_found(spark: SparkSession, root: str) -> DataFrame:
    return scans.found(table(spark, root, "text_lines"), table(spark, root, "word_list"))


def p5_paragraphs(spark: SparkSession, root: str) -> DataFrame:
    return scans.paragraphs(table(spark, root, "text_lines"), table(spark, root, "word_list"))


def p6_found(spark: SparkSession, root: str) -> DataFrame:
    return packing.found(table(spark, root, "documents"), table(spark, root, "size_limits"))


def p6_pack(spark: SparkSession, root: str) -> DataFrame:
    return packing.pack(table(spark, root, "documents").select("doc_id", "text"), packing.profiles_of(table(spark, root, "size_limits")))


def p6_fill(spark: SparkSession, root: str) -> DataFrame:
    profiles = packing.profiles_of(table(spark, root, "size_limits"))
    return packing.fill_rates(packing.pack(table(spark, root, "documents").select("doc_id", "text"), profiles), profiles, spark)


def p7_found(spark: SparkSession, root: str) -> DataFrame:
    return leakage.found(spread(table(spark, root, "documents").select("doc_id", "text")), table(spark, root, "eval_items"))


def p7_aligned(spark: SparkSession, root: str) -> DataFrame:
    """Every document and item that share a seed, with the longest run, the alignment score and what it makes of the pair."""
    return leakage.aligned(spread(table(spark, root, "documents").select("doc_id", "text")), table(spark, root, "eval_items"))


def p8_found(spark: SparkSession, root: str) -> DataFrame:
    return reading.found(spread(table(spark, root, "documents").select("doc_id", "text")), table(spark, root, "doc_levels"))


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (p1_found, p1_clean, p2_found, p2_last_batch, p3_found, p3_pieces, p3_repaired, p4_found, p4_forms, p5_found, p5_paragraphs, p6_found, p6_pack, p6_fill, p7_found, p7_aligned, p8_found)
}

SQL: dict[str, str] = {
    # pieces of each unit in order, measured on their own text; what lies before a piece is what no earlier one reaches
    "p3_found": r"""
        WITH lim AS (SELECT profile, min(unit) AS unit, min(max_size) AS size, coalesce(min(overlap), 0) AS lap FROM size_limits GROUP BY profile),
          u AS (SELECT unit_no, source_unit_id, text, length(text) AS n, unit, size, lap FROM source_units JOIN lim USING (profile) WHERE unit_no IS NOT NULL AND text IS NOT NULL AND size >= 1),
          f AS (SELECT fragment_id, fragment_no, updated_at, unnest(position.source_spans) AS s FROM fragments),
          k AS (SELECT DISTINCT s.source_unit_id AS source_unit_id, fragment_id, s.char_start AS a, s.char_end AS b FROM (
            SELECT *, dense_rank() OVER (PARTITION BY s.source_unit_id, fragment_id ORDER BY updated_at DESC, fragment_no DESC) AS r FROM f) WHERE r = 1 AND s.char_start IS NOT NULL AND s.char_end IS NOT NULL),
          p AS (SELECT unit_no, text, n, unit, size, lap, greatest(0, least(a, n)) AS a, greatest(0, least(b, n)) AS b FROM u JOIN k USING (source_unit_id)),
          o AS (SELECT *, coalesce(max(b) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS covered, lag(b) OVER w AS before, max(b) OVER (PARTITION BY unit_no) AS top FROM p WINDOW w AS (PARTITION BY unit_no ORDER BY a, b)),
          t AS (SELECT *, a > covered AND regexp_matches(substring(text, covered + 1, a - covered), '[^\s\p{Z}\x{85}\x1c-\x1f]') AS gap, substring(text, a + 1, greatest(b - a, 0)) AS piece FROM o)
        SELECT unit_no, 'unsplit' AS defect FROM u WHERE source_unit_id NOT IN (SELECT source_unit_id FROM k) AND CASE unit WHEN 'tokens' THEN len(regexp_extract_all(text, '\p{L}+|\p{N}+|[^\s\p{Z}\p{L}\p{N}]')) ELSE n END > size
        UNION SELECT unit_no, 'over' FROM t WHERE b > a AND CASE unit WHEN 'tokens' THEN len(regexp_extract_all(piece, '\p{L}+|\p{N}+|[^\s\p{Z}\p{L}\p{N}]')) ELSE b - a END > size
        UNION SELECT unit_no, 'gap' FROM t WHERE gap OR regexp_matches(substring(text, top + 1), '[^\s\p{Z}\x{85}\x1c-\x1f]')
        UNION SELECT unit_no, 'overlap' FROM t WHERE NOT gap AND before IS NOT NULL AND (a >= before OR a < before - lap)
        UNION SELECT unit_no, 'midword' FROM t WHERE b > 0 AND b < n AND regexp_matches(substring(text, b, 1), '\p{L}') AND regexp_matches(substring(text, b + 1, 1), '\p{L}')
          AND regexp_matches(substring(text, greatest(a, b - 120) + 1, b - greatest(a, b - 120)), '[\s\p{Z}\x{85}\x1c-\x1f]')
    """,
    "p6_found": r"""
        SELECT l.profile AS profile, d.doc_id AS doc_id
        FROM (SELECT doc_id, len(regexp_extract_all(text, '\p{L}+|\p{N}+|[^\s\p{Z}\p{L}\p{N}]')) AS n FROM documents) d
        JOIN (SELECT profile, min(max_size) AS cap FROM size_limits WHERE unit = 'tokens' GROUP BY profile) l ON d.n > l.cap
        GROUP BY l.profile, d.doc_id
    """,
}
