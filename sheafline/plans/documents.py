"""Queries on fragments and documents: runs, completeness, ids, tables, formulas, numbers, text quality, chunks, facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafline.functions import hashes as H
from sheafline.functions import texts as X
from sheafline.functions import units as U
from sheafline.functions.files import lookup
from sheafline.operators import chunking, facts, parts, ranks, tables
from sheafline.plans.registry import Registry
from sheafline.session import spread, table

R = Registry()


def latest(fragments: DataFrame) -> DataFrame:
    """One row a fragment_id: the last delivered. The aggregation keeps only a row number, the row itself joins back on it."""
    last = fragments.groupBy("fragment_id").agg(F.max_by("fragment_no", F.struct("updated_at", "fragment_no")).alias("fragment_no"))
    return fragments.join(last.select("fragment_no"), "fragment_no", "left_semi")


_LATEST = "(SELECT * FROM fragments WHERE fragment_no IN (SELECT fragment_no FROM (SELECT fragment_no, row_number() OVER (PARTITION BY fragment_id ORDER BY updated_at DESC, fragment_no DESC) r FROM fragments) WHERE r = 1))"


@R.query(f"SELECT fragment_no, fragment_id, fragment_type, position.page AS page, updated_at AT TIME ZONE 'UTC' AS updated_at FROM {_LATEST}")
def latest_fragments(spark: SparkSession, root: str) -> DataFrame:
    return latest(table(spark, root, "fragments")).select("fragment_no", "fragment_id", "fragment_type", F.col("position.page").alias("page"), "updated_at")


@R.query(
    f"""SELECT s3_fileid, run, min(fragment_type) AS fragment_type, count(*) AS fragments, min(ord) AS first_order, max(ord) AS last_order FROM (
      SELECT *, sum(fresh) OVER (PARTITION BY s3_fileid ORDER BY ord, fragment_no)::BIGINT AS run FROM (
        SELECT fragment_no, s3_fileid, fragment_type, position."order" AS ord,
          CASE WHEN lag(fragment_type) OVER w = fragment_type AND lag(position.page) OVER w IS NOT DISTINCT FROM position.page THEN 0 ELSE 1 END AS fresh
        FROM {_LATEST} WINDOW w AS (PARTITION BY s3_fileid ORDER BY position."order", fragment_no))) GROUP BY s3_fileid, run"""
)
def fragment_runs(spark: SparkSession, root: str) -> DataFrame:
    """Consecutive fragments of one type on one page (gaps and islands)."""
    # the order within a file and the fragment's number as one whole number; rows without an order come last, as in the SQL
    place = F.coalesce(F.col("position.order").cast("long"), F.lit((1 << 31) - 1)) * (1 << 32) + F.col("fragment_no")
    df = latest(table(spark, root, "fragments")).select("s3_fileid", place.alias("place"), "fragment_type", F.col("position.page").alias("page"))
    runs = ranks.runs(df, "s3_fileid", "place", ["fragment_type", "page"], width=1 << 40)
    order = lambda c: F.nullif(F.shiftright(c, 32).cast("int"), F.lit((1 << 31) - 1))
    return runs.select("s3_fileid", "run", "fragment_type", F.col("rows").alias("fragments"), order("first_order").alias("first_order"), order("last_order").alias("last_order"))


@R.query(
    r"""SELECT doc_id, line_no, line FROM (SELECT *, split_part(t, ' ', 1) AS a, split_part(t, ' ', 2) AS b FROM (SELECT doc_id, line_no, line, trim(line) AS t FROM (
      SELECT doc_id, unnest(generate_series(1, len(l))) AS line_no, unnest(l) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))))
    WHERE length(t) BETWEEN 1 AND 200 AND (
      regexp_matches(a, '^[0-9][0-9.]*$') AND regexp_matches(b, '^\p{Lu}')
      OR lower(a) IN ('глава', 'раздел', 'приложение', 'chapter', 'section', 'appendix') AND length(t) > length(a)
      OR length(t) > 3 AND regexp_full_match(t, '[\p{Lu}\p{Nd} .,-]+') AND regexp_matches(t, '\p{Lu}')
      OR t LIKE '%:' AND length(t) BETWEEN 4 AND 81 AND NOT regexp_matches(t, '[.!?]'))"""
)
def heading_lines(spark: SparkSession, root: str) -> DataFrame:
    lines = table(spark, root, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("p", "line"))
    return lines.filter(X.is_header(F.col("line"))).select("doc_id", (F.col("p") + 1).cast("long").alias("line_no"), "line")


@R.query(
    f"""SELECT s3_fileid, position.page AS page, count(*) AS fragments, count(position.bbox) AS placed,
      round(CASE WHEN count(position.bbox) FILTER (WHERE NOT (position.bbox.x1 = 0 AND position.bbox.y1 = 0 AND position.bbox.x2 = 1 AND position.bbox.y2 = 1)) = 0 THEN 0.9
        ELSE least(1.0, sum(abs(position.bbox.x2 - position.bbox.x1) * abs(position.bbox.y2 - position.bbox.y1))) END, 3) AS coverage,
      min(position.bbox.x1) AS x1, min(position.bbox.y1) AS y1, max(position.bbox.x2) AS x2, max(position.bbox.y2) AS y2
    FROM {_LATEST} GROUP BY s3_fileid, position.page"""
)
def page_coverage(spark: SparkSession, root: str) -> DataFrame:
    """The share of each page that its fragments cover, 0.9 where no place is known, and the union of their boxes."""
    b = F.col("position.bbox")
    known = b.isNotNull() & ~((b["x1"] == 0) & (b["y1"] == 0) & (b["x2"] == 1) & (b["y2"] == 1))
    area = F.abs(b["x2"] - b["x1"]) * F.abs(b["y2"] - b["y1"])
    cover = F.when(F.count_if(known) == 0, F.lit(0.9)).otherwise(F.least(F.lit(1.0), F.sum(area)))
    return latest(table(spark, root, "fragments")).groupBy("s3_fileid", F.col("position.page").alias("page")).agg(
        F.count("*").alias("fragments"), F.count(b).alias("placed"), F.round(cover, 3).alias("coverage"), F.min(b["x1"]).alias("x1"), F.min(b["y1"]).alias("y1"), F.max(b["x2"]).alias("x2"), F.max(b["y2"]).alias("y2")
    )


@R.query(
    """SELECT s3_fileid, page, round(least(1.0, coalesce(produced, 0) / expected), 3) AS recall, expected::BIGINT AS expected, coalesce(produced, 0)::BIGINT AS produced FROM
      (SELECT s3_fileid, page, sum(length(regexp_replace(text, '[\\s\\p{Z}\\x{85}]', '', 'g'))) AS expected FROM text_lines WHERE method = 'text_layer' GROUP BY ALL HAVING expected > 0)
      LEFT JOIN (SELECT s3_fileid, position.page AS page, sum(length(regexp_replace(coalesce(text, ''), '[\\s\\p{Z}\\x{85}]', '', 'g'))) AS produced FROM fragments GROUP BY ALL) USING (s3_fileid, page)"""
)
def layer_recall(spark: SparkSession, root: str) -> DataFrame:
    """How much of a page's text layer reached its fragments."""
    lines = table(spark, root, "text_lines").filter("method = 'text_layer'").groupBy("s3_fileid", "page").agg(F.sum(X.nonspace_chars(F.col("text"))).alias("expected")).filter("expected > 0")
    made = table(spark, root, "fragments").groupBy("s3_fileid", F.col("position.page").alias("page")).agg(F.sum(X.nonspace_chars(F.col("text"))).alias("produced"))
    both = lines.join(made, ["s3_fileid", "page"], "left").withColumn("produced", F.coalesce("produced", F.lit(0)))
    return both.select("s3_fileid", "page", F.round(F.least(F.lit(1.0), F.col("produced") / F.col("expected")), 3).alias("recall"), "expected", "produced")


# what stands behind each cell's opening, up to the next cell, row or end
_CELLS = "list_transform(string_split_regex(structured_payload.table_html, '(?i)<t[dh]\\b[^>]*>')[2:], lambda x: regexp_replace(x, '(?is)</?(?:t[dhr]|thead|tbody|tfoot|table)\\b.*$', ''))"


@R.query(
    f"""SELECT fragment_no, len(c)::INTEGER AS cells, f::INTEGER AS filled, round(CASE WHEN len(c) = 0 THEN 0.0 WHEN NOT regexp_matches(h, '(?i)<td\\b') THEN CASE WHEN f > 0 THEN 0.5 ELSE 0.0 END ELSE f / len(c) END, 3) AS completeness
      FROM (SELECT *, len(list_filter(c, lambda x: trim(regexp_replace(x, '(?s)<!--.*?-->|</?[A-Za-z][^>]*>', '', 'g')) <> '')) AS f FROM (SELECT fragment_no, structured_payload.table_html AS h, {_CELLS} AS c FROM fragments WHERE structured_payload.table_html IS NOT NULL))"""
)
def table_completeness(spark: SparkSession, root: str) -> DataFrame:
    """Filled cells of all cells, the text inside a cell's inner tags counted; a table of filled header cells only is half complete."""
    return table(spark, root, "fragments").filter("structured_payload.table_html is not null").select("fragment_no", *tables.completeness(F.col("structured_payload.table_html")))


@R.query()
def table_grids(spark: SparkSession, root: str) -> DataFrame:
    """HTML tables as headers and rows of equal width, spans repeated."""
    return tables.grids(table(spark, root, "fragments").select("fragment_no", F.col("structured_payload.table_html").alias("table_html")), "table_html")


@R.query(
    r"""SELECT fragment_no, nullif(regexp_extract(f, p, 1), '') AS base_var, nullif(trim(regexp_extract(f, p, 2)), '') AS expression,
      CAST(CASE WHEN trim(f) = '' THEN 0.0 WHEN regexp_extract(f, p, 1) <> '' THEN 0.7 ELSE 0.5 END AS DOUBLE) AS completeness
    FROM (SELECT fragment_no, replace(formula, chr(10), ' ') AS f, '^\s*([A-Za-zА-Яа-яΑ-ω][A-Za-z0-9_\\{}]*)\s*=\s*(.+)$' AS p FROM fragments WHERE formula IS NOT NULL)"""
)
def formula_parts(spark: SparkSession, root: str) -> DataFrame:
    df = table(spark, root, "fragments").filter("formula is not null").withColumn("a", X.assignment(F.col("formula")))
    full = F.when(F.trim("formula") == "", 0.0).when(F.col("a.base_var").isNotNull(), 0.7).otherwise(0.5)
    return df.select("fragment_no", "a.base_var", "a.expression", full.alias("completeness"))


# How a fragment's method is named to consumers, and the level of its strategy.
METHODS = {"cad_source": ("cad_source", 1), "text_layer": ("text_layer_extraction", 2), "text_layer_recovered": ("text_layer_extraction", 2), "office_extraction": ("office_extraction", 2), "plain_text": ("plain_text_extraction", 2), "tabular_extraction": ("tabular_extraction", 3), "tesseract": ("tesseract", 4), "ocr_layer": ("ocr_layer", 5), "ocr_layer_recovered": ("ocr_layer", 5), "mineru_ocr": ("mineru_ocr", 5), "mineru_table": ("mineru_table", 5), "mineru_formula": ("mineru_formula", 5), "mineru_image": ("mineru_image", 5), "restored_layout": ("restored_layout", 6), "vlm_escalation": ("vlm_escalation", 7), "vector_text_layer": ("vector_text_layer", 2)}
BY_KIND = {"text": "mineru_ocr", "table": "mineru_table", "formula": "mineru_formula", "image": "mineru_image", "drawing": "vector_text_layer"}
_METHOD = "coalesce(method, CASE fragment_type " + " ".join(f"WHEN '{k}' THEN '{m}'" for k, m in BY_KIND.items()) + " END)"


@R.query(
    f"""SELECT fragment_no, CASE m {" ".join(f"WHEN '{k}' THEN '{v[0]}'" for k, v in METHODS.items())} ELSE 'mineru_ocr' END AS label,
      CASE m {" ".join(f"WHEN '{k}' THEN {v[1]}" for k, v in METHODS.items())} ELSE 5 END AS level,
      (completeness IS NULL OR completeness < 0.5) AS needs_review FROM (SELECT *, {_METHOD} AS m FROM fragments)"""
)
def provenance(spark: SparkSession, root: str) -> DataFrame:
    m = F.coalesce("method", lookup(F.col("fragment_type"), BY_KIND))
    level = lookup(m, {k: str(v[1]) for k, v in METHODS.items()}, "5").cast("int")
    review = F.col("completeness").isNull() | (F.col("completeness") < 0.5)
    return table(spark, root, "fragments").select("fragment_no", lookup(m, {k: v[0] for k, v in METHODS.items()}, "mineru_ocr").alias("label"), level.alias("level"), review.alias("needs_review"))


_SIGN = r"CASE fragment_type WHEN 'text' THEN trim(regexp_replace(coalesce(text, ''), '[ \t\n\r\f\x0b]+', ' ', 'g')) WHEN 'formula' THEN coalesce(formula, '') WHEN 'table' THEN coalesce(structured_payload.table_html, '') ELSE '' END"


def signature() -> F.Column:
    t = F.col("fragment_type")
    return (
        F.when(t == "text", F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"[ \t\n\r\f\x0b]+", " ")))
        .when(t == "formula", F.coalesce("formula", F.lit("")))
        .when(t == "table", F.coalesce("structured_payload.table_html", F.lit("")))
        .otherwise("")
    )


_BASE = f"'doc-' || substr(sha256(s3_fileid), 1, 32) || ':p' || lpad(coalesce(position.page, 0)::VARCHAR, 3, '0') || ':' || fragment_type || ':' || substr(sha256({_SIGN}), 1, 12)"


@R.query(
    f"""SELECT fragment_no, CASE WHEN n = 1 THEN base ELSE base || '-' || n END AS stable_id FROM (
      SELECT fragment_no, base, row_number() OVER (PARTITION BY base ORDER BY fragment_no) AS n FROM (SELECT fragment_no, {_BASE} AS base FROM fragments))"""
)
def fragment_ids(spark: SparkSession, root: str) -> DataFrame:
    """Content-based ids; repeats are numbered in order of arrival."""
    df = table(spark, root, "fragments").select("fragment_no", H.fragment_base(F.col("s3_fileid"), F.col("position.page"), F.col("fragment_type"), signature()).alias("base"))
    return ranks.numbered(df, "base", "fragment_no").select("fragment_no", F.when(F.col("n") == 1, F.col("base")).otherwise(F.concat_ws("-", "base", "n")).alias("stable_id"))


@R.query(
    f"""SELECT s3_fileid, sha256(string_agg(sign || chr(30), '' ORDER BY ord, fragment_no)) AS content_hash, count(*) AS fragments
      FROM (SELECT s3_fileid, fragment_no, position."order" AS ord, {_SIGN} AS sign FROM {_LATEST}) GROUP BY s3_fileid"""
)
def normalized_hash(spark: SparkSession, root: str) -> DataFrame:
    """One hash of a file's content in reading order; a file's fragments are gathered as 16-byte keys and their signatures."""
    df = latest(table(spark, root, "fragments")).select("s3_fileid", "fragment_no", F.col("position.order").alias("ord"), signature().alias("sign"))
    gathered = df.groupBy("s3_fileid").agg(F.sort_array(F.collect_list(F.struct("ord", "fragment_no", "sign"))).alias("l"), F.count("*").alias("fragments"))
    joined = F.concat_ws("", F.transform("l", lambda x: F.concat(x["sign"], F.lit("\x1e"))))
    return gathered.select("s3_fileid", F.sha2(joined, 256).alias("content_hash"), "fragments")


@R.query(
    """WITH p AS (SELECT DISTINCT s3_fileid, position.page AS page FROM fragments WHERE position.page > 0),
      s AS (SELECT s3_fileid, max(page) AS last_page, count(*) AS pages FROM p GROUP BY 1),
      i AS (SELECT s3_fileid, min(page) AS a, max(page) AS b FROM (SELECT *, page - row_number() OVER (PARTITION BY s3_fileid ORDER BY page) AS g FROM p) GROUP BY s3_fileid, g)
    SELECT s.s3_fileid, pages, last_page, last_page - pages AS missing, r.ranges FROM s JOIN (SELECT s3_fileid, string_agg(CASE WHEN a = b THEN a::VARCHAR ELSE a || '-' || b END, ',' ORDER BY a) AS ranges FROM i GROUP BY 1) r USING (s3_fileid)"""
)
def page_report(spark: SparkSession, root: str) -> DataFrame:
    """Pages read and missing of each file, and the read ones as ranges such as 1-3,5."""
    pages = table(spark, root, "fragments").select("s3_fileid", F.col("position.page").alias("page")).filter("page > 0").distinct()
    g = F.col("page") - F.col("n")
    spans = ranks.numbered(pages, "s3_fileid", "page", width=1000).withColumn("g", g).groupBy("s3_fileid", "g").agg(F.min("page").alias("a"), F.max("page").alias("b"), F.count("*").alias("n"))
    text = F.when(F.col("a") == F.col("b"), F.col("a").cast("string")).otherwise(F.concat_ws("-", "a", "b"))
    by = spans.withColumn("t", text).groupBy("s3_fileid").agg(F.sum("n").alias("pages"), F.max("b").alias("last_page"), F.expr("listagg(t, ',') within group (order by a)").alias("ranges"))
    return by.select("s3_fileid", "pages", "last_page", (F.col("last_page") - F.col("pages")).alias("missing"), "ranges")


@R.query("SELECT DISTINCT r.id AS s3_fileid FROM (SELECT unnest(s3_fileid) AS id FROM parse_requests) r WHERE NOT EXISTS (SELECT 1 FROM fragments f WHERE f.s3_fileid = r.id)")
def not_indexed(spark: SparkSession, root: str) -> DataFrame:
    """Requested files that no fragment is there for: what a cache does not answer."""
    asked = table(spark, root, "parse_requests").select(F.explode("s3_fileid").alias("s3_fileid")).distinct()
    return asked.join(table(spark, root, "fragments").select("s3_fileid"), "s3_fileid", "left_anti")


@R.query(
    f"""SELECT s3_fileid, page, fragment_no FROM (SELECT s3_fileid, position.page AS page, fragment_no, row_number() OVER (PARTITION BY s3_fileid, position.page ORDER BY position."order", fragment_no) AS r
      FROM {_LATEST} WHERE fragment_type <> 'image') WHERE r = 1"""
)
def first_on_page(spark: SparkSession, root: str) -> DataFrame:
    df = latest(table(spark, root, "fragments")).filter("fragment_type <> 'image'")
    return df.groupBy("s3_fileid", F.col("position.page").alias("page")).agg(F.min_by("fragment_no", F.struct("position.order", "fragment_no")).alias("fragment_no"))


_UNITS = "МПа|MPa|мм|mm|°C|°С|%"


@R.query(
    rf"""SELECT doc_id, m.n AS nth, try_cast(replace(regexp_extract(m.t, '^(\d+(?:,\d+)?)', 1), ',', '.') AS DOUBLE) AS number,
      CASE lower(regexp_extract(m.t, '({_UNITS})$', 1)) WHEN 'мпа' THEN 'MPa' WHEN 'mpa' THEN 'MPa' WHEN 'мм' THEN 'mm' WHEN 'mm' THEN 'mm' WHEN '°c' THEN '°C' WHEN '°с' THEN '°C' ELSE '%' END AS unit
    FROM (SELECT doc_id, unnest(list_transform(generate_series(1, len(l)), lambda i: {{'n': i, 't': l[i]}})) AS m FROM (SELECT doc_id, regexp_extract_all(text, '\d+(?:,\d+)? (?:{_UNITS})') AS l FROM documents))"""
)
def numbers_with_units(spark: SparkSession, root: str) -> DataFrame:
    found = F.regexp_extract_all("text", F.lit(rf"\d+(?:,\d+)? (?:{_UNITS})"), F.lit(0))
    each = table(spark, root, "documents").select("doc_id", F.posexplode(found).alias("p", "t"))
    number = X.to_number(F.regexp_extract("t", r"^(\d+(?:,\d+)?)", 1))
    return each.select("doc_id", (F.col("p") + 1).cast("long").alias("nth"), number.alias("number"), U.canonical(F.regexp_extract("t", f"({_UNITS})$", 1)).alias("unit"))


@R.query(
    r"""SELECT doc_id, words::INTEGER AS words, mixed::INTEGER AS mixed, round(mixed / greatest(words, 1), 6) AS share, mixed > 0.12 * words AND chars >= 60 AS rescan FROM (
      SELECT doc_id, len(regexp_extract_all(text, '\p{L}+')) AS words, len(list_filter(regexp_extract_all(text, '\p{L}+'), lambda w: regexp_matches(w, '[a-zA-Z]') AND regexp_matches(w, '[а-яёА-ЯЁ]'))) AS mixed, length(text) AS chars FROM documents)"""
)
def corruption_share(spark: SparkSession, root: str) -> DataFrame:
    """Words of two alphabets among all words of a document."""
    words = F.regexp_extract_all("text", F.lit(r"\p{L}+"), F.lit(0))
    mixed = F.size(F.filter("w", lambda w: w.rlike("[a-zA-Z]") & w.rlike("[а-яёА-ЯЁ]")))
    df = table(spark, root, "documents").select("doc_id", words.alias("w"), F.length("text").alias("chars")).select("doc_id", F.size("w").alias("words"), mixed.alias("mixed"), "chars")
    return df.select("doc_id", "words", "mixed", F.round(F.col("mixed") / F.greatest("words", F.lit(1)), 6).alias("share"), ((F.col("mixed") > 0.12 * F.col("words")) & (F.col("chars") >= 60)).alias("rescan"))


@R.query(
    r"""SELECT doc_id, chars::INTEGER AS chars, lines::INTEGER AS lines, round(letters / greatest(chars, 1), 6) AS letter_share, round(dims / greatest(tokens, 1), 6) AS dimension_share,
      chars >= 400 AND letters >= 0.6 * chars AND dims <= 0.12 * tokens AS is_prose FROM (
      SELECT doc_id, length(regexp_replace(text, '[\s\p{Z}\x{85}]', '', 'g')) AS chars, len(list_filter(string_split(text, chr(10)), lambda l: trim(l) <> '')) AS lines, length(regexp_replace(text, '[^\p{L}]', '', 'g')) AS letters,
      len(regexp_extract_all(text, '\S+')) AS tokens, len(regexp_extract_all(text, '(?:^|\s)[⌀RrМM]?\d+(?:[.,xх×]\d+)*')) AS dims FROM documents)"""
)
def prose_share(spark: SparkSession, root: str) -> DataFrame:
    """How much of a text is prose rather than dimensions."""
    t = F.col("text")
    df = table(spark, root, "documents").select(
        "doc_id",
        X.nonspace_chars(t).alias("chars"),
        F.size(F.filter(F.split(t, "\n"), lambda x: F.trim(x) != "")).alias("lines"),
        F.length(F.regexp_replace(t, r"[^\p{L}]", "")).alias("letters"),
        F.regexp_count(t, F.lit(r"\S+")).alias("tokens"),
        F.regexp_count(t, F.lit(r"(?:^|\s)[⌀RrМM]?\d+(?:[.,xх×]\d+)*")).alias("dims"),
    )
    prose = (F.col("chars") >= 400) & (F.col("letters") >= 0.6 * F.col("chars")) & (F.col("dims") <= 0.12 * F.col("tokens"))
    share = lambda a, b: F.round(F.col(a) / F.greatest(F.col(b), F.lit(1)), 6)
    return df.select("doc_id", "chars", "lines", share("letters", "chars").alias("letter_share"), share("dims", "tokens").alias("dimension_share"), prose.alias("is_prose"))


@R.query(
    """SELECT doc_id, count(*)::INTEGER AS lines, (count(*) FILTER (WHERE r <= 3))::INTEGER AS kept FROM (
      SELECT doc_id, line_no, row_number() OVER (PARTITION BY doc_id, g, line ORDER BY line_no) AS r FROM (
        SELECT *, line_no - row_number() OVER (PARTITION BY doc_id, line ORDER BY line_no) AS g FROM (
          SELECT doc_id, unnest(generate_series(1, len(l))) AS line_no, unnest(l) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)))) GROUP BY doc_id"""
)
def collapsed_loops(spark: SparkSession, root: str) -> DataFrame:
    """Runs of more than three equal lines cut to three: counted here, inside the row, without a shuffle."""
    lines = F.split("text", "\n")
    step = F.aggregate(
        lines,
        F.struct(F.lit(0).alias("kept"), F.lit(0).alias("run"), F.lit(None).cast("string").alias("last")),
        lambda a, x: F.struct(
            (a["kept"] + F.when(~x.eqNullSafe(a["last"]) | (a["run"] < 3), 1).otherwise(0)).alias("kept"), F.when(x.eqNullSafe(a["last"]), a["run"] + 1).otherwise(1).alias("run"), x.alias("last")
        ),
    )
    return table(spark, root, "documents").filter("text is not null").select("doc_id", F.size(lines).alias("lines"), step["kept"].alias("kept"))


@R.query("SELECT doc_id, 'doc-' || substr(sha256(s3_fileid), 1, 32) AS file_doc, sha256(text) AS text_hash, length(text)::INTEGER AS chars FROM documents")
def document_ids(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "documents").select("doc_id", H.doc_id(F.col("s3_fileid")).alias("file_doc"), F.sha2("text", 256).alias("text_hash"), F.length("text").alias("chars"))


@R.query("SELECT source, lang, count(*) AS documents, sum(n_chars)::BIGINT AS chars, median(n_chars) AS median_chars, count(*) - count(lang) AS unlabelled FROM documents GROUP BY GROUPING SETS ((source, lang), (source), ())")
def corpus_profile(spark: SparkSession, root: str) -> DataFrame:
    df = table(spark, root, "documents")
    return df.groupingSets([[F.col("source"), F.col("lang")], [F.col("source")], []], "source", "lang").agg(
        F.count("*").alias("documents"), F.sum("n_chars").alias("chars"), F.median("n_chars").alias("median_chars"), (F.count("*") - F.count("lang")).alias("unlabelled")
    )


@R.query()
def chunks_fixed(spark: SparkSession, root: str) -> DataFrame:
    return chunking.chunks(spread(table(spark, root, "documents").select("doc_id", "text")), "doc_id", "text", "fixed")


@R.query()
def chunks_paragraph(spark: SparkSession, root: str) -> DataFrame:
    return chunking.chunks(spread(table(spark, root, "documents").select("doc_id", "text")), "doc_id", "text", "paragraph")


@R.query()
def chunks_semantic(spark: SparkSession, root: str) -> DataFrame:
    return chunking.chunks(spread(table(spark, root, "documents").select("doc_id", "text")), "doc_id", "text", "semantic")


@R.query()
def facts_from_documents(spark: SparkSession, root: str) -> DataFrame:
    return facts.extract(spread(table(spark, root, "documents").select("doc_id", "text")), "doc_id", "text")


@R.query()
def facts_from_tables(spark: SparkSession, root: str) -> DataFrame:
    grids = tables.grids(table(spark, root, "fragments").select("fragment_no", F.col("structured_payload.table_html").alias("table_html")), "table_html")
    return facts.extract_cells(grids, "fragment_no")


@R.query(
    rf"""WITH t AS (SELECT fragment_no, s3_fileid, position.page AS page, coalesce(position.sheet, '') AS sheet, position."order" AS ord, section_title, text, confidence, completeness,
        trim(string_split(regexp_replace(text, '\s+$', ''), chr(10))[-1]) AS last FROM {_LATEST} WHERE fragment_type = 'text' AND trim(text) <> ''),
      l AS (SELECT *, length(last) > 1 AND right(last, 1) IN (':', '：', '—', '–') OR regexp_full_match(last, '[0-9]{{1,3}}(\.[0-9]{{1,3}})*[.)]') AS label FROM t),
      f AS (SELECT *, CASE WHEN coalesce(lag(label) OVER w, FALSE) AND coalesce(lag(section_title) OVER w = section_title, TRUE) THEN 0 ELSE 1 END AS fresh FROM l WINDOW w AS (PARTITION BY s3_fileid, page, sheet ORDER BY ord, fragment_no)),
      i AS (SELECT *, sum(fresh) OVER (PARTITION BY s3_fileid, page, sheet ORDER BY ord, fragment_no) AS island FROM f)
    SELECT s3_fileid, page, arg_min(fragment_no, (ord, fragment_no)) AS fragment_no, string_agg(text, chr(10) ORDER BY ord, fragment_no) AS text, count(*) AS joined, min(confidence) AS confidence, min(completeness) AS completeness
    FROM i GROUP BY s3_fileid, page, sheet, island"""
)
def label_tails(spark: SparkSession, root: str) -> DataFrame:
    """Texts that end in a label joined with the text that follows on the page."""
    return parts.join_label_tails(latest(table(spark, root, "fragments")))


@R.query(
    """SELECT unit_no, CASE WHEN n = 1 THEN h ELSE h || '-' || n END AS stable_id FROM (SELECT unit_no, h, row_number() OVER (PARTITION BY h ORDER BY unit_no) AS n FROM (
      SELECT unit_no, substr(sha256(concat_ws(chr(31), s3_fileid, coalesce(page, 0)::VARCHAR, coalesce(sheet, ''), coalesce(text, ''))), 1, 24) AS h FROM source_units))"""
)
def source_unit_ids(spark: SparkSession, root: str) -> DataFrame:
    """Content ids of source units; repeats are numbered in the order of their numbers."""
    h = H.short_hash(F.concat_ws("\x1f", "s3_fileid", F.coalesce("page", F.lit(0)).cast("string"), F.coalesce("sheet", F.lit("")), F.coalesce("text", F.lit(""))), 24)
    df = table(spark, root, "source_units").select("unit_no", h.alias("h"))
    return ranks.numbered(df, "h", "unit_no").select("unit_no", F.when(F.col("n") == 1, F.col("h")).otherwise(F.concat_ws("-", "h", "n")).alias("stable_id"))


@R.query(
    """SELECT unit_no, pieces, coalesce(bad_order, 0) AS bad_order FROM source_units LEFT JOIN (SELECT source_unit_id, count(*) AS pieces, count(*) FILTER (WHERE s.char_end < s.char_start OR s.char_start < 0) AS bad_order FROM (
      SELECT s.source_unit_id AS source_unit_id, s FROM (SELECT unnest(position.source_spans) AS s FROM fragments)) GROUP BY 1) USING (source_unit_id)"""
)
def source_spans(spark: SparkSession, root: str) -> DataFrame:
    """How many stored pieces each source unit has, and how many of them are not valid spans."""
    spans = table(spark, root, "fragments").select(F.explode("position.source_spans").alias("s"))
    by = spans.groupBy("s.source_unit_id").agg(F.count("*").alias("pieces"), F.count_if((F.col("s.char_end") < F.col("s.char_start")) | (F.col("s.char_start") < 0)).alias("bad_order"))
    return table(spark, root, "source_units").select("unit_no", "source_unit_id").join(by, "source_unit_id", "left").select("unit_no", "pieces", F.coalesce("bad_order", F.lit(0)).alias("bad_order"))
