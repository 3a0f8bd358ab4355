"""Queries of the intake gateway: markers by role, text against path, the cascade with its early ends, technical checks and errors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sheafline.functions import files as N
from sheafline.functions import texts as X
from sheafline.operators import gateway as G
from sheafline.plans.intake import _EXT, _KIND, PERSONAL, SPARED, SYSTEM
from sheafline.plans.registry import Registry
from sheafline.session import spread, table

R = Registry()

LEAST_TEXT, SURE = 20, 0.6
_KNOWN = ", ".join(f"'{e}'" for e, _, _, ok in N.FILE_TYPES if ok)
_SPACE = r"[\s\p{Z}\x{85}]"


def _files(spark: SparkSession, root: str) -> DataFrame:
    """Intake files with what the cascade looks at: lower-case path and text, type, and whether there is text enough to judge."""
    df = spread(table(spark, root, "intake_files").select("file_no", "s3_fileid", "size_bytes", "file_hash", "text_sample"))
    ext = N.extension(F.col("s3_fileid"))
    return df.select(
        "file_no", "size_bytes", "file_hash", "s3_fileid", F.lower(F.try_url_decode("s3_fileid")).alias("p"), F.lower(F.coalesce("text_sample", F.lit(""))).alias("t"), ext.alias("ext"), N.kind(ext).alias("kind"), N.refusal(ext).alias("refusal"),
        (X.nonspace_chars(F.col("text_sample")) >= LEAST_TEXT).alias("reliable"),
    )


_FILES = f"""(SELECT *, {_KIND} AS kind, CASE WHEN ext = '' THEN 'no extension' WHEN ext = 'dwg' THEN 'needs converter' WHEN ext NOT IN ({_KNOWN}) THEN 'unknown type' END AS refusal FROM (
      SELECT file_no, size_bytes, file_hash, s3_fileid, lower(url_decode(s3_fileid)) AS p, lower(coalesce(text_sample, '')) AS t, {_EXT} AS ext, length(regexp_replace(coalesce(text_sample, ''), '{_SPACE}', '', 'g')) >= {LEAST_TEXT} AS reliable FROM intake_files))"""


@R.query(f"SELECT file_no, category, confidence, round(score, 6) AS score, hits::INTEGER AS hits FROM {G.sql_match(_FILES, 'file_no', 't')}")
def text_categories(spark: SparkSession, root: str) -> DataFrame:
    """What a file's text says it is, with markers that count only beside a designation."""
    df = _files(spark, root).withColumn("n", G.counted(F.col("t"))).withColumn("m", G.match(F.col("n")))
    return df.select("file_no", "m.category", "m.confidence", F.round("m.score", 6).alias("score"), "m.hits")


@R.query(f"SELECT file_no, category, round(confidence * {G.PATH_WEIGHT}, 3) AS confidence FROM {G.sql_match(_FILES, 'file_no', 'p', G.FROM_PATH)}")
def path_categories(spark: SparkSession, root: str) -> DataFrame:
    """What a file's path says it is: fewer categories, less weight."""
    df = _files(spark, root).withColumn("n", G.counted(F.col("p"))).withColumn("m", G.match(F.col("n"), G.FROM_PATH))
    return df.select("file_no", "m.category", F.round(F.col("m.confidence") * G.PATH_WEIGHT, 3).alias("confidence"))


def categorised(df: DataFrame) -> DataFrame:
    """Adds ``category``, ``confidence`` and ``source``: the text's word, else the path's, else what the type alone tells."""
    df = df.withColumn("tn", G.counted(F.col("t"))).withColumn("pn", G.counted(F.col("p"))).withColumn("tm", F.when(F.col("reliable"), G.match(F.col("tn")))).withColumn("pm", G.match(F.col("pn"), G.FROM_PATH))
    by_path = F.struct(F.col("pm.category").alias("category"), F.round(F.col("pm.confidence") * G.PATH_WEIGHT, 3).alias("confidence"), F.lit("path").alias("source"))
    fixed = lambda c, v, s: F.struct(F.lit(c).alias("category"), F.lit(v).alias("confidence"), F.lit(s).alias("source"))
    said = (
        F.when(F.col("tm").isNotNull(), F.struct(F.col("tm.category").alias("category"), F.col("tm.confidence").alias("confidence"), F.lit("text").alias("source")))
        .when(F.col("pm").isNotNull(), by_path)
        .when(F.col("ext") == "dxf", fixed("technical", 0.9, "type"))
        .when(F.col("kind") == "spreadsheet", fixed("business", 0.65, "type"))
        .when(~F.col("reliable") & (F.coalesce("size_bytes", F.lit(0)) == 0), fixed("unrecognizable", 0.55, "empty"))
        .otherwise(fixed("business", 0.5, "default"))
    )
    return df.withColumn("said", said).select("*", "said.category", "said.confidence", "said.source").drop("said", "tn", "pn", "tm")


_SAID = f"""(SELECT f.*, m.category AS tc, m.confidence AS tf, q.category AS pc, q.confidence AS pf,
      CASE WHEN reliable AND m.category IS NOT NULL THEN 'text' WHEN q.category IS NOT NULL THEN 'path' WHEN ext = 'dxf' OR kind = 'spreadsheet' THEN 'type' WHEN NOT reliable AND coalesce(size_bytes, 0) = 0 THEN 'empty' ELSE 'default' END AS source
    FROM {_FILES} f JOIN {G.sql_match(_FILES, 'file_no', 't')} m USING (file_no) JOIN {G.sql_match(_FILES, 'file_no', 'p', G.FROM_PATH)} q USING (file_no))"""
_CATEGORY = "CASE source WHEN 'text' THEN tc WHEN 'path' THEN pc WHEN 'type' THEN CASE WHEN ext = 'dxf' THEN 'technical' ELSE 'business' END WHEN 'empty' THEN 'unrecognizable' ELSE 'business' END"
_CONFIDENCE = f"CASE source WHEN 'text' THEN tf WHEN 'path' THEN round(pf * {G.PATH_WEIGHT}, 3) WHEN 'type' THEN CASE WHEN ext = 'dxf' THEN 0.9 ELSE 0.65 END WHEN 'empty' THEN 0.55 ELSE 0.5 END"


@R.query(f"SELECT file_no, {_CATEGORY} AS category, ({_CONFIDENCE})::DOUBLE AS confidence, source FROM {_SAID}")
def file_categories(spark: SparkSession, root: str) -> DataFrame:
    """Each file's category by text, path or type, whichever speaks first."""
    return categorised(_files(spark, root)).select("file_no", "category", "confidence", "source")


def _has(p: str, words: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains({p}, '{w}')" for w in words) + ")"


@R.query(
    f"""SELECT file_no, layer, CASE layer WHEN 'content' THEN {_CATEGORY} WHEN 'path' THEN CASE WHEN {_has('p', SYSTEM)} THEN 'system' ELSE 'personal' END END AS category,
      CASE WHEN layer = 'content' THEN ({_CONFIDENCE})::DOUBLE ELSE 1.0 END AS confidence, layer = 'content' AND {_CONFIDENCE} < {SURE} AS disputed,
      layer = 'content' AND pc IS NOT NULL AND pc <> {_CATEGORY} AS name_conflict,
      CASE layer WHEN 'path' THEN 'stopped by its path' WHEN 'size' THEN 'stopped by its size' WHEN 'type' THEN 'stopped by its type: ' || refusal ELSE 'taken for ' || ({_CATEGORY}) || ' by ' || source END AS explanation
    FROM (SELECT *, CASE WHEN {_has('p', SYSTEM)} OR {_has('p', PERSONAL)} AND NOT {_has('p', SPARED)} THEN 'path' WHEN size_bytes < 512 OR size_bytes > 209715200 THEN 'size' WHEN refusal IS NOT NULL THEN 'type' ELSE 'content' END AS layer FROM {_SAID})"""
)
def gateway_cascade(spark: SparkSession, root: str) -> DataFrame:
    """The layer at which each file's way through the gateway ends, and with what: path, size and type end it before the text is looked at.

    ``disputed``: the content layer is not sure enough; ``name_conflict``: the path names another category than the one taken.
    """
    df = _files(spark, root)
    system = N.has_any(F.col("p"), SYSTEM)
    personal = ~N.has_any(F.col("p"), SPARED) & N.has_any(F.col("p"), PERSONAL)
    layer = F.when(system | personal, "path").when((F.col("size_bytes") < 512) | (F.col("size_bytes") > 200 << 20), "size").when(F.col("refusal").isNotNull(), "type").otherwise("content")
    df = categorised(df).withColumn("layer", layer)
    content = F.col("layer") == "content"
    taken = F.when(content, F.col("category")).when(F.col("layer") == "path", F.when(system, "system").otherwise("personal"))
    words = F.when(F.col("layer") == "type", F.concat(F.lit("stopped by its type: "), "refusal")).when(~content, F.concat(F.lit("stopped by its "), "layer")).otherwise(F.concat(F.lit("taken for "), "category", F.lit(" by "), "source"))
    return df.select(
        "file_no", "layer", taken.alias("category"), F.when(content, F.col("confidence")).otherwise(F.lit(1.0)).alias("confidence"), (content & (F.col("confidence") < SURE)).alias("disputed"),
        (content & F.coalesce(F.col("pm.category") != F.col("category"), F.lit(False))).alias("name_conflict"), words.alias("explanation"),
    )


# What stops a file, tried in this order, and whether another try can help.
ERRORS = (("missing_hash", True), ("no_size", True), ("too_small", False), ("too_large", False), ("unsupported", False), ("no_text", False))
_ERROR = "CASE WHEN file_hash IS NULL THEN 'missing_hash' WHEN size_bytes IS NULL THEN 'no_size' WHEN size_bytes < 512 THEN 'too_small' WHEN size_bytes > 209715200 THEN 'too_large' WHEN refusal IS NOT NULL THEN 'unsupported' WHEN NOT reliable THEN 'no_text' END"


def error_of() -> Column:
    size = F.col("size_bytes")
    conditions = (F.col("file_hash").isNull(), size.isNull(), size < 512, size > 200 << 20, F.col("refusal").isNotNull(), ~F.col("reliable"))
    out = F.lit(None).cast("string")
    for (code, _), c in reversed(list(zip(ERRORS, conditions, strict=True))):
        out = F.when(c, code).otherwise(out)
    return out


_RETRY = ", ".join(f"'{c}'" for c, again in ERRORS if again)


@R.query(f"SELECT file_no, reason, reason IN ({_RETRY}) AS retryable FROM (SELECT file_no, {_ERROR} AS reason FROM {_FILES}) WHERE reason IS NOT NULL")
def file_errors(spark: SparkSession, root: str) -> DataFrame:
    """Technical validation: the first reason in the fixed order for which a file cannot be worked on."""
    df = _files(spark, root).select("file_no", error_of().alias("reason")).filter("reason is not null")
    return df.select("file_no", "reason", F.col("reason").isin(*[c for c, again in ERRORS if again]).alias("retryable"))


@R.query(
    f"""WITH e AS (SELECT s3_fileid, min_by(reason, file_no) AS reason FROM (SELECT s3_fileid, file_no, {_ERROR} AS reason FROM {_FILES}) WHERE reason IS NOT NULL GROUP BY 1),
      i AS (SELECT request_id, received_at, batch_no, unnest(generate_series(1, len(s3_fileid))) AS place, unnest(s3_fileid) AS s3_fileid FROM parse_requests WHERE request_id IS NOT NULL)
    SELECT request_id, count(*) AS items, count(e.reason) AS failed, min_by(s3_fileid, (place, received_at, s3_fileid)) FILTER (WHERE e.reason IS NOT NULL) AS first_failed, min_by(e.reason, (place, received_at, s3_fileid)) FILTER (WHERE e.reason IS NOT NULL) AS first_reason
    FROM i LEFT JOIN e USING (s3_fileid) GROUP BY request_id"""
)
def request_errors(spark: SparkSession, root: str) -> DataFrame:
    """Of each request how many of its files fail, and the first that does, in the request's order."""
    bad = _files(spark, root).select("s3_fileid", "file_no", error_of().alias("reason")).filter("reason is not null").groupBy("s3_fileid").agg(F.min_by("reason", "file_no").alias("reason"))
    items = table(spark, root, "parse_requests").filter("request_id is not null").select("request_id", "received_at", F.posexplode("s3_fileid").alias("place", "s3_fileid"))
    both = items.join(bad, "s3_fileid", "left")
    order = F.when(F.col("reason").isNotNull(), F.struct("place", "received_at", "s3_fileid"))
    return both.groupBy("request_id").agg(F.count("*").alias("items"), F.count("reason").alias("failed"), F.min_by("s3_fileid", order).alias("first_failed"), F.min_by("reason", order).alias("first_reason"))


@R.query(
    f"""WITH f AS (SELECT file_no, file_hash, {_ERROR} AS reason FROM {_FILES}), o AS (SELECT file_hash, min(file_no) AS owner FROM intake_files WHERE file_hash IS NOT NULL GROUP BY 1)
    SELECT file_no, CASE WHEN reason IN ('missing_hash', 'no_size', 'too_small', 'too_large', 'unsupported') THEN 'validation' WHEN owner < file_no THEN 'duplicate' WHEN reason IS NOT NULL THEN 'readability' ELSE 'passed' END AS stage, reason,
      CASE WHEN owner < file_no THEN owner END AS owner FROM f LEFT JOIN o USING (file_hash)"""
)
def quality_gate(spark: SparkSession, root: str) -> DataFrame:
    """The quality gate in its order with an early return: validation, exact duplicate of an earlier file, readability."""
    df = _files(spark, root).select("file_no", "file_hash", error_of().alias("reason"))
    owners = df.filter("file_hash is not null").groupBy("file_hash").agg(F.min("file_no").alias("owner"))
    again = F.col("owner") < F.col("file_no")
    stage = F.when(F.col("reason").isin(*[c for c, _ in ERRORS[:-1]]), "validation").when(again, "duplicate").when(F.col("reason").isNotNull(), "readability").otherwise("passed")
    return df.join(owners, "file_hash", "left").select("file_no", stage.alias("stage"), "reason", F.when(again, F.col("owner")).alias("owner"))


@R.query(
    """SELECT request_id, s3_fileid, place FROM (SELECT *, row_number() OVER (PARTITION BY request_id, s3_fileid ORDER BY place, received_at) AS r FROM (
      SELECT request_id, received_at, unnest(generate_series(1, len(s3_fileid))) AS place, trim(unnest(s3_fileid)) AS s3_fileid FROM parse_requests WHERE request_id IS NOT NULL)) WHERE r = 1 AND s3_fileid <> ''"""
)
def request_items(spark: SparkSession, root: str) -> DataFrame:
    """The items of each request: trimmed ids without empty ones, each at its first place."""
    items = table(spark, root, "parse_requests").filter("request_id is not null").select("request_id", F.posexplode("s3_fileid").alias("p", "id"))
    items = items.select("request_id", F.trim("id").alias("s3_fileid"), (F.col("p") + 1).cast("long").alias("place")).filter("s3_fileid <> ''")
    return items.groupBy("request_id", "s3_fileid").agg(F.min("place").alias("place"))


MOST_TRIES, DELAY = 3, 60


@R.query(
    f"""SELECT request_id, event_id, tries::INTEGER AS tries, CASE WHEN tries <= {MOST_TRIES} THEN ({DELAY} * tries)::INTEGER END AS delay FROM (
      SELECT request_id, event_id, row_number() OVER (PARTITION BY request_id ORDER BY received_at, event_id NULLS FIRST) AS tries FROM parse_requests WHERE request_id IS NOT NULL)"""
)
def retry_delays(spark: SparkSession, root: str) -> DataFrame:
    """How long each posting of a request waits before the next try; null once there have been too many."""
    tries = F.row_number().over(Window.partitionBy("request_id").orderBy("received_at", F.asc_nulls_first("event_id")))
    df = table(spark, root, "parse_requests").filter("request_id is not null").select("request_id", "event_id", tries.alias("tries"))
    return df.withColumn("delay", F.when(F.col("tries") <= MOST_TRIES, F.col("tries") * DELAY))


@R.query(
    f"""SELECT file_no, CASE WHEN kind IN ('image', 'cad') OR coalesce(size_bytes, 0) > 20971520 THEN 'ml' ELSE 'interactive' END AS queue, least(3600 * 0.8, 60 + 15.0 * greatest(1, ceil(coalesce(size_bytes, 0) / 102400.0)))::DOUBLE AS budget FROM {_FILES}"""
)
def work_queues(spark: SparkSession, root: str) -> DataFrame:
    """The queue of each file, and its budget in seconds: a base and so much a page (a page for each 100 KiB), within four fifths of the task's limit."""
    df = _files(spark, root)
    size = F.coalesce("size_bytes", F.lit(0))
    heavy = F.col("kind").isin("image", "cad") | (size > 20 << 20)
    pages = F.greatest(F.lit(1), F.ceil(size / F.lit(102400.0)))
    return df.select("file_no", F.when(heavy, "ml").otherwise("interactive").alias("queue"), F.least(F.lit(3600 * 0.8), 60 + 15.0 * pages).alias("budget"))


@R.query(
    f"""SELECT layer, category, accepts, rejects FROM (SELECT layer, coalesce(category, '?') AS category, count(*) FILTER (WHERE outcome = 'accept') AS accepts, count(*) FILTER (WHERE outcome = 'reject') AS rejects
      FROM ({R.sql['gateway_cascade']}) JOIN intake_files USING (file_no) GROUP BY ALL) WHERE accepts >= 3 AND accepts > 2 * rejects"""
)
def layer_suggestions(spark: SparkSession, root: str) -> DataFrame:
    """Layers and categories whose files are accepted far more often than rejected: candidates for a rule."""
    outcome = table(spark, root, "intake_files").select("file_no", "outcome")
    df = gateway_cascade(spark, root).select("file_no", "layer", F.coalesce("category", F.lit("?")).alias("category")).join(outcome, "file_no")
    by = df.groupBy("layer", "category").agg(F.count_if(F.col("outcome") == "accept").alias("accepts"), F.count_if(F.col("outcome") == "reject").alias("rejects"))
    return by.filter("accepts >= 3 and accepts > 2 * rejects")


@R.query(
    """SELECT q.file_no, min(l.file_no) AS resolved_by, arg_min(l.outcome, l.file_no) AS resolution FROM intake_files q LEFT JOIN intake_files l ON l.s3_fileid = q.s3_fileid AND l.file_no > q.file_no AND l.outcome IN ('accept', 'reject')
      WHERE q.outcome = 'quarantine' GROUP BY q.file_no"""
)
def resolved_quarantine(spark: SparkSession, root: str) -> DataFrame:
    """Each quarantined file with the next decided arrival of its id, which resolves it; null while it waits."""
    df = table(spark, root, "intake_files").filter("outcome in ('accept', 'reject', 'quarantine')").select("file_no", "s3_fileid", "outcome")
    later = Window.partitionBy("s3_fileid").orderBy("file_no").rowsBetween(1, Window.unboundedFollowing)
    decided = F.first(F.when(F.col("outcome") != "quarantine", F.struct("file_no", "outcome")), True).over(later)
    waiting = df.withColumn("d", decided).filter("outcome = 'quarantine'")
    return waiting.select("file_no", F.col("d.file_no").alias("resolved_by"), F.col("d.outcome").alias("resolution"))
