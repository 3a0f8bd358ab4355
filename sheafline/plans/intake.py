"""Queries on intake files and requests: names, types, rules, duplicates, claims, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sheafline.functions import files as N
from sheafline.functions import hashes as H
from sheafline.functions import texts as X
from sheafline.operators import rules
from sheafline.plans.registry import Registry
from sheafline.session import spread, table

R = Registry()

_EXT = r"lower(regexp_extract(url_decode(regexp_extract(s3_fileid, '([^/]*)$', 1)), '\.([A-Za-z0-9]{1,8})$', 1))"
_KIND = "CASE " + " ".join(f"WHEN ext = '{e}' THEN '{k}'" for e, k, _, _ in N.FILE_TYPES) + " ELSE 'unknown' END"
_MIME = "CASE " + " ".join(f"WHEN ext = '{e}' THEN '{m}'" for e, _, m, _ in N.FILE_TYPES) + " ELSE 'application/octet-stream' END"
_KNOWN = ", ".join(f"'{e}'" for e, _, _, ok in N.FILE_TYPES if ok)


@R.query(
    f"""SELECT file_no, ext AS extension, {_KIND} AS kind, {_MIME} AS mime, CASE ext WHEN 'jpeg' THEN 'jpg' WHEN 'tif' THEN 'tiff' ELSE ext END AS canonical,
    CASE WHEN ext = '' THEN 'no extension' WHEN ext = 'dwg' THEN 'needs converter' WHEN ext NOT IN ({_KNOWN}) THEN 'unknown type' END AS refusal,
    url_decode(regexp_extract(s3_fileid, '([^/]*)$', 1)) AS name
    FROM (SELECT *, {_EXT} AS ext FROM intake_files)"""
)
def file_types(spark: SparkSession, root: str) -> DataFrame:
    ext = N.extension(F.col("s3_fileid"))
    return table(spark, root, "intake_files").select(
        "file_no", ext.alias("extension"), N.kind(ext).alias("kind"), N.mime(ext).alias("mime"), N.canonical_extension(ext).alias("canonical"), N.refusal(ext).alias("refusal"), N.file_name(F.col("s3_fileid")).alias("name")
    )


@R.query(
    f"""SELECT kind, count(*) AS files, count(DISTINCT s3_fileid) AS ids, sum(size_bytes)::BIGINT AS bytes, min(size_bytes) AS least, max(size_bytes) AS most
    FROM (SELECT *, {_KIND} AS kind FROM (SELECT *, {_EXT} AS ext FROM intake_files)) GROUP BY kind"""
)
def files_by_kind(spark: SparkSession, root: str) -> DataFrame:
    df = table(spark, root, "intake_files").withColumn("kind", N.kind(N.extension(F.col("s3_fileid"))))
    return df.groupBy("kind").agg(F.count("*").alias("files"), F.countDistinct("s3_fileid").alias("ids"), F.sum("size_bytes").alias("bytes"), F.min("size_bytes").alias("least"), F.max("size_bytes").alias("most"))


SYSTEM, PERSONAL, SPARED = ("~$", ".tmp", "thumbs.db"), ("входящие",), ("obsh/",)


@R.query(
    """SELECT file_no, CASE WHEN contains(lower(p), '~$') OR contains(lower(p), '.tmp') OR contains(lower(p), 'thumbs.db') THEN 'system'
      WHEN contains(lower(p), 'obsh/') THEN 'open' WHEN contains(lower(p), 'входящие') THEN 'personal' ELSE 'open' END AS path_class,
      size_bytes < 512 AS too_small, size_bytes > 209715200 AS too_large
    FROM (SELECT *, url_decode(s3_fileid) AS p FROM intake_files)"""
)
def path_rules(spark: SparkSession, root: str) -> DataFrame:
    """Names and sizes only: nothing of the content is read. Exceptions come before the paths they spare."""
    p = F.try_url_decode("s3_fileid")
    cls = F.when(N.has_any(p, SYSTEM), "system").when(N.has_any(p, SPARED), "open").when(N.has_any(p, PERSONAL), "personal").otherwise("open")
    return table(spark, root, "intake_files").select("file_no", cls.alias("path_class"), (F.col("size_bytes") < 512).alias("too_small"), (F.col("size_bytes") > 200 << 20).alias("too_large"))


@R.query(
    f"""WITH wanted AS (SELECT DISTINCT regexp_replace(s3_fileid, '\\.[A-Za-z0-9]+$', '') AS stem FROM intake_files),
      tries AS (SELECT stem, e.rank, stem || '.' || e.ext AS path FROM wanted CROSS JOIN (VALUES {", ".join(f"({i}, '{e}')" for i, e in enumerate(N.PROBE_ORDER))}) e(rank, ext)),
      there AS (SELECT DISTINCT s3_fileid AS path FROM intake_files)
    SELECT w.stem, min_by(t.path, t.rank) AS path FROM wanted w LEFT JOIN (SELECT tries.* FROM tries JOIN there USING (path)) t USING (stem) GROUP BY w.stem"""
)
def locate_files(spark: SparkSession, root: str) -> DataFrame:
    """An id without extension finds its file: every known extension is tried, the first in the fixed order that is there wins."""
    ids = table(spark, root, "intake_files").select("s3_fileid").distinct()
    wanted = ids.select(F.regexp_replace("s3_fileid", r"\.[A-Za-z0-9]+$", "").alias("stem")).distinct()
    order = F.array(*[F.struct(F.lit(i).alias("rank"), F.lit(e).alias("ext")) for i, e in enumerate(N.PROBE_ORDER)])
    tries = wanted.withColumn("t", F.explode(order)).select("stem", F.col("t.rank").alias("rank"), F.concat_ws(".", "stem", F.col("t.ext")).alias("path"))
    hit = tries.join(ids.withColumnRenamed("s3_fileid", "path"), "path", "left_semi").groupBy("stem").agg(F.min_by("path", "rank").alias("path"))
    return wanted.join(hit, "stem", "left")


@R.query(
    """WITH asked AS (SELECT DISTINCT unnest(s3_fileid) AS s3_fileid FROM parse_requests)
    SELECT a.s3_fileid, CASE WHEN i.n IS NULL THEN FALSE WHEN i.hashed = 0 THEN NULL ELSE TRUE END AS present
    FROM asked a LEFT JOIN (SELECT s3_fileid, count(*) n, count(file_hash) hashed FROM intake_files GROUP BY 1) i USING (s3_fileid)"""
)
def presence(spark: SparkSession, root: str) -> DataFrame:
    """Three-valued presence of the asked files: there, not there, or not known (no copy with a hash was read)."""
    asked = table(spark, root, "parse_requests").select(F.explode("s3_fileid").alias("s3_fileid")).distinct()
    have = table(spark, root, "intake_files").groupBy("s3_fileid").agg(F.count("*").alias("n"), F.count("file_hash").alias("hashed"))
    state = F.when(F.col("n").isNull(), F.lit(False)).when(F.col("hashed") == 0, F.lit(None)).otherwise(F.lit(True))
    return asked.join(have, "s3_fileid", "left").select("s3_fileid", state.alias("present"))


@R.query(f"SELECT doc_id, category, round(score, 6) AS score, hits::BIGINT AS hits FROM ({rules.sql_scores('documents', 'doc_id', 'text')}) WHERE score > 0")
def rule_scores(spark: SparkSession, root: str) -> DataFrame:
    docs = spread(table(spark, root, "documents").select("doc_id", "text")).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rules.scores(docs, "text").filter("score > 0").select("doc_id", "category", F.round("score", 6).alias("score"), F.col("hits").cast("long").alias("hits"))


_RANKED = f"SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, rank) AS r, lead(score) OVER (PARTITION BY doc_id ORDER BY score DESC, rank) AS second FROM ({rules.sql_scores('documents', 'doc_id', 'text')})"


@R.query(
    f"""SELECT doc_id, CASE WHEN score > 0 THEN category END AS category,
      round(CASE WHEN score > 0 THEN least(0.95, 0.45 + 0.40 * (score - second) / score + 0.05 * least(hits, 3)) ELSE 0.0 END, 6) AS confidence FROM ({_RANKED}) WHERE r = 1"""
)
def rule_category(spark: SparkSession, root: str) -> DataFrame:
    docs = rules.score(spread(table(spark, root, "documents").select("doc_id", "text")), "text")
    return docs.select("doc_id", F.col("rules.category").alias("category"), F.round("rules.confidence", 6).alias("confidence"))


@R.query(
    f"""SELECT coalesce(category, 'none') AS category, count(*) AS documents, round(avg(confidence), 6) AS confidence
      FROM (SELECT CASE WHEN score > 0 THEN category END AS category, CASE WHEN score > 0 THEN least(0.95, 0.45 + 0.40 * (score - second) / score + 0.05 * least(hits, 3)) ELSE 0.0 END AS confidence FROM ({_RANKED}) WHERE r = 1) GROUP BY 1"""
)
def gateway_report(spark: SparkSession, root: str) -> DataFrame:
    """The flagship: every document's text classified by rules, counted by category."""
    docs = rules.score(spread(table(spark, root, "documents").select("doc_id", "text")), "text")
    return docs.groupBy(F.coalesce("rules.category", F.lit("none")).alias("category")).agg(F.count("*").alias("documents"), F.round(F.avg("rules.confidence"), 6).alias("confidence"))


@R.query(
    """SELECT file_no, s3_fileid, first_no, file_no <> first_no AS repeated FROM (
      SELECT file_no, s3_fileid, min(file_no) OVER (PARTITION BY file_hash) AS first_no FROM intake_files WHERE file_hash IS NOT NULL)"""
)
def exact_duplicates(spark: SparkSession, root: str) -> DataFrame:
    """The first file of each hash. The owner comes from a combined aggregation, so a hash that a third of all files share is no single task's window."""
    df = table(spark, root, "intake_files").filter("file_hash is not null").select("file_no", "s3_fileid", "file_hash")
    first = df.groupBy("file_hash").agg(F.min("file_no").alias("first_no"))
    return df.join(first, "file_hash").select("file_no", "s3_fileid", "first_no", (F.col("file_no") != F.col("first_no")).alias("repeated"))


@R.query("SELECT file_hash, min_by(s3_fileid, file_no) AS owner, count(*) AS claims, count(DISTINCT s3_fileid) AS claimants FROM intake_files WHERE outcome = 'accept' AND file_hash IS NOT NULL GROUP BY file_hash")
def first_claims(spark: SparkSession, root: str) -> DataFrame:
    df = table(spark, root, "intake_files").filter("outcome = 'accept' and file_hash is not null")
    return df.groupBy("file_hash").agg(F.min_by("s3_fileid", "file_no").alias("owner"), F.count("*").alias("claims"), F.countDistinct("s3_fileid").alias("claimants"))


@R.query("SELECT file_no, s3_fileid, arrived_at AT TIME ZONE 'UTC' AS arrived_at FROM intake_files WHERE outcome = 'quarantine' ORDER BY intake_files.arrived_at, file_no LIMIT 100")
def quarantine_queue(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "intake_files").filter("outcome = 'quarantine'").orderBy("arrived_at", "file_no").limit(100).select("file_no", "s3_fileid", "arrived_at")


@R.query("SELECT file_hash, arg_max(s3_fileid, file_no) AS s3_fileid FROM intake_files WHERE outcome = 'accept' AND file_hash IS NOT NULL GROUP BY file_hash")
def known_hashes(spark: SparkSession, root: str, most: int | None = None) -> DataFrame:
    """The latest id of each hash of the accepted files; ``most`` looks at the newest so many files only."""
    newest = table(spark, root, "intake_files").filter("outcome = 'accept' and file_hash is not null")
    if most:
        newest = newest.orderBy(F.desc("file_no")).limit(most)
    return newest.groupBy("file_hash").agg(F.max_by("s3_fileid", "file_no").alias("s3_fileid"))


@R.query(
    """SELECT outcome, batch_no, count(*) AS files, sum(count(*)) OVER (PARTITION BY outcome ORDER BY batch_no)::BIGINT AS running FROM intake_files WHERE batch_no IS NOT NULL GROUP BY outcome, batch_no"""
)
def outcomes_by_batch(spark: SparkSession, root: str) -> DataFrame:
    by = table(spark, root, "intake_files").filter("batch_no is not null").groupBy("outcome", "batch_no").agg(F.count("*").alias("files"))
    return by.withColumn("running", F.sum("files").over(Window.partitionBy("outcome").orderBy("batch_no")))


@R.query(
    """SELECT outcome, file_no, s3_fileid FROM (SELECT *, row_number() OVER (PARTITION BY outcome ORDER BY arrived_at DESC, file_no DESC) r FROM intake_files) WHERE r <= 5"""
)
def report_examples(spark: SparkSession, root: str) -> DataFrame:
    """Five newest of each outcome; the rank filter becomes a limit before the shuffle."""
    w = Window.partitionBy("outcome").orderBy(F.desc("arrived_at"), F.desc("file_no"))
    return table(spark, root, "intake_files").withColumn("r", F.row_number().over(w)).filter("r <= 5").select("outcome", "file_no", "s3_fileid")


@R.query(
    f"""SELECT coalesce(kind, '?') AS kind, accepts, rejects FROM (SELECT {_KIND} AS kind, count(*) FILTER (WHERE outcome = 'accept') AS accepts, count(*) FILTER (WHERE outcome = 'reject') AS rejects
      FROM (SELECT *, {_EXT} AS ext FROM intake_files) GROUP BY 1) WHERE accepts >= 3 AND accepts > 2 * rejects"""
)
def rule_suggestions(spark: SparkSession, root: str) -> DataFrame:
    df = table(spark, root, "intake_files").withColumn("kind", F.coalesce(N.kind(N.extension(F.col("s3_fileid"))), F.lit("?")))
    by = df.groupBy("kind").agg(F.count_if(F.col("outcome") == "accept").alias("accepts"), F.count_if(F.col("outcome") == "reject").alias("rejects"))
    return by.filter("accepts >= 3 and accepts > 2 * rejects")


_BITS = " + ".join(f"CASE WHEN sum(CASE WHEN {h} IS NULL THEN 0 ELSE (({h} >> {i}) & 1) * 2 - 1 END) > 0 THEN (1::HUGEINT << {i + s}) ELSE 0::HUGEINT END" for h, s in (("hi", 32), ("lo", 0)) for i in range(32))
_PRINTS = f"""SELECT file_no, CASE WHEN p >= 9223372036854775808::HUGEINT THEN (p - 18446744073709551616::HUGEINT)::BIGINT ELSE p::BIGINT END AS fingerprint FROM (
      SELECT file_no, {_BITS} AS p FROM (
        SELECT f.file_no, ('0x' || substr(md5(t.tok), 1, 8))::BIGINT AS hi, ('0x' || substr(md5(t.tok), 9, 8))::BIGINT AS lo
        FROM intake_files f LEFT JOIN (SELECT file_no, unnest(regexp_extract_all(lower(text_sample), '[\\p{{L}}\\p{{M}}\\p{{Nd}}\\p{{Nl}}\\p{{Pc}}\\x{{200c}}\\x{{200d}}]{{3,}}')) AS tok FROM intake_files) t USING (file_no)) GROUP BY file_no)"""


@R.query(_PRINTS)
def simhash64(spark: SparkSession, root: str) -> DataFrame:
    return H.simhash(table(spark, root, "intake_files"), "file_no", "text_sample")


@R.query(
    f"""WITH p AS ({_PRINTS}), h AS (SELECT fingerprint, min(file_no) AS class_id FROM p WHERE fingerprint <> 0 GROUP BY 1),
      n AS (SELECT a.class_id, b.class_id AS b, bit_count(xor(a.fingerprint, b.fingerprint)) AS d FROM h a JOIN h b ON a.class_id <> b.class_id AND bit_count(xor(a.fingerprint, b.fingerprint)) <= 6),
      l AS (SELECT class_id, count(*) AS links, arg_min(b, (d, b)) AS nearest_id, min(d)::INTEGER AS distance FROM n GROUP BY 1)
    SELECT file_no, coalesce(h.class_id, file_no) AS class_id, coalesce(links, 0) AS links, nearest_id, distance FROM p LEFT JOIN h USING (fingerprint) LEFT JOIN l ON l.class_id = h.class_id"""
)
def near_fingerprints(spark: SparkSession, root: str) -> DataFrame:
    """Each file with the class of its fingerprint, how many other prints are at most six bits away, and the nearest one."""
    return H.near_classes(H.simhash(table(spark, root, "intake_files"), "file_no", "text_sample"), "file_no")


@R.query(f"SELECT file_no, fingerprint FROM ({_PRINTS}) JOIN intake_files USING (file_no) WHERE outcome = 'accept' AND fingerprint <> 0")
def accepted_fingerprints(spark: SparkSession, root: str, most: int | None = None) -> DataFrame:
    """The fingerprints of all accepted files that have one; ``most`` keeps the newest so many."""
    own = table(spark, root, "intake_files").filter("outcome = 'accept'")
    prints = H.simhash(own, "file_no", "text_sample").filter("fingerprint <> 0")
    return prints.orderBy(F.desc("file_no")).limit(most) if most else prints


@R.query(
    r"""SELECT file_no, coalesce(length(regexp_replace(text_sample, '[\s\p{Z}\x{85}]', '', 'g')), 0) AS chars, coalesce(length(trim(text_sample)), 0) < 20 AS too_little,
      CASE WHEN y BETWEEN 1950 AND 2025 THEN y END AS year, CASE WHEN y BETWEEN 1950 AND 2025 THEN 2025 - y END AS age,
      CASE WHEN y IS NULL OR y NOT BETWEEN 1950 AND 2025 THEN 'undated' WHEN 2025 - y > 5 THEN 'old' ELSE 'fresh' END AS freshness
      FROM (SELECT *, try_cast(nullif(regexp_extract(s3_fileid, '(?:^|/)(\d{4})(?:/|$)', 1), '') AS INT) AS y FROM intake_files)"""
)
def text_and_freshness(spark: SparkSession, root: str) -> DataFrame:
    """Text volume, and the age by the year in the path, against the fixed reference year 2025."""
    y = F.nullif(F.regexp_extract("s3_fileid", r"(?:^|/)(\d{4})(?:/|$)", 1), F.lit("")).try_cast("int")
    dated = y.between(1950, 2025)
    return table(spark, root, "intake_files").select(
        "file_no",
        X.nonspace_chars(F.col("text_sample")).cast("long").alias("chars"),
        (F.coalesce(F.length(F.trim("text_sample")), F.lit(0)) < 20).alias("too_little"),
        F.when(dated, y).alias("year"),
        F.when(dated, F.lit(2025) - y).alias("age"),
        F.when(~F.coalesce(dated, F.lit(False)), "undated").when(F.lit(2025) - y > 5, "old").otherwise("fresh").alias("freshness"),
    )
