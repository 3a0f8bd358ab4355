"""Queries on requests, runs and events: states, timings, candidates, windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sheafline.functions.files import lookup
from sheafline.operators import candidates
from sheafline.plans.documents import METHODS
from sheafline.plans.registry import Registry
from sheafline.session import table
from sheafline.streaming import jobs

R = Registry()


@R.query(
    """SELECT request_id, count(*) AS posts, min(received_at) AT TIME ZONE 'UTC' AS first_post, max(received_at) AT TIME ZONE 'UTC' AS last_post, count(DISTINCT event_id) AS events, max(len(s3_fileid))::INTEGER AS files,
      CASE WHEN count(*) = 1 THEN 'single' WHEN count(DISTINCT s3_fileid::VARCHAR) = 1 THEN 'replay' ELSE 'conflict' END AS kind FROM parse_requests GROUP BY request_id"""
)
def repeated_requests(spark: SparkSession, root: str) -> DataFrame:
    """Requests posted again: the same files are a replay, others a conflict."""
    by = table(spark, root, "parse_requests").groupBy("request_id").agg(
        F.count("*").alias("posts"), F.min("received_at").alias("first_post"), F.max("received_at").alias("last_post"), F.countDistinct("event_id").alias("events"), F.max(F.size("s3_fileid")).alias("files"), F.countDistinct("s3_fileid").alias("sets")
    )
    return by.withColumn("kind", F.when(F.col("posts") == 1, "single").when(F.col("sets") == 1, "replay").otherwise("conflict")).drop("sets")


_ASKED = "SELECT request_id, max_by(s3_fileid, received_at) AS ids FROM parse_requests GROUP BY request_id"


@R.query(
    f"""SELECT request_id, n AS place, id AS s3_fileid, r.last_run, r.last_run IS NOT NULL AS done FROM (
      SELECT request_id, unnest(generate_series(1, len(ids))) AS n, unnest(ids) AS id FROM ({_ASKED})) q
      LEFT JOIN (SELECT s3_fileid, max(run_id) AS last_run FROM reconcile_stats GROUP BY 1) r ON r.s3_fileid = q.id"""
)
def results_in_order(spark: SparkSession, root: str) -> DataFrame:
    """The results of each request in the order in which its files were named."""
    asked = table(spark, root, "parse_requests").groupBy("request_id").agg(F.max_by("s3_fileid", "received_at").alias("ids"))
    each = asked.select("request_id", F.posexplode("ids").alias("p", "s3_fileid"))
    runs = table(spark, root, "reconcile_stats").groupBy("s3_fileid").agg(F.max("run_id").alias("last_run"))
    return each.join(runs, "s3_fileid", "left").select("request_id", (F.col("p") + 1).cast("long").alias("place"), "s3_fileid", "last_run", F.col("last_run").isNotNull().alias("done"))


@R.query(
    f"""SELECT request_id, count(*) AS files, count(r.s3_fileid) AS done, CASE WHEN count(r.s3_fileid) = 0 THEN 'queued' WHEN count(r.s3_fileid) < count(*) THEN 'processing' ELSE 'completed' END AS status
      FROM (SELECT request_id, unnest(list_distinct(ids)) AS id FROM ({_ASKED})) q LEFT JOIN (SELECT DISTINCT s3_fileid FROM reconcile_stats) r ON r.s3_fileid = q.id GROUP BY request_id"""
)
def request_progress(spark: SparkSession, root: str) -> DataFrame:
    asked = table(spark, root, "parse_requests").groupBy("request_id").agg(F.max_by("s3_fileid", "received_at").alias("ids"))
    each = asked.select("request_id", F.explode(F.array_distinct("ids")).alias("s3_fileid"))
    runs = table(spark, root, "reconcile_stats").select("s3_fileid", F.lit(1).alias("r")).distinct()
    by = each.join(runs, "s3_fileid", "left").groupBy("request_id").agg(F.count("*").alias("files"), F.count("r").alias("done"))
    return by.withColumn("status", F.when(F.col("done") == 0, "queued").when(F.col("done") < F.col("files"), "processing").otherwise("completed"))


@R.query(
    """WITH asked AS (SELECT id AS s3_fileid, min(received_at) AS asked_at FROM (SELECT unnest(s3_fileid) AS id, received_at FROM parse_requests) GROUP BY 1), run AS (SELECT s3_fileid, max(parsed_at) AS parsed_at FROM reconcile_stats GROUP BY 1)
    SELECT a.s3_fileid, a.asked_at AT TIME ZONE 'UTC' AS asked_at, CASE WHEN r.parsed_at IS NOT NULL THEN 'done' WHEN epoch(TIMESTAMP '2025-04-10 00:00:00') - epoch(a.asked_at::TIMESTAMP) > 4200 THEN 'lost' ELSE 'running' END AS state FROM asked a LEFT JOIN run r USING (s3_fileid)"""
)
def lost_tasks(spark: SparkSession, root: str) -> DataFrame:
    """Files asked for more than 4200 s before the fixed reference time without any result; a result is never overwritten."""
    asked = table(spark, root, "parse_requests").select(F.explode("s3_fileid").alias("s3_fileid"), "received_at").groupBy("s3_fileid").agg(F.min("received_at").alias("asked_at"))
    runs = table(spark, root, "reconcile_stats").groupBy("s3_fileid").agg(F.max("parsed_at").alias("parsed_at"))
    age = F.unix_timestamp(F.to_timestamp(F.lit("2025-04-10 00:00:00"))) - F.unix_timestamp("asked_at")
    state = F.when(F.col("parsed_at").isNotNull(), "done").when(age > 4200, "lost").otherwise("running")
    return asked.join(runs, "s3_fileid", "left").select("s3_fileid", "asked_at", state.alias("state"))


_COUNTS = ("rebuilt_blocks", "recovered_blocks", "mangled_formulas", "repaired_formulas", "decoded_formulas", "mangled_tables", "split_tokens", "duplicate_lines")


@R.query(
    f"""SELECT metric, count(value) AS runs, sum(value)::BIGINT AS total, max(value) AS most, round(median(value), 6) AS median FROM (UNPIVOT (SELECT {", ".join(f"{c}::BIGINT AS {c}" for c in _COUNTS)} FROM (
      SELECT *, row_number() OVER (PARTITION BY s3_fileid ORDER BY run_id DESC) r FROM reconcile_stats) WHERE r = 1) ON {", ".join(_COUNTS)} INTO NAME metric VALUE value) GROUP BY metric"""
)
def reconcile_totals(spark: SparkSession, root: str) -> DataFrame:
    """Counters of each file's last run, one row a counter."""
    last = table(spark, root, "reconcile_stats").groupBy("s3_fileid").agg(F.max_by(F.struct(*_COUNTS), "run_id").alias("c")).select("c.*")
    long = last.unpivot([], [F.col(c).cast("long").alias(c) for c in _COUNTS], "metric", "value").filter("value is not null")
    return long.groupBy("metric").agg(F.count("value").alias("runs"), F.sum("value").alias("total"), F.max("value").alias("most"), F.round(F.median("value"), 6).alias("median"))


@R.query(
    """SELECT s3_fileid, run_id, rebuilt_blocks, rebuilt_blocks - lag(rebuilt_blocks) OVER w AS change, epoch(parsed_at::TIMESTAMP) - epoch(lag(parsed_at::TIMESTAMP) OVER w) > 3600 AS late FROM reconcile_stats WINDOW w AS (PARTITION BY s3_fileid ORDER BY run_id)"""
)
def run_changes(spark: SparkSession, root: str) -> DataFrame:
    w = Window.partitionBy("s3_fileid").orderBy("run_id")
    gap = F.col("parsed_at").cast("double") - F.lag(F.col("parsed_at").cast("double")).over(w)
    return table(spark, root, "reconcile_stats").select("s3_fileid", "run_id", "rebuilt_blocks", (F.col("rebuilt_blocks") - F.lag("rebuilt_blocks").over(w)).alias("change"), (gap > 3600).alias("late"))


def _level() -> F.Column:
    return lookup(F.col("method"), {k: str(v[1]) for k, v in METHODS.items()}, "5").cast("int")


_LEVEL = f"CASE method {' '.join(f"WHEN '{k}' THEN {v[1]}" for k, v in METHODS.items())} ELSE 5 END"
_CANDIDATES = f"""SELECT *, round(least(1.0, greatest(0.0, round(CASE WHEN max(structured) OVER (PARTITION BY s3_fileid) AND NOT structured THEN (0.5 * confidence + 0.5 * completeness) * 0.55 ELSE 0.5 * confidence + 0.5 * completeness END, 9))), 8) AS score FROM (
      SELECT s3_fileid, level, sum(c)::BIGINT AS chars, round(sum(confidence * greatest(c, 1)) / sum(greatest(c, 1)), 4) AS confidence, round(least(1.0, sum(c) / (150 * greatest(count(DISTINCT page), 1))), 4) AS completeness, bool_or(st) AS structured FROM (
        SELECT s3_fileid, {_LEVEL} AS level, position.page AS page, confidence, length(regexp_replace(coalesce(text, ''), '[\\s\\p{{Z}}\\x{{85}}]', '', 'g')) + coalesce(length(structured_payload.table_html), 0) AS c, fragment_type IN ('table', 'formula') AS st FROM fragments) GROUP BY s3_fileid, level)"""


@R.query(_CANDIDATES.replace("SELECT *, round(", "SELECT s3_fileid, level, chars, round(confidence, 6) AS confidence, round(completeness, 6) AS completeness, structured, round(", 1))
def parse_candidates(spark: SparkSession, root: str) -> DataFrame:
    df = candidates.from_fragments(table(spark, root, "fragments"), _level())
    return df.select("s3_fileid", "level", "chars", F.round("confidence", 6).alias("confidence"), F.round("completeness", 6).alias("completeness"), "structured", "score")


@R.query(
    f"""SELECT s3_fileid, level, score, stop_level FROM (SELECT *, row_number() OVER (PARTITION BY s3_fileid ORDER BY keeps DESC, (structured AND keeps) DESC, score DESC, level) AS k FROM (
      SELECT *, min(CASE WHEN score >= 0.75 AND keeps THEN level END) OVER (PARTITION BY s3_fileid) AS stop_level FROM (
        SELECT *, chars >= 0.5 * max(chars) OVER (PARTITION BY s3_fileid ORDER BY level ROWS UNBOUNDED PRECEDING) AS keeps FROM ({_CANDIDATES}))) WHERE stop_level IS NULL OR level <= stop_level) WHERE k = 1"""
)
def best_candidate(spark: SparkSession, root: str) -> DataFrame:
    return candidates.choose(candidates.from_fragments(table(spark, root, "fragments"), _level()))


@R.query("SELECT time_bucket(INTERVAL 6 HOUR, ts::TIMESTAMP) AS window_start, event_type, count(*) AS events, round(sum(value), 4) AS value FROM events GROUP BY ALL")
def windowed_events(spark: SparkSession, root: str) -> DataFrame:
    """Tumbling windows in batch; the same aggregation as the stream's."""
    return jobs.windowed(jobs.with_time(table(spark, root, "events"))).select("window_start", "event_type", "events", F.round("value", 4).alias("value"))


@R.query("SELECT time_bucket(INTERVAL 6 HOUR, ts::TIMESTAMP) AS window_start, event_type, count(*) AS events, round(sum(value), 4) AS value FROM events GROUP BY ALL")
def streamed_events(spark: SparkSession, root: str) -> DataFrame:
    """The same windows from a stream over the table's file, with a watermark, run until all is read."""
    return jobs.run_windowed(spark, f"{root}/events.parquet").select("window_start", "event_type", "events", F.round("value", 4).alias("value"))


@R.query("SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY user_id, event_type")
def streamed_first_claims(spark: SparkSession, root: str) -> DataFrame:
    """The first event of each user and type from a stream with keyed state."""
    return jobs.run_first_claims(spark, f"{root}/events.parquet")


@R.query(
    """SELECT user_id, min(ts)::TIMESTAMP AS session_start, max(ts)::TIMESTAMP AS last_event, count(*) AS events FROM (SELECT *, sum(f) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (
      SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS f FROM events)) GROUP BY user_id, s"""
)
def event_sessions(spark: SparkSession, root: str) -> DataFrame:
    df = jobs.with_time(table(spark, root, "events"))
    by = df.groupBy("user_id", F.session_window("ts", "30 minutes").alias("w")).agg(F.min("ts").alias("session_start"), F.max("ts").alias("last_event"), F.count("*").alias("events"))
    return by.drop("w")
