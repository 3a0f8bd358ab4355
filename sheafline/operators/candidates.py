"""Ranking of competing parse results: score, early stop, best candidate.

Candidates of a file come from strategies of rising cost. The score is the mean of confidence (weighted by text) and completeness, times 0.55 where other
candidates have structure and this one has none. The cheapest candidate that is good enough stops the ladder; the best among those up to the stop wins
by (keeps enough text, has structure and keeps, score), the cheaper one on a tie.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PENALTY, CHARS_PER_PAGE, GOOD, KEEP = 0.55, 150, 0.75, 0.5


def score(confidence: Column, completeness: Column, structured: Column, expected: Column) -> Column:
    value = F.lit(0.5) * confidence + F.lit(0.5) * completeness
    return F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.when(expected & ~structured, value * PENALTY).otherwise(value))), 8)


def from_fragments(fragments: DataFrame, levels: Column) -> DataFrame:
    """(s3_fileid, level, chars, confidence, completeness, structured, score): one candidate a file and strategy level."""
    chars = F.length(F.regexp_replace(F.coalesce("text", F.lit("")), r"(?U)\s+", "")) + F.coalesce(F.length("structured_payload.table_html"), F.lit(0))
    df = fragments.select("s3_fileid", levels.alias("level"), F.col("position.page").alias("page"), "confidence", chars.alias("c"), F.col("fragment_type").isin("table", "formula").alias("st"))
    by = df.groupBy("s3_fileid", "level").agg(
        F.sum("c").alias("chars"),
        F.round(F.sum(F.col("confidence") * F.greatest("c", F.lit(1))) / F.sum(F.greatest("c", F.lit(1))), 4).alias("confidence"),
        F.round(F.least(F.lit(1.0), F.sum("c") / (CHARS_PER_PAGE * F.greatest(F.countDistinct("page"), F.lit(1)))), 4).alias("completeness"),
        F.max("st").alias("structured"),
    )
    expected = F.max("structured").over(Window.partitionBy("s3_fileid"))
    return by.withColumn("score", score(F.col("confidence"), F.col("completeness"), F.col("structured"), expected))


def choose(candidates: DataFrame) -> DataFrame:
    """(s3_fileid, level, score, stop_level): the chosen candidate of each file, and the level at which the ladder stopped (null: never)."""
    w = Window.partitionBy("s3_fileid")
    most = F.max("chars").over(w.orderBy("level").rowsBetween(Window.unboundedPreceding, 0))
    df = candidates.withColumn("keeps", F.col("chars") >= KEEP * most).withColumn("good", (F.col("score") >= GOOD) & F.col("keeps"))
    df = df.withColumn("stop_level", F.min(F.when(F.col("good"), F.col("level"))).over(w)).filter(F.col("stop_level").isNull() | (F.col("level") <= F.col("stop_level")))
    rank = F.struct("keeps", (F.col("structured") & F.col("keeps")).alias("sk"), "score", (-F.col("level")).alias("cheap"))
    best = df.groupBy("s3_fileid").agg(F.max_by(F.struct("level", "score", "stop_level"), rank).alias("b"))
    return best.select("s3_fileid", "b.*")


def covered(candidates: DataFrame, read: DataFrame, source: DataFrame) -> DataFrame:
    """Adds ``coverage`` and ``complete``: the share of a file's source pages that a candidate read.

    ``read``: (s3_fileid, level, page); ``source``: (s3_fileid, page). A file whose source pages are not known has coverage 1 and is never complete.
    """
    have = source.filter("page > 0").distinct().withColumn("known", F.lit(True))
    totals = have.groupBy("s3_fileid").agg(F.count("*").alias("source_pages"))
    hits = read.distinct().join(have, ["s3_fileid", "page"], "left").groupBy("s3_fileid", "level").agg(F.count("known").alias("hits"), F.count_if(F.col("known").isNull()).alias("beyond"))
    df = candidates.join(totals, "s3_fileid", "left").join(hits, ["s3_fileid", "level"], "left")
    share = F.when(F.col("source_pages").isNull(), F.lit(1.0)).otherwise(F.round(F.coalesce("hits", F.lit(0)) / F.col("source_pages"), 6))
    whole = F.coalesce((F.col("hits") == F.col("source_pages")) & (F.col("beyond") == 0), F.lit(False))
    return df.withColumn("coverage", share).withColumn("complete", whole).drop("source_pages", "hits", "beyond")


def climb(candidates: DataFrame, fallback: Column) -> DataFrame:
    """(s3_fileid, level, score, coverage, stop_level, tried, fallback_won, reserve_level): the ladder from the cheapest level up.

    A candidate is scored without structure expected until a structural one was seen. The first structural one that is good enough, keeps half of the best
    fallback's text so far and covers all pages stops the ladder. Of those tried the best is chosen by (keeps text, coverage, structural and keeps, score), measured against the best fallback of
    all tried; the cheaper one wins a tie. A fallback that wins although a structural candidate was seen is scored again, with structure expected; ``reserve_level`` is the longest fallback
    where a structural candidate that keeps too little was chosen.
    """
    w = Window.partitionBy("s3_fileid")
    upto, before = w.orderBy("level").rowsBetween(Window.unboundedPreceding, 0), w.orderBy("level").rowsBetween(Window.unboundedPreceding, -1)
    df = candidates.withColumn("fallback", fallback)
    df = df.withColumn("seen", F.coalesce(F.max(~F.col("fallback")).over(before), F.lit(False)))
    df = df.withColumn("value", score(F.col("confidence"), F.col("completeness"), ~F.col("fallback"), F.col("seen")))
    df = df.withColumn("most", F.coalesce(F.max(F.when(F.col("fallback"), F.col("chars"))).over(upto), F.lit(0)))
    stops = ~F.col("fallback") & (F.col("value") >= GOOD) & (F.col("chars") >= KEEP * F.col("most")) & F.col("complete")
    df = df.withColumn("stop_level", F.min(F.when(stops, F.col("level"))).over(w)).filter(F.col("stop_level").isNull() | (F.col("level") <= F.col("stop_level")))
    df = df.withColumn("most", F.coalesce(F.max(F.when(F.col("fallback"), F.col("chars"))).over(w), F.lit(0))).withColumn("keeps", F.col("chars") >= KEEP * F.col("most"))
    rank = F.struct("keeps", "coverage", (~F.col("fallback") & F.col("keeps")).alias("sk"), "value", (-F.col("level")).alias("cheap"))
    longest = F.max_by(F.when(F.col("fallback"), F.col("level")), F.when(F.col("fallback"), F.struct("chars", "value", (-F.col("level")).alias("cheap"))))
    best = df.groupBy("s3_fileid").agg(F.max_by(F.struct("level", "value", "coverage", "stop_level", "fallback", "keeps", "confidence", "completeness"), rank).alias("b"), F.count("*").alias("tried"), F.max(~F.col("fallback")).alias("structural"), longest.alias("longest"))
    won = F.col("b.fallback") & F.col("structural")
    value = F.when(won, score(F.col("b.confidence"), F.col("b.completeness"), F.lit(False), F.lit(True))).otherwise(F.col("b.value"))
    return best.select("s3_fileid", "b.level", value.alias("score"), "b.coverage", "b.stop_level", "tried", won.alias("fallback_won"), F.when(~F.col("b.fallback") & ~F.col("b.keeps"), F.col("longest")).alias("reserve_level"))
