"""Queries of the strategy ladder over the parsed fragments of each level."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafline.operators import candidates
from sheafline.plans.registry import Registry
from sheafline.plans.state import _CANDIDATES, _LEVEL, _level
from sheafline.session import table

R = Registry()

#: Levels that recognise a page as flat text.
FALLBACK = (4,)

_COVERED = f"""(WITH c AS ({_CANDIDATES}), s AS (SELECT DISTINCT s3_fileid, page FROM text_lines WHERE page > 0), t AS (SELECT s3_fileid, count(*) AS n FROM s GROUP BY 1),
      r AS (SELECT DISTINCT s3_fileid, {_LEVEL} AS level, position.page AS page FROM fragments),
      h AS (SELECT r.s3_fileid, r.level, count(s.page) AS hits, count(*) - count(s.page) AS beyond FROM r LEFT JOIN s ON r.s3_fileid = s.s3_fileid AND r.page = s.page GROUP BY ALL)
    SELECT c.*, CASE WHEN n IS NULL THEN 1.0 ELSE round(coalesce(hits, 0) / n, 6) END AS coverage, coalesce(hits = n AND beyond = 0, FALSE) AS complete FROM c LEFT JOIN t USING (s3_fileid) LEFT JOIN h USING (s3_fileid, level))"""


def _covered(spark: SparkSession, root: str) -> DataFrame:
    fragments = table(spark, root, "fragments")
    read = fragments.select("s3_fileid", _level().alias("level"), F.col("position.page").alias("page"))
    return candidates.covered(candidates.from_fragments(fragments, _level()), read, table(spark, root, "text_lines").select("s3_fileid", "page"))


@R.query(f"SELECT s3_fileid, level, coverage, complete FROM {_COVERED}")
def unit_coverage(spark: SparkSession, root: str) -> DataFrame:
    """How much of a file's pages (those of its lines) each level's result covers."""
    return _covered(spark, root).select("s3_fileid", "level", "coverage", "complete")


_MIXED = "round(least(1.0, greatest(0.0, round(CASE WHEN {e} AND {f} THEN (0.5 * confidence + 0.5 * completeness) * 0.55 ELSE 0.5 * confidence + 0.5 * completeness END, 9))), 8)"


@R.query(
    f"""WITH a AS (SELECT *, level IN ({", ".join(map(str, FALLBACK))}) AS fallback FROM {_COVERED}),
      b AS (SELECT *, coalesce(bool_or(NOT fallback) OVER (PARTITION BY s3_fileid ORDER BY level ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), FALSE) AS seen,
        coalesce(max(CASE WHEN fallback THEN chars END) OVER (PARTITION BY s3_fileid ORDER BY level ROWS UNBOUNDED PRECEDING), 0) AS most FROM a),
      c AS (SELECT *, {_MIXED.format(e="seen", f="fallback")} AS value FROM b),
      d AS (SELECT *, min(CASE WHEN NOT fallback AND value >= 0.75 AND chars >= 0.5 * most AND complete THEN level END) OVER (PARTITION BY s3_fileid) AS stop_level FROM c),
      e AS (SELECT *, coalesce(max(CASE WHEN fallback THEN chars END) OVER (PARTITION BY s3_fileid), 0) AS top FROM d WHERE stop_level IS NULL OR level <= stop_level),
      f AS (SELECT *, chars >= 0.5 * top AS keeps FROM e),
      g AS (SELECT *, count(*) OVER (PARTITION BY s3_fileid) AS tried, bool_or(NOT fallback) OVER (PARTITION BY s3_fileid) AS structural, row_number() OVER (PARTITION BY s3_fileid ORDER BY keeps DESC, coverage DESC, (NOT fallback AND keeps) DESC, value DESC, level) AS k,
        first_value(CASE WHEN fallback THEN level END) OVER (PARTITION BY s3_fileid ORDER BY fallback DESC, chars DESC, value DESC, level) AS longest FROM f)
    SELECT s3_fileid, level, CASE WHEN fallback AND structural THEN {_MIXED.format(e="TRUE", f="TRUE")} ELSE value END AS score, coverage, stop_level, tried, fallback AND structural AS fallback_won, CASE WHEN NOT fallback AND NOT keeps THEN longest END AS reserve_level FROM g WHERE k = 1"""
)
def ladder_choice(spark: SparkSession, root: str) -> DataFrame:
    """The ladder's choice for each file, with early stop, coverage, and the rescoring of a fallback that won."""
    return candidates.climb(_covered(spark, root), F.col("level").isin(*FALLBACK))
