"""Geometry of lines and blocks on pages, as windows and equi-joins on the page.

A page holds tens of lines and blocks, so page-keyed windows and page joins with a BETWEEN residual stay small whatever the corpus' size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GAP_HEIGHTS, LEAST_GAP = 0.85, 0.004
SLACK = 0.004


def height(box: str = "bbox") -> Column:
    return F.col(f"{box}.y2") - F.col(f"{box}.y1")


def paragraphs(lines: DataFrame) -> DataFrame:
    """Adds ``paragraph``: lines of a page in order; a gap above 0.85 of the median line height (0.004 at least), or another rotation, begins a new one.

    Lines without a place are left out.
    """
    df = lines.filter("bbox is not null")
    page = Window.partitionBy("s3_fileid", "page")
    order = page.orderBy(F.col("bbox.y1"), F.col("bbox.x1"), "line_id")
    df = df.withColumn("__m", F.median(height()).over(page))
    gap = F.col("bbox.y1") - F.lag("bbox.y2").over(order)
    fresh = F.when((gap > F.greatest(F.lit(LEAST_GAP), F.lit(GAP_HEIGHTS) * F.col("__m"))) | ~F.lag("rotation").over(order).eqNullSafe(F.col("rotation")) | F.lag("line_id").over(order).isNull(), 1).otherwise(0)
    return df.withColumn("__f", fresh).withColumn("paragraph", F.sum("__f").over(order)).drop("__m", "__f")


def page_turn(lines: DataFrame, share: float = 0.6) -> DataFrame:
    """(s3_fileid, page, turn, letters): the quarter turn that holds at least ``share`` of a page's letters, else 0."""
    quarter = F.pmod(F.floor(F.col("rotation") / 90 + F.lit(0.5)), F.lit(4)) * 90
    by = lines.filter("rotation is not null").groupBy("s3_fileid", "page", quarter.cast("int").alias("turn")).agg(F.sum(F.length(F.regexp_replace("text", r"[^\p{L}]", ""))).alias("n"))
    best = by.groupBy("s3_fileid", "page").agg(F.max_by("turn", F.struct("n", -F.col("turn"))).alias("t"), F.max("n").alias("m"), F.sum("n").alias("letters"))
    return best.select("s3_fileid", "page", F.when(F.col("m") >= share * F.col("letters"), F.col("t")).otherwise(0).alias("turn"), "letters")


def assign(lines: DataFrame, blocks: DataFrame) -> DataFrame:
    """(line_id, fragment_no): each placed line in the smallest block of its page that holds its centre (with a slack of 0.004); null where none does."""
    a = lines.filter("bbox is not null").select("line_id", "s3_fileid", "page", ((F.col("bbox.x1") + F.col("bbox.x2")) / 2).alias("cx"), ((F.col("bbox.y1") + F.col("bbox.y2")) / 2).alias("cy"))
    b = blocks.filter("position.bbox is not null").select("fragment_no", "s3_fileid", F.col("position.page").alias("page"), *[F.col(f"position.bbox.{c}").alias(c) for c in ("x1", "y1", "x2", "y2")])
    inside = F.col("cx").between(F.col("x1") - SLACK, F.col("x2") + SLACK) & F.col("cy").between(F.col("y1") - SLACK, F.col("y2") + SLACK)
    area = (F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1"))
    hit = a.join(b, ["s3_fileid", "page"]).filter(inside).groupBy("line_id").agg(F.min_by("fragment_no", F.struct(area, F.col("fragment_no"))).alias("fragment_no"))
    return a.select("line_id").join(hit, "line_id", "left")


def reading_text(lines: DataFrame) -> DataFrame:
    """(s3_fileid, page, text): a page's lines by rounded place."""
    placed = lines.filter("bbox is not null").select("s3_fileid", "page", "line_id", "text", F.round("bbox.y1", 3).alias("y"), F.round("bbox.x1", 3).alias("x"))
    return placed.groupBy("s3_fileid", "page").agg(F.expr("listagg(text, '\n') within group (order by y, x, line_id)").alias("text"))


def columns(lines: DataFrame, least_gap: float = 0.02) -> DataFrame:
    """(s3_fileid, page, column_no, x1, x2, lines): the corridors of a page: x intervals merged while they overlap or stand closer than ``least_gap``."""
    df = lines.filter("bbox is not null").select("s3_fileid", "page", "line_id", F.col("bbox.x1").alias("x1"), F.col("bbox.x2").alias("x2"))
    w = Window.partitionBy("s3_fileid", "page").orderBy("x1", "line_id")
    reach = F.max("x2").over(w.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(reach.isNull() | (F.col("x1") > reach + least_gap), 1).otherwise(0)
    df = df.withColumn("f", fresh).withColumn("column_no", F.sum("f").over(w))
    return df.groupBy("s3_fileid", "page", "column_no").agg(F.min("x1").alias("x1"), F.max("x2").alias("x2"), F.count("*").alias("lines"))


def better_reading(first: DataFrame, second: DataFrame, margin: float = 0.02, share: float = 0.5) -> DataFrame:
    """(line_id, rival): for lines of one reading, the line of another on the same page that overlaps it most (more than half of the lower height) and is
    surer by more than ``margin``."""
    a, b = first.filter("bbox is not null and confidence is not null").alias("a"), second.filter("bbox is not null and confidence is not null").alias("b")
    overlap = F.least("a.bbox.y2", "b.bbox.y2") - F.greatest("a.bbox.y1", "b.bbox.y1")
    low = F.least(F.col("a.bbox.y2") - F.col("a.bbox.y1"), F.col("b.bbox.y2") - F.col("b.bbox.y1"))
    pairs = a.join(b, (F.col("a.s3_fileid") == F.col("b.s3_fileid")) & (F.col("a.page") == F.col("b.page")) & (F.col("a.line_id") != F.col("b.line_id")))
    sure = pairs.filter((overlap > share * low) & (F.col("b.confidence") > F.col("a.confidence") + margin))
    return sure.groupBy(F.col("a.line_id").alias("line_id")).agg(F.max_by(F.col("b.line_id"), F.struct(F.round(overlap, 9), -F.col("b.line_id"))).alias("rival"))


def tile_boxes(sheets: DataFrame, across: int = 3, down: int = 2, overlap: float = 0.1) -> DataFrame:
    """(id, tile, x1, y1, x2, y2): overlapping tiles of each sheet, in sheet coordinates 0..1."""
    steps = F.explode(F.sequence(F.lit(0), F.lit(across * down - 1)))
    df = sheets.withColumn("tile", steps)
    col, row = F.col("tile") % across, F.floor(F.col("tile") / across)
    side = lambda k, n, s: F.greatest(F.lit(0.0), F.least(F.lit(1.0), (k + s) / n + F.lit((overlap if s else -overlap) / n)))
    return df.select(*sheets.columns, "tile", side(col, across, 0).alias("x1"), side(row, down, 0).alias("y1"), side(col, across, 1).alias("x2"), side(row, down, 1).alias("y2"))
