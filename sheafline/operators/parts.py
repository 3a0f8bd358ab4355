"""Label tails: a text that ends in a label (``Имеется:``, ``4.1.``) joined with the text that follows it on the page.

Chains are islands: a fragment continues its forerunner's island if that forerunner ends in a label and both stand on the same page and
sheet of a file, and not across two named sections. Islands are found with windows over one page, so no file is one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Signs that a label ends with.
LABEL_ENDS = (":", "：", "—", "–")


def ends_in_label(text: Column) -> Column:
    """Whether the last line of a text names something and stops: it ends with a colon or dash, or is nothing but an item number."""
    trimmed = F.rtrim(F.regexp_replace(text, r"\s+\z", ""))
    last = F.trim(F.substring_index(trimmed, "\n", -1))
    bare = F.rtrim(F.rtrim(last, F.lit(")")), F.lit("."))
    # an item number: up to three digits a level, closed by a period or bracket
    item = (bare != last) & (F.translate(bare, "0123456789.", "") == "") & ~F.exists(F.split(bare, r"\."), lambda x: ~F.length(x).between(1, 3))
    # a lone dash is no label
    named = reduce(lambda x, y: x | y, [last.endswith(e) for e in LABEL_ENDS]) & (F.length(last) > 1)
    return named | item


def join_label_tails(fragments: DataFrame) -> DataFrame:
    """(s3_fileid, page, fragment_no, text, joined, confidence, completeness): one row a joined text, named by its first fragment."""
    df = fragments.filter("fragment_type = 'text' and trim(text) <> ''").select(
        "fragment_no", "s3_fileid", F.col("position.page").alias("page"), F.coalesce("position.sheet", F.lit("")).alias("sheet"), F.col("position.order").alias("ord"), "section_title", "text", "confidence", "completeness"
    )
    w = Window.partitionBy("s3_fileid", "page", "sheet").orderBy("ord", "fragment_no")
    before, section = F.lag("text").over(w), F.lag("section_title").over(w)
    goes_on = ends_in_label(before) & (section.isNull() | F.col("section_title").isNull() | (section == F.col("section_title")))
    df = df.withColumn("fresh", F.when(F.coalesce(goes_on, F.lit(False)), 0).otherwise(1)).withColumn("island", F.sum("fresh").over(w))
    return df.groupBy("s3_fileid", "page", "sheet", "island").agg(
        F.min_by("fragment_no", F.struct("ord", "fragment_no")).alias("fragment_no"),
        F.expr("listagg(text, '\n') within group (order by ord, fragment_no)").alias("text"),
        F.count("*").alias("joined"),
        F.min("confidence").alias("confidence"),
        F.min("completeness").alias("completeness"),
    ).drop("sheet", "island")
