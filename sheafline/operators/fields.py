"""Drawing fields: classification of annotation texts, tolerances, duplicates, signs between readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafline.functions.texts import sign_key

# What an annotation is, tried in this order.
KINDS: tuple[tuple[str, str], ...] = (
    ("thread", r"^\s*[MМ]\d+([.,]\d+)?([xх×]\d+([.,]\d+)?)?"),
    ("radius", r"^\s*R\s?\d"),
    ("roughness", r"^\s*R[az]\s?\d|√"),
    ("size", r"^\s*[⌀Øø]?\s?\d+([.,]\d+)?\s*(±|[+-]\d|мм|mm|°|$)"),
    ("material", r"(?i)(сталь|латун|бронз|чугун|алюмин|steel|brass|bronze|iron|alumin)"),
    ("designation", r"[А-Я]{4}\.\d{6}\.\d{3}"),
    ("tolerance", r"±|[Hh]\d{1,2}\b"),
)


def kind(text: Column) -> Column:
    out = F.lit("note")
    for name, pattern in reversed(KINDS):
        out = F.when(text.rlike("(?u)" + pattern), name).otherwise(out)
    return out


def tolerance(text: Column) -> Column:
    """The plus-minus part, or a fit such as H7; null where there is none."""
    pm, fit = F.regexp_extract(text, r"±\s?(\d+(?:[.,]\d+)?)", 1), F.regexp_extract(text, r"\d([HhgfeEk]\d{1,2})(?:\W|$)", 1)
    return F.when(pm != "", F.concat(F.lit("±"), pm)).when(fit != "", fit)


def dedupe(fields: DataFrame, group: list[str], value: str, confidence: str, position: str) -> DataFrame:
    """Of equal values (trimmed, case folded) in a group the surest row, placed where the value was first seen."""
    key = F.lower(F.trim(value))
    best = fields.groupBy(*group, key.alias("key")).agg(
        F.max_by(F.struct(*fields.columns), F.struct(F.coalesce(confidence, F.lit(-1.0)), -F.col(position))).alias("r"), F.min(position).alias("first_position"), F.count("*").alias("seen")
    )
    return best.select("r.*", "first_position", "seen")


def merge_multisets(parts: DataFrame, group: list[str], part: str, line: str, position: str) -> DataFrame:
    """Lines of overlapping parts merged: each line as often as the part that holds it most often; the first part that reaches an occurrence gives its place.

    An occurrence number within the part turns the multiset union into a plain first-wins aggregation.
    """
    from pyspark.sql import Window

    key = sign_key(F.col(line))
    nth = F.row_number().over(Window.partitionBy(*group, part, key).orderBy(position))
    numbered = parts.withColumn("__nth", nth).withColumn("__key", key)
    return numbered.groupBy(*group, "__key", "__nth").agg(F.min_by(line, F.struct(part, position)).alias(line), F.min(F.struct(part, position)).alias("first")).select(*group, line, F.col(f"first.{part}").alias(part), F.col(f"first.{position}").alias(position))
