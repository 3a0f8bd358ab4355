"""Rule scoring: packs of weighted patterns, scored in one projection without a join.

A pack is data. Each marker adds ``weight * min(3, 1 + log2(count))`` to its category, counts capped at 16; categories are
ranked by score, then by their fixed order; confidence grows with the lead over the second category and with the number of markers.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COUNT_CAP, REPEAT_CAP = 16, 3.0


@dataclass(frozen=True)
class Marker:
    category: str
    weight: float
    pattern: str
    title: str


#: A pack for technical documents in Russian and English; patterns in the subset that both Java and RE2 read.
PACK: tuple[Marker, ...] = (
    Marker("technical", 2.0, r"[А-Я]{4}\.[0-9]{6}\.[0-9]{3}", "designation"),
    Marker("technical", 1.0, r"МПа|MPa|°C", "unit"),
    Marker("technical", 0.5, r"зазор|давлени|clearance|pressure", "parameter"),
    Marker("instruction", 1.5, r"Откройте|Закройте|Проверьте|Снимите|Смажьте|Open |Close |Check |Remove |Grease ", "imperative"),
    Marker("instruction", 1.0, r"Инструкция|Instruction", "title"),
    Marker("regulation", 1.5, r"предусматривает|обусловлива|определяет|determines|entails|requires", "provision"),
    Marker("regulation", 1.0, r"Регламент|Procedure", "title"),
    Marker("list", 1.0, r"(?m)^[0-9]+[.) ]", "numbered line"),
)
ORDER = ("technical", "instruction", "regulation", "list")


def marker_value(text: Column, m: Marker) -> Column:
    n = F.least(F.regexp_count(text, F.lit(m.pattern)), F.lit(COUNT_CAP))
    return F.when(n > 0, F.lit(m.weight) * F.least(F.lit(REPEAT_CAP), F.lit(1.0) + F.log2(n))).otherwise(F.lit(0.0))


def score(df: DataFrame, text: str, pack: tuple[Marker, ...] = PACK, order: tuple[str, ...] = ORDER, out: str = "rules") -> DataFrame:
    """Adds ``out`` = struct(category, confidence, marker, score, second, hits). Texts without any marker, or null, have category null and confidence 0."""
    t = F.coalesce(F.col(text), F.lit(""))
    values = df.withColumn("__v", F.array(*[F.struct(F.lit(m.category).alias("c"), F.lit(m.title).alias("t"), marker_value(t, m).alias("v")) for m in pack]))

    def total(c: str) -> Column:
        mine = F.filter("__v", lambda x: x["c"] == c)
        lead = F.array_max(F.transform(mine, lambda x: F.struct(x["v"].alias("v"), x["t"].alias("t"))))
        return F.struct(
            F.aggregate(mine, F.lit(0.0), lambda a, x: a + x["v"]).alias("score"),
            F.lit(-order.index(c)).alias("rank"),
            F.lit(c).alias("category"),
            lead["t"].alias("marker"),
            F.size(F.filter(mine, lambda x: x["v"] > 0)).alias("hits"),
        )

    ranked = values.withColumn("__r", F.sort_array(F.array(*[total(c) for c in order]), asc=False))
    best, second = F.col("__r")[0], F.col("__r")[1]["score"]
    found = best["score"] > 0
    confidence = F.least(F.lit(0.95), F.lit(0.45) + F.lit(0.40) * (best["score"] - second) / best["score"] + F.lit(0.05) * F.least(best["hits"], F.lit(3)))
    result = F.struct(
        F.when(found, best["category"]).alias("category"),
        F.when(found, confidence).otherwise(F.lit(0.0)).alias("confidence"),
        F.when(found, best["marker"]).alias("marker"),
        best["score"].alias("score"),
        second.alias("second"),
        best["hits"].alias("hits"),
    )
    return ranked.withColumn(out, result).drop("__v", "__r")


def scores(df: DataFrame, text: str, pack: tuple[Marker, ...] = PACK, order: tuple[str, ...] = ORDER) -> DataFrame:
    """The rows of ``df``, one for each category, with ``category``, ``score`` and ``hits`` (markers that count), summed inside the row."""
    values = df.withColumn("__v", F.array(*[F.struct(F.lit(m.category).alias("c"), marker_value(F.col(text), m).alias("v")) for m in pack]))

    def total(c: str) -> Column:
        mine = F.filter("__v", lambda x: (x["c"] == c) & (x["v"] > 0))
        return F.struct(F.lit(c).alias("category"), F.aggregate(mine, F.lit(0.0), lambda a, x: a + x["v"]).alias("score"), F.size(mine).alias("hits"))

    return values.withColumn("__c", F.explode(F.array(*[total(c) for c in order]))).select(*df.columns, "__c.category", "__c.score", "__c.hits")


def discount(confidence: Column, inspected: Column, enough: float = 0.2, least: float = 0.1) -> Column:
    """Confidence lowered where less than ``enough`` of a document was looked at, to a tenth at most."""
    return F.when(inspected < enough, confidence * F.greatest(F.lit(least), inspected / enough)).otherwise(confidence)


def sql_scores(table: str, id_col: str, text: str, pack: tuple[Marker, ...] = PACK) -> str:
    """The same scores as SQL: one row a record and category."""
    parts = []
    for c in ORDER:
        terms = []
        for m in (m for m in pack if m.category == c):
            n = f"least(len(regexp_extract_all(coalesce({text}, ''), '{m.pattern}')), {COUNT_CAP})"
            terms.append(f"CASE WHEN {n} > 0 THEN {m.weight} * least({REPEAT_CAP}, 1.0 + log2({n})) ELSE 0.0 END")
        hits = " + ".join(f"CASE WHEN len(regexp_extract_all(coalesce({text}, ''), '{m.pattern}')) > 0 THEN 1 ELSE 0 END" for m in pack if m.category == c)
        parts.append(f"SELECT {id_col}, '{c}' AS category, {ORDER.index(c)} AS rank, {' + '.join(terms)} AS score, {hits} AS hits FROM {table}")
    return " UNION ALL ".join(parts)
