"""The intake cascade: path, size and type first, then what the text and the path say a document is.

Scoring is a projection over a pack of markers (see rules.py). A marker's role decides when it counts: a ``group`` marker counts only beside a ``base`` one, and neither
counts where a marker of a category that a designation yields to, or a ``bars`` marker, stands in the text. A path may not declare every category, and speaks with less weight.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from sheafline.functions.texts import bound
from sheafline.operators.rules import COUNT_CAP, REPEAT_CAP


@dataclass(frozen=True)
class Sign:
    category: str
    weight: float
    pattern: str
    role: str = ""


CATEGORIES = ("technical", "business", "correspondence", "personal")
#: Categories that a designation yields to, and those that a path may declare.
YIELDS = ("correspondence", "personal")
FROM_PATH = ("technical", "business", "personal")
PATH_WEIGHT = 0.85

#: A pack for lower-case texts and paths in Russian and English; patterns in the subset that both Java and RE2 read.
SIGNS: tuple[Sign, ...] = (
    Sign("technical", 2.5, r"[а-яa-z]{4}\.[0-9]{6}\.[0-9]{3}", "base"),
    Sign("technical", 1.5, r"сборочный чертеж|чертеж общего вида|assembly drawing|general arrangement", "group"),
    Sign("technical", 1.0, r"изм\. ?[0-9]|rev\. ?[0-9]", "group"),
    Sign("technical", 2.0, r"гост( р)? ?[0-9]|din [0-9]|iso [0-9]"),
    Sign("technical", 1.5, r"техническ(ие|ое) (условия|задание)|technical specification"),
    Sign("technical", 1.5, r"руководство по эксплуатации|паспорт изделия|operating manual"),
    Sign("technical", 1.0, r"мпа|mpa|°c|об/мин|rpm"),
    Sign("technical", 1.0, r"допуск|шероховатост|tolerance|roughness"),
    Sign("technical", 0.8, r"клапан|насос|подшипник|редуктор|valve|pump|bearing|gearbox"),
    Sign("technical", 0.8, r"давлени|зазор|pressure|clearance"),
    Sign("technical", 0.6, r"монтаж|настройк|assembly|adjust|чертёж|spec_"),
    Sign("business", 2.0, r"договор|контракт|contract|agreement"),
    Sign("business", 1.5, r"сч[её]т-фактур|накладн|invoice"),
    Sign("business", 1.5, r"коммерческое предложение|прайс|quotation|price list"),
    Sign("business", 1.0, r"поставщик|заказчик|supplier|customer"),
    Sign("business", 1.0, r"стоимост|оплат|total price|payment"),
    Sign("business", 0.8, r"протокол|приказ|регламент|reglament|procedure"),
    Sign("business", 0.6, r"отч[её]т|otchet|report"),
    Sign("correspondence", 2.0, r"уважаем|dear (sir|colleague|madam)"),
    Sign("correspondence", 1.5, r"с уважением|kind regards|sincerely"),
    Sign("correspondence", 1.0, r"прошу вас|просим|please find attached"),
    Sign("business", 0.5, r"исх\. ?№|в ответ на ваш|in reply to your", "bars"),
    Sign("personal", 2.5, r"паспортные данные|дата рождения|date of birth"),
    Sign("personal", 2.0, r"снилс|резюме|curriculum vitae"),
    Sign("personal", 1.5, r"заявление на отпуск|больничный|family photo"),
)


def counted(text: Column, signs: tuple[Sign, ...] = SIGNS) -> Column:
    """How often each marker stands in a lower-case text, capped: an array in the order of the pack."""
    return F.array(*[F.least(F.regexp_count(text, F.lit(s.pattern)), F.lit(COUNT_CAP)) for s in signs])


def match(counts: Column, allowed: tuple[str, ...] = CATEGORIES, signs: tuple[Sign, ...] = SIGNS) -> Column:
    """struct(category, confidence, score, hits) from the counts of ``counted``; category null if nothing matches."""
    categories = [c for c in CATEGORIES if c in allowed]

    def any_of(n: Column, keep: Callable[[Sign], bool]) -> Column:
        return F.arrays_overlap(F.array(F.lit(True)), F.array(*[F.get(n, F.lit(i)) > 0 for i, s in enumerate(signs) if keep(s)]))

    def values(n: Column) -> Column:
        opened = any_of(n, lambda s: s.role == "base") & ~any_of(n, lambda s: s.category in YIELDS or s.role == "bars")

        def worth(i: int, s: Sign, o: Column) -> Column:
            k = F.get(n, F.lit(i))
            return F.when((k > 0) & o if s.role in ("base", "group") else k > 0, s.weight * F.least(F.lit(REPEAT_CAP), 1.0 + F.log2(k))).otherwise(F.lit(0.0))

        return bound(opened, lambda o: F.array(*[worth(i, s, o) for i, s in enumerate(signs)]))

    def totals(v: Column) -> Column:
        out = []
        for rank, c in enumerate(categories):
            mine = [F.get(v, F.lit(i)) for i, s in enumerate(signs) if s.category == c]
            hits = [F.when(x > 0, 1).otherwise(0) for x in mine]
            out.append(F.struct(F.round(sum(mine[1:], mine[0]), 9).alias("score"), F.lit(-rank).alias("rank"), F.lit(c).alias("category"), sum(hits[1:], hits[0]).alias("hits")))
        return F.sort_array(F.array(*out), asc=False)

    def verdict(ranked: Column) -> Column:
        best, second = F.get(ranked, F.lit(0)), F.get(ranked, F.lit(1))["score"]
        confidence = F.round(F.least(F.lit(0.95), 0.45 + 0.40 * (best["score"] - second) / best["score"] + 0.05 * F.least(best["hits"], F.lit(3))), 3)
        return F.when(best["score"] > 0, F.struct(best["category"].alias("category"), confidence.alias("confidence"), best["score"].alias("score"), best["hits"].alias("hits")))

    return bound(bound(values(counts), totals), verdict)


def sql_match(table: str, key: str, text: str, allowed: tuple[str, ...] = CATEGORIES, signs: tuple[Sign, ...] = SIGNS) -> str:
    """The same as SQL: (key, category, confidence, score, hits), one row a record."""
    n = ", ".join(f"least(len(regexp_extract_all({text}, '{s.pattern}')), {COUNT_CAP}) AS n{i}" for i, s in enumerate(signs))
    base = " OR ".join(f"n{i} > 0" for i, s in enumerate(signs) if s.role == "base")
    bars = " OR ".join(f"n{i} > 0" for i, s in enumerate(signs) if s.category in YIELDS or s.role == "bars")
    v = ", ".join(f"CASE WHEN n{i} > 0{' AND opened' if s.role in ('base', 'group') else ''} THEN {s.weight} * least({REPEAT_CAP}, 1.0 + log2(n{i})) ELSE 0.0 END AS v{i}" for i, s in enumerate(signs))
    rows = []
    for rank, c in enumerate(x for x in CATEGORIES if x in allowed):
        mine = [i for i, s in enumerate(signs) if s.category == c]
        rows.append(f"SELECT {key}, '{c}' AS category, {rank} AS rank, round({' + '.join(f'v{i}' for i in mine)}, 9) AS score, {' + '.join(f'(v{i} > 0)::INT' for i in mine)} AS hits FROM v")
    return f"""(WITH n AS (SELECT {key}, {n} FROM {table}), o AS (SELECT *, ({base}) AND NOT ({bars}) AS opened FROM n), v AS (SELECT {key}, {v} FROM o),
      c AS ({" UNION ALL ".join(rows)}),
      r AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY score DESC, rank) AS k, lead(score) OVER (PARTITION BY {key} ORDER BY score DESC, rank) AS second FROM c)
      SELECT {key}, CASE WHEN score > 0 THEN category END AS category, CASE WHEN score > 0 THEN round(least(0.95, 0.45 + 0.40 * (score - second) / score + 0.05 * least(hits, 3)), 3) END AS confidence, CASE WHEN score > 0 THEN score END AS score, CASE WHEN score > 0 THEN hits END AS hits FROM r WHERE k = 1)"""
