"""Outside services (recognition, layout, vision, remote classification) behind one interface.

A provider takes the content of a batch of inputs and gives one JSON string (or None) for each. Where none is configured the stub answers None, and the
operators go on with their own rules. Calls run in Arrow batches where the data lies; equal inputs are sent once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Provider = Callable[[Sequence[bytes]], Sequence[str | None]]


def stub(inputs: Sequence[bytes]) -> list[str | None]:
    """Answers nothing, as an unset endpoint does."""
    return [None] * len(inputs)


def ask(df: DataFrame, content: str, provider: Provider = stub, out: str = "answer") -> DataFrame:
    """Adds ``out``: the provider's answer for each row. Distinct contents are asked once, by digest; null content is not asked."""

    @F.pandas_udf(T.StringType())
    def call(data: pd.Series) -> pd.Series:
        return pd.Series(list(provider([bytes(x) for x in data])), dtype=object)

    digest = F.sha2(content, 256)
    asked = df.filter(F.col(content).isNotNull()).groupBy(digest.alias("__d")).agg(F.any_value(content).alias("__c"))
    answers = asked.select("__d", call("__c").alias(out))
    return df.drop(out).withColumn("__d", digest).join(answers, "__d", "left").drop("__d")


def answer_or(answer: Column, schema: str, rules: Column) -> Column:
    """The provider's answer read as ``schema``, or what the rules say where there is none."""
    return F.coalesce(F.from_json(answer, schema), rules)
