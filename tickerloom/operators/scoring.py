"""Batch scoring of texts with a pluggable scorer, and a fallback where it fails."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.functions.text import BEARISH, BULLISH, hits

SCORES = "positive double, negative double, neutral double"


def lexicon_scores(text: Column) -> dict[str, Column]:
    """Shares by the phrases found, each side smoothed by one; all in the JVM."""
    up, down = hits(text, BULLISH), hits(text, BEARISH)
    total = up + down + 2
    return {"positive": up / total, "negative": down / total, "neutral": F.lit(2) / total}


def batch_scorer(load: Callable[[], Callable[[list[str]], list[tuple[float, float, float] | None]]], size: int = 32):
    """A pandas UDF over texts. `load` runs once for each task and gives the scorer of a batch; a text it fails on is null."""

    @F.pandas_udf(SCORES)
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = load()
        for texts in parts:
            rows = []
            for a in range(0, len(texts), size):
                rows += model(["" if x is None else x for x in texts.iloc[a : a + size]])
            yield pd.DataFrame([(None, None, None) if r is None else r for r in rows], columns=["positive", "negative", "neutral"], dtype=float)

    return score


def with_label(df: DataFrame) -> DataFrame:
    """label and confidence of the columns positive, negative and neutral."""
    top = F.greatest("positive", "negative", "neutral")
    return df.withColumn("label", F.when(F.col("positive") == top, "positive").when(F.col("negative") == top, "negative").otherwise("neutral")).withColumn("confidence", top)


def scored(texts: DataFrame, scorer=None, text: str = "text") -> DataFrame:
    """texts with shares, label, confidence and `scored_by`. Where the scorer gives null, the lexicon's shares stand in."""
    lexicon = lexicon_scores(F.col(text))
    if scorer is None:
        return with_label(texts.withColumns(lexicon).withColumn("scored_by", F.lit("lexicon")))
    both = texts.withColumn("_s", scorer(F.col(text)))
    failed = F.col("_s.positive").isNull() | F.isnan("_s.positive")
    both = both.withColumns({k: F.when(failed, c).otherwise(F.col(f"_s.{k}")) for k, c in lexicon.items()})
    return with_label(both.withColumn("scored_by", F.when(failed, "lexicon").otherwise("model")).drop("_s"))
