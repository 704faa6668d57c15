"""The corpus pipeline: STAGES in order, each a function (spark, docs, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickerloom.llm import decontaminate, dedup_exact, jaccard, mixing, quality
from tickerloom.llm.common import finished, table


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of docs that the quality classifier keeps, with all their columns.

    Each row goes by its own text: null, empty and blank texts go, repeated rows stay or go together. An empty table stays
    empty; further columns may have any names.
    """
    return quality.keep_good(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows with equal normalised texts, the one with the smallest doc_id, with all its columns.

    Null text counts as empty; of repeated rows one stays; a null doc_id stays only where all of its texts' rows have none.
    An empty table stays empty; further columns may have any names.
    """
    return dedup_exact.keep_first(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, the rows with the smallest doc_id, with all their columns.

    Null, empty and blank texts are near to nothing and stay. Rows are told by doc_id and text; those that repeat in both
    stay or go together. An empty table stays empty; further columns may have any names.
    """
    return jaccard.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of docs whose text has no passage of the benchmark table, with all their columns.

    Null, empty and blank texts stay; each row goes by its own text, whatever its doc_id. An empty table stays empty; an empty
    benchmark drops nothing; further columns may have any names.
    """
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: shard, slot, source, doc_ids, text of each fixed-length block, joined by index.

    Texts without words, null ones included, give nothing; a null source is a source, the last one; repeated rows and null
    doc_ids each have words of their own. An empty table gives an empty mix.
    """
    return mixing.Mix(docs).blocks(docs)


STAGES = [
    ("quality classifier", quality_filter),
    ("exact dedup", exact_dedup),
    ("n-gram jaccard join", near_dedup),
    ("benchmark decontamination", decontamination),
    ("source mix", source_mix),
]

#: The quality classifier is learned, and the mix is drawn: SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written and read again; what a stage staged for itself is removed once it is written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = finished(lambda: stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))  # noqa: B023
    return STAGES[-1][1](spark, docs, sf_dir)
