"""Benchmark decontamination with spaced seeds, in DataFrame functions only.

Each mask keeps some of the token positions of a span and ignores the others. Hashes of the kept tokens at every place
of the test items and of the documents join; each hit fixes an item and a shift, along which the tokens of document and
item are compared one by one. A window of WINDOW aligned tokens with at most SLACK different ones is a leak. The masks
together meet every such window (a test tries all placements), so no leak is missed.
Tokens are words with A-Z lower-cased. Items of MIN_WORDS to WINDOW - 1 tokens leak only whole and without a difference;
shorter items never do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import staged

MASKS = ("1110010111", "110101110001")
WINDOW = 15
SLACK = 2
MIN_WORDS = 8
BROADCAST_SEEDS = 2_000_000  # seeds of the test items that are broadcast at most (24 bytes each); beyond, seeds meet in a shuffle


def tokens(text) -> Column:
    """Lower-cased words; blanks at either end would leave an empty one."""
    low = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_remove(F.split(low, r"[\x20\x09-\x0D]+"), "")


def _seed(mask: str, number: int) -> Column:
    """Hash of the tokens of `words` that the mask keeps from index `at` on; null where the span leaves the text."""
    kept = [F.get("words", F.col("at") + F.lit(i)) for i, x in enumerate(mask) if x == "1"]
    return F.when(F.col("at") + F.lit(len(mask)) <= F.size("words"), F.xxhash64(F.lit(number), *kept))


def _seeds(rows: DataFrame, masks: list[str]) -> DataFrame:
    """rows(key, words) with a row for each place and mask: at, seed."""
    placed = rows.withColumn("at", F.explode(F.sequence(F.lit(0), F.size("words"))))  # the last place has no seed
    return placed.withColumn("seed", F.explode(F.array(*[_seed(m, i) for i, m in enumerate(masks)]))).where("seed is not null")


def _found(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, hash (64 bits of the text), item_id, n_aligned, n_same, first_word: of each document and item the leaks at all shifts."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), tokens(F.col("text").cast("string")).alias("words")).where(F.size("words") >= MIN_WORDS)
    items = staged(items.distinct().withColumn("item", F.monotonically_increasing_id()), "leak-items")  # an item_id may be null or come with several texts
    short = [r.n for r in items.where(F.size("words") < WINDOW).select(F.size("words").alias("n")).distinct().collect()]  # WINDOW values at most
    masks = list(MASKS) + ["1" * n for n in sorted(short)]
    long_item = F.size("words") >= WINDOW
    short_number = F.array_position(F.array(*[F.lit(len(m) if i >= len(MASKS) else -1) for i, m in enumerate(masks)]), F.size("words")) - 1
    seeds = items.withColumn("at", F.explode(F.sequence(F.lit(0), F.size("words") - 1)))
    seeds = seeds.select("item", "at", "words", F.posexplode(F.array(*[_seed(m, i) for i, m in enumerate(masks)])).alias("number", "seed"))
    seeds = seeds.where(F.col("seed").isNotNull() & ((long_item & (F.col("number") < len(MASKS))) | (~long_item & (F.col("number") == short_number))))
    seeds = staged(seeds.select("seed", "item", F.col("at").alias("item_at"), F.size("words").alias("item_size")), "leak-seeds")

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("hash"), tokens(F.col("text").cast("string")).alias("words"))
    shift = (F.col("at") - F.col("item_at")).alias("shift")
    # Of each hit, only the item's stretch of the document goes on.
    part = F.slice("words", F.greatest(F.col("shift"), F.lit(0)) + 1, F.least(F.col("item_size"), F.col("shift") + F.col("item_size"))).alias("part")
    if seeds.count() <= BROADCAST_SEEDS:
        hits = _seeds(rows, masks).join(F.broadcast(seeds), "seed").select("doc_id", "hash", "item", "item_size", "words", shift)
        items = F.broadcast(items)
    else:  # documents' seeds go without their words, which are fetched for what was hit
        met = _seeds(rows, masks).select("doc_id", "hash", "at", "seed").join(seeds, "seed").select("doc_id", "hash", "item", "item_size", shift).distinct()
        met = staged(met, "leak-hits").withColumn("doc_id", F.struct("doc_id"))  # structs with null meet
        hits = rows.withColumn("doc_id", F.struct("doc_id")).join(met, ["doc_id", "hash"]).withColumn("doc_id", F.col("doc_id.doc_id"))
    aligned = hits.select("doc_id", "hash", "item", "shift", part).dropDuplicates(["doc_id", "hash", "item", "shift"])
    compared = aligned.join(items, "item")
    same = F.zip_with("part", F.expr("slice(words, greatest(-shift, 0) + 1, size(part))"), lambda a, b: (a == b).cast("int"))
    compared = compared.select("doc_id", "hash", "item_id", F.size("words").alias("item_size"), F.greatest("shift", F.lit(0)).alias("first_word"), same.alias("same"))
    window = F.least(F.lit(WINDOW), F.col("item_size"))
    need = F.when(F.col("item_size") >= WINDOW, window - SLACK).otherwise(window)
    best = F.when(F.size("same") >= window, F.array_max(F.transform(F.sequence(F.lit(1), F.size("same") - window + 1), lambda i: F.aggregate(F.slice("same", i, window), F.lit(0), lambda x, y: x + y))))
    found = compared.withColumn("need", need).withColumn("best", best).where("best >= need")
    return found.select("doc_id", "hash", "item_id", F.size("same").alias("n_aligned"), F.aggregate("same", F.lit(0), lambda x, y: x + y).alias("n_same"), "first_word")


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, n_aligned, n_same, first_word: of each document and item the best leak at one shift.

    docs(doc_id, text), benchmark(item_id, text); other columns are ignored. Null and empty texts have no leak, and items
    without a text or with few words none. Rows with equal doc_id count as one document, and those without one as another;
    so do items. Documents without a leak have no row; empty tables have none.
    """
    found = _found(docs, benchmark)
    return found.groupBy("doc_id", "item_id").agg(F.max(F.struct("n_same", "n_aligned", -F.col("first_word"))).alias("top")).select("doc_id", "item_id", "top.n_aligned", "top.n_same", (-F.col("top.col3")).alias("first_word"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs whose text has no leak, with all their columns.

    Each row goes or stays by its own text, also where doc_ids are null or repeat. Null and empty texts stay.
    """
    dropped = staged(_found(docs, benchmark).select(F.col("doc_id").alias("_id"), F.col("hash").alias("_hash")).distinct(), "leak-docs")
    return docs.join(dropped, docs.doc_id.cast("long").eqNullSafe(dropped._id) & (F.xxhash64(docs.text.cast("string")) == dropped._hash), "left_anti")
