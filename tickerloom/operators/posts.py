"""Posts as they come from a stream of JSON records, and the symbols that they are about."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.functions.text import KEYWORDS, cashtags

#: A record as the source gives it.
RECORD = "id bigint, text string, created_at timestamp, lang string, public_metrics struct<retweet_count:bigint,like_count:bigint,reply_count:bigint,quote_count:bigint>, matching_rules array<struct<id:string,tag:string>>"
METRICS = ("retweet_count", "like_count", "reply_count", "quote_count")
#: What a cashtag, a rule's tag of either kind and a keyword count, in tenths.
WEIGHTS = {"cashtag": 10, "cashtag_": 9, "company_": 7, "keyword": 5}


def _pattern(words: list[str]) -> str:
    """A pattern that takes the longest of the words at a place; at each letter it goes on with the words that have it."""
    heads: dict[str, list[str]] = {}
    for w in words:
        if w:
            heads.setdefault(w[0], []).append(w[1:])
    more = [re.escape(c) + _pattern(rest) for c, rest in heads.items()]
    return "" if not more else f"(?:{'|'.join(more)})" + ("?" if "" in words else "")


def contained(text: Column, words: list[str]) -> Column:
    """Those of the words (lower case, none empty) that the lower-cased text contains, overlaps included, in one pass over it.

    At each place one pattern finds the longest word that begins there; the words that begin it are there, too.
    """
    words = sorted(set(words), key=lambda w: (-len(w), w))
    begin = {w: [v for v in words if w.startswith(v)] for w in words}
    starts = "".join(sorted({re.escape(w[0]) for w in words}))
    found = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(f"(?=[{starts}])(?=({_pattern(words)}))"), F.lit(1)))
    more = F.create_map(*[x for w in words for x in (F.lit(w), F.array(*map(F.lit, begin[w])))])
    return F.array_distinct(F.flatten(F.transform(found, lambda w: more[w])))


def _once(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value), which evaluates value once, however often f uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def evidence(text: Column, tags: Column, symbols: tuple[str, ...], keywords: dict[str, tuple[str, ...]] = KEYWORDS) -> Column:
    """array<struct<symbol, weight>>: every cashtag, tag of a rule and keyword that speaks for one of the symbols. Null text is empty."""
    text = F.coalesce(text, F.lit(""))
    known = F.array(*map(F.lit, symbols))
    pair = lambda s, w: F.struct(s.alias("symbol"), F.lit(w).alias("weight"))
    parts = [F.transform(cashtags(text), lambda s: pair(s, WEIGHTS["cashtag"]))]
    tags = F.coalesce(tags, F.array().cast("array<string>"))

    def of_rules(prefix: str) -> Column:
        named = F.filter(tags, lambda x: F.startswith(x, F.lit(prefix)))
        return F.transform(named, lambda x: pair(F.substring(x, len(prefix) + 1, 1 << 20), WEIGHTS[prefix]))

    parts += [of_rules("cashtag_"), of_rules("company_")]
    of: dict[str, list[str]] = {}
    for s in symbols:
        for word in keywords.get(s, ()):
            of.setdefault(word, []).append(s)
    if of:
        owners = F.create_map(*[x for w, ss in of.items() for x in (F.lit(w), F.array(*map(F.lit, ss)))])
        parts.append(F.transform(F.flatten(F.transform(contained(text, list(of)), lambda w: owners[w])), lambda s: pair(s, WEIGHTS["keyword"])))
    return F.filter(F.concat(*parts), lambda e: F.array_contains(known, e["symbol"]))


def best_symbol(text: Column, tags: Column, symbols: tuple[str, ...], keywords: dict[str, tuple[str, ...]] = KEYWORDS) -> Column:
    """struct<symbol, confidence>: the symbol with most evidence, the first listed of ties, and min(1, evidence); null without any."""
    found = F.coalesce(evidence(text, tags, symbols, keywords), F.array().cast("array<struct<symbol:string,weight:int>>"))
    place = F.create_map(*[x for i, s in enumerate(symbols) for x in (F.lit(s), F.lit(-i))])

    def most(found: Column) -> Column:
        total = lambda s: F.aggregate(F.filter(found, lambda e: e["symbol"] == s), F.lit(0), lambda a, e: a + e["weight"])
        return F.array_max(F.transform(F.array_distinct(F.transform(found, lambda e: e["symbol"])), lambda s: F.struct(total(s).alias("weight"), place[s].alias("place"), s.alias("symbol"))))

    shown = lambda best: F.when(best.isNotNull(), F.struct(best["symbol"].alias("symbol"), (F.least(F.lit(10), best["weight"]) / F.lit(10.0)).alias("confidence")))
    return _once(_once(found, most), shown)


def first_symbol(text: Column, tags: Column, symbols: tuple[str, ...], default: str | None = None) -> Column:
    """The symbol of the first cashtag_ or company_ tag, else the first listed one whose cashtag the text contains, else default."""
    of_rules = F.get(F.filter(F.coalesce(tags, F.array().cast("array<string>")), lambda x: x.rlike("^(cashtag|company)_")), F.lit(0))
    said = F.get(F.filter(F.array(*map(F.lit, symbols)), lambda s: F.contains(F.upper(text), F.concat(F.lit("$"), s))), F.lit(0))
    return F.coalesce(F.regexp_replace(of_rules, "^(cashtag|company)_", ""), said, F.lit(default))


def projected(records: DataFrame, symbols: tuple[str, ...], default: str | None = None) -> DataFrame:
    """tweet_id, symbol, text, created_at, lang, rules and the metrics (0 where absent) of records (RECORD), as a batch or a stream."""
    rules = F.transform(F.coalesce("matching_rules", F.array().cast("array<struct<id:string,tag:string>>")), lambda r: r["tag"])
    metrics = [F.coalesce(f"public_metrics.{m}", F.lit(0)).cast("long").alias(m) for m in METRICS]
    return records.withColumn("rules", rules).select(F.col("id").alias("tweet_id"), first_symbol(F.col("text"), F.col("rules"), symbols, default).alias("symbol"), "text", "created_at", "lang", "rules", *metrics)
