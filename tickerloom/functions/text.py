"""Expressions on post texts. Classes such as \\w and \\s are ASCII."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Phrases that point up or down, phrases of spam, words of finance, companies' names and keywords.
BULLISH = ("buy", "bull", "bullish", "long", "calls", "moon", "rocket", "pump", "breakout", "rally", "surge", "spike", "gap up", "strong", "beat", "upgrade", "outperform", "overweight", "positive", "good news")
BEARISH = ("sell", "bear", "bearish", "short", "puts", "crash", "dump", "drop", "breakdown", "decline", "fall", "gap down", "weak", "miss", "downgrade", "underperform", "underweight", "negative", "bad news")
SPAM = ("follow me", "dm me", "check my bio", "link in bio", "subscribe", "like and retweet", "giveaway")
FINANCE = (
    "earnings", "revenue", "profit", "loss", "guidance", "forecast", "bullish", "bearish", "buy", "sell", "hold", "upgrade", "downgrade", "analyst", "target", "price", "stock", "shares", "market",
    "trading", "volume", "breakout", "support", "resistance", "dividend", "split", "merger", "acquisition", "ipo",
)
KEYWORDS = {
    "AAPL": ("apple", "iphone", "ipad", "mac", "ios"), "GOOGL": ("google", "alphabet", "youtube", "android", "gmail"), "TSLA": ("tesla", "elon musk", "model 3", "model y", "cybertruck"),
    "META": ("meta", "facebook", "instagram", "whatsapp", "metaverse"), "MSFT": ("microsoft", "windows", "office", "azure", "xbox"), "AMZN": ("amazon", "aws", "prime", "alexa", "bezos"),
    "NVDA": ("nvidia", "gpu", "ai chip", "graphics card"), "JPM": ("jpmorgan", "chase", "jamie dimon"), "JNJ": ("johnson", "johnson & johnson", "j&j"), "V": ("visa", "payment"), "MA": ("mastercard", "payment"),
}
URL, MENTION, HASHTAG, CASHTAG = r"https?://[^\s]+", r"@\w+", r"#\w+", r"\$([A-Z]{1,5})"


def clean_text(text: Column, urls: bool = True, mentions: bool = False, hashtags: bool = False) -> Column:
    for pattern, on in ((URL, urls), (MENTION, mentions), (HASHTAG, hashtags)):
        text = F.regexp_replace(text, pattern, "") if on else text
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def cashtags(text: Column) -> Column:
    return F.regexp_extract_all(F.upper(text), F.lit(CASHTAG), F.lit(1))


def hashtags(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(HASHTAG), F.lit(0)), F.lower)


def hits(text: Column, phrases: tuple[str, ...]) -> Column:
    """How many of the phrases the lower-cased text contains."""
    low = F.lower(text)
    total = F.lit(0)
    for p in phrases:
        total = total + F.contains(low, F.lit(p)).cast("int")
    return total


def engagement(retweets: Column, quotes: Column, replies: Column, likes: Column) -> Column:
    weight = 3 * retweets + 2 * quotes + 1.5 * replies + likes
    return F.when(weight == 0, 0.0).otherwise(F.least(F.lit(1.0), F.log10(weight + 1.0) / F.log10(F.lit(1001.0))))


def virality(retweets: Column, likes: Column) -> Column:
    return F.when(likes == 0, 0.0).otherwise(F.least(F.lit(1.0), F.try_divide(retweets, likes) / 0.3))


def is_quality(text: Column, interactions: Column) -> Column:
    """Length 20 to 280, at least 2 interactions, no spam phrase, at least half of the words distinct."""
    words = F.split(F.trim(F.regexp_replace(F.lower(text), r"\s+", " ")), " ")
    return F.length(text).between(20, 280) & (interactions >= 2) & (hits(text, SPAM) == 0) & (F.size(F.array_distinct(words)) >= 0.5 * F.size(words))


def softmax(logits: Column) -> Column:
    top = F.array_max(logits)
    e = F.transform(logits, lambda x: F.exp(x - top))
    return F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, b: a + b))


def label_scores(label: Column, score: Column) -> dict[str, Column]:
    """A label and its score as shares. What a neutral label leaves goes to negative; a missing label is wholly neutral."""
    rest = F.lit(1.0) - score
    pos = F.when(label == "positive", score).otherwise(0.0)
    neg = F.when(label == "negative", score).when(label.isNull() | (label == "positive"), 0.0).otherwise(rest)
    neu = F.when(label.isNull(), 1.0).when(label.isin("positive", "negative"), rest).otherwise(score)
    return {"positive": pos, "negative": neg, "neutral": neu, "compound": pos - neg}


def parse_response(text: Column) -> dict[str, Column]:
    """A model's words as shares and its own class's confidence; positive is looked for first."""
    low = F.lower(F.coalesce(text, F.lit("")))
    up, down = F.contains(low, F.lit("positive")), F.contains(low, F.lit("negative"))
    pick = lambda a, b, c: F.when(up, a).when(down, b).otherwise(c)
    return {"positive": pick(0.8, 0.05, 0.25), "neutral": pick(0.15, 0.15, 0.5), "negative": pick(0.05, 0.8, 0.25), "label": pick(F.lit("positive"), F.lit("negative"), F.lit("neutral")), "confidence": pick(0.8, 0.8, 0.5)}


def format_size(size: Column) -> Column:
    """Bytes as B, KB, MB or GB with one decimal."""
    show = lambda k, unit: F.concat(F.format_string("%.1f", size / float(1024**k)), F.lit(f" {unit}"))
    return F.when(size < 1024, F.concat(size.cast("string"), F.lit(" B"))).when(size < 1024**2, show(1, "KB")).when(size < 1024**3, show(2, "MB")).otherwise(show(3, "GB"))


def format_duration(seconds: Column) -> Column:
    show = lambda x, unit: F.concat(F.format_string("%.1f", x), F.lit(unit))
    return F.when(seconds < 60, F.concat(F.format_string("%.0f", seconds.cast("double")), F.lit("s"))).when(seconds < 3600, show(seconds / 60.0, "m")).otherwise(show(seconds / 3600.0, "h"))


def clip(x: Column, low: float, high: float) -> Column:
    """Clamps; null stays null, which greatest and least alone would not keep."""
    return F.when(x.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), x)))
