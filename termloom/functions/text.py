"""Column expressions on sentence text; all of them stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The term types that are delivered.
TYPES = ["other", "hot", "cul", "tech", "poli", "econ", "tab", "per", "loc", "org"]
# Separators inside a list of types.
TYPE_SPLIT = "[,，;/|]+"
# Apostrophes that are delivered as ', and quotes that may wrap a whole term.
APOSTROPHES = "’ʼ՚′＇"
QUOTES = "\"“”«»‘’「」„‹›"
# Messages of an exhausted account, lower case, with spaces for _ and -.
BALANCE = ["insufficient balance", "insufficient account balance", "insufficient credit", "insufficient quota", "insufficient funds", "balance is insufficient", "exceeded your current quota", "余额不足", "额度不足", "欠费"]
# A run stops for rate limits from so many hits that are over this share of calls.
RATE_LIMIT_HITS, RATE_LIMIT_SHARE = 20, 0.10


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean(c: Column | str) -> Column:
    """Without outer white space of any kind; null is empty."""
    return F.regexp_replace(F.coalesce(_col(c), F.lit("")), r"(?U)^[\s\x{1C}-\x{1F}]+|[\s\x{1C}-\x{1F}]+$", "")


def is_meaningful(c: Column | str) -> Column:
    """Any letter of any script; null has none."""
    return F.coalesce(_col(c).rlike(r"\p{L}"), F.lit(False))


def usable(src: Column | str, tgt: Column | str) -> Column:
    return is_meaningful(src) & is_meaningful(tgt)


def cjk_ratio(c: Column | str) -> Column:
    """Share of U+4E00..U+9FFF among the characters that are no white space; 0 if there are none."""
    text = F.coalesce(_col(c), F.lit(""))
    every = F.length(F.regexp_replace(text, r"(?U)[\s\x{1C}-\x{1F}]", ""))
    return F.when(every > 0, F.length(F.regexp_replace(text, "[^一-鿿]", "")) / every).otherwise(F.lit(0.0))


def foreign_side(src: Column | str, tgt: Column | str) -> Column:
    """The slot with the lower share of Chinese; tgt when they tie."""
    return F.when(cjk_ratio(src) >= cjk_ratio(tgt), "tgt").otherwise("src")


def norm_types(c: Column | str) -> Column:
    """Types of a separated string or an array of such: known ones, each once, `other` only alone."""
    parts = F.split(F.coalesce(_col(c).cast("string"), F.lit("")), TYPE_SPLIT)
    known = F.array(*[F.lit(t) for t in TYPES])
    kept = F.array_distinct(F.filter(F.transform(parts, lambda x: F.lower(clean(x))), lambda x: F.array_contains(known, x)))
    return F.when(F.size(kept) > 1, F.array_remove(kept, "other")).otherwise(kept)


def normalize_delivery(c: Column | str) -> Column:
    """Apostrophes become ', and one pair of quotes around a whole term without inner ones goes.

    Apostrophes and quotes are different classes here: an apostrophe inside
    doesn't keep the quotes around.
    """
    text = F.translate(_col(c), APOSTROPHES, "'" * len(APOSTROPHES))
    quote = F.lit("".join(q for q in QUOTES if q not in APOSTROPHES))
    wrapped = (F.length(text) > 2) & (F.instr(quote, F.substring(text, 1, 1)) > 0) & (F.instr(quote, F.substring(text, -1, 1)) > 0)
    body = text.substr(F.lit(2), F.length(text) - 2)
    return F.when(wrapped & ~body.rlike("[" + "".join(q for q in QUOTES if q not in APOSTROPHES) + "]"), clean(body)).otherwise(text)


def balance_exhausted(status: Column | str, message: Column | str) -> Column:
    """Status 402, or a message that says that the account is empty."""
    low = F.translate(F.lower(F.coalesce(_col(message), F.lit(""))), "_-", "  ")
    found = F.lit(False)
    for p in BALANCE:
        found = found | low.contains(p)
    return F.coalesce(_col(status) == 402, F.lit(False)) | found


def refused(ok: Column | str, content: Column | str, finish: Column | str) -> Column:
    return F.coalesce(_col(finish).isin("content_filter", "refusal"), F.lit(False)) | (_col(ok) & (F.length(clean(content)) == 0))


def truncated(finish: Column | str) -> Column:
    return F.coalesce(_col(finish) == "length", F.lit(False))


def rate_limited(hits: Column | str, calls: Column | str) -> Column:
    return (_col(hits) >= RATE_LIMIT_HITS) & (_col(hits) > RATE_LIMIT_SHARE * F.greatest(F.lit(1), _col(calls)))
