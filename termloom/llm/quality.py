"""Operator 3 [native]: quality rules by the divergence of distributions.

Each document gets two histograms: its characters by class, and its words over
the most common words of its language.  A language's reference is the mean of
the histograms of all its documents that are long enough and pass the base
rules.  A document is kept if it passes the base rules and the Jensen-Shannon
distance of each histogram from its language's reference is at most a limit; a
histogram of fewer characters or words than a guard has no say.

The limit of the words is the language's own, never above `word_limit`: what
counting n words alone brings, with a margin, and the spread of its steady
documents beyond that; and it stays below the distance at which a text without
any common word stands.  Words have a say only where the reference lets expect
some common ones; languages without a list have no limit of their own.

Everything is made of DataFrame functions; no text is shuffled, and a
document's windows are compared inside its own row.

Defined results: a null text has no words (and so fails the base rules); a null
language is a language of its own, without common words; a language whose
documents are all too short has no reference, and its documents are judged by
the base rules alone; repeated rows stay repeated; an empty table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import materialise

# White space, symbols, window and base limits of the contract.
WHITE, SYMBOLS, WINDOW = " \t\n\x0b\x0c\r", r"[#*$%&|<>]", 5
LEAST_WORDS, MOST_REPEATED = 10, 20

# Common words by language.
COMMON = {
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "ist", "im", "dem", "nicht", "ein", "eine"],
    "en": ["the", "of", "and", "to", "a", "in", "is", "that", "for", "it", "as", "was", "with", "be", "by", "on", "not", "he"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un", "por", "con", "no", "una", "su", "para"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "a", "par", "plus"],
}
#: Character classes, in the order of the histogram.
CLASSES = ("white", "upper", "digit", "symbol", "mark", "wide", "other")
#: Least characters and words for the histograms to count, and the largest distances (0 to 1) of kept documents.
GUARD_CHARS, GUARD_WORDS, CHAR_LIMIT, WORD_LIMIT = 200, 80, 0.30, 0.60
#: Common words that must be expected; deviations of counting and of the language's documents that are allowed; share of the distance of a text without common words.
GUARD_COMMON, COUNTING, SPREAD, SHORT_OF = 10, 4.0, 3.0, 0.9


def _spaced(text: Column) -> Column:
    """text with spaces for other white space: splitting at a space needs no regular expression."""
    for c in WHITE[1:]:
        text = F.replace(text, F.lit(c), F.lit(WHITE[0]))
    return text


def _array_sum(a: Column, kind: str) -> Column:
    return F.aggregate(a, F.lit(0).cast(kind), lambda acc, x: acc + x.cast(kind))


def _shares(a: Column, total: Column) -> Column:
    return F.transform(a, lambda x: x / F.greatest(total.cast("double"), F.lit(1.0)))


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance to base 2 of two histograms of shares."""
    part = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))
    terms = F.zip_with(p, q, lambda x, y: (part(x, (x + y) / 2) + part(y, (x + y) / 2)) / 2)
    return F.sqrt(F.greatest(F.lit(0.0), _array_sum(terms, "double")))


def features(docs: DataFrame) -> DataFrame:
    """Counts and histograms of each document, in one pass over its text.

    Where a lambda names a column that has no other use, Spark computes it anew
    for each element; so hits is named twice.
    """
    df = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    df = df.withColumn("spaced", _spaced(F.col("text")))
    df = df.select(
        "doc_id", "lang", F.length("text").cast("long").alias("chars"),
        F.array_remove(F.split("spaced", " "), "").alias("words"),
        F.replace("spaced", F.lit(" "), F.lit("")).alias("packed"),
        F.filter(F.split("text", "\n", -1), lambda x: F.ltrim(x, F.lit(WHITE)) != "").alias("lines"),
    )
    n = F.size("words")
    upto = lambda a, at, less: F.slice(a, F.lit(at), F.greatest(F.lit(0), n - less))
    both = lambda a, b: F.zip_with(a, b, lambda x, y: F.xxhash64(x, y))
    common = sorted({w for own in COMMON.values() for w in own})
    df = df.select(
        "doc_id", "lang", "chars", "words", n.cast("long").alias("n_words"),
        F.length("packed").cast("long").alias("word_chars"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.filter("words", lambda w: w.isin(common)).alias("hits"),
        both(upto("words", 1, 1), upto("words", 2, 1)).alias("pairs"),
        F.length(F.regexp_replace("packed", r"[\x00-\x7F]+", "")).cast("long").alias("wide"),
        F.regexp_replace("packed", r"[^\x00-\x60\x7B-\x7F]+", "").alias("rest"),
    )
    # two words, then four, then the WINDOW of five
    df = df.withColumn("w", both(both(upto("pairs", 1, 4), upto("pairs", 3, 4)), upto("words", 5, 4))).drop("words", "pairs")
    # only texts with a repeated window sort theirs; then the windows that equal their neighbour give the covered words
    df = df.withColumn("s", F.when(F.size(F.array_distinct("w")) < F.size("w"), F.sort_array(F.transform("w", lambda x, i: F.struct(x.alias("x"), i.alias("i")))))).drop("w")
    equal = F.array_compact(F.zip_with("s", F.slice("s", F.lit(2), F.size("s")), lambda a, b: F.when(a["x"] == b["x"], F.array(a["i"], b["i"]))))
    df = df.withColumn("at", F.sort_array(F.array_distinct(F.flatten(equal)))).drop("s")
    covered = _array_sum(F.zip_with("at", F.slice("at", F.lit(2), F.size("at")), lambda p, after: F.least(F.lit(WINDOW), F.coalesce(after - p, F.lit(WINDOW)))), "long")
    own = F.array().cast("array<string>")
    for lang, listed in COMMON.items():
        own = F.when(F.col("lang") == lang, F.array(*[F.lit(w) for w in listed])).otherwise(own)
    counts = F.transform(own, lambda v: (F.size("hits") - F.size(F.array_remove("hits", v))).cast("long"))
    df = df.select(
        "doc_id", "lang", "chars", "n_words", "word_chars", "n_dup_lines", "wide",
        F.coalesce(covered, F.lit(0)).alias("n_repeat_words"),
        counts.alias("common"),
        *[F.regexp_count("rest", F.lit(of)).cast("long").alias(name) for name, of in (("n_symbols", SYMBOLS), ("upper", "[A-Z]"), ("digit", "[0-9]"), ("mark", r"[.,;:!?()\"'/_-]"))],
    )
    classes = {"white": F.col("chars") - F.col("word_chars"), "symbol": F.col("n_symbols"), **{c: F.col(c) for c in ("upper", "digit", "mark", "wide")}}
    classes["other"] = F.greatest(F.lit(0), F.col("chars") - sum(classes.values(), F.lit(0)))
    base_failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return df.select(
        "doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed.alias("base_failed"), "chars",
        F.array(*[classes[c].cast("long") for c in CLASSES]).alias("char_counts"),
        F.concat("common", F.array(F.col("n_words") - _array_sum(F.col("common"), "long"))).alias("word_counts"),
    )


def quality(docs: DataFrame, char_limit: float = CHAR_LIMIT, word_limit: float = WORD_LIMIT) -> DataFrame:
    """doc_id, the counts, base_failed, kept, and the distances (null below a guard)."""
    rows = materialise(features(docs), "quality")
    rows = rows.withColumns({"p": _shares(F.col("char_counts"), F.col("chars")), "q": _shares(F.col("word_counts"), F.col("n_words"))})
    sizes = {"p": len(CLASSES), "q": max(map(len, COMMON.values())) + 1}
    steady = rows.where(~F.col("base_failed") & (F.col("chars") >= GUARD_CHARS) & (F.col("n_words") >= GUARD_WORDS))
    means = [F.avg(F.get(name, F.lit(i))).alias(f"{name}{i}") for name, n in sizes.items() for i in range(n)]
    reference = steady.groupBy("lang").agg(*means).select(F.col("lang"), *[F.filter(F.array(*[f"{name}{i}" for i in range(n)]), lambda x: x.isNotNull()).alias(f"{name}_ref") for name, n in sizes.items()])
    # once written, a table of one row a language has a known size: Spark broadcasts it while small, and rows aren't dealt out by language
    rows = rows.join(materialise(reference, "references"), "lang", "left")
    far = lambda own, n, least, limit: F.when((F.col(n) >= least) & F.col(f"{own}_ref").isNotNull(), distance(F.col(own), F.col(f"{own}_ref")))
    rows = rows.withColumns({"char_distance": far("p", "chars", GUARD_CHARS, char_limit), "word_distance": far("q", "n_words", GUARD_WORDS, word_limit)})
    # the squared distance of n words drawn from a reference of k bars is about chi-squared / (8 n ln 2), with k - 1 degrees of freedom
    free = F.size("q_ref") - 1
    unit = 1 / (8 * math.log(2) * F.col("n_words"))
    beyond = F.sqrt(F.greatest(F.lit(0.0), F.pow("word_distance", F.lit(2.0)) - free * unit))
    part = lambda at: F.percentile_approx("beyond", F.lit(at), F.lit(1000))
    spread = rows.where(~F.col("base_failed") & (F.col("chars") >= GUARD_CHARS)).select("lang", beyond.alias("beyond")).groupBy("lang").agg((part(0.5) + SPREAD * (part(0.75) - part(0.25)) / 1.349).alias("spread"))
    rows = rows.join(materialise(spread, "spreads"), "lang", "left")
    counted = F.sqrt(F.pow("spread", F.lit(2.0)) + (free + COUNTING * F.sqrt(2 * free)) * unit)
    bare = F.transform("q_ref", lambda _, i: F.when(i == F.size("q_ref") - 1, 1.0).otherwise(0.0))
    expected = F.col("n_words") * (1 - F.element_at("q_ref", -1))
    own_limit = F.when(expected >= GUARD_COMMON, F.least(counted, SHORT_OF * distance(bare, F.col("q_ref"))))
    near = (F.coalesce("char_distance", F.lit(0.0)) <= char_limit) & (F.coalesce("word_distance", F.lit(0.0)) <= F.least(F.lit(word_limit), own_limit))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & near).alias("kept"), "char_distance", "word_distance")
