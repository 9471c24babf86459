"""A small list of habitual plurals, and its lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.functions.morph import ELIDED, FUNCTION_WORDS, PREPOSITIONS, _by_lang, words

SCHEMA = "lang string, head string, term string, zh string, why string, observed boolean, meaning_shift boolean"
# Own entries: words used in the plural by habit, with a gloss and a reason.
ENTRIES = [
    ("es", "víveres", "víveres de reserva", "储备粮", "no singular in use", False, False),
    ("es", "finanzas", "finanzas municipales", "市政财政", "the plural names the field", False, False),
    ("es", "afueras", "afueras de la ciudad", "市郊", "no singular in use", False, False),
    ("es", "bienes", "bienes de consumo", "消费品", "the singular means the good as such", False, True),
    ("es", "esposas", "esposas de acero", "钢制手铐", "the singular means a wife", False, True),
    ("fr", "archives", "archives nationales", "国家档案馆", "the plural names the institution", False, False),
    ("fr", "environs", "environs du port", "港口周边", "no singular in use", False, False),
    ("fr", "assises", "cour d'assises", "重罪法庭", "the singular means a base layer", False, True),
    ("fr", "vacances", "vacances scolaires", "学校假期", "the singular means a vacancy", False, True),
    ("ru", "финансы", "государственные финансы", "国家财政", "no singular in use", False, False),
    ("ru", "весы", "электронные весы", "电子秤", "no singular in use", False, False),
    ("ru", "часы", "песочные часы", "沙漏", "the singular means an hour", False, True),
]


def entries(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ENTRIES, SCHEMA)


def heads(lexicon: DataFrame, lang: str) -> DataFrame:
    return lexicon.where(F.col("lang") == lang).select(F.lower("head").alias("head")).distinct()


def lookup(words_df: DataFrame, lexicon: DataFrame, word: str = "word", lang: str = "lang") -> DataFrame:
    """Words with the entry of the same head; the list is small by nature, and Spark checks that before it broadcasts."""
    own = lexicon.select(F.col("lang").alias("_lang"), F.lower("head").alias("_head"), "head", "term", "why")
    return words_df.join(own, (F.col(lang) == F.col("_lang")) & (F.lower(F.col(word)) == F.col("_head"))).drop("_lang", "_head")


def content_tokens(term: Column, lang: Column) -> Column:
    """Lower-case words without elisions, function words and prepositions."""
    token = F.transform(words(term), lambda w: F.regexp_replace(F.lower(w), "^(" + "|".join(ELIDED) + ")", ""))
    skip = F.concat(_by_lang(FUNCTION_WORDS, lang), _by_lang(PREPOSITIONS, lang))
    return F.filter(token, lambda w: (w != "") & ~F.array_contains(skip, w))


def lookup_terms(terms: DataFrame, lexicon: DataFrame, term: str = "term", lang: str = "lang", id: str = "id") -> DataFrame:
    """The first entry (by head) that a term stands for: equal content, or its head with the head alone or another shared word.

    Joined on words, not by comparing all with all.
    """
    t = terms.select(F.col(id).alias("id"), F.col(lang).alias("lang"), content_tokens(F.col(term), F.col(lang)).alias("have")).withColumn("w", F.explode(F.array_distinct("have")))
    e = lexicon.select("lang", F.lower("head").alias("w"), "head", F.col("term").alias("entry"), content_tokens(F.col("term"), F.col("lang")).alias("want"))
    both = t.join(e, ["lang", "w"])
    rest = lambda c: F.array_remove(F.col(c), F.col("w"))
    hit = (F.col("have") == F.col("want")) | (F.size(rest("have")) == 0) | (F.size(rest("want")) == 0) | F.arrays_overlap(rest("have"), rest("want"))
    return both.where(hit).groupBy("id").agg(F.min(F.struct("head", "entry")).alias("m")).select("id", "m.head", "m.entry")


def examples(lexicon: DataFrame, lang: str, n: int = 8) -> DataFrame:
    """Entries for a prompt: observed ones first."""
    return lexicon.where(F.col("lang") == lang).orderBy(~F.col("observed"), "term").limit(n)


def meaning_shift(lexicon: DataFrame) -> DataFrame:
    return lexicon.where("meaning_shift")
