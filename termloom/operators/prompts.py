"""What a model is told: the engine's own instructions, or a user's file."""

from __future__ import annotations

from pyspark.sql import SparkSession

from termloom.functions.morph import LANGUAGES
from termloom.functions.text import TYPES
from termloom.operators import lexicon
from termloom.sources.sinks import prompt_parts

#: Entries of the lexicon that a prompt shows.
SHOWN = 8

CONTRACT = """You read sentence pairs and list the terms that both sides share.
Answer with one JSON array and nothing else. For each pair give
{"sent_id": <its number>, "terms": [{"term_src": ..., "term_tgt": ..., "dict_form": ..., "types": [...], "note": ""}]}.
term_src and term_tgt are copied letter by letter from their own sentence.
A pair without terms has an empty list."""


def default_prompt(spark: SparkSession, lang: str) -> tuple[str, str]:
    """(system, user) for a language: the contract, the types, the dictionary form and some entries of the lexicon."""
    parts = [CONTRACT, f"types are one or more of: {', '.join(TYPES)}."]
    if lang in LANGUAGES:
        parts.append(f"dict_form is the dictionary form of the '{lang}' term: as many words as it has there, each of the same word, with names as they stand.")
    shown = [r["term"] for r in lexicon.examples(lexicon.entries(spark), lang, SHOWN).collect()]
    if shown:
        parts.append("Words that stay plural in the dictionary, as in: " + "; ".join(shown) + ".")
    return "\n".join(parts), "{pairs}"


def read_prompt(spark: SparkSession, path: str) -> tuple[str, str]:
    """(system, user) of a UTF-8 text file, with or without a byte order mark."""
    text = spark.read.text(path, wholetext=True).first()
    return prompt_parts((text["value"] if text else "").lstrip("\ufeff").replace("\r\n", "\n"))
