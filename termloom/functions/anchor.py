"""Verbatim anchors: a term's own place in its sentence.

The exact step is native; only rows it leaves go through the folding steps, in
a vectorised function.  Each folding keeps for every folded character the place
it came from, so what is cut out is always the sentence's own slice.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _folded(text: str, yo: bool, space: bool) -> tuple[str, list[int]]:
    chars, places = [], []
    for i, c in enumerate(text):
        if space and c.isspace():
            if chars and chars[-1] == " ":
                continue
            c = " "
        for f in c.casefold():
            chars.append("е" if yo and f == "ё" else f)
            places.append(i)
    return "".join(chars), places


def slice_of(term: str | None, text: str | None) -> str | None:
    """The slice of the NFC text that the NFC term stands for, or None: exact, case folded, ё folded, white space folded."""
    if not term or not text or not term.strip():
        return None
    term, text = unicodedata.normalize("NFC", term.strip()), unicodedata.normalize("NFC", text)
    if term in text:
        return term
    for yo, space in ((False, False), (True, False), (True, True)):
        want, _ = _folded(term, yo, space)
        have, places = _folded(text, yo, space)
        at = have.find(want)
        while at >= 0:
            end = at + len(want)
            whole = (at == 0 or places[at] != places[at - 1]) and (end == len(places) or places[end] != places[end - 1])
            if whole:  # neither edge cuts a character that folds to several
                last = places[end] if end < len(places) else len(text)
                return text[places[at] : last].rstrip() if space else text[places[at] : last]
            at = have.find(want, at + 1)
    return None


def _folding(term: pd.Series, text: pd.Series) -> pd.Series:
    return pd.Series([slice_of(a, b) for a, b in zip(term, text, strict=True)], dtype=object)


def exact(term: Column, text: Column) -> Column:
    t = F.trim(term)
    return F.when((F.length(t) > 0) & (F.instr(text, t) > 0), t)


def anchor(term: Column, text: Column) -> Column:
    """The sentence's slice for a term, or null; only what isn't found exactly leaves the JVM."""
    return F.coalesce(exact(term, text), F.when(F.length(F.trim(term)) > 0, F.pandas_udf(_folding, "string")(term, text)))
