"""Column expressions on file names."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from termloom.functions.text import cjk_ratio

# Misspelled endings and the right one.
MISSPELLED = ["_algin.qc.json", "_aglin.qc.json", "_align.qc..json"]
RIGHT = "_align.qc.json"
# Fixed value: share of Chinese from which a side counts as Chinese.
CHINESE = 0.3


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def normalize_basename(name: Column) -> Column:
    """Without the mark of a repeated download, without a stray space before the ending, spelling put right."""
    fixed = F.regexp_replace(name, r"(?:\s*\(\d+\)|\s+)(?=\.jsonl?$)", "")
    return F.regexp_replace(fixed, "(?:" + "|".join(re.escape(bad) for bad in MISSPELLED) + ")$", RIGHT)


def replace_out_name(name: Column) -> Column:
    return (
        F.when(F.endswith(name, F.lit("align.qc.json")), F.regexp_replace(name, r"align\.qc\.json$", "term.xlsx"))
        .when(name.rlike(r"\.jsonl?$"), F.regexp_replace(name, r"\.jsonl?$", "_term.xlsx"))
        .otherwise(F.concat(name, F.lit("_term.xlsx")))
    )


def out_name(name: Column) -> Column:
    return replace_out_name(normalize_basename(name))


def stem(name: Column) -> Column:
    return F.when(name.rlike(r"[_.]align\.qc\.json$"), F.regexp_replace(name, r"[_.]align\.qc\.json$", "")).otherwise(F.regexp_replace(name, r"\.(jsonl|json|xlsx)$", ""))


def layer(name: Column, scene: Column | None = None, domain: Column | None = None) -> Column:
    parts = F.split(stem(name), "_")
    known = F.concat_ws("/", F.coalesce(scene, F.lit("?")) if scene is not None else F.lit("?"), F.coalesce(domain, F.lit("?")) if domain is not None else F.lit("?"))
    return F.when(F.size(parts) >= 3, F.concat_ws("/", F.get(parts, F.lit(1)), F.get(parts, F.lit(2)))).otherwise(known)


def name_direction(name: Column) -> Column:
    return F.get(F.split(stem(name), "_"), F.lit(0))


def content_direction(src: Column, tgt: Column) -> Column:
    """An aggregate over usable pairs: which side is Chinese in more of them; ? without any pair."""
    a, b = F.count_if(cjk_ratio(src) > CHINESE), F.count_if(cjk_ratio(tgt) > CHINESE)
    return F.when(F.count(F.lit(1)) == 0, "?").when(a > b, "zh-first").when(b > a, "foreign-first").otherwise("unclear")
