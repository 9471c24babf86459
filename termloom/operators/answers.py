"""Answers become rows: parsing, resolution of sentences, anchors, types, dictionary forms, counters."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.functions.anchor import anchor
from termloom.functions.morph import LANGUAGES, check_form
from termloom.functions.text import clean, foreign_side, norm_types
from termloom.functions.tolerant import answer_array

ITEMS = "struct<parsed:boolean,empty:boolean,items:array<struct<sent_id:bigint,item_pos:int,shape_error:string,terms:array<struct<term_src:string,term_tgt:string,dict_form:string,types:array<string>,shape_error:string>>>>>"


def _id(x: object) -> int | None:
    if isinstance(x, bool):
        return None
    if isinstance(x, int):
        return x if -(1 << 63) <= x < 1 << 63 else None
    return int(x) if isinstance(x, str) and x.strip().isdecimal() and len(x) < 18 else None


def _word(x: object) -> str | None:
    return x if isinstance(x, str) else None if x is None else str(x)


def _types(x: object) -> list[str]:
    return [t if isinstance(t, str) else json.dumps(t) for t in x] if isinstance(x, list) else [] if x is None else [str(x)]


def _items(text: str | None) -> dict:
    found, ok = answer_array(text)
    items = []
    for i, item in enumerate(found):
        if not isinstance(item, dict):
            items.append({"sent_id": None, "item_pos": i, "shape_error": "item_not_object", "terms": []})
            continue
        terms, error = item.get("terms", []), None
        if not isinstance(terms, list):
            terms, error = [], "terms_not_list"
        rows = []
        for t in terms:
            if isinstance(t, dict):
                form = t["dict_form"] if "dict_form" in t else t.get("nominative")
                rows.append({"term_src": _word(t.get("term_src")), "term_tgt": _word(t.get("term_tgt")), "dict_form": _word(form), "types": _types(t.get("types")), "shape_error": None})
            else:
                rows.append({"term_src": None, "term_tgt": None, "dict_form": None, "types": [], "shape_error": "term_not_object"})
        items.append({"sent_id": _id(item.get("sent_id")), "item_pos": i, "shape_error": error, "terms": rows})
    return {"parsed": ok, "empty": ok and not found, "items": items}


def _parse(content: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([_items(x) for x in content], columns=["parsed", "empty", "items"])


def parse_answer(content: Column) -> Column:
    return F.pandas_udf(_parse, ITEMS)(content)


def parsed(responses: DataFrame) -> DataFrame:
    """Responses with parsed, empty and items."""
    return responses.withColumn("answer", parse_answer(F.col("content"))).select("*", "answer.parsed", "answer.empty", "answer.items").drop("answer")


def proposals(answers: DataFrame) -> DataFrame:
    """A row for each proposed term or broken element, with its place: item_pos, term_pos."""
    items = answers.where("parsed").select("file", "batch_idx", "batch_key", F.explode("items").alias("item"))
    rows = items.select("file", "batch_idx", "batch_key", "item.sent_id", "item.item_pos", F.col("item.shape_error").alias("item_error"), F.posexplode_outer("item.terms").alias("term_pos", "term"))
    rows = rows.where("term is not null or item_error is not null")
    return rows.select("file", "batch_idx", "batch_key", "sent_id", "item_pos", F.coalesce("term_pos", F.lit(0)).alias("term_pos"), "term.term_src", "term.term_tgt", "term.dict_form", "term.types", F.coalesce("item_error", "term.shape_error").alias("shape_error"))


def validated(rows: DataFrame, batches: DataFrame, lang: Column | None = None, check=check_form) -> DataFrame:
    """Proposals joined to their sentences: anchors, types, dictionary form, and reject_code for rows that drop.

    Codes, first one wins: a shape error, bad_sent_id, empty_side, bad_anchor_src,
    bad_anchor_tgt.  A bad type or dictionary form doesn't drop a row.
    """
    sentences = batches.select("file", "batch_idx", F.explode("pairs").alias("p")).select("file", "batch_idx", F.col("p.pos").cast("long").alias("sent_id"), F.col("p.src").alias("src_text"), F.col("p.tgt").alias("tgt_text"))
    joined = rows.join(sentences, ["file", "batch_idx", "sent_id"], "left")
    lang = F.lit(None).cast("string") if lang is None else lang
    joined = joined.withColumn("blank", (F.length(clean("term_src")) == 0) | (F.length(clean("term_tgt")) == 0))
    joined = joined.withColumn("span_src", F.when(~F.col("blank"), anchor(F.col("term_src"), F.col("src_text")))).withColumn("span_tgt", F.when(~F.col("blank"), anchor(F.col("term_tgt"), F.col("tgt_text"))))
    code = (
        F.coalesce("shape_error", F.when(F.col("src_text").isNull(), "bad_sent_id").when(F.col("blank"), "empty_side").when(F.col("span_src").isNull(), "bad_anchor_src").when(F.col("span_tgt").isNull(), "bad_anchor_tgt"))
    )
    joined = joined.withColumn("reject_code", code).withColumn("lang", lang).withColumn("side", foreign_side("src_text", "tgt_text"))
    types = norm_types(F.array_join("types", ","))
    joined = joined.withColumn("type_fallback", F.size(types) == 0).withColumn("types", F.when(F.size(types) == 0, F.array(F.lit("other"))).otherwise(types))
    span = F.when(F.col("side") == "src", F.col("span_src")).otherwise(F.col("span_tgt"))
    form = clean("dict_form")
    inflected = F.col("lang").isin(*LANGUAGES)
    error = F.when(F.col("reject_code").isNull() & inflected, F.when(form == "", "form_missing").otherwise(check(form, span, F.col("lang"))))
    joined = joined.withColumn("form_error", error).withColumn("form_noop", F.col("form_error").isNotNull() & (form == span))
    base = F.when(inflected & F.col("reject_code").isNull() & F.col("form_error").isNull() & (form != span), form).otherwise(F.lit(""))
    joined = joined.withColumn("base", base)
    return joined.withColumn("base_src", F.when(F.col("side") == "src", F.col("base")).otherwise(F.lit(""))).withColumn("base_tgt", F.when(F.col("side") == "tgt", F.col("base")).otherwise(F.lit(""))).drop("blank", "base")


CODES = ["item_not_object", "terms_not_list", "term_not_object", "bad_sent_id", "empty_side", "bad_anchor_src", "bad_anchor_tgt"]


def outcomes(batches: DataFrame, answers: DataFrame, rows: DataFrame) -> DataFrame:
    """Counters of each batch, also of those without a row or an answer."""
    sums = rows.groupBy("file", "batch_idx").agg(
        F.count_if(F.col("reject_code").isNull()).alias("n_kept"),
        F.count_if(F.col("reject_code").isNotNull()).alias("n_failures"),
        *[F.count_if(F.col("reject_code") == c).alias(f"n_{c}") for c in CODES],
        F.count_if(F.col("type_fallback") & F.col("reject_code").isNull()).alias("n_type_fallback"),
        F.count_if(F.col("form_error").isNotNull() & ~F.col("form_noop")).alias("n_form_fallback"),
        F.count_if(F.col("form_noop")).alias("n_form_noop"),
        F.count_if(F.col("lang").isin(*LANGUAGES) & F.col("reject_code").isNull() & F.col("form_error").isNull()).alias("n_form_ok"),
    )
    own = answers.select("file", "batch_idx", "ok", "parsed", "empty", "content", F.size("items").alias("n_items"), "finish_reason")
    out = batches.select("file", "batch_idx", "batch_key", "n").join(own, ["file", "batch_idx"], "left").join(sums, ["file", "batch_idx"], "left")
    counters = [c for c in sums.columns if c.startswith("n_")]
    out = out.select("file", "batch_idx", "batch_key", "n", F.coalesce("ok", F.lit(False)).alias("ok"), (F.coalesce("ok", F.lit(False)) & ~F.coalesce("parsed", F.lit(False))).alias("parse_failed"), F.coalesce("empty", F.lit(False)).alias("empty_answer"), F.greatest(F.lit(0), F.coalesce("n_items", F.lit(0))).alias("n_items"), (F.length(clean("content")) > 0).alias("answered"), *[F.coalesce(c, F.lit(0)).alias(c) for c in counters])
    return out.withColumn("needs_retry", F.col("ok") & ((F.col("n_failures") > 0) | (F.col("parse_failed") & F.col("answered"))))


def feedback(rows: DataFrame, answers: DataFrame, problems: int = 25) -> DataFrame:
    """What a correction tells of the first answer: its first problems, in order, and the answer itself."""
    line = F.concat_ws(" ", F.coalesce(F.col("sent_id").cast("string"), F.lit("?")), "reject_code", F.coalesce("term_src", F.lit("")), F.coalesce("term_tgt", F.lit("")))
    told = rows.where("reject_code is not null").groupBy("file", "batch_idx").agg(F.array_sort(F.collect_list(F.struct("item_pos", "term_pos", line.alias("line")))).alias("all"))
    told = told.select("file", "batch_idx", F.array_join(F.transform(F.slice("all", 1, problems), lambda x: x["line"]), "\n").alias("told"))
    return answers.select("file", "batch_idx", "content").join(told, ["file", "batch_idx"], "left").select("file", "batch_idx", F.concat_ws("\n", F.coalesce("told", F.lit("the answer could not be read")), F.coalesce("content", F.lit(""))).alias("feedback"))


def better(first: DataFrame, second: DataFrame) -> DataFrame:
    """For each batch which answer counts: the second only if it keeps more rows, or as many with fewer failures."""
    key = ["file", "batch_idx"]
    both = first.select(*key, "n_kept", "n_failures", F.lit("first").alias("kind")).unionByName(second.select(*key, "n_kept", "n_failures", F.lit("correction").alias("kind")))
    best = F.max_by(F.struct("kind", "n_kept", "n_failures"), F.struct(F.col("n_kept"), -F.col("n_failures"), (F.col("kind") == "first").cast("int")))
    return both.groupBy(*key).agg(best.alias("b")).select(*key, "b.*")
