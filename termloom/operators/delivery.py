"""From kept rows to what is delivered: normal punctuation, one form per term and file, order, copies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.functions.text import cjk_ratio, normalize_delivery

ORDER = ["sent_id", "batch_idx", "item_pos", "term_pos"]
# The delivered columns in order.
COLUMNS = ["sent_id", "src_text", "tgt_text", "term_src", "term_tgt", "types", "note", "term_src_dict", "term_tgt_dict"]


def delivered(base: Column, span: Column) -> Column:
    return F.coalesce(F.nullif(base, F.lit("")), span)


def normalized(rows: DataFrame) -> DataFrame:
    """The foreign side's delivered form with normal punctuation; spans stay. changed tells where."""
    src = cjk_ratio("src_text") < cjk_ratio("tgt_text")
    for side, own in (("src", src), ("tgt", ~src)):
        span, base = F.col(f"span_{side}"), F.col(f"base_{side}")
        now = delivered(base, span)
        new = normalize_delivery(now)
        differs = own & (F.length(new) > 0) & (new != now)
        rows = rows.withColumn(f"_changed_{side}", differs).withColumn(f"base_{side}", F.when(differs, F.when(new == span, "").otherwise(new)).otherwise(base))
    return rows.withColumn("changed", F.col("_changed_src") | F.col("_changed_tgt")).drop("_changed_src", "_changed_tgt")


def majority_vote(rows: DataFrame, file: str = "file") -> DataFrame:
    """In each file one form for the same term and span: the most frequent; of equal ones the span, else the first.

    Votes are counted before the shuffle and joined back, so a frequent term isn't one task's window.
    """
    for side, other in (("src", "tgt"), ("tgt", "src")):
        key = [file, f"span_{other}", f"span_{side}"]
        form = delivered(F.col(f"base_{side}"), F.col(f"span_{side}"))
        votes = rows.withColumn("_form", form).groupBy(*key, "_form").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*ORDER)).alias("first"))
        first = F.struct(*[-F.coalesce(F.col(f"first.{c}").cast("long"), F.lit(0)) for c in ORDER])
        won = votes.groupBy(*key).agg(F.max_by("_form", F.struct(F.col("n"), (F.col("_form") == F.col(f"span_{side}")).cast("int"), first)).alias("_won"))
        rows = rows.join(won, key, "left").withColumn(f"base_{side}", F.when(F.col("_won") == F.col(f"span_{side}"), "").otherwise(F.coalesce("_won", f"base_{side}"))).drop("_won")
    return rows


def table(rows: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The delivered columns, after the keys in keep; sort by the keys of ORDER before cutting them off."""
    form = lambda side: delivered(F.col(f"base_{side}"), F.col(f"span_{side}")).alias(f"term_{side}_dict")
    return rows.select(*(keep or []), F.coalesce("out_id", "sent_id").alias("sent_id") if "out_id" in rows.columns else F.col("sent_id"), "src_text", "tgt_text", F.col("span_src").alias("term_src"), F.col("span_tgt").alias("term_tgt"), F.array_join("types", ",").alias("types"), F.lit("").alias("note"), form("src"), form("tgt"))


def finish(rows: DataFrame) -> DataFrame:
    """Normal punctuation first, then the vote: the vote counts what would be delivered."""
    return majority_vote(normalized(rows.where("reject_code is null")))
