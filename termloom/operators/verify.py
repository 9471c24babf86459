"""An independent look at what was delivered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.functions.text import TYPES, cjk_ratio

# The delivered columns, stated again on the checking side.
EXPECTED = ("sent_id", "src_text", "tgt_text", "term_src", "term_tgt", "types", "note", "term_src_dict", "term_tgt_dict")


def header_problems(columns: list[str]) -> list[str]:
    return [f"missing {c}" for c in EXPECTED if c not in columns]


def violations(rows: DataFrame) -> DataFrame:
    """A row for each broken rule of each delivered row."""
    known = F.array(*[F.lit(t) for t in TYPES])
    rules: dict[str, Column] = {
        "span_src": F.instr("src_text", F.col("term_src")) == 0,
        "span_tgt": F.instr("tgt_text", F.col("term_tgt")) == 0,
        "types": (F.col("types") == "") | F.exists(F.split("types", ","), lambda t: ~F.array_contains(known, t)),
        "note": F.col("note") != "",
        "dict_src": F.coalesce("term_src_dict", F.lit("")) == "",
        "dict_tgt": F.coalesce("term_tgt_dict", F.lit("")) == "",
    }
    broken = F.array_compact(F.array(*[F.when(F.coalesce(bad, F.lit(True)), F.lit(name)) for name, bad in rules.items()]))
    return rows.select("*", F.explode(broken).alias("rule"))


def form_class(rows: DataFrame, check=None, lang: Column | None = None) -> DataFrame:
    """rows with class of the foreign form: exact, restored, or neither; the Chinese side must be exact."""
    from termloom.functions.morph import check_form
    from termloom.functions.text import normalize_delivery

    src = cjk_ratio("src_text") < cjk_ratio("tgt_text")
    form, span = (F.when(src, F.col(f"term_src{s}")).otherwise(F.col(f"term_tgt{s}")) for s in ("_dict", ""))
    legal = (normalize_delivery(form) == normalize_delivery(span)) | ((check or check_form)(form, span, lang if lang is not None else F.lit("es")).isNull())
    return rows.withColumn("form_class", F.when(form == span, "exact").when(legal, "restored").otherwise("neither"))


def verdict(rows: DataFrame, most_neither: float) -> tuple[bool, dict]:
    """(passed, counts): structure must be clean, and the share of `neither` at most the cap; the two are judged apart."""
    classes = {r["form_class"]: r["count"] for r in form_class(rows).groupBy("form_class").count().collect()}
    broken = {r["rule"]: r["count"] for r in violations(rows).groupBy("rule").count().collect()}
    total = sum(classes.values())
    return not broken and (total == 0 or classes.get("neither", 0) / total <= most_neither), {"classes": classes, "broken": broken}


def lineage(delivered: DataFrame, raw: DataFrame) -> DataFrame:
    """Delivered rows that the raw rows don't bear out: missing, or with another form. Keys: out_name, sent_id, both spans."""
    key = ["out_name", "sent_id", "term_src", "term_tgt"]
    index = raw.groupBy(*key).agg(F.collect_set(F.struct("term_src_dict", "term_tgt_dict")).alias("forms"))
    own = F.struct("term_src_dict", "term_tgt_dict")
    return delivered.join(index, key, "left").withColumn("problem", F.when(F.col("forms").isNull(), "missing").when(~F.array_contains("forms", own), "other_form")).where("problem is not null").drop("forms")


def lineage_problems(spark: SparkSession, delivered: DataFrame, path: str) -> list[str]:
    """What the raw dump at path doesn't bear out, counted by problem; a dump that was never written is a problem of its own."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return ["no raw rows to compare with"]
    raw = spark.read.schema(delivered.schema).json(path)
    return [f"{r['count']} rows: {r['problem']}" for r in lineage(delivered, raw).groupBy("problem").count().orderBy("problem").collect()]
