"""Numbers of a run and the gates they must pass."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.functions.text import balance_exhausted, refused
from termloom.operators.provider import Price, cost

# Limits of the gates.
JSON_OK, ANCHOR_PASS, INCOMPLETE, CORPUS_LOSS = 0.95, 0.90, 0.002, 0.01


def ratio(a: Column, b: Column) -> Column:
    """a over b, 0 where b is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def run_metrics(outcomes: DataFrame, skipped: DataFrame | None = None) -> DataFrame:
    """One row: sums over final outcomes (a batch counts by its last state) and the ratios made of them."""
    o = outcomes.agg(
        F.count(F.lit(1)).alias("batches"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("sentences"),
        F.count_if(~F.col("ok")).alias("call_failures"),
        F.count_if("parse_failed").alias("parse_failures"),
        F.count_if("empty_answer").alias("empty_answers"),
        F.coalesce(F.sum("n_kept"), F.lit(0)).alias("terms_kept"),
        F.coalesce(F.sum(F.col("n_kept") + F.col("n_failures")), F.lit(0)).alias("terms_proposed"),
        F.coalesce(F.sum("n_form_fallback"), F.lit(0)).alias("form_fallbacks"),
        F.coalesce(F.sum("n_form_ok"), F.lit(0)).alias("form_ok"),
    )
    n_skipped = skipped.agg(F.count(F.lit(1)).alias("skipped")) if skipped is not None else None
    o = o.join(n_skipped, F.lit(True)) if n_skipped is not None else o.withColumn("skipped", F.lit(0).cast("long"))  # one row each
    o = o.withColumn("attempted", F.col("batches") - F.col("call_failures"))
    o = o.withColumn("json_ok_rate", F.when(F.col("attempted") > 0, 1 - ratio(F.col("parse_failures"), F.col("attempted"))).otherwise(0.0))
    o = o.withColumn("anchor_pass_rate", ratio(F.col("terms_kept"), F.col("terms_proposed")))
    o = o.withColumn("form_fallback_rate", ratio(F.col("form_fallbacks"), F.col("form_fallbacks") + F.col("form_ok")))
    o = o.withColumn("sentences_effective", F.bround(F.col("sentences") * ratio(F.col("attempted"), F.col("batches"))).cast("long"))
    o = o.withColumn("terms_per_sentence", ratio(F.col("terms_kept"), F.col("sentences_effective")))
    return o.withColumn("incomplete_rate", ratio(F.col("call_failures") + F.col("parse_failures") + F.col("skipped"), F.col("batches") + F.col("skipped")))


def call_metrics(responses: DataFrame, price: Price) -> DataFrame:
    """One row: calls, refusals, hits of rate limits and of an empty account, tokens, cost."""
    tokens = ["prompt_tokens", "cached_tokens", "completion_tokens", "reasoning_tokens"]
    m = responses.agg(
        F.count(F.lit(1)).alias("calls"),
        F.count_if(refused("ok", "content", "finish_reason")).alias("refused"),
        F.coalesce(F.sum("n429"), F.lit(0)).alias("rate_limited"),
        F.count_if(~F.col("ok") & balance_exhausted("status", "error")).alias("balance_errors"),
        *[F.coalesce(F.sum(t), F.lit(0)).alias(t) for t in tokens],
    )
    m = m.withColumn("refusal_rate", ratio(F.col("refused"), F.col("calls"))).withColumn("cache_ratio", ratio(F.col("cached_tokens"), F.col("prompt_tokens")))
    return m.withColumn("usd", cost(F.col("prompt_tokens"), F.col("cached_tokens"), F.col("completion_tokens"), price))


def gates(metrics: DataFrame, analyzer_enabled: bool | None = None, sensitive_refusals: int = 0, rate_limited: int = 0, balance_errors: int = 0) -> DataFrame:
    """gate, value, verdict (pass, warn, reject) for each rule.

    sensitive_refusals: refused calls in the layer that must not be skipped.
    """
    rules = [
        ("json_ok", F.col("json_ok_rate"), (F.col("attempted") > 0) & (F.col("json_ok_rate") < JSON_OK)),
        ("anchor_pass", F.col("anchor_pass_rate"), (F.col("terms_proposed") > 0) & (F.col("anchor_pass_rate") < ANCHOR_PASS)),
        ("incomplete", F.col("incomplete_rate"), F.col("incomplete_rate") > INCOMPLETE),
        ("skipped", F.col("skipped").cast("double"), F.col("skipped") > 0),
        ("balance", F.lit(float(balance_errors)), F.lit(balance_errors > 0)),
        ("analyzer", F.lit({None: -1.0, True: 1.0, False: 0.0}[analyzer_enabled]), F.lit(analyzer_enabled is False)),
    ]
    warnings = [
        ("call_failures", F.col("call_failures").cast("double"), F.col("call_failures") > 0),
        ("sensitive_refusals", F.lit(float(sensitive_refusals)), F.lit(sensitive_refusals > 0)),
        ("rate_limited", F.lit(float(rate_limited)), F.lit(rate_limited > 0)),
    ]
    row = lambda name, value, bad, verdict: F.struct(F.lit(name).alias("gate"), value.cast("double").alias("value"), F.when(bad, verdict).otherwise("pass").alias("verdict"))
    rows = F.array(*[row(*r, "reject") for r in rules], *[row(*r, "warn") for r in warnings])
    return metrics.select(F.explode(rows).alias("g")).select("g.*")


def layer_stats(sentences: DataFrame, terms: DataFrame | None = None) -> DataFrame:
    """For each layer files, sentences, terms and terms a sentence."""
    out = sentences.groupBy("layer").agg(F.count_distinct("file").alias("files"), F.count(F.lit(1)).alias("sentences"))
    if terms is None:
        return out
    return out.join(terms.groupBy("layer").agg(F.count(F.lit(1)).alias("terms")), "layer", "left").withColumn("terms", F.coalesce("terms", F.lit(0))).withColumn("density", ratio(F.col("terms"), F.col("sentences")))


def issue_rollup(files: DataFrame) -> DataFrame:
    """Files for each kind of anomaly."""
    return files.select("basename", F.explode("issues").alias("i")).groupBy(F.col("i.code").alias("code")).agg(F.count_distinct("basename").alias("files"))


def extrapolated(cost: float, effective: int, target: int) -> float:
    return cost / effective * target if effective else 0.0


def corpus_complete(selected: int, registered: int | None) -> bool:
    """Whether an unsampled run has nearly all registered sentences; true if none are registered."""
    return not registered or selected >= registered * (1 - CORPUS_LOSS)


@dataclass
class Preflight:
    """What must hold before a paid run; every check can be told to warn only."""

    cache_writable: bool = True
    out_writable: bool = True
    free_gb: float = 1e9
    probe_ok: bool = True
    stale_outputs: int = 0

    def problems(self, warn_only: frozenset[str] = frozenset()) -> list[str]:
        found = {"cache": not self.cache_writable, "output": not self.out_writable, "disk": self.free_gb < 2, "probe": not self.probe_ok, "stale": self.stale_outputs > 0}
        return [k for k, bad in found.items() if bad and k not in warn_only]
