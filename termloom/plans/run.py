"""The whole run: pairs to delivered terms."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.functions.morph import check_form
from termloom.functions.text import usable
from termloom.operators import answers, delivery, metrics, planning
from termloom.operators.provider import Provider, RuleProvider, respond
from termloom.sources.scratch import materialise


@dataclass
class Run:
    """Tables of a run; responses and validated rows are written before anything reads them twice."""

    batches: DataFrame
    answers: DataFrame
    rows: DataFrame
    outcomes: DataFrame
    terms: DataFrame

    def metrics(self) -> DataFrame:
        return metrics.run_metrics(self.outcomes)


def plan(sentences: DataFrame, batch_size: int = planning.BATCH, limit_sentences: int | None = None, sample_per_layer: int | None = None) -> DataFrame:
    """Batches of usable sentences: what a dry run returns."""
    chosen = sentences.where(usable("src", "tgt"))
    if limit_sentences:
        chosen = planning.per_file_limit(chosen, limit_sentences)
    if sample_per_layer:
        chosen = planning.stratified_head(chosen, sample_per_layer)
    return planning.batches(chosen, batch_size)


def extract(batches: DataFrame, responses: DataFrame, lang: str | None = None, check=check_form) -> Run:
    """What responses say about batches."""
    read = materialise(answers.parsed(responses), "answers")
    rows = materialise(answers.validated(answers.proposals(read), batches, F.lit(lang).cast("string"), check), "rows")
    return Run(batches, read, rows, answers.outcomes(batches, read, rows), delivery.finish(rows))


def corrected(first: Run, make: Callable[[], Provider], lang: str | None = None, check=check_form, ask: Callable[[DataFrame], DataFrame] | None = None) -> Run:
    """A second answer for batches that need one; each batch keeps the better of the two.

    `ask` gets the batches with their feedback and returns responses, as waves
    under a cap do; without it all are asked at once.  A batch that got no
    readable second answer keeps its first.
    """
    todo = materialise(first.outcomes.where("needs_retry").select("file", "batch_idx"), "retries")
    again = first.batches.join(todo, ["file", "batch_idx"]).join(answers.feedback(first.rows, first.answers), ["file", "batch_idx"], "left")
    said = ask(again) if ask else respond(again, make, kind="correction")
    second = extract(first.batches.join(todo, ["file", "batch_idx"], "left_semi"), said, lang, check)
    second.outcomes = second.outcomes.where("ok and not parse_failed")
    kept = materialise(answers.better(first.outcomes, second.outcomes).select("file", "batch_idx", "kind"), "kept")

    def of(kind: str, df: DataFrame) -> DataFrame:
        return df.join(kept.where(F.col("kind") == kind).select("file", "batch_idx"), ["file", "batch_idx"], "left_semi")

    rows = of("first", first.rows).unionByName(of("correction", second.rows))
    states = of("first", first.outcomes).unionByName(of("correction", second.outcomes))
    read = of("first", first.answers).unionByName(of("correction", second.answers), allowMissingColumns=True)
    return Run(first.batches, read, rows, states, delivery.finish(rows))


def offline(sentences: DataFrame, make: Callable[[], Provider] = RuleProvider, lang: str | None = None, batch_size: int = planning.BATCH) -> Run:
    """A run with the offline provider."""
    planned = materialise(plan(sentences, batch_size), "batches")
    return extract(planned, respond(planned, make), lang)
