"""Command line: python -m termloom.command run|verify ...

Exit codes: 0 done, 1 verification failed, 2 refused to start, 3 tables written
but the package withheld.
"""

from __future__ import annotations

import argparse
import importlib
import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.functions.morph import check_form, with_analyzer
from termloom.operators import dedup, delivery, metrics, planning, prompts, verify
from termloom.operators.provider import Breakers, Provider, RuleProvider, get_profile, run_waves, withdraw
from termloom.plans.run import corrected, extract, plan
from termloom.sources import corpus, sinks

GATES = ("degraded", "force", "incomplete", "partial-corpus", "slow", "balance", "rate-limit", "preflight")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="termloom")
    sub = p.add_subparsers(dest="what", required=True)
    r = sub.add_parser("run")
    r.add_argument("--corpus", required=True, help="folder of zips and JSON files")
    r.add_argument("--out", required=True)
    r.add_argument("--lang", default="es", choices=sorted(corpus.LANGUAGES))
    r.add_argument("--model", default="rules")
    r.add_argument("--effort")
    r.add_argument("--provider", help="module:name of a Provider class; without it the offline one")
    r.add_argument("--analyzer", help="module:name of a morphological analyzer")
    r.add_argument("--prompt", help="text file: instructions, then ===USER=== and the user's part with {pairs}")
    r.add_argument("--batch-size", type=int, default=planning.BATCH)
    r.add_argument("--concurrency", type=int, default=planning.CONCURRENCY)
    r.add_argument("--limit-files", type=int)
    r.add_argument("--limit-sentences", type=int)
    r.add_argument("--files")
    r.add_argument("--layer")
    r.add_argument("--sample-per-layer", type=int)
    r.add_argument("--max-spend", type=float, default=0.0, help="USD; 0: from the amount of work")
    r.add_argument("--registered-sentences", type=int)
    r.add_argument("--tag", default="run")
    for flag in ("no-cache", "no-correct-retry", "dry-run", "no-zip", "no-raw-dump"):
        r.add_argument(f"--{flag}", action="store_true")
    r.add_argument("--allow", action="append", default=[], choices=GATES, help="let a gate only warn; may be repeated")
    v = sub.add_parser("verify")
    v.add_argument("out")
    v.add_argument("--lang", default="es", choices=sorted(corpus.LANGUAGES))
    v.add_argument("--expect-files", type=int)
    v.add_argument("--max-neither", type=float, default=0.0)
    return p


def refuse(why: str) -> int:
    print(f"refused: {why}", file=sys.stderr)
    return 2


def named(place: str):
    """What module:name stands for."""
    module, _, name = place.partition(":")
    return getattr(importlib.import_module(module), name)


def run(spark: SparkSession, a: argparse.Namespace, make: type[Provider] = RuleProvider, analyzer=None) -> int:
    """One run from files to tables, package and report."""
    lang = a.lang.partition("_")[0]
    try:
        make = named(a.provider) if a.provider else make
        analyzer = named(a.analyzer)() if a.analyzer else analyzer
    except (ImportError, AttributeError) as e:
        return refuse(str(e))
    if analyzer is None and "degraded" not in a.allow:
        return refuse("no morphological analyzer; --allow degraded runs the native checks only")
    files, _ = corpus.load_corpus(spark, a.corpus)
    files = planning.select_files(files, a.files, a.layer, a.limit_files)
    clash = dedup.collisions(files).limit(5).collect()
    if clash:
        return refuse(f"several files would write {[(r.out_name, r.files) for r in clash]}")
    files = dedup.content_dedup(files, F.col("md5"), "basename")
    sentences = corpus.sentences_of(files.where("basename = representative"))
    batches = plan(sentences, a.batch_size, a.limit_sentences, a.sample_per_layer).join(files.select(F.col("basename").alias("file"), "md5"), "file")
    totals = batches.agg(F.count(F.lit(1)).alias("b"), F.coalesce(F.sum("n"), F.lit(0)).alias("s")).first()
    if not a.sample_per_layer and not a.limit_sentences and "partial-corpus" not in a.allow and not metrics.corpus_complete(totals["s"], a.registered_sentences):
        return refuse(f"{totals['s']} of {a.registered_sentences} registered sentences")
    if "slow" not in a.allow and planning.too_slow(totals["b"], a.concurrency):
        return refuse(f"{planning.eta_hours(totals['b'], a.concurrency):.1f} hours at concurrency {a.concurrency}")
    jvm = spark.sparkContext._jvm
    tables = jvm.org.apache.hadoop.fs.Path(f"{a.out}/tables")
    if "force" not in a.allow and tables.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(tables):
        return refuse(f"{a.out}/tables exists")
    if a.dry_run:
        print(json.dumps({"batches": totals["b"], "sentences": totals["s"], "budget": planning.auto_budget(totals["s"], a.batch_size), "hours": planning.eta_hours(totals["b"], a.concurrency)}))
        return 0
    profile = get_profile(a.model)
    if profile.price is None:
        return refuse(f"{a.model} has no price")
    enforce = {"spend", *({"balance"} - set(a.allow)), *(set() if "rate-limit" in a.allow else {"rate"})}
    breakers = Breakers(a.max_spend or planning.auto_budget(totals["s"], a.batch_size), profile.price, enforce=frozenset(enforce))
    try:
        system, user = prompts.read_prompt(spark, a.prompt) if a.prompt else prompts.default_prompt(spark, lang)
    except ValueError as e:
        return refuse(str(e))
    cache = f"{a.out}/responses"
    asking = {"wave": 5 * a.concurrency, "reuse": not a.no_cache, "effort": a.effort, "parallel": a.concurrency, "profile": profile, "system": system, "user": user}
    check = with_analyzer(analyzer) if analyzer else check_form
    responses, skipped, why = run_waves(batches, cache, make, breakers, **asking)
    done = extract(batches, responses, lang, check)
    stopped = [why]
    if not a.no_correct_retry and not why:

        def ask(again: DataFrame) -> DataFrame:
            nonlocal responses
            second, _, stop = run_waves(again, cache, make, breakers, kind="correction", **asking)
            stopped.append(stop)
            responses = responses.unionByName(second)
            return second

        done = corrected(done, make, lang, check, ask)
    withdraw(cache, responses, done.outcomes)
    keyed = sentences.select("file", F.col("pos").cast("long").alias("sent_id"), "out_id")
    made = done.terms.join(keyed, ["file", "sent_id"])
    rows = dedup.fan_out(made.join(files.select(F.col("basename").alias("file"), "digest"), "file").drop("file"), files.select("basename", "out_name", "layer", "digest"))
    out = delivery.table(rows, ["out_name", "layer", *delivery.ORDER[1:]])
    sinks.write_tables(out, f"{a.out}/tables", "overwrite" if "force" in a.allow else "errorifexists")
    out = spark.read.parquet(f"{a.out}/tables")
    if not a.no_raw_dump:
        sinks.raw_dump(out, f"{a.out}/raw")
    m = done.metrics() if why is None else metrics.run_metrics(done.outcomes, skipped)
    gates = metrics.gates(m, analyzer is not None, rate_limited=breakers.n429, balance_errors=breakers.balance)
    incomplete = m.first()["incomplete_rate"] > metrics.INCOMPLETE
    ended = next((x for x in stopped if x), None)
    sinks.save_report(m, gates, f"{a.out}/report-{a.tag}.json", {"stopped": ended, "calls": breakers.calls, "usd": breakers.spend})
    if incomplete:
        lost = sinks.incomplete_table(batches, done.outcomes, skipped)
        sinks.replace_file(f"{a.out}/incomplete.txt", sinks.incomplete_report(lost).encode())
        if "incomplete" not in a.allow:
            return 3
    if not a.no_zip:
        sinks.package(sinks.sheets(out), f"{a.out}/terms.zip", {"README.md": sinks.read_me(lang, out.select("out_name").distinct().count(), out.count()), "FIELDS.txt": sinks.field_description()})
    return 0


def check(spark: SparkSession, a: argparse.Namespace) -> int:
    rows = spark.read.parquet(f"{a.out}/tables")
    problems = verify.header_problems(rows.columns)
    if a.expect_files is not None and (n := rows.select("out_name").distinct().count()) != a.expect_files:
        problems.append(f"{n} files, {a.expect_files} expected")
    if not problems:
        problems += verify.lineage_problems(spark, rows, f"{a.out}/raw")
    passed, counts = verify.verdict(rows.withColumn("note", F.coalesce("note", F.lit(""))), a.max_neither) if not problems else (False, {})
    print(json.dumps({"passed": passed and not problems, "problems": problems, **counts}, ensure_ascii=False))
    return 0 if passed and not problems else 1


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    spark = SparkSession.builder.appName("termloom").getOrCreate()
    return run(spark, a) if a.what == "run" else check(spark, a)


if __name__ == "__main__":
    sys.exit(main())
