"""Operator 5 [native]: mixing sources to target weights by temperature.

A source's weight is its share of tokens to the power of an exponent between 0
(all alike) and 1 (as they are), normalised.  The exponent is bisected to the
largest whose mixture has a wanted entropy, or to the smallest that keeps every
source within a repetition limit.  The weights times the budget are the sources'
quotas, which are realised as permutations: each whole pass over a source takes
all its documents, the last, partial pass takes those that come first in a
hashed order, cut where the quota is reached.  A draw's place in its source's
quota decides the block of the mixture that it goes to, so every block holds all
sources in the target proportion, and each block has a permutation of its own.

Everything is made of DataFrame functions.  The order within a source comes from
sums over hashed blocks of bounded size and sums over those blocks, so a source
with a third of all rows is dealt over as many tasks as its size asks for.

Defined results: a null source is a source of its own; a null text has no tokens; a
source without any token gets no weight, and its documents are drawn once if
`cover`, else never; repeated rows are drawn as rows of their own; equal hashes
are ordered by doc_id; a budget beyond the repetition limit, which no exponent can
keep, is refused; very long texts count whole; an empty table gives an empty result; further columns are
ignored, or carried along by `mixed`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.llm.common import materialise

WORD = r"[^\x20\x09-\x0D]+"
#: Tokens and rows of a hashed block, at most about so many blocks, and tokens of a block of the mixture.
BLOCK_TOKENS, BLOCK_ROWS, MOST_BLOCKS, MIX_TOKENS = 60_000, 2_000, 1_000_000, 250_000
#: Halvings of the interval of exponents.
STEPS = 50


def tokens_of(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def unit(*what: Column) -> Column:
    """A hash as a number from 0 up to 1."""
    return F.shiftrightunsigned(F.xxhash64(*what), 11).cast("double") / F.lit(float(1 << 53))


def _total(a: Column, f) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda acc, x: acc + f(x))


def exponent(shares: Column, budget: Column, entropy: float | None, repeats: float | None, cover: bool) -> Column:
    """The bisected exponent for an array of shares; budget counts in passes over the whole corpus."""

    def keeps(a: Column) -> Column:
        power = _total(shares, lambda p: F.pow(p, a))
        if entropy is not None:  # of the mixture, in bits
            return _total(shares, lambda p: -(F.pow(p, a) / power) * F.log2(F.pow(p, a) / power)) >= entropy
        passes = F.transform(shares, lambda p: F.pow(p, a - 1))
        most = F.array_max(passes)
        return (most / F.array_min(passes) if cover else budget * most / power) <= repeats

    def step(s: Column, _: Column) -> Column:
        middle = (s["low"] + s["high"]) / 2
        good = keeps(middle)
        low, high = (F.when(good, middle).otherwise(s["low"]), F.when(good, s["high"]).otherwise(middle)) if entropy is not None else (F.when(good, s["low"]).otherwise(middle), F.when(good, middle).otherwise(s["high"]))
        return F.struct(low.alias("low"), high.alias("high"))

    span = F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), F.struct(F.lit(0.0).alias("low"), F.lit(1.0).alias("high")), step)
    return span["low" if entropy is not None else "high"]


def quotas(totals: DataFrame, budget: float, entropy: float | None, repeats: float | None, cover: bool) -> DataFrame:
    """source, total, docs, weight, quota, passes (whole ones), rest (tokens of the partial pass), blocks, mix_blocks.

    totals: source, total, docs; a row for each source, which is what comes together here.
    """
    if repeats is not None and not cover and budget > repeats:
        raise ValueError(f"a budget of {budget} passes repeats sources {budget} times on average, over the limit of {repeats}")
    one = totals.agg(F.array_sort(F.collect_list(F.struct("source", "total", "docs"))).alias("all"))
    one = one.withColumn("sum", _total(F.col("all"), lambda x: x["total"].cast("double")))
    one = one.withColumn("shares", F.transform(F.filter("all", lambda x: x["total"] > 0), lambda x: x["total"] / F.col("sum")))
    one = one.withColumn("exponent", exponent(F.col("shares"), F.lit(float(budget)), entropy, repeats, cover))
    one = one.withColumn("power", _total(F.col("shares"), lambda p: F.pow(p, F.col("exponent"))))
    # with cover the budget is the least that takes every document once
    cheapest = F.array_min(F.transform("shares", lambda p: F.pow(p, F.col("exponent") - 1) / F.col("power")))
    one = one.withColumn("tokens", F.col("sum") * (1 / cheapest if cover else F.lit(float(budget))))
    rows = one.select("sum", "exponent", "power", "tokens", F.explode("all").alias("s")).select("sum", "exponent", "power", "tokens", "s.*")
    weight = F.when(F.col("total") > 0, F.pow(F.col("total") / F.col("sum"), F.col("exponent")) / F.col("power")).otherwise(F.lit(0.0))
    rows = rows.withColumn("weight", weight).withColumn("quota", F.round(F.col("tokens") * F.col("weight")).cast("long"))
    if cover:
        rows = rows.withColumn("quota", F.greatest("quota", "total"))
    rows = rows.withColumn("passes", F.when(F.col("total") > 0, F.floor(F.col("quota") / F.col("total"))).otherwise(F.lit(int(cover))).cast("int"))
    per_block = F.greatest(F.lit(float(BLOCK_TOKENS)), F.col("sum") / MOST_BLOCKS)
    blocks = F.greatest(F.lit(1.0), F.ceil(F.col("total") / per_block).cast("double"), F.ceil(F.col("docs") / BLOCK_ROWS).cast("double")).cast("int")
    return rows.select("source", "total", "docs", "weight", "quota", "passes", (F.col("quota") - F.col("passes") * F.col("total")).alias("rest"), blocks.alias("blocks"), F.greatest(F.lit(1.0), F.ceil(F.col("tokens") / MIX_TOKENS).cast("double")).cast("int").alias("mix_blocks"))


def _named(source: Column) -> Column:
    """A source as a key that tells a null from every string."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def _draws(rows: DataFrame, plan: DataFrame, seed: int, carried: list[str]) -> DataFrame:
    """rows (key, salt, source, tokens, and carried columns) with a row for each draw: pass, block.

    salt tells apart rows that share a key, so they are dealt over blocks too.
    """
    rows = rows.join(plan, "source").withColumn("u", unit(F.lit(seed), F.col("passes"), F.col("key"), F.col("salt")))
    rows = rows.withColumn("part", F.floor(F.col("u") * F.col("blocks")).cast("int"))
    sums = rows.groupBy("source", "part").agg(F.sum("tokens").alias("n"))
    before = sums.select("source", "part", (F.sum("n").over(Window.partitionBy("source").orderBy("part")) - F.col("n")).alias("before"))
    inside = F.sum("tokens").over(Window.partitionBy("source", "part").orderBy("u", "key", "salt", "tokens").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("tokens")
    rows = rows.withColumn("inside", inside).join(before, ["source", "part"]).withColumn("at", F.col("before") + F.col("inside"))
    times = F.col("passes") + F.when(F.col("at") < F.col("rest"), 1).otherwise(0)
    rows = rows.where(times > 0).withColumn("pass", F.explode(F.sequence(F.lit(0), times - 1)))
    # a whole pass has its own order; the partial one that of the cut
    place = F.when(F.col("pass") < F.col("passes"), (F.col("pass") + unit(F.lit(seed + 1), F.col("pass"), F.col("key"), F.col("salt"))) * F.col("total")).otherwise(F.col("passes") * F.col("total") + F.col("at"))
    block = F.least(F.col("mix_blocks") - 1, F.floor(place / F.greatest("quota", F.lit(1)) * F.col("mix_blocks")).cast("int"))
    return rows.withColumn("block", block).select("key", "salt", "source", "tokens", "weight", "pass", "block", *carried)


def mixture(docs: DataFrame, budget: float = 1.0, entropy: float | None = None, repeats: float | None = 4.0, cover: bool = False, seed: int = 11) -> DataFrame:
    """doc_id, source, n_tokens, weight (of the source), pass, block, position (in the block's permutation).

    budget: tokens to draw, in passes over the corpus; entropy (bits) or repeats:
    the target.  cover: take the least budget that draws every document once.
    """
    rows = docs.select(F.col("doc_id").alias("key"), _named(F.col("source")).alias("source"), tokens_of(F.col("text")).alias("tokens"), F.monotonically_increasing_id().alias("salt"))
    rows = materialise(rows, "tokens")  # row numbers must not change when a task runs again
    totals = rows.groupBy("source").agg(F.sum("tokens").alias("total"), F.count(F.lit(1)).alias("docs"))
    plan = materialise(quotas(totals, budget, entropy, repeats, cover), "quotas")
    drawn = _draws(rows, plan, seed, [])
    order = Window.partitionBy("block").orderBy(F.xxhash64(F.lit(seed + 2), "key", "salt", "pass"), "key", "salt", "pass", "tokens")
    return drawn.select(F.col("key").alias("doc_id"), F.when(F.col("source") != "", F.expr("substring(source, 2)")).alias("source"), F.col("tokens").alias("n_tokens"), "weight", "pass", "block", F.row_number().over(order).alias("position"))


def mixed(docs: DataFrame, repeats: float = 2.0, seed: int = 11) -> DataFrame:
    """docs in the proportions of the mixture: every row at least once, rows of small sources up to about `repeats` times.

    All columns are carried as they are.
    """
    rows = docs.select(F.col("doc_id").alias("key"), F.monotonically_increasing_id().alias("salt"), _named(F.col("source")).alias("source"), tokens_of(F.col("text")).alias("tokens"), F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    rows = materialise(rows, "numbered")  # row numbers must not change when a task runs again, and tell equal rows apart
    totals = rows.groupBy("source").agg(F.sum("tokens").alias("total"), F.count(F.lit(1)).alias("docs"))
    plan = materialise(quotas(totals, 1.0, None, repeats, True), "quotas")
    # the texts go along to their hashed block, one shuffle; a join by doc_id would need one too and could not tell repeated rows apart
    return _draws(rows, plan, seed, ["row"]).select("row.*")
