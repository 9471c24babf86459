"""Model calls: a provider interface, an offline provider, retries, a cache of responses, and breakers.

A call may cost money, so its result is written before anything reads it: waves
of batches go out, are appended to the responses table, and only then parsed.
"""

from __future__ import annotations

import hashlib
import json
import random
import re
import time
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.functions.text import RATE_LIMIT_HITS, RATE_LIMIT_SHARE, balance_exhausted, refused, truncated
from termloom.sources.scratch import materialise

# Attempts and seconds of a call, retried statuses, limits of what a correction feeds back.
ATTEMPTS, TIMEOUT, SLOT = 5, 300, 900
RETRIED = {408, 409, 425, 429, 500, 502, 503, 504}
PROBLEMS, FEEDBACK_CHARS = 25, 20_000

RESPONSE = "file string, batch_idx int, batch_key string, kind string, ok boolean, content string, finish_reason string, status int, error string, attempts int, n429 int, prompt_tokens long, cached_tokens long, completion_tokens long, reasoning_tokens long, model string, effort string, wire_fp string"
ANSWERED = f"{RESPONSE}, prompt_hash string"
#: A stored response: the call's own columns, what it was asked, and the run and wave that called.
STORED = f"{ANSWERED}, run long, wave int"
#: What tells askings of one model, effort and kind apart, and what names one stored response.
ASKING = ["file", "batch_idx", "batch_key", "prompt_hash"]
NAMED = [*ASKING, "model", "effort", "kind", "run"]


@dataclass(frozen=True)
class Price:
    """USD for a million tokens."""

    inp: float
    out: float
    cached: float


@dataclass(frozen=True)
class Profile:
    """What is known of a model; a model without a price is an error where costs are asked for."""

    name: str
    ceiling: int = 100
    efforts: tuple[str, ...] = ()
    numeric_effort: bool = False
    default_effort: str | None = None
    output_caps: dict[str, int] = field(default_factory=dict)
    price: Price | None = None

    def effort_ok(self, effort: str | None) -> bool:
        if effort is None:
            return True
        if self.numeric_effort and effort.isdigit():
            return 1 <= int(effort) <= 100
        return effort in self.efforts

    def parameters(self, effort: str | None) -> dict:
        """What goes over the wire beside the messages; no temperature."""
        effort = effort or self.default_effort
        if not self.effort_ok(effort):
            raise ValueError(f"{self.name} has no effort {effort!r}")
        cap = self.output_caps.get(effort or "")
        if cap is None and effort and effort.isdigit():
            cap = 4_000 + 600 * int(effort)
        return {"effort": effort, "max_output_tokens": cap or 32_000, "response_format": "json"}


#: Models by name; users register their own.
REGISTRY: dict[str, Profile] = {"rules": Profile("rules", ceiling=64, efforts=("low", "high"), default_effort="low", price=Price(1.0, 4.0, 0.1))}


def get_profile(name: str) -> Profile:
    if name not in REGISTRY:
        raise KeyError(f"unknown model {name!r}; known are {sorted(REGISTRY)}")
    return REGISTRY[name]


def fingerprint(parameters: dict) -> str:
    return hashlib.sha256(json.dumps(parameters, sort_keys=True, ensure_ascii=False).encode()).hexdigest()[:12]


def prompt_hash(system: str, user: str) -> str:
    return hashlib.sha256(f"{system}\0{user}".encode()).hexdigest()[:12]


class CallError(Exception):
    def __init__(self, message: str, status: int | None = None, retry_after: float | None = None) -> None:
        super().__init__(message)
        self.status, self.retry_after = status, retry_after


class Provider:
    """complete() answers one batch, or raises CallError; it is made once a task."""

    model = "rules"

    def complete(self, messages: list[dict], parameters: dict) -> dict:
        raise NotImplementedError


class RuleProvider(Provider):
    """Offline and deterministic: of each side the first word of enough letters, in the contract's shape.

    `shape` wraps the answer as models do: bare, fenced, wrapped, trailing.
    `noise` n: every n-th term gets a span that its sentence lacks.
    """

    def __init__(self, least: int = 4, shape: str = "bare", noise: int = 0) -> None:
        self.least, self.shape, self.noise = least, shape, noise

    def complete(self, messages: list[dict], parameters: dict) -> dict:
        out = []
        for pair in json.loads(messages[-1]["pairs"]):
            a, b = (re.search(rf"[^\W\d_]{{{self.least},}}", pair[s]) for s in ("src", "tgt"))
            terms = []
            if a and b:
                span = b[0] + ("#" if self.noise and pair["sent_id"] % self.noise == 0 else "")
                terms = [{"term_src": a[0], "term_tgt": span, "dict_form": span, "types": ["other"], "note": ""}]
            out.append({"sent_id": pair["sent_id"], "terms": terms})
        text = json.dumps(out, ensure_ascii=False)
        text = {"bare": text, "fenced": f"```json\n{text}\n```", "wrapped": f'{{"result": {text}}}', "trailing": re.sub(r"\]$", ",]", text) if out else text}[self.shape]
        size = sum(len(m.get("content", "")) + len(m.get("pairs", "")) for m in messages)
        return {"content": text, "finish_reason": "stop", "prompt_tokens": size // 4, "cached_tokens": 0, "completion_tokens": len(text) // 4, "reasoning_tokens": 0}


def messages_for(pairs: list[dict], system: str, user: str) -> list[dict]:
    body = json.dumps([{"sent_id": p["pos"], "src": p["src"], "tgt": p["tgt"]} for p in pairs], ensure_ascii=False, indent=2)
    return [{"role": "system", "content": system}, {"role": "user", "content": user.replace("{pairs}", body), "pairs": body}]


def call(provider: Provider, messages: list[dict], parameters: dict, sleep: Callable[[float], None] = time.sleep, seed: int = 0) -> dict:
    """One call with retries; never raises.  A Retry-After of 0 is honoured."""
    jitter, began = random.Random(seed), time.monotonic()
    n429, last = 0, CallError("not called")
    for attempt in range(1, ATTEMPTS + 1):
        try:
            return {"ok": True, "error": None, "status": 200, "attempts": attempt, "n429": n429, **provider.complete(messages, parameters)}
        except CallError as e:
            last = e
            n429 += e.status == 429
            if e.status is not None and e.status not in RETRIED or attempt == ATTEMPTS or time.monotonic() - began > SLOT:
                break
            sleep(min(60.0, e.retry_after if e.retry_after is not None else 2.0**attempt) + jitter.uniform(0, 1.5))
        except Exception as e:  # a batch's failure is a row, never the task's
            last = CallError(f"{type(e).__name__}: {e}")
            break
    return {"ok": False, "content": None, "finish_reason": None, "error": str(last), "status": last.status, "attempts": attempt, "n429": n429, "prompt_tokens": 0, "cached_tokens": 0, "completion_tokens": 0, "reasoning_tokens": 0}


def asked(batches: DataFrame, system: str, user: str) -> DataFrame:
    """batches with prompt_hash: of both prompts and, in a correction, of what it feeds back."""
    own = F.lit(prompt_hash(system, user))
    if "feedback" in batches.columns:
        told = F.substring(F.coalesce("feedback", F.lit("")), 1, FEEDBACK_CHARS)
        own = F.substring(F.sha2(F.concat_ws("\n", own, told), 256), 1, 12)
    return batches.withColumn("prompt_hash", own)


def respond(batches: DataFrame, make: Callable[[], Provider], system: str = "", user: str = "{pairs}", effort: str | None = None, kind: str = "first", parallel: int = 8, profile: Profile | None = None) -> DataFrame:
    """A response for each batch; at most `parallel` tasks call at a time, within the model's ceiling."""
    profile = profile or get_profile(make().model)
    parameters = profile.parameters(effort)
    wire, known = fingerprint(parameters), asdict(profile)["name"]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        provider = make()
        for part in parts:
            rows = []
            for r in part.itertuples(index=False):
                feedback = getattr(r, "feedback", None)
                messages = messages_for([dict(zip(("pos", "src", "tgt"), (p["pos"], p["src"], p["tgt"]), strict=True)) for p in r.pairs], system, user)
                if feedback:
                    messages[-1]["content"] += "\n" + feedback[:FEEDBACK_CHARS]
                got = call(provider, messages, parameters)
                rows.append({"file": r.file, "batch_idx": r.batch_idx, "batch_key": r.batch_key, "kind": kind, **got, "model": known, "effort": parameters["effort"], "wire_fp": wire, "prompt_hash": r.prompt_hash})
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in ANSWERED.split(", ")])

    columns = [*ASKING, "pairs"] + [c for c in ("feedback",) if c in batches.columns]
    return asked(batches, system, user).select(*columns).repartition(max(1, min(parallel, profile.ceiling))).mapInPandas(run, ANSWERED)


def cacheable() -> Column:
    return F.col("ok") & ~refused("ok", "content", "finish_reason") & ~truncated("finish_reason")


def worklist(batches: DataFrame, cache: DataFrame, on: list[str] | None = None) -> DataFrame:
    """Batches without a kept response."""
    on = on or ["file", "batch_idx", "batch_key"]
    return batches.join(cache.select(*on).distinct(), on, "left_anti")


def valid_cache(cache: DataFrame, tombstones: DataFrame | None = None, wire_fp: str | None = None) -> DataFrame:
    """Kept responses of the same parameters (old ones without a fingerprint count) that no tombstone withdrew.

    A tombstone withdraws by as many of a response's names as it holds: a batch
    as a whole, or one response of one run.
    """
    if wire_fp:
        cache = cache.where(F.col("wire_fp").isNull() | (F.col("wire_fp") == wire_fp))
    if tombstones is None:
        return cache
    on = [c for c in NAMED if c in tombstones.columns and c != "effort"]
    return cache.join(tombstones.select(*on).distinct(), on, "left_anti")


def tombstones(outcomes: DataFrame) -> DataFrame:
    """Batches whose final answer couldn't be read; an empty array is an answer and stays."""
    return outcomes.where("parse_failed").select("file", "batch_key")


def cost(prompt: Column, cached: Column, completion: Column, price: Price) -> Column:
    return ((prompt - cached) * F.lit(price.inp) + cached * F.lit(price.cached) + completion * F.lit(price.out)) / F.lit(1e6)


@dataclass
class Breakers:
    """Sums over waves; stop() names the first reason not to send another."""

    max_spend: float
    price: Price
    calls: int = 0
    n429: int = 0
    spend: float = 0.0
    balance: int = 0
    enforce: frozenset[str] = frozenset({"spend", "rate", "balance"})

    def add(self, responses: DataFrame) -> None:
        row = responses.agg(
            F.count(F.lit(1)).alias("calls"),
            F.coalesce(F.sum("n429"), F.lit(0)).alias("n429"),
            F.coalesce(F.sum(cost(F.col("prompt_tokens"), F.col("cached_tokens"), F.col("completion_tokens"), self.price)), F.lit(0.0)).alias("spend"),
            F.count_if(~F.col("ok") & balance_exhausted("status", "error")).alias("balance"),
        ).first()
        self.calls += row["calls"]
        self.n429 += row["n429"]
        self.spend += row["spend"]
        self.balance += row["balance"]

    def stop(self) -> str | None:
        if self.balance and "balance" in self.enforce:
            return "balance"
        if self.n429 >= RATE_LIMIT_HITS and self.n429 > RATE_LIMIT_SHARE * max(1, self.calls) and "rate" in self.enforce:
            return "rate"
        if self.spend > self.max_spend and "spend" in self.enforce:
            return "spend"
        return None


def _exists(spark, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def stored(spark, path: str) -> DataFrame:
    """All responses of the table at path that nothing withdrew; none if there is no table.

    Rows of a table that lacks prompt_hash have null there and answer no asking.
    """
    if not _exists(spark, path):
        return spark.createDataFrame([], STORED)
    rows, gone = spark.read.schema(STORED).parquet(path), f"{path}.withdrawn"
    return valid_cache(rows, spark.read.parquet(gone)) if _exists(spark, gone) else rows


def withdraw(path: str, responses: DataFrame, outcomes: DataFrame) -> None:
    """Withdraw the answers, of either kind, to batches whose final answer couldn't be read: the next run asks again."""
    gone = responses.where("ok").join(tombstones(outcomes).distinct(), ["file", "batch_key"], "left_semi")
    gone.select(*NAMED).write.mode("append").parquet(f"{path}.withdrawn")


def _latest(batches: DataFrame, rows: DataFrame) -> DataFrame:
    """The last run's response to each of the askings in batches."""
    mine = rows.join(batches.select(*ASKING), ASKING, "left_semi")
    return mine.join(mine.groupBy(*ASKING).agg(F.max("run").alias("run")), [*ASKING, "run"])


def run_waves(batches: DataFrame, path: str, make: Callable[[], Provider], breakers: Breakers, wave: int = 40, reuse: bool = True, **options) -> tuple[DataFrame, DataFrame, str | None]:
    """(responses, skipped batches, why it stopped): waves of batches, each appended to the table at path before the next.

    A good answer that the table holds isn't asked for again if it is of the same
    batch, prompt, feedback, model, effort, parameters and kind; failed, refused,
    truncated and withdrawn ones are.  So a stopped run resumes.  reuse=False asks
    for all and counts nothing of earlier runs.  The batches are written once, in
    the order of their waves, so a wave reads its own and no input again.  Only
    the number of waves is known to the driver, never the batches.
    """
    spark = batches.sparkSession
    if spark.conf.get("spark.speculation", "false") == "true":
        raise ValueError("switch spark.speculation off: it would pay for calls twice")
    profile = options.get("profile") or get_profile(make().model)
    parameters, kind = profile.parameters(options.get("effort")), options.get("kind", "first")
    batches = asked(batches, options.get("system", ""), options.get("user", "{pairs}"))

    def same() -> DataFrame:
        rows = valid_cache(stored(spark, path), None, fingerprint(parameters))
        return rows.where((F.col("model") == profile.name) & F.col("effort").eqNullSafe(F.lit(parameters["effort"])) & (F.col("kind") == kind))

    last = spark.read.schema(STORED).parquet(path).agg(F.max("run")).first()[0] if _exists(spark, path) else None
    run = (last or 0) + 1
    todo = worklist(batches, same().where(F.coalesce(cacheable(), F.lit(False))), ASKING) if reuse else batches
    columns = [*ASKING, "pairs"] + [c for c in ("feedback",) if c in batches.columns]
    todo = materialise(todo.select(*columns, F.pmod(F.xxhash64("file", "batch_key", "batch_idx"), F.lit(1 << 20)).alias("_turn")).orderBy("_turn"), "todo")
    n = todo.count()
    waves = max(1, -(-n // wave))
    why = None
    for i in range(waves if n else 0):
        turn = F.col("_turn")
        mine = todo.where((turn >= (i << 20) // waves) & (turn < ((i + 1) << 20) // waves))
        done = respond(mine.drop("_turn", "prompt_hash"), make, **options)
        done.withColumn("run", F.lit(run).cast("long")).withColumn("wave", F.lit(i)).write.mode("append").parquet(path)
        breakers.add(spark.read.schema(STORED).parquet(path).where((F.col("run") == run) & (F.col("wave") == i)))
        if why := breakers.stop():
            break
    rows = same() if reuse else same().where(F.col("run") == run)
    responses = _latest(batches, rows)
    return responses, worklist(batches, responses, ASKING).drop("prompt_hash"), why
