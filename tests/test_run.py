import json

import pytest
from pyspark.sql import functions as F

from termloom.operators import answers, delivery, lexicon, metrics, prompts, provider, verify
from termloom.plans.run import corrected, extract, offline, plan
from termloom.sources import sinks
from termloom.streaming.pairs import stream_terms

PAIRS = [("f1", i, f"源句子{i} palabra", f"frase{'s' * (i % 3)} numero{i} larga") for i in range(1, 8)]


@pytest.fixture(scope="module")
def sentences(spark):
    return spark.createDataFrame(PAIRS, "file string, pos int, src string, tgt string")


def answer(spark, sentences, terms):
    """A run over hand-written answers: terms is what the model says for the first batch."""
    batches = plan(sentences, 10)
    key = batches.first()
    row = (key.file, key.batch_idx, key.batch_key, "first", True, terms if isinstance(terms, str) else json.dumps(terms), "stop", 200, None, 1, 0, 10, 0, 10, 0, "m", None, "w")
    return batches, spark.createDataFrame([row], provider.RESPONSE)


def test_rejections_and_counters(spark, sentences):
    good = {"term_src": "PALABRA", "term_tgt": "larga", "dict_form": "larga", "types": ["Tech", "other"]}
    items = [
        {"sent_id": 1, "terms": [good, {**good, "term_tgt": "zzz"}, {**good, "term_src": "zzz"}, {**good, "term_src": " "}, "junk"]},
        {"sent_id": "2", "terms": [{**good, "types": ["num"]}]},
        {"sent_id": 99, "terms": [good]}, {"sent_id": True, "terms": [good]}, {"sent_id": [1], "terms": [good]}, {"sent_id": 3, "terms": 5}, 7, {"sent_id": 4},
    ]
    run = extract(*answer(spark, sentences, items), lang="es")
    codes = {r.reject_code: r["count"] for r in run.rows.groupBy("reject_code").count().collect()}
    assert codes == {None: 2, "bad_anchor_tgt": 1, "bad_anchor_src": 1, "empty_side": 1, "term_not_object": 1, "bad_sent_id": 3, "terms_not_list": 1, "item_not_object": 1}
    kept = run.terms.orderBy("sent_id").collect()
    assert [(r.span_src, r.types) for r in kept] == [("palabra", ["tech"]), ("palabra", ["other"])]
    o = run.outcomes.first()
    assert (o.n_kept, o.n_failures, o.n_items, o.parse_failed, o.needs_retry, o.n_type_fallback) == (2, 9, 8, False, True, 1)


def test_empty_answer_is_no_failure(spark, sentences):
    run = extract(*answer(spark, sentences, []), lang="es")
    o = run.outcomes.first()
    assert o.empty_answer and not o.parse_failed and not o.needs_retry
    assert run.metrics().first().incomplete_rate == 0
    bad = extract(*answer(spark, sentences, "I can't"), lang="es")
    assert bad.outcomes.first().parse_failed and bad.outcomes.first().needs_retry
    assert provider.tombstones(bad.outcomes).count() == 1 and provider.tombstones(run.outcomes).count() == 0


def test_forms(spark, sentences):
    term = {"term_src": "palabra", "term_tgt": "numero1 larga", "types": ["tech"]}
    for form, base, error, noop in (("numero1 largo", "", "gender_flipped", False), ("numero1 larga", "", None, False), ("numero1 largas", "numero1 largas", None, False), (None, "", "form_missing", False)):
        run = extract(*answer(spark, sentences, [{"sent_id": 1, "terms": [{**term, "dict_form": form}]}]), lang="es")
        r = run.rows.first()
        assert (r.base_tgt, r.form_error, r.form_noop, r.base_src) == (base, error, noop, "")


@pytest.mark.parametrize("shape", ["bare", "fenced", "wrapped", "trailing"])
def test_offline_shapes(spark, sentences, shape):
    run = offline(sentences, lambda: provider.RuleProvider(shape=shape))
    assert run.terms.count() == 7 and verify.violations(delivery.table(run.terms)).count() == 0
    assert delivery.table(run.terms).columns == list(verify.EXPECTED) and not verify.header_problems(delivery.COLUMNS)


def test_correction_keeps_the_better(spark, sentences):
    first = offline(sentences, lambda: provider.RuleProvider(noise=2))
    assert first.terms.count() == 4
    both = corrected(first, provider.RuleProvider)
    assert both.terms.count() == 7 and both.outcomes.count() == first.outcomes.count()
    tie = answers.better(first.outcomes, first.outcomes).first()
    assert tie.kind == "first"


def test_vote(spark):
    rows = [("f", "天", "dias", "dia"), ("f", "天", "dias", "dia"), ("f", "天", "dias", ""), ("f", "日", "dias", ""), ("f", "日", "dias", "día"), ("g", "天", "dias", ""), ("h", "天", "x", "b"), ("h", "天", "x", "a")]
    data = [(i, f, s, t, b, "", 0, 0, 0) for i, (f, s, t, b) in enumerate(rows)]
    d = spark.createDataFrame(data, "sent_id long, file string, span_src string, span_tgt string, base_tgt string, base_src string, batch_idx int, item_pos int, term_pos int")
    voted = delivery.majority_vote(d)
    assert [r.base_tgt for r in voted.orderBy("sent_id").collect()] == ["dia", "dia", "dia", "", "", "", "b", "b"]
    assert [r.base_tgt for r in delivery.majority_vote(voted).orderBy("sent_id").collect()] == ["dia", "dia", "dia", "", "", "", "b", "b"]


class Flaky(provider.Provider):
    def __init__(self, errors):
        self.errors = list(errors)

    def complete(self, messages, parameters):
        if self.errors:
            raise self.errors.pop(0)
        return {"content": "[]", "finish_reason": "stop", "prompt_tokens": 1, "cached_tokens": 0, "completion_tokens": 1, "reasoning_tokens": 0}


def test_retries():
    waits = []
    got = provider.call(Flaky([provider.CallError("slow", 429, 0.0), provider.CallError("net")]), [], {}, waits.append)
    assert got["ok"] and got["attempts"] == 3 and got["n429"] == 1 and waits[0] < 1.6 and 4 <= waits[1] <= 5.6
    assert provider.call(Flaky([provider.CallError("no", 401)]), [], {}, waits.append)["attempts"] == 1
    dead = provider.call(Flaky([provider.CallError("x", 500)] * 9), [], {}, lambda s: None)
    assert not dead["ok"] and dead["attempts"] == provider.ATTEMPTS
    assert provider.call(Flaky([ValueError("boom")]), [], {})["error"] == "ValueError: boom"


def test_registry():
    with pytest.raises(KeyError):
        provider.get_profile("none")
    p = provider.Profile("m", efforts=("low",), numeric_effort=True)
    assert p.effort_ok(None) and p.effort_ok("low") and p.effort_ok("100") and not p.effort_ok("101") and not p.effort_ok("max")
    assert provider.fingerprint({"a": 1, "b": 2}) == provider.fingerprint({"b": 2, "a": 1})
    assert len(provider.prompt_hash("a", "b")) == 12 and provider.prompt_hash("ab", "") != provider.prompt_hash("a", "b")


class Costly(provider.RuleProvider):
    def complete(self, messages, parameters):
        return {**super().complete(messages, parameters), "prompt_tokens": 1_000_000}


class Broke(provider.RuleProvider):
    def complete(self, messages, parameters):
        raise provider.CallError("insufficient_quota", 403)


class Mumbling(provider.RuleProvider):
    def complete(self, messages, parameters):
        return {**super().complete(messages, parameters), "content": "hm"}


def test_waves_resume_and_stop(spark, sentences, tmp_path):
    batches = plan(sentences, 1)
    price = provider.Price(1.0, 0.0, 0.0)
    responses, skipped, why = provider.run_waves(batches, f"{tmp_path}/spend", Costly, provider.Breakers(1.5, price), wave=2)
    assert why == "spend" and 0 < skipped.count() == 7 - responses.count()
    responses, skipped, why = provider.run_waves(batches, f"{tmp_path}/spend", provider.RuleProvider, provider.Breakers(1e9, price), wave=2)
    assert why is None and skipped.count() == 0 and responses.count() == 7
    assert responses.where("prompt_tokens = 1000000").count() < 7
    again, _, _ = provider.run_waves(batches, f"{tmp_path}/spend", Broke, provider.Breakers(1e9, price))
    assert again.count() == 7
    _, skipped, why = provider.run_waves(batches, f"{tmp_path}/broke", Broke, provider.Breakers(1e9, price), wave=2)
    assert why == "balance" and skipped.count() > 0
    calm = provider.Breakers(1e9, price)
    calm.n429, calm.calls = 25, 1000
    assert calm.stop() is None
    calm.calls = 100
    assert calm.stop() == "rate"


def test_stored_answers_are_of_one_asking(spark, sentences, tmp_path):
    batches, path = plan(sentences, 4), f"{tmp_path}/r"

    def calls(make=provider.RuleProvider, **options):
        b = provider.Breakers(1e9, provider.Price(1.0, 1.0, 1.0))
        responses, skipped, why = provider.run_waves(batches, path, make, b, **options)
        assert responses.count() == 2 and skipped.count() == 0 and why is None
        return b.calls, responses

    assert calls()[0] == 2 and calls()[0] == 0
    assert calls(system="other")[0] == 2 and calls(effort="high")[0] == 2 and calls(reuse=False)[0] == 2
    unreadable = provider.run_waves(batches, path, Mumbling, provider.Breakers(1e9, provider.Price(1.0, 1.0, 1.0)), system="third")[0]
    provider.withdraw(path, unreadable, extract(batches, unreadable).outcomes)
    n, again = calls(system="third")
    assert n == 2 and again.where("content = 'hm'").count() == 0 and calls(system="third")[0] == 0


def test_correction_within_the_cap(spark, sentences, tmp_path):
    first = offline(sentences, lambda: provider.RuleProvider(noise=2))
    breakers = provider.Breakers(1e9, provider.Price(1.0, 1.0, 1.0))
    both = corrected(first, Broke, ask=lambda again: provider.run_waves(again, f"{tmp_path}/c", Broke, breakers, kind="correction")[0])
    assert breakers.calls == 1 and both.terms.count() == 4 and both.outcomes.where("ok").count() == 1


def test_prompts(spark, tmp_path):
    system, user = prompts.default_prompt(spark, "es")
    assert "term_src" in system and "dictionary form" in system and user == "{pairs}"
    (tmp_path / "p.txt").write_bytes(b"\xef\xbb\xbfrules\r\n===USER===\r\ndo {pairs}")
    assert prompts.read_prompt(spark, f"{tmp_path}/p.txt") == ("rules", "do {pairs}")


def test_metrics_and_gates(spark, sentences):
    run = offline(sentences, lambda: provider.RuleProvider(noise=2))
    m = run.metrics()
    gates = {r.gate: r.verdict for r in metrics.gates(m, analyzer_enabled=True).collect()}
    assert {g for g, v in gates.items() if v != "pass"} == {"anchor_pass"} and len(gates) == 9
    warned = {r.gate: r.verdict for r in metrics.gates(m, None, 1, 2, 3).collect()}
    assert (warned["sensitive_refusals"], warned["rate_limited"], warned["balance"]) == ("warn", "warn", "reject")
    calls = metrics.call_metrics(run.answers, provider.Price(1.0, 1.0, 1.0)).first()
    assert calls.calls == 1 and calls.refusal_rate == 0 and calls.usd > 0
    assert {r.gate: r.verdict for r in metrics.gates(m).collect()}["analyzer"] == "pass"
    empty = metrics.run_metrics(run.outcomes.limit(0)).first()
    assert empty.json_ok_rate == 0 and empty.terms_per_sentence == 0
    assert metrics.extrapolated(2.0, 4, 10) == 5.0 and metrics.extrapolated(1, 0, 5) == 0
    assert metrics.corpus_complete(99, 100) and not metrics.corpus_complete(98, 100) and metrics.corpus_complete(1, None)
    assert metrics.Preflight(free_gb=1, stale_outputs=2).problems(frozenset({"stale"})) == ["disk"]


def test_sinks(spark, sentences, tmp_path):
    run = offline(sentences)
    rows = delivery.table(run.terms, ["file", *delivery.ORDER[1:]]).withColumn("out_name", F.concat("file", F.lit("_term.xlsx")))
    books = sinks.sheets(rows)
    header, body = sinks.read_xlsx(books.first().content)
    assert header == delivery.COLUMNS and [r[0] for r in body] == list(range(1, 8)) and body[0][1].startswith("源句子1")
    assert sinks.package(books, f"{tmp_path}/p.zip", {"README.md": sinks.read_me("es", 1, 7), "FIELDS.txt": sinks.field_description()}) == 1
    assert sinks.package(books.limit(0), f"{tmp_path}/none.zip") == 0 and not (tmp_path / "none.zip").exists()
    sinks.write_tables(rows, f"{tmp_path}/t")
    with pytest.raises(Exception, match="already exists"):
        sinks.write_tables(rows, f"{tmp_path}/t")
    sinks.raw_dump(rows, f"{tmp_path}/raw")
    assert spark.read.json(f"{tmp_path}/raw").count() == 7
    sinks.save_report(run.metrics(), metrics.gates(run.metrics()), f"{tmp_path}/r.json")
    assert json.loads((tmp_path / "r.json").read_text())["metrics"]["terms_kept"] == 7
    lost = sinks.incomplete_table(run.batches, run.outcomes, run.batches)
    assert "positions 1-7: skipped" in sinks.incomplete_report(lost)
    assert sinks.xlsx_bytes(["a"], [["<&>\x00", None, 3]])
    key = tmp_path / "k"
    key.write_bytes(b"\xef\xbb\xbfabc\n")
    assert sinks.key_of("NO_SUCH_KEY", [str(key)]) == "abc" and len(sinks.key_mark("abc")) == 8
    with pytest.raises(ValueError, match="no key"):
        sinks.key_of("NO_SUCH_KEY")
    assert sinks.prompt_parts("s\n===USER===\nu {pairs}") == ("s", "u {pairs}")
    with pytest.raises(ValueError, match="pairs"):
        sinks.prompt_parts("s\n===USER===\nu")


def test_verify(spark, sentences):
    rows = delivery.table(offline(sentences).terms)
    broken = rows.withColumn("note", F.when(F.col("sent_id") == 1, "x").otherwise("")).withColumn("types", F.when(F.col("sent_id") == 2, "num").otherwise("tech"))
    assert {(r.sent_id, r.rule) for r in verify.violations(broken).collect()} == {(1, "note"), (2, "types")}
    odd = rows.withColumn("term_tgt_dict", F.when(F.col("sent_id") == 3, "otra cosa mas").otherwise(F.col("term_tgt_dict")))
    assert verify.verdict(odd, 0.5)[0] and not verify.verdict(odd, 0.1)[0] and not verify.verdict(broken, 1.0)[0]
    named = rows.withColumn("out_name", F.lit("o"))
    assert verify.lineage(named, named).count() == 0 and verify.lineage(named, named.where("sent_id > 1")).first().problem == "missing"


def test_lexicon(spark):
    own = lexicon.entries(spark)
    assert own.groupBy("lang", "head").count().where("count > 1").count() == 0
    terms = spark.createDataFrame([(1, "víveres de reserva", "es"), (2, "víveres", "es"), (3, "reserva natural", "es"), (4, "Archives du port", "fr"), (5, "cours d'assises", "fr")], "id long, term string, lang string")
    assert {r.id: r.head for r in lexicon.lookup_terms(terms, own).collect()} == {1: "víveres", 2: "víveres"}
    assert lexicon.lookup(terms.withColumn("word", F.lit("VÍVERES")), own).count() == 3
    assert lexicon.examples(own, "es", 2).count() == 2 and lexicon.meaning_shift(own).count() == 5 and lexicon.heads(own, "ru").count() == 3


def test_stream(spark, tmp_path):
    rows = [(1, 0, "user", "palabra una"), (1, 1, "assistant", "mundo dos"), (2, 0, "user", "x")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/in")
    q = stream_terms(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/ck")
    q.awaitTermination(120)
    got = spark.read.parquet(f"{tmp_path}/out").collect()
    assert [(r.span_src, r.span_tgt) for r in got] == [("palabra", "mundo")]
