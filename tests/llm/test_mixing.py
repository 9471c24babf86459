import math
import re

import pytest

from termloom.llm import mixing
from termloom.llm.mixing import mixed, mixture


def skewed(spark, n=400):
    rows = [(i, "w " * (5 + i % 17), "hot" if i % 2 else f"s{i % 6}", i) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, u long")


def totals(rows):
    out = {}
    for r in rows:
        out[r.source] = out.get(r.source, 0) + r.n_tokens
    return out


@pytest.mark.parametrize(("kw", "limit"), [({"repeats": 2.0, "cover": True}, 2.0), ({"repeats": 1.5}, 1.5), ({"budget": 3.0, "repeats": 4.0}, 4.0)])
def test_repetition_limit_and_quotas(spark, kw, limit):
    d = skewed(spark)
    own = {}
    for r in d.collect():
        own[r.source] = own.get(r.source, 0) + len(r.text.split())
    rows = mixture(d, **kw).collect()
    got, weights = totals(rows), {r.source: r.weight for r in rows}
    assert max(got[s] / own[s] for s in own) <= limit + 0.2
    assert abs(sum(weights.values()) - 1) < 1e-9
    for s in own:
        assert abs(got[s] / sum(got.values()) - weights[s]) < 0.02
    # a whole pass takes each document once, in each pass
    assert len({(r.doc_id, r["pass"]) for r in rows}) == len(rows)
    for b in {r.block for r in rows}:
        assert sorted(r.position for r in rows if r.block == b) == list(range(1, sum(r.block == b for r in rows) + 1))
    if kw.get("cover"):
        assert {r.doc_id for r in rows} == set(range(400))


def test_target_entropy(spark):
    rows = mixture(skewed(spark), entropy=1.9, repeats=None).collect()
    w = {r.source: r.weight for r in rows}.values()
    assert abs(-sum(x * math.log2(x) for x in w) - 1.9) < 1e-6


def test_documents(spark, edge, empty):
    assert mixture(empty).count() == 0 and mixed(empty).count() == 0
    rows = mixture(edge, repeats=2.0, cover=True).collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in edge.select("doc_id").collect()}
    out = mixed(edge)
    assert out.columns == edge.columns and out.count() >= edge.count()


def test_plan_has_no_python(spark, capsys):
    mixture(skewed(spark)).explain("formatted")
    assert not re.search("Python|Arrow|Pandas", capsys.readouterr().out)


@pytest.mark.parametrize("kw", [{"repeats": 1.3}, {"budget": 2.0, "repeats": 2.4}, {"entropy": 1.9, "repeats": None}, {"repeats": 2.0, "cover": True}])
def test_weights_and_quotas_match_brute_force(spark, kw):
    d = skewed(spark)
    own = {}
    for r in d.collect():
        own[r.source] = own.get(r.source, 0) + len(r.text.split())
    total, budget = sum(own.values()), kw.get("budget", 1.0)
    share = {s: n / total for s, n in own.items()}

    def weights(a):
        power = sum(p**a for p in share.values())
        return {s: p**a / power for s, p in share.items()}

    def good(a):
        w = weights(a)
        passes = {s: w[s] / share[s] for s in share}
        if kw.get("entropy"):
            return -sum(x * math.log2(x) for x in w.values()) >= kw["entropy"]
        if kw.get("cover"):
            return max(passes.values()) / min(passes.values()) <= kw["repeats"]
        return budget * max(passes.values()) <= kw["repeats"]

    low, high = 0.0, 1.0
    for _ in range(200):
        middle = (low + high) / 2
        if good(middle) == bool(kw.get("entropy")):
            low = middle
        else:
            high = middle
    want = weights(low)
    assert 0.02 < low < 0.98  # the target binds
    rows = mixture(d, **kw).collect()
    got, w = totals(rows), {r.source: r.weight for r in rows}
    passes = {s: want[s] / share[s] for s in share}
    tokens = total * (1 / min(passes.values()) if kw.get("cover") else budget)
    for s in own:
        assert abs(w[s] - want[s]) < 1e-9
        quota = round(tokens * want[s])
        assert quota <= got[s] < quota + 22  # the last document may reach over by its own length


def test_null_sources_repeated_rows_and_impossible_limits(spark):
    rows = [(None, "a b c", None)] * 50 + [(7, "a b", "")] * 50 + [(i, "x y z", "s") for i in range(100, 150)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixture(d, repeats=2.0, cover=True).collect()
    assert {r.source for r in got} == {None, "", "s"} and sum(r.source is None for r in got) >= 50 and sum(r.doc_id == 7 for r in got) >= 50
    assert mixed(d).count() >= 150
    with pytest.raises(ValueError):
        mixture(d, budget=3.0, repeats=2.0)


def test_equal_rows_are_dealt_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 200)
    held = []
    draws = mixing._draws
    monkeypatch.setattr(mixing, "_draws", lambda rows, *rest: held.append(rows) or draws(rows, *rest))
    rows = [(7, "the same row", "s")] * 4000 + [(i, "another row", "s") for i in range(100, 4100)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert mixed(d).count() == 8000
    part = mixing.F.floor(mixing.unit(mixing.F.lit(11), mixing.F.lit(1), mixing.F.col("key"), mixing.F.col("salt")) * 40)
    sizes = [r["count"] for r in held[0].groupBy(part).count().collect()]
    assert len(sizes) == 40 and max(sizes) < 300
