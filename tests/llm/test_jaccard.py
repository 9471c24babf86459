import random
import re
from collections import Counter, defaultdict

import pytest

from termloom.llm import jaccard
from termloom.llm.jaccard import one_of_each, similar

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, k):
    w = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOW))
    return frozenset([tuple(w)] if 0 < len(w) < k else zip(*[w[i:] for i in range(k)], strict=False))


def brute(rows, k, num):
    sets = [shingle_set(t, k) for _, t in rows]
    parent, links = list(range(len(rows))), Counter()

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= num * len(a | b):
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    groups = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            groups[find(i)].append(d)
    return sorted((str(d), len(sets[i]), str(min(groups[find(i)], default=None)), links[i]) for i, (d, _) in enumerate(rows))


@pytest.mark.parametrize(("k", "num", "hot", "block"), [(3, 90, 24, 384), (5, 80, 24, 384), (2, 40, 2, 7), (3, 60, 3, 16)])
def test_components_match_brute_force(spark, mixed_docs, monkeypatch, k, num, hot, block):
    monkeypatch.setattr(jaccard, "HOT", hot)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rows = [(r.doc_id, r.text) for r in mixed_docs.select("doc_id", "text").collect()]
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.n_links) for r in similar(mixed_docs, k, num, 100).collect())
    assert got == brute(rows, k, num)


def test_documents(spark, edge, empty):
    rows = [(r.doc_id, r.text) for r in edge.select("doc_id", "text").collect()]
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.n_links) for r in similar(edge).collect())
    assert got == brute(rows, 3, 90)
    assert similar(empty).count() == 0
    out = one_of_each(edge)
    assert out.columns == edge.columns
    kept = {r.doc_id for r in out.select("doc_id").collect()}
    assert {0, 1, 2, 3, 4, 6, 7, 9, None} <= kept and not kept & {5, 8, 10}


def test_rows_without_ids_cost_what_others_do(spark):
    import time

    from pyspark.sql import functions as F

    rng = random.Random(6)
    texts = []
    for _ in range(5000):
        w = [f"w{rng.randrange(10**6)}" for _ in range(60)]
        texts += [" ".join(w), " ".join([*w[:-1], "end"])]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4).cache()
    seconds = []
    for docs in (d, d.withColumn("doc_id", F.lit(None).cast("long"))):
        began = time.monotonic()
        got = similar(docs).groupBy("n_links").count().collect()
        seconds.append(time.monotonic() - began)
        assert [tuple(r) for r in got] == [(1, 10_000)]
    assert seconds[1] < 2 * seconds[0] + 5


def test_a_large_group_of_different_near_copies(spark):
    base = [f"w{i}" for i in range(300)]
    texts = [" ".join([*base, *(f"x{i}y{j}" for j in range(3))]) for i in range(900)]  # all shingles but a few are in all
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = similar(d).groupBy("component_id", "n_links").count().collect()
    assert [tuple(r) for r in got] == [(0, 899, 900)]


def test_one_row_of_each_component_whatever_the_ids(spark):
    a, b, near = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(1, a), (2, a), (2, b), (3, near + " x"), (3, near), (3, near), (None, a), (None, "alone is this one text"), (4, None), (4, None), (5, b)]
    d = spark.createDataFrame([(i, t, str(n), n, {"k": n}) for n, (i, t) in enumerate(rows)], "doc_id long, text string, c string, row int, rest map<string,int>")
    out = one_of_each(d)
    assert out.columns == d.columns and out.schema["rest"].dataType == d.schema["rest"].dataType
    got = [(r.doc_id, r.text, r.c, r.row, r.rest) for r in out.collect()]
    assert all((r[0], r[1]) == rows[r[3]] and r[2] == str(r[3]) and r[4] == {"k": r[3]} for r in got)
    left = sorted(r[3] for r in got)
    assert len(left) == 6 and {0, 2, 7, 8, 9} <= set(left) and (set(left) & {3, 4, 5})
    plain = one_of_each(d.select("text", "doc_id"))
    assert plain.columns == ["text", "doc_id"] and plain.count() == 6


def test_texts_that_share_shingles_by_chance_are_not_compared(spark, monkeypatch):
    """Few words: nearly all texts share shingles of their prefixes, some of them very many, and only copies are alike."""
    rng = random.Random(12)
    texts = [" ".join(rng.choice("abcdefghijkl") for _ in range(rng.randint(60, 90))) for _ in range(1500)]
    texts += [t + " end" for t in texts[:40]]
    written = {}

    def noted(df, name, real=jaccard.materialise):
        out = real(df, name)
        written.setdefault(name, out.count())
        return out

    monkeypatch.setattr(jaccard, "materialise", noted)
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.component_id, r.n_links) for r in similar(d).collect()}
    assert got == {i: (i % 1500, int(i >= 1500 or i < 40)) for i in range(1540)}
    assert written["postings"] > 5000
    assert written["links"] < 160


@pytest.mark.parametrize(("num", "parts"), [(90, 1024), (80, 16), (40, 5)])
def test_sketches_drop_no_linked_pair(num, parts):
    import numpy as np

    rng = np.random.default_rng(num)
    base = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
    sets = []
    for _ in range(160):
        own = base[: rng.integers(1, 3000) if rng.random() < 0.5 else 130]
        own = np.concatenate([own[rng.random(len(own)) < rng.choice([1, 0.97, 0.8, 0.6])], rng.integers(0, 1 << 63, rng.integers(0, 20)).astype(np.uint64)])
        sets.append(np.unique(own if len(own) else base[:1]))
    n, held = np.array([len(s) for s in sets]), [None if i % 40 == 7 else jaccard.parity(s) for i, s in enumerate(sets)]
    sides = rng.integers(0, 2, len(sets)) if parts == 16 else np.full(len(sets), 2)
    got = jaccard.near(n, np.zeros(len(sets), np.int64), held, sides, num, 100)
    linked = jaccard.linked(sets, sides, num, 100)
    assert linked.any() and not (linked & ~got).any() and (got == got.T).all()
    for i in range(len(sets)):
        for j in range(i):
            apart = sides[i] == sides[j] != 2
            size = 100 * min(n[i], n[j]) >= num * max(n[i], n[j])
            assert got[i, j] == (not apart and size and jaccard.alike(held[i], held[j], int(n[i] + n[j]), num, 100))
