import random
import re
from collections import Counter, defaultdict

import pytest

from termloom.llm import collocations as c
from termloom.llm.collocations import collocations, ranked

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, longest, least, share, most):
    found, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOW)):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                found[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in found.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        own = []
        for p, a in candidates.items():
            if any(len(q) > len(p) and 100 * b >= share * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in candidates.items()):
                continue
            score, _, left, right = min((1000 * a * n[lang] // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            own.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, i + 1, p.decode(), -a, left, right, n[lang], -score) for i, (score, a, p, left, right) in enumerate(sorted(own)[:most])]
    return sorted(out)


def texts(n=120):
    rng = random.Random(5)
    words = ["the", "The", "old", "new", "york", "times", "é", "日本", "state", "of", "art", " x", "w\x00", "long" * 50]
    phrases = ["new york times square now", "State of the art", "old old old old old old", "日本 é"]
    rows = []
    for i in range(n):
        parts = [rng.choice(phrases) if rng.random() < 0.3 else rng.choice(words) for _ in range(rng.randrange(0, 60))]
        rows.append((rng.choice(["en", "fr", None, "und", ""]), "".join(p + rng.choice([" ", " ", "  ", "\t", ", ", ".", "\n", " ; "]) for p in parts)))
    return rows


def result(spark, rows, longest, least, share, most=2000):
    d = spark.createDataFrame([(i, t, lang, "x", 1, 2) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string, key string, a long, n long")
    out = ranked(collocations(d, longest, least, share), most)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in out.collect())


@pytest.mark.parametrize(("longest", "least", "share", "most", "shard", "group"), [(5, 3, 100, 2000, 1 << 20, 1 << 15), (5, 2, 60, 7, 300, 40), (2, 2, 100, 2000, 500, 1), (3, 4, 100, 2000, 100, 8)])
def test_phrases_match_brute_force(spark, monkeypatch, longest, least, share, most, shard, group):
    monkeypatch.setattr(c, "SHARD", shard)
    monkeypatch.setattr(c, "GROUP", group)
    rows = texts()
    got = result(spark, rows, longest, least, share, most)
    assert got and got == brute(rows, longest, least, share, most)


def test_documents(spark, empty):
    assert ranked(collocations(empty)).count() == 0
    long = " ".join(f"w{i % 97} x" for i in range(20_000))
    rows = [("en", None), ("en", ""), ("en", " \t.,\n"), (None, "one"), ("en", long), ("en", long), ("fr", "a a " * 100), ("de", "b c, " * 99), ("de", "b\nc d")]
    got = result(spark, rows, 5, 100, 100)
    assert got == brute(rows, 5, 100, 100, 2000) and {r[0] for r in got} == {"en", "fr"}


def test_products_beyond_64_bits(spark):
    d = spark.range(1).selectExpr("3000000000L a", "9000000000000L n", "array(4000000000L, 3000000000L) p", "array(3000000000L, 3500000000L) s")
    got = d.select(c._best_cut(d.a, d.n, d.p, d.s).alias("x")).first().x
    assert got.score == 1000 * 3000000000 * 9000000000000 // (4000000000 * 3500000000) and got.k == 1
