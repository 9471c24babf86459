import random
import re
from hashlib import sha256

import numpy as np

from termloom.llm import substrings
from termloom.llm.fmindex import FMIndex, RankBits, WaveletTree
from termloom.llm.substrings import remove_repeats


def brute(rows, size):
    seen, out = set(), {}
    for d, t in sorted(rows, key=lambda r: r[0]):
        w, cut = re.findall("[^\x20\x09-\x0d]+", t or ""), set()
        for i in range(len(w) - size + 1):
            k = tuple(w[i : i + size])
            if k in seen:
                cut.update(range(i, i + size))
            seen.add(k)
        kept = " ".join(x for i, x in enumerate(w) if i not in cut)
        out[d] = (len(w), len(cut), sha256(kept.encode()).hexdigest())
    return out


def test_index_counts_occurrences():
    rng = np.random.default_rng(1)
    bits = rng.integers(0, 2, 1000).astype(np.uint8)
    at = rng.integers(0, 1001, 200)
    assert RankBits(bits).rank(at).tolist() == [int(bits[:i].sum()) for i in at]
    symbols = rng.integers(0, 37, 800)
    tree = WaveletTree(symbols, 37)
    who, at = symbols[rng.integers(0, 800, 300)], rng.integers(0, 801, 300)
    assert tree.rank(who, at).tolist() == [int((symbols[:i] == s).sum()) for s, i in zip(who, at, strict=True)]
    parts = [rng.integers(1, 4, n) for n in (9, 9, 5, 12)]
    parts[1] = parts[0].copy()
    text = np.concatenate([np.append(p, 0) for p in parts])
    index = FMIndex(text, 4, 13)
    for p in parts:
        low, high = np.array([0]), np.array([len(text)])
        for i in range(len(p) - 1, -1, -1):
            low, high = index.extend(p[i : i + 1], low, high)
            pattern = p[i:]
            assert (high - low)[0] == sum((q[j : j + len(pattern)] == pattern).all() for q in parts for j in range(len(q) - len(pattern) + 1))


def test_matching_statistics():
    rng = np.random.default_rng(3)
    for size in (1, 2, 4, 7):
        for _ in range(20):
            own, other = ([rng.integers(1, 4, rng.integers(1, 25)) for _ in range(5)] for _ in range(2))
            other.append(np.array([1, 2, -1, 1, 1, 2, 3, -1, 2]))
            text = np.concatenate([np.append(p, 0) for p in own])
            index = FMIndex(text, 4, 26, size, np.arange(len(text)), np.ones(len(text), np.int64))
            held = np.concatenate([np.append(p, 0) for p in other])
            lengths = np.array([len(p) for p in other])
            begin = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
            got = {(p, o): (index.least[r], index.total[r]) for p, o, r in zip(*index.windows(held, begin, lengths), strict=True)}
            want = {}
            for p, x in enumerate(other):
                for o in range(len(x) - size + 1):
                    at = [i for i in range(len(text) - size + 1) if (text[i : i + size] == x[o : o + size]).all()]
                    if at:
                        want[p, o] = (at[0], len(at))
            assert got == want


def test_split_anchors_and_the_index_decides(spark, mixed_docs, monkeypatch):
    rows = [(r.doc_id, r.text) for r in mixed_docs.select("doc_id", "text").collect()]
    want = brute(rows, 20)
    monkeypatch.setattr(substrings, "SPLIT", 2)
    monkeypatch.setattr(substrings, "STREAMED", 2)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in remove_repeats(mixed_docs, 20).collect()}
    assert got == want
    # without the index nothing is found
    monkeypatch.setattr(substrings.FMIndex, "windows", lambda *a: (np.zeros(0, np.int64),) * 3)
    blind = substrings.Shard([(1, 1, np.arange(30, dtype=np.uint64).tobytes(), 5, 5, 0, 3)], 20)
    assert blind.stream() == []


def test_many_repeated_rows_and_long_words(spark):
    rng = random.Random(7)
    text = " ".join(f"w{rng.randrange(1000)}" for _ in range(300))
    a = "a"
    for _ in range(11):
        a += a.translate({97: 98, 98: 97})
    b = a.translate({97: 98, 98: 97})
    tail = [f"t{i}" for i in range(19)]
    rows = [(1, text)] * 400 + [(2, text + " more"), (3, " ".join([a, *tail])), (4, " ".join([b, *tail])), (5, " ".join([*tail, a])), (6, " ".join([a, *tail, "x"]))]
    words = [f"v{i % 2}" if (bin(i // 1).count("1") % 2) else "u" for i in range(1024)]
    rows += [(7, " ".join(words)), (8, " ".join("u" if w != "u" else "v1" for w in words))]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = remove_repeats(d, 20, keep_text=False).collect()
    assert len(got) == len(rows) and len({tuple(r) for r in got if r.doc_id == 1}) == 1
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == brute(sorted(set(rows)), 20)


def test_removal_matches_brute_force(spark, mixed_docs):
    for size in (20, 6):
        rows = [(r.doc_id, r.text) for r in mixed_docs.select("doc_id", "text").collect()]
        want = brute(rows, size)
        got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in remove_repeats(mixed_docs, size).collect()}
        assert got == want and sum(v[1] for v in want.values()) > 500


def test_repetitive_texts(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice("ab") for _ in range(rng.randrange(60)))) for i in range(40)] + [(50, "x " * 90), (51, "x " * 25)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in remove_repeats(d, 20).collect()} == brute(rows, 20)


def test_documents(spark, edge, empty):
    got = remove_repeats(edge).collect()
    assert len(got) == edge.count()
    by = {r.doc_id: r for r in got}
    assert by[0].n_words == 0 and by[0].kept_sha256 == sha256(b"").hexdigest()
    assert by[9].n_removed < by[10].n_removed == by[10].n_words
    assert by[7].n_words == 30_000 and by[8].n_removed == 30_000
    assert remove_repeats(empty).count() == 0
