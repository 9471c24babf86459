import random
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest

from termloom.llm import suffixes
from termloom.llm.suffixes import Family, Level, anchored, least_in_windows, remove_strings, segments_of, suffix_array


def brute(rows, size):
    bodies = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(b[i : i + size] for _, b in bodies for i in range(len(b) - size + 1))
    out = []
    for d, b in bodies:
        cut = np.zeros(len(b) + 1, np.int64)
        for i in range(len(b) - size + 1):
            if seen[b[i : i + size]] > 1:
                cut[i] += 1
                cut[i + size] -= 1
        gone = np.cumsum(cut)[:-1] > 0
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((d, len(b), int(gone.sum()), spans, sha256(kept).hexdigest()))
    return sorted(out, key=str)


def of(docs, size):
    return sorted((tuple(r) for r in remove_strings(docs, size, keep_text=False).collect()), key=str)


def test_least_in_windows():
    key = np.random.default_rng(1).integers(0, 1 << 62, 400).astype(np.uint64)
    for w in (1, 2, 7, 137, 400):
        assert least_in_windows(key, w).tolist() == [int(key[i : i + w].min()) for i in range(401 - w)]


def test_every_string_lies_in_one_segment(monkeypatch):
    monkeypatch.setattr(suffixes, "CHUNK", 3000)
    import pyarrow as pa

    rng = random.Random(2)
    texts = ["".join(rng.choice("abcdé") for _ in range(rng.choice([0, 5, 199, 200, 201, 700, 9000]))) for _ in range(40)]
    texts += [texts[-1], "x" * 1000, None]
    seen, by_string = Counter(), {}
    for part in segments_of(pa.array(texts), 200):
        for row, first, n, lead, seed, content in zip(*(x.tolist() for x in part), strict=True):
            body = (texts[row] or "").encode()
            for k in range(n):
                seen[row, first + k] += 1
                # equal strings have the same anchor at the same place
                assert by_string.setdefault(body[first + k : first + k + 200], (seed, lead - k)) == (seed, lead - k)
            assert body[first : first + n + 199] and content
    want = {(i, k) for i, t in enumerate(texts) for k in range(len((t or "").encode()) - 199)}
    assert set(seen) == want and set(seen.values()) == {1}


@pytest.mark.parametrize("size", [9, 16, 50, 200])
def test_suffix_array_and_levels(size):
    rng = np.random.default_rng(size)
    texts = [rng.integers(97, 99 + i, 600 + 300 * i).astype(np.uint8) for i in range(3)]
    texts[1][100:450] = texts[0][50:400]
    levels = []
    for text in texts:
        starts = np.arange(len(text) - size + 1)
        order, rank = suffix_array(text, starts, size)
        strings = [text[i : i + size].tobytes() for i in starts]
        assert [strings[i] for i in order] == sorted(strings)
        assert len(set(zip(rank.tolist(), strings, strict=True))) == len(set(strings)) == len(set(rank.tolist()))
        one = order[np.concatenate(([True], rank[order[1:]] != rank[order[:-1]]))]
        levels.append(Level(text, starts[one], one, size))
    place, found = levels[0].scanned(levels[1])
    held = [levels[0].text[i : i + size].tobytes() for i in levels[0].at]
    other = [levels[1].text[i : i + size].tobytes() for i in levels[1].at]
    assert found.tolist() == [x in set(held) for x in other] and found.sum() > 100
    assert all(held[p] == x if f else (p == len(held) or held[p] > x) and (p == 0 or held[p - 1] < x) for p, f, x in zip(place, found, other, strict=True))
    both = levels[0].merged(levels[1].without(found))
    assert [both.text[i : i + size].tobytes() for i in both.at] == sorted(set(held) | set(other))


def test_family_grows_geometrically():
    rng, size = random.Random(4), 20
    family, contents = Family(size), []
    passage = bytes(rng.choice(b"ab") for _ in range(60))
    for i in range(37):
        batch = [bytes(rng.choice(b"abcd") for _ in range(rng.randrange(20, 80))) for _ in range(rng.randrange(1, 9))]
        batch.append(passage[rng.randrange(20) : rng.randrange(45, 60)])
        family.add(batch)
        contents += batch
        ranks = [x.rank for x in family.levels]
        assert ranks == sorted(set(ranks), reverse=True) and len(ranks) <= (i + 1).bit_length()
    count = Counter(c[i : i + size] for c in contents for i in range(len(c) - size + 1))
    assert family.repeated[0].tolist() == [count[c[i : i + size]] > 1 for c in contents for i in range(len(c) - size + 1)]
    assert sum(len(x.at) for x in family.levels) == len(count)


def test_removal_matches_brute_force(spark, mixed_docs):
    rows = [(r.doc_id, r.text) for r in mixed_docs.select("doc_id", "text").collect()]
    for size in (200, 30):
        got = of(mixed_docs, size)
        assert got == brute(rows, size) and sum(r[2] for r in got) > 5000


def test_finer_anchors_and_many_batches(spark, mixed_docs, monkeypatch):
    rows = [(r.doc_id, r.text) for r in mixed_docs.select("doc_id", "text").collect()]
    monkeypatch.setattr(suffixes, "SPLIT", 2)
    monkeypatch.setattr(suffixes, "BATCH", 1500)
    monkeypatch.setattr(suffixes, "FAMILY", 9000)
    for finer in ((12, 1), (50,), (7,)):
        monkeypatch.setattr(suffixes, "FINER", finer)
        assert of(mixed_docs, 200) == brute(rows, 200)
    # the levels decide: without them strings of different contents are not found
    monkeypatch.setattr(suffixes.Level, "scanned", lambda self, other: (np.zeros(len(other.at), np.int64), np.zeros(len(other.at), bool)))
    monkeypatch.setattr(suffixes, "SPLIT", 1 << 30)
    assert sum(r[2] for r in of(mixed_docs, 200)) < sum(r[2] for r in brute(rows, 200))


def test_repetitive_and_repeated(spark):
    rng = random.Random(5)
    text = "".join(rng.choice("abcdefgh ") for _ in range(900))
    rows = [(1, text)] * 40 + [(1, text[:300]), (None, "q" + text[:250]), (None, "q" + text[:250]), (2, "x" * 450), (3, "xy" * 150), (4, "abc" * 66 + "ab"), (5, "abc" * 66 + "a"), (6, ""), (7, None), (8, "é" * 120), (9, "z" + "é" * 100)]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = of(d, 200)
    assert got == brute(rows, 200)
    assert {r[2] for r in got if r[0] == 1} == {900, 300}


def test_documents(edge, empty):
    got = remove_strings(edge, 200).collect()
    assert len(got) == edge.count()
    rows = [(r.doc_id, r.text) for r in edge.select("doc_id", "text").collect()]
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got), key=str) == brute(rows, 200)
    assert all(sha256(r.kept).hexdigest() == r.kept_sha256 and len(r.spans) == r.n_spans for r in got)
    assert remove_strings(empty, 200).count() == 0
