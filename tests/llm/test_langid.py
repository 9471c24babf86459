import random

from termloom.llm.langid import accepted, identify


def corpus(spark, n=240):
    rng = random.Random(8)
    syllables = {"aa": ["the", "ing", "wh", "ou"], "bb": ["sch", "ung", "ein", "zu"], "cc": ["ción", "ñe", "lo", "qu"]}
    rows = []
    for i in range(n):
        lang = sorted(syllables)[i % 3]
        rows.append((i, " ".join("".join(rng.choice(syllables[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(3, 60))), lang))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_held_out_accuracy(spark):
    import zlib

    d = corpus(spark)
    want = {r.doc_id: r.lang for r in d.collect()}
    got = identify(d).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out]
    assert held and sum(r.lang_pred == want[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got) and not any(r.rejected for r in got)


def test_prediction_ignores_the_label(spark):
    from pyspark.sql import functions as F

    d = corpus(spark)
    blind = d.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string")) % 4 != 2, F.col("lang")))
    assert {(r.doc_id, r.lang_pred) for r in identify(d).collect()} == {(r.doc_id, r.lang_pred) for r in identify(blind).collect()}


def test_documents(spark, edge, empty):
    got = identify(edge).collect()
    assert len(got) == edge.count()
    letters = {r.doc_id: any(c.isalpha() for c in r.text or "") for r in edge.select("doc_id", "text").collect()}
    for r in got:
        assert (r.lang_pred == "und") == (not letters[r.doc_id]) and r.rejected == (r.lang_pred == "und")
    assert identify(empty).count() == 0 and accepted(empty).count() == 0
    out = accepted(edge)
    assert out.columns == edge.columns and out.count() == sum(not r.rejected for r in got)


def test_long_texts_are_summed_whole():
    import numpy as np

    from termloom.llm.codepoints import lower_letters
    from termloom.llm.langid import BUCKETS, Model

    letters, rng = lower_letters(), random.Random(2)
    model = Model(["a", "b"], np.random.default_rng(1).normal(size=(BUCKETS, 2)), np.zeros(2), 0.0)
    for _ in range(200):
        text = "".join(rng.choice(["a", "é", "字", " ", "  ", ".", "Zz", "\U0001f600"]) for _ in range(rng.randrange(1, 60)))
        want, n = model._sums([text], letters)
        for size in (1, 2, 3, 7, 16):
            got, m = model._long(text, letters, size)
            assert m[0] == n[0] and np.allclose(got, want)


def test_every_label_is_learned(spark):
    rng = random.Random(4)
    rows = []
    for lang in range(70):  # more labels than any small table would hold
        alphabet = [chr(0x100 + 5 * lang + k) for k in range(5)]
        for _ in range(16):
            rows.append((len(rows), " ".join("".join(rng.choice(alphabet) for _ in range(4)) for _ in range(20)), f"l{lang:02}"))
    got = {r.doc_id: r for r in identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample=400).collect()}
    held = [r for r in rows if got[r[0]].held_out]
    assert sum(got[r[0]].lang_pred == r[2] for r in held) >= 0.95 * len(held)
    assert {r.lang_pred for r in got.values()} == {r[2] for r in rows}


def test_strangers_are_rejected(spark):
    rng = random.Random(5)
    strange = [(1000 + k, " ".join("".join(rng.choice("жщюя") for _ in range(5)) for _ in range(40)), None) for k in range(20)]
    d = corpus(spark, 600).unionByName(spark.createDataFrame(strange, "doc_id long, text string, lang string"))
    got = {r.doc_id: r.rejected for r in identify(d).collect()}
    assert sum(got[r[0]] for r in strange) >= 18 and sum(v for k, v in got.items() if k < 1000) <= 6
    kept = {r.doc_id for r in accepted(d).collect()}
    assert kept == {k for k, v in got.items() if not v}
