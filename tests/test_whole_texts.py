"""Queries over whole texts: words far into a text count like the first ones."""

import os
import random

import duckdb
import pytest

from termloom.plans import catalog


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(8)
    vocabulary = "Que que les eux ciónes sin sobre en du rojo roja rojos casas grande grandes été niño, niña. x año 2024 ! Les".split()
    texts = [" ".join(rng.choice(vocabulary) for _ in range(n)) for n in (0, 1, 2, 24, 25, 26, 90, 700)]
    rows = [(i, t, lang) for i, (t, lang) in enumerate((t, lang) for t in texts for lang in ("es", "fr", "en"))]
    d = str(tmp_path_factory.mktemp("whole"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{d}/documents.parquet")
    return d


def rows_of(rows):
    return sorted(tuple(map(str, r)) for r in rows)


@pytest.mark.parametrize("name", ["stem_prefix", "gender_guard", "script_guard", "word_count_guard", "complement_metric", "lexicon_lookup"])
def test_word_pairs_of_whole_texts(spark, folder, name):
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    r = c.execute(catalog.oracle_sql()[name])
    columns = [x[0] for x in r.description]
    want = r.fetchall()
    assert max(x[columns.index("i")] for x in want) > 600
    assert rows_of(catalog.queries()[name](spark, folder).select(*columns).collect()) == rows_of(want)


def test_form_codes_of_whole_texts(spark, folder):
    n = {}
    for r in catalog.queries()["form_check"](spark, folder).collect():
        n[r["lang"]] = n.get(r["lang"], 0) + r["n"]
    assert n == dict.fromkeys(("es", "fr"), sum(max(0, x - 1) for x in (0, 1, 2, 24, 25, 26, 90, 700)))


def test_delivery_and_ratios_of_whole_texts(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    got = {r.doc_id: r.delivered for r in catalog.queries()["delivery_norm"](spark, folder).collect()}
    made = lambda i, t: (t, f"l'{t}", f'"{t[:5]}"{t[5:]}"', t)[i % 4]
    assert {i: t for i, t in got.items() if len(t) > 20} == {r.doc_id: made(r.doc_id, r.text) for r in docs if len(r.text) > 17}
    assert len(got) == len(docs)
    total = dict.fromkeys(("es", "fr", "en"), 0.0)
    for r in docs:
        s = "汉字" * (r.doc_id % 7) + r.text if r.doc_id % 3 == 0 else r.text
        bare = "".join(s.split())
        total[r.lang] += sum("一" <= c <= "\u9fff" for c in bare) / len(bare) if bare else 0
    for r in catalog.queries()["cjk_ratio_stats"](spark, folder).collect():
        assert r.n == 8 and abs(r.total - total[r.lang]) < 1e-5


def test_discarded_tables_are_gone_and_others_stay(spark, tmp_path):
    from termloom.sources.scratch import discard, materialise

    gone, kept = materialise(spark.range(10), "test-gone"), materialise(spark.range(5), "test-kept")
    folder = gone.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    discard(gone)
    assert not os.path.exists(folder) and kept.count() == 5
    spark.range(3).write.parquet(str(tmp_path / "own"))
    with pytest.raises(ValueError, match="no intermediate"):
        discard(spark.read.parquet(str(tmp_path / "own")))
    assert spark.read.parquet(str(tmp_path / "own")).count() == 3


def test_words_are_split_once_a_row(spark):
    from pyspark.sql import functions as F

    from termloom.functions import morph

    rows = spark.range(1).select(F.lit("de casa").alias("b"), F.lit("de casas").alias("s"), F.lit("es").alias("l"))
    out = rows.select(morph.complement_changed(F.col("b"), F.col("s"), F.col("l")).alias("c"))
    assert out.first().c
    assert out._jdf.queryExecution().analyzed().toString().count("split(") == 2
