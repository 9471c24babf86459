import re
from collections import Counter

from termloom.llm.quality import distance, quality


def brute(text):
    t = text or ""
    w = re.findall("[^\x20\x09-\x0d]+", t)
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    counts, covered = Counter(windows), set()
    for i, x in enumerate(windows):
        if counts[x] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in t.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)


def test_counts_match_brute_force(spark, edge, empty, mixed_docs):
    for docs in (edge, mixed_docs):
        want = sorted((str(r.doc_id), *brute(r.text)) for r in docs.select("doc_id", "text").collect())
        rows = quality(docs).collect()
        assert sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows) == want
        for r in rows:
            assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
            assert not (r.kept and r.base_failed)
    assert quality(empty).count() == 0


def test_strange_texts_fail_and_plain_ones_stay(spark):
    import random

    rng = random.Random(1)
    common = "the of and to a in is that for it as was with be".split()
    plain = [" ".join(rng.choice(common) if rng.random() < 0.4 else "".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(150)) + "." for _ in range(60)]
    strange = ["".join(rng.choice("#*%&|$") * 3 + str(rng.randrange(999)) + " " for _ in range(150)) for _ in range(3)]
    d = spark.createDataFrame([(i, t, "en") for i, t in enumerate(plain + strange)], "doc_id long, text string, lang string")
    kept = {r.doc_id: r.kept for r in quality(d).collect()}
    assert all(kept[i] for i in range(60)) and not any(kept[60 + i] for i in range(3))


def test_texts_without_the_common_words_of_their_language_fail(spark):
    import random

    from termloom.llm.quality import COMMON

    rng = random.Random(5)
    other = lambda: "".join(rng.choice("abcdefghilmnorstu") for _ in range(6))
    text = lambda lang, n, share: " ".join(rng.choice(COMMON[lang]) if rng.random() < share else other() for _ in range(n)) + "."
    rows = [(text(lang, n, 0.2), lang, True) for lang in ("en", "fr") for n in (90, 120, 200, 400, 900) for _ in range(20)]
    rows += [(text("en", n, 0.0), lang, False) for lang in ("en", "fr") for n in (90, 200, 900)]  # gibberish with usual characters
    rows += [(text("de", n, 0.2), "en", False) for n in (300, 900)]  # a wrong label
    d = spark.createDataFrame([(i, t, lang) for i, (t, lang, _) in enumerate(rows)], "doc_id long, text string, lang string")
    kept = {r.doc_id: r.kept for r in quality(d).collect()}
    assert [i for i, (_, _, want) in enumerate(rows) if kept[i] != want] == []


def test_distance(spark):
    from pyspark.sql import functions as F

    r = spark.range(1).select(distance(F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(0.0), F.lit(1.0))).alias("far"), distance(F.array(F.lit(0.5), F.lit(0.5)), F.array(F.lit(0.5), F.lit(0.5))).alias("near")).first()
    assert abs(r.far - 1) < 1e-12 and r.near == 0


def test_plan_has_no_python(spark, mixed_docs, capsys):
    quality(mixed_docs).explain("formatted")
    assert not re.search("Python|Arrow|Pandas", capsys.readouterr().out)


def test_verdicts_match_brute_force(spark):
    import math
    import random

    from termloom.llm import quality as q

    rng = random.Random(8)
    other = lambda: "".join(rng.choice("abcdeghilmnorst") for _ in range(rng.randrange(2, 9)))
    rows = []
    for i in range(240):
        lang = rng.choice(["en", "fr", "xx", None])
        share = rng.choice([0.3, 0.3, 0.3, 0.25, 0.0])
        words = [rng.choice(q.COMMON.get(lang, ["zz"])) if rng.random() < share else other() for _ in range(rng.choice([5, 60, 90, 150, 400]))]
        text = " ".join(words).capitalize() + rng.choice([".", "!?", " 漢字é" * rng.randrange(40), " #$%" * rng.randrange(200)])
        rows.append((i, text, lang))

    def histograms(text, lang):
        w = re.findall("[^\x20\x09-\x0d]+", text)
        n = lambda p: len(re.findall(p, text))
        counts = [len(text) - sum(map(len, w)), n("[A-Z]"), n("[0-9]"), n("[#*$%&|<>]"), n(r"[.,;:!?()\"'/_-]"), sum(ord(c) > 127 for c in text)]
        own = Counter(w)
        common = [own[v] for v in q.COMMON.get(lang, [])]
        chars = [*counts, max(0, len(text) - sum(counts))]
        return len(w), [c / max(1, sum(chars)) for c in chars], [c / max(1, len(w)) for c in [*common, len(w) - sum(common)]]

    def far(p, r):
        part = lambda x, m: x * math.log2(x / m) if x > 0 else 0.0
        return math.sqrt(max(0.0, sum((part(x, (x + y) / 2) + part(y, (x + y) / 2)) / 2 for x, y in zip(p, r, strict=True))))

    docs = {i: (*histograms(t, lang or ""), len(t), lang or "", len(re.findall("[^\x20\x09-\x0d]+", t)) < 10 or 100 * brute(t)[4] > 20 * brute(t)[0]) for i, t, lang in rows}
    references, spreads = {}, {}
    for lang in ("en", "fr", "xx", ""):
        steady = [d for d in docs.values() if d[4] == lang and not d[5] and d[3] >= q.GUARD_CHARS and d[0] >= q.GUARD_WORDS]
        references[lang] = [[sum(d[k][i] for d in steady) / len(steady) for i in range(len(steady[0][k]))] for k in (1, 2)]
    unit = lambda d: 1 / (8 * math.log(2) * d[0])
    for lang, (_, words) in references.items():
        beyond = sorted(math.sqrt(max(0.0, far(d[2], words) ** 2 - (len(words) - 1) * unit(d))) for d in docs.values() if d[4] == lang and not d[5] and d[3] >= q.GUARD_CHARS and d[0] >= q.GUARD_WORDS)
        at = lambda p: beyond[max(0, math.ceil(p * len(beyond)) - 1)]
        spreads[lang] = at(0.5) + q.SPREAD * (at(0.75) - at(0.25)) / 1.349
    want = {}
    for i, d in docs.items():
        chars, words = references[d[4]]
        ok = not d[5]
        if d[3] >= q.GUARD_CHARS:
            ok &= far(d[1], chars) <= q.CHAR_LIMIT
        if d[0] >= q.GUARD_WORDS:
            limit = q.WORD_LIMIT
            if d[0] * (1 - words[-1]) >= q.GUARD_COMMON:
                free = len(words) - 1
                limit = min(limit, math.sqrt(spreads[d[4]] ** 2 + (free + q.COUNTING * math.sqrt(2 * free)) * unit(d)), q.SHORT_OF * far([0.0] * free + [1.0], words))
            ok &= far(d[2], words) <= limit
        want[i] = ok
    got = {r.doc_id: r.kept for r in quality(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert got == want and len(set(want.values())) == 2
    assert any(not want[i] and not docs[i][5] and far(docs[i][1], references[docs[i][4]][0]) <= q.CHAR_LIMIT for i in docs)  # words alone reject some


def test_words_are_gone_through_once_a_document(mixed_docs):
    """Spark computes what a lambda names anew for each element, if it is used nowhere else."""
    from termloom.llm.quality import features

    plan = features(mixed_docs)._jdf.queryExecution().optimizedPlan().toString()
    bodies = []
    for at in re.finditer(r"lambdafunction\(", plan):
        depth, end = 1, at.end()
        while depth:
            depth += {"(": 1, ")": -1}.get(plan[end], 0)
            end += 1
        bodies.append(plan[at.end() : end])
    assert bodies and not [b for b in bodies if re.search(r"(filter|transform|zip_with|split|regexp_\w+|sort_array)\(", b)]
    # regular expressions that must look at each character see what is left without words' small letters
    assert not re.search(r"regexp_extract_all\(text", plan)


def test_repeats_that_touch_overlap_and_stand_at_the_ends(spark):
    texts = ["a b c d e a b c d e", "a b c d e x a b c d e y z a b c d e", "a a a a a a", "a a a a a", "a b c d", "a b c d e f a b c d e f", " a\tb\nc\x0bd\x0ce\ra b c d e\t", "p q a b c d e r s t u a b c d f", "a b c d e b c d e a b c d e b"]
    rows = quality(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "'en' as lang")).collect()
    assert [r.n_repeat_words for r in sorted(rows)] == [brute(t)[4] for t in texts]


def test_rows_are_not_dealt_out_by_language(spark):
    """The languages' table is small beside the rows, and its size is known when the join is planned."""
    from pyspark.sql import functions as F

    words = F.transform(F.sequence(F.lit(0), F.lit(99)), lambda i: F.substring(F.sha2((F.col("id") * 100 + i).cast("string"), 256), 1, 6))
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.array_join(words, " ").alias("text"), F.lit("en").alias("lang"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "40k")
    try:
        plan = quality(docs)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("BroadcastHashJoin") == 2 and "hashpartitioning" not in plan
