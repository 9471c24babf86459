import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, words string, row string, n int, f string, node string, token string, content string, key string, part int, block int, u double"


def rows_of(texts):
    """Documents with clashing further columns."""
    out = []
    for i, t in enumerate(texts):
        out.append((i, t, "en", f"s{i % 3}", None if t is None else len(t), "x", "y", 1, "f", "n", "t", "c", "k", 0, 0, 0.5))
    return out


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls, empty and long texts, repeats, ties, odd characters."""
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    texts = [None, "", " \t\n\r\x0b\x0c", "one", "a a a a a a a a a a a a", "a a a a a a a a a a a a", "Ünï cödé \U0001f600 x", long, long + " tail", "same text here " * 9, "same text here " * 9, "\x00 \x1c\x85　 y"]
    rows = rows_of(texts)
    rows.append((None, "no id at all but words enough to be a set", None, None, None, *rows[0][5:]))
    rows.append((None, "no id at all but words enough to be a set", None, None, None, *[None] * 11))
    rows.append(rows[3])
    rows.append(rows[3])
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def mixed_docs(spark):
    """Random texts with exact copies, near copies and shared passages."""
    rng = random.Random(3)
    vocabulary = [f"{a}{b}" for a in "bdfgklmnprst" for b in ("a", "e", "io", "un", "or", "ist")]
    draw = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passage = draw(45)
    texts = []
    for i in range(150):
        w = draw(rng.randrange(3, 160))
        if i % 7 == 0:
            at = rng.randrange(len(w))
            w[at:at] = passage
        texts.append(" ".join(w))
    for i in range(60):
        w = texts[i % 20].split()
        for _ in range(i % 4):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        texts.append(" ".join(w) if i % 5 else texts[i % 20].upper())
    texts += [texts[0]] * 12 + ["a b", "a b", "a", None, ""]
    return spark.createDataFrame(rows_of(texts), DOCS)
