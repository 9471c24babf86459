"""Operator 9: language of whole texts.

A text becomes the average of embeddings of its hashed subwords: character
n-grams of lower-cased letters, inside words and across their edges.  A linear
softmax on that average gives the language.  Embeddings and softmax are trained
in numpy by stochastic gradient descent, on a bounded sample of labelled rows;
a part of the sample is kept back to calibrate a temperature and the score
under which a prediction is rejected.  As everything after the sum is linear,
prediction uses one table of scores per subword and language.

Defined results: a null text, or one without a letter, is `und` with score 0
and rejected; equal scores go to the language that sorts first; rows without a
language are predicted but never learned from; without any labelled row every
text is `und`; an empty table gives an empty result; repeated rows stay
repeated; further columns are ignored.  A null doc_id counts as not held out and
is not learned from.  A very long text is summed piece by piece and gets the
scores that it has as a whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.llm.codepoints import lower_letters
from termloom.llm.common import arrow_map, only

#: Bound of the labelled sample, over all languages together.
SAMPLE = 4000
#: Rows of a language that are sampled at least, as far as it has so many; the bound grows by them with the labels.
LEAST_ROWS = 20
BUCKETS, WIDTH, EPOCHS, RATE = 1 << 17, 12, 4, 0.4
#: Updates of a training at least: few rows are gone through more often.
LEAST_STEPS = 12_000
#: Code points that a subword reaches beyond its first.
REACH = 3
#: Every CALIBRATE-th sampled row calibrates and doesn't train.
CALIBRATE = 5
#: Share of right predictions on the calibration rows that may be rejected, and the score that is never rejected.
LOSS, SURE = 0.001, 0.45
CHUNK = 1 << 20


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def grams(texts: list[str], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all subwords of the texts, and for each text where its own begin (one more at the end)."""
    points = np.frombuffer("\x00".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    ends = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64) - 1
    code = letters[points]
    keep = np.ones(len(code), bool)
    keep[1:] = (code[1:] != 0) | (code[:-1] != 0)  # of a run of other signs one stays, as the words' edge
    keep[ends] = True
    at = np.cumsum(keep) - 1
    code = code[keep].astype(np.uint64)
    ends = at[ends]
    n = len(code)
    text = np.zeros(n, dtype=np.int64)
    text[ends[:-1] + 1] = 1
    text = np.cumsum(text)
    inner = code != 0
    with np.errstate(over="ignore"):
        c1, c2, c3 = np.roll(code, -1), np.roll(code, -2), np.roll(code, -3)
        two = code * np.uint64(0x9E3779B1) + c1 * np.uint64(0x85EBCA6B)
        three = two + c2 * np.uint64(0xC2B2AE35)
        four = three + c3 * np.uint64(0x27D4EB2F)
        salt = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)]
        hashed = [((h * s) >> np.uint64(64 - 17)).astype(np.int32) for h, s in zip((two, three, four), salt, strict=True)]
    same = [np.roll(text, -k) == text for k in (1, 2, 3)]
    for k, ok in enumerate(same, 1):
        ok[max(0, n - k) :] = False
    i1, i2 = np.roll(inner, -1), np.roll(inner, -2)
    valid = [same[0] & (inner | i1), same[1] & i1, same[2] & i1 & i2]
    ok = np.stack(valid, axis=1)
    buckets = np.stack(hashed, axis=1)[ok]
    per_place = ok.sum(axis=1)
    total = np.concatenate(([0], np.cumsum(per_place)))
    return buckets, np.concatenate(([0], total[ends + 1]))


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # BUCKETS x languages: scores of one subword, temperature included
    bias: np.ndarray
    reject_below: float

    def scores(self, texts: list[str], letters: np.ndarray) -> np.ndarray:
        """Probabilities, texts x languages; zeros for texts without a letter."""
        out = np.zeros((len(texts), len(self.languages)))
        i = 0
        while i < len(texts):
            j, size = i, 0
            while j < len(texts) and (j == i or size + len(texts[j]) < CHUNK):
                size += len(texts[j]) + 1
                j += 1
            out[i:j] = self._scores(texts[i:j], letters)
            i = j
        return out

    def _scores(self, texts: list[str], letters: np.ndarray) -> np.ndarray:
        if len(texts) == 1 and len(texts[0]) > CHUNK:
            total, n = self._long(texts[0], letters)
        else:
            total, n = self._sums(texts, letters)
        z = total / np.maximum(n, 1)[:, None] + self.bias
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[n == 0] = 0
        return p

    def _long(self, text: str, letters: np.ndarray, size: int = CHUNK) -> tuple[np.ndarray, np.ndarray]:
        """The sums of one text, piece by piece: each reaches REACH signs into the next, and what starts there is taken off again."""
        total, n = self._sums([text[: size + REACH]], letters)
        for a in range(size, len(text), size):
            more, m = self._sums([text[a : a + size + REACH]], letters)
            over, k = self._sums([text[a : a + REACH]], letters)
            total, n = total + more - over, n + m - k
        return total, n

    def _sums(self, texts: list[str], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        buckets, at = grams(texts, letters)
        n = np.diff(at)
        total = np.zeros((len(texts), len(self.languages)))
        full = np.flatnonzero(n)
        if len(full):
            total[full] = np.add.reduceat(self.table[buckets], at[full], axis=0)
        return total, n


def train(texts: list[str], labels: list[str], letters: np.ndarray, seed: int = 7) -> Model:
    """Rows come in a fixed order; every CALIBRATE-th calibrates."""
    languages = sorted(set(labels))
    y = np.array([languages.index(x) for x in labels])
    rows = []
    for t in texts:
        buckets, at = grams([t], letters)
        rows.append(tuple(np.unique(buckets, return_counts=True)))
    used = [i for i, (b, _) in enumerate(rows) if len(b)]
    back = [i for i in used if i % CALIBRATE == 0] if len(used) >= 5 * CALIBRATE else used
    front = [i for i in used if i not in set(back)] if len(used) >= 5 * CALIBRATE else used
    rng = np.random.default_rng(seed)
    embed = rng.normal(0, 0.1, (BUCKETS, WIDTH)).astype(np.float32)
    soft, bias = np.zeros((WIDTH, len(languages)), np.float32), np.zeros(len(languages), np.float32)
    soft += rng.normal(0, 0.1, soft.shape)
    if not front:
        return Model(languages, np.zeros((BUCKETS, len(languages)), np.float32), np.zeros(len(languages)), 0.0)
    epochs = max(EPOCHS, LEAST_STEPS // len(front))
    steps, step = epochs * len(front), 0
    for _ in range(epochs):
        for i in rng.permutation(front):
            rate = RATE * (1 - step / steps)
            step += 1
            buckets, counts = rows[i]
            weight = (counts / counts.sum()).astype(np.float32)
            hidden = weight @ embed[buckets]
            z = hidden @ soft + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1
            back_hidden = soft @ p
            soft -= rate * np.outer(hidden, p)
            bias -= rate * p
            embed[buckets] -= (rate * len(buckets) ** 0.5) * np.outer(weight, back_hidden)
    table = embed @ soft
    met = np.zeros(BUCKETS, bool)
    met[np.concatenate([rows[i][0] for i in front])] = True
    table[~met] = 0  # what no training text holds says nothing: a text of such subwords is left to chance, and rejected
    z = np.array([(c / c.sum()) @ table[b] + bias for b, c in (rows[i] for i in back)])
    want = y[back]

    def loss(t: float) -> float:
        s = z * t
        s = s - s.max(axis=1, keepdims=True)
        return float(np.mean(np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(s)), want]))

    heat = min(np.geomspace(0.25, 8, 41), key=loss) if len(back) else 1.0
    model = Model(languages, (table * heat).astype(np.float32), (bias * heat).astype(np.float64), 0.0)
    s = np.exp(z * heat - (z * heat).max(axis=1, keepdims=True)) if len(back) else np.ones((1, 1))
    right = (s / s.sum(axis=1, keepdims=True)).max(axis=1)[s.argmax(axis=1) == want] if len(back) else np.ones(1)
    model.reject_below = min(SURE, float(np.quantile(right, LOSS))) if len(right) else 0.0
    return model


def fit(docs: DataFrame, sample: int = SAMPLE, letters: np.ndarray | None = None) -> Model | None:
    """Train on at most about `sample` labelled rows that aren't held out, an equal share for each language.

    Every label that occurs is learned, from LEAST_ROWS rows at least if it has
    them.  Which rows is decided by a hash of doc_id, so it doesn't depend on
    their order.  The sample is the only part of the corpus that reaches the driver.
    """
    known = docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    counts = known.groupBy("lang").count()
    # labels are names of languages, so a row for each is little; every one of them is learned
    each = max(sample // max(1, counts.count()), LEAST_ROWS)
    place = F.shiftrightunsigned(F.xxhash64(F.lit("language sample"), "doc_id"), 1).cast("double") / float(1 << 63)
    # twice the share, so that chance leaves no rare language short; then the first of each by hash
    near = known.join(F.broadcast(counts), "lang").where(place * F.col("count") < 2 * each + LEAST_ROWS)
    first = F.row_number().over(Window.partitionBy("lang").orderBy(place, "doc_id", "text"))
    rows = near.withColumn("first", first).where(F.col("first") <= each).select("doc_id", "text", "lang").toArrow().sort_by([("doc_id", "ascending"), ("text", "ascending")])
    if not rows.num_rows:
        return None
    letters = lower_letters() if letters is None else letters
    return train(rows["text"].to_pylist(), rows["lang"].to_pylist(), letters)


SCHEMA = "lang_pred string, score double, rejected boolean"


def _predict(df: DataFrame, model: Model | None, letters: np.ndarray, make_columns, schema) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast((model and (model.languages, model.table, model.bias, model.reject_below), letters))  # fixed size for the labels there are: code points, and BUCKETS scores a language

    def make():
        fields, letters = shared.value
        model = fields and Model(*fields)

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [x or "" for x in batch.column("text").to_pylist()]
            p = model.scores(texts, letters) if model else np.zeros((len(texts), 1))
            best, score = p.argmax(axis=1), p.max(axis=1)
            names = np.array(model.languages if model else ["und"], dtype=object)
            lang = np.where(score > 0, names[best], "und")
            rejected = (score <= 0) | (score < (model.reject_below if model else 1))
            return make_columns(batch, lang, score, rejected)

        return each

    return arrow_map(df, make, schema)


def identify(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, lang_pred, score (the calibrated probability), rejected."""
    letters = lower_letters()
    model = fit(docs, sample, letters)

    def columns(batch, lang, score, rejected):
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(lang, pa.string()), pa.array(score), pa.array(rejected)], ["doc_id", "held_out", "lang_pred", "score", "rejected"])

    inputs = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    return _predict(inputs, model, letters, columns, "doc_id long, held_out boolean, " + SCHEMA)


def accepted(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of docs whose prediction isn't rejected, all columns as they are."""
    letters = lower_letters()
    model = fit(docs, sample, letters)
    return _predict(docs, model, letters, lambda batch, lang, score, rejected: batch.filter(pa.array(~rejected)), docs.schema)
