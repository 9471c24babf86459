"""Operator 2: secrets in whole texts.

Base spans come from three patterns.  Beside them the operator tests every run
of 20 or more token characters outside base spans, where "=" belongs to a run
as padding at its end only and else separates; of a run that fits no encoding,
or doesn't look random as a whole, it tests the parts between "+", "/", "_" and
"-" instead.  It infers the run's encoding (hexadecimal, base 32, base 36, base 64 in either alphabet), and asks
whether its symbols look drawn at random, by a chi-squared test of uniformity
over the alphabet, a runs test about the median and a test of serial
correlation, joined by Fisher's method into one probability p; a run without
any digit, as words are, or of digits only has at most the probability of that.  Random strings
have p uniform on 0 to 1, words have p near 0.  How well the tests tell the two
apart depends on the length, so false discoveries are controlled apart for
each encoding and length class: from the number of runs with p over one half
follows how many random strings there are; the threshold t is the least at
which, of the runs with p >= t, a share of at most `fdr` must be something else.
Classes with too few such runs for an estimate of their own are pooled.
The histogram of p covers all documents and has a fixed size.

Defined results: a null text counts as empty and has no spans; rows are judged
independently, so repeated ids or texts stay repeated; an empty table gives an
empty result; further columns are ignored.  Offsets are code points, ends
exclusive.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from hashlib import sha256
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import arrow_map, materialise, only

# The base patterns, their kinds in order, and least sizes.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "random")
LEAST = {"assign": 6, "access": 20, "hex": 24}
KEYWORDS = ("password", "passwd", "secret", "token", "api")

#: Least length of a tested run, and where the length classes begin.
SHORTEST, LENGTHS = 20, (20, 24, 32, 48, 64)
RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % SHORTEST)
#: A tested run ends with padding or holds none; below so small a p its parts are tested instead.
PADDED = re.compile(r"[A-Za-z0-9+/_-]+(?:=+(?![A-Za-z0-9+/_=-]))?")
PART, PARTED = re.compile(r"[A-Za-z0-9]+(?:=+)?"), 0.05
UPPER, LOWER, DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
#: From the narrowest to the widest; a run has the first that holds all its symbols.
ALPHABETS = {
    "hex": DIGITS + "abcdef",
    "HEX": DIGITS + "ABCDEF",
    "base32": UPPER + "234567",
    "base36": DIGITS + LOWER,
    "BASE36": DIGITS + UPPER,
    "base64": UPPER + LOWER + DIGITS + "+/",
    "base64url": UPPER + LOWER + DIGITS + "-_",
}
VALUES = {name: {c: i for i, c in enumerate(a)} for name, a in ALPHABETS.items()}
#: Equal shares of an alphabet that the test of uniformity counts; histogram bars of p.
SHARES, BARS = 8, 100
#: Classes with fewer runs of p over one half are pooled.
FEW = 20

SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, base array<struct<kind:string,start:int,end:int>>, tested array<struct<start:int,end:int,class:string,p:double>>"


def chi_squared_tail(x: float, df: int) -> float:
    """P(chi-squared with df degrees of freedom > x), by the finite sums for odd and even df."""
    if x <= 0:
        return 1.0
    if df % 2 == 0:
        term = total = math.exp(-x / 2)
        for i in range(1, df // 2):
            term *= x / 2 / i
            total += term
        return min(1.0, total)
    total = math.erfc(math.sqrt(x / 2))
    term = math.sqrt(2 * x / math.pi) * math.exp(-x / 2)
    for i in range(1, df, 2):
        total += term
        term *= x / (i + 2)
    return min(1.0, total)


def randomness(run: str) -> tuple[str, float]:
    """(encoding, p) of a run: p of Fisher's method over the three tests."""
    symbols = set(run.rstrip("="))
    encoding = next((name for name, a in VALUES.items() if symbols <= a.keys()), None)
    if encoding is None or not symbols:
        return "mixed", 0.0
    values = [VALUES[encoding][c] for c in run.rstrip("=")]
    n, size = len(values), len(ALPHABETS[encoding])
    counts = Counter(v * SHARES // size for v in values)
    widths = Counter(v * SHARES // size for v in range(size))
    chi = sum((counts[k] - n * w / size) ** 2 / (n * w / size) for k, w in widths.items())
    tests = [chi_squared_tail(chi, SHARES - 1)]
    high = [2 * v >= size for v in values]
    a, b = sum(high), n - sum(high)
    if a and b:
        runs = 1 + sum(x != y for x, y in zip(high, high[1:], strict=False))
        mean = 2 * a * b / n + 1
        spread = (mean - 1) * (mean - 2) / (n - 1)
        tests.append(math.erfc(abs(runs - mean) / math.sqrt(2 * spread)) if spread > 0 else 1e-12)
    else:
        tests.append(1e-12)
    mean = sum(values) / n
    var = sum((v - mean) ** 2 for v in values)
    if var > 0:
        r = sum((x - mean) * (y - mean) for x, y in zip(values, values[1:], strict=False)) / var
        tests.append(math.erfc(abs(r + 1 / n) * math.sqrt(n / 2)))
    else:
        tests.append(1e-12)
    p = chi_squared_tail(-2 * sum(math.log(max(t, 1e-12)) for t in tests), 2 * len(tests))
    digits = sum(c.isdigit() for c in ALPHABETS[encoding]) / size
    if not any(c.isdigit() for c in run):  # words
        p = min(p, (1 - digits) ** n)
    elif all(c.isdigit() for c in run.rstrip("=")):  # numbers
        p = min(p, digits**n)
    return encoding, p


def length_class(n: int) -> int:
    return max(x for x in LENGTHS if x <= n)


def scan(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[int, int, str, float]]]:
    """Base spans (kind, start, end) in order, and tested runs (start, end, class, p)."""
    base, tested = [], []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        base += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    runs = list(RUN.finditer(text))  # hex and access spans of their least size lie within such runs
    for m in runs:
        for kind, pattern in (("access", ACCESS), ("hex", HEX)):
            base += [(kind, x.start(), x.end()) for x in pattern.finditer(text, *m.span()) if x.end() - x.start() >= LEAST[kind]]
    base.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    ended = list(accumulate((b for _, _, b in base), max))  # where all spans so far have ended
    first = 0  # base spans before it end before the run; both lists are in order
    for m in runs:
        while first < len(base) and ended[first] <= m.start():
            first += 1
        for a, b in outside(m.start(), m.end(), base, first):
            for x in PADDED.finditer(text, a, b):
                if x.end() - x.start() >= SHORTEST:
                    tested += tests_of(text, *x.span())
    return base, tested


def outside(start: int, end: int, base: list[tuple[str, int, int]], first: int) -> list[tuple[int, int]]:
    """The stretches of start to end that no base span from number `first` on covers; base is in order of starts."""
    out = []
    for i in range(first, len(base)):
        _, a, b = base[i]
        if a >= end:
            break
        if start < b:
            if a > start:
                out.append((start, a))
            start = max(start, b)
    return [*out, (start, end)] if start < end else out


def tests_of(text: str, start: int, end: int) -> list[tuple[int, int, str, float]]:
    """The test of a run as a whole, or those of its long parts if it doesn't look random; p that can't reach any threshold is left out."""
    encoding, p = randomness(text[start:end])
    spans = [(start, end, encoding, p)]
    if p < PARTED:
        parts = [x.span() for x in PART.finditer(text, start, end) if x.end() - x.start() >= SHORTEST]
        spans = [(a, b, *randomness(text[a:b])) for a, b in parts] or spans
    return [(a, b, f"{e}:{length_class(b - a)}", p) for a, b, e, p in spans if p > 0.001]


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _scanned(docs: DataFrame) -> DataFrame:
    def make():
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                base, tested = scan(text or "")
                n = Counter(k for k, _, _ in base)
                rows.append({"doc_id": doc_id, "n_assign": n["assign"], "n_access": n["access"], "n_hex": n["hex"], "base_sha256": sha256(joined(base).encode()).hexdigest(), "base": [dict(zip(("kind", "start", "end"), s, strict=True)) for s in base], "tested": [dict(zip(("start", "end", "class", "p"), s, strict=True)) for s in tested]})
            return pa.RecordBatch.from_pylist(rows, schema=arrow)

        span = [pa.field("start", pa.int32()), pa.field("end", pa.int32())]
        arrow = pa.schema([("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("base_sha256", pa.string()), ("base", pa.list_(pa.struct([pa.field("kind", pa.string()), *span]))), ("tested", pa.list_(pa.struct([*span, pa.field("class", pa.string()), pa.field("p", pa.float64())])))])
        return each

    return arrow_map(only(docs, "doc_id", "text"), make, SCHEMA)


def thresholds(bars: dict[str, Counter], fdr: float) -> dict[str, float]:
    """For each class the least t at which the share of others among p >= t is at most fdr; absent if there is none.

    Classes with few runs above one half are counted together and share t.
    """
    out = {}
    above = lambda counts: sum(n for bar, n in counts.items() if bar >= BARS // 2)
    pool = sum((c for c in bars.values() if above(c) < FEW), Counter())
    for name, own in bars.items():
        counts = own if above(own) >= FEW else pool
        random = 2.0 * above(counts)
        found = 0
        for bar in range(BARS - 1, 0, -1):
            found += counts[bar]
            if found and 1 - random * (1 - bar / BARS) / found <= fdr:
                out[name] = bar / BARS
    return out


def secret_spans(docs: DataFrame, fdr: float = 0.05) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, base, found (spans of the method), spans (all, as text)."""
    rows = materialise(_scanned(docs), "secrets")
    bars: dict[str, Counter] = {}  # at most classes x BARS entries, whatever the corpus
    for r in rows.select(F.explode("tested").alias("t")).groupBy("t.class", F.floor(F.col("t.p") * BARS).alias("bar")).count().collect():
        bars.setdefault(r["class"], Counter())[min(BARS - 1, r["bar"])] += r["count"]
    at_least = thresholds(bars, fdr)
    passes = lambda t: F.lit(False)
    if at_least:
        limit = F.create_map(*[F.lit(x) for pair in at_least.items() for x in pair])
        passes = lambda t: F.coalesce(t["p"] >= limit[t["class"]], F.lit(False))
    found = F.transform(F.filter("tested", passes), lambda t: F.struct(F.lit("random").alias("kind"), t["start"].alias("start"), t["end"].alias("end")))
    rows = rows.withColumn("found", found)
    order = F.array(*[F.lit(k) for k in KINDS])
    every = F.array_sort(F.transform(F.concat("base", "found"), lambda s: F.struct(s["start"].alias("start"), F.array_position(order, s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))))
    spans = F.array_join(F.transform(every, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    return rows.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "base", "found", spans.alias("spans"))


def redact(docs: DataFrame, mask: str = "[secret]", fdr: float = 0.05) -> DataFrame:
    """docs with every span of every text replaced by mask, and n_chars, if there, set anew.

    Spans are found and cut row by row, so rows that share a doc_id stay apart.
    All columns pass through, whatever their names.
    """

    def make():
        def each(batch: pa.RecordBatch) -> pa.RecordBatch | None:
            flat = [{"class": c, "p": p} for t in batch.column(0).to_pylist() for _, _, c, p in scan(t or "")[1]]
            return pa.RecordBatch.from_pylist(flat, schema=pa.schema([("class", pa.string()), ("p", pa.float64())])) if flat else None

        return each

    bars: dict[str, Counter] = {}
    for r in arrow_map(only(docs, "text"), make, "class string, p double").groupBy("class", F.floor(F.col("p") * BARS).alias("bar")).count().collect():
        bars.setdefault(r["class"], Counter())[min(BARS - 1, r["bar"])] += r["count"]
    limits = thresholds(bars, fdr)

    def make_cut():
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column("text").to_pylist()
            cut = [t and masked(t, spans_of(t, limits), mask) for t in texts]
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            columns["text"] = pa.array(cut, batch.schema.field("text").type)
            if "n_chars" in columns:
                n = [len(c) if c != t else was for t, c, was in zip(texts, cut, columns["n_chars"].to_pylist(), strict=True)]
                columns["n_chars"] = pa.array(n, batch.schema.field("n_chars").type)
            return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

        return each

    return arrow_map(docs, make_cut, docs.schema)


def spans_of(text: str, limits: dict[str, float]) -> list[tuple[int, int]]:
    base, tested = scan(text)
    return sorted([(a, b) for _, a, b in base] + [(a, b) for a, b, c, p in tested if p >= limits.get(c, 2)])


def masked(text: str, spans: list[tuple[int, int]], mask: str) -> str:
    out, at = [], 0
    for a, b in spans:
        if a >= at:
            out += [text[at:a], mask]
        at = max(at, b)
    return "".join([*out, text[at:]])
