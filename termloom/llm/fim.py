"""Operator 11: fill-in-the-middle, by a table-driven automaton over bytes.

A text is cut at two drawn unit boundaries into prefix, middle and suffix, which
are put together again behind sentinels, so that a model learns to fill gaps.

One scan runs an automaton over the UTF-8 bytes.  Its state says whether a
letter came before and how much of a sentinel has been read; its table is built
from the sentinels, and each transition carries what it counts: a unit begins, a
code point begins (no continuation byte), a sentinel is complete.  A state
depends on no more bytes than the longest sentinel has, so bytes are laid out in
lanes, each lane is primed with the bytes before it, and all lanes step at once.
Counts are summed by block.  The second pass finds the block of a cut by those
sums and looks only at the transitions of that block.

Defined results: a null text counts as empty; an empty text is plain, without
units; a null doc_id draws as an id of no digits; rows are cut independently, so
repeated ids or texts stay repeated and equal rows get equal results; an empty
table gives an empty result; further columns are ignored.  A text's length is
bounded only by memory for a few copies of one text.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from termloom.llm.common import arrow_map, only

#: Sentinels before prefix, suffix and middle.
SENTINELS = ("<P>", "<S>", "<M>")
#: What a transition counts: a unit's first byte, a code point's first byte, a sentinel's last one.
UNIT, POINT, MARK = 1, 2, 4
#: Bytes of a lane, of what is scanned at once, and of a block of counts.
LANE, PIECE, BLOCK = 256, 1 << 20, 4096
#: Codes of a byte, and what is added for a text's first one.
CODES, FIRST = 512, 256


def checked(sentinels: tuple[str, str, str]) -> tuple[bytes, ...]:
    """The sentinels as bytes, if no text between them can ever be taken for one of them."""
    marks = tuple(s.encode() for s in sentinels)
    for a in marks:
        if not a or any(b != a and b.startswith(a) for b in marks) or any(a[0] in b[1:] for b in marks) or len(set(marks)) < 3:
            raise ValueError(f"sentinels {sentinels} can't be told apart in every text")
    return marks


class Automaton:
    def __init__(self, sentinels: tuple[str, str, str] = SENTINELS) -> None:
        marks = checked(sentinels)
        letters = set(range(65, 91)) | set(range(97, 123))
        begun = sorted({m[:i] for m in marks for i in range(1, len(m))})
        # states: no letter before, a letter before, and what has been read of a sentinel
        states = {(b"", False): 0, (b"", True): 1} | {(p, p[-1] in letters): i for i, p in enumerate(begun, 2)}
        if len(states) * CODES > 1 << 16:
            raise ValueError("the sentinels are too long")
        self.back = max(map(len, marks))
        self.step = np.zeros((len(states), CODES), np.uint16)
        self.counted = np.zeros((len(states), CODES), np.uint8)
        for (read, letter), state in states.items():
            for byte in range(256):
                for code, was, after in ((byte, read, letter), (byte + FIRST, b"", False)):
                    now = was + bytes([byte])
                    held = next((now[i:] for i in range(len(now)) if now[i:] in begun), b"")
                    point = not 0x80 <= byte < 0xC0
                    unit = not after if byte in letters else point
                    self.counted[state, code] = UNIT * unit | POINT * point | MARK * any(now.endswith(m) for m in marks)
                    self.step[state, code] = CODES * states[held, (held[-1] if held else byte) in letters]
        self._step, self._counted = self.step.reshape(-1), self.counted.reshape(-1)

    def run(self, data: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        """What the transition at each byte counts; firsts are places where a text begins."""
        out, codes = np.empty(len(data), np.uint8), np.zeros(self.back, np.uint16)
        firsts = np.unique(firsts[firsts < len(data)])
        for a in range(0, len(data), PIECE):
            b = min(a + PIECE, len(data))
            before = codes[len(codes) - self.back :]
            codes = data[a:b].astype(np.uint16)
            codes[firsts[np.searchsorted(firsts, a) : np.searchsorted(firsts, b)] - a] += FIRST
            out[a:b] = self._lanes(codes, before)
            codes = np.concatenate((before, codes))[-self.back :]
        return out

    def _lanes(self, codes: np.ndarray, before: np.ndarray) -> np.ndarray:
        n = -(-len(codes) // LANE)
        grid = np.zeros(n * LANE, np.uint16)
        grid[: len(codes)] = codes
        grid = np.ascontiguousarray(grid.reshape(n, LANE).T)
        state = np.zeros(n, np.uint16)
        for i in range(self.back):
            last = np.concatenate((before[i : i + 1], grid[LANE - self.back + i, :-1]))
            state = self._step[state + last]
        out = np.empty((LANE, n), np.uint8)
        for i in range(LANE):
            at = state + grid[i]
            out[i] = self._counted[at]
            state = self._step[at]
        return out.T.reshape(-1)[: len(codes)]


class Counts:
    """Sums by block of one thing that transitions count."""

    def __init__(self, counted: np.ndarray, what: int) -> None:
        self.hits = (counted & what).astype(bool)
        blocks = np.add.reduceat(self.hits, np.arange(0, len(counted), BLOCK), dtype=np.int64) if len(counted) else np.zeros(0, np.int64)
        self.before = np.concatenate(([0], np.cumsum(blocks)))

    def until(self, at: int) -> int:
        """How many there are before the byte at."""
        block = at // BLOCK
        return int(self.before[block]) + int(np.count_nonzero(self.hits[block * BLOCK : at]))

    def place(self, k: int) -> int:
        """The byte of the k-th one, counted from 0."""
        block = int(np.searchsorted(self.before, k, side="right")) - 1
        return block * BLOCK + int(np.flatnonzero(self.hits[block * BLOCK : (block + 1) * BLOCK])[k - int(self.before[block])])


def draws(doc_id: int | None, seed: int) -> list[int]:
    """Four numbers of 32 bits that depend on id and seed alone."""
    held = sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(held[i : i + 4], "big") for i in range(0, 16, 4)]


def joined(form: str, prefix: bytes, middle: bytes, suffix: bytes, marks: tuple[bytes, ...]) -> bytes:
    p, s, m = marks
    return p + prefix + s + suffix + m + middle if form == "psm" else s + suffix + p + prefix + m + middle


def restored(output: bytes, form: str, sentinels: tuple[str, str, str] = SENTINELS) -> bytes:
    """The text that an output was made of."""
    if form == "plain":
        return output
    p, s, m = checked(sentinels)
    one, two = (p, s) if form == "psm" else (s, p)
    a = output.index(two, len(one))
    b = output.index(m, a + len(two))
    first, second, middle = output[len(one) : a], output[a + len(two) : b], output[b + len(m) :]
    return first + middle + second if form == "psm" else second + middle + first


def fill_in_middle(docs: DataFrame, plain: int = 10, spm: int = 20, seed: int = 1, sentinels: tuple[str, str, str] = SENTINELS, keep_text: bool = True) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars, output_sha256, restored_sha256, and with keep_text the output.

    A unit is a run of ASCII letters or any other code point.  plain: percent of
    documents that stay as they are, beside empty ones and those that hold a
    sentinel; spm: percent of the others whose suffix comes first.
    """
    marks = checked(sentinels)

    def make():
        automaton = Automaton(sentinels)

        def chunk(data: np.ndarray, ids: list, offsets: np.ndarray) -> list[tuple]:
            counted = automaton.run(data, offsets[:-1])
            units, points, found = (Counts(counted, what) for what in (UNIT, POINT, MARK))
            rows, body = [], data.tobytes()
            for doc_id, a, b in zip(ids, offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                text, first = body[a:b], units.until(a)
                n = units.until(b) - first
                h = draws(doc_id, seed)
                if not n or found.until(b) > found.until(a) or h[2] % 100 >= 100 - plain:
                    form, output, sizes = "plain", text, (None, None)
                else:
                    form = "spm" if h[3] % 100 < spm else "psm"
                    x, y = (b if k == n else units.place(first + k) for k in sorted((h[0] % (n + 1), h[1] % (n + 1))))
                    at = points.until(a), points.until(x), points.until(y)
                    sizes = at[1] - at[0], at[2] - at[1]
                    output = joined(form, body[a:x], body[x:y], body[y:b], marks)
                back = restored(output, form, sentinels)
                rows.append((doc_id, n, form, *sizes, sha256(output).hexdigest(), sha256(back).hexdigest(), *([output] if keep_text else [])))
            return rows

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            text = batch.column("text").cast(pa.large_binary()).fill_null(b"")
            _, raw, held = text.buffers()
            offsets = np.frombuffer(raw, np.int64, len(text) + 1 + text.offset)[text.offset :]
            data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
            ids, rows, i = batch.column("doc_id").to_pylist(), [], 0
            while i < len(text):
                j = min(max(i + 1, int(np.searchsorted(offsets, offsets[i] + PIECE, side="right")) - 1), len(text))
                rows += chunk(data[offsets[i] : offsets[j]], ids[i:j], offsets[i : j + 1] - offsets[i])
                i = j
            kinds = [batch.column("doc_id").type, pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary()]
            names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256", "output"]
            width = len(names) if keep_text else len(names) - 1
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=False)] if rows else [pa.array([], k) for k in kinds[:width]]
            if keep_text:
                columns[-1] = columns[-1].cast(pa.string())
            return pa.RecordBatch.from_arrays(columns, names[:width])

        return each

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"
    return arrow_map(only(docs, "doc_id", "text"), make, schema + ", output string" * keep_text)
