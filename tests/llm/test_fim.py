import random
import re
from hashlib import sha256

import numpy as np
import pytest

from termloom.llm import fim
from termloom.llm.fim import Automaton, Counts, fill_in_middle, restored


def brute(doc_id, text):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    hexed = sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(hexed[i : i + 8], 16) for i in (0, 8, 16, 24)]
    n = len(units)
    x, y = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(u) for u in (units[:x], units[x:y], units[y:]))
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        form, output, sizes = "plain", text, (None, None)
    else:
        form = "spm" if h[3] % 100 < 20 else "psm"
        output = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
        sizes = len(p), len(m)
    return (doc_id, n, form, *sizes, sha256(output.encode()).hexdigest(), sha256(text.encode()).hexdigest())


SIGNS = ["a", "b", "Z", "<", "P", "S", "M", ">", "<P>", "<S", "é", "\U0001f600", "\n", "1", " ", "\x00"]


def test_automaton_counts(monkeypatch):
    monkeypatch.setattr(fim, "PIECE", 700)
    rng = random.Random(1)
    texts = ["".join(rng.choice(SIGNS) for _ in range(rng.choice([0, 1, 3, 10, 300, 5000]))) for _ in range(300)]
    raw = [t.encode() for t in texts]
    at = np.concatenate(([0], np.cumsum([len(r) for r in raw])))
    counted = Automaton().run(np.frombuffer(b"".join(raw), np.uint8), at[:-1])
    for t, a, b in zip(texts, at[:-1], at[1:], strict=True):
        found = counted[a:b]
        starts = [len(t[: m.start()].encode()) for m in re.finditer("[A-Za-z]+|[^A-Za-z]", t)]
        assert np.flatnonzero(found & fim.UNIT).tolist() == starts
        assert [np.count_nonzero(found & k) for k in (fim.POINT, fim.MARK)] == [len(t), len(re.findall("<[PSM]>", t))]


@pytest.mark.parametrize("sentinels", [fim.SENTINELS, ("<|pre|>", "<|suf|>", "<|mid|>"), ("▁é", "▂é", "▃é")])
def test_state_depends_on_no_more_than_a_sentinel(sentinels):
    automaton = Automaton(sentinels)
    rng = np.random.default_rng(2)
    held = np.frombuffer("".join(sentinels).encode() + b"a .", np.uint8)
    for _ in range(500):
        state = np.arange(len(automaton.step)).astype(np.uint16) * fim.CODES
        for byte in rng.choice(held, automaton.back):
            state = automaton._step[state + byte]
        assert len(set(state.tolist())) == 1


def test_blocks_of_counts(monkeypatch):
    monkeypatch.setattr(fim, "BLOCK", 8)
    bits = np.random.default_rng(3).integers(0, 2, 101).astype(np.uint8)
    c = Counts(bits, 1)
    assert [c.until(i) for i in range(102)] == [int(bits[:i].sum()) for i in range(102)]
    assert [c.place(k) for k in range(int(bits.sum()))] == np.flatnonzero(bits).tolist()


def test_sentinels_that_texts_could_forge():
    for bad in (("<P>", "<P>", "<M>"), ("<P", "<P>", "<M>"), ("", "<S>", "<M>"), ("aba", "<S>", "<M>")):
        with pytest.raises(ValueError, match="told apart"):
            fim.checked(bad)
    assert restored(b"<S>x<<P>S><M>M>", "spm") == b"S>M>x<"


def test_brute_force(edge, mixed_docs, empty):
    for docs in (edge, mixed_docs):
        want = sorted(map(str, (brute(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())))
        assert sorted(str(tuple(r)) for r in fill_in_middle(docs, keep_text=False).collect()) == want
    forms = {r["form"]: r["count"] for r in fill_in_middle(mixed_docs, keep_text=False).groupBy("form").count().collect()}
    assert set(forms) == {"plain", "psm", "spm"} and forms["psm"] > forms["spm"] > 10
    assert fill_in_middle(empty).collect() == []


def test_general_interface(mixed_docs):
    marks = ("<|pre|>", "<|suf|>", "<|mid|>")
    own = {r.doc_id: r.text or "" for r in mixed_docs.collect()}
    rows = fill_in_middle(mixed_docs, plain=0, spm=100, seed=7, sentinels=marks).collect()
    assert {r.form for r in rows if own[r.doc_id]} == {"spm"}
    assert all(restored(r.output.encode(), r.form, marks).decode() == own[r.doc_id] for r in rows)
