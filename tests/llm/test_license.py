import random

import pytest

from termloom.llm.license import COVERAGE, NOTICES, Library, Template, license_notices, notices, patience, rising, words_of


def test_rising_is_longest():
    rng = random.Random(6)
    for _ in range(200):
        seconds = rng.sample(range(12), rng.randrange(1, 10))
        best = [1] * len(seconds)
        for i in range(len(seconds)):
            best[i] += max([best[j] for j in range(i) if seconds[j] < seconds[i]], default=0)
        out = rising(list(enumerate(seconds)))
        assert len(out) == max(best) and all(a < c and b < d for (a, b), (c, d) in zip(out, out[1:], strict=False))


def test_patience_aligns_equal_words_in_order():
    a, b = "a x b y c d".split(), "z a b q y y c d".split()
    pairs = patience(a, b)
    assert [a[i] for i, _ in pairs] == ["a", "b", "c", "d"] or len(pairs) >= 4
    assert all(a[i] == b[j] for i, j in pairs) and pairs == sorted(pairs)


def test_notices(spark, edge, empty):
    mit = NOTICES["MIT"][0]
    rows = [(1, "x y " + mit.replace("merge", "fuse").upper() + " tail"), (2, "see: Licensed under CC BY-NC 4.0. ok"), (3, "the of and license nothing"), (4, None), (5, " ".join(mit.split()[:40])), (2, "see: Licensed under CC BY-NC 4.0. ok"), (6, "Released under the MIT License. Released under the MIT License.")]
    got = license_notices(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = sorted((r.doc_id, r.license) for r in got)
    assert found == [(1, "MIT"), (2, "CC-BY-NC-4.0"), (2, "CC-BY-NC-4.0"), (6, "MIT"), (6, "MIT")]
    one = next(r for r in got if r.doc_id == 1)
    assert one.aligned_words >= one.template_words - 1 and one.coverage > 0.98
    assert rows[1][1][next(r.start_char for r in got if r.doc_id == 2) :].startswith("Licensed under")
    assert license_notices(edge).count() == 0 and license_notices(empty).count() == 0


LIBRARY = Library(COVERAGE, NOTICES)


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Licensed under CC BY-SA 4.0.", "CC-BY-SA-4.0"),
        ("Licensed under CC BY 4.0.", "CC-BY-4.0"),
        ("Licensed under CC BY-ND 4.0.", "CC-BY-ND-4.0"),
        ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"),
        ("Word under CC BY-NC 4.0.", "CC-BY-NC-4.0"),
        ("Released under the BSD License.", "BSD"),
        ("Released under the GPL License.", "GPL"),
        ("Released under the MIT License.", "MIT"),
        ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0"),
        ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0"),
        ("This work is licensed under the GNU Lesser General Public License, version 3.", "LGPL-3.0"),
        ("This work is licensed under the GNU General Public License, version 9.", "GPL"),
        ("Licensed under the Apache License, Version 1.1.", "Apache-1.1"),
        ("Licensed under the Apache License, Version 2.0.", "Apache-2.0"),
        ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "CC-BY-SA-4.0"),
        ("Distributed under the terms of the 3-clause BSD license", "BSD-3-Clause"),
        ("He was released under the bridge of MIT", None),
        ("We met under the licence of the Apache people, version 2.0", None),
    ],
)
def test_names(text, want):
    assert [n[0] for n in notices(f"One two. {text} More words here.", LIBRARY)] == ([want] if want else [])


@pytest.mark.parametrize("name", sorted(NOTICES))
def test_every_notice_is_found_whole_under_its_own_name(name):
    text = NOTICES[name][0]
    rng = random.Random(3)
    common = [w for w, _, _ in words_of(text)]
    for noise in ("", " ".join(rng.choice(common) for _ in range(70)), "unlike words stand here " * 30):
        body = f"{noise} {text} {noise}"
        found = [n for n in notices(body, LIBRARY) if n[0] == name]
        assert len(found) == 1 and found[0][1] == found[0][2] and body[found[0][3] : found[0][4]].strip(" ./").endswith(text.split()[-1].strip("./"))
        assert {n[0] for n in notices(body, LIBRARY)} == {name}


def test_other_versions_keep_other_names():
    gpl = NOTICES["GPL-3.0-or-later"][0]
    assert {n[0] for n in notices(gpl.replace("version 3", "version 9"), LIBRARY)} == {"GPL"}  # the family, which the text names
    assert {n[0] for n in notices(NOTICES["BSD-2-Clause"][0], LIBRARY)} == {"BSD-2-Clause"}


def test_stretches_match_brute_force():
    rng = random.Random(9)
    words = [f"w{i}" for i in range(14)]
    for _ in range(150):
        t = Template("t", " ".join(rng.choice(words) for _ in range(rng.randrange(5, 12))), (), 0.8)
        text = [rng.choice(words + ["x", "y"]) for _ in range(rng.randrange(0, 40))]
        if rng.random() < 0.7:
            body = [w for w in t.words if rng.random() < 0.95]
            at = rng.randrange(len(text) + 1)
            text[at:at] = body
        every = [(a, min(len(text), a + t.span)) for a in range(len(text)) if text[a] in t.bag and len(patience(t.words, text[a : a + t.span])) >= t.need]
        found = [x for lo, hi in t.stretches(text) for x in t.best(text, lo, hi)]
        assert found or not every  # no start that covers the template is lost; votes may find more
        assert all(b - a <= t.span and n >= t.need and len(patience(t.words, text[a:b])) <= n for a, b, n in found)
        left = list(text)  # what is found doesn't overlap, and no window beside it is left
        for a, b, _ in sorted(found, reverse=True):
            assert all(not (a < d and c < b) for c, d, _ in found if (c, d) != (a, b))
            left[a:b] = [None] * (b - a)
        assert not any(None not in left[a:b] for a, b in every)


def test_long_texts_like_licences():
    import time

    rng = random.Random(1)
    common = [w for w, _, _ in words_of(NOTICES["MIT"][0])]
    text = " ".join(rng.choice(common) for _ in range(4000))
    began = time.monotonic()
    notices(text, LIBRARY)
    assert time.monotonic() - began < 60


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("This is not licensed under the MIT License.", []),
        ("It is not licensed under the GPL", []),
        ("It is no longer released under the MIT License or the Apache License, Version 2.0.", []),
        ("No warranty, licensed under the MIT License.", ["MIT"]),
        ("Ask or not. Licensed under the MIT License.", ["MIT"]),
        ("Not licensed under the GPL. Licensed under the MIT License.", ["MIT"]),
        ("Licensed under the Apache License, Version 2.0 or the MIT License.", ["Apache-2.0", "MIT"]),
        ("Licensed under MIT or Apache-2.0", ["MIT", "Apache-2.0"]),
        ("Licensed under the MIT License and you may or may not like it", ["MIT"]),
        ("# SPDX-License-Identifier: MIT\nimport x", ["MIT"]),
        ("SPDX-License-Identifier: GPL-3.0-or-later OR MIT", ["GPL-3.0-or-later", "MIT"]),
        ("SPDX-License-Identifier: GPL-2.0-only", ["GPL-2.0"]),
        ("SPDX-License-Identifier:", []),
    ],
)
def test_denied_joined_and_tagged(text, want):
    assert [n[0] for n in notices(text, LIBRARY)] == want
