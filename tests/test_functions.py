import json
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from termloom.functions import morph, names, text
from termloom.functions.anchor import anchor, slice_of
from termloom.functions.tolerant import answer_array, repair


def values(spark, rows, schema, **columns):
    return [r.asDict() for r in spark.createDataFrame(rows, schema).select(*[c.alias(n) for n, c in columns.items()]).collect()]


def test_predicates(spark):
    rows = [("abc", "汉字"), ("12 %", "x"), (None, None), ("汉 a", "汉字汉"), ("", " ")]
    got = values(spark, rows, "a string, b string", m=text.is_meaningful("a"), u=text.usable("a", "b"), r=text.cjk_ratio("a"), s=text.foreign_side("a", "b"))
    assert [g["m"] for g in got] == [True, False, False, True, False]
    assert [g["u"] for g in got] == [True, False, False, True, False]
    assert [g["r"] for g in got] == [0, 0, 0, 0.5, 0]
    assert [g["s"] for g in got] == ["src", "tgt", "tgt", "src", "tgt"]


def test_types(spark):
    got = values(spark, [("Tech, other；POLI",), ("num",), (None,), ("other",), ("tech/tech|x",)], "t string", t=text.norm_types("t"))
    assert [g["t"] for g in got] == [["tech"], [], [], ["other"], ["tech"]]


@pytest.mark.parametrize(("given_", "want"), [("l’eau", "l'eau"), ("“mot”", "mot"), ('"a" et "b"', '"a" et "b"'), ("“l’eau”", "l'eau"), ('""', '""'), ("«  x »", "x"), ('proyecto "X"', 'proyecto "X"')])
def test_delivery_text(spark, given_, want):
    assert values(spark, [(given_,)], "t string", t=text.normalize_delivery("t"))[0]["t"] == want


def test_call_predicates(spark):
    rows = [(402, None, 0, 0), (403, "Account-balance is_insufficient", 25, 100), (429, "slow down", 20, 300), (None, "额度不足", 19, 20)]
    got = values(spark, rows, "s int, m string, h int, c int", b=text.balance_exhausted("s", "m"), r=text.rate_limited("h", "c"))
    assert [(g["b"], g["r"]) for g in got] == [(True, False), (True, True), (False, False), (True, False)]
    got = values(spark, [(True, " ", "stop"), (True, "x", "length"), (False, None, None), (True, "x", "content_filter")], "ok boolean, c string, f string", r=text.refused("ok", "c", "f"), t=text.truncated("f"))
    assert [(g["r"], g["t"]) for g in got] == [(True, False), (False, True), (False, False), (True, False)]


@pytest.mark.parametrize(
    ("name", "out", "layer", "direction"),
    [
        ("zh-es_conf_poli_0001_align.qc.json", "zh-es_conf_poli_0001_term.xlsx", "conf/poli", "zh-es"),
        ("zh-es_conf_poli_0001_algin.qc.json", "zh-es_conf_poli_0001_term.xlsx", "conf/poli", "zh-es"),
        ("a_b_c_align.qc (1).json", "a_b_c_term.xlsx", "b/c", "a"),
        ("a_b_c_align.qc .json", "a_b_c_term.xlsx", "b/c", "a"),
        ("a_b_align.qc..json", "a_b_term.xlsx", "b/align.qc.", "a"),
        ("a_b_align.json", "a_b_align_term.xlsx", "b/align", "a"),
        ("x.jsonl", "x_term.xlsx", "?/?", "x"),
        ("x", "x_term.xlsx", "?/?", "x"),
    ],
)
def test_names(spark, name, out, layer, direction):
    n = F.col("n")
    assert values(spark, [(name,)], "n string", o=names.out_name(n), y=names.layer(n), d=names.name_direction(n)) == [{"o": out, "y": layer, "d": direction}]


FORMS = [
    ("flor", "flores", "es", None), ("empresa privada", "empresas privadas", "es", None), ("empresa privado", "empresas privadas", "es", "gender_flipped"),
    ("luz de neón", "luces de neón", "es", None), ("luz del neón", "luces de neón", "es", "function_word"), ("estado", "Estados", "es", "proper_name"),
    ("flor azul", "flores", "es", "word_count"), ("花", "flores", "es", "new_cjk"), ("флор", "flores", "es", "new_cyrillic"), ("", "flores", "es", "empty_form"),
    ("grand", "grande", "fr", "gender_flipped"), ("travail", "travaux", "fr", None), ("porcelaine bleue", "porcelaines bleues", "fr", None),
    ("компания", "компании", "ru", None), ("завод", "компании", "ru", "stem"), ("kompania", "компании", "ru", "new_latin"), ("ёлка", "елки", "ru", None), ("x", "y", "de", None),
]


def test_forms_without_analyzer(spark):
    got = values(spark, [f[:3] for f in FORMS], "b string, s string, l string", e=morph.check_form(F.col("b"), F.col("s"), F.col("l")))
    assert [(f[0], g["e"]) for f, g in zip(FORMS, got, strict=True)] == [(f[0], f[3]) for f in FORMS]


class Toy:
    """A dictionary of a few words, as an analyzer."""

    table = {"яма": "яма", "яму": "яма", "угля": "уголь", "уголь": "уголь", "flores": "flor", "flor": "flor", "casa": "casa"}

    def known(self, w, lang):
        return w.lower() in self.table

    def lemmas(self, w, lang):
        return {self.table.get(w.lower(), w.lower())}

    def noun(self, w):
        return True

    nominal = noun

    def nominative(self, w):
        return w.lower() in self.table.values()

    def numbers(self, w):
        return {"sing"}


def test_forms_with_analyzer(spark):
    check = morph.with_analyzer(Toy())
    rows = [("уголь", "угля", "ru"), ("яму", "яма", "ru"), ("casa", "flores", "es"), ("flor", "flores", "es"), ("flor", "", "es")]
    got = values(spark, rows, "b string, s string, l string", e=check(F.col("b"), F.col("s"), F.col("l")))
    assert [g["e"] for g in got] == [None, "not_nominative", "other_word", None, "empty_span"]
    assert values(spark, [("flores", "es")], "b string, l string", k=morph.plural_kept(None)(F.col("b"), F.col("l"))) == [{"k": False}]
    assert morph.status({"es": Toy()})["ru"].startswith("checks without")


@pytest.mark.parametrize(("base", "span", "lang", "changed"), [("forme d'entreprise", "formes d'entreprises", "fr", True), ("immeuble de bureaux", "immeubles de bureaux", "fr", False), ("luz de neón", "luces de neones", "es", True), ("porcelaine et vase", "porcelaines et vases", "fr", False), ("a", "b", "ru", False)])
def test_complement(spark, base, span, lang, changed):
    assert values(spark, [(base, span, lang)], "b string, s string, l string", c=morph.complement_changed(F.col("b"), F.col("s"), F.col("l")))[0]["c"] is changed


@pytest.mark.parametrize(("term", "sentence", "want"), [("casa", "La casa azul", "casa"), ("CASA", "La Casa azul", "Casa"), ("елка", "Зелёная Ёлка тут", "Ёлка"), ("a  b", "x A\n b y", "A\n b"), ("perro", "gato", None), ("", "x", None), ("strasse", "Die STRAßE hier", "STRAßE"), ("s", "ß", None)])
def test_anchor(spark, term, sentence, want):
    assert slice_of(term, sentence) == want
    assert values(spark, [(term, sentence)], "t string, s string", a=anchor(F.col("t"), F.col("s")))[0]["a"] == want


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aAéÉёЁ ßſ\ńx", max_size=12), st.text(alphabet="aAéÉёЁ ßſ\ńx", max_size=6))
def test_an_anchor_is_always_a_slice(sentence, term):
    found = slice_of(term, sentence)
    assert found is None or found in unicodedata.normalize("NFC", sentence)


def test_repair():
    assert repair('{"a": 1 "b": [1,2,], }') == ({"a": 1, "b": [1, 2]}, ["missing_comma", "trailing_comma", "trailing_comma"])
    assert repair('{"a" 1}')[0] is None and repair("words")[0] is None and repair("")[0] is None
    assert repair('[1, 2]') == ([1, 2], [])
    assert repair("[" + " ".join("1" for _ in range(60)) + "]")[0] is None
    assert repair('[{"x": "a,]"} {"y": "\\""}]')[0] == [{"x": "a,]"}, {"y": '"'}]


@settings(max_examples=150, deadline=None)
@given(st.recursive(st.none() | st.booleans() | st.integers() | st.text(max_size=4), lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text(max_size=3), x, max_size=3), max_leaves=8))
def test_repair_undoes_lost_commas(value):
    whole = json.dumps(value, indent=1)
    assert repair(whole)[0] == value
    if (at := whole.find(",\n")) >= 0 and '"' not in whole:
        assert repair(whole[:at] + whole[at + 1 :])[0] == value


@pytest.mark.parametrize(("answer", "want"), [("[]", ([], True)), ("", ([], False)), ("sorry", ([], False)), ("```json\n[1]\n```", ([1], True)), ('{"result": [2]}', ([2], True)), ("so: [3,] ok", ([3], True)), ('{"sent_id": 4}', ([{"sent_id": 4}], True)), ("［“a”，“b”］", (["a", "b"], True)), ('{"x": 1}', ([], False))])
def test_answers(answer, want):
    assert answer_array(answer) == want


def test_words_of_two_letters_share_a_stem():
    assert morph.analyzed_error("su", "sus", "es", None, Toy()) is None and morph.analyzed_error("té", "tés", "fr", None, Toy()) is None
    assert morph.analyzed_error("su", "la", "es", None, Toy()) == "other_word"
