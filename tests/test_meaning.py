"""Meanings, definitions, roles of letters, arbitration and the checks of records."""

import pytest
from pyspark.sql import functions as F

from quillgraph.functions import symbols as S
from quillgraph.functions import text as T
from quillgraph.operators import meaning as E
from quillgraph.operators import provenance as P
from quillgraph.operators import reconcile as M

ROWS = "row_id long, arxiv_id string, equation string, text_before string, text_after string, section string"


def test_meanings(spark):
    rows = [
        (1, "p", "H = a + b", "Nothing here. Below, a total energy operator called", None, None), (2, "p", "[A, B] = C", "We define the spectral gap function", None, None),
        (3, "p", "[A, B] = C", "We define the commutator algebra", None, None), (4, "p", "\\\\rho_s = c + d", None, "where \\\\rho_s is the reduced density matrix", None),
        (5, "p", "a = b", None, None, None), (6, "q", None, "", "", "")]
    got = {r.row_id: (r.meaning, r.stage, r.confidence) for r in E.meanings(spark.createDataFrame(rows, ROWS).withColumn("phrase", F.lit("clash")), ["row_id"], "arxiv_id").collect()}
    assert got[1] == ("total energy operator", "definiendum (regex cue)", "high") and got[2] == ("commutation relation", "role name", "medium")
    assert got[3][0] == "commutator algebra" and got[5] == ("", "empty", "low") and got[6][0] == ""
    assert E.meanings(spark.createDataFrame([], ROWS), ["row_id"], "arxiv_id").count() == 0


def test_shared_meanings_are_blanked(spark):
    rows = [(n, "p", "[A, B] = C", None, None, None) for n in range(4)] + [(9, "q", "[A, B] = C", None, None, None)]
    got = {r.row_id: r.meaning for r in E.meanings(spark.createDataFrame(rows, ROWS), ["row_id"], "arxiv_id").collect()}
    assert set(got.values()) == {"", "commutation relation"} and got[9] != ""


@pytest.mark.parametrize("raw, clean", [
    ("the coupling strength, which we set", "coupling strength"), ("reduced density matrix of the bath. Then", "reduced density matrix of the bath"), ("operator", ""), ("of the bath", ""),
    ("energy given by Eq. (2)", "energy"), ("shown to be small", ""), ("our rate", ""), ("", ""), (None, ""), ("a b c d", ""), ("decay rate $\\gamma$", "decay rate"), ("rate (in units", "rate"),
])
def test_definitions(raw, clean):
    assert S.clean_definition(raw) == clean


@pytest.mark.parametrize("text, roles", [
    ("\\\\sum_{n=1}^{N} a_n", {"n": "index", "N": "index"}), ("\\\\frac{\\\\partial f}{\\\\partial t}", {"f": "derivative", "t": "derivative"}), ("i\\\\hbar \\\\psi", {"i": "imaginary unit"}), ("a_{i} + b_j", {"i": "index", "j": "index"}),
    ("p(x) = 1", {"p": "probability"}), ("\\\\mathcal{L} \\\\rho", {"L": "lindblad"}), ("\\\\int f dx", {"x": "differential"}), ("\\\\gamma^{\\\\mu}", {"gamma": "dirac", "mu": "lorentz"}), ("", {}),
])
def test_roles(text, roles):
    assert S.letter_roles(text.replace("\\\\", "\\")) == roles


@pytest.mark.parametrize("phrase, valid", [("spectral gap", True), ("gap is open", False), ("gap of", False), ("of gap", False), ("QED", True), ("gap", False), ("see fig", False), ("x_1 gap", False), ("a b cd", False), (None, False), ("Dirac equation", True), ("one two three four five six seven", False)])
def test_phrases(spark, phrase, valid):
    assert spark.createDataFrame([(phrase,)], "p string").select(T.valid_phrase(F.col("p"))).first()[0] is valid


def test_arbitration(spark):
    sets = "document string, place int, equation string"
    left = spark.createDataFrame([("a", 1, "x = y + z"), ("a", 2, "u = v"), ("b", 1, "\\frac{a}{b} = c"), ("c", 1, "x = 1")], sets)
    right = spark.createDataFrame([("a", 1, "x = y + z"), ("a", 2, "u = v"), ("a", 3, "w = 1"), ("b", 1, "k - l > m"), ("d", 1, "x")], sets)
    alike = {r.document: (r.similarity, r.pairs) for r in M.set_similarity(left, right).collect()}
    assert alike["a"] == (1.0, 2) and alike["b"][0] < 0.48 and set(alike) == {"a", "b"}
    quality = lambda *rows: spark.createDataFrame(rows, "document string, quality double, garbled int")
    got = {r.document: (r.prefer, r.reason) for r in M.arbitrate(quality(("a", 0.9, 0), ("b", 0.9, 0), ("c", 0.1, 0)), quality(("a", 0.5, 0), ("b", 0.5, 0), ("d", 0.2, 0)), M.set_similarity(left, right)).collect()}
    assert got["a"] == ("right", "sets agree") and got["b"][0] == "left" and got["c"] == ("left", "only set") and got["d"][0] == "right"
    poor = M.arbitrate(quality(("b", 0.4, 0)), quality(("b", 0.3, 0)), M.set_similarity(left, right)).first()
    garbled = M.arbitrate(quality(("b", 0.6, 1)), quality(("b", 0.7, 0)), M.set_similarity(left, right)).first()
    assert (poor.prefer, garbled.prefer) == ("right", "right")


def test_violations(spark):
    schema = "rec_id long, arxiv_id string, eq_number string, equation string, relations map<string,struct<grade:string>>"
    ok, odd = ("none",), ("what",)
    rows = [(1, "a", "1", "x", {"2": ok, "3": ok}), (2, "a", "2", "", {"1": ok}), (3, "a", "3", "x", {"1": odd, "2": ok, "3": ok, "9": ok}), (4, "b", "1", "x", {}), (5, "b", "1", None, None)]
    got = {}
    for r in P.violations(spark.createDataFrame(rows, schema)).collect():
        got.setdefault(r.rec_id, set()).add(r.problem)
    assert got == {2: {"empty equation", "missing relation"}, 3: {"unknown grade", "relation to itself", "relation to an unknown label"}, 5: {"empty equation"}}
