"""Row operators on small fixtures, with nulls, ties, repeats and empty tables."""

import numpy as np
from pyspark.sql import functions as F

from quillgraph.functions import symbols as S
from quillgraph.functions import text as T
from quillgraph.operators import provenance as P
from quillgraph.operators import reconcile as M
from quillgraph.operators import rows as R


def test_first_by_label_and_top(spark):
    rows = [("a", "(2)", 1), ("a", "2", 2), ("a", "1", 3), ("a", None, 4), ("a", "10", 5), ("b", "1", 6)]
    df = spark.createDataFrame(rows, "d string, l string, n int")
    first = R.first_by_label(df, "d", "l", ["n"])
    assert sorted(r.n for r in first.collect()) == [1, 3, 5, 6]
    assert sorted((r.d, r.n) for r in R.top_k(first, "d", ["n"], 2).collect()) == [("a", 1), ("a", 3), ("b", 6)]
    assert R.first_by_label(df.limit(0), "d", "l", ["n"]).count() == 0


def test_gaps_and_recovery(spark):
    df = spark.createDataFrame([("a", "3"), ("a", "6"), ("a", "6"), ("a", "A.1"), ("b", "1"), ("b", None)], "d string, l string")
    gaps = R.numbering_gaps(df, "d", "l")
    assert sorted(tuple(r) for r in gaps.collect()) == [("a", 0, 3, 2), ("a", 3, 6, 2)]
    candidates = spark.createDataFrame([("a", 1, 0, "w"), ("a", 2, 0, "x"), ("a", 3, 0, "y"), ("a", 9, 3, "z")], "d string, position int, after_number int, t string")
    got = sorted((r.number, r.t) for r in R.recover_gaps(gaps, candidates, "d").collect())
    assert got == [(1, "x"), (2, "y"), (4, "z")]


def test_blank_repeated(spark):
    df = spark.createDataFrame([("a", "M")] * 3 + [("a", "m "), ("a", "x"), ("a", None), ("a", "")] + [("b", "M")] * 3, "d string, v string")
    got = [r.v for r in R.blank_repeated(df, "d", "v").collect()]
    assert sorted(x or "" for x in got) == ["", "", "", "", "", "", "M", "M", "M", "x"]


def test_pairs_do_not_depend_on_partitions(spark):
    df = spark.createDataFrame([("a", n) for n in range(5)] + [("b", 0)], "d string, n int")
    one, many = (R.unordered_pairs(df.repartition(k), "d", "n").select("d", "l.n", F.col("r.n").alias("m")) for k in (1, 8))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect())) and one.count() == 10


def test_inherit(spark):
    rows = [(1, "a", "X", "energy operator"), (2, "a", "X", ""), (3, "a", "X_eff", None), (4, "a", "Y_1", ""), (5, "b", "X", ""), (6, "a", "t", "time"), (7, "a", "t", "")]
    df = spark.createDataFrame(rows, "i int, d string, symbol string, definition string")
    got = {r.i: (r.definition, r.inherited) for r in R.inherit_definitions(df, "d", ["i"]).collect()}
    assert got[2] == ("energy operator", "exact") and got[3] == ("energy operator", "base") and got[5] == ("", "none") and got[7] == ("", "none")


def test_quality_and_predicates(spark):
    df = spark.createDataFrame([("\\frac{a}{b} = c",), (None,), ("",), ("word " * 8,)], "e string")
    rows = df.select(T.looks_like_equation(F.col("e")).alias("l"), T.is_noisy(F.col("e")).alias("n"), T.engine_quality(F.col("e"), F.lit("high")).alias("q")).collect()
    assert [r.l for r in rows] == [True, False, False, False] and [r.n for r in rows] == [False, False, False, False] and rows[1].q == 0.0
    assert spark.range(1).select(T.valid_phrase(F.lit("master equation")), T.valid_phrase(F.lit("equation")), T.valid_phrase(F.lit("Fig 3"))).first()[:] == (True, False, False)


def test_symbol_keys():
    cases = {"\\hat{S}^{z}": "S^z", "\\hat{S}^{\\pm}": "S^pm", "\\hat{A}_{p}^{\\dagger}": "A_p^dagger", "R_{3}": "R_3", "\\rho": "rho"}
    assert {a: S.key_of(a) for a in cases} == cases
    assert S.tokenize("\\frac{d\\rho}{dt} = \\sin \\omega + \\hat{H}0") == ["\\rho", "\\omega", "\\hat{H}_{0}"]
    assert S.tokenize("") == []


def test_definitions():
    keys = ["rho", "H", "g_eff"]
    assert S.define("where rho is the density operator and H denotes the Hamiltonian, g_eff is the coupling.", keys) == {"rho": "density operator", "H": "Hamiltonian", "g_eff": "coupling"}
    assert S.define("", keys) == dict.fromkeys(keys, "")


def test_reconcile(spark):
    schema = "document string, ord int, eq_number string, base string, equation string, garbled boolean"
    left = spark.createDataFrame([("a", 1, "1", "1", "\\rho = x + y", False), ("a", 2, "2", "2", "q w e r", True), ("c", 1, "1", "1", "z = 1", False)], schema)
    right = spark.createDataFrame([("a", 1, "1", "1", "\\rho = x + y", False), ("a", 2, "2", "2", "\\alpha = \\beta", False), ("b", 1, "1", "1", "k = 2", False)], schema)
    got = {(r.document, r.ord): r.rule for r in M.match(left, right).collect()}
    assert got == {("a", 1): "label", ("a", 2): "garbled", ("c", 1): "kept"}


def test_violations(spark):
    schema = "rec_id long, arxiv_id string, eq_number string, equation string, relations map<string,struct<grade:string,description:string>>"
    ok, bad = {"2": ("none", "x")}, {"1": ("odd", "x"), "2": ("none", "x"), "9": ("none", "x")}
    df = spark.createDataFrame([(1, "a", "1", "e", ok), (2, "a", "2", " ", bad)], schema)
    assert sorted(tuple(r) for r in P.violations(df).collect()) == [(2, "empty equation"), (2, "relation to an unknown label"), (2, "relation to itself"), (2, "unknown grade")]


def test_nearest_searches_all_rows(spark):
    rng = np.random.default_rng(5)
    vectors = rng.integers(-3, 4, (60, 4)).astype(float)
    vectors[7] = vectors[3]  # a tie
    rows = [(n, v.tolist(), n % 3) for n, v in enumerate(vectors)]
    schema = "b long, w array<float>, grp int"
    unit = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-300)
    want = set()
    for a in range(0, 60, 5):
        if vectors[a].any():
            ranked = sorted((-round(float(unit[a] @ unit[b]), 6), b) for b in range(60) if b != a and vectors[b].any())
            want |= {(a, b, -s) for s, b in ranked[:3]}
    table = spark.createDataFrame([*rows, (90, None, 0), (None, [1.0] * 4, 0), (91, [0.0] * 4, 0), (92, [1.0], 0)], schema).repartition(3)
    asked = table.where("b % 5 = 0").select(F.col("b").alias("a"), F.col("w").alias("v"))
    got = R.nearest(asked, table.select("b", "w"), k=3, block=5).collect()
    assert {(r.a, r.b, abs(r.similarity) if r.similarity == 0 else r.similarity) for r in got} == {(a, b, abs(s) if s == 0 else s) for a, b, s in want}
    assert R.nearest(asked.limit(0), table.select("b", "w")).count() == R.nearest(asked, table.select("b", "w").limit(0)).count() == 0


def test_similar_vectors_cross_labels(spark, tmp_path):
    from quillgraph.plans import catalog

    rows = [(20, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (2, [1.0, 0.1], 2), (3, [1.0, 0.2], 3), (4, [1.0, 0.3], 4)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert sorted((r.a, r.b) for r in catalog.queries()["o54_similar_vectors"](spark, str(tmp_path)).collect()) == [(20, 2), (20, 3), (20, 4)]
