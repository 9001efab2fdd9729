"""Labels: normal form, bases, natural order, prefixes."""

import pytest
from pyspark.sql import functions as F

from quillgraph.functions import labels as L


@pytest.mark.parametrize("raw, label, base", [(" (1a – d) ", "1a-d", "1"), ("2a-b", "2a-b", "2"), ("2.1a-c", "2.1a-c", "2.1"), ("2.1", "2.1", "2.1"), (None, "", ""), ("A.3", "A.3", "A.3"), ("( 5 )", "5", "5")])
def test_labels(spark, raw, label, base):
    row = spark.createDataFrame([(raw,)], "x string").select(L.normalize_label(F.col("x")), L.base_label(F.col("x"))).first()
    assert tuple(row) == (label, base)


def test_natural_order(spark):
    df = spark.createDataFrame([(x,) for x in ("10", "2.10", "2", "A", "2.9", "2b", "2a", "1")], "x string")
    assert [r.x for r in df.orderBy(L.label_key(F.col("x"))).collect()] == ["1", "2", "2a", "2b", "2.9", "2.10", "10", "A"]


@pytest.mark.parametrize("labels, right", [(["1", "2", "3"], True), (["2.1", "2.2"], True), (["2.1", "3.1"], False), (["1", "3"], False), ([], False), (["1", ""], False)])
def test_prefix(spark, labels, right):
    assert spark.createDataFrame([(labels,)], "x array<string>").select(L.has_prefix(F.col("x"))).first()[0] is right


def test_near(spark):
    df = spark.createDataFrame([("1", "2"), ("2.1", "2.3"), ("2.1", "3.1"), ("1", "2.1"), ("A", "1")], "a string, b string")
    assert [r[0] for r in df.select(L.labels_near(F.col("a"), F.col("b"), 1)).collect()] == [True, False, False, False, False]
