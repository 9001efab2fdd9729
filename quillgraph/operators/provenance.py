"""Provenance trails of records and the checks of the output's shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgraph.functions import text as T

# Methods a trail may name, and grades of a relation.
METHODS = "download_html download_pdf parse_html parse_pdf latex_ocr docling clean_equation_text extract_symbol_identifiers extract_symbol_definitions extract_meaning recover_definitions inherit_definitions reconcile_sources build_relations".split()
GRADES = ["none", "strong", "potential"]


def preview(c: Column, limit: int = 220) -> Column:
    """Bounded one-line text."""
    return T.shorten(c, limit)


def trail(source: Column, label: Column, symbols: Column, meaning: Column) -> Column:
    """The trail of a record as a map from method to lines; methods without a line are left out."""
    found = F.transform(F.coalesce(symbols, F.array().cast("array<string>")), lambda s: F.concat(F.lit("found "), s))
    entries = F.array(
        F.struct(F.when(source == "html", "parse_html").otherwise("parse_pdf").alias("k"), F.array(F.concat(F.lit("label ("), label, F.lit(")"))).alias("v")),
        F.struct(F.lit("extract_symbol_identifiers").alias("k"), found.alias("v")),
        F.struct(F.lit("extract_meaning").alias("k"), F.array(F.when(F.coalesce(meaning, F.lit("")) == "", "no meaning extracted").otherwise(preview(meaning))).alias("v")))
    return F.map_from_entries(F.filter(entries, lambda e: F.size(e["v"]) > 0))


def trail_problems(c: Column, limit: int = 400) -> Column:
    """Problems of a trail: unknown methods, empty entries, lines that are too long."""
    known = F.exists(F.map_keys(c), lambda k: ~k.isin(*METHODS))
    empty = F.exists(F.map_values(c), lambda v: F.size(v) == 0)
    long = F.exists(F.flatten(F.map_values(c)), lambda x: F.length(x) > limit)
    return F.filter(F.array(F.when(known, "unknown method"), F.when(empty, "empty entry"), F.when(long, "long line")), lambda x: x.isNotNull())


def violations(records: DataFrame) -> DataFrame:
    """``(rec_id, problem)``: records whose shape is not that of the output.

    Checked: grades in their enumeration, no relation of a formula to itself, and a relation to exactly the other
    labels of its document. Nulls count as missing. Relations are counted against the labels by a join, so a document
    of a third of all records costs what its relations cost.
    """
    labels = records.select("arxiv_id", F.col("eq_number").alias("_key")).dropna().distinct()
    sizes = labels.groupBy("arxiv_id").agg(F.count("*").alias("_labels"))
    ends = records.select("rec_id", "arxiv_id", "eq_number", F.explode(F.map_keys("relations")).alias("_key"))
    known = ends.join(labels.withColumn("_known", F.lit(1)), ["arxiv_id", "_key"], "left")
    counted = known.groupBy("rec_id").agg(
        F.sum(F.when(F.col("_known").isNotNull() & (F.col("_key") != F.col("eq_number")), 1).otherwise(0)).alias("_to"), F.sum(F.when(F.col("_known").isNull(), 1).otherwise(0)).alias("_strange"))
    joined = records.join(sizes, "arxiv_id").join(counted, "rec_id", "left")
    others = F.col("_labels") - F.when(F.col("eq_number").isNotNull(), 1).otherwise(0)
    problems = F.array(
        F.when(F.coalesce(F.trim("equation"), F.lit("")) == "", "empty equation"),
        F.when(F.exists(F.map_values("relations"), lambda r: ~F.coalesce(r["grade"], F.lit("")).isin(*GRADES)), "unknown grade"),
        F.when(F.array_contains(F.map_keys("relations"), F.col("eq_number")), "relation to itself"),
        F.when(F.coalesce("_to", F.lit(0)) < others, "missing relation"),
        F.when(F.coalesce("_strange", F.lit(0)) > 0, "relation to an unknown label"))
    return joined.select("rec_id", F.explode(F.filter(problems, lambda x: x.isNotNull())).alias("problem"))
