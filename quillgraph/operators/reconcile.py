"""Matching two extractions of one document: equal labels, similar text, then shared core symbols, one to one.

The match is greedy in the order of the first extraction, because a consumed row is gone for the rows after it; it is
therefore a cogrouped Arrow function per document, whose groups are the few formulas of one document.
"""

from __future__ import annotations

import re
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

from quillgraph.functions import text as T
from quillgraph.functions.symbols import key_of, tokenize

SAME_LABEL, ANY, CORE = 0.55, 0.72, 0.82
# Formulas that are compared, and the bounds of the arbitration.
FIRST, USABLE, DIFFERENT, DOUBTFUL = 3, 0.5, 0.28, 0.48
_SCHEMA = "document string, ord int, eq_number string, equation string, equation_text_source string, context_source string, matched_ord int, score double, rule string"


def plain_signature(text: str) -> str:
    """A formula as a string of plain tokens."""
    text = re.sub(r"\\left|\\right", "", text or "")
    text = re.sub(r"\\(?:hat|vec|bar|tilde|mathrm|operatorname|mathcal|mathbb)\s*\{([^{}]+)\}", r"\1", text)
    return " ".join(re.sub(r"[^A-Za-z0-9_+\-=*/^{}().,]+", " ", re.sub(r"\\[A-Za-z]+", " ", text)).split()).lower()


def similarity(left: str, right: str) -> float:
    """Token overlap and sequence likeness of two formulas, between 0 and 1."""
    a, b = plain_signature(left), plain_signature(right)
    if not a or not b:
        return 0.0
    x, y = set(a.split()), set(b.split())
    return 0.55 * len(x & y) / len(x | y) + 0.45 * SequenceMatcher(None, a, b).ratio()


def core_terms(text: str) -> set[str]:
    """Base symbols without the usual indices."""
    keys = (re.sub(r"_[a-z0-9]+$", "", key_of(a)) for a in tokenize(text or ""))
    return {k for k in keys if k} - {"i", "j", "k", "l", "m", "delta", "pi"}


def _profile(text: str) -> set[str]:
    signs = {"bracket": "[", "equals": "=", "sum": "\\sum", "integral": "\\int"}
    return {n for n, s in signs.items() if s in text} | ({"differential"} if "\\frac{d" in text or "\\partial" in text else set())


def core_overlap(left: str, right: str) -> float:
    """How much of the left formula's core the right one has, at most 1."""
    a, b = core_terms(left), core_terms(right)
    if not a or not b:
        return 0.0
    both = len(a & b)
    bonus = 0.05 if _profile(left) & _profile(right) else 0.0
    return min(1.0, 0.75 * both / len(a) + 0.25 * both / len(b) + bonus)


def _best(text: str, candidates: list, score) -> tuple[int, float]:
    scored = [(score(text, c["equation"] or ""), -n) for n, c in candidates]
    top = max(scored, default=(0.0, 0))
    return (-top[1], top[0]) if top[0] > 0 else (-1, 0.0)


def match(left: DataFrame, right: DataFrame) -> DataFrame:
    """Reconcile ``left`` with ``right``, both ``(document, ord, eq_number, base, equation, garbled)``.

    Rules in order: the same base label and a likeness of 0.55; any unused row and 0.72; core symbols at 0.82, which
    takes the context only and does not consume the row; a garbled text takes the first unused row of its label.
    Rows without a match keep their text. Documents missing on the right are kept, those missing on the left are not.
    """
    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        rows, used = [], set()
        others = list(enumerate(b.sort_values("ord").to_dict("records")))
        for x in a.sort_values("ord").to_dict("records"):
            text = x["equation"] or ""
            free = [(n, c) for n, c in others if n not in used]
            labelled = [(n, c) for n, c in free if c["base"] == x["base"]]
            hit, score, rule = -1, 0.0, "kept"
            for name, pool, rate, least in (("label", labelled, similarity, SAME_LABEL), ("similar", free, similarity, ANY), ("core", free, core_overlap, CORE)):
                n, s = _best(text, pool, rate)
                if n >= 0 and s >= least:
                    hit, score, rule = n, s, name
                    break
            if hit < 0 and x["garbled"] and labelled:
                hit, rule = labelled[0][0], "garbled"
            other = dict(others).get(hit)
            if other and rule != "core":
                used.add(hit)
            takes_text = other is not None and rule != "core"
            rows.append((x["document"], x["ord"], x["eq_number"], other["equation"] if takes_text else text, "html" if takes_text else "pdf", "html" if other else "pdf", other["ord"] if other else None, round(score, 6), rule))
        return pd.DataFrame(rows, columns=[c.split()[0] for c in _SCHEMA.split(", ")])

    return left.groupBy("document").cogroup(right.groupBy("document")).applyInPandas(run, _SCHEMA).where("ord is not null")


@pandas_udf(DoubleType())
def likeness(left: pd.Series, right: pd.Series) -> pd.Series:
    """``similarity`` of two columns of formulas; a null is like nothing."""
    return pd.Series([similarity(a, b) for a, b in zip(left, right)], dtype="float64")


def set_similarity(left: DataFrame, right: DataFrame, first: int = FIRST) -> DataFrame:
    """``(document, similarity, pairs)``: mean likeness of the ``first`` formulas of both sets, joined by their place.

    Both are ``(document, place, equation)``, places from 1. A document of one side only has no row; a place of one
    side only is no pair.
    """
    side = lambda df, name: df.where(F.col("place") <= first).select("document", "place", F.col("equation").alias(name))
    both = side(left, "a").join(side(right, "b"), ["document", "place"])
    return both.groupBy("document").agg(F.round(F.avg(likeness("a", "b")), 6).alias("similarity"), F.count("*").alias("pairs"))


def arbitrate(left: DataFrame, right: DataFrame, alike: DataFrame) -> DataFrame:
    """Which of two sets of formulas a document takes: ``(document, left, right, similarity, prefer, reason)``.

    ``left`` and ``right`` are ``(document, quality, garbled)`` with the number of garbled formulas, ``alike`` comes from
    ``set_similarity``. The right set is the default. The left one is taken where it is the only one, or where it is
    good enough (0.5), not both worse and garbled, and the sets tell different formulas: a likeness below 0.48.
    """
    joined = left.select("document", F.col("quality").alias("left"), F.col("garbled").alias("_g")).join(
        right.select("document", F.col("quality").alias("right")), "document", "full_outer").join(alike, "document", "left")
    like = F.coalesce("similarity", F.lit(0.0))
    worse = (F.col("right") > F.col("left")) & (F.col("_g") > 0)
    reason = (
        F.when(F.col("right").isNull(), "only set").when(F.col("left").isNull(), "no left set").when(F.col("left") < USABLE, "left set is poor").when(worse, "left set is garbled")
        .when(like < DIFFERENT, "sets differ").when(like < DOUBTFUL, "sets differ in part").otherwise("sets agree"))
    return joined.select("document", "left", "right", "similarity", F.when(reason.isin("only set", "sets differ", "sets differ in part"), "left").otherwise("right").alias("prefer"), reason.alias("reason"))


def garbled(c):
    """Is the formula's text flattened?"""
    return T.is_garbled(c)
