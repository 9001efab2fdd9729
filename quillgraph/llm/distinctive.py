"""How distinctive a term is per record: positive pointwise mutual information with smoothed contexts."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from quillgraph.llm.glyphs import fold_text, sql_form
from quillgraph.session import cut, spread

SMOOTHING = 0.75
_GREEK = re.compile(r"GREEK (SMALL|CAPITAL) LETTER ([A-Z]+)$")
# Signs of symbol keys and their plain names.
_SIGNS = {"±": "pm", "†": "dagger", "′": "prime", "∗": "*"}


def plain_key(key: str) -> str:
    """A symbol key in plain ASCII: look-alikes united, Greek letters spelled out, accents removed."""
    key = fold_text(key)
    if key.isascii():
        return key
    out = []
    for c in unicodedata.normalize("NFD", key):
        named = _GREEK.match(unicodedata.name(c, ""))
        if c.isascii():
            out.append(c)
        elif named:
            out.append(named[2].lower() if named[1] == "SMALL" else named[2].capitalize())
        elif not unicodedata.combining(c):
            out.append(_SIGNS.get(c, f"u{ord(c):x}"))
    return "".join(out)


@pandas_udf(StringType())
def plain(values: pd.Series) -> pd.Series:
    """``plain_key`` per distinct value; null stays null."""
    return values.map({v: plain_key(v) for v in values.dropna().unique()}).where(values.notna(), None)


def score_terms(terms: DataFrame, record: list[str], term: str, count: str | None = None, smoothing: float = SMOOTHING) -> DataFrame:
    """PPMI of every (record, term).

    ``terms`` has one row per occurrence, or per (record, term) with its number in ``count``. Returns the record
    columns, ``term``, ``joint`` (its occurrences in the record), ``records`` (records that hold it) and
    ``score = max(0, log2(p(r,t) / (p(r) p_s(t))))`` with ``p_s(t)`` in proportion to ``n(t)^smoothing``.

    Rows with a null record column, term or count are left out; repeated rows add up; an empty input gives an
    empty result. The marginal of terms is aggregated before it is joined, so a term of a third of all rows is one
    row on that side, and the join's other side is split where a term is hot.
    """
    weight = F.col(count) if count else F.lit(1)
    known = terms.dropna(subset=[*record, term, *([count] if count else [])])
    joint = cut(known.groupBy(*record, term).agg(F.sum(weight).cast("double").alias("joint")).where("joint > 0"))
    per_term = joint.groupBy(term).agg(F.sum("joint").alias("_nt"), F.count("*").alias("records"))
    total = joint.agg(F.sum("joint").alias("_n"))
    smooth = per_term.agg(F.sum(F.pow("_nt", F.lit(smoothing))).alias("_ns"))
    n_r = F.sum("joint").over(Window.partitionBy(*record))
    # the two totals are single rows
    return (
        joint.withColumn("_nr", n_r).join(per_term, term).join(F.broadcast(total)).join(F.broadcast(smooth))
        .withColumn("score", F.greatest(F.lit(0.0), F.log2(
            (F.col("joint") / F.col("_n")) / ((F.col("_nr") / F.col("_n")) * (F.pow("_nt", F.lit(smoothing)) / F.col("_ns"))))))
        .select(*record, term, F.col("joint").cast("long").alias("joint"), "records", "score")
    )


def symbol_scores(dataset: DataFrame) -> DataFrame:
    """Scores of the plain symbol keys of every distinct (arxiv_id, eq_number) of ``dataset``."""
    keys = dataset.select("arxiv_id", "eq_number", F.explode(F.map_keys("symbols")).alias("key"))
    plain_keys = spread(keys).select("arxiv_id", "eq_number", plain("key").alias("symbol")).where("symbol <> ''").distinct()
    return score_terms(plain_keys, ["arxiv_id", "eq_number"], "symbol")


def found(dataset: DataFrame, at_most: int = 5, times: int = 5) -> DataFrame:
    """``p4_found``: the record's most characteristic key where it is far rarer than every other key.

    Keys of a single record are left out first. The record's highest score names the key; the rarity bounds of
    the task are then checked on its record counts.
    """
    scored = symbol_scores(dataset).where("records > 1")
    by_score = Window.partitionBy("arxiv_id", "eq_number").orderBy(F.desc("score"), "records", "symbol")
    ranked = (
        scored.withColumn("_rank", F.row_number().over(by_score))
        .withColumn("_next", F.lead("records").over(by_score))
    )
    return ranked.where((F.col("_rank") == 1) & (F.col("records") <= at_most) & (F.col("_next") >= times * F.col("records"))).select(
        "arxiv_id", "eq_number", "symbol")


def sql_plain(column: str) -> str:
    """``plain_key`` in SQL, but for characters that are neither letters with marks, Greek letters nor known signs."""
    names = {chr(c): m for c in range(0x370, 0x400) if (m := _GREEK.match(unicodedata.name(chr(c), "")))}
    out = sql_form(column)
    for c, name in {**{c: m[2].lower() if m[1] == "SMALL" else m[2].capitalize() for c, m in names.items()}, **_SIGNS}.items():
        out = f"replace({out}, '{c}', '{name}')"
    return f"strip_accents({out})"
