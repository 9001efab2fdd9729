"""Relational operators over rows of formulas: de-duplication, ranking, gaps, segments, merges, aggregates.

Every operator is a DataFrame transform; windows are partitioned by the document, whose rows are few once the first
``k`` formulas are taken, and every ranking has a full tie-break, so results do not depend on partitioning.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillgraph.functions import labels as L
from quillgraph.functions import text as T
from quillgraph.session import spread

PER_DOCUMENT = 7
SCAN_CAP = 17
#: Asked vectors per broadcast; a larger query set is taken in blocks of this many.
ASKED_BLOCK = 20_000


def first_by_label(df: DataFrame, document: str, label: str, order: list) -> DataFrame:
    """The first row of every (document, normal label); rows without a label are left out."""
    keyed = df.withColumn("_label", L.normalize_label(F.col(label))).where("_label <> ''")
    window = Window.partitionBy(document, "_label").orderBy(*order)
    return keyed.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank", "_label")


def top_k(df: DataFrame, document: str, order: list, k: int = PER_DOCUMENT) -> DataFrame:
    """The first ``k`` rows of every document, with their place."""
    window = Window.partitionBy(document).orderBy(*order)
    return df.withColumn("place", F.row_number().over(window)).where(F.col("place") <= k)


def prefer_main_body(df: DataFrame, document: str, is_appendix: Column, least: int = PER_DOCUMENT) -> DataFrame:
    """Leave out appendix rows of documents that have at least ``least`` other rows."""
    main = F.sum(F.when(is_appendix, 0).otherwise(1)).over(Window.partitionBy(document))
    return df.withColumn("_main", main).where((F.col("_main") < least) | ~is_appendix).drop("_main")


def blank_repeated(df: DataFrame, document: str, value: str, least: int = 4) -> DataFrame:
    """Blank a value that ``least`` or more rows of a document share; empty and null values are left alone."""
    low = F.lower(F.trim(F.col(value)))
    n = F.count("*").over(Window.partitionBy(document, low))
    return df.withColumn(value, F.when((F.coalesce(low, F.lit("")) != "") & (n >= least), "").otherwise(F.col(value)))


def numbering_gaps(df: DataFrame, document: str, label: str) -> DataFrame:
    """``(document, after_number, before_number, missing)`` for gaps between whole-number labels; 0 is before the first."""
    numbers = df.select(document, L.base_label(F.col(label)).try_cast("int").alias("n")).where("n is not null").distinct()
    window = Window.partitionBy(document).orderBy("n")
    pairs = numbers.withColumn("p", F.coalesce(F.lag("n").over(window), F.lit(0)))
    return pairs.where("n - p > 1").select(document, F.col("p").alias("after_number"), F.col("n").alias("before_number"), (F.col("n") - F.col("p") - 1).alias("missing"))


def recover_gaps(gaps: DataFrame, candidates: DataFrame, document: str) -> DataFrame:
    """Unlabelled candidates put into numbering gaps in their order, as many as a gap has room for.

    ``candidates(document, position, after_number, ...)``: ``after_number`` is the last label number before the
    candidate. A leading gap takes the last candidates before the first label, numbered from 1.
    """
    joined = candidates.join(gaps, [document, "after_number"])
    span = Window.partitionBy(document, "after_number")
    ranked = joined.withColumn("_n", F.count("*").over(span)).withColumn("_r", F.row_number().over(span.orderBy("position")))
    skip = F.when(F.col("after_number") == 0, F.greatest(F.col("_n") - F.col("missing"), F.lit(0))).otherwise(0)
    placed = ranked.withColumn("_k", F.col("_r") - skip).where("_k between 1 and missing")
    return placed.withColumn("number", (F.col("after_number") + F.col("_k")).cast("int")).drop("_n", "_r", "_k", "before_number", "missing")


def renumber(df: DataFrame, document: str, label: str, order: list, k: int = PER_DOCUMENT) -> DataFrame:
    """Renumber documents by display order where all labels are whole numbers from 1 with a gap; others are kept."""
    number = L.normalize_label(F.col(label)).try_cast("int")
    every = Window.partitionBy(document)
    checked = df.withColumn("_n", number).withColumn("_whole", F.min(F.when(F.col("_n").isNull(), 0).otherwise(1)).over(every)).withColumn(
        "_low", F.min("_n").over(every)).withColumn("_high", F.max("_n").over(every)).withColumn("_distinct", F.size(F.collect_set("_n").over(every)))
    fix = (F.col("_whole") == 1) & (F.col("_low") == 1) & (F.col("_high") > F.col("_distinct"))
    placed = checked.withColumn("_place", F.row_number().over(every.orderBy(*order))).where(~fix | (F.col("_place") <= k))
    return placed.withColumn("new_label", F.when(fix, F.col("_place").cast("string")).otherwise(F.col(label))).drop("_n", "_whole", "_low", "_high", "_distinct", "_place")


def segments(df: DataFrame, document: str, order: list, starts: Column) -> DataFrame:
    """Number the islands of rows of a document: a row where ``starts`` holds begins a new one."""
    window = Window.partitionBy(document).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("segment", F.sum(F.when(starts, 1).otherwise(0)).over(window))


def starts_expression(c: Column) -> Column:
    """Does a row's math begin an expression of its own, rather than go on with the one above?"""
    return ~T.squash(c).rlike(r"^(?:=|\+|-|\\pm|\\mp|\\left|\\right|\\begin|\\\\)")


def neighbours(df: DataFrame, document: str, order: list, text: str, rows: int = 5, budget: int = 2000) -> DataFrame:
    """``above`` and ``below``: the text of up to ``rows`` neighbouring rows on each side, cut to a budget of characters."""
    window = Window.partitionBy(document).orderBy(*order)
    joined = lambda a, b: F.array_join(F.filter(F.collect_list(F.coalesce(F.col(text), F.lit(""))).over(window.rowsBetween(a, b)), lambda x: x != ""), " ")
    return df.withColumn("above", F.right(joined(-rows, -1), F.lit(budget))).withColumn("below", F.left(joined(1, rows), F.lit(budget)))


def join_pieces(df: DataFrame, keys: list[str], order: str, piece: str) -> DataFrame:
    """Pieces of math in order, joined to one formula: no comment signs or display style, no blank around ``=``."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.coalesce(F.col(piece), F.lit("")).alias("p"))))
    text = F.array_join(F.transform(ordered, lambda x: x["p"]), " ")
    text = T.squash(F.regexp_replace(F.replace(text, F.lit("%"), F.lit(" ")), r"\\displaystyle(?![A-Za-z])", " "))
    return df.groupBy(*keys).agg(F.regexp_replace(text, r" ?= ?", "=").alias("formula"))


def best_candidate(df: DataFrame, document: str, label: str, text: str, confidence: str, priority: str, order: list) -> DataFrame:
    """Per label the engines' best row: highest quality, then engine priority, then order."""
    scored = df.withColumn("quality", F.round(T.engine_quality(F.col(text), F.col(confidence)), 4)).withColumn("_label", L.normalize_label(F.col(label))).where("_label <> ''")
    window = Window.partitionBy(document, "_label").orderBy(F.desc("quality"), priority, *order)
    return scored.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank", "_label")


def override_text(df: DataFrame, other: DataFrame, document: str, label: str, text: str, contexts: list[str]) -> DataFrame:
    """Left join by normal label: the other source's text wins where present, its contexts only fill empty ones.

    ``other`` has one row per (document, label) and the same column names.
    """
    right = other.select(F.col(document), L.normalize_label(F.col(label)).alias("_label"), *(F.col(c).alias(f"_{c}") for c in [text, *contexts]))
    joined = df.withColumn("_label", L.normalize_label(F.col(label))).join(right, [document, "_label"], "left")
    filled = lambda c: F.when(F.coalesce(F.col(c), F.lit("")) == "", F.col(f"_{c}")).otherwise(F.col(c))
    out = joined.withColumn(text, F.coalesce(F.nullif(F.col(f"_{text}"), F.lit("")), F.col(text)))
    for c in contexts:
        out = out.withColumn(c, filled(c))
    return out.drop("_label", *(f"_{c}" for c in [text, *contexts]))


def missing_edges(nodes: DataFrame, edges: DataFrame, document: str, label: str, source: str, target: str) -> DataFrame:
    """Ordered pairs of a document's labels that have no edge: an anti join."""
    a = nodes.select(document, F.col(label).alias(source)).distinct()
    b = nodes.select(document, F.col(label).alias(target)).distinct()
    pairs = a.join(b, document).where(F.col(source) != F.col(target))
    return pairs.join(edges.select(document, source, target).distinct(), [document, source, target], "left_anti")


def missing_counts(nodes: DataFrame, edges: DataFrame, document: str, label: str, source: str, target: str) -> DataFrame:
    """``(document, label, missing_out, missing_in)``: how many pairs of ``missing_edges`` begin and end at each label.

    Counted from the edges that are there, so documents of any number of labels are counted whole without their pairs.
    """
    labels = nodes.select(document, label).dropna().distinct()
    known = edges.select(document, source, target).where(F.col(source) != F.col(target)).distinct()
    for end in (source, target):
        known = known.join(labels.withColumnRenamed(label, end), [document, end], "left_semi")
    ends = known.select(document, F.explode(F.array(
        F.struct(F.col(source).alias(label), F.lit(1).alias("o"), F.lit(0).alias("i")), F.struct(F.col(target).alias(label), F.lit(0).alias("o"), F.lit(1).alias("i")))).alias("x"))
    present = ends.select(document, f"x.{label}", "x.o", "x.i").groupBy(document, label).agg(F.sum("o").alias("o"), F.sum("i").alias("i"))
    sized = labels.join(labels.groupBy(document).agg(F.count("*").alias("_n")), document).join(present, [document, label], "left")
    missing = lambda c: F.col("_n") - 1 - F.coalesce(F.col(c), F.lit(0))
    return sized.select(document, label, missing("o").alias("missing_out"), missing("i").alias("missing_in"))


def unordered_pairs(df: DataFrame, document: str, order: str) -> DataFrame:
    """Every pair of a document's rows once, the earlier as ``l``, the later as ``r``. Take the first ``k`` rows before."""
    left = df.select(document, F.col(order).alias("_lo"), F.struct(*df.columns).alias("l"))
    right = df.select(document, F.col(order).alias("_ro"), F.struct(*df.columns).alias("r"))
    return left.join(right, document).where("_lo < _ro").select(document, "l", "r")


def document_status(df: DataFrame, document: str, label: str, text: str, order: list) -> DataFrame:
    """Per document: number of formulas, labels in order, expected labels, consecutive or not, findings."""
    ordered = F.array_sort(F.collect_list(F.struct(*[F.col(o).alias(f"o{k}") for k, o in enumerate(order)], L.normalize_label(F.col(label)).alias("label"), L.base_label(F.col(label)).alias("base"))))
    noisy = F.sum(F.when(T.is_noisy(F.col(text)), 1).otherwise(0))
    empty = F.sum(F.when(F.coalesce(F.trim(F.col(text)), F.lit("")) == "", 1).otherwise(0))
    grouped = df.groupBy(document).agg(ordered.alias("_o"), noisy.alias("noisy"), empty.alias("empty"), F.count("*").cast("int").alias("equation_count"))
    base = F.transform("_o", lambda x: x["base"])
    shaped = grouped.select(document, "equation_count", F.transform("_o", lambda x: x["label"]).alias("labels"), base.alias("base"), "noisy", "empty")
    shaped = shaped.withColumn("consecutive", L.has_prefix(F.col("base"))).withColumn("expected", L.expected_prefix(F.size("base"), F.coalesce(F.get("base", F.lit(0)), F.lit(""))))
    found = F.filter(F.array(
        F.when(~F.col("consecutive"), "numbering gap"), F.when(F.col("empty") > 0, "empty equation"), F.when(F.col("noisy") > 0, "noisy equation")), lambda x: x.isNotNull())
    return shaped.withColumn("findings", found).drop("base", "noisy", "empty")


def inherit_definitions(symbols: DataFrame, document: str, order: list) -> DataFrame:
    """Fill empty definitions from the document's first definition of the same symbol, else of its safe base.

    ``symbols(document, ..., symbol, definition)``. A base ``X`` lends its definition to ``X_abc`` only where the
    definition's last word names a type of thing. Automatic labels and relational phrases are not inherited.
    """
    known = F.coalesce(F.trim("definition"), F.lit(""))
    lends = (known != "") & ~known.isin("summation index", "differential variable", "Lorentz index", "time", "imaginary unit", "Pauli matrix", "Dirac gamma matrix", "probability distribution")
    first = symbols.where(lends & ~known.rlike(r"(?i)\b(?:of|between|in|with) (?:eq|the (?:above|previous))\b")).groupBy(document, "symbol").agg(
        F.min_by(known, F.struct(*order)).alias("own"))
    base = F.regexp_extract("symbol", r"^(.+)_[A-Za-z0-9]{1,4}$", 1)
    heads = first.where(F.lower("own").rlike(r"(?:operator|matrix|state|function|hamiltonian|tensor|vector|field|parameter|density|energy|frequency|part)s?$")).select(
        document, F.col("symbol").alias("_base"), F.col("own").alias("base_own"))
    out = symbols.join(first, [document, "symbol"], "left").withColumn("_base", base).join(heads, [document, "_base"], "left")
    return out.withColumn("inherited", F.when(known != "", "own").when(F.col("own").isNotNull(), "exact").when(F.col("base_own").isNotNull(), "base").otherwise("none")).withColumn(
        "definition", F.coalesce(F.nullif(known, F.lit("")), F.col("own"), F.col("base_own"), F.lit(""))).drop("own", "base_own", "_base")


def select_candidate(candidates: DataFrame, document: str, label: str) -> DataFrame:
    """A formula's meaning among its candidates: lowest tier, a local cue first, then nearest, then best scored."""
    valid = candidates.where(T.valid_phrase(F.col("phrase")))
    once = Window.partitionBy(document, label, F.lower("phrase")).orderBy("tier", "distance", "cand_id")
    distinct = valid.withColumn("_r", F.row_number().over(once)).where("_r = 1")
    local = F.when(F.col("stage") == "local cue", 0).otherwise(1)
    picked = F.when(F.col("embedding_selected"), 0).otherwise(1)
    best = Window.partitionBy(document, label).orderBy("tier", local, picked, "distance", F.desc_nulls_last("score"), "cand_id")
    return distinct.withColumn("_r", F.row_number().over(best)).where("_r = 1").drop("_r")


def candidate_confidence() -> Column:
    """high, medium or low, from tier, distance and score."""
    base = F.coalesce(F.col("score"), F.lit(0.0)) + F.when(F.col("embedding_selected"), 0.05).otherwise(0.0)
    return F.when((F.col("tier") == 1) & (F.col("distance") == 0), "high").when((F.col("tier") <= 3) & (base >= 0.6), "high").when(base >= 0.45, "medium").otherwise("low")


def rerank_by_embedding(candidates: DataFrame, document: str, label: str, least: float = 0.35, margin: float = 0.03) -> DataFrame:
    """Within the lowest tier, the candidate whose embedding score is high enough and clear of the next one's."""
    tier = F.min("tier").over(Window.partitionBy(document, label))
    window = Window.partitionBy(document, label).orderBy(F.desc("embedding_score"), "cand_id")
    scored = candidates.withColumn("_t", tier).where("tier = _t and embedding_score is not null")
    ranked = scored.withColumn("_r", F.row_number().over(window)).withColumn("_next", F.lead("embedding_score").over(window))
    clear = (F.col("embedding_score") >= least) & (F.col("_next").isNull() | (F.round(F.col("embedding_score") - F.col("_next"), 6) >= margin))
    return ranked.where((F.col("_r") == 1) & clear).drop("_t", "_r", "_next")


def cosine_rank(left: DataFrame, right: DataFrame, k: int = 1) -> DataFrame:
    """``(a, b, similarity)``: for every row of ``left(a, v, grp)`` the ``k`` most similar rows of ``right`` in its group.

    For reranking the few candidates of a formula; ``nearest`` searches a whole table.
    """
    dot = F.aggregate(F.zip_with("v", "w", lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda acc, x: acc + x)
    norm = lambda c: F.sqrt(F.aggregate(c, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))
    joined = left.join(right, "grp").where("a <> b").withColumn("similarity", F.round(dot / (norm("v") * norm("w")), 6))
    return joined.withColumn("_r", F.row_number().over(Window.partitionBy("a").orderBy(F.desc("similarity"), "b"))).where(F.col("_r") <= k).select("a", "b", "similarity")


def nearest(asked: DataFrame, rows: DataFrame, k: int = 1, block: int = ASKED_BLOCK) -> DataFrame:
    """``(a, b, similarity)``: for every row of ``asked(a, v)`` the ``k`` most similar rows of all ``rows(b, w)``.

    Exact cosine, rounded to six places; ties go to the smaller ``b``; a row is no neighbour of its own id. Asked
    vectors are broadcast in blocks, rows are only scanned, and a task keeps ``k`` rows for an asked vector. Null ids,
    and vectors that are null, empty, zero or hold null, have no neighbours and are none; vectors of different length
    are not compared.
    """
    spark = rows.sparkSession

    def units(ids, vectors) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """Ids and unit vectors by length of the vectors, in order of the ids."""
        kept: dict[int, list] = {}
        for i, x in zip(ids, vectors):
            x = np.asarray(x, np.float64)
            norm = np.sqrt(x @ x)
            if 0 < norm < np.inf:
                kept.setdefault(len(x), []).append((i, x / norm))
        return {n: (np.array([i for i, _ in group], np.int64), np.array([x for _, x in group])) for n, group in ((n, sorted(g, key=lambda t: t[0])) for n, g in kept.items())}

    scanned = spread(rows.select(F.col("b").cast("long"), F.col("w").cast("array<double>")).where("b is not null and w is not null"))
    blocks, current = [], []
    for row in asked.select(F.col("a").cast("long"), F.col("v").cast("array<double>")).where("a is not null and v is not null").toLocalIterator():
        current.append((row["a"], row["v"]))
        if len(current) == block:
            blocks.append(spark.sparkContext.broadcast(current))
            current = []
    blocks.append(spark.sparkContext.broadcast(current))
    out = None
    for held in blocks:

        def scan(batches: Iterator[pd.DataFrame], held=held) -> Iterator[pd.DataFrame]:
            wanted = units(*zip(*held.value)) if held.value else {}
            best = {n: (np.full((k, len(a)), -np.inf), np.zeros((k, len(a)), np.int64)) for n, (a, _) in wanted.items()}
            for batch in batches:
                for n, (ids, vectors) in units(batch["b"], batch["w"]).items():
                    if n not in wanted:
                        continue
                    a, v = wanted[n]
                    for at in range(0, len(a), 2000):  # bounds the matrix of similarities
                        part = slice(at, at + 2000)
                        likeness = np.round(vectors @ v[part].T, 6)
                        likeness[ids[:, None] == a[None, part]] = -np.inf
                        high, who = [best[n][0][:, part]], [best[n][1][:, part]]
                        for _ in range(min(k, len(ids))):  # ids are in order, so the first maximum has the smallest
                            first = likeness.argmax(axis=0)
                            column = np.arange(len(first))
                            high.append(likeness[first, column][None])
                            who.append(ids[first][None])
                            likeness[first, column] = -np.inf
                        high, who = np.concatenate(high), np.concatenate(who)
                        order = np.lexsort((who, -high), axis=0)[:k]
                        best[n][0][:, part], best[n][1][:, part] = np.take_along_axis(high, order, 0), np.take_along_axis(who, order, 0)
            for n, (a, _) in wanted.items():
                high, who = best[n]
                found = high > -np.inf
                yield pd.DataFrame({"a": np.broadcast_to(a, high.shape)[found], "b": who[found], "similarity": high[found]})

        part = scanned.mapInPandas(scan, "a long, b long, similarity double")
        out = part if out is None else out.unionByName(part)
    return out.withColumn("_r", F.row_number().over(Window.partitionBy("a").orderBy(F.desc("similarity"), "b"))).where(F.col("_r") <= k).drop("_r")


def rank_sentences(df: DataFrame, keys: list[str], before: str, after: str, limit: int = 5) -> DataFrame:
    """The ``limit`` sentences around a formula that most likely name it: rank, then nearness, then the side before."""
    side = lambda c, name, nearest_last: F.transform(
        F.reverse(T.sentences(F.col(c))) if nearest_last else T.sentences(F.col(c)), lambda s, n: F.struct(F.lit(name).alias("side"), n.alias("distance"), s.alias("sentence")))
    rows = df.select(*keys, F.explode(F.concat(F.slice(side(before, "before", True), 1, 5), F.slice(side(after, "after", False), 1, 5))).alias("x")).select(*keys, "x.*")
    s = F.col("sentence")
    cue = r"(?i)\b(?:defined as|given by|written as|expressed as|called|known as|denoted by|we define|we introduce|takes the form|is described by|are described by|reads?|can be written|can be expressed)\b|\bwhere\b.{0,90}\bdenotes?\b|:\s*$"
    rank = (
        F.greatest(F.lit(0.0), 1.0 - 0.25 * F.col("distance")) + F.when(s.rlike(cue), 1.0).otherwise(0.0) + F.when(s.rlike(r":\s*$"), 0.45).otherwise(0.0)
        + F.when(s.rlike(r"(?i)\b(?:equation|relation|function|operator|matrix|state|rule)\b"), 0.15).otherwise(0.0) + F.when(F.col("side") == "before", 0.1).otherwise(0.0)
        - F.when(s.rlike(r"(?i)\b(?:figure|fig\.|table|tab\.|appendix|app\.|copyright|license|email|affiliation|doi|arxiv|section|sect\.)\b"), 0.8).otherwise(0.0)
        - F.when(s.rlike(r"(?i)\b(?:eqs?|refs?|sections?)\.?\s*\(?\d"), 0.25).otherwise(0.0))
    boiler = s.rlike(r"(?i)\b(?:patents?|copyright|licen[sc]e|all rights reserved|arxiv:|doi:|e-?mail|affiliation)\b") | (F.regexp_count(s, F.lit(r"\b[A-Z]{3,}\b")) >= 4)
    window = Window.partitionBy(*keys).orderBy(F.desc("rank"), "distance", F.when(F.col("side") == "before", 0).otherwise(1))
    return rows.where(~boiler).withColumn("rank", F.round(rank, 3)).withColumn("place", F.row_number().over(window)).where(F.col("place") <= limit)


def set_quality(df: DataFrame, document: str, place: str, k: int = PER_DOCUMENT) -> DataFrame:
    """Mean text quality of a document's first ``k`` formulas."""
    score = T.text_quality(F.col("equation"), F.col("equation_format"), F.col("equation_confidence"))
    return df.where(F.col(place) <= k).groupBy(document).agg(F.round(F.avg(score), 6).alias("quality"), F.count("*").alias("n"))
