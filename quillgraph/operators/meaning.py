"""Meaning of a formula: candidates by stage, their scores, the choice among them, and the structural role where there are none.

Stages come in tiers. Tier 1 are phrases that a cue in one of the ranked sentences defines, tier 3 the definition of the
symbol on the left side. Stages that need a dependency parse give nothing. All of it is array and window
expressions; only symbols and their definitions come from Arrow functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillgraph.functions import symbols as S
from quillgraph.functions import text as T
from quillgraph.operators import rows as R

_WORD = r"[A-Za-z][A-Za-z0-9'\-\/]*"
_PHRASE = rf"{_WORD}(?:\s+{_WORD}){{0,5}}"
# Patterns of cues, the phrase in their first group.
CUES = [
    ("article noun phrase before definition cue", rf"(?i)\b(?:the|a|an|this|these|those|our)\s+({_PHRASE})\s+(?:is|are|can be|may be|is then|are then)?\s*(?:given by|written as|defined as|expressed as|described by|denoted by|called|known as|takes the form)\b"),
    ("article noun phrase before colon", rf"(?i)\b(?:the|a|an|this|these|those|our)\s+({_PHRASE})\s+(?:is|are)\s*:?\s*$"),
    ("pronoun production cue", rf"(?i)\b(?:this|that|it|which)\s+(?:gives|yields|produces|defines|describes|introduces)\s+(?:the|a|an)?\s*({_PHRASE})\s*:?\s*$"),
    ("first-person definition cue", rf"(?i)\bwe\s+(?:define|introduce|call|denote|write|express)\s+(?:the|a|an)?\s*({_PHRASE})\b"),
    ("the following [equation name] introducer", rf"(?i)(?:the|a|an)\s+following\s+({_WORD}(?:\s+{_WORD}){{0,2}})\b"),
]
# Words that a phrase must hold to go with a role, and roles that a left side's symbol can't name.
ROLE_WORDS = {
    "commutation relation": "commutation commutator relation algebra", "inequality": "inequality bound", "differential equation": "equation dynamics evolution motion",
    "master equation": "master lindblad equation evolution", "recurrence relation": "recurrence recursion update relation",
}
UNNAMED_BY_SYMBOL = ["commutation relation", "differential equation", "inequality", "recurrence relation"]
TIER_CUE, TIER_SYMBOL = 1, 3


def clean_phrase(c: Column) -> Column:
    """A phrase without an article ahead or signs at its ends."""
    plain = F.regexp_replace(F.regexp_replace(T.squash(c), r"(?i)^(?:the|a|an)\s+", ""), r"(?<![\w/-])\d+(?:/\d+)?(?![\w/-])", " ")
    return F.regexp_replace(T.squash(plain), r"^[\s.,;:()]+|[\s.,;:()/-]+$", "")


def cue_candidates(df: DataFrame, keys: list[str], before: str = "text_before", after: str = "text_after") -> DataFrame:
    """``(keys, phrase, stage, tier, distance, evidence)`` of the phrases that cues in the best sentences define.

    Phrases are as long as they can be, so one that runs into the cue's own verb (*the gap is given by*) holds it and is
    no valid phrase later on.
    """
    sentences = R.rank_sentences(df, keys, before, after)
    raw = lambda name, pattern: F.transform(F.regexp_extract_all("sentence", F.lit(pattern), 1), lambda x: F.struct(F.lit(name).alias("cue"), x.alias("raw")))
    each = F.flatten(F.array(*(raw(*cue) for cue in CUES)))
    found = sentences.select(*keys, "distance", F.explode(each).alias("x")).select(*keys, "distance", "x.cue", clean_phrase(F.col("x.raw")).alias("phrase"))
    return found.where("phrase <> ''").select(
        *keys, "phrase", F.lit("definiendum (regex cue)").alias("stage"), F.lit(TIER_CUE).alias("tier"), "distance", F.concat("cue", F.lit(": "), "phrase").alias("evidence"))


def symbol_candidates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Candidates from the definition of the first symbol on a left side, for ``df(keys, equation, symbols, role)``."""
    left = S.symbol_keys(F.trim(F.substring_index(F.coalesce("equation", F.lit("")), "=", 1)))
    first = df.where(~F.coalesce("role", F.lit("")).isin(*UNNAMED_BY_SYMBOL)).select(*keys, "symbols", left.alias("_left"))
    named = first.withColumn("_first", F.get(F.filter("_left", lambda k: F.map_contains_key("symbols", k)), F.lit(0)))
    raw = F.split(F.coalesce(F.try_element_at("symbols", "_first"), F.lit("")), r"\s+(?:or|/)\s+")
    said = named.where("_first is not null").select(*keys, F.col("_first"), clean_phrase(F.get(raw, F.lit(0))).alias("phrase"))
    return said.where((F.col("phrase") != "") & (F.size(F.split("phrase", " ")) <= T.MOST_WORDS)).select(
        *keys, "phrase", F.lit("LHS symbol definition").alias("stage"), F.lit(TIER_SYMBOL).alias("tier"), F.lit(0).alias("distance"), F.concat(F.lit("left side symbol "), "_first").alias("evidence"))


def phrase_score(phrase: Column, distance: Column) -> Column:
    """Nearer, of two to five words, and named is better; at most 1."""
    words = F.size(F.split(phrase, " "))
    score = F.greatest(F.lit(0.0), 1.0 - 0.2 * distance) + F.when(words.between(2, 5), 0.15).otherwise(0.0) + F.when(T.looks_named(phrase), 0.1).otherwise(0.0)
    return F.round(F.least(F.lit(1.0), score), 3)


def goes_with(phrase: Column, role: Column) -> Column:
    """Has the phrase a word of the role? Without a role every phrase goes."""
    out = F.lit(True)
    for name, words in ROLE_WORDS.items():
        out = F.when(role == name, T.any_token(F.lower(phrase), words.split())).otherwise(out)
    return out


def meanings(df: DataFrame, keys: list[str], document: str) -> DataFrame:
    """``(keys, meaning, confidence, stage, evidence, role)`` for every row of ``df(keys, document, equation, text_before, text_after, section)``.

    Of the valid candidates, each phrase once, the lowest tier wins, then the nearest, then the best score. Where a role
    is known, candidates that do not go with it are left out even if none remain, and then the role is the meaning. A
    meaning that four or more formulas of a document share is blanked. Nulls count as empty; keys are taken as unique.
    """
    context = T.context(F.col("section"), F.col("text_before"), F.col("text_after"))
    role = T.equation_role(F.col("equation"), F.col("text_before"), F.col("text_after"), F.col("section"))
    shaped = df.select(*keys, document, "equation", "text_before", "text_after", role.alias("role"), S.definitions(context, S.symbol_keys("equation")).alias("symbols"))
    candidates = cue_candidates(shaped, keys).unionByName(symbol_candidates(shaped, keys)).where(T.valid_phrase(F.col("phrase")))
    candidates = candidates.withColumn("score", phrase_score(F.col("phrase"), F.col("distance"))).join(shaped.select(*keys, "role"), keys).where(goes_with(F.col("phrase"), F.col("role")))
    once = Window.partitionBy(*keys, F.lower("phrase")).orderBy("tier", "distance", "evidence", "phrase")
    best = Window.partitionBy(*keys).orderBy("tier", "distance", F.desc("score"), "evidence", "phrase")
    chosen = candidates.withColumn("_r", F.row_number().over(once)).where("_r = 1").withColumn("_r", F.row_number().over(best)).where("_r = 1")
    chosen = chosen.withColumn("embedding_selected", F.lit(False))  # there is no embedding of sentences here
    joined = shaped.select(*keys, document, "role").join(chosen.select(*keys, "phrase", "stage", "evidence", R.candidate_confidence().alias("sure")), keys, "left")
    own = F.col("phrase").isNotNull()
    named = joined.select(
        *keys, document, "role", F.coalesce("phrase", "role", F.lit("")).alias("meaning"),
        F.when(own, F.col("sure")).when(F.col("role").isNotNull(), "medium").otherwise("low").alias("confidence"),
        F.when(own, F.col("stage")).when(F.col("role").isNotNull(), "role name").otherwise("empty").alias("stage"),
        F.when(own, F.col("evidence")).when(F.col("role").isNotNull(), F.concat(F.lit("structural role: "), "role")).otherwise("").alias("evidence"))
    return R.blank_repeated(named, document, "meaning")
