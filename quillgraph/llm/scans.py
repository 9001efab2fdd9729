"""Noise in text from scanned pages: broken words, misread characters, running headers and page numbers.

Misread characters. Words are grouped by a skeleton in which glyphs that scanners confuse are drawn with the same
strokes; in every group the form that is far more frequent is the candidate for the rare ones, and it is chosen where
its neighbours support it better than the form that stands there. In formulas, where names have no fixed neighbours,
the frequency alone decides. In scripts without spaces the same is done for characters between their neighbours.

Running headers. Lines are masked (digits, then all words but function words). A line whose removal joins two words
that belong together, or two halves of a word, is a header by its context; masks of which most lines are headers
are headers wherever they stand. A line of words without a sign of a formula, inside a formula, is no part of it. Page
numbers have their own patterns.

Broken words are joined unless the hyphenated form is a word of the collection. Neighbouring lines are seen, and lines
are run together again, by windows over the lines of a field. Words are read once, with their places; all counting
is group-bys and joins over all rows, and nothing is collected.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from quillgraph.llm.glyphs import fold_text
from quillgraph.session import cut, spread

RATIO = 10
SUPPORT = 3

# Strokes of confusable glyphs.
_STROKES = {
    "m": "iii", "w": "vv", "d": "ci", "n": "ii", "u": "ii", "h": "ii", "b": "ii", "6": "ii", "r": "i", "l": "i", "t": "i", "f": "i", "1": "i", "!": "i", "|": "i",
    "j": "i", "†": "i", "e": "c", "o": "o", "0": "o", "5": "s", "@": "a", "9": "g", "y": "v", "q": "g", "8": "s", "3": "з", "2": "z", "$": "s",
    "л": "д", "и": "н", "п": "н", "й": "н", "т": "г", "щ": "ш", "ц": "ш", "ь": "ъ", "ы": "ъ", "о": "o", "с": "c", "е": "c", "ё": "c", "в": "в",
}
_LIGATURES = {"ﬁ": "fi", "ﬂ": "fl", "é": "c", "è": "c", "ê": "c", "í": "i", "ì": "i", "ï": "i", "ü": "ii", "ú": "ii", "ö": "o", "ó": "o", "ô": "o", "ä": "a", "á": "a", "à": "a", "ñ": "ii", "ç": "c"}
# Function words that masks keep.
_KEPT = ("the a an of on and or to from for in with by at is are was be as we it not this that versus vs et al page p received preprint draft vol sect section chapter "
         "de la le les du des der die das und von zu el los las del y en").split()

_SYMBOLS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi pi rho sigma tau upsilon phi chi psi omega dagger".split()

_PAGE = (
    r"^\s*(?:[-–—·\[(|]\s*\d{1,4}\s*[-–—·\])|]|\d{1,4}|[ivxlc]{2,7}|[-–—·\[(]\s*[ivxlc]{1,7}\s*[-–—·\])]|(?:[Pp]age|[Ss]eite|p\.|S\.|[Pp]ág\.|стр\.)\s*\d{1,4}(?:\s*(?:of|von|de|/|из)\s*\d{1,4})?"
    r"|\d{1,4}\s*/\s*\d{1,4}|\d{1,4}\s*\|\s*P ?a ?g ?e|\d{1,4}\s{2,}\S.{0,60}|\S.{0,80}\s{2,}\d{1,4})\s*$")


#: Rows up to which a side of a join is broadcast; a larger side is shuffled.
_SMALL = 500_000


def _small(df: DataFrame) -> DataFrame:
    """``df`` materialised, and broadcast if it is counted to be small."""
    done = cut(df)
    return F.broadcast(done) if done.count() <= _SMALL else done


def skeleton(word: Column) -> Column:
    """Strokes of a word: equal for words that differ in confusable glyphs only."""
    out = F.lower(word)
    for glyph, strokes in {**_LIGATURES, **_STROKES}.items():
        if glyph != strokes:
            out = F.replace(out, F.lit(glyph), F.lit(strokes))
    return out


def _texts(equations: DataFrame) -> DataFrame:
    """Fields in long form: (field, id, text)."""
    return equations.select(F.col("row_id").alias("id"), F.explode(F.create_map(
        F.lit("text_before"), F.col("text_before"), F.lit("text_after"), F.col("text_after"), F.lit("equation"), F.col("equation"))).alias("field", "text")
    ).where("text is not null and text <> ''")


def _folded(text: str) -> tuple[str, list[int]]:
    """A formula with look-alike characters united, and where each of its characters comes from."""
    out, places = [], []
    for n, c in enumerate(text):
        for f in c if c in " \n" else fold_text(f"x{c}x")[1:-1]:
            out.append(f)
            places.append(n)
    return "".join(out), [*places, len(text)]


def _patterns():
    import regex

    return regex.compile(
        r"(?P<skip>\$[^$\n]*\$|\S*(?:://|@\w+\.)\S*|[\p{L}\p{N}]*[_^\\{}<>=/&#][\p{L}\p{N}{}_^\\=/&;#]+)"
        r"|(?P<word>[\p{N}!@†'’-]*\p{L}(?:[\p{L}\p{N}!@†'’]|-(?![ \t]*\n)|[-¬­‐][ \t]*\n(?=\p{L}))*)|(?P<sign>[.,;:?])"
    ), regex.compile(r"(?<![\p{L}\x80-\xbf])\\?[A-Za-z0-9!|]*[A-Za-z][A-Za-z0-9!|]*(?![\p{L}\x80-\xbf])"), regex.compile(r"[-¬­‐][ \t]*\n")


def read_words(texts: DataFrame) -> DataFrame:
    """``(field, id, kind, w array<struct<word, first, end>>)``: the words and signs of every field with their places.

    In text, formulas, addresses and identifiers count as one sign, and a word broken over a line end is one word. In
    formulas every name and command is a word. Positions count characters of the field as it stands.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        prose, names, broken = _patterns()
        for batch in batches:
            out = []
            for field, text in zip(batch["field"], batch["text"]):
                if field == "equation":
                    plain, places = (text, range(len(text) + 1)) if text.isascii() else _folded(text)
                    out.append([(m.group(), places[m.start()], places[m.end() - 1] + 1) for m in names.finditer(plain)])
                else:
                    out.append([("§" if m.lastgroup == "skip" else broken.sub("", m.group()), *m.span()) for m in prose.finditer(text)])
            yield pd.DataFrame({"field": batch["field"], "id": batch["id"], "kind": ["equation" if f == "equation" else "text" for f in batch["field"]],
                                "w": [[{"word": w, "first": a, "end": b} for w, a, b in x] for x in out]})

    return texts.select("field", "id", "text").mapInPandas(run, "field string, id long, kind string, w array<struct<word:string,first:int,end:int>>").where(F.size("w") > 0)


def _triples(read: DataFrame) -> DataFrame:
    """(field, id, kind, first, end, word, own, before, after) of every word; all but ``word`` in the case that counts."""
    own = F.transform("w", lambda x: F.lower(x["word"]))
    each = F.transform("w", lambda x, k: F.struct(
        x["first"].alias("first"), x["end"].alias("end"), x["word"].alias("word"),
        F.when(k > 0, F.get("_l", k - 1)).otherwise("").alias("before"), F.coalesce(F.get("_l", k + 1), F.lit("")).alias("after")))
    rows = read.withColumn("_l", own).select("field", "id", "kind", F.explode(each).alias("t")).select("field", "id", "kind", "t.*")
    return rows.withColumn("own", F.when(F.col("kind") == "equation", F.col("word")).otherwise(F.lower("word")))


def misread(read: DataFrame, ratio: int = RATIO, support: int = SUPPORT) -> DataFrame:
    """``(field, id, first, end, word, chosen)``: words of ``read_words`` that scanners misread, with the form chosen instead.

    Every form of a skeleton group that is ``ratio`` times more frequent than a rare one is tried for it; a form with a
    digit or sign among its letters has to be half as rare, in formulas, where such forms are no words, a quarter. A word
    whose neighbours are no words has only its frequency to go by, and then must be a form of that kind, mostly letters.
    """
    triples = _triples(read)
    counts = triples.where((F.length("word") >= 2) & F.col("word").rlike(r"\p{L}")).groupBy("kind", F.col("own").alias("w")).count()
    words = cut(counts.withColumn("skeleton", skeleton(F.col("w"))).withColumn("mixed", F.col("w").rlike(r"\p{L}[0-9!@†|]|[0-9!@†|]\p{L}")))
    mains = words.where(~F.col("mixed") & (F.col("count") >= 5)).select("kind", "skeleton", F.col("w").alias("main"), F.col("count").alias("n"))
    need = F.when(~F.col("mixed"), ratio).when(F.col("kind") == "equation", ratio / 4).otherwise(ratio / 2)
    pairs = words.join(mains, ["kind", "skeleton"]).where(
        (F.col("w") != F.col("main")) & (F.col("n") >= need * F.col("count")) & (F.lower("w") != F.lower("main")) & ~F.col("w").isin(*_SYMBOLS) & ~F.col("w").rlike(r"^d[A-Za-z]$"))
    # in a formula a short form without digits or signs may be a rare name of its own
    pairs = pairs.where((F.col("kind") == "text") | F.col("mixed") | (F.length("w") > 2) | (F.col("n") >= 3 * ratio * F.col("count")))
    top = Window.partitionBy("kind", "w").orderBy(F.desc("n"), "main")
    pairs = pairs.withColumn("_best", F.row_number().over(top) == 1).select("kind", F.col("w").alias("own"), "main", "mixed", "_best")
    doubtful = triples.join(_small(pairs), ["kind", "own"])
    at = ["field", "id", "first", "end", "word"]
    worded = F.length(F.regexp_replace("word", r"\P{L}", "")) * 2 > F.length("word")
    alone = ~F.col("before").rlike(r"\p{L}") & ~F.col("after").rlike(r"\p{L}") & worded
    doubtful = cut(doubtful)
    sure = doubtful.where("_best").where((F.col("kind") == "equation") | alone & F.col("mixed")).select(*at, F.col("main").alias("chosen"))
    asked = doubtful.where((F.col("kind") == "text") & ~(alone & F.col("mixed")))
    pair = lambda mine, a, b: F.struct(F.lit(mine).alias("mine"), F.col(a).alias("a"), F.col(b).alias("b"))
    keys = asked.select(*at, "main", F.explode(F.array(
        pair(False, "before", "main"), pair(False, "main", "after"), pair(True, "before", "own"), pair(True, "own", "after"))).alias("k")
    ).select(*at, "main", "k.*").where(F.col("a").rlike(r"\p{L}") & F.col("b").rlike(r"\p{L}"))  # signs are no context
    bigrams = triples.where("kind = 'text' and after <> ''").groupBy(F.col("own").alias("a"), F.col("after").alias("b")).count()
    counted = keys.join(bigrams.join(_small(keys.select("a", "b").distinct()), ["a", "b"]), ["a", "b"]).groupBy(*at, "main").agg(
        F.sum(F.when(F.col("mine"), 0).otherwise(F.col("count"))).alias("for_main"), F.sum(F.when(F.col("mine"), F.col("count")).otherwise(0)).alias("for_own"))
    supported = counted.where((F.col("for_main") >= support) & (F.col("for_main") >= 5 * (F.col("for_own") - 2)))
    chosen = supported.groupBy(*at).agg(F.max_by("main", F.struct("for_main", "main")).alias("chosen"))
    return sure.unionByName(chosen)


def misread_characters(texts: DataFrame, ratio: int = 8, contexts: int = 2) -> DataFrame:
    """``(field, id, at, word, chosen)`` for scripts without spaces: characters unlike what their neighbours call for.

    The neighbours are the two characters before and after. A pair of characters counts as confusable only if it shows
    in several neighbourhoods. It is learned from characters with two neighbours on both sides and applied to all.
    """
    letters = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}"
    flat = F.regexp_replace(F.regexp_replace("text", r"\$[^$\n]*\$", "§"), r"\s+", "")
    runs = texts.where(F.col("field") != "equation").where(F.col("text").rlike(f"[{letters}]")).select("field", "id", flat.alias("t"))
    # two blanks on either side, so that the first and last characters of a field have windows too
    windows = runs.where("t <> ''").select("field", "id", F.concat(F.lit("  "), "t", F.lit("  ")).alias("p"), F.explode(F.sequence(F.lit(1), F.length("t"))).alias("k")).select(
        "field", "id", (F.col("k") - 2).alias("at"), F.expr("substring(p, k, 5)").alias("s"))
    split = windows.select("field", "id", "at", F.concat(F.substring("s", 1, 2), F.lit("?"), F.substring("s", 4, 2)).alias("around"), F.substring("s", 3, 1).alias("c")).where(
        F.col("c").rlike(r"\p{IsHan}") & F.col("around").rlike(f"[{letters}].?\\?|\\?.?[{letters}]"))
    counts = split.where(~F.col("around").contains(" ")).groupBy("around", "c").count()  # learned from full windows only
    mains = counts.groupBy("around").agg(F.max_by("c", F.struct("count", "c")).alias("main"), F.max("count").alias("n")).where(F.col("n") >= 5)
    odd = counts.join(mains, "around").where((F.col("c") != F.col("main")) & (F.col("n") >= ratio * F.col("count"))).select("around", "c", "main", "count")
    # a confusable pair is learned where the character stands mostly for the other; all its uses are then misread
    common = counts.groupBy("c").agg(F.sum("count").alias("all"))
    learned = odd.groupBy("c", "main").agg(F.count("*").alias("places"), F.sum("count").alias("odd_count")).where(F.col("places") >= contexts)
    learned = learned.join(common, "c").where((F.col("odd_count") >= 0.3 * F.col("all")) & F.col("main").rlike(r"\p{IsHan}"))
    learned = learned.join(common.select(F.col("c").alias("main"), F.col("all").alias("main_all")), "main").where(F.col("main_all") >= 5 * F.col("all"))
    best = learned.groupBy("c").agg(F.max_by("main", F.struct("odd_count", "main")).alias("main"))
    return split.join(best, "c").select("field", "id", "at", F.col("c").alias("word"), F.col("main").alias("chosen"))


def mask(line: Column) -> Column:
    """A line with digits and all words but function words masked; a cut-off end is masked as such."""
    words = F.split(F.regexp_replace(F.regexp_replace(F.lower(F.trim(line)), r"\s{2,}\d{1,4}$", ""), r"(\W)", " $1 "), r"\s+")
    masked = F.transform(F.filter(words, lambda w: w != ""), lambda w: F.when(w.isin(*_KEPT) | w.rlike(r"^[^\p{L}\p{N}]+$"), w).when(w.rlike(r"^\d+$"), F.lit("0")).otherwise(F.lit("w")))
    return F.regexp_replace(F.array_join(masked, " "), r"\bw(?: - w| w)*\b", "w")


def _neighbours(lines: DataFrame) -> DataFrame:
    """Lines with the two above and below, by a window over the lines of a field."""
    order = Window.partitionBy("field", "id").orderBy("line")
    beside = lambda k: F.coalesce(F.lag("text", k).over(order) if k > 0 else F.lead("text", -k).over(order), F.lit(""))
    return lines.withColumn("above", beside(1)).withColumn("above2", beside(2)).withColumn("below", beside(-1)).withColumn("below2", beside(-2))


def headers(texts: DataFrame, least: int = 4) -> DataFrame:
    """``(field, id, line)``: lines that are running headers or page numbers."""
    code = r"```|~~~|\\begin\{|<(?:source|pre|code|syntaxhighlight|li|p)\b"
    broken = texts.where(F.col("text").contains("\n") & ~F.col("text").rlike(code)).select("field", "id", F.posexplode(F.split("text", "\n")).alias("line", "text"))
    first = lambda c: F.lower(F.regexp_extract(c, r"^\s*([\p{L}\p{N}'’-]+|\$|\S)", 1))
    last = lambda c: F.lower(F.regexp_extract(c, r"([\p{L}\p{N}'’]+|\$|\S)[-¬­‐]?\s*$", 1))
    lines = _neighbours(broken).where(F.trim("text") != "")
    page = F.col("text").rlike(_PAGE) & (F.length("text") <= 100) & ~((F.col("line") == 0) & (F.col("field") == "equation"))
    # a list item or heading of markup is none
    lines = lines.withColumn("page", page & ~F.col("text").rlike(r"[=+<>\\{}]|^\s*(?:[-*#]\s+\p{L})")).withColumn("mask", mask(F.col("text")))
    foreign = (F.col("field") == "equation") & (F.col("line") > 0) & F.col("text").rlike(r"\p{L}{3}") & ~F.col("text").rlike(r"[=+\\^_{}−±∓×·∂∑∏∫√⟨⟩⊗⊕≤≥<>→∞≈|]")
    lines = lines.withColumn("page", F.col("page") | foreign)
    # page numbers between are seen through
    lines = lines.withColumn("above", F.when(F.col("above").rlike(_PAGE), F.col("above2")).otherwise(F.col("above"))).withColumn(
        "below", F.when(F.col("below").rlike(_PAGE), F.col("below2")).otherwise(F.col("below"))).drop("above2", "below2")
    lines = cut(lines)
    at = ["field", "id", "line"]
    short = F.length("text") <= 80
    inner = lines.where((F.col("above") != "") & (F.col("below") != "") & (F.col("field") != "equation") & short & ~F.col("page"))
    hyphen = F.col("above").rlike(r"\p{L}[-¬­‐]\s*$")
    pair = lambda what, a, b: F.struct(F.lit(what).alias("what"), a.alias("a"), b.alias("b"))
    keys = inner.select(*at, F.explode(F.array(
        pair("in", last(F.col("above")), first(F.col("text"))), pair("out", last(F.col("text")), first(F.col("below"))), pair("join", last(F.col("above")), first(F.col("below"))),
        pair("half", F.when(hyphen, F.concat(last(F.col("above")), first(F.col("below")))), F.lit("")),
        pair("half_in", F.when(hyphen, F.concat(last(F.col("above")), first(F.col("text")))), F.lit("")))).alias("k")
    ).select(*at, "k.*").where("a is not null and a <> ''")
    # pairs of neighbouring words, and words alone, inside the lines of all fields
    flat = F.regexp_replace("text", r"\$[^$\n]*\$", r" \$ ")
    tokens = texts.where(F.col("field") != "equation").select(F.explode(F.split(flat, "\n")).alias("x")).select(
        F.transform(F.regexp_extract_all("x", F.lit(r"([\p{L}\p{N}'’-]+|\$|[^\s\p{L}\p{N}])"), 1), lambda w: F.lower(w)).alias("w")).where(F.size("w") > 0)
    pairs = tokens.select(F.explode(F.transform("w", lambda x, k: F.struct(x.alias("a"), F.coalesce(F.get("w", k + 1), F.lit("")).alias("b")))).alias("p")).groupBy("p.a", "p.b").count()
    both = pairs.unionByName(pairs.where(F.length("a") > 2).groupBy("a").agg(F.sum("count").alias("count")).select("a", F.lit("").alias("b"), "count"))
    counts = both.join(_small(keys.select("a", "b").distinct()), ["a", "b"]).groupBy("a", "b").agg(F.sum("count").alias("count"))
    joined = keys.join(_small(counts), ["a", "b"], "left").groupBy(*at).agg(*(F.max(F.when(F.col("what") == w, F.coalesce("count", F.lit(0)))).alias(w) for w in ("in", "out", "join", "half", "half_in")))
    proof = joined.select(*at, (
        (F.coalesce("half", F.lit(0)) >= 2) & (F.coalesce("half_in", F.lit(0)) == 0) | (F.col("join") >= 2) & (F.col("in") == 0) & (F.col("out") <= 1)).alias("proved"), (F.col("in") >= 2).alias("plain"))
    judged = cut(lines.join(proof, at, "left"))
    known = judged.where("proved is not null").groupBy("mask").agg(F.sum(F.col("proved").cast("int")).alias("yes"), F.sum((F.col("plain") & ~F.col("proved")).cast("int")).alias("no"))
    # lines of one word prove nothing about others
    masks = known.where((F.col("yes") >= least) & (F.col("yes") >= 4 * F.col("no")) & (F.length("mask") > 2)).select("mask", F.lit(True).alias("known"))
    marked = judged.join(_small(masks), "mask", "left")
    return marked.where(F.col("page") | F.coalesce("known", F.lit(False)) & short & ~F.col("text").rlike(r"[=\\]") | F.coalesce("proved", F.lit(False))).select(*at)


def broken_words(texts: DataFrame) -> DataFrame:
    """``(field, id, at, left, right)``: words broken by a hyphen over a line end, whatever stands between."""
    base = texts.where((F.col("field") != "equation") & F.col("text").contains("\n"))
    soft = base.where(F.col("text").rlike(r"\p{L}[¬­][ \t]*\n")).select("field", "id", F.lit(0).alias("at"), F.lit("").alias("left"), F.lit("").alias("right"))
    hard = base.where(F.col("text").rlike(r"\p{L}-[ \t]*\n"))
    split = hard.select("field", "id", F.split("text", "\n").alias("l"))
    each = F.transform(F.sequence(F.lit(0), F.size("l") - 2), lambda k: F.struct(
        k.alias("at"), F.regexp_extract(F.get("l", k), r"(\p{L}+)-[ \t]*$", 1).alias("left"),
        F.regexp_extract(F.get("l", k + 1), r"^[ \t]*(\p{L}+)", 1).alias("right")))
    ends = split.where(F.size("l") > 1).select("field", "id", F.explode(each).alias("x")).select("field", "id", "x.*").where("left <> ''")
    # the hyphenated form, where the collection uses it inside lines
    compounds = texts.where((F.col("field") != "equation") & F.col("text").contains("-")).select(F.explode(F.regexp_extract_all("text", F.lit(r"(\p{L}+-\p{L}+)"), 1)).alias("w")).groupBy(
        F.lower("w").alias("compound")).count().where("count >= 2")
    cased = ends.withColumn("compound", F.lower(F.concat("left", F.lit("-"), "right")))
    odd = cased.join(compounds, "compound", "left_anti")
    return soft.unionByName(odd.select("field", "id", "at", "left", "right"))


def _found_in(equations: DataFrame) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The fields, and what is damaged in them by kind."""
    texts = cut(spread(_texts(equations)))
    return texts, {"glyph": misread(cut(read_words(texts))), "character": misread_characters(texts), "header": headers(texts), "hyphen": broken_words(texts)}


def damage(equations: DataFrame) -> DataFrame:
    """``(field, id, kind)``: every kind of page-scan damage of every field.

    Null and empty fields have none; repeated rows are separate rows; an empty table gives an empty result; other
    columns are ignored.
    """
    out = None
    for kind, frame in _found_in(equations)[1].items():
        part = frame.select("field", "id", F.lit("glyph" if kind == "character" else kind).alias("kind"))
        out = part if out is None else out.unionByName(part)
    return out.distinct()


def _replaced(text: str, words, signs) -> str:
    """The text with misread words and characters put right at their places; the number of its lines stays."""
    edits = []
    for w in words:
        new, old = w["chosen"], text[w["first"] : w["end"]]
        if old[:1].isupper() and not new.startswith("\\"):
            new = new.upper() if len(old) > 1 and old.isupper() else new[:1].upper() + new[1:]
        edits.append((w["first"], w["end"], new + "\n" * old.count("\n")))
    if len(signs):
        # places among the characters that are neither blank nor in a formula, a formula being one
        places = []
        for m in re.finditer(r"\$[^$\n]*\$|\s+|.", text, re.S):
            if not m.group().isspace():
                places.append(m.start())
        edits += [(places[s["at"] + 1], places[s["at"] + 1] + 1, s["chosen"]) for s in signs if s["at"] + 1 < len(places) and text[places[s["at"] + 1]] == s["word"]]
    for a, b, new in sorted(edits, reverse=True):
        text = text[:a] + new + text[b:]
    return text


@pandas_udf(StringType())
def _put_right(texts: pd.Series, words: pd.Series, signs: pd.Series) -> pd.Series:
    return pd.Series([_replaced(t, [] if w is None else w, [] if s is None else s) for t, w, s in zip(texts, words, signs)], dtype=object)


def repair(equations: DataFrame) -> DataFrame:
    """``(field, id, text, fixes)``: every field repaired into continuous text, and the number of its repairs.

    Misread words get the form chosen for them at their places, in the case they stand in; headers are left out, broken
    words are joined, other hyphens at line ends stay with their word, and lines are run together within a paragraph,
    each line looking at the next by a window. Fields without damage come back as they are, null and empty ones are
    left out. Ids are taken as unique.
    """
    texts, kinds = _found_in(equations)
    kinds = {k: cut(v) for k, v in kinds.items()}
    key = ["field", "id"]
    words = kinds["glyph"].groupBy(*key).agg(F.collect_set(F.struct("first", "end", "chosen")).alias("_words"))
    signs = kinds["character"].groupBy(*key).agg(F.collect_set(F.struct("at", "word", "chosen")).alias("_signs"))
    others = kinds["header"].select(*key).unionByName(kinds["hyphen"].select(*key)).groupBy(*key).agg(F.count("*").alias("_others"))
    joined = texts.join(words, key, "left").join(signs, key, "left").join(others, key, "left")
    fixes = (F.coalesce(F.size("_words"), F.lit(0)) + F.coalesce(F.size("_signs"), F.lit(0)) + F.coalesce("_others", F.lit(0))).cast("int")
    counted = joined.withColumn("fixes", fixes)
    whole = counted.where("fixes = 0").select(*key, "text", "fixes")
    lines = counted.where("fixes > 0").select(*key, "fixes", F.posexplode(F.split(_put_right("text", "_words", "_signs"), "\n")).alias("line", "text"))
    lines = lines.join(kinds["header"].select(*key, "line"), [*key, "line"], "left_anti")
    halves = kinds["hyphen"].where("left <> ''").select(*key, F.col("left").alias("_left"), F.col("right").alias("_right"), F.lit(True).alias("_join")).distinct()
    order = Window.partitionBy(*key).orderBy("line")
    lines = lines.withColumn("next", F.lead("text").over(order))
    lines = lines.withColumn("_left", F.regexp_extract("text", r"(\p{L}+)-[ \t]*$", 1)).withColumn("_right", F.regexp_extract(F.coalesce("next", F.lit("")), r"^[ \t]*(\p{L}+)", 1))
    lines = lines.join(halves, [*key, "_left", "_right"], "left")
    goes_on = F.col("_right") != ""
    soft, hard = F.col("text").rlike(r"\p{L}[¬­][ \t]*$") & goes_on, (F.col("_left") != "") & goes_on
    blank = (F.trim("text") == "") | (F.trim("next") == "")
    piece = (
        F.when(F.col("next").isNull(), F.col("text")).when(soft | hard & F.col("_join"), F.regexp_replace("text", r"[-¬­][ \t]*$", "")).when(hard, F.rtrim("text"))
        .when(blank, F.concat("text", F.lit("\n"))).otherwise(F.concat(F.rtrim("text"), F.lit(" "))))
    # a line goes on where the one above ends: its own indent is layout
    led = F.coalesce(F.trim(F.lag("text").over(order)) != "", F.lit(False))
    pieces = lines.withColumn("_p", piece).withColumn("_p", F.when(led, F.ltrim("_p")).otherwise(F.col("_p")))
    done = pieces.groupBy(*key, "fixes").agg(F.array_sort(F.collect_list(F.struct("line", "_p"))).alias("_l"))
    return whole.unionByName(done.select(*key, F.trim(F.array_join(F.transform("_l", lambda x: x["_p"]), "")).alias("text"), "fixes"))


def found(equations: DataFrame) -> DataFrame:
    """``p1_found``: damaged fields."""
    return damage(equations).select("field", "id").distinct()
