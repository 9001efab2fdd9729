"""Visually identical text with different characters: one consistent form and the pairs it unites.

Method: compatibility normalisation to the composed form, full case folding, mapped white space and removal of
default-ignorable characters, computed once per distinct value of an Arrow batch. Because case and some
compatibility variants (superscripts, ligatures) are visible, an exact check on a stricter form follows.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from quillgraph.session import cut, spread

# Letters of other alphabets drawn like a Latin letter.
_TWIN_FROM = "АВЕЅІЈКМНОРСТХУаеорсухіјѕԁԛԝһӏΑΒΕΖΗΙΚΜΝΟΡΤΥΧοʼ∆"
_TWIN_TO = "ABESIJKMHOPCTXYaeopcyxijsdqwhlABEZHIKMNOPTYXo'Δ"
TWINS = str.maketrans(_TWIN_FROM, _TWIN_TO)

# Unicode's default-ignorable code points.
_IGNORABLE = re.compile(
    r"[\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180b-\u180f\u200b-\u200f\u202a-\u202e\u2060-\u206f\u3164"
    r"\ufe00-\ufe0f\ufeff\uffa0\ufff0-\ufff8\U0001bca0-\U0001bca3\U0001d173-\U0001d17a\U000e0000-\U000e0fff]"
)
_BLANKS = re.compile(r"[\s\u2800]+")
#: Compatibility mappings that change nothing one can see.
_INVISIBLE = ("<wide>", "<narrow>", "<font>", "<noBreak>")


def _fold_char(c: str) -> str:
    kind = unicodedata.decomposition(c)
    if kind.startswith(_INVISIBLE):
        return unicodedata.normalize("NFKC", c)
    return "\u03bc" if c == "\u00b5" else c


def fold_text(text: str) -> str:
    """The strict form: strings have the same one exactly if they look the same; case is kept."""
    if text.isascii():
        return _BLANKS.sub(" ", text).strip()
    text = _IGNORABLE.sub("", text)
    text = "".join(c if c < " " else _fold_char(c) for c in text)
    text = unicodedata.normalize("NFC", unicodedata.normalize("NFD", text).translate(TWINS))
    return _BLANKS.sub(" ", text).strip()


def normal_text(text: str) -> str:
    """The loose form: NFKC, full case folding, look-alike letters united, blanks mapped, ignorables removed."""
    text = _IGNORABLE.sub("", unicodedata.normalize("NFKC", text))
    text = unicodedata.normalize("NFD", text).translate(TWINS).casefold()
    return _BLANKS.sub(" ", unicodedata.normalize("NFKC", text)).strip()


def _per_value(values: pd.Series, rule) -> pd.Series:
    known = values.dropna()
    return values.map({v: rule(v) for v in known.unique()}).where(values.notna(), None)


@pandas_udf(StringType())
def normal_form(values: pd.Series) -> pd.Series:
    """``normal_text`` per distinct value; null stays null."""
    return _per_value(values, normal_text)


@pandas_udf(StringType())
def strict_form(values: pd.Series) -> pd.Series:
    """``fold_text`` per distinct value; null stays null."""
    return _per_value(values, fold_text)


def unify(df: DataFrame, column: str, into: str) -> DataFrame:
    """Add ``into``: the consistent form of ``column``. Nulls stay null, empty text stays empty."""
    return df.withColumn(into, normal_form(F.col(column)))


_ON = ["key", "field", "scope", "strict"]


def _keyed(values: DataFrame) -> DataFrame:
    """Rows with their strict form and the hash of both forms under which they meet."""
    rows = values.select("field", "scope", "id", "value").where(F.col("value").isNotNull())
    forms = spread(rows).withColumn("loose", normal_form("value")).withColumn("strict", strict_form("value"))
    return cut(forms.withColumn("key", F.xxhash64("field", "scope", "loose", "strict")).drop("loose"))


def _spellings(keyed: DataFrame) -> DataFrame:
    """Groups of more than one spelling: the most frequent one, the number of spellings and of rows."""
    spellings = keyed.groupBy(*_ON, "value").agg(F.count("*").alias("n"))
    return spellings.groupBy(*_ON).agg(
        F.max_by("value", F.struct("n", "value")).alias("main"), F.count("*").alias("spellings"), F.sum("n").alias("rows")).where("spellings > 1")


def classes(values: DataFrame) -> DataFrame:
    """``(field, scope, id, value, form, main, spellings, rows)``: every row whose value has a look-alike, with its class.

    A class is a field, scope and ``form``; ``main`` is its most frequent spelling. The result has a row for each row of
    a class, however many pairs the class would make. Null values have no class; other columns are ignored.
    """
    keyed = _keyed(values)
    return keyed.join(_spellings(keyed), _ON).select("field", "scope", "id", "value", F.col("strict").alias("form"), "main", "spellings", "rows")


def same_look(values: DataFrame) -> DataFrame:
    """Pairs of rows whose values look the same but are different strings.

    ``values(field, scope, id, value)``: only rows of one field and scope are compared. Returns
    ``(field, id_a, id_b)``, the smaller id first, each pair once. Null values match nothing; repeated rows of
    one id count once; equal strings are no pair. Other columns are ignored.

    Candidates agree in the loose form, the strict form decides. A group's most frequent spelling is never
    joined with itself, so the work is that of the pairs returned, however many rows share one spelling. Where
    the pairs themselves would be too many, ``classes`` says the same in one row for each row.
    """
    keyed = _keyed(values)
    member = keyed.select(*_ON, "id", "value").join(_spellings(keyed).select(*_ON, "main"), _ON)
    odd = member.where("value <> main").select(*_ON, F.col("id").alias("a"), F.col("value").alias("va"))
    both = odd.join(member, _ON).where(
        (F.col("a") != F.col("id")) & (F.col("va") != F.col("value"))
        & ((F.col("value") == F.col("main")) | (F.col("a") < F.col("id")))
    )
    return both.select("field", F.least("a", "id").alias("id_a"), F.greatest("a", "id").alias("id_b")).distinct()


def fields_of(equations: DataFrame, dataset: DataFrame) -> DataFrame:
    """The values of the task: formulas in one scope, symbol keys in that of their paper."""
    formulas = equations.select(
        F.lit("equation").alias("field"), F.lit("").alias("scope"), F.col("row_id").alias("id"), F.col("equation").alias("value"))
    keys = dataset.where(F.col("arxiv_id").isNotNull()).select(
        F.lit("symbols").alias("field"), F.col("arxiv_id").alias("scope"), F.col("rec_id").alias("id"),
        F.explode(F.map_keys("symbols")).alias("value"))
    return formulas.unionByName(keys)


def found(equations: DataFrame, dataset: DataFrame) -> DataFrame:
    """``p3_found``: look-alike pairs of equations (whole table) and of records of one paper (symbol keys)."""
    return same_look(fields_of(equations, dataset))


def sql_form(column: str) -> str:
    """The strict form in SQL: one-character foldings by ``translate``, whose table follows from ``fold_text``."""
    single = {c: f for c in map(chr, (*range(0x80, 0xD800), *range(0xE000, 0x20000))) if len(f := fold_text(c)) == 1 and f != c and unicodedata.normalize("NFC", c) != f}
    quote = lambda text: text.replace("'", "''")
    blanks = "\\t\\n\\x0b\\x0c\\r\\x1c-\\x20\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}\\x{2800}"
    ignorable = re.sub(r"\\(?:u([0-9a-f]{4})|U000([0-9a-f]{5}))", lambda m: f"\\x{{{m[1] or m[2]}}}", _IGNORABLE.pattern)
    shown = f"translate(regexp_replace({column}, '{ignorable}', '', 'g'), '{quote(''.join(single))}', '{quote(''.join(single.values()))}')"
    return f"trim(regexp_replace(nfc_normalize({shown}), '[{blanks}]+', ' ', 'g'))"
