"""Labels of numbered formulas: normal form, base, natural order, distance, prefixes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The grammar of labels.
_DASHES = "–—−"
_GROUPED = r"^(\d+(?:\.\d+)*)([A-Za-z])(?:-([A-Za-z]))?$"


def normalize_label(c: Column) -> Column:
    """A label without blanks and outer parentheses, with one kind of dash; null becomes empty."""
    text = F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), r"(?U)^\s+|\s+$", "")
    text = F.regexp_replace(text, r"^[()]+|[()]+$", "")
    return F.regexp_replace(F.translate(text, _DASHES, "---"), r"(?U)\s+", "")


def base_label(c: Column) -> Column:
    """The label without its letter or letter range: ``2.1a-c`` to ``2.1``; other labels as they are."""
    label = normalize_label(c)
    base = F.regexp_extract(label, _GROUPED, 1)
    return F.when(base != "", base).otherwise(label)


def label_numbers(c: Column) -> Column:
    """The base's numbers as an array, or null where it is no dotted number."""
    base = base_label(c)
    return F.when(base.rlike(r"^\d+(\.\d+)*$"), F.transform(F.split(base, r"\."), lambda x: x.cast("int")))


def label_key(c: Column) -> Column:
    """Natural order: numbers before anything else, then the letter, then the text."""
    label, numbers = normalize_label(c), label_numbers(c)
    suffix = F.lower(F.regexp_extract(label, _GROUPED, 2))
    return F.struct(
        F.when(numbers.isNull(), 1).otherwise(0).alias("kind"),
        F.coalesce(numbers, F.array().cast("array<int>")).alias("numbers"),
        F.when(numbers.isNull(), "").otherwise(suffix).alias("suffix"),
        label.alias("label"),
    )


def labels_near(left: Column, right: Column, gap: int) -> Column:
    """Same depth, same leading numbers, and last numbers at most ``gap`` apart."""
    a, b = label_numbers(left), label_numbers(right)
    head = lambda x: F.slice(x, F.lit(1), F.greatest(F.size(x) - 1, F.lit(0)))
    near = (F.size(a) == F.size(b)) & (head(a) == head(b)) & (F.abs(F.element_at(a, -1) - F.element_at(b, -1)) <= gap)
    return F.coalesce(near, F.lit(False))


def expected_prefix(count: Column, first: Column) -> Column:
    """``1..n``, or ``p.1..p.n`` where the first label has a family ``p``."""
    family = F.regexp_extract(first, r"^(.*)\.[^.]*$", 1)
    numbers = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))
    return F.transform(numbers, lambda n: F.when(family != "", F.concat(family, F.lit("."), n.cast("string"))).otherwise(n.cast("string")))


def has_prefix(labels: Column) -> Column:
    """Do base labels, in order, equal the expected prefix? An empty list, or one with a blank, does not."""
    blank = F.exists(labels, lambda x: x == "")
    expected = expected_prefix(F.size(labels), F.coalesce(F.get(labels, F.lit(0)), F.lit("")))
    return F.coalesce((F.size(labels) > 0) & ~blank & (labels == expected), F.lit(False))
