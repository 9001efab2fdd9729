"""Flattened formula text to LaTeX-like text: an ordered chain of replacements as one Catalyst expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Glyphs and their commands.
GLYPHS = {
    "∂": r"\partial ", "∑": r"\sum ", "∏": r"\prod ", "∫": r"\int ", "√": r"\sqrt", "⟨": r"\langle ", "⟩": r"\rangle ", "†": r"^{\dagger}", "±": r"\pm ", "∓": r"\mp ", "⊗": r"\otimes ", "⊕": r"\oplus ", "≤": r"\leq ", "≥": r"\geq ", "≪": r"\ll ", "≫": r"\gg ", "→": r"\to ", "∞": r"\infty ", "≈": r"\approx ", "≡": r"\equiv ", "∈": r"\in ", "−": "-", "ˆ": r"\hat ", "ℏ": r"\hbar ",
    "α": r"\alpha ", "β": r"\beta ", "γ": r"\gamma ", "δ": r"\delta ", "ε": r"\epsilon ", "ϵ": r"\epsilon ", "ζ": r"\zeta ", "η": r"\eta ", "θ": r"\theta ", "κ": r"\kappa ", "λ": r"\lambda ", "μ": r"\mu ", "µ": r"\mu ", "ν": r"\nu ", "ξ": r"\xi ", "π": r"\pi ", "ρ": r"\rho ", "σ": r"\sigma ", "τ": r"\tau ", "φ": r"\phi ", "χ": r"\chi ", "ψ": r"\psi ", "ω": r"\omega ", "Γ": r"\Gamma ", "Δ": r"\Delta ", "Θ": r"\Theta ", "Λ": r"\Lambda ", "Σ": r"\Sigma ", "Φ": r"\Phi ", "Ψ": r"\Psi ", "Ω": r"\Omega ",
}
_RULES = [
    (r"(?<![A-Za-z\\])(lim|exp|ln|log|sin|cos|tan|det|max|min)(?![A-Za-z])", r"\\$1"),
    (r"(?<![A-Za-z\\])(Tr|tr|argmax|argmin)(?![A-Za-z])", r"\\operatorname{$1}"),
    (r"([A-Za-z])̂", r"\\hat{$1}"),
    (r"(?<![A-Za-z\\])d([A-Za-z]|\\[A-Za-z]+ ?)/d([A-Za-z])", r"\\frac{d$1}{d$2}"),
    (r"(\\partial )([A-Za-z\\]+ ?)/(\\partial )([A-Za-z]+)", r"\\frac{\\partial $2}{\\partial $4}"),
    (r"([A-Za-z}])_([A-Za-z0-9]{2,})(?![A-Za-z0-9}])", r"$1_{$2}"),
    (r"\|([A-Za-z0-9\\]+)\\rangle", r"\\ket{$1}"),
    (r"\\sqrt\(([^()]*)\)", r"\\sqrt{$1}"),
    (r"(?<![A-Za-z0-9\\}])(\d+)/([A-Za-z])(?![A-Za-z])", r"\\frac{$1}{$2}"),
    (r"\s+", " "),
]


def latexify(c: Column) -> Column:
    """Glyphs to commands, then operators, hats, derivatives, indices, kets, roots and simple fractions.

    A fraction keeps the sign it has: ``1/x`` becomes ``\\frac{1}{x}``. Null stays null; text of several lines
    becomes an aligned block.
    """
    text = c
    for glyph, command in GLYPHS.items():
        text = F.replace(text, F.lit(glyph), F.lit(command))
    one = text
    for pattern, to in _RULES[:-1]:
        one = F.regexp_replace(one, pattern, to)
    rows = F.filter(F.transform(F.split(one, "\n"), lambda r: F.trim(F.regexp_replace(r, r"\s+", " "))), lambda r: r != "")
    return F.when(c.isNull(), None).when(F.size(rows) >= 2, F.concat(F.lit("\\begin{aligned} "), F.array_join(rows, " \\\\ "), F.lit(" \\end{aligned}"))).otherwise(F.array_join(rows, " "))


def strip_prose(c: Column) -> Column:
    """A formula without words ahead of it (up to its first math sign) and without a clause behind it."""
    text = F.regexp_replace(c, r"^(?:(?:[A-Za-z]{2,}|[aI]),?\s+){3,}(?=[^A-Za-z]*[\\A-Za-z]\S*\s*(?:=|\\|\())", "")
    return F.trim(F.regexp_replace(text, r"[,.;]?\s+(?:where|with|which|for all|and therefore|so that)\s+(?![^=]{0,80}=).*$", ""))


def is_valid_formula(c: Column) -> Column:
    """Dense enough in math, and not prose, to be a formula."""
    text = F.coalesce(c, F.lit(""))
    words = F.regexp_count(text, F.lit(r"[A-Za-z]{4,}"))
    marks = F.regexp_count(text, F.lit(r"[=+\-*/^_{}\\∑∫√∂⟨⟩]"))
    return (F.length(text) >= 6) & (F.length(text) <= 1200) & (marks >= 1) & (F.contains(text, F.lit("=")) | (marks >= 3)) & (words <= 12) & ~text.rlike(r"(?i)\b(?:figure|table|copyright|arxiv:|doi:|preprint|university)\b")


def salvageable(c: Column) -> Column:
    """Looser: kept with low confidence."""
    text = F.coalesce(c, F.lit(""))
    return ~is_valid_formula(c) & (F.length(text) >= 4) & text.rlike(r"[=<>≤≥\\^_]") & (F.regexp_count(text, F.lit(r"[A-Za-z]{4,}")) <= 20)
