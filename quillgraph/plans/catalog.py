"""Named queries over the test tables and, where SQL can express them, their SQL twins.

Every query runs over its whole tables. The names carry the numbers of the operator inventory.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillgraph.functions import labels as L
from quillgraph.functions import latexify as X
from quillgraph.functions import symbols as S
from quillgraph.functions import text as T
from quillgraph.operators import meaning as E
from quillgraph.operators import provenance as P
from quillgraph.operators import reconcile as M
from quillgraph.operators import relations as G
from quillgraph.operators import rows as R
from quillgraph.session import spread, table, tune
from quillgraph.sources import documents as D

Query = Callable[[SparkSession, str], DataFrame]
DOC, LABEL = "arxiv_id", "eq_number"

# ---------------------------------------------------------------- building blocks


def _extracted(spark: SparkSession, folder: str) -> DataFrame:
    """Each formula once: of repeated deliveries the row with the smallest id."""
    return R.first_by_label(table(spark, folder, "equations"), DOC, LABEL, ["row_id"])


def _top(spark: SparkSession, folder: str) -> DataFrame:
    """The first seven formulas of every document in natural label order."""
    return R.top_k(_extracted(spark, folder).withColumn("_key", L.label_key(F.col(LABEL))), DOC, ["_key", "row_id"]).drop("_key")


def _placed(spark: SparkSession, folder: str) -> DataFrame:
    """All formulas of every document with their place in natural label order."""
    keyed = _extracted(spark, folder).withColumn("_key", L.label_key(F.col(LABEL)))
    return keyed.withColumn("place", F.row_number().over(Window.partitionBy(DOC).orderBy("_key", "row_id"))).drop("_key")


def _graph(spark: SparkSession, folder: str) -> DataFrame:
    top = _top(spark, folder).select(DOC, LABEL, "place", "equation", "text_before", "text_after", "section")
    first = F.coalesce(F.get(S.symbol_keys(F.trim(F.substring_index(F.coalesce("equation", F.lit("")), "=", 1))), F.lit(0)), F.lit(""))
    context = T.context(F.col("section"), F.col("text_before"), F.col("text_after"))
    shaped = spread(top).withColumn("_keys", S.symbol_keys("equation")).withColumn("symbols", S.definitions(context, F.col("_keys"))).withColumn(
        "meaning", F.coalesce(T.equation_role(F.col("equation"), F.col("text_before"), F.col("text_after"), F.col("section")), F.lit("")))
    shaped = R.blank_repeated(shaped, DOC, "meaning")
    return G.edges(G.defined_symbols(shaped.withColumn("_first", first), F.col("_first")).drop("_first", "_keys"), DOC, "place")


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """The graded relation graph of the first formulas of every document."""
    return _graph(tune(spark), folder)


def _pages(rows: DataFrame) -> DataFrame:
    """A page of every document's formulas as a converter would write it."""
    esc = lambda c: F.replace(F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit('"'), F.lit("&quot;"))
    row = F.concat(
        F.lit("<section><h2>"), esc(F.coalesce("section", F.lit("Unknown Section"))), F.lit('</h2><p>'), esc(F.col("text_before")), F.lit('</p><table class="ltx_equation" id="S'), F.col("row_id").cast("string"),
        F.lit('"><tr><td><math alttext="'), esc(F.col("equation")), F.lit('"><mi>x</mi></math></td><td class="ltx_eqn_eqno"><span class="ltx_tag_equation">('), F.col(LABEL), F.lit(")</span></td></tr></table><p>"), esc(F.col("text_after")), F.lit("</p></section>"))
    return rows.groupBy(F.col(DOC).alias("document")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row_id", row.alias("h")))), lambda x: x["h"]), "\n").alias("html"))


def _edges_of(spark, folder):
    """Each edge once."""
    window = Window.partitionBy(DOC, "src", "dst").orderBy("edge_id")
    return table(spark, folder, "relations").withColumn("_r", F.row_number().over(window)).where("_r = 1").drop("_r")


# ---------------------------------------------------------------- SQL fragments

_N = "regexp_replace(regexp_replace(translate(trim(coalesce(eq_number, '')), '–—−', '---'), '^[()]+|[()]+$', '', 'g'), '\\s+', '', 'g')"
_B = f"CASE WHEN regexp_full_match({_N}, '\\d+(\\.\\d+)*[A-Za-z](-[A-Za-z])?') THEN regexp_extract({_N}, '^(\\d+(\\.\\d+)*)', 1) ELSE {_N} END"
_FIRST = f"(SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY arxiv_id, {_N} ORDER BY row_id) AS r FROM equations WHERE {_N} <> '') WHERE r = 1)"
_NUMS = f"CASE WHEN regexp_full_match({_B}, '\\d+(\\.\\d+)*') THEN list_transform(string_split({_B}, '.'), lambda x: CAST(x AS INTEGER)) ELSE CAST([] AS INTEGER[]) END"
_KIND = f"CASE WHEN regexp_full_match({_B}, '\\d+(\\.\\d+)*') THEN 0 ELSE 1 END"
_SUFFIX = f"CASE WHEN regexp_full_match({_B}, '\\d+(\\.\\d+)*') THEN lower(regexp_extract({_N}, '^\\d+(\\.\\d+)*([A-Za-z])(-[A-Za-z])?$', 2)) ELSE '' END"
_ORDER = f"{_KIND}, {_NUMS}, {_SUFFIX}, {_N}, row_id"
_TOP = f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY arxiv_id ORDER BY {_ORDER}) AS place FROM {_FIRST}) WHERE place <= 7)"
_RECORDS = _TOP.replace("row_id", "rec_id").replace("FROM equations", "FROM dataset")
_SQ = lambda c: f"trim(regexp_replace(coalesce({c}, ''), '[\\s\\x{{a0}}\\x{{1680}}\\x{{2000}}-\\x{{200a}}\\x{{2028}}\\x{{2029}}\\x{{202f}}\\x{{205f}}\\x{{3000}}\\x{{85}}]+', ' ', 'g'))"
_ANY = lambda c, tokens: "(" + " OR ".join(f"contains({c}, '{t}')" for t in tokens) + ")"
_NOISY = "(len(regexp_extract_all(coalesce(equation, ''), '[A-Za-z]{5,}')) > 5 AND len(regexp_extract_all(coalesce(equation, ''), '[=+\\-*/∑∫√_^{}()\\[\\]]')) < 3)"
_QUALITY = (
    "CASE WHEN coalesce(equation, '') = '' THEN 0.0 ELSE greatest(0.0, least(0.9, 0.25 + CASE WHEN length(equation) >= 8 THEN 0.15 ELSE 0 END"
    f" + CASE WHEN {_ANY('equation', T.QUALITY_TOKENS)} THEN 0.2 ELSE 0 END"
    " + CASE equation_format WHEN 'latex' THEN 0.2 WHEN 'latex_ocr' THEN 0.15 WHEN 'latex_like_from_pdf' THEN 0.1 ELSE 0 END"
    f" + CASE equation_confidence WHEN 'high' THEN 0.2 WHEN 'medium' THEN 0.1 ELSE 0 END - CASE WHEN {_NOISY} THEN 0.3 ELSE 0 END)) END")

_IN = lambda words: "(" + ", ".join(f"'{w}'" for w in words) + ")"
_WORDS = "string_split(coalesce(phrase, ''), ' ')"
_NAMED = f"CASE WHEN len({_WORDS}) = 1 THEN regexp_full_match(coalesce(phrase, ''), '[A-Z]{{2,}}') ELSE len(list_filter({_WORDS}, lambda w: regexp_full_match(w, '[A-Z][A-Za-z0-9-]{{2,}}|[A-Z]{{2,}}'))) > 0 END"
_PARTS = "regexp_extract_all(lower(coalesce(phrase, '')), '[a-z0-9]+')"
_VALID = f"""(NOT (list_has_any({_PARTS}, [{', '.join(f"'{w}'" for w in T._CLAUSE)}]) OR regexp_extract(lower(coalesce(phrase, '')), '([a-z]+)\\s*$', 1) IN {_IN(T._LAST)} OR regexp_extract(lower(coalesce(phrase, '')), '^([a-z]+)([^a-z0-9]|$)', 1) IN {_IN(T._FIRST)}
      OR (len({_WORDS}) = 1 AND lower(coalesce(phrase, '')) IN {_IN(T._GENERIC)}) OR coalesce(phrase, '') IN {_IN(T._SIDES)} OR len(list_filter({_WORDS}, lambda w: trim(replace(lower(w), '.', ' ')) IN {_IN(T._REFERENCES)})) > 0
      OR regexp_matches(coalesce(phrase, ''), '(?i)^(?:I{{1,3}}|IV|V?I{{0,3}}|I?X|X{{0,3}}I{{0,3}})(?:\\s+[A-Z])?$') OR regexp_matches(coalesce(phrase, ''), '^[A-Za-z]{{1,6}}\\d{{1,4}}[a-z]?$') OR regexp_matches(coalesce(phrase, ''), '[A-Za-z]\\d{{4}}|\\d{{4}}[A-Za-z]')
      OR regexp_matches(coalesce(phrase, ''), '[^A-Za-z0-9 ''\\-/]') OR length(regexp_replace(coalesce(phrase, ''), '[^A-Za-z]', '', 'g')) < 3 OR len({_WORDS}) > {T.MOST_WORDS}
      OR (len({_WORDS}) >= 2 AND len(list_filter({_WORDS}, lambda w: length(w) <= 2)) * 2 > len({_WORDS}))) AND (len({_WORDS}) >= 2 OR {_NAMED}))"""

# Sentences. SQL's word borders know ASCII letters only, so other letters beside them become an
# underscore, which the scrub takes out as it does them.
_SCRUB = lambda c: "trim(regexp_replace(" + reduce(lambda x, p: f"regexp_replace({x}, '{p}', ' ', 'g')", (
    "(?i)\\b(?:ket|bra|langle|rangle|otimes|oplus|ominus|odot|dagger|mathrm|mathcal|mathbb|mathbf|mathfrak|mathsf|hat|vec|tilde|overline|underline|overrightarrow|boldsymbol)\\b",
    "\\b[A-Z]\\S{1,25}(?:\\s+\\S{1,15})?\\s+et[\\s\\x{a0}]+al\\.?\\s*\\(\\s*\\d{4}[^)]*\\)", "[^\\x00-\\x7f]+", "\\[[^\\]]{0,30}\\]", "[{}_^\\\\]", "\\b(?:[A-Za-z]\\s+){2,}[A-Za-z]\\b"), f"regexp_replace(regexp_replace(coalesce({c}, ''), '[^\\P{{L}}A-Za-z]([A-Za-z])', '_\\1', 'g'), '([A-Za-z])[^\\P{{L}}A-Za-z]', '\\1_', 'g')") + ", '\\s+', ' ', 'g'))"
_CUT = lambda c, stops: f"list_filter(list_transform(string_split(regexp_replace({c}, '([{stops}])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda x: trim(x)), lambda x: x <> '')"
_PHRASES = lambda c: _CUT(_SCRUB(c), ".!?;:")
def _REFERRING(c):
    kept = _SQ(c)
    for short in ("Eqs", "Eq", "Fig", "Sec"):
        kept = f"replace({kept}, '{short}.', '{short}§')"
    return f"list_transform({_CUT(kept, '.!?;')}, lambda x: replace(x, '§', '.'))"


_CLAUSES = lambda c: _CUT(_SQ(c), ".;")
_LAST_RECORDS = "(SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY arxiv_id, eq_number ORDER BY rec_id DESC) AS r FROM dataset) WHERE r = 1)"

_QUERIES: dict[str, tuple[Query, str | None]] = {}


def _add(name: str, sql: str | None = None):
    def keep(build):
        _QUERIES[name] = (lambda spark, folder: build(tune(spark), folder), sql)
        return build

    return keep


# ---------------------------------------------------------------- scans and sources


@_add("o01_ids", """SELECT arxiv_id, CASE WHEN trim(arxiv_id) = '' OR starts_with(trim(arxiv_id), '#') THEN NULL ELSE nullif(regexp_extract(regexp_replace(trim(arxiv_id), '(?i)arXiv:', ''),
      '(\\d{4}\\.\\d{4,5}(v\\d+)?|[a-z][a-z.-]*/\\d{7}(v\\d+)?)', 1), '') END AS clean_id, count(*) AS n FROM paper_status GROUP BY 1, 2""")
def _o01(spark, folder):
    return table(spark, folder, "paper_status").groupBy("arxiv_id", T.clean_id(F.col("arxiv_id")).alias("clean_id")).agg(F.count("*").alias("n"))


@_add("o02_markers", "SELECT row_id, coalesce(contains(left(text_after, 50000), '<math') OR regexp_matches(left(text_after, 50000), 'ltx_document|ltx_page_main|ltx_equation'), false) AS marked FROM equations")
def _o02(spark, folder):
    return table(spark, folder, "equations").select("row_id", T.document_marker(F.col("text_after")).alias("marked"))


@_add("o05_html", f"""SELECT document, eq_number, equation FROM (SELECT arxiv_id AS document, {_N} AS eq_number,
      regexp_replace({_SQ("replace(equation, '%', ' ')")}, ' ?= ?', '=', 'g') AS equation FROM {_TOP})
      WHERE length(equation) >= 8 AND {_ANY('equation', T.MATH_TOKENS)}""")
def _o05(spark, folder):
    # the twin has no filters of the operator after the first seven formulas; o05_html_pages reads whole pages
    return D.parse_html(spread(_pages(_top(spark, folder))), k=1_000_000, recover=False).select("document", LABEL, "equation")


@_add("o05_html_pages")
def _o05p(spark, folder):
    return D.parse_html(spread(_pages(_extracted(spark, folder)))).select("document", LABEL, "equation", "section", "place")


@_add("o08_layout")
def _o08(spark, folder):
    text = F.concat_ws("\n", F.coalesce("text_before", F.lit("")), F.concat("equation", F.lit("  ("), F.col(LABEL), F.lit(")")), F.coalesce("text_after", F.lit("")))
    pages = _extracted(spark, folder).groupBy(F.col(DOC).alias("document")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row_id", text.alias("t")))), lambda x: x["t"]), "\n").alias("text"))
    return D.layout_formulas(pages)


@_add("o09_markdown")
def _o09(spark, folder):
    return D.markdown_formulas(spread(table(spark, folder, "documents")).select(F.col("doc_id").cast("string").alias("document"), "text"))


@_add("o06_geometry")
def _o06(spark, folder):
    placed = _placed(spark, folder).where(F.col("equation").isNotNull())
    # a page has room for seven formulas, so the range join of a page is bounded however long its document is
    placed = placed.withColumn("page", F.floor((F.col("place") - 1) / 7).cast("int") + 1).withColumn("cy", ((F.col("place") - 1) % 7 + 1) * 100.0)
    words = placed.select(DOC, "page", "cy", F.posexplode(F.split("equation", " ")).alias("n", "text"))
    tokens = words.select(F.col(DOC).alias("document"), "page", F.lit(600.0).alias("width"), (40.0 + F.col("n") * 6).alias("x0"), (45.0 + F.col("n") * 6).alias("x1"), "cy", "text")
    markers = placed.select(F.col(DOC).alias("document"), "page", F.lit(600.0), F.lit(560.0), F.lit(590.0), "cy", F.concat(F.lit("("), L.normalize_label(F.col(LABEL)), F.lit(")")))
    return D.geometry_formulas(tokens.union(markers))


@_add("o10_records", f"""SELECT arxiv_id, eq_number AS label, equation, coalesce(meaning, '') AS meaning, CAST(cardinality(symbols) AS INTEGER) AS symbols, CAST(cardinality(relations) AS INTEGER) AS relations FROM {_LAST_RECORDS}""")
def _o10(spark, folder):
    each = D.nested_records(table(spark, folder, "dataset")).select("arxiv_id", F.explode("record").alias("label", "r"))
    return each.select("arxiv_id", "label", "r.equation", "r.meaning", F.size("r.symbols").alias("symbols"), F.size("r.relations").alias("relations"))


# ---------------------------------------------------------------- scalars


@_add("o11_labels", f"SELECT row_id, {_N} AS label, {_B} AS base FROM equations")
def _o11(spark, folder):
    return table(spark, folder, "equations").select("row_id", L.normalize_label(F.col(LABEL)).alias("label"), L.base_label(F.col(LABEL)).alias("base"))


@_add("o13_label_order", f"SELECT arxiv_id, row_id, row_number() OVER (PARTITION BY arxiv_id ORDER BY {_ORDER}) AS place FROM equations")
def _o13(spark, folder):
    keyed = table(spark, folder, "equations").withColumn("_key", L.label_key(F.col(LABEL)))
    return keyed.select(DOC, "row_id", F.row_number().over(Window.partitionBy(DOC).orderBy("_key", "row_id")).alias("place"))


@_add("o14_clean", f"""SELECT row_id, CASE WHEN len(list_filter(string_split(trim(h), ' '), lambda w: w <> '')) >= 5 THEN trim(substr(c, length(h) + 1)) ELSE c END AS cleaned FROM (SELECT row_id, c, regexp_extract(c, '^(([A-Za-z]{{2,}}[,:]?\\s+)+)', 1) AS h
      FROM (SELECT row_id, regexp_replace({_SQ('equation')}, '(\\\\(hat|vec|bar|tilde|dot|ddot)\\{{[A-Za-z]\\}})(\\d+)', '\\1_{{\\3}}', 'g') AS c FROM equations))""")
def _o14(spark, folder):
    return table(spark, folder, "equations").select("row_id", T.clean_equation(F.col("equation")).alias("cleaned"))


@_add("o15_latexify")
def _o15(spark, folder):
    return table(spark, folder, "equations").select("row_id", X.latexify(F.col("equation")).alias("latex"))


@_add("o16_strip_prose")
def _o16(spark, folder):
    return table(spark, folder, "equations").select("row_id", X.strip_prose(F.concat_ws(" ", "text_before", "equation")).alias("formula"))


@_add("o17_context", f"""SELECT row_id, CASE WHEN length(w) <= 4000 THEN w ELSE {_SQ("concat_ws(' ', right(h, 700), left(a, 3200))")} END AS context FROM (SELECT row_id,
      {_SQ("concat_ws(' ', nullif(section, ''), nullif(text_before, ''), nullif(text_after, ''))")} AS w, {_SQ("concat_ws(' ', nullif(section, ''), nullif(text_before, ''))")} AS h, {_SQ('text_after')} AS a FROM equations)""")
def _o17(spark, folder):
    return table(spark, folder, "equations").select("row_id", T.context(F.col("section"), F.col("text_before"), F.col("text_after")).alias("context"))


@_add("o18_preview", f"SELECT doc_id, CASE WHEN length({_SQ('text')}) <= 120 THEN {_SQ('text')} ELSE rtrim(left({_SQ('text')}, 117)) || '...' END AS preview FROM documents")
def _o18(spark, folder):
    return table(spark, folder, "documents").select("doc_id", T.shorten(F.col("text"), 120).alias("preview"))


@_add("o19_scrub", f"SELECT doc_id, {_SCRUB('text')} AS prose FROM documents")
def _o19(spark, folder):
    return table(spark, folder, "documents").select("doc_id", T.scrub(F.col("text")).alias("prose"))


@_add("o20_unicode_math")
def _o20(spark, folder):
    return spread(table(spark, folder, "equations")).select("row_id", S.unicode_names("equation").alias("named"))


@_add("o21_identifiers", """SELECT row_id, k AS n, CASE WHEN c IN ('d', 'i', 'e') THEN '' ELSE c END AS identifier FROM (SELECT row_id, k, regexp_replace(CASE """
      + " ".join(f"WHEN trim(x) = '{g}' THEN '{n}'" for g, n in T.GREEK_NAMES.items()) + """ ELSE trim(x) END, '[^A-Za-z0-9]', '', 'g') AS c FROM (SELECT row_id, generate_subscripts(identifier_candidates, 1) - 1 AS k, unnest(identifier_candidates) AS x FROM equations))""")
def _o21(spark, folder):
    each = table(spark, folder, "equations").select("row_id", F.posexplode("identifier_candidates").alias("n", "x"))
    return each.select("row_id", "n", T.canonical_identifier(F.col("x")).alias("identifier"))


_KEY = reduce(lambda c, _: "regexp_replace(regexp_replace(" + c + ", '\\\\(?:" + "|".join(S.FORMATS) + ")\\s*\\{([^{}]*)\\}', '\\1', 'g'), '([_^])\\{([^{}\\\\]*)\\}', '\\1\\2', 'g')", range(4), "symbol")


@_add("o22_symbol_keys", f"""SELECT rec_id, symbol, regexp_replace({_KEY}, '[{{}}\\\\\\s]', '', 'g') AS key FROM (SELECT rec_id, unnest(map_keys(symbols)) AS symbol FROM dataset)""")
def _o22(spark, folder):
    return table(spark, folder, "dataset").select("rec_id", F.explode(F.map_keys("symbols")).alias("symbol")).select("rec_id", "symbol", S.symbol_key(F.col("symbol")).alias("key"))


# ---------------------------------------------------------------- predicates


@_add("o23_equation_like", f"SELECT row_id, coalesce(length(equation) >= 8 AND {_ANY('equation', T.MATH_TOKENS)}, false) AS looks FROM equations")
def _o23(spark, folder):
    return table(spark, folder, "equations").select("row_id", T.looks_like_equation(F.col("equation")).alias("looks"))


_MARKS = "len(regexp_extract_all(e, '[=+\\-*/^_{}\\\\∑∫√∂⟨⟩]'))"
_LONG = "len(regexp_extract_all(e, '[A-Za-z]{4,}'))"
_FORMULA = f"(length(e) >= 6 AND length(e) <= 1200 AND {_MARKS} >= 1 AND (contains(e, '=') OR {_MARKS} >= 3) AND {_LONG} <= 12 AND NOT regexp_matches(e, '(?i)\\b(?:figure|table|copyright|arxiv:|doi:|preprint|university)\\b'))"


@_add("o24_valid_formulas", f"SELECT row_id, {_FORMULA} AS valid, NOT {_FORMULA} AND length(e) >= 4 AND regexp_matches(e, '[=<>≤≥\\\\^_]') AND {_LONG} <= 20 AS salvageable FROM (SELECT row_id, coalesce(equation, '') AS e FROM equations)")
def _o24(spark, folder):
    return table(spark, folder, "equations").select("row_id", X.is_valid_formula(F.col("equation")).alias("valid"), X.salvageable(F.col("equation")).alias("salvageable"))


@_add("o25_noisy", f"""SELECT row_id, {_NOISY} AS noisy, (s > 5 AND s > m) OR regexp_matches(e, '\\\\partial[A-Za-z]') OR regexp_matches(e, '[^\\x00-\\x7F]') OR regexp_matches(e, '\\\\(hat|vec|bar|tilde|dot|ddot|breve|check)\\{{[A-Za-z0-9]\\}}[0-9]')
      OR (contains(e, '\\\\') AND d > 3 AND c < 2) AS garbled FROM (SELECT *, coalesce(equation, '') AS e, len(list_filter(t, lambda x: regexp_full_match(x, '[A-Za-z]{{1,3}}'))) AS s, len(list_filter(t, lambda x: regexp_full_match(x, '[0-9]+'))) AS d,
      len(regexp_extract_all(coalesce(equation, ''), '\\\\[A-Za-z]+')) AS m, len(regexp_extract_all(coalesce(equation, ''), '\\\\(frac|hat|vec|bar|tilde|sum|int|sqrt|mathcal|mathbb|bra|ket)\\b')) AS c FROM (SELECT *, string_split({_SQ('equation')}, ' ') AS t FROM equations))""")
def _o25(spark, folder):
    return table(spark, folder, "equations").select("row_id", T.is_noisy(F.col("equation")).alias("noisy"), T.is_garbled(F.col("equation")).alias("garbled"))


@_add("o26_main_body", f"SELECT row_id FROM (SELECT *, sum(CASE WHEN section = 'Appendix A' THEN 0 ELSE 1 END) OVER (PARTITION BY arxiv_id) AS m FROM {_FIRST}) WHERE m < 7 OR coalesce(section, '') <> 'Appendix A'")
def _o26(spark, folder):
    return R.prefer_main_body(_extracted(spark, folder), DOC, F.coalesce(F.col("section") == "Appendix A", F.lit(False))).select("row_id")


@_add("o27_valid_phrases", f"SELECT cand_id, {_VALID} AS valid, {_NAMED} AS named FROM candidates")
def _o27(spark, folder):
    return table(spark, folder, "candidates").select("cand_id", T.valid_phrase(F.col("phrase")).alias("valid"), T.looks_named(F.coalesce("phrase", F.lit(""))).alias("named"))


@_add("o28_definitions")
def _o28(spark, folder):
    each = table(spark, folder, "dataset").select("rec_id", F.explode("symbols").alias("symbol", "definition"))
    distinct = each.select("definition").distinct().withColumn("cleaned", S.clean_definitions("definition"))
    return each.join(distinct, "definition").select("rec_id", "symbol", "cleaned")


# ---------------------------------------------------------------- tokenizers and definitions


@_add("o29_symbols")
def _o29(spark, folder):
    return spread(table(spark, folder, "equations")).select("row_id", F.posexplode(S.symbols("equation")).alias("n", "symbol"))


@_add("o30_roles", """SELECT row_id, regexp_matches(e, '\\\\partial|∂|\\\\frac\\s*\\{d') AS derivative, regexp_matches(e, '\\\\hat\\{?[XYZ]\\}?') AS pauli, regexp_matches(e, '\\\\gamma\\s*[_^]\\s*\\{?(?:\\\\mu|\\\\nu|[0-3])') AS dirac,
      regexp_matches(e, '[_^]\\s*\\{?\\s*\\\\(?:mu|nu)') AS lorentz, regexp_matches(e, '(?:^|[^A-Za-z\\\\])[pq]\\s*\\([^)]*\\|?[^)]*\\)') AS probability, regexp_matches(e, '\\\\mathcal\\{[LD]\\}|\\\\rho.*\\\\dagger|L_?\\{?[a-z0-9]*\\}?\\s*\\\\rho') AS lindblad
      FROM (SELECT row_id, coalesce(equation, '') AS e FROM equations)""")
def _o30(spark, folder):
    return table(spark, folder, "equations").select("row_id", S.role_flags(F.col("equation")).alias("f")).select("row_id", "f.*")


@_add("o30_letters")
def _o30l(spark, folder):
    return spread(table(spark, folder, "equations").select("row_id", "equation")).select("row_id", F.explode(S.roles("equation")).alias("letter", "role"))


@_add("o31_sentences", "SELECT row_id, kind, CAST(k - 1 AS INTEGER) AS n, sentence FROM (" + " UNION ALL ".join(
    f"SELECT row_id, '{kind}' AS kind, generate_subscripts(l, 1) AS k, unnest(l) AS sentence FROM (SELECT row_id, {cut('text_before')} AS l FROM equations)" for kind, cut in (("phrase", _PHRASES), ("reference", _REFERRING), ("clause", _CLAUSES))) + ")")
def _o31(spark, folder):
    rows = table(spark, folder, "equations")
    kinds = F.array(F.struct(F.lit("phrase").alias("kind"), T.sentences(F.col("text_before")).alias("s")), F.struct(F.lit("reference").alias("kind"), T.reference_sentences(F.col("text_before")).alias("s")), F.struct(F.lit("clause").alias("kind"), T.clauses(F.col("text_before")).alias("s")))
    return rows.select("row_id", F.explode(kinds).alias("k")).select("row_id", "k.kind", F.posexplode("k.s").alias("n", "sentence"))


@_add("o32_definitions_in_text")
def _o32(spark, folder):
    rows = spread(_extracted(spark, folder)).withColumn("_keys", S.symbol_keys("equation"))
    context = T.context(F.col("section"), F.col("text_before"), F.col("text_after"))
    return rows.select("row_id", F.explode(S.definitions(context, F.col("_keys"))).alias("symbol", "definition")).where("definition <> ''")


# ---------------------------------------------------------------- joins


@_add("o36_pairs", f"SELECT l.arxiv_id, l.row_id AS left_id, r.row_id AS right_id FROM {_TOP} l JOIN {_TOP} r ON l.arxiv_id = r.arxiv_id AND l.place < r.place")
def _o36(spark, folder):
    return R.unordered_pairs(_top(spark, folder).select(DOC, "row_id", "place"), DOC, "place").select(DOC, F.col("l.row_id").alias("left_id"), F.col("r.row_id").alias("right_id"))


@_add("o37_reconcile")
def _o37(spark, folder):
    shaped = _extracted(spark, folder).select(F.col(DOC).alias("document"), F.col("row_id").cast("int").alias("ord"), F.col(LABEL), L.base_label(F.col(LABEL)).alias("base"), "equation", M.garbled(F.col("equation")).alias("garbled"), "equation_text_source")
    # each source keeps the first seven formulas of a document, as it does when it is read alone
    pdf, html = (R.top_k(shaped.where(c), "document", ["ord"]).drop("equation_text_source", "place") for c in ("equation_text_source <> 'html'", "equation_text_source = 'html'"))
    return M.match(pdf, html)


@_add("o38_override", f"""SELECT e.row_id, coalesce(nullif(d.equation, ''), e.equation) AS equation FROM equations e LEFT JOIN (SELECT arxiv_id, {_N} AS label, min_by(equation, rec_id) AS equation FROM dataset GROUP BY 1, 2) d
      ON e.arxiv_id = d.arxiv_id AND {_N.replace('eq_number', 'e.eq_number')} = d.label""")
def _o38(spark, folder):
    other = table(spark, folder, "dataset").groupBy(DOC, L.normalize_label(F.col(LABEL)).alias(LABEL)).agg(F.min_by("equation", "rec_id").alias("equation"))
    return R.override_text(table(spark, folder, "equations").select("row_id", DOC, LABEL, "equation"), other, DOC, LABEL, "equation", []).select("row_id", "equation")


@_add("o39_between", f"""SELECT g.arxiv_id, g.after_number, count(*) AS crossing FROM (SELECT arxiv_id, coalesce(lag(n) OVER (PARTITION BY arxiv_id ORDER BY n), 0) AS after_number, n AS before_number FROM (SELECT DISTINCT arxiv_id, CASE WHEN regexp_full_match({_B}, '\\d+') THEN try_cast({_B} AS INTEGER) END AS n FROM equations) WHERE n IS NOT NULL) g
      JOIN relations r ON r.arxiv_id = g.arxiv_id AND regexp_full_match(r.src, '\\d+') AND regexp_full_match(r.dst, '\\d+') AND try_cast(r.src AS INTEGER) <= g.after_number AND try_cast(r.dst AS INTEGER) >= g.before_number WHERE g.before_number - g.after_number > 1 GROUP BY 1, 2""")
def _o39(spark, folder):
    gaps = R.numbering_gaps(table(spark, folder, "equations"), DOC, LABEL)
    number = lambda c: F.when(F.col(c).rlike(r"^\d+$"), F.col(c).try_cast("int"))
    edges = table(spark, folder, "relations").select(DOC, number("src").alias("s"), number("dst").alias("d")).where("s is not null and d is not null").groupBy(DOC, "s", "d").count()
    joined = gaps.join(edges, DOC).where("s <= after_number and d >= before_number")
    return joined.groupBy(DOC, "after_number").agg(F.sum("count").alias("crossing"))


@_add("o40_missing_edges", f"""SELECT a.arxiv_id, a.eq_number AS src, b.eq_number AS dst FROM {_RECORDS} a JOIN {_RECORDS} b ON a.arxiv_id = b.arxiv_id AND a.eq_number <> b.eq_number
      WHERE NOT EXISTS (SELECT 1 FROM relations r WHERE r.arxiv_id = a.arxiv_id AND r.src = a.eq_number AND r.dst = b.eq_number)""")
def _o40(spark, folder):
    first = R.first_by_label(table(spark, folder, "dataset"), DOC, LABEL, ["rec_id"])
    nodes = R.top_k(first.withColumn("_key", L.label_key(F.col(LABEL))), DOC, ["_key", "rec_id"])
    return R.missing_edges(nodes, table(spark, folder, "relations"), DOC, LABEL, "src", "dst")


_LABELS = "(SELECT DISTINCT arxiv_id, eq_number FROM " + _RECORDS.replace(" WHERE place <= 7", "") + ")"
_ENDS = f"(SELECT DISTINCT r.arxiv_id, src, dst FROM relations r JOIN {_LABELS} a ON r.arxiv_id = a.arxiv_id AND r.src = a.eq_number JOIN {_LABELS} b ON r.arxiv_id = b.arxiv_id AND r.dst = b.eq_number WHERE src <> dst)"


@_add("o40_missing_counts", f"""SELECT l.arxiv_id, l.eq_number, n - 1 - coalesce(o.c, 0) AS missing_out, n - 1 - coalesce(i.c, 0) AS missing_in FROM {_LABELS} l JOIN (SELECT arxiv_id, count(*) AS n FROM {_LABELS} GROUP BY 1) USING (arxiv_id)
      LEFT JOIN (SELECT arxiv_id, src AS eq_number, count(*) AS c FROM {_ENDS} GROUP BY 1, 2) o USING (arxiv_id, eq_number) LEFT JOIN (SELECT arxiv_id, dst AS eq_number, count(*) AS c FROM {_ENDS} GROUP BY 1, 2) i USING (arxiv_id, eq_number)""")
def _o40c(spark, folder):
    first = R.first_by_label(table(spark, folder, "dataset"), DOC, LABEL, ["rec_id"])
    return R.missing_counts(first, table(spark, folder, "relations"), DOC, LABEL, "src", "dst")


# ---------------------------------------------------------------- aggregates


@_add("o41_pieces", "SELECT row_id, regexp_replace(trim(regexp_replace(string_agg(x, ' ' ORDER BY k), '\\s+', ' ', 'g')), ' ?= ?', '=', 'g') AS formula FROM (SELECT row_id, generate_subscripts(identifier_candidates, 1) AS k, unnest(identifier_candidates) AS x FROM equations) GROUP BY row_id")
def _o41(spark, folder):
    return R.join_pieces(table(spark, folder, "equations").select("row_id", F.posexplode("identifier_candidates").alias("n", "x")), ["row_id"], "n", "x")


@_add("o42_blank_repeated", "SELECT rec_id, CASE WHEN coalesce(lower(trim(meaning)), '') <> '' AND count(*) OVER (PARTITION BY arxiv_id, lower(trim(meaning))) >= 4 THEN '' ELSE meaning END AS meaning FROM dataset")
def _o42(spark, folder):
    return R.blank_repeated(table(spark, folder, "dataset").select("rec_id", DOC, "meaning"), DOC, "meaning").select("rec_id", "meaning")


@_add("o43_set_quality", f"SELECT arxiv_id, round(avg({_QUALITY}), 6) AS quality, count(*) AS n FROM {_TOP} GROUP BY 1")
def _o43(spark, folder):
    return R.set_quality(_top(spark, folder), DOC, "place")


def _sources(spark, folder):
    """A document's formulas from PDF and from HTML, each with their place."""
    rows = _extracted(spark, folder).withColumn("_key", L.label_key(F.col(LABEL))).withColumn("document", F.col(DOC))
    return tuple(R.top_k(rows.where(c), "document", ["_key", "row_id"]).drop("_key") for c in (F.col("equation_order_source") == "pdf", F.col("equation_order_source") == "html"))


@_add("o43_set_similarity")
def _o43s(spark, folder):
    pdf, html = _sources(spark, folder)
    return M.set_similarity(pdf, html)


@_add("o43_arbitrate")
def _o43a(spark, folder):
    pdf, html = _sources(spark, folder)
    judged = [R.set_quality(x, "document", "place").join(x.groupBy("document").agg(F.sum(M.garbled(F.col("equation")).cast("int")).alias("garbled")), "document") for x in (pdf, html)]
    return M.arbitrate(*judged, M.set_similarity(pdf, html).drop("pairs"))


@_add("o44_status", f"""SELECT arxiv_id, CAST(count(*) AS INTEGER) AS equation_count, string_agg({_N}, '|' ORDER BY {_ORDER}) AS labels, coalesce(sum(CASE WHEN {_NOISY} THEN 1 ELSE 0 END) > 0, false) AS noisy, coalesce(sum(CASE WHEN trim(coalesce(equation, '')) = '' THEN 1 ELSE 0 END) > 0, false) AS empty FROM {_FIRST} GROUP BY 1""")
def _o44(spark, folder):
    keyed = _extracted(spark, folder).withColumn("_key", L.label_key(F.col(LABEL)))
    status = R.document_status(keyed, DOC, LABEL, "equation", ["_key", "row_id"])
    return status.select(DOC, "equation_count", F.array_join("labels", "|").alias("labels"), F.array_contains("findings", "noisy equation").alias("noisy"), F.array_contains("findings", "empty equation").alias("empty"))


@_add("o45_prefix", f"""SELECT arxiv_id, list_aggregate(b, 'string_agg', '|') = CASE WHEN contains(b[1], '.') THEN list_aggregate(list_transform(range(1, len(b) + 1), lambda x: regexp_replace(b[1], '\\.[^.]*$', '') || '.' || x), 'string_agg', '|')
      ELSE list_aggregate(list_transform(range(1, len(b) + 1), lambda x: CAST(x AS VARCHAR)), 'string_agg', '|') END AS complete FROM (SELECT arxiv_id, list({_B} ORDER BY {_ORDER}) AS b FROM {_FIRST} GROUP BY 1)""")
def _o45(spark, folder):
    keyed = _extracted(spark, folder).withColumn("_key", L.label_key(F.col(LABEL)))
    return R.document_status(keyed, DOC, LABEL, "equation", ["_key", "row_id"]).select(DOC, F.col("consecutive").alias("complete"))


# ---------------------------------------------------------------- windows


@_add("o46_first_by_label", f"SELECT row_id, arxiv_id FROM {_FIRST}")
def _o46(spark, folder):
    return _extracted(spark, folder).select("row_id", DOC)


@_add("o47_top", f"SELECT arxiv_id, row_id, place FROM {_TOP}")
def _o47(spark, folder):
    return _top(spark, folder).select(DOC, "row_id", "place")


_ENGINE = (
    f"round(CASE WHEN {_SQ('equation')} = '' THEN 0.0 ELSE greatest(0.0, least(1.0, 0.35 + CASE equation_confidence WHEN 'medium' THEN 0.08 WHEN 'low' THEN -0.08 ELSE 0 END + CASE WHEN contains(q, '\\') THEN 0.16 ELSE 0 END + CASE WHEN {_ANY('q', T.ENGINE_TOKENS)} THEN 0.16 ELSE 0 END"
    " + CASE WHEN contains(q, '=') THEN 0.08 ELSE 0 END + CASE WHEN length(replace(q, '{', '')) = length(replace(q, '}', '')) AND length(replace(q, '(', '')) = length(replace(q, ')', '')) AND length(replace(q, '[', '')) = length(replace(q, ']', '')) THEN 0.08 ELSE -0.14 END"
    " - CASE WHEN regexp_matches(q, '[=+\\-(,]$') OR regexp_matches(q, '^[)\\]},]') THEN 0.24 ELSE 0 END - CASE WHEN regexp_matches(q, '[\\x00-\\x08\\x0b-\\x1f]') THEN 0.18 ELSE 0 END"
    " - CASE WHEN regexp_matches(q, '(?i)\\b(where|therefore|using|represented by|according to|shown in)\\b') THEN 0.16 ELSE 0 END - CASE WHEN len(regexp_extract_all(q, '[A-Za-z]{4,}')) > 12 THEN 0.16 ELSE 0 END - CASE WHEN length(q) < 8 THEN 0.2 ELSE 0 END)) END, 4)")
_PRIORITY = "CASE equation_text_source WHEN 'html' THEN 0 WHEN 'latex_ocr' THEN 1 ELSE 2 END"


@_add("o48_best_engine", f"SELECT row_id, quality FROM (SELECT *, row_number() OVER (PARTITION BY arxiv_id, {_N} ORDER BY quality DESC, {_PRIORITY}, row_id) AS r FROM (SELECT *, {_ENGINE} AS quality FROM (SELECT *, {_SQ('equation')} AS q FROM equations WHERE {_N} <> ''))) WHERE r = 1")
def _o48(spark, folder):
    rows = table(spark, folder, "equations").withColumn("_p", F.when(F.col("equation_text_source") == "html", 0).when(F.col("equation_text_source") == "latex_ocr", 1).otherwise(2))
    return R.best_candidate(rows, DOC, LABEL, "equation", "equation_confidence", "_p", ["row_id"]).select("row_id", "quality")


@_add("o49_gaps", f"SELECT arxiv_id, p AS after_number, n AS before_number, n - p - 1 AS missing FROM (SELECT arxiv_id, n, coalesce(lag(n) OVER (PARTITION BY arxiv_id ORDER BY n), 0) AS p FROM (SELECT DISTINCT arxiv_id, CASE WHEN regexp_full_match({_B}, '\\d+') THEN try_cast({_B} AS INTEGER) END AS n FROM equations) WHERE n IS NOT NULL) WHERE n - p > 1")
def _o49(spark, folder):
    return R.numbering_gaps(table(spark, folder, "equations"), DOC, LABEL)


@_add("o49_recovered")
def _o49h(spark, folder):
    # labels of formulas of low confidence are hidden, and found again where they make a gap
    hidden = _extracted(spark, folder).withColumn(LABEL, F.when(F.col("equation_confidence") == "low", "").otherwise(F.col(LABEL)))
    return D.parse_html(spread(_pages(hidden)), k=1_000_000).select("document", LABEL, "equation", "section")


@_add("o49_renumber", f"""SELECT row_id, CASE WHEN fix THEN CAST(k AS VARCHAR) ELSE eq_number END AS new_label FROM (SELECT *, w = 1 AND lo = 1 AND hi > ds AS fix, row_number() OVER (PARTITION BY arxiv_id ORDER BY row_id) AS k FROM (SELECT *, min(CASE WHEN n IS NULL THEN 0 ELSE 1 END) OVER (PARTITION BY arxiv_id) AS w,
      min(n) OVER (PARTITION BY arxiv_id) AS lo, max(n) OVER (PARTITION BY arxiv_id) AS hi, count(DISTINCT n) OVER (PARTITION BY arxiv_id) AS ds FROM (SELECT *, CASE WHEN regexp_full_match({_N}, '[+-]?\\d+') THEN try_cast({_N} AS INTEGER) END AS n FROM {_FIRST}))) WHERE NOT coalesce(fix, false) OR k <= 7""")
def _o49r(spark, folder):
    return R.renumber(_extracted(spark, folder), DOC, LABEL, ["row_id"]).select("row_id", "new_label")


@_add("o50_segments", f"SELECT row_id, CAST(sum(CASE WHEN NOT regexp_matches({_SQ('text_after')}, '^(=|\\+|-|\\\\pm|\\\\mp|\\\\left|\\\\right|\\\\begin|\\\\\\\\|where|and)') THEN 1 ELSE 0 END) OVER (PARTITION BY arxiv_id ORDER BY row_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS segment FROM equations")
def _o50(spark, folder):
    starts = R.starts_expression(F.col("text_after")) & ~T.squash(F.col("text_after")).rlike("^(?:where|and)")
    return R.segments(table(spark, folder, "equations"), DOC, ["row_id"], starts).select("row_id", "segment")


@_add("o51_neighbours", """SELECT row_id, coalesce(right(string_agg(nullif(equation, ''), ' ' ORDER BY row_id) OVER (PARTITION BY arxiv_id ORDER BY row_id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING), 2000), '') AS above,
      coalesce(left(string_agg(nullif(equation, ''), ' ' ORDER BY row_id) OVER (PARTITION BY arxiv_id ORDER BY row_id ROWS BETWEEN 1 FOLLOWING AND 5 FOLLOWING), 2000), '') AS below FROM equations""")
def _o51(spark, folder):
    return R.neighbours(table(spark, folder, "equations"), DOC, ["row_id"], "equation").select("row_id", "above", "below")


_HINT = "(?i)\\b(?:defined as|given by|written as|expressed as|called|known as|denoted by|we define|we introduce|takes the form|is described by|are described by|reads?|can be written|can be expressed)\\b|\\bwhere\\b.{0,90}\\bdenotes?\\b|:\\s*$"


@_add("o52_ranked_sentences", f"""SELECT row_id, side, distance, sentence, rank, place FROM (SELECT *, CAST(row_number() OVER (PARTITION BY row_id ORDER BY rank DESC, distance, CASE WHEN side = 'before' THEN 0 ELSE 1 END) AS INTEGER) AS place FROM (SELECT row_id, side, CAST(k - 1 AS INTEGER) AS distance, sentence,
      round(greatest(0.0, 1.0 - 0.25 * (k - 1)) + CASE WHEN regexp_matches(sentence, '{_HINT}') THEN 1.0 ELSE 0.0 END + CASE WHEN regexp_matches(sentence, ':\\s*$') THEN 0.45 ELSE 0.0 END
      + CASE WHEN regexp_matches(sentence, '(?i)\\b(?:equation|relation|function|operator|matrix|state|rule)\\b') THEN 0.15 ELSE 0.0 END + CASE WHEN side = 'before' THEN 0.1 ELSE 0.0 END
      - CASE WHEN regexp_matches(sentence, '(?i)\\b(?:figure|fig\\.|table|tab\\.|appendix|app\\.|copyright|license|email|affiliation|doi|arxiv|section|sect\\.)\\b') THEN 0.8 ELSE 0.0 END - CASE WHEN regexp_matches(sentence, '(?i)\\b(?:eqs?|refs?|sections?)\\.?\\s*\\(?\\d') THEN 0.25 ELSE 0.0 END, 3) AS rank
      FROM (SELECT row_id, side, generate_subscripts(l, 1) AS k, unnest(l) AS sentence FROM (SELECT row_id, 'before' AS side, list_reverse({_PHRASES('text_before')})[1:5] AS l FROM equations UNION ALL SELECT row_id, 'after', ({_PHRASES('text_after')})[1:5] FROM equations))
      WHERE NOT (regexp_matches(sentence, '(?i)\\b(?:patents?|copyright|licen[sc]e|all rights reserved|arxiv:|doi:|e-?mail|affiliation)\\b') OR len(regexp_extract_all(sentence, '\\b[A-Z]{{3,}}\\b')) >= 4))) WHERE place <= 5""")
def _o52(spark, folder):
    return R.rank_sentences(table(spark, folder, "equations"), ["row_id"], "text_before", "text_after").select("row_id", "side", "distance", "sentence", "rank", "place")


@_add("o53_select_meaning", f"""SELECT arxiv_id, eq_number, cand_id FROM (SELECT *, row_number() OVER (PARTITION BY arxiv_id, eq_number ORDER BY tier, CASE WHEN stage = 'local cue' THEN 0 ELSE 1 END, CASE WHEN embedding_selected THEN 0 ELSE 1 END, distance, score DESC NULLS LAST, cand_id) AS r FROM
      (SELECT *, row_number() OVER (PARTITION BY arxiv_id, eq_number, lower(phrase) ORDER BY tier, distance, cand_id) AS q FROM candidates WHERE {_VALID}) WHERE q = 1) WHERE r = 1""")
def _o53(spark, folder):
    return R.select_candidate(table(spark, folder, "candidates"), DOC, LABEL).select(DOC, LABEL, "cand_id")


@_add("o54_rerank", """SELECT arxiv_id, eq_number, cand_id FROM (SELECT *, row_number() OVER w AS r, lead(embedding_score) OVER w AS nxt FROM (SELECT * FROM (SELECT *, min(tier) OVER (PARTITION BY arxiv_id, eq_number) AS t FROM candidates) WHERE tier = t AND embedding_score IS NOT NULL)
      WINDOW w AS (PARTITION BY arxiv_id, eq_number ORDER BY embedding_score DESC, cand_id)) WHERE r = 1 AND embedding_score >= 0.35 AND (nxt IS NULL OR round(embedding_score - nxt, 6) >= 0.03)""")
def _o54(spark, folder):
    return R.rerank_by_embedding(table(spark, folder, "candidates"), DOC, LABEL).select(DOC, LABEL, "cand_id")


@_add("o54_similar_vectors", """SELECT a, b, similarity FROM (SELECT a, b, similarity, row_number() OVER (PARTITION BY a ORDER BY similarity DESC, b) AS r FROM (SELECT q.vec_id AS a, e.vec_id AS b, round(list_dot_product(CAST(q.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[]))
      / (sqrt(list_dot_product(CAST(q.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[]))) * sqrt(list_dot_product(CAST(e.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[])))), 6) AS similarity
      FROM embeddings q, embeddings e WHERE q.vec_id % 20 = 0 AND q.vec_id <> e.vec_id)) WHERE r <= 3""")
def _o54v(spark, folder):
    rows = table(spark, folder, "embeddings")
    asked = rows.where("vec_id % 20 = 0").select(F.col("vec_id").alias("a"), F.col("embedding").alias("v"))
    return R.nearest(asked, rows.select(F.col("vec_id").alias("b"), F.col("embedding").alias("w")), k=3)


_EACH = "(SELECT rec_id, arxiv_id, k AS symbol, coalesce(trim(symbols[k]), '') AS definition FROM (SELECT rec_id, arxiv_id, symbols, unnest(map_keys(symbols)) AS k FROM dataset))"
_OWN = f"""(SELECT arxiv_id, symbol, min_by(definition, rec_id) AS own FROM {_EACH} WHERE definition NOT IN ('', 'summation index', 'differential variable', 'Lorentz index', 'time', 'imaginary unit', 'Pauli matrix', 'Dirac gamma matrix', 'probability distribution')
      AND NOT regexp_matches(definition, '(?i)\\b(?:of|between|in|with) (?:eq|the (?:above|previous))\\b') GROUP BY 1, 2)"""


@_add("o55_inherit", f"""SELECT s.rec_id, s.symbol, coalesce(nullif(s.definition, ''), f.own, g.own, '') AS definition FROM {_EACH} s LEFT JOIN {_OWN} f ON s.arxiv_id = f.arxiv_id AND s.symbol = f.symbol
      LEFT JOIN {_OWN} g ON s.arxiv_id = g.arxiv_id AND nullif(regexp_extract(s.symbol, '^(.+)_[A-Za-z0-9]{{1,4}}$', 1), '') = g.symbol AND regexp_matches(lower(g.own), '(?:operator|matrix|state|function|hamiltonian|tensor|vector|field|parameter|density|energy|frequency|part)s?$')""")
def _o55(spark, folder):
    each = table(spark, folder, "dataset").select("rec_id", DOC, F.explode("symbols").alias("symbol", "definition"))
    return R.inherit_definitions(each, DOC, ["rec_id"]).select("rec_id", "symbol", "definition")


# ---------------------------------------------------------------- relations, meaning, provenance


@_add("o56_graph")
def _o56(spark, folder):
    return _graph(spark, folder)


@_add("o56_similarity", f"""SELECT left_id, right_id, CASE WHEN len(a) = 0 OR len(b) = 0 THEN 0.0 ELSE round(len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))), 6) END AS similarity FROM (SELECT l.row_id AS left_id, r.row_id AS right_id,
      list_distinct(regexp_extract_all(regexp_replace(lower(coalesce(l.equation, '')), '\\\\[a-z]+', ' ', 'g'), '[a-z][a-z0-9]*|[0-9]+|[=+\\-*/]')) AS a, list_distinct(regexp_extract_all(regexp_replace(lower(coalesce(r.equation, '')), '\\\\[a-z]+', ' ', 'g'), '[a-z][a-z0-9]*|[0-9]+|[=+\\-*/]')) AS b
      FROM {_TOP} l JOIN {_TOP} r ON l.arxiv_id = r.arxiv_id AND l.place < r.place)""")
def _o56s(spark, folder):
    top = _top(spark, folder).withColumn("tokens", T.relation_tokens(F.col("equation"))).select(DOC, "row_id", "place", "tokens")
    return R.unordered_pairs(top, DOC, "place").select(F.col("l.row_id").alias("left_id"), F.col("r.row_id").alias("right_id"), F.round(T.jaccard(F.col("l.tokens"), F.col("r.tokens")), 6).alias("similarity"))


@_add("o56_inverse", """SELECT edge_id, CASE relation_type WHEN 'substitution' THEN 'substitution_target' WHEN 'substitution_target' THEN 'substitution' WHEN 'derivation_dependency' THEN 'used_by_derivation' WHEN 'used_by_derivation' THEN 'derivation_dependency'
      WHEN 'definition_usage' THEN 'uses_definition' WHEN 'uses_definition' THEN 'definition_usage' ELSE relation_type END AS relation_type,
      CASE WHEN relation_type = 'substitution' THEN 'receives substitution from' WHEN relation_type = 'substitution_target' THEN 'substituted into' WHEN relation_type = 'derivation_dependency' AND description = 'derived from' THEN 'used in derivation'
      WHEN relation_type = 'used_by_derivation' AND description = 'used in derivation' THEN 'derived from' WHEN relation_type = 'definition_usage' THEN regexp_replace(description, '^defines ', 'uses definition of ')
      WHEN relation_type = 'uses_definition' THEN regexp_replace(description, '^uses definition of ', 'defines ') ELSE description END AS description FROM (SELECT *, row_number() OVER (PARTITION BY arxiv_id, src, dst ORDER BY edge_id) AS r FROM relations) WHERE r = 1""")
def _o56i(spark, folder):
    kind = F.col("relation_type")
    return _edges_of(spark, folder).select("edge_id", G.inverse_type(kind).alias("relation_type"), G.inverse_description(kind, F.col("description")).alias("description"))


@_add("o57_roles", """SELECT row_id, CASE WHEN regexp_matches(e, '\\[[^\\]]+,[^\\]]+\\]\\s*=') THEN 'commutation relation' WHEN regexp_matches(e, '\\\\(leq?|geq?|ll|gg)\\b|<=|>=') THEN 'inequality' WHEN regexp_matches(e, '\\\\partial|\\\\frac\\{d') AND (contains(p, 'master equation') OR contains(p, 'lindblad')) THEN 'master equation'
      WHEN regexp_matches(e, '\\\\partial|\\\\frac\\{d|\\\\dot') THEN 'differential equation' WHEN regexp_matches(p, 'recursion|recurrence|iterate|update rule') THEN 'recurrence relation' END AS role FROM (SELECT row_id, replace(coalesce(equation, ''), '−', '-') AS e, lower(concat_ws(' ', text_before, text_after, section)) AS p FROM equations)""")
def _o57(spark, folder):
    return table(spark, folder, "equations").select("row_id", T.equation_role(F.col("equation"), F.col("text_before"), F.col("text_after"), F.col("section")).alias("role"))


@_add("o57_cues")
def _o57c(spark, folder):
    return E.cue_candidates(table(spark, folder, "equations"), ["row_id"]).where(T.valid_phrase(F.col("phrase")))


@_add("o57_meaning")
def _o57m(spark, folder):
    return E.meanings(spread(_extracted(spark, folder)), ["row_id"], DOC).drop(DOC)


@_add("o58_trails", """SELECT rec_id, k AS method, len(audit_trail[k]) AS lines FROM (SELECT rec_id, audit_trail, unnest(map_keys(audit_trail)) AS k FROM dataset)""")
def _o58(spark, folder):
    each = table(spark, folder, "dataset").select("rec_id", F.explode("audit_trail").alias("method", "v"))
    return each.select("rec_id", "method", F.size("v").cast("long").alias("lines"))


@_add("o58_built_trails", f"""SELECT row_id, 'extract_symbol_identifiers' AS method, CAST(len(identifier_candidates) AS INTEGER) AS lines, 'found ' || identifier_candidates[1] AS first FROM equations WHERE len(identifier_candidates) > 0
      UNION ALL SELECT row_id, CASE WHEN equation_order_source = 'html' THEN 'parse_html' ELSE 'parse_pdf' END, 1, 'label (' || eq_number || ')' FROM equations
      UNION ALL SELECT row_id, 'extract_meaning', 1, CASE WHEN coalesce(section, '') = '' THEN 'no meaning extracted' WHEN length({_SQ('section')}) <= 220 THEN {_SQ('section')} ELSE rtrim(left({_SQ('section')}, 217)) || '...' END FROM equations""")
def _o58t(spark, folder):
    rows = table(spark, folder, "equations").select("row_id", F.explode(P.trail(F.col("equation_order_source"), F.col(LABEL), F.col("identifier_candidates"), F.col("section"))).alias("method", "l"))
    return rows.select("row_id", "method", F.size("l").alias("lines"), F.get("l", F.lit(0)).alias("first"))


@_add("o58_trail_problems", """SELECT rec_id, len(list_filter(map_keys(audit_trail), lambda k: k NOT IN (""" + ", ".join(f"'{m}'" for m in P.METHODS) + """))) > 0 AS unknown_method, len(list_filter(map_values(audit_trail), lambda v: len(v) = 0)) > 0 AS empty_entry,
      len(list_filter(flatten(map_values(audit_trail)), lambda x: length(x) > 400)) > 0 AS long_line FROM dataset""")
def _o58p(spark, folder):
    rows = table(spark, folder, "dataset").select("rec_id", P.trail_problems(F.col("audit_trail")).alias("p"))
    return rows.select("rec_id", *(F.array_contains("p", x).alias(x.replace(" ", "_")) for x in ("unknown method", "empty entry", "long line")))


@_add("o58_violations", """SELECT rec_id, problem FROM (SELECT rec_id, unnest(list_filter([CASE WHEN coalesce(trim(equation), '') = '' THEN 'empty equation' END, CASE WHEN len(list_filter(map_values(relations), lambda r: coalesce(r.grade, '') NOT IN ('none', 'strong', 'potential'))) > 0 THEN 'unknown grade' END,
      CASE WHEN list_contains(map_keys(relations), eq_number) THEN 'relation to itself' END, CASE WHEN len(list_filter(labels, lambda x: x <> eq_number AND NOT list_contains(map_keys(relations), x))) > 0 THEN 'missing relation' END,
      CASE WHEN len(list_filter(map_keys(relations), lambda x: NOT list_contains(labels, x))) > 0 THEN 'relation to an unknown label' END], lambda p: p IS NOT NULL)) AS problem FROM dataset JOIN (SELECT arxiv_id, list(DISTINCT eq_number) AS labels FROM dataset GROUP BY 1) USING (arxiv_id))""")
def _o58v(spark, folder):
    return P.violations(table(spark, folder, "dataset"))


def queries() -> dict[str, Query]:
    """Name to query; a query takes the session and a data folder."""
    return {name: build for name, (build, _) in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    """Name to SQL, for the queries that have a twin."""
    return {name: sql for name, (_, sql) in _QUERIES.items() if sql}
