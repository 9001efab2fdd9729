"""Sources and sinks: id lists, cached pages, HTML, labelled Markdown, layout text and tokens, nested JSON."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillgraph.functions import labels as L
from quillgraph.functions import latexify as X
from quillgraph.functions import text as T
from quillgraph.operators import rows as R


def scan_ids(spark: SparkSession, path: str) -> DataFrame:
    """``(ord, id)`` of the ids in a text file, in its order; comments, blanks and other lines are left out."""
    lines = spark.read.text(path).select("value", F.monotonically_increasing_id().alias("ord"))
    return lines.select("ord", T.clean_id(F.col("value")).alias("id")).where("id is not null")


def scan_html(spark: SparkSession, folder: str) -> DataFrame:
    """``(path, html)`` of cached pages that are converted documents by their first 50,000 characters."""
    pages = spark.read.text(f"{folder}/*.html", wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("html"))
    return pages.where(T.document_marker(F.col("html")))


def scan_pdf(spark: SparkSession, folder: str) -> DataFrame:
    """``(path, content, length)`` of cached PDF files that begin as such; decoding them is left to a converter."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.pdf").load(folder)
    return files.where(F.substring(F.col("content"), 1, 4) == F.lit(b"%PDF")).select("path", "content", "length")


# ---------------------------------------------------------------- HTML


class _Page(HTMLParser):
    """Flattens a page into events: headings, prose blocks, and rows of display tables with their math and label."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.events: list[dict] = []
        self.stack: list[tuple[str, str]] = []
        self.row: dict | None = None
        self.block: list[str] | None = None
        self.heading: list[str] | None = None
        self.note: list[str] | None = None
        self.number: list[str] | None = None
        self.names: list[str] | None = None
        self.table = ""

    def handle_starttag(self, tag, attrs):
        attrs = dict(attrs)
        classes = attrs.get("class") or ""
        if tag == "table":
            self.table = attrs.get("id") or ""
        if tag == "tr":
            self.row = {"kind": "row", "math": [], "label": "", "names": [], "table": self.table}
        elif tag == "math" and self.row is not None:
            if attrs.get("alttext"):
                self.row["math"].append(attrs["alttext"])
                self.row["_alt"] = True
        elif tag == "annotation" and attrs.get("encoding") == "application/x-tex" and self.row is not None:
            self.note = []
        elif tag == "mi" and self.row is not None:
            self.names = []
        elif tag in ("h2", "h3", "h4", "h5", "h6"):
            self.heading = []
        elif tag in ("p", "div") and self.row is None and "ltx_equation" not in classes:
            self._flush()
            self.block = []
        if "ltx_tag_equation" in classes or "ltx_eqn_num" in classes or "ltx_eqn_eqno" in classes:
            self.number = []
            self.stack.append((tag, "number"))
        else:
            self.stack.append((tag, ""))

    def handle_endtag(self, tag):
        while self.stack:
            name, role = self.stack.pop()
            if role == "number" and self.number is not None and self.row is not None:
                found = re.search(r"\(\s*(\d+(?:\.\d+)*(?:[A-Za-z](?:\s*[-–]\s*[A-Za-z])?)?)\s*\)", "".join(self.number))
                if found and not self.row["label"]:
                    self.row["label"] = found[1]
                self.number = None
            if name == tag:
                break
        if tag == "annotation" and self.note is not None and self.row is not None:
            if self.row.pop("_alt", False):
                self.row["math"].pop()  # the annotation says it better than the alternative text
            self.row["math"].append("".join(self.note))
            self.note = None
        elif tag == "math" and self.row is not None:
            self.row.pop("_alt", None)
        elif tag == "mi" and self.names is not None and self.row is not None:
            self.row["names"].append("".join(self.names))
            self.names = None
        elif tag == "tr" and self.row is not None:
            if self.row["math"]:
                self.events.append(self.row)
            self.row = None
        elif tag in ("h2", "h3", "h4", "h5", "h6") and self.heading is not None:
            self.events.append({"kind": "heading", "text": " ".join("".join(self.heading).split())})
            self.heading = None
        elif tag in ("p", "div"):
            self._flush()

    def _flush(self):
        if self.block is not None:
            text = " ".join("".join(self.block).split())
            if text:
                self.events.append({"kind": "text", "text": text})
        self.block = None

    def handle_data(self, data):
        for sink in (self.number, self.note, self.names, self.heading, None if self.row is not None else self.block):
            if sink is not None:
                sink.append(data)


def html_events(html: str) -> list[dict]:
    """Events of a page in document order."""
    page = _Page()
    page.feed(html or "")
    page.close()
    page._flush()
    return page.events


def recover_labels(found: DataFrame) -> DataFrame:
    """``found(document, ord, eq_number, ...)`` with labels for unlabelled formulas that stand in a gap of the numbering.

    A gap takes as many as it misses, in their order; the gap ahead of the first label takes the last ones before it.
    """
    number = L.base_label(F.col("eq_number")).try_cast("int")
    before = Window.partitionBy("document").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    placed = found.withColumn("_last", F.coalesce(F.last(number, ignorenulls=True).over(before), F.lit(0)))
    gaps = R.numbering_gaps(found.where("eq_number <> ''"), "document", "eq_number")
    lone = placed.where("eq_number = ''").select("document", F.col("ord").alias("position"), F.col("_last").alias("after_number"))
    named = R.recover_gaps(gaps, lone, "document").select("document", F.col("position").alias("ord"), F.col("number").cast("string").alias("_new"))
    return placed.join(named, ["document", "ord"], "left").withColumn("eq_number", F.coalesce("_new", "eq_number")).drop("_new", "_last")


def parse_html(pages: DataFrame, k: int = R.PER_DOCUMENT, recover: bool = True) -> DataFrame:
    """Numbered formulas of pages ``(document, html)``: the first ``k`` labels in natural order, first of each label.

    Returns ``(document, eq_number, ord, equation, text_before, text_after, section, identifier_candidates, table_id)``.
    Rows of a table belong to the label among them; unlabelled rows continue the label above or, ahead of the first
    label, the one below. Formulas without a label that stand in a gap of the numbering get the missing labels unless
    ``recover`` is off. Null pages give nothing.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["document", "ord", "label", "pieces", "names", "before", "after", "section", "table_id"]
        for batch in batches:
            out = []
            for document, html in zip(batch["document"], batch["html"]):
                section, prose, groups, table = "Unknown Section", "", [], None
                for e in html_events(html):
                    if e["kind"] == "heading":
                        section = e["text"]
                    elif e["kind"] == "text":
                        prose = f"{prose} {e['text']}"[-2000:] if prose else e["text"][-2000:]
                        if groups and len(groups[-1]["after"]) < 2000:
                            groups[-1]["after"] += (" " if groups[-1]["after"] else "") + e["text"]
                        table = None
                    else:
                        same = groups and table == (e["table"] or None) and table is not None
                        if same and not (e["label"] and groups[-1]["label"]):
                            groups[-1]["pieces"] += e["math"]
                            groups[-1]["names"] += e["names"]
                            groups[-1]["label"] = groups[-1]["label"] or e["label"]
                        else:
                            groups.append({"label": e["label"], "pieces": list(e["math"]), "names": list(e["names"]), "before": prose, "after": "", "section": section, "table": e["table"]})
                        table = e["table"] or None
                out += [(document, n, g["label"], " ".join(g["pieces"]), g["names"], g["before"], g["after"][:2000], g["section"], g["table"]) for n, g in enumerate(groups)]
            yield pd.DataFrame(out, columns=columns)

    schema = "document string, ord int, label string, pieces string, names array<string>, before string, after string, section string, table_id string"
    rows = pages.where("html is not null").select("document", "html").mapInPandas(run, schema)
    math = T.squash(F.regexp_replace(F.replace("pieces", F.lit("%"), F.lit(" ")), r"\\displaystyle(?![A-Za-z])", " "))
    found = rows.select("document", "ord", F.when(F.col("label") == "", F.regexp_extract("table_id", r"(?:^|\.)E(\d{1,2})$", 1)).otherwise(F.col("label")).alias("eq_number"),
                        F.regexp_replace(math, r" ?= ?", "=").alias("equation"), F.col("before").alias("text_before"), F.col("after").alias("text_after"), "section",
                        F.array_distinct(F.filter(F.transform("names", T.canonical_identifier), lambda x: x != "")).alias("identifier_candidates"), "table_id")
    kept = found.where(T.looks_like_equation(F.col("equation")))
    kept = recover_labels(kept) if recover else kept
    first = R.first_by_label(kept, "document", "eq_number", ["ord"])
    keyed = first.withColumn("eq_number", L.normalize_label(F.col("eq_number"))).withColumn("_key", L.label_key(F.col("eq_number")))
    body = R.prefer_main_body(keyed, "document", F.lower(F.col("section")).rlike("^appendix"))
    return R.top_k(body, "document", ["_key", "ord"], k).drop("_key")


# ---------------------------------------------------------------- Markdown and layout text

_MARKDOWN = re.compile(
    r"\$\$(?P<a>.+?)\\tag\s*\{(?P<al>[^{}]+)\}\s*\$\$|\\\[(?P<b>.+?)\\tag\s*\{(?P<bl>[^{}]+)\}\s*\\\]|\\begin\{(?P<env>equation|align|gather)\*?\}(?P<c>.+?)\\tag\s*\{(?P<cl>[^{}]+)\}.*?\\end\{(?P=env)\*?\}"
    r"|(?:^|\n)[ \t]*(?:\\\[|\$\$)?(?P<d>[^\n]*?[=<>][^\n]*?)(?:\\\]|\$\$)?[ \t]*\((?P<dl>\d+(?:\.\d+)*[a-z]?)\)[ \t]*(?=\n|$)", re.S)


def markdown_formulas(texts: DataFrame, k: int = R.PER_DOCUMENT, window: int = 1200) -> DataFrame:
    """Labelled formulas of Markdown texts ``(document, text)``: tagged environments, displays and labelled lines.

    Returns ``(document, ord, eq_number, equation, text_before, text_after, section)``, first of each label, first
    ``k`` in order of position. Null and empty texts give nothing.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for document, text in zip(batch["document"], batch["text"]):
                for n, m in enumerate(_MARKDOWN.finditer(text)):
                    body, label = next((m[x], m[x + "l"]) for x in "abcd" if m[x] is not None)
                    body = " ".join(re.sub(r"\\(?:label|tag)\{[^{}]*\}|\\nonumber", " ", body).strip(" $,.;").split())
                    heads = re.findall(r"(?m)^#{1,6}\s+(.+?)\s*$", text[: m.start()])
                    out.append((document, n, label.strip(), body, " ".join(text[max(0, m.start() - window) : m.start()].split()), " ".join(text[m.end() : m.end() + window].split()), heads[-1] if heads else "Unknown Section"))
            yield pd.DataFrame(out, columns=["document", "ord", "eq_number", "equation", "text_before", "text_after", "section"])

    rows = texts.where("text is not null and text <> ''").select("document", "text").mapInPandas(
        run, "document string, ord int, eq_number string, equation string, text_before string, text_after string, section string")
    usable = (F.length("equation") >= 6) & T.any_token(F.col("equation"), T.MATH_TOKENS) & (F.regexp_count(F.regexp_replace("equation", r"\\[A-Za-z]+|\$[^$]*\$", " "), F.lit(r"[A-Za-z]{3,}")) < 8)
    return R.top_k(R.first_by_label(rows.where(usable), "document", "eq_number", ["ord"]), "document", ["ord"], k)


def layout_formulas(texts: DataFrame, k: int = R.PER_DOCUMENT, reach: int = 8) -> DataFrame:
    """Formulas of layout text ``(document, text)``: a line that ends in a label, with the math rows above it.

    A row joins from above while it is math and at most two blank rows lie between. Valid formulas have medium, only
    salvageable ones low confidence; other candidates are left out. Null and empty texts give nothing.
    """
    lines = texts.where("text is not null and text <> ''").select("document", F.posexplode(F.split("text", "\n")).alias("ord", "line"))
    marker = F.regexp_extract("line", r"\((\d+(?:\.\d+)*[a-z]?)\)\s*$", 1)
    shaped = lines.select("document", "ord", "line", marker.alias("eq_number"), F.trim(F.regexp_replace("line", r"\(\d+(?:\.\d+)*[a-z]?\)\s*$", "")).alias("math"))
    window = Window.partitionBy("document").orderBy("ord").rowsBetween(-reach, -1)
    formula = F.col("math").rlike(r"[=+\-*/^_\\∑∫√∂⟨⟩]") & (F.regexp_count("math", F.lit("[A-Za-z]{4,}")) <= 3) | (F.col("math") == "")
    state = F.struct(F.when(F.col("eq_number") != "", "label").when(F.col("math") == "", "blank").when(formula, "math").otherwise("prose").alias("kind"), F.col("math").alias("m"))
    above = shaped.withColumn("_above", F.reverse(F.collect_list(state).over(window))).where("eq_number <> ''")
    gathered = F.aggregate("_above", F.struct(F.lit(True).alias("open"), F.lit(0).alias("blanks"), F.array().cast("array<string>").alias("rows")), lambda acc, x: F.struct(
        (acc["open"] & (x["kind"].isin("math", "blank")) & (acc["blanks"] + F.when(x["kind"] == "blank", 1).otherwise(0) <= 2)).alias("open"),
        (acc["blanks"] + F.when(x["kind"] == "blank", 1).otherwise(0)).alias("blanks"),
        F.when(acc["open"] & (x["kind"] == "math"), F.concat(F.array(x["m"]), acc["rows"])).otherwise(acc["rows"]).alias("rows")))
    built = above.withColumn("_rows", gathered["rows"]).withColumn("equation", T.squash(F.array_join(F.concat("_rows", F.array("math")), " ")))
    judged = built.withColumn("equation_confidence", F.when(X.is_valid_formula(F.col("equation")), "medium").when(X.salvageable(F.col("equation")), "low")).where("equation_confidence is not null")
    first = R.first_by_label(judged, "document", "eq_number", ["ord"])
    return R.top_k(first, "document", ["ord"], k).select("document", "ord", "eq_number", "equation", "equation_confidence", "place")


def cluster_rows(tokens: DataFrame, tolerance: float = 7.0) -> DataFrame:
    """Add ``row`` to layout tokens ``(document, page, marker, x, cy, text)``: tokens on one line, found greedily.

    A token joins the first line whose running mean height is within ``tolerance``; tokens come by height, then
    position. Groups are the tokens near one marker, so they are small.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for document, page, marker, near in batch.itertuples(index=False):
                means: list[tuple[float, int]] = []
                for t in near:
                    hit = next((n for n, (total, count) in enumerate(means) if abs(total / count - t["cy"]) <= tolerance), len(means))
                    if hit == len(means):
                        means.append((0.0, 0))
                    means[hit] = means[hit][0] + t["cy"], means[hit][1] + 1
                    out.append((document, page, marker, t["x"], t["cy"], t["text"], hit))
            yield pd.DataFrame(out, columns=["document", "page", "marker", "x", "cy", "text", "row"])

    near = tokens.groupBy("document", "page", "marker").agg(F.array_sort(F.collect_list(F.struct("cy", "x", "text"))).alias("near"))
    return near.mapInPandas(run, "document string, page int, marker string, x double, cy double, text string, row int")


def geometry_formulas(tokens: DataFrame, tolerance: float = 7.0, reach: float = 38.0) -> DataFrame:
    """Formulas of layout tokens ``(document, page, width, x0, x1, cy, text)`` of blocks or XML.

    A marker is a label at the right of its column; the math tokens left of it, in its column and within ``reach`` of
    its height are gathered by a range join per page, put into lines and joined in order.
    """
    label = F.regexp_extract("text", r"^\((\d+(?:\.\d+)*[a-z]?)\)$", 1)
    column = F.when(F.col("x0") < F.col("width") / 2, 0).otherwise(1)
    shaped = tokens.withColumn("_label", label)
    markers = shaped.where((F.col("_label") != "") & ((F.col("x1") > 0.83 * F.col("width")) | F.col("x1").between(0.45 * F.col("width"), 0.55 * F.col("width")))).select(
        "document", "page", F.col("_label").alias("marker"), F.col("x0").alias("mx"), F.col("cy").alias("my"), F.when(F.col("x1") <= 0.55 * F.col("width"), 0).otherwise(1).alias("mcol"))
    math = shaped.where("_label = ''").where(F.col("text").rlike(r"[=+\-*/^_\\∑∫√∂⟨⟩0-9α-ωΑ-Ω]|^[A-Za-z]{1,3}$")).withColumn("_col", column)
    joined = markers.join(math, ["document", "page"]).where((F.abs(F.col("cy") - F.col("my")) <= reach) & (F.col("x0") < F.col("mx")) & ((F.col("mcol") == 1) | (F.col("_col") == 0)))
    # of two markers in reach a token belongs to the nearer one
    nearest = Window.partitionBy("document", "page", "x0", "cy", "text").orderBy(F.abs(F.col("cy") - F.col("my")), "marker")
    own = joined.withColumn("_r", F.row_number().over(nearest)).where("_r = 1").select("document", "page", "marker", F.col("x0").alias("x"), "cy", "text")
    rows = cluster_rows(own, tolerance)
    heights = rows.withColumn("_h", F.avg("cy").over(Window.partitionBy("document", "page", "marker", "row")))
    ordered = F.array_sort(F.collect_list(F.struct("_h", "x", "text")))
    return heights.groupBy("document", "page", F.col("marker").alias("eq_number")).agg(T.squash(F.array_join(F.transform(ordered, lambda t: t["text"]), " ")).alias("equation"))


def xml_tokens(pages: DataFrame) -> DataFrame:
    """Layout tokens of converter XML ``(document, xml)``: one row per text element, parsed with ``from_xml``."""
    schema = "page ARRAY<STRUCT<_number: INT, _width: DOUBLE, text: ARRAY<STRUCT<_left: DOUBLE, _top: DOUBLE, _width: DOUBLE, _height: DOUBLE, _VALUE: STRING>>>>"
    parsed = pages.where("xml is not null").select("document", F.from_xml("xml", schema, {"rowTag": "pdf2xml"}).alias("d"))
    page = parsed.select("document", F.explode("d.page").alias("p"))
    text = page.select("document", F.col("p._number").alias("page"), F.col("p._width").alias("width"), F.explode("p.text").alias("t"))
    return text.select("document", "page", "width", F.col("t._left").alias("x0"), (F.col("t._left") + F.col("t._width")).alias("x1"), (F.col("t._top") + F.col("t._height") / 2).alias("cy"), F.trim("t._VALUE").alias("text"))


# ---------------------------------------------------------------- sinks


def nested_records(records: DataFrame) -> DataFrame:
    """``(document, record map<label, struct>)``: one row per document, the later row winning on a repeated label."""
    last = Window.partitionBy("arxiv_id", "eq_number").orderBy(F.desc("rec_id"))
    once = records.withColumn("_r", F.row_number().over(last)).where("_r = 1")
    entry = F.struct("eq_number", F.struct("equation", F.coalesce("meaning", F.lit("")).alias("meaning"), "symbols", "relations", F.col("audit_trail").alias("audit-trail")))
    return once.groupBy("arxiv_id").agg(F.map_from_entries(F.array_sort(F.collect_list(entry), lambda a, b: F.when(a["eq_number"] < b["eq_number"], -1).otherwise(1))).alias("record"))


def write_json(df: DataFrame, path: str) -> None:
    """Nested records as JSON lines, UTF-8: one document per line, an object of label to record objects."""
    df.select(F.to_json(F.struct("arxiv_id", "record")).alias("value")).write.mode("overwrite").text(path)
