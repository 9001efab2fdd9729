"""Sources and sinks: files, pages, Markdown, layout, records, streams."""

import json

from pyspark.sql import functions as F

from quillgraph.sources import documents as D
from quillgraph.streaming import ingest


def test_ids(spark, tmp_path):
    (tmp_path / "ids.txt").write_text("# list\n\narXiv:2401.00001v2\nnonsense\nquant-ph/0102003\n")
    assert [r.id for r in D.scan_ids(spark, str(tmp_path / "ids.txt")).orderBy("ord").collect()] == ["2401.00001v2", "quant-ph/0102003"]


def test_cached_files(spark, tmp_path):
    (tmp_path / "a.html").write_text("<div class='ltx_document'>x</div>")
    (tmp_path / "b.html").write_text("<p>x</p>")
    (tmp_path / "c.pdf").write_bytes(b"%PDF-1.4 x")
    (tmp_path / "d.pdf").write_bytes(b"nothing")
    assert D.scan_html(spark, str(tmp_path)).count() == 1
    assert [r.length for r in D.scan_pdf(spark, str(tmp_path)).collect()] == [10]


def row(n, math, label):
    cell = f"<td class='ltx_eqn_eqno'><span class='ltx_tag_equation'>({label})</span></td>" if label else ""
    return f"<tr id='r{n}'><td><math alttext='{math}'><mi>ψ</mi><annotation encoding='application/x-tex'>{math}</annotation></math></td>{cell}</tr>"


def test_html(spark):
    page = (
        "<h2>Model</h2><p>We write</p><table id='S1.E1'>" + row(1, "\\\\psi = a + b", "1") + row(2, "= c + d", "") + "</table><p>where a is</p>"
        "<h2>Appendix A</h2><table id='S2.E2'>" + row(3, "\\\\phi = e^{x}", "") + "</table><table>" + row(4, "x", "9") + "</table><table>" + row(5, "\\\\psi = z + y", "1") + "</table>")
    got = D.parse_html(spark.createDataFrame([("d", page), ("e", None), ("f", "")], "document string, html string")).orderBy("place").collect()
    assert [(r.eq_number, r.section) for r in got] == [("1", "Model"), ("2", "Appendix A")]
    assert got[0].equation.startswith("\\\\psi=a + b=c + d") and got[0].text_before == "We write" and got[0].text_after == "where a is" and got[0].identifier_candidates == ["psi"]


def test_labels_are_recovered(spark):
    row_ = lambda n, label: f"<table>{row(n, f'x_{{{n}}} = y_{{{n}}} + z', label)}</table><p>then</p>"
    page = row_(1, "") + row_(2, "2") + row_(3, "") + row_(4, "") + row_(5, "5") + row_(6, "")
    got = D.parse_html(spark.createDataFrame([("d", page), ("e", row_(1, "") + row_(2, ""))], "document string, html string")).orderBy("place").collect()
    assert [(r.document, r.eq_number, r.equation[:5]) for r in got] == [("d", "1", "x_{1}"), ("d", "2", "x_{2}"), ("d", "3", "x_{3}"), ("d", "4", "x_{4}"), ("d", "5", "x_{5}")]
    assert D.parse_html(spark.createDataFrame([("d", page)], "document string, html string"), recover=False).count() == 2


def test_markdown(spark):
    text = "# One\n$$x_1 = \\frac{a}{b} \\tag{2}$$\nwords\n\\[y^2 = z + 1 \\tag{1}\\]\nE = m c^2 + k  (3)\n"
    got = D.markdown_formulas(spark.createDataFrame([("d", text), ("e", None), ("f", "")], "document string, text string")).orderBy("place").collect()
    assert [r.eq_number for r in got] == ["2", "1", "3"] and got[0].section == "One"


def test_layout(spark):
    text = "Some prose that is long enough here\nx = a + b\n  + c   (1)\nMore prose in this line of text\n"
    got = D.layout_formulas(spark.createDataFrame([("d", text), ("e", None)], "document string, text string")).collect()
    assert [(r.eq_number, r.equation, r.equation_confidence) for r in got] == [("1", "x = a + b + c", "medium")]


def test_geometry_of_xml(spark):
    xml = '<pdf2xml><page number="1" width="600"><text left="100" top="95" width="10" height="10">x</text><text left="120" top="96" width="10" height="10">=</text><text left="140" top="95" width="10" height="10">y</text><text left="560" top="95" width="30" height="10">(4)</text></page></pdf2xml>'
    tokens = D.xml_tokens(spark.createDataFrame([("d", xml.replace('number=', 'number=')), ("e", None)], "document string, xml string"))
    assert [(r.eq_number, r.equation) for r in D.geometry_formulas(tokens).collect()] == [("4", "x = y")]


def test_records(spark, tmp_path):
    schema = "rec_id long, arxiv_id string, eq_number string, equation string, meaning string, symbols map<string,string>, relations map<string,struct<grade:string,description:string>>, audit_trail map<string,array<string>>"
    df = spark.createDataFrame([(1, "a", "1", "old", None, {}, {}, {}), (2, "a", "1", "é", "m", {"x": ""}, {}, {})], schema)
    D.write_json(D.nested_records(df), str(tmp_path / "out"))
    lines = [json.loads(x) for p in (tmp_path / "out").glob("part-*") for x in p.read_text().splitlines()]
    assert len(lines) == 1 and lines[0]["arxiv_id"] == "a" and lines[0]["record"]["1"] == {"equation": "é", "meaning": "m", "symbols": {"x": ""}, "relations": {}, "audit-trail": {}}


def test_stream(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "arxiv_id string, n int").withColumn("t", F.lit("2031-01-01 00:00:00").cast("timestamp"))
    df.write.parquet(str(tmp_path / "in"))
    stream = ingest.first_deliveries(ingest.read_stream(spark, str(tmp_path / "in"), df.schema), ["arxiv_id", "n"], "t")
    query = stream.writeStream.format("memory").queryName("first").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination(60)
    assert spark.table("first").count() == 2


def test_queries_read_whole_documents(spark, tmp_path):
    from quillgraph.plans import catalog

    rows = [(n, "a", str(n), "plain words" if n <= 4 else f"x_{n} = y_{n} + z_{n} - 1", "", "", "One") for n in range(1, 18)]
    spark.createDataFrame(rows, "row_id long, arxiv_id string, eq_number string, equation string, text_before string, text_after string, section string").write.parquet(f"{tmp_path}/equations.parquet")
    records = [(n, "a", str(n)) for n in range(1, 11)] + [(11, "b", "1")]
    spark.createDataFrame(records, "rec_id long, arxiv_id string, eq_number string").write.parquet(f"{tmp_path}/dataset.parquet")
    spark.createDataFrame([("a", "1", "9"), ("a", "1", "9"), ("a", "9", "1"), ("a", "9", "10"), ("a", "2", "2"), ("a", "3", "99")], "arxiv_id string, src string, dst string").write.parquet(f"{tmp_path}/relations.parquet")
    run = lambda name: catalog.queries()[name](spark, str(tmp_path)).collect()
    assert sorted(int(r.eq_number) for r in run("o05_html_pages")) == list(range(5, 12))
    assert sorted(int(r.eq_number) for r in run("o08_layout")) == list(range(5, 12))
    assert {int(r.eq_number) for r in run("o06_geometry")} >= set(range(5, 18))
    edges, counts = {("1", "9"), ("9", "1"), ("9", "10")}, {(r.arxiv_id, r.eq_number): (r.missing_out, r.missing_in) for r in run("o40_missing_counts")}
    names = [str(n) for n in range(1, 11)]
    missing = [(a, b) for a in names for b in names if a != b and (a, b) not in edges]
    assert counts == {("b", "1"): (0, 0)} | {("a", x): (sum(a == x for a, _ in missing), sum(b == x for _, b in missing)) for x in names}
