"""Queries of the text operators and, where SQL can express them on whole tables, their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillgraph.llm import distinctive, encoding, glyphs, leakage, markup, packing, privacy, scans, sentences
from quillgraph.session import table, tune


def _query(build, *names):
    def run(spark, folder):
        tune(spark)
        return build(*(table(spark, folder, n) for n in names))

    return run


def queries():
    """Name to query; a query takes the session and a data folder."""
    return {
        "p1_found": _query(scans.found, "equations"),
        "p1_damage": _query(scans.damage, "equations"),
        "p1_repaired": _query(scans.repair, "equations"),
        "p2_found": _query(markup.found, "equations", "dataset"),
        "p2_clean": _query(lambda e, d: markup.clean(markup.fields_of(e, d)), "equations", "dataset"),
        "p3_found": _query(glyphs.found, "equations", "dataset"),
        "p3_classes": _query(lambda e, d: glyphs.classes(glyphs.fields_of(e, d)), "equations", "dataset"),
        "p3_forms": _query(lambda e: glyphs.unify(e.select("row_id", "equation"), "equation", "form"), "equations"),
        "p4_found": _query(distinctive.found, "dataset"),
        "p4_scores": _query(lambda d: distinctive.symbol_scores(d).withColumn("score", F.round("score", 6)), "dataset"),
        "p5_found": _query(encoding.found, "equations"),
        "p5_restored": _query(lambda e: encoding.diagnose(encoding.fields_of(e)), "equations"),
        "p6_found": _query(sentences.found, "equations", "sentence_tasks"),
        "p7_containers": _query(packing.pack, "documents", "container_specs"),
        "p7_check": _query(packing.check, "documents", "container_specs"),
        "p8_found": _query(leakage.found, "documents", "eval_items"),
        "p9_found": _query(privacy.found, "documents"),
        "p9_surrogates": _query(lambda d: privacy.surrogate(d, "quillgraph"), "documents"),
        "p9_redacted": _query(privacy.redact, "documents"),
    }


_SIZES = "(SELECT coalesce(n_tokens, strlen(coalesce(text, '')) + 1) AS n FROM documents WHERE doc_id IS NOT NULL)"


def _values() -> str:
    """The rows of p3, with the strict form."""
    return f"""(SELECT *, {glyphs.sql_form('value')} AS form FROM (SELECT 'equation' AS field, '' AS scope, row_id AS id, equation AS value FROM equations WHERE equation IS NOT NULL
        UNION ALL SELECT 'symbols', arxiv_id, rec_id, unnest(map_keys(symbols)) FROM dataset WHERE arxiv_id IS NOT NULL))"""


def _scores() -> str:
    """Scores of p4: (record, term) with its marginals."""
    return f"""WITH joint AS (SELECT DISTINCT arxiv_id, eq_number, {distinctive.sql_plain('key')} AS symbol FROM (SELECT arxiv_id, eq_number, unnest(map_keys(symbols)) AS key FROM dataset) WHERE arxiv_id IS NOT NULL AND eq_number IS NOT NULL),
        kept AS (SELECT * FROM joint WHERE symbol <> ''), terms AS (SELECT symbol, count(*) AS records FROM kept GROUP BY 1), recs AS (SELECT arxiv_id, eq_number, count(*) AS nr FROM kept GROUP BY 1, 2),
        total AS (SELECT sum(records) AS n, sum(pow(records, 0.75)) AS ns FROM terms),
        scored AS (SELECT arxiv_id, eq_number, symbol, CAST(1 AS BIGINT) AS joint, records, greatest(0.0, log2((1 / n) / ((nr / n) * (pow(records, 0.75) / ns)))) AS score FROM kept JOIN terms USING (symbol) JOIN recs USING (arxiv_id, eq_number), total)"""


def oracle_sql():
    """SQL twins, by query."""
    return {
        "p3_found": f"""SELECT DISTINCT a.field, least(a.id, b.id) AS id_a, greatest(a.id, b.id) AS id_b FROM {_values()} a JOIN {_values()} b ON a.field = b.field AND a.scope = b.scope AND a.form = b.form AND a.id < b.id AND a.value <> b.value""",
        "p3_classes": f"""SELECT field, scope, id, value, form, main, spellings, CAST(rows AS BIGINT) AS rows FROM {_values()} JOIN (SELECT field, scope, form, max_by(value, (n, value)) AS main, count(*) AS spellings, sum(n) AS rows
            FROM (SELECT field, scope, form, value, count(*) AS n FROM {_values()} GROUP BY ALL) GROUP BY ALL HAVING count(*) > 1) USING (field, scope, form)""",
        "p4_scores": f"{_scores()} SELECT arxiv_id, eq_number, symbol, joint, records, round(score, 6) AS score FROM scored",
        "p4_found": f"""{_scores()}, ranked AS (SELECT *, row_number() OVER w AS k, lead(records) OVER w AS next FROM scored WHERE records > 1 WINDOW w AS (PARTITION BY arxiv_id, eq_number ORDER BY score DESC, records, symbol))
            SELECT arxiv_id, eq_number, symbol FROM ranked WHERE k = 1 AND records <= 5 AND next >= 5 * records""",
        "p7_check": f"""SELECT spec_id, count(*) AS documents, CAST(sum(greatest(ceil(n / capacity), 1)) AS BIGINT) AS pieces, CAST(sum(n) AS BIGINT) AS tokens, CAST(0 AS BIGINT) AS torn, CAST(0 AS BIGINT) AS overfull, true AS close
            FROM {_SIZES}, (SELECT DISTINCT spec_id, capacity FROM container_specs WHERE spec_id IS NOT NULL AND capacity > 0) GROUP BY spec_id""",
    }
