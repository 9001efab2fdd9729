"""Text operators against brute force, round trips and edge cases."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quillgraph.llm import distinctive, encoding, glyphs, leakage, markup, packing, privacy, scans, sentences

EQUATIONS = "row_id long, arxiv_id string, equation string, text_before string, text_after string"
DATASET = "rec_id long, arxiv_id string, eq_number string, meaning string, symbols map<string,string>"
DOCUMENTS = "doc_id long, text string, n_tokens int"


# ---------------------------------------------------------------- look-alikes


def test_forms():
    assert glyphs.fold_text("𝑥​ ＝ а") == "x = a"
    assert glyphs.fold_text("Н̂") == glyphs.fold_text("Ĥ") and glyphs.fold_text("N") != glyphs.fold_text("n")
    assert glyphs.normal_text("ﬁ Straße­Å") == "fi strasseå"
    for text in ("", "abc", "Ĥ  x", "漢字", "x²"):
        assert glyphs.fold_text(glyphs.fold_text(text)) == glyphs.fold_text(text)


def test_same_look_against_all_pairs(spark):
    random.seed(1)
    forms = ["a b", "a b", "а b", "a​ b", "A b", "c", "ｃ", "", None]
    rows = [("equation", "", n, random.choice(forms)) for n in range(60)] + [("equation", "", 3, "c")]
    got = {tuple(r) for r in glyphs.same_look(spark.createDataFrame(rows, "field string, scope string, id long, value string")).collect()}
    want = {("equation", min(a, b), max(a, b)) for _, _, a, v in rows for _, _, b, w in rows if a != b and v is not None and w is not None and v != w and glyphs.fold_text(v) == glyphs.fold_text(w)}
    assert got == want
    each = glyphs.classes(spark.createDataFrame([r for r in rows if r[3]], "field string, scope string, id long, value string")).collect()
    assert {r.id for r in each} == {x for _, a, b in want for x in (a, b)} and {(r.form, r.spellings) for r in each} == {("a b", 4), ("c", 2)}


def test_symbol_pairs_stay_within_papers(spark):
    data = spark.createDataFrame([(1, "p", "1", None, {"rho": ""}), (2, "p", "2", None, {"rhо": "", "x": ""}), (3, "q", "1", None, {"rhо": ""}), (4, None, "1", None, None)], DATASET).withColumn("value", F.lit("clash"))
    empty = spark.createDataFrame([], EQUATIONS)
    assert [tuple(r) for r in glyphs.found(empty, data).collect()] == [("symbols", 1, 2)]


# ---------------------------------------------------------------- term scores


def test_scores_against_brute_force(spark):
    random.seed(2)
    rows = [(f"r{random.randrange(12)}", f"t{int(random.random() ** 2 * 9)}") for _ in range(150)] + [(None, "t1"), ("r1", None)]
    joint = Counter((r, t) for r, t in rows if r and t)
    n, by_r, by_t = sum(joint.values()), Counter(), Counter()
    for (r, t), c in joint.items():
        by_r[r] += c
        by_t[t] += c
    smooth = sum(c**0.75 for c in by_t.values())
    got = distinctive.score_terms(spark.createDataFrame(rows, "r string, t string"), ["r"], "t").collect()
    assert len(got) == len(joint)
    for x in got:
        want = max(0.0, math.log2((joint[x.r, x.t] / n) / (by_r[x.r] / n * by_t[x.t] ** 0.75 / smooth)))
        assert abs(x.score - want) < 1e-9 and x.joint == joint[x.r, x.t]


def test_characteristic_keys(spark):
    rows = [(n, "p", str(n), None, {"rho": "", **({"Q_x": ""} if n < 2 else {})}) for n in range(12)]
    data = spark.createDataFrame(rows, DATASET).withColumn("score", F.lit("clash"))
    assert sorted((r.eq_number, r.symbol) for r in distinctive.found(data).collect()) == [("0", "Q_x"), ("1", "Q_x")]
    assert distinctive.found(data.limit(0)).count() == 0
    assert distinctive.plain_key("θ_𝑒ff") == "theta_eff"


# ---------------------------------------------------------------- packing


@pytest.mark.parametrize("seed", range(6))
def test_plan(seed):
    rng = random.Random(seed)
    capacity = rng.choice([50, 128, 1000])
    sizes = [rng.randint(1, capacity) for _ in range(rng.choice([0, 1, 7, 400]))] + [capacity // 2] * rng.choice([0, 300])
    histogram = Counter(sizes)
    runs, total = packing.plan(dict(histogram), capacity)
    filled, placed = Counter(), Counter()
    for size, first, last, container, each in runs:
        for rank in range(first, last + 1):
            filled[container + (rank - first) // each] += size
            placed[size, rank] += 1
    assert all(v <= capacity for v in filled.values()) and set(placed.values()) <= {1}
    assert Counter(s for s, _ in placed) == histogram and len(filled) == total
    space: list[int] = []  # best fit decreasing
    for s in sorted(sizes, reverse=True):
        fits = [k for k, v in enumerate(space) if v >= s]
        if fits:
            k = min(fits, key=lambda k: space[k])
            space[k] -= s
        else:
            space.append(capacity - s)
    assert total <= len(space) * 1.06 + 2


def test_pack(spark):
    docs = [(n, "x" * n, None if n % 3 else n + 1) for n in range(0, 300, 7)] + [(1000, None, None), (1001, "é" * 40, None), (None, "x", 1), (1002, "y" * 999, 1000)]
    specs = spark.createDataFrame([(1, 64), (2, 256), (3, None), (2, 256)], "spec_id int, capacity int").withColumn("size", F.lit("clash"))
    got = packing.pack(spark.createDataFrame(docs, DOCUMENTS).withColumn("container", F.lit("clash")), specs).toPandas()
    size = {d: (t if t is not None else len((x or "").encode()) + 1) for d, x, t in docs if d is not None}
    for spec, capacity in ((1, 64), (2, 256)):
        mine = got[got.spec_id == spec]
        assert mine.groupby("container")["size"].sum().max() <= capacity
        assert mine.groupby("doc_id")["size"].sum().to_dict() == size
        assert all(size[d] > capacity for d, n in mine.groupby("doc_id").size().items() if n > 1)
    assert packing.pack(spark.createDataFrame([], DOCUMENTS), specs).count() == 0


# ---------------------------------------------------------------- leakage


def brute_tiles(text, item, least):
    """Greedy string tiling by trying every pair of positions."""
    marked_t, marked_i, tiles = [False] * len(text), [False] * len(item), []
    while True:
        best = (0, 0, 0)
        for p in range(len(text)):
            for q in range(len(item)):
                k = 0
                while p + k < len(text) and q + k < len(item) and text[p + k] == item[q + k] and not marked_t[p + k] and not marked_i[q + k]:
                    k += 1
                if k > best[0]:
                    best = (k, p, q)
        k, p, q = best
        if k < least:
            return tiles
        tiles.append((p, q, k))
        for x in range(k):
            marked_t[p + x] = marked_i[q + x] = True


def test_tiles_against_brute_force():
    rng = random.Random(3)
    for _ in range(25):
        item = [rng.randrange(6) for _ in range(25)]
        text = [rng.randrange(6) for _ in range(15)] + item[10:20] + [rng.randrange(6) for _ in range(5)] + item[:9]
        seeds = [(p, q) for p in range(len(text) - 3) for q in range(22) if text[p : p + 4] == item[q : q + 4]]
        got = leakage.tile(seeds, leakage.SEED, len(text), len(item)) if seeds else []
        want = brute_tiles(text, item, leakage.SEED)
        assert sum(t[2] for t in got) >= 0.9 * sum(t[2] for t in want)
        assert all(text[p : p + n] == item[q : q + n] for p, q, n in got)


def test_rolling_hashes():
    a, b = (leakage.rolling(leakage.token_hashes([f"w{x}" for x in t]), 4) for t in ([1, 2, 3, 4, 5], [9, 2, 3, 4, 5]))
    assert a[0][1] == b[0][1] and a[1][1] == b[1][1] and a[0][0] != b[0][0] and len(leakage.rolling(leakage.token_hashes(["x"]), 4)[0]) == 0


def test_leaks(spark):
    passage = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    docs = [
        (1, "x " + passage.upper().replace(" ", ",\n") + " y"), (2, "nine ten eleven twelve thirteen fourteen and one two three four five"), (3, "one two three four and nothing else"),
        (4, "one two three four FIVE! sox seven eight nine ten"), (5, None), (6, ""), (7, "one two three four five six sev-\nen eight nine ten"), (1, passage)]
    items = spark.createDataFrame([(1, passage), (2, None), (3, ""), (4, "short one")], "item_id long, passage string").withColumn("text", F.lit("clash"))
    got = {tuple(r) for r in leakage.found(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()}
    assert got == {(1, 1), (2, 1), (4, 1), (7, 1)}
    assert leakage.found(spark.createDataFrame(docs, "doc_id long, text string"), items.limit(0)).count() == 0


# ---------------------------------------------------------------- markup


@pytest.mark.parametrize("text, clean", [
    ("<p>a <b>b</b></p><ul><li>c</li></ul>", "a b\n- c"), ("x &amp;lt; y", "x < y"), ("**a** and `b` and ~~c~~", "a and b and c"), ("[[Mode|x]] {{cn}}y", "x y"), ("\\textbf{a} \\emph{b}~\\cite{k}", "a b"),
    ("== T ==\nbody", "T\n\nbody"), ("```\ncode  x\n```\nt", "code  x\nt"), ("a\n- b\n- c\n", "a\n- b\n- c"), ("$$x_{k}$$ t", "$x_{k}$\nt"), ('<math alttext="a < b"><mi>x</mi></math> t', "$a < b$ t"), ("a</div> b", "a b"),
    ("T\n{| class=\"wikitable\"\n|-\n! a !! b\n|-\n| style=\"x\" | 1 || 2\n|}\nend", "T\na, b\n1, 2\nend"), ("| a | b |\n|---|---|\n| 1 | 2 |\n", "a, b\n1, 2"),
])
def test_markup(text, clean):
    got, nodes, _ = markup.convert(text)
    assert sum(n for _, n, _ in nodes) > 0 and got == clean


@pytest.mark.parametrize("text", ["", "For a <b and c> d we use 5*11*2 and run_a_b & c.", "K' and $g_{a}$'' label", "counts #$\\eta$ ~ 5.7", "f \\ g", "see [12, Thm. 2]", "- 146 -\nHEADER", "a^dagger < 3"])
def test_no_markup(text):
    assert markup.convert(text)[:2] == (text, [])


def test_boilerplate_is_left_out():
    page = "<div><nav><a href='#x'>Home</a> <a href='#y'>About us</a></nav><div><p>" + "A long paragraph, with commas, and words. " * 5 + "</p><p>" + "Another, too, goes on and on. " * 5 + "</p></div></div>"
    text = markup.convert(page)[0]
    assert "Home" not in text and "Another, too" in text


def test_markup_without_bounds():
    many = " ".join(f"$\\alpha_{{{n}}}$ and `c{n}`" for n in range(3000))
    assert markup.convert(many)[0] == many.replace("`", "")
    long = "$" + "\\frac{a}{b} + " * 300 + "c$"
    assert markup.convert(long)[:2] == (long, [])
    text, nodes, _ = markup.convert("<div>" * 3000 + "<p>deep words, and more of them in here</p>" + "</div>" * 3000)
    assert text == "deep words, and more of them in here" and {k for k, _, _ in nodes} == {"div", "p"} and max(s for *_, s in nodes) > 0


def test_markup_frames(spark):
    e = spark.createDataFrame([(1, "p", None, "<b>x</b>", None), (2, "p", None, "", "plain " * 20000 + "**x**")], EQUATIONS).withColumn("field", F.lit("clash"))
    d = spark.createDataFrame([(1, "p", "1", None, {}), (2, "p", "1", "''a''", {})], DATASET)
    assert {tuple(r) for r in markup.found(e, d).collect()} == {("text_before", 1), ("text_after", 2), ("meaning", 2)}
    assert markup.found(e.limit(0), d.limit(0)).count() == 0


# ---------------------------------------------------------------- encodings


def test_utf8_round_trip():
    tables = encoding.Tables()
    for name in ("cp1252", "cp437", "mac_roman", "cp1251"):
        text = "größere Werte, ядро und α"
        wrong = "".join(bytes([b]).decode(name, "ignore") or chr(b) for b in text.encode())
        assert encoding.utf8_once(wrong, tables.bytes[name])[0] == text
    assert encoding.utf8_once("Ŝ^± Ã DEUX â† ok", tables.bytes["cp1252"])[1] == 0


def test_short_scores():
    judge = encoding.Judge(np.random.default_rng(0).integers(0, 50, 2**encoding.BITS).astype(float))
    for text in ("größer 12 ё", "é", "", "abc", "\nЯ 7\n漢"):
        assert abs(judge._short(text) - judge.score(text)) < 1e-3
    h, owner = encoding.hashes_of(["é1", "", "plain", "zé"])
    assert sorted(h[owner == 0]) == sorted(encoding.hashes("é1")) and sorted(h[owner == 3]) == sorted(encoding.hashes("zé")) and set(owner) == {0, 3}


def test_garbled(spark):
    clean = ["größere Werte für die Übergänge", "l’état d’équilibre est réduit", "ядро памяти мало", "die Größe der Störung"]
    rows = [(n, f"p{n % 7}", "x = 1", clean[n % 4], None) for n in range(200)]
    rows += [(900, "p1", None, "l’état d’équilibre".encode().decode("cp1252"), None), (901, "p2", "gr��ere", "", None), (902, None, None, "l’état Ã DEUX", None), (903, "p3", "ÐµÐ´Ñ€Ð¾ Ð¿Ð°Ð¼ÑÑ‚Ð¸", None, None)]
    e = spark.createDataFrame(rows, EQUATIONS).withColumn("source", F.lit("clash"))
    got = {(r.field, r.id): r for r in encoding.diagnose(encoding.fields_of(e)).collect()}
    assert set(got) == {("text_before", 900), ("equation", 901), ("equation", 903)}
    assert got["text_before", 900].restored == "l’état d’équilibre" and got["equation", 901].restored is None
    assert encoding.found(e.limit(0)).count() == 0


def test_a_hot_source_garbled_throughout(spark):
    clean = ["ядро памяти мало и спектр шума мал", "оператор плотности мал", "узел решётки мал и закон затухания мал", "спектр шума задаёт узел решётки"]
    rows = [(n, f"p{n % 40}", "x = 1", clean[n % 4], None) for n in range(160)]
    rows += [(1000 + n, "hot", "x = 1", clean[n % 4].encode("koi8_r").decode("cp1251"), None) for n in range(80)]
    got = {r.id: r.restored for r in encoding.diagnose(encoding.fields_of(spark.createDataFrame(rows, EQUATIONS))).collect()}
    assert set(got) == set(range(1000, 1080)) and got[1000] == clean[0]


# ---------------------------------------------------------------- sentences


@pytest.mark.parametrize("text, starts", [
    ("See Fig. 3 and Ref. [2]. The values are 1.8, 4.78, etc. Then it ends.", ["See", "The", "Then"]), ('The report says: "It is bare." What if not?', ["The", "What"]), ('"Is it bare?" is the question. σ is small.', ['"Is', "σ"]),
    ("It vanishes ... but only here. (This is omitted.) Next", ["It", "(This", "Next"]), ("As J. K. Ilvane observed, it stays. It is called J. Compare it.", ["As", "It", "Compare"]),
    ("Die Korrektur 3. Ordnung ändert es. Am 4. Mai lief es. Das ist alles usw. Ja!", ["Die", "Am", "Das", "Ja!"]), ("文献称：“晶格不变。”为什么？“稳态？”这一问题见第2节。", ["文", "为", "“"]), ("値はv2.9で変わる……図1を参照。", ["値", "図"]),
    ("ค่าแทนแลตทิซ ดูสมการ(1)สำหรับ", ["ค่า", "ดู"]), ("¿Es así? Sí.", ["¿Es", "Sí."]), ("«Да?» — пишет он. А потом.", ["«Да", "А"]), ("", []), ("   ", []), ("lower start. Next", ["lower", "Next"]),
])
def test_sentences(text, starts):
    got = sentences.boundaries(text)
    assert len(got) == len(starts) and all(text[p:].startswith(s) for p, s in zip(got, starts))


def test_chunks_do_not_matter(spark):
    rng = random.Random(5)
    parts = ["The report says: “It is bare.” ", "See Fig. 3 (cf. Ref. [2]). ", "文献称：“晶格不变。”", "What if not?\n\n", "(All is omitted.) ", "At 3.5 K it ends. "]
    texts = [(n, "f", "".join(rng.choice(parts) for _ in range(40 * n))) for n in range(1, 5)] + [(9, "f", None), (10, "f", "")]
    df = spark.createDataFrame(texts, "row_id long, field string, text string").withColumn("start_char", F.lit("clash"))
    whole = sorted(map(tuple, sentences.split(df, ["row_id", "field"]).collect()))
    assert whole == sorted(map(tuple, sentences.split(df, ["row_id", "field"], chunk=300).collect()))
    assert whole == sorted((n, f, p) for n, f, t in texts if t for p in sentences.boundaries(t))


def test_scan_is_composition():
    rng = np.random.default_rng(0)
    f = rng.integers(0, len(sentences._STATES), (9, len(sentences._STATES)))
    state, want = sentences.START, []
    for g in f:
        want.append(state)
        state = g[state]
    assert sentences.prefix_scan(f).tolist() == want


# ---------------------------------------------------------------- page scans


def test_page_scans(spark):
    words = ["the lattice site is small and the memory kernel decays", "we find the response tensor of the lattice site", "the memory kernel of the boundary layer is small"]
    rows = [(n, "p", None, words[n % 3], words[(n + 1) % 3]) for n in range(90)]
    rows += [(900, "p", None, "the lattice s!te is srnall and the mem0ry kernel decays", None), (901, "p", None, "we find the response ten-\nsor of the lattice site", ""), (902, "p", None, "the memory kernel\n– 22 –\nof the boundary layer is small", None),
             (903, "p", None, "the memory kernel\nof the boundary layer is small", None), (904, "p", "x = y\nPage 3 of 48\n+ z", None, None)]
    e = spark.createDataFrame(rows, EQUATIONS).withColumn("line", F.lit("clash"))
    assert {tuple(r) for r in scans.found(e).collect()} == {("text_before", 900), ("text_before", 901), ("text_before", 902), ("equation", 904)}
    fixed = {(r.field, r.id): r.text for r in scans.repair(e).where("id >= 900").collect()}
    assert fixed["text_before", 900] == words[0] and fixed["text_before", 901] == words[1] and fixed["text_before", 902] == words[2] and fixed["equation", 904] == "x = y + z"
    assert scans.found(e.limit(0)).count() == 0


def test_learned_characters_at_the_edges(spark):
    rows = [(n, t) for n in range(12) for t in ("次式を得るから", "結果を得るのだ")] + [(50, "次式を待るから"), (51, "結果を待るのだ"), (52, "次式を待る"), (53, "待る"), (54, "式待")]
    texts = spark.createDataFrame([("text_before", n, t) for n, t in rows], "field string, id long, text string")
    got = {(r.id, r.at, r.word, r.chosen) for r in scans.misread_characters(texts).collect()}
    assert got == {(50, 2, "待", "得"), (51, 2, "待", "得"), (52, 2, "待", "得"), (53, -1, "待", "得"), (54, 0, "待", "得")}


# ---------------------------------------------------------------- personal information


TEXT = ("We thank Fenra A. Kulwald for help. Contact fenra.kulwald (at) uni-nordau.example or +44 20 7946 0695. Her home is 12 Marrow Street, Valmeren ZZ1 2QX. Passport ZX1234567 was lost. The Kulwald theorem holds. "
        "Grant no. 2291-0045-13 and ISBN 000-0-00-160000-0 are fine. We thank Fenra A. Kulwald again.")


def test_privacy(spark):
    filler = [(n, "We thank you for the home and the contact. Her passport was lost, as the theorem holds. Grant it again.", None) for n in range(2, 30)]
    docs = spark.createDataFrame([(1, TEXT, None), (30, None, None), (31, "", None), *filler], DOCUMENTS).withColumn("kind", F.lit("clash"))
    got = [(r.kind, r.value) for r in privacy.entities(docs).where("doc_id = 1").orderBy("start_char").collect()]
    assert got == [("name", "Fenra A. Kulwald"), ("email", "fenra.kulwald (at) uni-nordau.example"), ("phone", "+44 20 7946 0695"), ("address", "12 Marrow Street, Valmeren ZZ1 2QX"), ("id_number", "ZX1234567"), ("name", "Fenra A. Kulwald")]
    out = {r.doc_id: r for r in privacy.redact(docs).collect()}
    assert out[1].text.startswith("We thank [NAME] for help. Contact [EMAIL] or [PHONE]. Her home is [ADDRESS]. Passport [ID_NUMBER] was lost.") and out[30].text is None and out[31].text == "" and out[2].text == filler[0][1]
    new = {r.doc_id: r.text for r in privacy.surrogate(docs, "key").collect()}[1]
    assert "Kulwald for" not in new and "ZX1234567" not in new and "Kulwald theorem" in new and "7946" not in new
    assert new.split("We thank ")[1].split(" for help")[0] == new.split("We thank ")[2].split(" again")[0]
    assert privacy.found(docs.limit(0)).count() == 0


def test_names_by_context(spark):
    none = lambda w: w in ("We", "The", "In", "Im", "On", "Paid", "by", "Signed", "après")
    names = lambda text: [text[a:b] for a, b, kind in privacy._spans(text, none) if kind == "name"]
    people = ["April Kulwald", "June Szelby", "Fenra Grant", "Oda Lane", "Fenra A. Ilvane", "Oda Varnholt", "Satz Kulwald"]
    assert [names(f"We thank {p} for help.") for p in people] == [[p] for p in people]
    assert [names(t) for t in ("Im Satz von Kulwald steht es.", "The Kulwald theorem holds.", "for the Kulwald–Ilvane bound.", "Der Kulwald-Operator wirkt.", "Paid by Grant No. 2291", "On 4 May Tuesday", "On May 4")] == [[]] * 7


    assert names("D'après Kulwald, Fenra, il est. Fenra Kulwald Tel.: 5") == ["Kulwald, Fenra", "Fenra Kulwald"]


def test_labels_are_learned(spark):
    rows = [(n, "We use the Zorvane theorem and the bound of the Zorvane operator for it.", None) for n in range(9)] + [(20, "We use it by Zorvane Zorvane, and by Fenra Zorvane.", None)]
    got = privacy.entities(spark.createDataFrame(rows, DOCUMENTS)).collect()
    assert [(r.doc_id, r.value) for r in got] == [(20, "Fenra Zorvane")]


def test_filter(spark):
    words = [f"wört{n}" for n in range(3000)]
    got = privacy._filter(spark.createDataFrame([(w,) for w in words], "w string"))
    hashes = np.array([xxhash.xxh64_intdigest(w.encode(), 42) for w in [*words, *(f"other{n}" for n in range(3000))]], np.uint64)
    mask = got.mask(hashes)
    assert mask[:3000].all() and mask[3000:].sum() < 60 and mask.tolist() == [int(h) in got for h in hashes]
    assert 7 not in privacy._filter(spark.createDataFrame([], "w string"))


def test_surrogates_are_distinct(spark):
    rows = [("name", f"xo{a}{b}") for a in "bcdfg" for b in "klmnp"] + [("phone", f"{n}0794600{m}0") for n in range(1, 10) for m in range(10)] + [("id_number", f"{n:02}") for n in range(100)]
    got = privacy.surrogates(spark.createDataFrame(rows + rows[:5], "kind string, unit string"), "k").collect()
    by = defaultdict(list)
    for r in got:
        by[r.kind, r.surrogate].append(r.unit)
    assert len(got) == len(rows) and all(len(v) == 1 for v in by.values())
    assert not {(r.kind, r.surrogate) for r in got} & set(rows)


def test_no_digits_survive():
    rng = random.Random(4)
    for value in ["+44 20 7946 0695", "555-123-4567 x 12345", "+1 555 987 6543", "(020) 7946 0001", "00442079460695", "+44 (0)20 7946 0695"] + ["0" + "".join(rng.choice("0123456789") for _ in range(9)) for _ in range(200)]:
        code, national, ext, roles = privacy.phone_parts(value)
        assert len(roles) == sum(c.isdigit() for c in value)
        unit = f"{code}:{national}" if code else national
        new = privacy._put("phone", value, {unit: privacy._draw("phone", unit, "k", 0)}, "k")
        assert len(new) == len(value) and all(a == b if not a.isdigit() else True for a, b in zip(value, new))
        old_digits, new_digits = re.sub(r"\D", "", value), re.sub(r"\D", "", new)
        assert all(a != b for a, b, role in zip(old_digits, new_digits, roles) if role in "nx") and old_digits[-7:] != new_digits[-7:]
        assert not code or new_digits[roles.index("c"):][: len(code)] != code
    assert privacy._unit("phone", "+1 555 987 6543") != privacy._unit("phone", "+44 20 987 6543")


def test_one_person_one_surrogate(spark):
    text = "We thank Fenra Kulwald, then F. Kulwald, then Kulwald, Fenra, and FENRA KULWALD (+44 20 7946 0695, 020 7946 0695); not Oda Kulwald."
    docs = spark.createDataFrame([(1, text, None), (2, "We thank you, then not for it. Thank them.", None)], DOCUMENTS)
    new = {r.value: r.new for r in privacy.replacements(docs, "k").collect()}
    given, family = new["Fenra Kulwald"].split()
    assert new["Kulwald, Fenra"] == f"{family}, {given}" and new["F. Kulwald"] == f"{given[0]}. {family}" and new["FENRA KULWALD"] == f"{given} {family}".upper()
    assert given[-1] == "a" and new["Oda Kulwald"].split()[1] == family and new["Oda Kulwald"].split()[0] != given
    assert re.sub(r"\D", "", new["+44 20 7946 0695"])[2:] == re.sub(r"\D", "", new["020 7946 0695"])[1:]
