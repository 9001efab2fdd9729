"""Personal information inside free text: found, typed, and replaced by surrogates.

E-mail addresses, phone numbers, identity numbers, street addresses and names are found by layered patterns; names
are runs of capitalised words that the collection does not otherwise use as ordinary words. The collection's own word
statistics, not a list of names, separate "Following Ref." from a person and the name of a theorem from its author.

``replacements`` gives every occurrence its keyed surrogate. The units that surrogates are drawn for are the words of
names, whole phone and identity numbers, e-mail addresses and street addresses. A unit's surrogate is drawn from a
keyed digest; units that would share one, or that would get a value standing in the collection, draw again until all
are distinct. Because a name is replaced word by word, and a word's initial by a keyed permutation of its alphabet, the
full, the initialled and the reversed form of a name stay one person, and different persons stay different. Script,
letter case, the ending that carries the gender of many given names, particles and digit formats are kept.
``redact`` puts typed placeholders in place of the occurrences instead.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from quillgraph.llm.filters import HashFilter
from quillgraph.session import cut, spread

KINDS = ("email", "id_number", "phone", "address", "name")

_U, _L = "A-ZÀ-ÖØ-ÞĀĂĄĆČŁŃŒŚŠŹŻŽА-ЯЁΑ-Ω", "a-zß-öø-ÿāăąćčłńœśšźżžа-яёα-ω"
_AT = r"(?:\s?[@＠]\s?|\s?[\[({<]\s?(?:at|AT|arroba|chez|ät)\s?[\])}>]\s?| (?:AT|at|arroba) )"
_DOT = r"(?:\.|\s?[\[({<]\s?(?:dot|DOT|punto|point|punkt)\s?[\])}>]\s?| (?:DOT|dot|punto) )"
_EMAIL = re.compile(rf"(?<![\w.+$\\-])[A-Za-z0-9](?:[\w.+-]*\w)?{_AT}[A-Za-z0-9-]+(?:{_DOT}[A-Za-z0-9-]+)*{_DOT}[A-Za-z]{{2,}}(?![\w@])")
_ID = re.compile(
    r"(?<![\w.:/-])(?:"
    r"[A-Z]{2}\d{6,8}[A-Z]?|[A-Z]{2} \d\d \d\d \d\d [A-D]"  # two letters and a serial number
    r"|\d{8}-?[A-Z]|[XYZ]-?\d{7}-?[A-Z]|\d{2}-\d{6}-[A-Z]"  # a serial number and a check letter
    r"|\d{3}-\d{2}-\d{4}|\d{3} \d{2} \d{4}|\d{3}\.\d{3}\.\d{3}-\d{2}"  # grouped tax and insurance numbers
    r"|[1-6]\d{16}[\dXx]"
    r")(?![\w-]|\.\d)"
)
_ID_WORD = re.compile(
    r"(?:passport|badge|tax (?:number|id)|staff (?:no\.?|number|id)|payroll (?:no\.?|number|lists)|ID(?: no\.?| number)?|national id|"
    r"Ausweisnummer|Ausweis-?Nr\.?|Steuernummer|Personalnummer|identité n°|passeport n°|documento|pasaporte|DNI|NIF|паспорт|ИНН|护照|身份证|旅券)"
    r"(?: (?:no|number|Nr)\.?)?[\s:]{1,3}(?:is |lautet |est )?([A-Z]{0,3}[ -]?\d[\dA-Z]*(?:[ .-][\dA-Z]+){0,5})(?![\w-])", re.IGNORECASE)
_PHONE = re.compile(
    r"(?<![\w.:/\\$@#=-])(?:"
    r"\+\d{1,3}(?:[ .\-]?\(\d{1,5}\)|[ .\-]\d{1,5})(?:[ .\-/]?\d{2,5}){1,4}"  # international
    r"|\+\d{10,14}|00[1-9]\d{9,12}"
    r"|\(0?\d{2,5}\)[ ]?\d{3,5}[ .\-]?\d{3,5}"
    r"|0\d{1,4}/\d{4,6}(?:-\d{1,4})?"
    r"|0\d(?:[ .]\d\d){4}|0\d{2,4} \d{3,4} \d{3,4}"
    r"|[2-9]\d{2}([-.])\d{3}\1\d{4}"
    r")(?:,? ?(?:ext\.?|x|Durchwahl|poste) ?\d{1,5})?(?![\w/]|[.-]\d)"
)
#: Plain searches without which none of the longer patterns can match.
_MAYBE_EMAIL = re.compile(r"[@＠]|[\[({<]\s?(?:at|AT|arroba|chez|ät)\s?[\])}>]| (?:AT|arroba) | at [A-Za-z0-9-]+(?:\.|\s?[\[({<]| (?:DOT|dot|punto) )")
_MAYBE_STREET = re.compile(
    r"(?:Lane|Road|Street|Avenue|Ave|Way|Drive|Close|Court|Place|Square|Row|Terrace|Gardens|Crescent|Boulevard|Blvd|Rd|St|Ln)\b|\d ?(?:bis|ter|[a-z])?,? (?:rue|avenue|boulevard|place|chemin|allée|quai|impasse|route|cours) "
    r"|(?:Am|An der|An den|Auf dem|Auf der|Im|In der|Zum|Zur|Unter den) [^\W\d_]|(?:weg|straße|strasse|str\.|gasse|platz|allee|ring|damm|ufer|steig|stieg|pfad|markt) \d"
    r"|(?:alle|venida|vda\.|laza|aseo|amino|C/|Via|iale|iazza) |(?:ул\.|улица|пр\.|проспект|пер\.|наб\.) ")
_MAYBE_ID = re.compile(r"\d(?:[\dA-Z .-]{3,}[\dA-Z]|[\dA-Za-z.-]{4,})")
_NAME_WORD = rf"[{_U}](?:[{_L}]+|[{_U}'’-][{_L}]+)(?:[-'’][{_U}]?[{_L}]+)*"
_STREET = re.compile(
    rf"(?<![\w/-])(?:(?:Flat|Apt\.?|Apartment|Unit|Suite) \d+[A-Za-z]?,?\s)?\d{{1,4}}[A-Za-z]?,? (?:{_NAME_WORD} ){{1,3}}"
    r"(?:Lane|Road|Street|Avenue|Ave\b\.?|Way|Drive|Close|Court|Place|Square|Row|Terrace|Gardens|Crescent|Boulevard|Blvd\.?|Rd\b\.?|St\b\.?|Ln\b\.?)(?!\w)"
    rf"|(?<![\w/-])\d{{1,4}}(?: ?(?:bis|ter|[a-z]))?,? (?:rue|avenue|boulevard|place|chemin|allée|quai|impasse|route|cours) (?:(?:de la|de l['’]|des|du|de|d['’]|aux?) ?)?{_NAME_WORD}"
    rf"|(?<!\w)(?:(?:Am|An der|An den|Auf dem|Auf der|Im|In der|Zum|Zur|Unter den) (?:{_NAME_WORD} ){{1,3}}|[{_U}][{_L}-]*(?:weg|straße|strasse|str\.|gasse|platz|allee|ring|damm|ufer|steig|stieg|pfad|markt) )\d{{1,4}} ?[a-z]?(?!\w)"
    rf"|(?<!\w)(?:[Cc]alle|[Aa]venida|[Aa]vda\.|[Pp]laza|[Pp]aseo|[Cc]amino|C/|Via|[Vv]iale|[Pp]iazza) (?:(?:de la|de los|de las|del|de) )?(?:{_NAME_WORD} ?){{1,3}},? ?\d{{1,4}}(?!\w)"
    rf"|(?<!\w)(?:ул\.|улица|пр\.|проспект|пер\.|наб\.) {_NAME_WORD}(?: {_NAME_WORD})?, (?:д\. ?)?\d{{1,4}}"
)
#: What may follow a street in the address: floor, post code and town.
_REST = re.compile(
    rf"(?:,? ?\d{{1,2}}\.[ºª] ?[A-Z]?(?!\w))?(?:,?[ \n](?:\d{{4,6}} )?{_NAME_WORD}(?: [A-Z]{{1,2}}\d{{1,2}}[A-Z]? \d[A-Z]{{2}})?(?: \d{{4,6}})?(?=[\s.,;:)\n]|$))?")
# Nouns that make a label of a name beside them, in the languages of the collection.
_NOUNS_AFTER = ("theorem equation operator bound gauge model theory limit transform relation lemma conjecture law method ansatz algorithm "
                "distribution inequality formula function kernel matrix state space group algebra effect number constant").split()
_NOUNS_BEFORE = ("théorème équation opérateur borne jauge modèle teorema ecuación operador cota modelo satz gleichung operator schranke eichung modell "
                 "теорема теоремы теореме теорему уравнение уравнения уравнению оператор оператора").split()
_LABEL_LINKS = "de d del di von van des der du la".split()
_LABEL_AFTER = re.compile(rf"[\s-]*(?:{'|'.join(_NOUNS_AFTER)})s?\b", re.IGNORECASE)
_LABEL_BEFORE = re.compile(rf"(?:{'|'.join(_NOUNS_BEFORE)})\s(?:de |d['’]|del |von |van |des )?$", re.IGNORECASE)
_PARTICLE = r"(?:van der|van den|van|von der|von|de la|de|del|di|da|le|la|ter|ten|zu|af)"
_PIECE = rf"(?:{_NAME_WORD}|[{_U}]{{3,}}(?:-[{_U}]{{3,}})*)"
_RUN = re.compile(
    rf"(?<![\w'’$\\_^{{-])(?:{_PIECE}, (?:[{_U}]\. ?)*{_PIECE}(?: [{_U}]\.)?"  # surname, given name
    rf"|(?:[{_U}]\.[ -]?){{1,3}}(?:{_PARTICLE} )?{_PIECE}(?: {_PIECE})?"  # initials and surname
    rf"|{_PIECE}(?: (?:[{_U}]\.|{_PARTICLE}|{_PIECE}))*)(?![\w'’^{{]|_)")
_WORD = re.compile(r"[^\W\d_]+")
_BLANK, _FIRST_PIECE, _PIECES = re.compile(r"[\s,]|\.(?=.)"), re.compile(r"[^\s,]+"), re.compile(rf"[{_U}]\.|[^\s,]+")
_TITLE = re.compile(r"\b(?:Dr|Prof|Mr|Mrs|Ms|Mme|M|Herr|Frau|Sr|Sra|Hr|Fr)\.?\s*$")


def _word_parts(text: str) -> list[str]:
    return _WORD.findall(text)


def word_uses(texts: DataFrame, text: str = "text") -> DataFrame:
    """``(w, n, low, start, title, label)`` for every word in lower case: all its uses, those in lower case, capitalised at
    the start of a sentence, capitalised and not in capitals throughout, and beside a noun that makes it a label.

    Words inside addresses of any kind do not count. All texts are counted, with partial aggregation before the shuffle.
    """
    word = (
        r"(?:(?:[.!?…»“”\"|]\s+|\n))?(?<![\p{L}\p{N}._+@=\\-])\p{L}{2,}(?![\p{L}\p{N}_+@]|\.\p{L}|-\p{L}*[@ ]?(?:@|AT |\[at|\(at)|\s?(?:@|AT |[\[(]at))")
    initial = F.regexp_replace(F.concat(F.lit("\n"), F.col(text)), r"\b(\p{Lu}|Dr|Prof|Mr|Mrs|Sra?|Mme|M)\. ", "$1, ")  # no sentence ends there
    listed = texts.select(F.regexp_extract_all(initial, F.lit(word), 0).alias("x")).where(F.size("x") > 0)
    plain = F.transform("x", lambda x: F.when(x.rlike(r"^\p{L}"), x).otherwise(F.regexp_replace(x, r"^\P{L}+", "")))
    listed = listed.select("x", plain.alias("w"), F.transform(plain, lambda x: F.lower(x)).alias("l"))
    at = lambda k: F.coalesce(F.get("l", k), F.lit(""))
    each = F.transform("w", lambda w, k: F.struct(
        w.alias("w"), (F.get("x", k) != w).cast("int").alias("start"),
        (at(k + 1).isin(_NOUNS_AFTER + [n + "s" for n in _NOUNS_AFTER]) | at(k - 1).isin(_NOUNS_BEFORE) | at(k - 1).isin(_LABEL_LINKS) & at(k - 2).isin(_NOUNS_BEFORE)).cast("int").alias("label")))
    counts = listed.select(F.explode(each).alias("x")).groupBy("x.w").agg(F.count("*").alias("n"), F.sum("x.start").alias("start"), F.sum("x.label").alias("label"))
    low = F.col("w") == F.lower("w")
    titled = ~low & (F.col("w") != F.upper("w"))
    return counts.groupBy(F.lower("w").alias("w")).agg(
        F.sum("n").alias("n"), F.sum(F.when(low, F.col("n")).otherwise(0)).alias("low"), F.sum(F.when(low, 0).otherwise(F.col("start"))).alias("start"),
        F.sum(F.when(titled, F.col("n")).otherwise(0)).alias("title"), F.sum(F.when(titled, F.col("label")).otherwise(0)).alias("label"))


def _filter(words: DataFrame) -> HashFilter:
    return HashFilter.made(words.select(F.xxhash64("w").alias("h")))


def word_filters(texts: DataFrame) -> tuple[HashFilter, HashFilter]:
    """Words that are ordinary in this collection, and words that it uses as labels.

    A word is ordinary if at least a twentieth of its uses are in lower case, if most of its capitals stand at the
    start of a sentence, or if it is only ever written in capitals. A word is a label if most of its capitalised uses
    stand beside a noun like *theorem*. Both are filters of a bounded size with a false-positive rate below one in 150.
    """
    uses = cut(word_uses(texts))
    ordinary = ((F.col("low") >= 2) & (F.col("low") * 20 >= F.col("n"))) | ((F.col("n") >= 5) & (F.col("start") > 0.7 * (F.col("n") - F.col("low")))) | (F.col("low") + F.col("title") == 0)
    label = (F.col("label") >= 2) & (F.col("label") * 2 >= F.col("title"))
    return _filter(uses.where(ordinary)), _filter(uses.where(label & ~ordinary))


def _spans(text: str, ordinary, label=lambda w: False) -> list[tuple[int, int, str]]:
    """Non-overlapping ``(start, end, kind)`` in order."""
    taken: list[tuple[int, int, str]] = []

    def free(a: int, b: int) -> bool:
        return all(b <= x or a >= y for x, y, _ in taken)

    def add(a: int, b: int, kind: str) -> None:
        if free(a, b):
            taken.append((a, b, kind))

    if _MAYBE_EMAIL.search(text):
        for m in _EMAIL.finditer(text):
            add(m.start(), m.end(), "email")
    for m in _STREET.finditer(text) if _MAYBE_STREET.search(text) else ():
        rest = _REST.match(text, m.end())
        add(m.start(), rest.end() if rest else m.end(), "address")
    for m in _ID.finditer(text):
        add(m.start(), m.end(), "id_number")
    for m in _ID_WORD.finditer(text) if _MAYBE_ID.search(text) else ():
        if sum(c.isdigit() for c in m[1]) >= 5:
            add(m.start(1), m.end(1), "id_number")
    for m in _PHONE.finditer(text):
        add(m.start(), m.end(), "phone")
    for a, b in _names(text, ordinary, label, taken):
        add(a, b, "name")
    return sorted(taken)


def _names(text: str, ordinary, label, taken) -> Iterator[tuple[int, int]]:
    known = lambda w: ordinary(w) or w.lower() in _FIXED
    position = 0
    while m := _RUN.search(text, position):
        position = m.end()
        if not _BLANK.search(m.group()) and not _TITLE.search(text, max(0, m.start() - 12), m.start()):
            continue  # one word is a name after a title only
        first = _FIRST_PIECE.match(m.group())
        if first.end() < len(m.group()) and all(len(x) == 1 or known(x) for x in _word_parts(first.group())) and len(first.group()) > 2:
            position = m.start() + first.end()  # the run may start at its next word
            continue
        pieces = [(m.start() + p.start(), m.start() + p.end()) for p in _PIECES.finditer(m.group())]
        pieces = [(a, b) for a, b in pieces if all(b <= x or a >= y for x, y, _ in taken)]
        # leave out ordinary words, titles and labels at either end
        is_name = []
        for n, (a, b) in enumerate(pieces):
            w = text[a:b]
            initial = len(w) == 2 and w[1] == "."
            particle = w.islower() or w in ("van", "von", "de")
            dated = w.lower() in _AMBIGUOUS and bool(_NUMBER_BEFORE.search(text[max(0, a - 12) : a]) or _NUMBER_AFTER.match(text, b))
            # "Satz" in "Satz von Lindau": a capitalised noun that makes a label of the name after the particle
            noun = n + 1 < len(pieces) and text[slice(*pieces[n + 1])].islower() and bool(_LABEL_BEFORE.search(w + " "))
            is_name.append("i" if initial else "p" if particle else "x" if dated or noun or text[b : b + 2] == ".:" or any(known(x) for x in _word_parts(w)) or len(w) < 3 else "n")
        at = 0
        while at < len(pieces):
            if is_name[at] not in "in":
                at += 1
                continue
            end = at
            while end + 1 < len(pieces) and is_name[end + 1] in "inp":
                end += 1
            while end > at and is_name[end] == "p":
                end -= 1
            kinds = "".join(is_name[at : end + 1])
            a, b = pieces[at][0], pieces[end][1]
            at = end + 1
            if "n" not in kinds:
                continue
            if kinds[-1] == "i":  # a trailing initial belongs to the name only after "surname, given name"
                if "," not in text[a:b]:
                    b = pieces[at - 1][0]
                    while b > a and text[b - 1] in " ":
                        b -= 1
                    kinds = kinds[:-1]
            if text[b : b + 2] in ("’s", "'s"):
                continue
            before, after = text[max(0, a - 40) : a], text[b : b + 20]
            if _LABEL_AFTER.match(after) or _LABEL_BEFORE.search(before) or after[:1] == "–" or before[-1:] == "–":
                continue
            if all(label(x) for x in _word_parts(text[a:b]) if len(x) > 1 and not x.islower()):
                continue  # the collection uses all its words as labels
            if kinds.count("n") + kinds.count("i") >= 2 or _TITLE.search(before):
                yield a, b


# Capitalised words that are no part of a name.
_FIXED = frozenset("""monday tuesday wednesday thursday friday saturday sunday january february march july september october november december
eq eqs ref refs fig figs sec sect tab thm app vol vgl abb kap abschn gl nr dr prof mr mrs ms mme sr sra herr frau el la le les der die das the an am im isbn doi
flat road street way avenue calle""".split())
#: Words that are names of persons too: left out only where a number or a date stands beside them.
_AMBIGUOUS = frozenset("april may june august grant lane rue".split())
_NUMBER_BEFORE = re.compile(r"\d(?:st|nd|rd|th|\.)?(?: of)?[\s,]+$")
_NUMBER_AFTER = re.compile(r"[\s,]*(?:(?:[Nn]o|[Nn]r)\b\.?|[Nn]umber\b|#|№|\d)")


def entities(documents: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``(doc_id, kind, start_char, end_char, value)``: one row per occurrence, positions in code points.

    Whole texts are read. Null ids or texts and empty texts give no rows; repeated rows give repeated occurrences;
    an empty table gives an empty result; other columns are ignored. Two word filters of bounded size are the only
    thing broadcast. A text without a capital letter, a digit or an at sign is not looked at.
    """
    spark = documents.sparkSession
    texts = documents.select("doc_id", "text").where("doc_id is not null and text is not null and text <> ''")
    held = spark.sparkContext.broadcast(word_filters(spread(texts)))

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        common, labels = held.value
        caches: tuple[dict, dict] = {}, {}

        def asked(which: int, word: str) -> bool:
            cache, word = caches[which], word.lower()
            got = cache.get(word)
            if got is None:
                if len(cache) > 200_000:
                    cache.clear()
                got = cache[word] = xxhash.xxh64_intdigest(word.encode(), 42) in (common, labels)[which]
            return got

        for batch in batches:
            rows = [(doc, kind, a, b, text[a:b]) for doc, text in zip(batch["doc_id"], batch["text"])
                    for a, b, kind in _spans(text, lambda w: asked(0, w), lambda w: asked(1, w))]
            yield pd.DataFrame(rows, columns=["doc_id", "kind", "start_char", "end_char", "value"])

    out = spread(texts.where(F.col("text").rlike(r"[\p{Lu}\p{Nd}@＠]"))).mapInPandas(find, "doc_id long, kind string, start_char int, end_char int, value string")
    return out.where(F.col("kind").isin(keep)) if keep else out


# ---------------------------------------------------------------- surrogates

# Country calling codes of two digits (1 and 7 have one digit, all others three), and words of formats.
_TWO = frozenset("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())
_FORMAT_WORDS = frozenset("""at dot arroba punto chez point ät punkt ext poste durchwahl flat apt apartment unit suite lane road street avenue ave way drive close court place square row terrace gardens
crescent boulevard blvd rd st ln rue chemin allée quai impasse route cours des du de la l d aux au am an der den auf dem im in zum zur unter weg straße strasse str gasse platz allee ring damm ufer steig
stieg pfad markt calle avenida avda plaza paseo camino via viale piazza los las del ул улица пр проспект пер наб д van von di da le ter ten zu af example test invalid org com net""".split())
_SCRIPTS = {  # alphabet, vowels, consonants, codas
    "latin": ("abcdefghijklmnopqrstuvwxyz", "aeiou", "bdfgklmnprstvz", ("", "n", "l", "r", "s", "m")),
    "cyrillic": ("абвгдежзиклмнопрстуфхцчшэюя", "аеиоу", "бвгдзклмнпрст", ("", "н", "л", "р", "с", "м")),
    "greek": ("αβγδεζηθικλμνξοπρστυφχψω", "αεηιο", "βγδκλμνπρστ", ("", "ν", "ς", "ρ")),
}
_EXTENSION = re.compile(r"(?:ext\.?|x|Durchwahl|poste) ?(\d{1,5})\s*$", re.IGNORECASE)


def _stream(key: str, *parts: object) -> Iterator[int]:
    """Numbers drawn from the key for the parts, without end."""
    n = 0
    while True:
        yield from hmac.new(key.encode(), "\x1f".join(map(str, (*parts, n))).encode(), hashlib.sha256).digest()
        n += 1


def _script(letter: str) -> str:
    return "cyrillic" if "\u0400" <= letter <= "\u04ff" else "greek" if "\u0370" <= letter <= "\u03ff" else "latin"


def _bare(letter: str) -> str:
    """The letter of the alphabet under a letter's marks."""
    return unicodedata.normalize("NFD", letter.casefold())[:1]


def _other_letter(letter: str, key: str) -> str:
    """A letter's place in a keyed permutation of its alphabet that leaves no letter in its place; case is kept."""
    script = _script(letter.lower())
    alphabet = _SCRIPTS[script][0]
    order = sorted(alphabet, key=lambda c: hmac.new(key.encode(), f"{script}|{c}".encode(), hashlib.sha256).digest())
    low = _bare(letter)
    new = order[(order.index(low) + 1) % len(order)] if low in alphabet else order[ord(low[:1] or "a") % len(order)]
    return new.upper() if letter.isupper() else new


def _draw_word(word: str, key: str, attempt: int) -> str:
    """A pronounceable word of the same script with the same ending, whose initial is the word's by the permutation."""
    script = _script(word[0])
    _, vowels, consonants, codas = _SCRIPTS[script]
    stream = _stream(key, "word", word, attempt)
    pick = lambda pool: pool[next(stream) % len(pool)]
    out = _other_letter(word[0], key)
    if len(word) == 1 and attempt < 8:
        return out
    for n in range(max(2, len(word) // 3) + attempt // 4):  # later attempts are longer, so there is always room
        out += (pick(consonants) if n or out[-1] in vowels else "") + pick(vowels) + pick(codas)
    last = _bare(word[-1])
    ends = last if last in vowels or last in "аяyь" else pick(consonants)
    return out.rstrip("".join(vowels)) + ends if out[-1] in vowels else out + ends if ends in vowels else out[:-1] + pick(vowels) + ends


def _other_digit(digit: str, draw: int, low: int = 0) -> str:
    """Another digit of at least ``low``."""
    pool = [str(d) for d in range(low, 10) if str(d) != digit]
    return pool[draw % len(pool)]


def phone_parts(value: str) -> tuple[str, str, str, str]:
    """Country code, national number without its trunk zero, extension, and what each digit of the value is:
    ``p`` prefix or trunk, ``c`` country code, ``n`` national number, ``x`` extension."""
    ext = _EXTENSION.search(value)
    body = value[: ext.start()] if ext else value
    digits = re.sub(r"\D", "", body)
    roles, code = "", ""
    if body.lstrip().startswith("+") or digits.startswith("00"):
        roles = "" if body.lstrip().startswith("+") else "pp"
        rest = digits[len(roles):]
        code = rest[: 1 if rest[:1] in ("1", "7") else 2 if rest[:2] in _TWO else 3]
        roles += "c" * len(code)
        if re.search(r"\(0\)", body) or digits[len(roles):].startswith("0"):
            roles += "p"
    elif digits.startswith("0"):
        roles = "p"
    national = digits[len(roles):]
    return code, national, ext[1] if ext else "", roles + "n" * len(national) + "x" * len(ext[1] if ext else "")


def _unit(kind: str, value: str) -> str:
    """What coreferent mentions share: digits of a number, letters and digits of an identity number, folded text."""
    if kind == "phone":
        return phone_parts(value)[1]
    if kind == "id_number":
        return re.sub(r"[\W_]", "", value).casefold()
    return re.sub(r"\s+", " ", unicodedata.normalize("NFC", value)).casefold()


def _draw(kind: str, unit: str, key: str, attempt: int) -> str:
    """The surrogate of a unit: every digit becomes another, every word that is no part of the format a drawn one."""
    if kind == "name":
        return _draw_word(unit, key, attempt)
    stream = _stream(key, kind, unit, attempt)
    if kind in ("phone", "id_number"):
        body = unit.split(":")[-1]
        out = [_other_digit(c, next(stream), int(n == 0)) if c.isdigit() else _other_letter(c, f"{key}{next(stream)}") for n, c in enumerate(body)]
        # where a format has no values left, the number grows
        out += [str(next(stream) % 10) for _ in range(max(0, attempt - 15))]
        code = unit[: -len(body) - 1] if ":" in unit else ""
        same = [c for c in (("1", "7") if len(code) == 1 else sorted(_TWO)) if c != code and len(c) == len(code)]
        return (f"{same[next(stream) % len(same)] if same else ''.join(_other_digit(c, next(stream), 2) for c in code)}:" if code else "") + "".join(out)
    words = re.sub(r"[^\W\d_]+", lambda m: m[0] if m[0] in _FORMAT_WORDS else _draw_word(m[0], f"{key}{next(stream)}", attempt), unit)
    more = max(0, attempt - 15)
    return re.sub(r"\d+", lambda m: "".join(_other_digit(c, next(stream), int(n == 0)) for n, c in enumerate(m[0])) + "".join(str(next(stream) % 10) for _ in range(more)), words)


def _cased(shape: str, new: str) -> str:
    """``new`` in the letter case of ``shape``."""
    letters = [c for c in shape if c.isalpha()]
    if len(letters) > 1 and all(c.isupper() for c in letters):
        return new.upper()
    return new[:1].upper() + new[1:] if letters and letters[0].isupper() else new


def _put(kind: str, value: str, new: dict[str, str], key: str) -> str:
    """The mention with its units' surrogates in its own form: letter case, order, blanks and signs, prefixes."""
    value = unicodedata.normalize("NFC", value)
    if kind == "name":
        return re.sub(r"[^\W\d_]+", lambda m: m[0] if m[0] in _FORMAT_WORDS else _cased(m[0], new.get(m[0].casefold(), m[0])), value)
    drawn = next(iter(new.values()))
    if kind == "phone":
        code, _, body = drawn.rpartition(":")
        *_, roles = phone_parts(value)
        ext = _stream(key, "extension", value)
        sources, out, left = {"c": iter(code), "n": iter(body)}, [], iter(roles)
        for c in value:
            role = next(left, "p") if c.isdigit() else ""
            out.append(c if not role or role == "p" else _other_digit(c, next(ext)) if role == "x" else next(sources[role], c))
        return "".join(out) + "".join(sources["n"])
    if kind == "id_number":
        letters, out = iter(drawn), []
        for c in value:
            n = next(letters, c) if c.isalnum() else c
            out.append(n.upper() if c.isupper() else n)
        return "".join(out) + "".join(letters)
    parts = iter(re.findall(r"[^\W_]+", drawn))
    return re.sub(r"[^\W_]+", lambda m: _cased(m[0], next(parts, m[0])), value)


def _drawer(key: str):
    @pandas_udf("string")
    def draw(kind: pd.Series, unit: pd.Series, attempt: pd.Series) -> pd.Series:
        return pd.Series([_draw(k, u, key, int(a)) for k, u, a in zip(kind, unit, attempt)], dtype=object)

    return draw


def _unit_column(kind: Column, value: Column) -> Column:
    @pandas_udf("array<string>")
    def units(kinds: pd.Series, values: pd.Series) -> pd.Series:
        of_name = lambda v: sorted({w.casefold() for w in re.findall(r"[^\W\d_]+", unicodedata.normalize("NFC", v)) if w not in _FORMAT_WORDS})
        return pd.Series([of_name(v) if k == "name" else [_unit(k, v)] for k, v in zip(kinds, values)])

    return units(kind, value)


def surrogates(units: DataFrame, key: str) -> DataFrame:
    """``(kind, unit, surrogate)`` for ``units(kind, unit)``: keyed, of the same format, and distinct.

    The first unit in order keeps a shared surrogate; the others, and those whose surrogate is a unit of the collection,
    draw again with the next attempt until there are none. Later attempts are longer, so the rounds end.
    """
    draw = _drawer(key)
    values = units.select("kind", "unit").distinct()
    current = cut(values.withColumn("attempt", F.lit(0)).withColumn("surrogate", draw("kind", "unit", "attempt")))
    own = current.select("kind", F.col("unit").alias("surrogate"), F.lit(True).alias("_own"))
    own = cut(own.where("length(surrogate) > 1"))  # initials have one letter: their permutation has no collisions
    while True:
        order = Window.partitionBy("kind", "surrogate").orderBy("attempt", "unit")
        ranked = current.withColumn("_r", F.row_number().over(order)).join(own, ["kind", "surrogate"], "left")
        again = (F.length("unit") > 1) & ((F.col("_r") > 1) | F.col("_own").isNotNull())
        marked = cut(ranked.select("kind", "unit", "attempt", "surrogate", again.alias("_again")))
        redo = marked.where("_again").withColumn("attempt", F.col("attempt") + 1)
        if redo.isEmpty():
            return marked.select("kind", "unit", "surrogate")
        current = cut(marked.where("not _again").drop("_again").unionByName(redo.drop("_again", "surrogate").withColumn("surrogate", draw("kind", "unit", "attempt"))))


def with_country(values: DataFrame) -> DataFrame:
    """Phone units with their country code: the value's own, or for a national form the only one that the collection
    has for this national number."""
    @pandas_udf("string")
    def code(v: pd.Series) -> pd.Series:
        return pd.Series([phone_parts(x)[0] for x in v], dtype=object)

    coded = values.withColumn("_code", F.when(F.col("kind") == "phone", code("value")).otherwise(""))
    known = coded.where("_code <> ''").groupBy("kind", "unit").agg(F.count_distinct("_code").alias("_codes"), F.min("_code").alias("_only"))
    joined = coded.join(known, ["kind", "unit"], "left")
    use = F.when(F.col("_code") != "", F.col("_code")).when(F.col("_codes") == 1, F.col("_only"))
    return joined.withColumn("unit", F.when(use.isNotNull() & (F.col("kind") == "phone"), F.concat(use, F.lit(":"), "unit")).otherwise(F.col("unit"))).select("kind", "value", "unit")


def replacements(documents: DataFrame, key: str) -> DataFrame:
    """``(doc_id, kind, start_char, end_char, value, new)``: every occurrence with its surrogate.

    Surrogates are drawn for distinct units and put into distinct values; occurrences only look their value up, so a
    value of a third of all rows is one row on the other side of that join.
    """
    spans = cut(entities(documents))
    values = cut(with_country(spans.select("kind", "value").distinct().select("kind", "value", F.explode(_unit_column(F.col("kind"), F.col("value"))).alias("unit"))))
    drawn = values.join(surrogates(values, key), ["kind", "unit"])
    gathered = drawn.groupBy("kind", "value").agg(F.map_from_entries(F.collect_list(F.struct("unit", "surrogate"))).alias("new"))

    @pandas_udf("string")
    def put(kind: pd.Series, value: pd.Series, new: pd.Series) -> pd.Series:
        return pd.Series([_put(k, v, dict(n), key) for k, v, n in zip(kind, value, new)], dtype=object)

    return spans.join(gathered.select("kind", "value", put("kind", "value", "new").alias("new")), ["kind", "value"]).select(
        "doc_id", "kind", "start_char", "end_char", "value", "new")


def _rewrite(documents: DataFrame, replaced: DataFrame) -> DataFrame:
    """Texts with ``replaced(doc_id, start_char, end_char, new)`` put in; texts without entities stay as they are."""
    spans = replaced.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("start_char", "end_char", "new"))).alias("_spans"))
    parts = F.aggregate(
        "_spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, x: F.struct(
            x["end_char"].alias("at"),
            F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, x["start_char"] - acc["at"]), x["new"]).alias("out")),
        lambda acc: F.concat(acc["out"], F.expr("substring(text, 1 + _spans[size(_spans) - 1].end_char)")))
    return documents.select("doc_id", "text").join(spans, "doc_id", "left").select(
        "doc_id", F.when(F.col("_spans").isNull(), F.col("text")).otherwise(parts).alias("text"), F.coalesce(F.size("_spans"), F.lit(0)).alias("entities"))


def redact(documents: DataFrame) -> DataFrame:
    """``(doc_id, text, entities)``: every entity replaced by its typed placeholder, all else unchanged.

    Ids are taken as unique. Null and empty texts come back as they are.
    """
    new = entities(documents).withColumn("new", F.concat(F.lit("["), F.upper("kind"), F.lit("]")))
    return _rewrite(documents, new)


def surrogate(documents: DataFrame, key: str) -> DataFrame:
    """As ``redact``, with keyed surrogates in place of placeholders."""
    return _rewrite(documents, replacements(documents, key))


def found(documents: DataFrame, key: str = "found") -> DataFrame:
    """``p9_found``: every occurrence that has got its surrogate: document, kind and first character."""
    return replacements(documents, key).select("doc_id", "kind", "start_char")
