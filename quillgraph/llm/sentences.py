"""Sentence boundaries across languages and scripts: rules compiled into a finite transducer.

A text is read as events: quotes and brackets that open or close, terminators, paragraph breaks, and the kind of
text that follows. Which full stops are terminators is decided by a bounded window around them (abbreviations,
initials, ordinals, decimals). The transducer's states hold what no window can: whether a quotation or bracket is
open, whether it opened the sentence, and whether a terminator is waiting for what follows.

Because its states are few, a chunk of a long document is a function from states to states. Chunks are turned into
such functions independently, the functions are composed by a parallel prefix scan, and every chunk then emits its
boundaries from its true entry state. The result does not depend on the size of the chunks.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgraph.session import spread

CHUNK = 20_000
CONTEXT = 80

# ---------------------------------------------------------------- the transducer

_QUOTE, _BRACKET = ("none", "first", "inside"), ("none", "first", "inside")
_PHASE = ("forced", "fresh", "body", "ended", "weak")
_STATES = list(itertools.product(_QUOTE, _BRACKET, _PHASE))
_NUMBER = {s: n for n, s in enumerate(_STATES)}
_EVENTS = ("open", "close", "straight", "bracket", "unbracket", "end", "break", "upper", "lower", "uncased")
_EVENT = {e: n for n, e in enumerate(_EVENTS)}
START = _NUMBER["none", "none", "forced"]


def _step(state: tuple[str, str, str], event: str) -> tuple[tuple[str, str, str], bool]:
    """The next state, and whether a sentence starts at the event."""
    quote, bracket, phase = state
    if event == "straight":
        event = "open" if quote == "none" else "close"
    if event == "break":
        return ("none", "none", "forced"), False
    outside = quote == "none" and bracket == "none"
    if event in ("open", "bracket"):
        starts = phase == "forced" or outside and phase in ("ended", "weak")
        kind = "first" if starts or phase == "fresh" and outside else "inside"
        state = (kind, bracket, "fresh") if event == "open" else (quote, kind, "fresh")
        return state, starts
    if event in ("close", "unbracket"):
        kind = quote if event == "close" else bracket
        ended = phase in ("ended", "weak")
        if phase == "forced":
            after = "forced"
        elif not ended or kind == "none":
            after = phase if ended else "body"
        elif event == "close":
            after = "weak" if kind == "first" else "ended"
        else:
            after = "ended" if kind == "first" else "weak"
        return (("none", bracket, after) if event == "close" else (quote, "none", after)), False
    if event == "end":
        return (quote, bracket, "ended" if phase != "forced" else "forced"), False
    if phase == "forced":
        return (quote, bracket, "body"), True
    if outside and (phase == "ended" and event != "lower" or phase == "weak" and event == "upper"):
        return (quote, bracket, "body"), True
    return (quote, bracket, "body"), False


#: next state and emission by state and event
TABLE = np.array([[_NUMBER[_step(s, e)[0]] for e in _EVENTS] for s in _STATES], np.int64)
EMITS = np.array([[_step(s, e)[1] for e in _EVENTS] for s in _STATES])

# ---------------------------------------------------------------- the events

_OPEN, _CLOSE = "„«‹「『《〈‟", "”»›」』》〉"
_TOKEN = re.compile(
    rf"(?P<open>[{_OPEN}])|(?P<close>[{_CLOSE}])|(?P<straight>[\"“])|(?P<bracket>[(（\[【])|(?P<unbracket>[)）\]】])"
    r"|(?P<end>[.!?…。！？؟।॥．‼⁇⁈⁉]+(?:\s(?=[»›]))?)|(?P<break>\n[ \t\r]*\n\s*)|(?P<thai>(?<=[฀-๿])\s+(?=[฀-๿]))")

# Abbreviations that never end a sentence, lower case and without the stop.
_NEVER = frozenset("""
eq eqs fig figs ref refs sec sect secs tab tabs thm prop lem cor def app ch chap vol no nos pp p cf resp approx vs viz ie eg i.e e.g al ca dr prof mr mrs ms st rev hon gen col
mme mlle mm m éq éqs réf réfs fig figs p.ex ex c.-à-d env av apr art
abb abschn bd bzw gl gln kap nr s vgl z d h u o evtl ggf inkl sog tab usf hr fr str jan feb mär apr jun jul aug sep sept okt nov dez
ec ecs ej pág págs ss sr sra srta ud uds ee uu núm cap dra
рис табл разд ур ф-ла см ср тыс млн млрд т е п пп с стр гл проф акад д др им напр т.е
समी डॉ चि श्री
د ص م أ ج
""".split())
# Abbreviations that end a sentence when something that can start one follows.
_MAY = frozenset("etc usw a.s a.m p.m u.k u.s u.s.a e.u jr sr inc ltd co г гг д др ff ss".split())
_TITLES = frozenset("as by et dr prof mr mrs ms проф акад m mme".split())
_AFTER_ORDINAL = frozenset("""januar februar märz april mai juni juli august september oktober november dezember jan feb mär apr jun jul aug sep sept okt nov dez
ordnung grades grad art klasse stufe auflage jahrhundert kapitel teil""".split())
_GREEK = frozenset("""alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega""".split())
_BEFORE = re.compile(r"((?:(?<![\w$])[^\W\d_]\.\s?)*(?:[^\W\d_]|-(?=[^\W\d_]))+(?:\.-?[^\W\d_]+)*)\Z")
_REFERENCE = re.compile(r"(?:^|[\s(])([^\W\d_]+)\.\s*\Z")
_NEXT = re.compile(r"\s*([$#]?)([^\W\d_]+)?([_^'’]?)")


def _starts(text: str, at: int) -> str:
    """The kind of text at ``at``: can it start a sentence?"""
    c = text[at]
    if c in "–—-" or c in ",;:，；：、،؛%/":
        return "lower"
    m = _NEXT.match(text, at)
    word = m[2]
    if m[1] or not word:
        return "upper"
    first = word[0]
    if first.isupper() or first.istitle():
        return "upper"
    if not first.islower():
        return "uncased"
    if m[3] in ("_", "^") or word in _GREEK or "Ͱ" <= first <= "Ͽ":
        return "upper"
    if m[3] in ("'", "’"):
        return "upper" if len(word) == 1 and word not in "cdjlmnstq" else "lower"
    return "upper" if len(word) == 1 and word not in "aeoyàùéиавскоуяв" else "lower"


def _ends(text: str, a: int, b: int) -> bool:
    """Is the run of stops ``text[a:b]`` a terminator?"""
    stops = text[a:b].strip()
    after = text[b : b + 1]
    if stops[-1] in "。！？؟।॥．‼⁇⁈⁉" or stops[0] in "。！？":
        return True
    if "…" in stops or stops.startswith(".."):
        if "……" in stops or after == "" or after.isspace():
            return True
        return after in _CLOSE + "“\")）]" or bool(re.match(r"[぀-ヿ㐀-鿿]", after))
    if stops[-1] in "!?":
        return after == "" or after.isspace() or after in _CLOSE + "“\")）]’'*_" or not after.isalnum()
    # a single full stop
    if after and not after.isspace() and after not in _CLOSE + "“\")）]’'":
        return False
    left = text[max(0, a - CONTEXT) : a]
    if left[-1:].isdigit():
        number = re.search(r"(?:^|[^\w.,])(\d{1,2})\Z", left)
        follows = re.match(r"\s+([^\W\d_]+)", text[b : b + CONTEXT])
        if number and follows and follows[1].lower() in _AFTER_ORDINAL and not (
            (ref := _REFERENCE.search(left[: -len(number[1])])) and ref[1].lower() in _NEVER):
            return False
        return True
    m = _BEFORE.search(left)
    if not m:
        return True
    word = re.sub(r"\s", "", m[1])
    low = word.lower()
    last = re.split(r"[.\s]", m[1])[-1]
    before = left[: m.start()].rstrip()
    attached = left[m.start() - 1 : m.start()] if m.start() else ""
    if attached in ("_", "^", "}", "$", "\\", "&", "@", "/") or attached.isdigit():
        return True
    follows = text[b : b + CONTEXT].lstrip()
    if low in ("т.д", "т.п", "a.s", "u.a"):
        return low != "u.a"
    if low in _MAY:
        return True
    if len(last) == 1 and last.isalpha():
        if last.lower() == last.upper():  # scripts without case
            return low not in _NEVER
        if last.isupper():  # an initial, a unit or a symbol
            if low in _MAY:
                return True
            previous = re.search(r"([^\W\d_]+)\.?\Z", before)
            name = re.match(r"(?:[^\W\d_]\.\s?)*[A-ZÀ-ÞА-Я][^\W\d_]+", follows)
            dotted = len(word) > 1
            if dotted and not name:
                return word.lower() not in _NEVER and bool(re.match(r"[^a-zа-яà-ÿ]", follows or "A"))
            if name and (dotted or not before or previous and previous[1].lower() in _TITLES):
                return False
            if low in _NEVER and last in "SM" and (re.match(r"\d", follows) or name and previous and previous[1] in ("et", "de", "à", "par", "selon")):
                return False
            return True
        if dotted_abbreviation(m[1], follows):
            return False
        if low in _NEVER and low in ("p", "s", "d", "z", "u", "h", "o", "т", "е", "п", "с", "г", "m", "д"):
            if re.match(r"\d|[(\[]", follows) or re.match(r"(?:ex|ej|B|h|a|o|е|д|п)\.", follows):
                return False
            return bool(re.search(r"[=\s]\Z", left[: m.start()]) and not re.match(r"[a-zа-я]{2}", follows))
        return True
    if low in _NEVER or last.lower() in _NEVER and len(last) > 1:
        return False
    return True


def dotted_abbreviation(left: str, follows: str) -> bool:
    """``z. B.``, ``d. h.``, ``p. ex.``, ``т. е.`` and the like, at either of their stops."""
    return re.sub(r"\s", "", left).lower() in ("z.b", "d.h", "s.o", "s.u", "u.a", "i.e", "e.g", "т.е", "т.к", "o.ä", "p.ex", "p.ej", "v.a", "m.e", "z.t")


def events(text: str, first: int = 0, last: int | None = None) -> tuple[list[int], list[int]]:
    """Events whose position lies in ``[first, last)``, and these positions; the rest of ``text`` is context."""
    last = len(text) if last is None else last
    kinds, places = [], []

    def content(a: int, b: int) -> None:
        while a < b and text[a].isspace():
            a += 1
        if a < b:
            add(_starts(text, a), a)

    def add(kind: str, at: int) -> None:
        if first <= at < last:
            kinds.append(_EVENT[kind])
            places.append(at)

    at, abbreviated = 0, -1
    for m in _TOKEN.finditer(text):
        kind = m.lastgroup
        if kind == "end" and not _ends(text, *m.span()):
            abbreviated = m.end()
            continue
        if kind == "break" and m.start() == abbreviated:  # a break after an abbreviation is layout
            continue
        if kind == "thai":
            content(at, m.start())
            add("end", m.start())
            at = m.end()
            continue
        content(at, m.start())
        if kind in ("bracket",) and m.group() in "(（" :
            close = re.compile(r"[^()（）]*(?:[(（][^()（）]*[)）][^()（）]*)*[)）]").match(text, m.end(), m.end() + 600)
            # a bracket after a sentence is one of its own only if it ends like one
            if close and not re.search(r"[.!?…。！？؟।]['\"”»」]?[)）]\Z", close.group()):
                add("lower", m.start())
                at = m.start() + 1
                continue
        if kind in ("bracket", "unbracket") and m.group() in "[]【】":
            add("lower", m.start()) if m.group() in "[【" else None
            at = m.end()
            continue
        add(kind, m.start())
        at = m.end()
    content(at, len(text))
    return kinds, places


def boundaries(text: str) -> list[int]:
    """Starts of all sentences of a text."""
    kinds, places = events(text)
    return _emit(kinds, places, START)[0]


def _emit(kinds: list[int], places: list[int], state: int) -> tuple[list[int], int]:
    out = []
    for k, p in zip(kinds, places):
        if EMITS[state, k]:
            out.append(p)
        state = TABLE[state, k]
    return out, state


def transition(kinds: list[int]) -> np.ndarray:
    """The chunk as a function: its exit state for every entry state."""
    f = np.arange(len(_STATES))
    for k in kinds:
        f = TABLE[f, k]
    return f


def prefix_scan(functions: np.ndarray) -> np.ndarray:
    """Entry state of every chunk: inclusive Hillis-Steele scan of the composition, then shifted by one."""
    scanned, step = functions.copy(), 1
    while step < len(scanned):
        moved = scanned.copy()
        # (later after earlier): apply the earlier prefix first
        moved[step:] = np.take_along_axis(scanned[step:], scanned[:-step], axis=1)
        scanned, step = moved, step * 2
    return np.concatenate([[START], scanned[:-1, START]])


# ---------------------------------------------------------------- the operator


def split(texts: DataFrame, keys: list[str], text: str = "text", chunk: int = CHUNK) -> DataFrame:
    """``(keys..., start_char)``: one row per sentence of every row of ``texts``.

    The keys are taken as unique. Null, empty and blank texts have no sentences; an empty table gives an empty
    result; other columns are ignored. Texts over ``chunk`` characters are processed in chunks of that size.
    """
    schema = ", ".join(f"{n} {t}" for n, t in texts.select(*keys).dtypes)
    known = spread(texts.select(*keys, F.col(text).alias("_text")).where(F.col(text).isNotNull()))

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            starts = [boundaries(t) for t in batch["_text"]]
            out = batch[keys].loc[batch.index.repeat([len(s) for s in starts])].reset_index(drop=True)
            out["start_char"] = np.array(list(itertools.chain.from_iterable(starts)), np.int32)
            yield out

    short = known.where(F.length("_text") <= chunk).mapInPandas(whole, f"{schema}, start_char int")
    def pieced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, row in batch.iterrows():  # one long text at a time
                ks = range((len(row["_text"]) - 1) // chunk + 1)
                out = pd.DataFrame({name: [row[name]] * len(ks) for name in keys})
                out["k"], out["t"] = np.array(ks, np.int32), [row["_text"][(at := max(k * chunk - CONTEXT, 0)) : at + chunk + 2 * CONTEXT + 700] for k in ks]
                yield out

    pieces = known.where(F.length("_text") > chunk).mapInPandas(pieced, f"{schema}, k int, t string")

    def span(k: int, t: str) -> tuple[list[int], list[int], int]:
        lead = min(CONTEXT, k * chunk)
        kinds, places = events(t, lead, min(lead + chunk, len(t)))
        return kinds, places, k * chunk - lead

    def functions(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = batch[[*keys, "k"]].copy()
            out["f"] = [transition(span(k, t)[0]).tolist() for k, t in zip(batch["k"], batch["t"])]
            yield out

    def scan(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("k")
        out = group[[*keys, "k"]].copy()
        out["entry"] = prefix_scan(np.array(group["f"].tolist(), np.int64))
        return out

    # a document's functions are 45 numbers per 20,000 characters: what one task gathers is small
    entries = pieces.mapInPandas(functions, f"{schema}, k int, f array<int>").groupBy(*keys).applyInPandas(scan, f"{schema}, k int, entry int")

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            starts = []
            for k, t, entry in zip(batch["k"], batch["t"], batch["entry"]):
                kinds, places, shift = span(k, t)
                starts.append([p + shift for p in _emit(kinds, places, entry)[0]])
            out = batch[keys].loc[batch.index.repeat([len(s) for s in starts])].reset_index(drop=True)
            out["start_char"] = np.array(list(itertools.chain.from_iterable(starts)), np.int32)
            yield out

    long = pieces.join(entries, [*keys, "k"]).mapInPandas(emit, f"{schema}, start_char int")
    return short.unionByName(long)


def found(equations: DataFrame, tasks: DataFrame) -> DataFrame:
    """``p6_found``: sentence starts of the tasks' fields."""
    asked = tasks.dropna(subset=["row_id", "field"]).distinct()
    fields = equations.select("row_id", F.explode(F.create_map(
        F.lit("text_before"), F.col("text_before"), F.lit("text_after"), F.col("text_after"))).alias("field", "text")).where("text is not null")
    return split(asked.join(fields, ["row_id", "field"]), ["row_id", "field"]).select("row_id", "field", "start_char")
