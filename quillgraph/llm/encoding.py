"""Garbled text from wrong character encoding: latent encoding chains by expectation-maximisation.

Every record has a latent chain: none, or a sequence of encodings its text was pushed through (for example UTF-8
bytes read as Windows-1252, perhaps twice). A chain's evidence in one record is the log-likelihood ratio, under the
collection's own character statistics, of the text the chain would restore against the text as it stands. Weak
evidence is pooled: each source and field has its own chain weights, shrunk to the field's overall weights, and EM
alternates between the records' posteriors and the weights. A record is garbled if its posterior for all chains
together exceeds one half, and is repaired by its most probable chain.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillgraph.session import cut, spread

BITS = 18
ROUNDS = 4
PRIOR = 0.003
STRENGTH = 20.0
LEAST = 2.0
MOST = 40.0

# Encodings that UTF-8 bytes are taken for, and pairs (taken for, was) of other encodings.
_TAKEN = ("cp1252", "cp437", "mac_roman", "cp1251", "cp1250", "cp850", "koi8_r", "cp866", "iso8859_7", "iso8859_9", "cp1253", "cp1254")
_PAIRS = (
    ("cp1252", "cp850"), ("cp1252", "cp437"), ("cp1252", "mac_roman"), ("cp1252", "cp1251"), ("cp1252", "koi8_r"), ("cp1252", "cp866"),
    ("cp1252", "cp1253"), ("cp1252", "cp1250"), ("cp1252", "cp1256"), ("cp1252", "cp874"), ("mac_roman", "cp1252"), ("cp850", "cp1252"), ("cp437", "cp1252"),
    ("cp1250", "cp1252"), ("cp1251", "cp1252"), ("cp1251", "koi8_r"), ("koi8_r", "cp1251"), ("cp1251", "cp866"),
)
_WIDE = (("cp1252", "gbk"), ("cp1252", "shift_jis"), ("cp1252", "euc_jp"), ("cp1252", "big5"), ("cp1252", "euc_kr"))
#: Encodings in which ordinary text of another kind hardly ever looks like UTF-8.
_PLAIN = ("cp1252", "cp437", "mac_roman", "cp1251", "cp1250", "cp850")
_UTF8 = re.compile("[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2}|\xed[\x80-\x9f][\x80-\xbf]|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}|\xf4[\x80-\x8f][\x80-\xbf]{2}")
_RUN = re.compile("[^\x00-\x7f]+")
_CONTROLS = re.compile("[\x80-\x84\x86-\x9f]")
_TWO_PAIRS = re.compile("(?:[\x81-\xfe][\x40-\xfe]){2}")
_STRANGE = "￿"


def byte_table(encoding: str) -> dict[int, str]:
    """Characters to the bytes they stand for (as Latin-1 characters), control characters and undefined bytes passing through."""
    table = {c: _STRANGE for c in range(0xA0, 0x100)} | {c: chr(c) for c in range(0x80, 0xA0)}
    for b in range(0x80, 0x100):
        try:
            table[ord(bytes([b]).decode(encoding))] = chr(b)
        except UnicodeDecodeError:
            table[b] = chr(b)
    return table


def _decoder(encoding: str) -> dict[int, str]:
    out = {}
    for b in range(0x80, 0x100):
        try:
            out[b] = bytes([b]).decode(encoding)
        except UnicodeDecodeError:
            out[b] = _STRANGE
    return out


#: Blocks whose characters ordinary text of the usual scripts is made of; a decoded character elsewhere proves nothing.
_LIKELY = re.compile("[\u0080-\u024f\u02b0-\u02ff\u0370-\u052f\u0600-\u06ff\u0900-\u097f\u0e00-\u0e7f\u2000-\u22ff\u2500-\u25ff\u27e8\u27e9\u3000-\u30ff\u4e00-\u9fff\uac00-\ud7af\uff00-\uff60]")
_TWO_WIDE = re.compile("[\u3000-\u30ff\u4e00-\u9fff\uac00-\ud7af]{2}")


class Tables:
    """Translation tables, built once in a worker."""

    def __init__(self) -> None:
        names = {*_TAKEN, *(w for w, _ in _PAIRS), *(w for w, _ in _WIDE)}
        self.bytes = {n: byte_table(n) for n in names}
        self.pairs = []
        for wrong, right in _PAIRS:
            decode = _decoder(right)
            self.pairs.append((f"{wrong}<{right}", {c: decode[ord(b)] for c, b in self.bytes[wrong].items() if b != _STRANGE}))
        cover = {n: {chr(c): b for c, b in t.items() if b != _STRANGE} for n, t in self.bytes.items()}
        some = lambda n, low, high: "[" + "".join(re.escape(c) for c, b in cover[n].items() if low <= b <= high) + "]"
        #: a lead byte and a continuation, as characters: without them no UTF-8 can stand in the text
        self.leads = {n: re.compile(some(n, "\xc2", "\xf4") + some(n, "\x80", "\xbf")) for n in _TAKEN}
        self.stretch = {w: re.compile("[\x00-\x7f" + some(w, "\x80", "\xff")[1:] + "+") for w, _ in _WIDE}


def utf8_once(text: str, table: dict[int, str]) -> tuple[str, int]:
    """Valid UTF-8 sequences among the bytes the text stands for, decoded; their number."""
    mapped = text.translate(table)
    if not _UTF8.search(mapped):
        return text, 0
    out, at, n = [], 0, 0
    for m in _UTF8.finditer(mapped):
        out.append(text[at : m.start()])
        out.append(m.group().encode("latin-1").decode("utf-8"))
        at, n = m.end(), n + 1
    out.append(text[at:])
    return "".join(out), n


def hashes_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the trigrams and characters of texts that hold anything beyond ASCII, and which text each is of."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    c = np.frombuffer(("\n" + "\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    digit = (c >= 48) & (c <= 57)
    c = np.where(digit, np.uint64(48), np.where(c == 10, np.uint64(32), c))
    high = c > 127
    # every character is the middle of a trigram; the signs between texts are not
    inside = np.ones(len(c), bool)
    inside[np.concatenate(([0], np.cumsum(lengths + 1)))] = False
    owner = np.repeat(np.arange(len(texts)), lengths + 1)[: len(c) - 2] if len(texts) else np.empty(0, np.int64)
    three = (high[:-2] | high[1:-1] | high[2:]) & inside[1:-1]
    high = high[1:-1]
    with np.errstate(over="ignore"):
        h = (c[:-2] * np.uint64(0x9E3779B1) + c[1:-1] * np.uint64(0x85EBCA77) + c[2:] * np.uint64(0xC2B2AE3D))[three]
        one = c[1:-1][high] * np.uint64(0x27D4EB2F165667C5) + np.uint64(0x165667B1)
        h = np.concatenate((h, one))
        h ^= h >> np.uint64(29)
        h = h * np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(64 - BITS)).astype(np.int64), np.concatenate((owner[three], owner[high]))


def _bucket(piece: str) -> int:
    """The bucket of one trigram or one character, as ``hashes_of`` has it."""
    c = [48 if 48 <= ord(x) <= 57 else 32 if x == "\n" else ord(x) for x in piece]
    h = c[0] * 0x27D4EB2F165667C5 + 0x165667B1 if len(c) == 1 else c[0] * 0x9E3779B1 + c[1] * 0x85EBCA77 + c[2] * 0xC2B2AE3D
    h &= 0xFFFFFFFFFFFFFFFF
    h = (h ^ h >> 29) * 0xBF58476D1CE4E5B9 & 0xFFFFFFFFFFFFFFFF
    return h >> 64 - BITS


def hashes(text: str) -> np.ndarray:
    """Buckets of one text."""
    return hashes_of([text])[0]


def _spliced(text: str, runs: list[tuple]) -> str:
    """The text with its runs ``(first, end, restored, ...)`` put in."""
    pieces, at = [], 0
    for a, b, after, *_ in runs:
        pieces += [text[at:a], after]
        at = b
    return "".join(pieces) + text[at:]


class Judge:
    """Log-likelihood ratios of restored against given text."""

    def __init__(self, counts: np.ndarray) -> None:
        self.logs = np.log((counts + 0.1) / (counts.sum() + 0.1 * len(counts)) * len(counts) / 4).clip(-6, 8).astype(np.float32)
        self.tables = Tables()
        self.runs: dict[tuple[str, str, str], list[tuple[int, str, float]]] = {}
        self.weights: dict[str, float] = {}
        self.utf8_runs: dict[tuple[str, str, str], list[tuple[int, str, float, int]]] = {}

    def score(self, text: str) -> float:
        return float(self.logs[hashes(text)].sum())

    def _short(self, text: str) -> float:
        """``score`` of a few characters, whose trigrams are looked up: the same ones come again and again."""
        total, padded = 0.0, f"\n{text}\n"
        for n, c in enumerate(text):
            three = padded[n : n + 3]
            if not three.isascii():
                got = self.weights.get(three)
                if got is None:
                    if len(self.weights) > 1_000_000:
                        self.weights.clear()
                    got = self.weights[three] = float(self.logs[_bucket(three)]) + (float(self.logs[_bucket(c)]) if c > "\x7f" else 0.0)
                total += got
        return total

    def _gain(self, left: str, run: str, right: str, after: str) -> float:
        return self._short(left + after + right) - self._short(left + run + right)

    def _utf8_run(self, left: str, run: str, right: str) -> list[tuple[int, str, float, int]]:
        """(encoding, restored run, gain, sequences) of a run between its neighbours; each such run is judged once."""
        key = (left, run, right)
        got = self.utf8_runs.get(key)
        if got is None:
            got, gains = [], {}
            for k, name in enumerate(_TAKEN):
                if self.tables.leads[name].search(run):
                    after, n = utf8_once(run, self.tables.bytes[name])
                    if n:
                        if after not in gains:
                            gains[after] = self._gain(left, run, right, after)
                        got.append((k, after, gains[after], n))
            if len(self.utf8_runs) > 200_000:
                self.utf8_runs.clear()
            self.utf8_runs[key] = got
        return got

    def _utf8(self, text: str) -> list[tuple[str, float, str]]:
        """UTF-8 taken for another encoding; of encodings that restore the same text the first stands for all."""
        by: dict[int, list[tuple[int, int, str, float, int]]] = {}
        for m in _RUN.finditer(text):
            a, b = m.span()
            for k, *rest in self._utf8_run(text[max(0, a - 2) : a], m.group(), text[b : b + 2]):
                by.setdefault(k, []).append((a, b, *rest))
        out: dict[str, tuple[str, float, str]] = {}
        for k in sorted(by):
            after = _spliced(text, by[k])
            if after not in out:
                out[after] = (_TAKEN[k], sum(r[3] for r in by[k]) + min(sum(r[4] for r in by[k]), 3), after)
        return list(out.values())

    def chains(self, text: str) -> list[tuple[str, float, str]]:
        """``(chain, ratio, restored)`` of all chains with evidence, best first."""
        found = [("lossy", MOST, text)] if "�" in text else []
        for name, ratio, after in self._utf8(text):
            # the same mistake may have been made again and again
            total, best, label = ratio, after, f"{name}<utf_8"
            for _ in range(2):
                again = max(self._utf8(best), key=lambda x: x[1], default=None)
                if not again or again[1] <= 0:
                    break
                total, best, label = total + again[1], again[2], f"{label}+{again[0]}"
            found.append((label, total, best))
        found += self._bytes(text)
        found += self._wide(text)
        found = sorted((x for x in found if x[1] >= LEAST), key=lambda x: -x[1])
        once = {t: (c, min(r, MOST), t) for c, r, t in reversed(found)}
        return sorted(once.values(), key=lambda x: -x[1])

    @staticmethod
    def _plausible(left: str, run: str, right: str, after: str) -> bool:
        """Restored letters or quotes that belong to a word: blanks and lone symbols of formulas are no evidence."""
        letters = sum(c.isalpha() for c in after)
        if all(c in "\u00a0\u00ad\u00ac" for c in run):  # blanks and hyphens of layout
            return False
        if letters + sum(c in "¿¡«»“”„‘’–—… " for c in after) < len(after):
            return False
        if "\u0400" <= run[0] <= "\u04ff":
            return letters >= 3
        near = left[-1:].isalpha() or right[:1].isalpha()
        return near and letters + sum(c in "¿¡«»“”„" for c in after) > 0 or letters >= 3

    def _run(self, left: str, run: str, right: str) -> list[tuple[int, str, float]]:
        """(pair, restored run, gain) of the pairs that better a run between its neighbours; each such run is judged once."""
        key = (left, run, right)
        got = self.runs.get(key)
        if got is None:
            got = []
            for k, (_, table) in enumerate(self.tables.pairs):
                after = run.translate(table)
                if after == run or _STRANGE in after or not self._plausible(left, run, right, after):
                    continue
                gain = self._gain(left, run, right, after)
                if gain > 0:
                    got.append((k, after, gain))
            if len(self.runs) > 200_000:
                self.runs.clear()
            self.runs[key] = got
        return got

    def _bytes(self, text: str) -> list[tuple[str, float, str]]:
        """One-byte encodings taken for each other, run by run."""
        gains: dict[int, list[tuple[int, int, str, float]]] = {}
        for m in _RUN.finditer(text):
            a, b = m.span()
            for k, after, gain in self._run(text[max(0, a - 2) : a], m.group(), text[b : b + 2]):
                gains.setdefault(k, []).append((a, b, after, gain))
        out = []
        for k, runs in gains.items():
            total = sum(r[3] for r in runs)
            if total >= LEAST:
                out.append((self.tables.pairs[k][0], total, _spliced(text, self._with_short(text, runs, self.tables.pairs[k][1]))))
        return out

    @staticmethod
    def _with_short(text: str, runs: list[tuple], table: dict[int, str]) -> list[tuple]:
        """The runs, and with them those too short to prove anything, where nearly all that is not ASCII is garbled."""
        every = [m.span() for m in _RUN.finditer(text)]
        if sum(r[1] - r[0] for r in runs) < 0.8 * sum(b - a for a, b in every):
            return runs
        taken = {r[0] for r in runs}
        short = [(a, b, after) for a, b in every if a not in taken and text[a:b].isalpha() and (after := text[a:b].translate(table)).isalpha()]
        return sorted([*(r[:3] for r in runs), *short])

    def _wide(self, text: str) -> list[tuple[str, float, str]]:
        """Two-byte encodings taken for one-byte ones: stretches of characters that are all bytes of the wrong one."""
        out = []
        for wrong in dict.fromkeys(w for w, _ in _WIDE):
            for m in self.tables.stretch[wrong].finditer(text):
                if len(m.group()) < 4 or m.group().isascii():
                    continue
                raw = m.group().translate(self.tables.bytes[wrong])
                if not _TWO_PAIRS.search(raw):
                    continue
                inner = re.search(r"[^\x00-\x7f].*[^\x00-\x7f](?:[@-~](?![a-z]{2}))?", m.group(), re.S)
                if not inner or sum(c > "\x7f" for c in inner.group()) < 3:
                    continue
                raw = inner.group().translate(self.tables.bytes[wrong])
                if _STRANGE in raw:
                    continue
                a, b = m.start() + inner.start(), m.start() + inner.end()
                for right in (r for w, r in _WIDE if w == wrong):
                    after = raw.encode("latin-1").decode(right, "replace")
                    if after.count("�") * 5 > len(after) or not _TWO_WIDE.search(after):
                        continue
                    restored = text[:a] + after.replace("�", "") + text[b:]
                    gain = self.score(restored) - self.score(text) - 3 * after.count("�")
                    if gain >= LEAST:
                        out.append((f"{wrong}<{right}", gain, restored))
        return out


def plainly_garbled(text: str, tables: Tables) -> bool:
    """Strong evidence that needs no statistics; such texts stay out of the first character counts."""
    if "�" in text or _CONTROLS.search(text):
        return True
    for n in _PLAIN:
        if tables.leads[n].search(text):
            found = _UTF8.findall(text.translate(tables.bytes[n]))
            if found and all(_LIKELY.match(x.encode("latin-1").decode("utf-8")) for x in found):
                return True
    return False


def character_counts(texts: DataFrame) -> np.ndarray:
    """Weights of character buckets over all texts ``(source, text)`` that are not plainly garbled: ``2**BITS`` numbers.

    A source's count of a bucket enters as its square root, so a source of a third of all rows that is garbled
    throughout doesn't make its garbage usual.
    """
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables = Tables()
        for batch in batches:
            kept = [n for n, text in enumerate(batch["text"]) if not plainly_garbled(text, tables)]
            if not kept:
                continue
            codes, names = pd.factorize(batch["source"])
            buckets, owner = hashes_of([batch["text"].iat[n] for n in kept])
            sources = codes[np.array(kept)][owner]
            both, n = np.unique(sources << BITS | buckets, return_counts=True)
            yield pd.DataFrame({"source": np.asarray(names)[both >> BITS], "h": (both & (2**BITS - 1)).astype(np.int32), "n": n})

    per_source = texts.select("source", "text").mapInPandas(count, "source string, h int, n long").groupBy("source", "h").agg(F.sum("n").alias("n"))
    counts = np.zeros(2**BITS)
    for row in per_source.groupBy("h").agg(F.sum(F.sqrt("n")).alias("n")).toLocalIterator():
        counts[row["h"]] = row["n"]
    return counts


def diagnose(fields: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``(field, id, source, chain, posterior, restored)``: every garbled record with its most probable chain.

    ``fields(field, id, source, text)``. ``restored`` is null where the chain lost characters for good. Null or empty
    texts and pure ASCII are never garbled; a null source is a source of its own; (field, id) is taken as unique;
    an empty table gives an empty result; other columns are ignored.

    Only records with some evidence enter EM; the others only add to their source's size, which is aggregated first.
    """
    spark = fields.sparkSession
    known = fields.select("field", "id", F.coalesce("source", F.lit("")).alias("source"), "text").where("text is not null and text <> ''")
    high = cut(spread(known.where(F.col("text").rlike(r"[^\x00-\x7f]"))))
    held = spark.sparkContext.broadcast(character_counts(high))

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        by = Judge(held.value)
        for batch in batches:
            rows = [
                (f, i, s, chain, ratio, None if chain == "lossy" else after)
                for f, i, s, t in zip(batch["field"], batch["id"], batch["source"], batch["text"]) for chain, ratio, after in by.chains(t)]
            yield pd.DataFrame(rows, columns=["field", "id", "source", "chain", "ratio", "restored"])

    evidence = cut(high.mapInPandas(judge, "field string, id long, source string, chain string, ratio double, restored string"))
    sizes = known.groupBy("field", "source").agg(F.count("*").alias("n"))
    present = evidence.select("field", "source").distinct()
    sizes = cut(sizes.join(present, ["field", "source"], "left_semi"))
    overall = known.groupBy("field").agg(F.count("*").alias("all"))

    slim = evidence.select("field", "id", "source", "chain", "ratio")
    current = slim.withColumn("weight", F.lit(PRIOR))
    for _ in range(rounds):
        posterior = _posterior(current)
        by_field = posterior.groupBy("field", "chain").agg(F.sum("posterior").alias("mass")).join(F.broadcast(overall), "field")
        shared = by_field.select("field", "chain", ((F.col("mass") + PRIOR) / (F.col("all") + 1)).alias("share"))
        own = posterior.groupBy("field", "source", "chain").agg(F.sum("posterior").alias("mass"))
        weights = own.join(sizes, ["field", "source"]).join(F.broadcast(shared), ["field", "chain"]).select(
            "field", "source", "chain",
            F.least(F.lit(0.5), (F.col("mass") + STRENGTH * F.col("share")) / (F.col("n") + STRENGTH)).alias("weight"))
        current = cut(slim.join(weights, ["field", "source", "chain"]))
    final = _posterior(current)
    best = final.groupBy("field", "id").agg(F.sum("posterior").alias("all"), F.max_by("chain", F.struct("posterior", "chain")).alias("chain"))
    sure = best.where("all > 0.5").select("field", "id", "chain", F.col("all").alias("posterior"))
    return sure.join(evidence.select("field", "id", "source", "chain", "restored"), ["field", "id", "chain"]).select(
        "field", "id", "source", "chain", "posterior", "restored")


def _posterior(current: DataFrame) -> DataFrame:
    """Posteriors of a record's chains; what is missing to one is the posterior of undamaged text."""
    odds = current.withColumn("odds", F.exp("ratio") * F.col("weight"))
    return odds.withColumn("posterior", F.col("odds") / (1 + F.sum("odds").over(Window.partitionBy("field", "id"))))


def fields_of(equations: DataFrame) -> DataFrame:
    """The fields of the task in long form; a paper is a source."""
    return equations.select(F.col("row_id").alias("id"), F.col("arxiv_id").alias("source"), F.explode(F.create_map(
        F.lit("equation"), F.col("equation"), F.lit("text_before"), F.col("text_before"))).alias("field", "text"))


def found(equations: DataFrame) -> DataFrame:
    """``p5_found``: garbled fields, restorable or not."""
    return diagnose(fields_of(equations)).select("field", "id")
