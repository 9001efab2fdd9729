"""Evaluation texts leaking into training text: greedy string tiling of passages over documents.

Seeds, windows of ``SEED`` tokens, are hashed by two Karp-Rabin rolling hashes. The seeds of the documents that a
passage can have (a filter of bounded size says so) are joined with those of the passages on both hashes, 128 bits, and
gathered by document and passage. There, seeds are extended along their diagonals, and the longest match whose tokens
are still unmarked is marked, again and again, until none of ``SEED`` tokens is left. The order of the passages'
parts in the document does not matter, so reordered copies are found. A passage leaks if its marked tokens, with the
single words exchanged between two tiles, cover enough of it.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgraph.llm.filters import HashFilter
from quillgraph.llm.glyphs import normal_text
from quillgraph.session import cut, spread

SEED = 4
COVERAGE = 0.5
_BASES = (np.uint64(1_000_003), np.uint64(0x9E3779B97F4A7C15))
_WORD = re.compile(r"[^\W_]+")
_BROKEN = re.compile(r"(?<=\w)[-¬­‐]\s*\n\s*(?=\w)")


def words(text: str) -> list[str]:
    """Tokens that case, punctuation, blanks, layout and look-alike letters leave alone."""
    if "\n" in text:
        text = _BROKEN.sub("", text)
    return _WORD.findall(text.lower() if text.isascii() else normal_text(text))


class _Known(dict):
    """64-bit hashes of words, each made once."""

    def __missing__(self, word: str) -> int:
        import xxhash

        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def token_hashes(tokens: list[str], known: dict[str, int] | None = None) -> np.ndarray:
    """64-bit hashes of tokens; ``known`` keeps those met before."""
    known = _Known() if known is None else known
    return np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens))


def rolling(tokens: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Two Karp-Rabin hashes, with two bases, of all windows of ``size`` tokens, modulo 2^64."""
    n = max(0, len(tokens) - size + 1)
    out = tuple(np.zeros(n, np.uint64) for _ in _BASES)
    with np.errstate(over="ignore"):
        for k in range(size if n else 0):
            for h, base in zip(out, _BASES):
                h *= base
                h += tokens[k : k + n]
        for h in out:  # the last bits of a product say little
            h ^= h >> np.uint64(29)
            h *= np.uint64(0xBF58476D1CE4E5B9)
            h ^= h >> np.uint64(32)
    return out


def tile(seeds: list[tuple[int, int]], seed: int, of_text: int, of_item: int) -> list[tuple[int, int, int]]:
    """Greedy tiles ``(text position, passage position, length)``: longest first, none overlapping on either side."""
    runs: dict[int, list[int]] = {}
    for p, q in seeds:
        runs.setdefault(p - q, []).append(q)
    heap: list[tuple[int, int, int]] = []
    for diagonal, qs in runs.items():
        qs.sort()
        start = last = qs[0]
        for q in [*qs[1:], None]:
            if q is None or q > last + 1:
                heap.append((-(last - start + seed), start + diagonal, start))
                start = q
            last = q
    heapq.heapify(heap)
    text, item = np.zeros(of_text, bool), np.zeros(of_item, bool)
    tiles = []
    while heap:
        length, p, q = heapq.heappop(heap)
        length = -length
        free = ~(text[p : p + length] | item[q : q + length])
        if free.all():
            text[p : p + length] = item[q : q + length] = True
            tiles.append((p, q, length))
            continue
        edges = np.flatnonzero(np.diff(np.concatenate(([0], free.astype(np.int8), [0]))))
        for a, b in zip(edges[::2], edges[1::2]):
            if b - a >= seed:
                heapq.heappush(heap, (-int(b - a), p + int(a), q + int(a)))
    return tiles


def coverage(tiles: list[tuple[int, int, int]], of_item: int) -> float:
    """Share of the passage's tokens in tiles, counting up to two exchanged tokens between tiles of one stretch."""
    covered = np.zeros(of_item, bool)
    ordered = sorted(tiles, key=lambda t: t[1])
    for p, q, n in ordered:
        covered[q : q + n] = True
    for (p, q, n), (p2, q2, _) in zip(ordered, ordered[1:]):
        if 0 < q2 - q - n <= 2 and 0 <= p2 - p - n <= 3:
            covered[q + n : q2] = True
    return float(covered.mean())


def _seeds(texts: DataFrame, key: str, text: str, sizes: list[int] | None = None, wanted=None) -> DataFrame:
    """``(key, at, h, g, size)``: the seeds of every text, each of at most ``SEED`` tokens.

    Without ``sizes`` a text has seeds of ``SEED`` tokens or, if it is shorter, of all it has, and ``size`` is its number
    of tokens. With them it has seeds of all these sizes, those that the filter ``wanted`` lets through.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _Known()
        for batch in batches:
            if len(known) > 500_000:
                known.clear()
            read = [words(t) for t in batch[text]]
            lengths = np.fromiter(map(len, read), np.int64, len(read))
            tokens = token_hashes([w for r in read for w in r], known)
            # all texts of a batch in one row of tokens: windows across two texts are left out
            owner, first = np.repeat(np.arange(len(read)), lengths), np.cumsum(lengths) - lengths
            parts = []
            for size in sizes or range(1, SEED + 1):
                h, g = rolling(tokens, size)
                kept = owner[: len(h)] == owner[size - 1 :]
                if not sizes:  # a text's own seeds: of SEED tokens, or of all it has
                    kept &= np.minimum(lengths, SEED)[owner[: len(h)]] == size
                at = np.flatnonzero(kept)
                if wanted:
                    at = at[wanted.value.mask(h[at])]
                whose = owner[at]
                parts.append((batch[key].to_numpy()[whose], at - first[whose], h[at].view(np.int64), g[at].view(np.int64), np.full(len(at), size) if sizes else lengths[whose]))
            columns = [np.concatenate(x) for x in zip(*parts)]
            yield pd.DataFrame(dict(zip((key, "at", "h", "g", "size"), columns)))

    return spread(texts.select(key, text).where(F.col(text) != "").dropna()).mapInPandas(run, f"{key} long, at int, h long, g long, size int")


def leaks(documents: DataFrame, items: DataFrame, least: float = COVERAGE) -> DataFrame:
    """Every (document, passage) whose tiles cover at least ``least`` of the passage, with the coverage.

    ``documents(doc_id, text)``, ``items(item_id, passage)``; other columns are ignored. Returns
    ``(doc_id, item_id, coverage, tiles)``. Null ids and null or empty texts leak nothing; repeated rows of a
    document or passage give one row; empty tables give an empty result.

    Documents are read once. Only seeds that a passage may share are shuffled; a seed of many passages is split by
    the join, and what meets in a row are the shared seeds of one document and one passage.
    """
    spark = documents.sparkSession
    stated = items.select("item_id", "passage").dropna().dropDuplicates(["item_id"])
    theirs = cut(_seeds(stated, "item_id", "passage"))
    sizes = [r[0] for r in theirs.select(F.least(F.lit(SEED), "size").alias("n")).distinct().orderBy("n").collect()]  # at most SEED numbers
    wanted = spark.sparkContext.broadcast(HashFilter.made(theirs.select("h").distinct()))
    ours = _seeds(documents, "doc_id", "text", sizes, wanted) if sizes else spark.createDataFrame([], "doc_id long, at int, h long, g long, size int")
    pairs = ours.select("doc_id", F.col("at").alias("p"), "h", "g", F.col("size").alias("seed")).join(
        theirs.select("item_id", F.col("at").alias("q"), "h", "g", "size", F.least(F.lit(SEED), "size").alias("seed")), ["h", "g", "seed"])
    # tiles are made of seeds: too few of them can't cover enough
    both = pairs.groupBy("doc_id", "item_id", "size", "seed").agg(F.collect_set(F.struct("p", "q")).alias("seeds"))
    places = F.size(F.array_distinct(F.transform("seeds", lambda s: s["q"])))
    both = both.where(places * F.col("seed") >= F.lit(least / 2) * F.col("size"))

    def tiled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc, item, size, seed, seeds in batch.itertuples(index=False):
                places = [(s["p"], s["q"]) for s in seeds]
                tiles = tile(places, seed, max(p for p, _ in places) + seed, size)
                share = coverage(tiles, size)
                if share >= least:
                    rows.append((doc, item, share, len(tiles)))
            yield pd.DataFrame(rows, columns=["doc_id", "item_id", "coverage", "tiles"])

    return both.mapInPandas(tiled, "doc_id long, item_id long, coverage double, tiles int")


def found(documents: DataFrame, items: DataFrame) -> DataFrame:
    """``p8_found``: the leaking (document, passage) pairs."""
    return leaks(documents, items).select("doc_id", "item_id")
