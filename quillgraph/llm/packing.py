"""Filling fixed-capacity containers with documents: linear grouping over the histogram of sizes.

The plan of a kind of container is made in one task from the histogram of sizes. It has at most ``capacity`` entries,
whatever the number of documents; every step of the plan works on runs of equal containers, never on single documents.
Nothing reaches the driver.

1. A document larger than the capacity is cut into full pieces and one rest; no other document is cut.
2. Large sizes (over ``capacity * small``) are put into ``groups`` groups of equal cardinality and rounded up to the
   largest of their group. A configuration programme over these few sizes is solved by column generation; each
   column is one way to fill a container.
3. The actual documents take the places of the rounded sizes, largest first, so every place is at least as large as
   its document. What does not fit whole configurations is packed best-fit.
4. Small sizes go best-fit, in decreasing order, into the space that is left, then into new containers.

Ranks within (container kind, size) turn the plan's runs into a container for every document, by joins only.
"""

from __future__ import annotations

import bisect
from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from quillgraph.session import cut

GROUPS = 128
SMALL = 1 / 3
_SALTS = 64
_PLAN = StructType([
    StructField("spec_id", IntegerType()), StructField("size", IntegerType()), StructField("first_rank", LongType()),
    StructField("last_rank", LongType()), StructField("first_container", LongType()), StructField("per_container", IntegerType()),
])


def document_size() -> F.Column:
    """Tokens of a document: ``n_tokens``, or where it is null one per UTF-8 byte and an end token; null text is empty."""
    return F.coalesce(F.col("n_tokens"), F.octet_length(F.coalesce(F.col("text"), F.lit(""))) + 1).cast("int")


# ---------------------------------------------------------------- the configuration programme


def _knapsack(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable way to fill one container; repeats allowed. Layers by number of items."""
    most = int(capacity // sizes.min())
    best = np.zeros(capacity + 1)
    picks = []
    for _ in range(most):
        nxt, pick = best.copy(), np.full(capacity + 1, -1, np.int32)
        for k, (s, v) in enumerate(zip(sizes, values)):
            if v <= 0:
                continue
            offer = best[: capacity + 1 - s] + v
            better = offer > nxt[s:] + 1e-12
            nxt[s:][better] = offer[better]
            pick[s:][better] = k
        picks.append(pick)
        best = nxt
    column = np.zeros(len(sizes))
    room = capacity
    for pick in reversed(picks):
        if pick[room] >= 0:
            column[pick[room]] += 1
            room -= sizes[pick[room]]
    return float(best[capacity]), column


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 400) -> list[tuple[np.ndarray, int]]:
    """Ways to fill a container with their whole numbers of uses, covering no more than ``demand``.

    Column generation with a revised simplex; the fractional optimum is rounded down. The first basis is diagonal and
    every exchange updates its inverse by one rank, elementwise: no matrix is ever factorised.
    """
    n = len(sizes)
    each = np.array([max(1.0, min(capacity // sizes[k], demand[k])) for k in range(n)])
    basis, inverse, x = np.diag(each), np.diag(1 / each), demand / each
    for _ in range(rounds):
        value, column = _knapsack(sizes, inverse.sum(axis=0), capacity)
        if value <= 1 + 1e-7:
            break
        direction = (inverse * column).sum(axis=1)
        ratio = np.where(direction > 1e-9, x / np.where(direction > 1e-9, direction, 1), np.inf)
        leave = int(np.argmin(ratio))
        if not np.isfinite(ratio[leave]):
            break
        basis[:, leave] = column
        row, step = inverse[leave] / direction[leave], x[leave] / direction[leave]
        inverse -= np.multiply.outer(direction, row)
        x = x - direction * step
        inverse[leave], x[leave] = row, step
    whole = np.floor(np.maximum(x, 0) + 1e-9).astype(int)
    return [(basis[:, k].astype(int), int(whole[k])) for k in range(n) if whole[k] >= 1]


# ---------------------------------------------------------------- the plan


class _Open:
    """Open containers by free space: runs (first container, number) of equal containers."""

    def __init__(self) -> None:
        self.spaces: list[int] = []
        self.runs: dict[int, list[tuple[int, int]]] = defaultdict(list)

    def add(self, space: int, first: int, number: int) -> None:
        if space > 0 and number > 0:
            if not self.runs[space]:
                bisect.insort(self.spaces, space)
            self.runs[space].append((first, number))

    def take(self, need: int) -> tuple[int, int, int] | None:
        """The run with the least space that still holds ``need``."""
        at = bisect.bisect_left(self.spaces, need)
        if at == len(self.spaces):
            return None
        space = self.spaces[at]
        first, number = self.runs[space].pop()
        if not self.runs[space]:
            self.spaces.pop(at)
        return space, first, number


def plan(histogram: dict[int, int], capacity: int, groups: int = GROUPS, small: float = SMALL) -> tuple[list[tuple], int]:
    """Runs ``(size, first_rank, last_rank, first_container, per_container)`` and the number of containers.

    ``histogram`` gives the number of documents of each size from 1 to ``capacity``. Rank ``r`` of a run goes into
    container ``first_container + (r - first_rank) // per_container``.
    """
    runs: list[tuple] = []
    used: dict[int, int] = defaultdict(int)
    left = {s: n for s, n in histogram.items() if n > 0 and s > 0}
    open_, total = _Open(), 0
    large = sorted((s for s in left if s > capacity * small), reverse=True)

    def place(size: int, number: int, first: int, each: int) -> None:
        runs.append((size, used[size], used[size] + number - 1, first, each))
        used[size] += number
        left[size] -= number

    if large:
        # equal-cardinality groups, cut at sizes so that a group is an interval of sizes
        count, per_group = 0, max(1, -(-sum(left[s] for s in large) // groups))
        tops, members = [], []
        for s in large:
            if not members or count >= per_group:
                tops.append(s)
                members.append([])
                count = 0
            members[-1].append(s)
            count += left[s]
        demand = np.array([sum(left[s] for s in m) for m in members], float)
        for column, times in configurations(np.array(tops), demand, capacity):
            # every place of the configuration takes the next documents of its group, largest first
            cells = [(g, j) for g in range(len(tops)) for j in range(int(column[g]))]
            pieces = [(0, times, 0)]  # (offset, number, filled)
            for g, _ in cells:
                out = []
                for offset, number, filled in pieces:
                    while number:
                        size = next((s for s in members[g] if left[s] > 0), None)
                        if size is None:
                            out.append((offset, number, filled))
                            break
                        n = min(number, left[size])
                        place(size, n, total + offset, 1)
                        out.append((offset, n, filled + size))
                        offset, number = offset + n, number - n
                pieces = out
            for offset, number, filled in pieces:
                open_.add(capacity - filled, total + offset, number)
            total += times
    for size in sorted(left, reverse=True):  # the rest of the large ones, then the small ones, best-fit
        while left[size]:
            got = open_.take(size)
            if got is None:
                each = capacity // size
                whole, rest = divmod(left[size], each)
                if whole:
                    place(size, whole * each, total, each)
                    open_.add(capacity - each * size, total, whole)
                    total += whole
                if rest:
                    place(size, rest, total, rest)
                    open_.add(capacity - rest * size, total, 1)
                    total += 1
                continue
            space, first, number = got
            each = space // size
            whole = min(number, left[size] // each)
            if whole:
                place(size, whole * each, first, each)
                open_.add(space - each * size, first, whole)
                open_.add(space, first + whole, number - whole)
            else:
                n = left[size]
                place(size, n, first, n)
                open_.add(space - n * size, first, 1)
                open_.add(space, first + 1, number - 1)
    return runs, total


# ---------------------------------------------------------------- the operator


def pack(documents: DataFrame, specs: DataFrame, groups: int = GROUPS, small: float = SMALL) -> DataFrame:
    """The container of every document or piece, for every kind of container.

    Returns ``(spec_id, doc_id, piece, start_token, size, container)``; ``piece`` is 0 for an uncut document and
    counts pieces from 0 otherwise, ``start_token`` is where the piece begins. Repeated documents are packed once
    for each row; rows with a null ``doc_id`` and specs with a null or non-positive capacity are left out; a null
    text without ``n_tokens`` is one end token. Empty tables give an empty result. Other columns are ignored.

    Ranks are taken per (spec, size, salt) and shifted by counts, so that a size shared by a third of all documents
    is spread over ``64`` partitions; runs are cut at the same borders, so a piece meets those of its own salt only.
    """
    kinds = specs.select("spec_id", "capacity").where("spec_id is not null and capacity > 0").distinct()
    sized = documents.where("doc_id is not null").select("doc_id", document_size().alias("n"))
    # containers' kinds are a stated small table: each document is repeated once per kind
    each = sized.join(F.broadcast(kinds))
    whole = (F.col("n") / F.col("capacity")).cast("int")
    pieces = each.withColumn("piece", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("n") / F.col("capacity")).cast("int") - 1, F.lit(0)))))
    pieces = pieces.withColumn("size", F.when(F.col("piece") < whole, F.col("capacity")).otherwise(F.col("n") - whole * F.col("capacity")))
    pieces = cut(pieces.select(
        "spec_id", "doc_id", "piece", (F.col("piece") * F.col("capacity")).alias("start_token"), "size",
        (F.pmod(F.xxhash64("doc_id", "piece"), F.lit(_SALTS))).cast("int").alias("salt")))
    counts = cut(pieces.groupBy("spec_id", "size", "salt").agg(F.count("*").alias("n")))
    histogram = counts.groupBy("spec_id", "size").agg(F.sum("n").alias("n")).join(F.broadcast(kinds), "spec_id")

    def planned(sizes: pd.DataFrame) -> pd.DataFrame:
        rows = plan(dict(zip(sizes["size"].tolist(), sizes["n"].tolist())), int(sizes["capacity"].iloc[0]), groups, small)[0]
        return pd.DataFrame([(sizes["spec_id"].iloc[0], *r) for r in rows], columns=_PLAN.fieldNames())

    # at most ``capacity`` rows a kind of container meet in a task
    runs = cut(histogram.groupBy("spec_id").applyInPandas(planned, _PLAN))

    before = Window.partitionBy("spec_id", "size").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select("spec_id", "size", "salt", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    # the stretch of every run that falls to a salt: a piece meets the runs of its own salt only
    cells = shift.join(runs, ["spec_id", "size"]).where("first_rank < shift + n and last_rank >= shift").select(
        "spec_id", "size", "salt", "shift", "first_rank", "last_rank", "first_container", "per_container")
    order = Window.partitionBy("spec_id", "size", "salt").orderBy("doc_id", "piece")
    ranked = pieces.withColumn("_rank", F.row_number().over(order) - 1)
    placed = ranked.join(cells, ["spec_id", "size", "salt"]).withColumn("rank", F.col("_rank") + F.col("shift")).where("rank between first_rank and last_rank")
    return placed.select(
        "spec_id", "doc_id", "piece", "start_token", "size",
        (F.col("first_container") + F.floor((F.col("rank") - F.col("first_rank")) / F.col("per_container"))).alias("container"))


def check(documents: DataFrame, specs: DataFrame, slack: float = 0.02) -> DataFrame:
    """What a packing must keep to, per kind of container.

    ``(spec_id, documents, pieces, tokens, torn, overfull, close)``: rows of documents packed, pieces, their tokens,
    documents cut although they fit, containers over their capacity, and whether the containers are at most
    ``slack`` (and one) more than the tokens need.
    """
    packed = cut(pack(documents, specs)).join(F.broadcast(specs.select("spec_id", "capacity").dropna().distinct()), "spec_id")
    fill = packed.groupBy("spec_id", "container", "capacity").agg(F.sum("size").alias("filled"))
    full = fill.groupBy("spec_id", "capacity").agg(F.count("*").alias("n"), F.sum("filled").alias("tokens"), F.sum((F.col("filled") > F.col("capacity")).cast("long")).alias("overfull"))
    docs = packed.groupBy("spec_id").agg(
        F.sum((F.col("piece") == 0).cast("long")).alias("documents"), F.count("*").alias("pieces"),
        F.sum(((F.col("piece") == 1) & (F.col("start_token") != F.col("capacity"))).cast("long")).alias("torn"))
    need = F.ceil(F.col("tokens") / F.col("capacity"))
    return docs.join(full, "spec_id").select("spec_id", "documents", "pieces", "tokens", "torn", "overfull", (F.col("n") <= F.floor(need * (1 + slack)) + 1).alias("close"))
