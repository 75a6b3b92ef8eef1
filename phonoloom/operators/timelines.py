"""Fixpoint timelines of a recording: labels smoothed over short runs (F10, F11) and values merged by distance (F12).

Runs farther apart than the gap limit never touch, whatever is merged, so a timeline falls into
blocks that are built apart from each other: the unit of work is a block, not a recording. Inside a
block runs are a linked list with heaps, so n segments take O(n log n) steps.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import bucket_of, carry_last, carry_previous

GAP, SHORT, DELTA = 10_000, 4_000, 0.15


class _Chain:
    """Runs of neighbouring rows as a doubly linked list over the rows' positions."""

    def __init__(self, n: int):
        self.left, self.right, self.alive = list(range(-1, n - 1)), [*range(1, n), -1] if n else [], [True] * n

    def join(self, a: int) -> int:
        """Merges run ``a`` with its right neighbour, which ceases to be."""
        b = self.right[a]
        self.alive[b] = False
        self.right[a] = self.right[b]
        if self.right[b] >= 0:
            self.left[self.right[b]] = a
        return b

    def runs(self) -> list[int]:
        return [i for i, ok in enumerate(self.alive) if ok]


def value_runs(values: Sequence[float | None], weights: Sequence[float], delta: float = DELTA, short: float = SHORT) -> list[list[int]]:
    """F12. Row positions of each span of one block.

    Every row starts alone; the closest adjacent pair (leftmost at ties) is merged while its relative
    distance is below ``delta``, unknown values being at distance 0; with none left, the first run
    shorter than ``short`` goes to the neighbour nearest in value, the longer at ties, the left one
    at equal length, and merging by value resumes. A run's value is the weighted mean of its rows'.
    """
    n = len(values)
    chain, members = _Chain(n), [[i] for i in range(n)]
    vw = [(v * w if v is not None else 0.0, w if v is not None else 0.0) for v, w in zip(values, weights)]
    size, version = list(weights), [0] * n

    def far(a: int, b: int) -> float:
        if vw[a][1] == 0 or vw[b][1] == 0:
            return 0.0
        x, y = vw[a][0] / vw[a][1], vw[b][0] / vw[b][1]
        top = max(abs(x), abs(y))
        return abs(x - y) / top if top else 0.0

    near: list[tuple[float, int, int, int]] = []

    def offer(a: int) -> None:
        b = chain.right[a] if a >= 0 else -1
        if b >= 0 and (d := far(a, b)) < delta:
            heapq.heappush(near, (d, a, version[a], version[b]))

    def merge(a: int) -> None:
        b = chain.join(a)
        members[a] += members[b]
        vw[a] = (vw[a][0] + vw[b][0], vw[a][1] + vw[b][1])
        size[a] += size[b]
        version[a] += 1
        version[b] += 1
        offer(chain.left[a])
        offer(a)
        if size[a] < short:
            heapq.heappush(brief, a)

    brief = [i for i in range(n) if size[i] < short]
    for i in range(n):
        offer(i)
    while True:
        if near:
            _, a, va, vb = heapq.heappop(near)
            if chain.alive[a] and version[a] == va and chain.right[a] >= 0 and version[chain.right[a]] == vb:
                merge(a)
            continue
        while brief and (not chain.alive[brief[0]] or size[brief[0]] >= short):
            heapq.heappop(brief)
        if not brief:
            break
        i = heapq.heappop(brief)
        options = [j for j in (chain.left[i], chain.right[i]) if j >= 0]
        if options:
            j = min(options, key=lambda j: (far(i, j), -size[j]))
            merge(min(i, j))
    return [members[i] for i in chain.runs()]


def label_spans(labels: Sequence[str | None], weights: Sequence[float], short: float = SHORT) -> list[tuple[list[int], str | None]]:
    """F11. (row positions, published label) of each span of one block.

    Runs of equal labels; the first run shorter than ``short`` is absorbed by its longer neighbour
    (the left one at ties), which keeps its label, until none is left; equal neighbours join. A span
    publishes the label of most weight among its rows (the greatest at ties, null labels don't
    vote); neighbours that publish the same join, from the left, until stable.
    """
    n = len(labels)
    chain, members, name, size = _Chain(n), [[i] for i in range(n)], list(labels), list(weights)

    def merge(a: int) -> None:
        b = chain.join(a)
        members[a] += members[b]
        size[a] += size[b]

    i = 0 if n else -1
    while i >= 0:
        while chain.right[i] >= 0 and name[chain.right[i]] == name[i]:
            merge(i)
        i = chain.right[i]
    brief = [i for i in chain.runs() if size[i] < short]
    heapq.heapify(brief)
    while brief:
        i = heapq.heappop(brief)
        if not chain.alive[i] or size[i] >= short:
            continue
        a, b = chain.left[i], chain.right[i]
        if a < 0 and b < 0:
            continue
        if a >= 0 and (b < 0 or size[a] >= size[b]):
            merge(a)
            i = a
        else:
            name[i] = name[b]
            merge(i)
        while chain.right[i] >= 0 and name[chain.right[i]] == name[i]:
            merge(i)
        while chain.left[i] >= 0 and name[chain.left[i]] == name[i]:
            i = chain.left[i]
            merge(i)
        if size[i] < short:
            heapq.heappush(brief, i)

    def published(rows: list[int]) -> str | None:
        votes: dict[str, float] = {}
        for r in rows:
            if labels[r] is not None:
                votes[labels[r]] = votes.get(labels[r], 0.0) + weights[r]
        return max(votes.items(), key=lambda x: (x[1], x[0]))[0] if votes else None

    # joining from the left until stable: a stack suffices, as only the last joined span can match anew
    out: list[tuple[list[int], str | None]] = []
    for i in chain.runs():
        out.append((members[i], published(members[i])))
        while len(out) > 1 and out[-1][1] == out[-2][1]:
            rows = out.pop()[0]
            both = out.pop()[0] + rows
            out.append((both, published(both)))
    return out


def blocks(segs: DataFrame, gap_ms: int = GAP) -> DataFrame:
    """Adds ``block``, the (s, idx) of the first row of the stretch without a gap above the limit to the previous row's end."""
    d = carry_previous(segs.withColumn("hour", bucket_of(F.col("s"), 3_600_000)), ["sid"], "hour", ["s", "idx"], ["e"])
    opens = F.when(~F.col("has_prev") | (F.col("s") - F.col("prev_e") > gap_ms), F.struct("s", "idx"))
    return carry_last(d.withColumn("opens", opens), ["sid"], "hour", ["s", "idx"], "opens", "block")


def _spans(segs: DataFrame, value: str, build, schema: str) -> DataFrame:
    """A block is one row holding its segments in order, so many blocks share a batch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for sid, items in zip(b["sid"], b["items"]):
                s, e = [x["s"] for x in items], [x["e"] for x in items]
                w = [float(y - x) for x, y in zip(s, e)]
                for at, extra in build([x["v"] for x in items], w):
                    rows.append((sid, s[at[0]], max(e[i] for i in at), int(sum(w[i] for i in at)), len(at), extra))
            if rows:
                yield pd.DataFrame(rows, columns=["sid", "span_start", "span_end", "speech_ms", "n_seg", "label"])

    d = blocks(segs.select("sid", "idx", "s", "e", F.col(value).alias("v")))
    lists = d.groupBy("sid", "block").agg(F.sort_array(F.collect_list(F.struct("s", "idx", "e", "v"))).alias("items"))
    return lists.select("sid", "items").mapInPandas(run, f"sid string, span_start long, span_end long, speech_ms long, n_seg long, label {schema}")


def value_timeline(segs: DataFrame, value: str) -> DataFrame:
    """F12. Spans of (sid, idx, s, e, value): sid, span_start, span_end, speech_ms, n_seg and the weighted mean as ``label``."""

    def build(v: list, w: list[float]) -> list:
        v = [None if x is None or x != x else float(x) for x in v]
        out = []
        for at in value_runs(v, w):
            t = sum(w[i] for i in at if v[i] is not None)
            out.append((at, round(sum(v[i] * w[i] for i in at if v[i] is not None) / t, 4) if t else None))
        return out

    return _spans(segs, value, build, "double")


def label_timeline(segs: DataFrame, label: str) -> DataFrame:
    """F11. Spans of (sid, idx, s, e, label): sid, span_start, span_end, speech_ms, n_seg and the published ``label``."""

    return _spans(segs, label, label_spans, "string")
