"""P7: items into containers of fixed capacity by hierarchical residual packing."""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.lineage import settle

_MEMBERS = "array<struct<doc_id:bigint,piece:int,tokens:bigint,doc_tokens:bigint>>"
_SCHEMA = f"size long, full boolean, members {_MEMBERS}"


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Positions of the items of each bin: best fit in decreasing order of size, ties by position.

    An item goes into the bin with the least room that still holds it, found by binary search.
    Sizes must not exceed the capacity; items of size 0 fit anywhere.
    """
    room: list[tuple[int, int]] = []
    bins: list[list[int]] = []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        at = bisect_left(room, (sizes[i], -1))
        if at == len(room):
            bins.append([i])
            insort(room, (capacity - sizes[i], len(bins) - 1))
        else:
            left, b = room.pop(at)
            bins[b].append(i)
            insort(room, (left - sizes[i], b))
    return bins


def cut_items(items: DataFrame, capacity: int) -> DataFrame:
    """Items of (doc_id, tokens) as bins of one piece: whole, or for one beyond the capacity full pieces and a rest."""
    n = F.greatest(F.lit(1), F.ceil(F.col("tokens") / F.lit(capacity))).cast("int")
    p = items.withColumn("piece", F.explode(F.sequence(F.lit(0), n - 1)))
    size = F.least(F.lit(capacity), F.col("tokens") - F.col("piece") * F.lit(capacity)).cast("long")
    member = F.struct("doc_id", F.col("piece").cast("int").alias("piece"), size.alias("tokens"), F.col("tokens").alias("doc_tokens"))
    return p.select(size.alias("size"), (size >= capacity).alias("full"), F.array(member).cast(_MEMBERS).alias("members"))


def pack(items: DataFrame, capacity: int, nearly: float = 0.985, per_task: int = 20_000) -> DataFrame:
    """container_id, size, doc_id, piece, tokens, doc_tokens: every piece in one container, none above the capacity.

    Each partition packs its items; bins filled to ``nearly`` are done, the others are the items of
    the next round, mixed anew and narrower (``per_task`` bins to a task, never more), until one task
    holds what is left. A round that leaves more than nine tenths of its bins open ends it as well: in
    a task with a random ``per_task`` of all the bins hardly any two go together, so those left
    stay as they are. A bin's members are bounded by the capacity. Items without id or with null size are left out;
    equal items count each; no items, no containers.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = list(batches)
        if not parts:
            return
        rows = pd.concat(parts, ignore_index=True)
        done, open_ = rows[rows["full"]], rows[~rows["full"]].reset_index(drop=True)
        if len(done):
            yield done
        sizes = [int(x) for x in open_["size"]]
        members = [list(m) for m in open_["members"]]
        out = []
        for b in best_fit(sizes, capacity):
            total = sum(sizes[i] for i in b)
            out.append((total, total >= nearly * capacity, [m for i in b for m in members[i]]))
        if out:
            yield pd.DataFrame(out, columns=["size", "full", "members"])

    bins = settle(cut_items(items.select("doc_id", "tokens").where("doc_id is not null and tokens is not null"), capacity).mapInPandas(run, _SCHEMA))
    done = [bins.where("full")]
    rest, left, turn = bins.where("not full"), bins.where("not full").count(), 0
    while left:
        parts = math.ceil(left / per_task)
        spread = rest.repartition(parts, F.xxhash64(F.lit(turn), F.col("members")[0]["doc_id"], F.col("members")[0]["piece"]))
        packed = settle(spread.mapInPandas(run, _SCHEMA))
        done.append(packed.where("full"))
        rest, before, turn = packed.where("not full"), left, turn + 1
        left = rest.count()
        if parts == 1 or left > 0.9 * before:
            done.append(rest)
            break
    whole = done[0]
    for d in done[1:]:
        whole = whole.unionByName(d)
    first = F.array_min(F.transform("members", lambda m: F.struct(m["doc_id"], m["piece"])))
    named = whole.select(F.format_string("c%d_%d", first["doc_id"], first["piece"]).alias("container_id"), "size", F.explode("members").alias("m"))
    return named.select("container_id", "size", "m.doc_id", "m.piece", "m.tokens", "m.doc_tokens")


def fill(packed: DataFrame, capacity: int) -> DataFrame:
    """container_id, n_items, size, room, fill: what each container of ``pack`` holds; room is what stays empty, fill the share used."""
    held = packed.groupBy("container_id").agg(F.count(F.lit(1)).alias("n_items"), F.sum("tokens").alias("size"))
    return held.select("container_id", "n_items", "size", (F.lit(capacity) - F.col("size")).alias("room"), F.round(F.col("size") / F.lit(float(capacity)), 6).alias("fill"))


def checked(packed: DataFrame, capacity: int) -> DataFrame:
    """doc_id, within, complete: 1 where all containers of a document keep the capacity, and where its pieces are numbered from 0, sum to its size
    and are one unless it exceeds a container."""
    full = packed.groupBy("container_id").agg((F.sum("tokens") <= capacity).cast("int").alias("__ok"))
    d = packed.join(full, "container_id").groupBy("doc_id").agg(
        F.min("__ok").alias("within"), F.count(F.lit(1)).alias("n"), F.countDistinct("piece").alias("k"), F.max("piece").alias("top"), F.sum("tokens").alias("t"), F.max("doc_tokens").alias("all")
    )
    whole = (F.col("n") == F.col("k")) & (F.col("top") == F.col("n") - 1) & (F.col("t") == F.col("all")) & ((F.col("n") == 1) | (F.col("all") > capacity))
    return d.select("doc_id", "within", whole.cast("int").alias("complete"))
