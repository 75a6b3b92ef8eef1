"""P4: connected components by hash-to-min, and their splits by weighted rendezvous hashing."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.lineage import discard, settle, settle_table
from .speakers import is_person, speaker_key

# Squeezed spellings that name nobody, and words that with a number are local to a recording.
PLACEHOLDERS = ("", "na", "nan", "none", "null", "nil", "unknown", "unk", "anonymous", "anon", "undefined", "unidentified", "various", "noname", "tbd")
LOCAL_WORDS = "speaker|spk|spkr|s|voice|person|sprecher|hablante|falante|orateur|locuteur|спикер|спікер|说话人|話者|화자|ผู้พูด|वक्ता"


def squeezed(name: Column) -> Column:
    """A name in lower case without spaces and punctuation; null where it names nobody."""
    s = F.lower(F.regexp_replace(name, r"[^\p{L}\p{M}\p{N}]+", ""))
    return F.when(~s.isin(*PLACEHOLDERS), s)


def persons(labels: DataFrame) -> DataFrame:
    """(id, label) rows into distinct (id, person): labels of numbered voices and placeholders are gone."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            names = [speaker_key(x) for x in b["label"]]
            rows = [(i, n) for i, n in zip(b["id"], names) if is_person(n)]
            if rows:
                yield pd.DataFrame(rows, columns=["id", "person"])

    return labels.where("id is not null and label is not null").distinct().mapInPandas(run, "id string, person string").distinct()


def ties(records: DataFrame, recordings: DataFrame, segments: DataFrame) -> DataFrame:
    """Distinct (id, tie): what each record could share with others. Null maps, voices and authors tie nothing."""
    ids = records.where("id is not null").select("id").distinct()
    voices = records.where("id is not null").select("id", F.explode(F.map_values("speakers")).alias("v")).select("id", squeezed(F.col("v.speaker")).alias("k"))
    voices = voices.where(f"k is not null and not k rlike '^({LOCAL_WORDS})[0-9]+$'").select("id", F.concat(F.lit("v:"), "k").alias("tie"))
    authors = recordings.select(F.col("sid").alias("id"), squeezed(F.col("author")).alias("k")).where("k is not null").select("id", F.concat(F.lit("a:"), "k").alias("tie"))
    named = persons(segments.select(F.col("sid").alias("id"), F.col("speaker").alias("label"))).select("id", F.concat(F.lit("p:"), "person").alias("tie"))
    return voices.unionByName(authors.unionByName(named).join(ids, "id", "left_semi")).distinct()


def star_edges(shared: DataFrame) -> DataFrame:
    """(u, v) from each record to the smallest record with the same tie: as many rows as ties, never all pairs."""
    heads = shared.groupBy("tie").agg(F.min("id").alias("v"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return shared.join(heads.select("tie", "v"), "tie").where("id <> v").select(F.col("id").alias("u"), "v").distinct()


def hash_to_min(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Components of (u, v) edges: (node, root), root the smallest node in code-point order.

    A node's cluster is a set of (node, member) rows, so no cluster is ever one value or one task's
    list. Each round a node sends its cluster to the cluster's minimum and the minimum to the
    cluster; it ends when a round changes nothing. The least member of a node comes from a partial
    aggregation; the join back on hot nodes is left to adaptive skew splitting. A round's table is deleted once
    the next is written. No edges, no rows.
    """
    both = edges.select(F.col("u").alias("n"), F.col("v").alias("m")).unionByName(edges.select(F.col("v").alias("n"), F.col("u").alias("m")))
    clusters, path = settle_table(both.unionByName(both.select("n", F.col("n").alias("m"))).distinct())
    seen = None
    for _ in range(max_rounds):
        least = clusters.groupBy("n").agg(F.min("m").alias("low"))
        sent = clusters.join(least, "n").select(F.explode(F.array(F.struct(F.col("low").alias("n"), F.col("m").alias("m")), F.struct(F.col("m").alias("n"), F.col("low").alias("m")))).alias("x"))
        before, (clusters, path) = path, settle_table(sent.select("x.n", "x.m").distinct())
        discard(edges.sparkSession, before)  # a round needs only the one before
        # unordered digest of the cluster rows: two rounds alike mean stable
        now = clusters.agg(F.count(F.lit(1)), F.sum(F.xxhash64("n", "m").cast("decimal(38,0)")), F.sum(F.crc32(F.concat_ws("\x00", "n", "m").cast("binary")).cast("decimal(38,0)"))).first()
        if now == seen:
            return clusters.groupBy("n").agg(F.min("m").alias("root")).withColumnRenamed("n", "node")
        seen = now
    raise RuntimeError(f"components are not stable after {max_rounds} rounds")


def groups(records: DataFrame, recordings: DataFrame, segments: DataFrame) -> DataFrame:
    """(id, group_id) for every distinct record id; one alone is its own group."""
    parts = hash_to_min(star_edges(settle(ties(records, recordings, segments))))
    ids = records.where("id is not null").select("id").distinct()
    return ids.join(parts.select(F.col("node").alias("id"), "root"), "id", "left").select("id", F.coalesce("root", "id").alias("group_id"))


def rendezvous(key: Column, weights: Mapping[str, float], seed: int = 0) -> Column:
    """The target with the highest weighted rendezvous score for ``key``; stable when targets come or go."""
    scored = []
    for name, weight in weights.items():
        unit = (F.pmod(F.xxhash64(F.lit(seed), F.lit(name), key), F.lit(1 << 52)) + F.lit(1.0)) / F.lit(float((1 << 52) + 2))
        scored.append(F.struct((F.lit(-float(weight)) / F.log(unit)).alias("score"), F.lit(name).alias("name")))
    return F.array_max(F.array(*scored)).getField("name")


#: Parts of the splits where none are given.
WEIGHTS = {"train": 0.8, "validation": 0.1, "test": 0.1}


def splits(records: DataFrame, recordings: DataFrame, segments: DataFrame, weights: Mapping[str, float] | None = None) -> DataFrame:
    """(id, group_id, split): whole groups go to train, validation or test in the given proportions."""
    return groups(records, recordings, segments).withColumn("split", rendezvous(F.col("group_id"), weights or WEIGHTS))


def checked(placed: DataFrame) -> DataFrame:
    """(id, group_id, together) of placed records; together is 1 where all records of the group are in one known split."""
    whole = placed.groupBy("group_id").agg(((F.min("split") == F.max("split")) & F.min("split").isin(*WEIGHTS)).cast("int").alias("together"))
    return placed.select("id", "group_id").join(whole, "group_id").select("id", "group_id", "together")


def reached(placed: DataFrame, nv_placed: DataFrame, weights: Mapping[str, float] | None = None) -> DataFrame:
    """(split, target, n_groups, n_records, record_share, n_nv_rows, nv_share): what each split was to get and got.

    A split that got nothing has a row of zeros; nv rows without a record are the row whose split is null.
    """
    weights = weights or WEIGHTS
    total = float(sum(weights.values()))
    rec = placed.groupBy("split").agg(F.countDistinct("group_id").alias("n_groups"), F.count(F.lit(1)).alias("n_records"))
    nv = nv_placed.groupBy("split").agg(F.count(F.lit(1)).alias("n_nv_rows"))
    wanted = placed.sparkSession.createDataFrame([(k, w / total) for k, w in weights.items()], "split string, target double")
    # from here on a row per split
    got = wanted.join(rec, "split", "left").unionByName(nv.where("split is null").select("split"), allowMissingColumns=True)
    got = got.join(nv.withColumnRenamed("split", "__s"), F.col("split").eqNullSafe(F.col("__s")), "left").drop("__s").na.fill(0, ["n_groups", "n_records", "n_nv_rows"])
    whole = got.agg(F.sum("n_records").alias("__r"), F.sum("n_nv_rows").alias("__n"))
    share = lambda n, of: F.when(F.col(of) > 0, F.round(F.col(n) / F.col(of), 6))
    return got.crossJoin(F.broadcast(whole)).select("split", "target", "n_groups", "n_records", share("n_records", "__r").alias("record_share"), "n_nv_rows", share("n_nv_rows", "__n").alias("nv_share"))


def split_rows(nv_rows: DataFrame, placed: DataFrame) -> DataFrame:
    """The nv rows with the split of the record whose id theirs begins with; repeated rows count once."""
    of = F.regexp_extract("id", r"^(.+?)(?:_[A-Z]\d+(?:_.*)?)?$", 1)
    rows = nv_rows.where("id is not null").select("id", of.alias("record_id")).distinct()
    return rows.join(placed.select(F.col("id").alias("record_id"), "split"), "record_id", "left").select("id", "record_id", "split")
