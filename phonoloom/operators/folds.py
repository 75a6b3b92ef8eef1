"""Aggregations over weighted segments (w > 0). Everything decomposes into partial and final sums."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from ..functions import scalars as X
from .ordered import ranged_sum


def weighted_vote(df: DataFrame, keys: Sequence[str], label: str, weight: Column) -> DataFrame:
    """E1. The label of the greatest summed weight, the greatest label at ties, with its share; null and empty labels don't vote."""
    per = df.where(F.col(label).isNotNull() & (F.col(label) != "")).groupBy(*keys, label).agg(F.sum(weight).alias("w"))
    g = per.groupBy(*keys).agg(F.max(F.struct("w", label)).alias("x"), F.sum("w").alias("all"))
    return g.select(*keys, F.col("x")[label].alias("label"), F.round(F.col("x.w") / F.nullif(F.col("all"), F.lit(0)), 6).alias("share"))


def weighted_mean(df: DataFrame, keys: Sequence[str], value: str, weight: Column) -> DataFrame:
    """E2. Sum of value by weight over the weight of rows that have a value; null without any."""
    w = F.when(F.col(value).isNotNull() & ~F.isnan(value), weight)
    return df.groupBy(*keys).agg(F.round(F.sum(F.when(w.isNotNull(), F.col(value) * w)) / F.nullif(F.sum(w), F.lit(0)), 6).alias("mean"))


def energy_mean(df: DataFrame, keys: Sequence[str], level: Column, weight: Column) -> DataFrame:
    """E3. Mean of decibel levels in the energy domain."""
    w = F.when(level.isNotNull(), weight)
    return df.groupBy(*keys).agg(F.round(10 * F.log10(F.sum(w * F.pow(F.lit(10.0), level / 10)) / F.nullif(F.sum(w), F.lit(0))), 4).alias("level"))


def covering_labels(df: DataFrame, keys: Sequence[str], label: str, weight: Column, cover: float = 0.9) -> DataFrame:
    """E11. Labels by descending weight (label at ties) until those before cover ``cover`` of the whole."""
    per = df.where(F.col(label).isNotNull() & (F.col(label) != "")).groupBy(*keys, label).agg(F.sum(weight).alias("w"))
    w = W.partitionBy(*keys)
    before = F.coalesce(F.sum("w").over(w.orderBy(F.desc("w"), label).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    d = per.withColumn("before", before).withColumn("all", F.sum("w").over(w)).where(F.col("before") < cover * F.col("all"))
    return d.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_list(label)), ",").alias("labels"))


def posterior_mean(df: DataFrame, keys: Sequence[str], values: str) -> DataFrame:
    """E4, E5. Mean of a posterior vector per key, position by position, and the rank of each position (greatest first)."""
    e = df.select(*keys, F.posexplode(values).alias("pos", "p"))
    n = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    m = e.groupBy(*keys, "pos").agg(F.sum(F.abs("p").cast("double")).alias("t")).join(n, list(keys)).withColumn("mean", F.round(F.col("t") / F.col("n"), 6))
    return m.select(*keys, "pos", "mean", F.row_number().over(W.partitionBy(*keys).orderBy(F.desc("mean"), "pos")).alias("rank"))


def indexed_quantiles(df: DataFrame, keys: Sequence[str], value: str, qs: Sequence[float]) -> DataFrame:
    """E19. The value at position int(n * q) of the sorted values, from counts of distinct values (no list of all)."""
    per = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("c"))
    w = W.partitionBy(*keys).orderBy(value).rowsBetween(W.unboundedPreceding, 0)
    d = per.withColumn("upto", F.sum("c").over(w)).withColumn("n", F.sum("c").over(W.partitionBy(*keys)))
    at = lambda q: F.min(F.when(F.col("upto") > F.floor(F.col("n") * F.lit(q)), F.col(value)))
    return d.groupBy(*keys).agg(F.max("n").alias("n"), *[at(q).alias(f"p{round(q * 100)}") for q in qs])


def tag_counts(df: DataFrame, keys: Sequence[str], tags: str) -> DataFrame:
    """E16. Occurrences of each tag per key, and rows that carry it."""
    once = F.explode(F.array_distinct(tags)).alias("tag")
    per_row = df.select(*keys, tags, once).select(*keys, "tag", F.size(F.filter(tags, lambda t: t.eqNullSafe(F.col("tag")))).alias("c"))
    return per_row.groupBy(*keys, "tag").agg(F.sum("c").alias("n_tags"), F.count(F.lit(1)).alias("n_rows"))


def grouped_voices(df: DataFrame, parent: str, voice: str, least: int = 1) -> DataFrame:
    """E8. One row per parent with its voices nested: a map of voice to (segments, seconds); rows without voice are counted as orphans."""
    d = df.groupBy(parent, voice).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("e") - F.col("s")).alias("ms"))
    orphan = F.sum(F.when(F.col(voice).isNull(), F.col("n")).otherwise(0)).alias("orphans")
    named = F.collect_list(F.when(F.col(voice).isNotNull() & (F.col("n") >= least), F.struct(F.col(voice).alias("key"), F.struct("n", "ms").alias("value"))))
    return d.groupBy(parent).agg(orphan, F.map_from_entries(F.array_sort(named)).alias("voices"))


def speed_edges(df: DataFrame, lang: str, rate: str, least: int = 200) -> DataFrame:
    """E21. Per language with enough rows the median rate and the edges fitted to it, with the shares below, between and above."""
    m = df.where(F.col(rate).isNotNull() & F.col(lang).isNotNull()).groupBy(lang).agg(F.count(F.lit(1)).alias("n"), F.median(rate).alias("med")).where(F.col("n") >= least)
    # The edges as parts of the median.
    m = m.select(lang, "n", F.round(F.col("med") * 0.843, 1).alias("lo"), F.round(F.col("med") * 1.335, 1).alias("hi"))
    d = df.where(F.col(rate).isNotNull()).join(m, lang)
    g = d.groupBy(lang, "n", "lo", "hi").agg(F.sum((F.col(rate) < F.col("lo")).cast("int")).alias("slow"), F.sum((F.col(rate) > F.col("hi")).cast("int")).alias("fast"))
    return g.select(lang, "n", "lo", "hi", F.round(F.col("slow") / F.col("n"), 6).alias("slow_share"), F.round(F.col("fast") / F.col("n"), 6).alias("fast_share"))


def budgeted(df: DataFrame, order: str, amount: str, most: float) -> DataFrame:
    """G5. Rows in ``order`` while the sum of those before stays below ``most``, with that sum as ``before``; summed over ranges of ``order``."""
    return ranged_sum(df, order, amount, "before").where(F.col("before") < most)


def restricted(posterior: DataFrame, keys: Sequence[str], label: str, weight: str, admitted: str) -> DataFrame:
    """C25. (keys, label, share): weights restricted to the labels in the array ``admitted`` and made to sum to one.

    Where nothing is admitted, or no weight lies on what is, all labels keep their part.
    """
    w = W.partitionBy(*keys)
    d = posterior.withColumn("__k", F.when(F.array_contains(F.coalesce(admitted, F.array().cast("array<string>")), F.col(label)), F.col(weight)).otherwise(0))
    d = d.withColumn("__kt", F.sum("__k").over(w)).withColumn("__wt", F.sum(weight).over(w)).where("__kt = 0 or __k > 0")
    return d.select(*keys, label, F.round(F.when(F.col("__kt") > 0, F.col("__k") / F.col("__kt")).otherwise(F.col(weight) / F.nullif(F.col("__wt"), F.lit(0))), 6).alias("share"))


def enriched(rows: DataFrame, tags: str, ok: str) -> DataFrame:
    """E26. Per tag the pass rates of rows with and without it and their ratio: tag, n_with, n_without, rate_with, rate_without, ratio.

    ``ok`` is 0 or 1; a rate over no rows and a ratio to a rate of zero are null.
    """
    all_ = rows.agg(F.count(F.lit(1)).alias("__n"), F.sum(ok).alias("__ok"))  # one row
    per = rows.select(F.explode(F.array_distinct(tags)).alias("tag"), F.col(ok).alias("__o")).groupBy("tag").agg(F.count(F.lit(1)).alias("n_with"), F.sum("__o").alias("__k"))
    d = per.join(F.broadcast(all_)).withColumn("n_without", F.col("__n") - F.col("n_with"))
    a, b = F.col("__k") / F.col("n_with"), (F.col("__ok") - F.col("__k")) / F.nullif(F.col("n_without"), F.lit(0))
    return d.select("tag", "n_with", "n_without", F.round(a, 6).alias("rate_with"), F.round(b, 6).alias("rate_without"), F.round(a / F.nullif(b, F.lit(0.0)), 6).alias("ratio"))


def view_hours(rows: DataFrame, least_hours: float = 0.05) -> DataFrame:
    """E20. Rows, hours and part of the whole by language and view, with the sums of a language (null view) and of all (both null): lang, view, n, hours, part.

    Entries below ``least_hours`` are left out, the grand total never. ``rows`` have lang, view and ms.
    """
    total = rows.agg(F.sum("ms").alias("__all"))  # one row
    g = rows.rollup("lang", "view").agg(F.count(F.lit(1)).alias("n"), F.sum("ms").alias("__ms"), F.grouping("lang").alias("__gl"))
    h = F.col("__ms") / F.lit(3_600_000.0)
    d = g.join(F.broadcast(total)).where((h >= least_hours) | (F.col("__gl") == 1))
    return d.select("lang", "view", "n", F.round(h, 4).alias("hours"), F.round(F.col("__ms") / F.col("__all"), 6).alias("part"))


def speaker_fold(segs: DataFrame, genders: DataFrame) -> DataFrame:
    """E6. What belongs to a speaker whatever is said: sid, spk, n_segments, speech_seconds, lang and dominant_lang_ratio (vote by length),
    n_languages, gender, mean_q (weighted) and the pitch class found anew from the mean and the gender.

    ``genders`` has a row per (sid, spk) at most; a speaker without one has a null gender, which takes the edges of female.
    """
    key, w = ["sid", "spk"], F.col("e") - F.col("s")
    g = segs.groupBy(*key).agg(F.count(F.lit(1)).alias("n_segments"), F.round(F.sum(w) / 1000 + 1e-9, 2).alias("speech_seconds"), F.countDistinct(F.when(F.col("lang") != "", F.col("lang"))).alias("n_languages"))
    vote = weighted_vote(segs, key, "lang", w).select(*key, F.col("label").alias("lang"), F.col("share").alias("dominant_lang_ratio"))
    d = g.join(vote, key, "left").join(weighted_mean(segs, key, "q", w).withColumnRenamed("mean", "mean_q"), key).join(genders, key, "left")
    # the measured score stands for a mean pitch, as the tables have none
    pitch = X.pitch_label(F.col("mean_q") * 45, F.col("gender"))
    return d.select(*key, "n_segments", "speech_seconds", "lang", "dominant_lang_ratio", "n_languages", "gender", "mean_q", pitch.alias("pitch"))


def posterior_fold(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """E4. From (keys, label, p, w, row) entries: keys, label, mean = sum of w p over the weight of all rows that have entries, so a label a row lacks counts 0 there.

    ``row`` tells the rows of a key apart; ``w`` is the row's, repeated in each of its entries.
    """
    keys = list(keys)
    whole = rows.groupBy(*keys, "row").agg(F.max("w").alias("w")).groupBy(*keys).agg(F.sum("w").alias("__w"))
    g = rows.groupBy(*keys, "label").agg(F.sum(F.col("w") * F.col("p")).alias("__wp")).join(whole, keys)
    return g.select(*keys, "label", F.round(F.col("__wp") / F.nullif(F.col("__w"), F.lit(0)), 6).alias("mean"))


def accent_fold(rows: DataFrame, keys: Sequence[str], at: Column) -> DataFrame:
    """E5. From (keys, label, p, w) entries: keys, label of the greatest summed w p (the first met by ``at`` at ties), agreement (its part of all), and
    top3, the three greatest as ``label=part`` with parts of the sum of all, three places."""
    keys = list(keys)
    g = rows.groupBy(*keys, "label").agg(F.sum(F.col("w") * F.col("p")).alias("s"), F.min(at).alias("first"))
    order = lambda a, b: F.when(a["s"] > b["s"], -1).when(a["s"] < b["s"], 1).when(a["first"] < b["first"], -1).when(a["first"] > b["first"], 1).otherwise(0)
    d = g.groupBy(*keys).agg(F.sum("s").alias("all"), F.array_sort(F.collect_list(F.struct("s", "first", "label")), order).alias("l"))
    part = lambda x: F.concat(x["label"], F.lit("="), F.format_string("%.3f", x["s"] / F.col("all") + 1e-12))
    return d.select(*keys, F.col("l")[0]["label"].alias("label"), F.round(F.col("l")[0]["s"] / F.col("all"), 6).alias("agreement"), F.array_join(F.transform(F.slice("l", 1, 3), part), " ").alias("top3"))


def file_summary(segs: DataFrame, durations: DataFrame, runs: DataFrame) -> DataFrame:
    """E7. Flat record of a recording: sid, n_segments, speech_seconds (two places), file_seconds (its declared duration), speech_ratio (three places, null without one),
    lang, dominant_lang_ratio, n_languages, mean_q, level (energy mean of -10 q) and n_spans, the runs of its language. Segments have a positive length."""
    w = F.col("e") - F.col("s")
    base = segs.groupBy("sid").agg(F.count(F.lit(1)).alias("n_segments"), F.sum(w).alias("__ms"), F.countDistinct(F.when(F.col("lang") != "", F.col("lang"))).alias("n_languages"))
    vote = weighted_vote(segs, ["sid"], "lang", w).select("sid", F.col("label").alias("lang"), F.col("share").alias("dominant_lang_ratio"))
    d = base.join(vote, "sid", "left").join(weighted_mean(segs, ["sid"], "q", w).withColumnRenamed("mean", "mean_q"), "sid").join(energy_mean(segs, ["sid"], F.col("q") * -10, w), "sid")
    d = d.join(durations.select("sid", F.col("duration").alias("file_seconds")), "sid", "left").join(runs.groupBy("sid").agg(F.count(F.lit(1)).alias("n_spans")), "sid")
    sec = F.round(F.col("__ms") / 1000 + 1e-9, 2)
    return d.select("sid", "n_segments", sec.alias("speech_seconds"), "file_seconds", F.round(F.col("__ms") / 1000 / F.nullif(F.col("file_seconds"), F.lit(0.0)) + 1e-9, 3).alias("speech_ratio"), "lang", "dominant_lang_ratio", "n_languages", "mean_q", "level", "n_spans")


def drifted_edges(fitted: DataFrame, shipped: Mapping[str, tuple[float, float]], most: float = 0.15) -> DataFrame:
    """E21. ``speed_edges`` rows with the shipped edges and whether either is more than ``most`` off, as a part of the shipped; languages without any have null."""
    table = F.create_map(*[x for k, (lo, hi) in shipped.items() for x in (F.lit(k), F.struct(F.lit(lo).alias("lo"), F.lit(hi).alias("hi")))])
    old = F.try_element_at(table, F.lower(F.trim("lang")))
    off = F.greatest(F.abs(F.col("lo") / old["lo"] - 1), F.abs(F.col("hi") / old["hi"] - 1))
    return fitted.select("lang", "n", "lo", "hi", old["lo"].alias("shipped_lo"), old["hi"].alias("shipped_hi"), (off > most).cast("int").alias("drift"))
