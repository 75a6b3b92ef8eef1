"""Repetition measures of recognised text, ordered verdicts, and runs assembled from them."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from ..functions import scalars as X
from .lineage import settle
from .sequences import gate_windows, window_metrics

_WORD = re.compile(r"[^\W_]+")


def most_repeats(text: str | None) -> int:
    """I2. Most occurrences of a run of 6 words where there are 12 or more, else of 10 characters without white space where there are 30, else 1; null counts 1."""
    units: Sequence[str] = (text or "").split()
    n = 6
    if len(units) < 12:
        units, n = "".join(units), 10
        if len(units) < 30:
            return 1
    return max(Counter(tuple(units[i : i + n]) for i in range(len(units) - n + 1)).values())


def ngram_repeat(text: Column) -> Column:
    """I2 as a column: a vectorised function, since nested lambdas over n-grams cost a hundred times as much in the JVM."""

    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([most_repeats(t) for t in texts])

    return F.pandas_udf(run, "int")(text)


def repeated_share(words: Sequence[str], n: int = 4, seen: int = 5) -> float:
    """I3. Share of word positions in runs of ``n`` words that occur ``seen`` times or more; 0 below 18 words."""
    return covered_share(words, n, seen) if len(words) >= 18 else 0.0


def repeated_text_share(text: str | None) -> float:
    """I3. ``repeated_share`` of a text's words; below 18 words, as in scripts without spaces, the share of letters and digits
    in runs of 8 that occur 5 times or more, where there are 30 or more; else 0."""
    low = (text or "").casefold()
    words = _WORD.findall(low)
    if len(words) >= 18:
        return repeated_share(words)
    chars = [c for c in low if c.isalnum()]
    return covered_share(chars, 8, 5) if len(chars) >= 30 else 0.0


def covered_share(words: Sequence[str], n: int, seen: int) -> float:
    """Share of positions in runs of ``n`` units that occur ``seen`` times or more; 0 below 3 n units."""
    if len(words) < 3 * n:
        return 0.0
    grams = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
    count, until, hit = Counter(grams), 0, 0
    for i, g in enumerate(grams):
        if count[g] >= seen:
            hit += i + n - max(i, until)
            until = i + n
    return hit / len(words)


def with_repeated_share(df: DataFrame, key: str, text: str) -> DataFrame:
    """I3. (key, share) of each row's text; null texts have 0."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({key: b[key], "share": [round(repeated_text_share(t), 6) for t in b[text]]})

    return df.select(key, text).mapInPandas(run, f"`{key}` {df.schema[key].dataType.simpleString()}, share double")


def degenerate(text: Column, seconds: Column) -> Column:
    """I2. More than 80 characters, more than 25 a second, and a run that recurs three times."""
    n = F.coalesce(X.char_count(text), F.lit(0))
    return (n > 80) & (seconds > 0) & (n > 25 * seconds) & (ngram_repeat(text) >= 3)


def transcript_verdict(text: Column, lang: Column, accepted: Column, seconds: Column, q: Column, lid: Column, repeated: Column, dialect: Column, fewest: int = 2, floor: float = 3.0, dialect_floor: float = 2.4) -> Column:
    """C3. The first failing check of a transcript: no_result, lang, asr_repetition, text, post_asr_zh_en, ratio; null where all pass.

    ``lid`` is the language a detector gave before, ``repeated`` the I3 share, ``dialect`` whether both sides name one. A text
    recognised as zh or en that the detector took for neither must reach the quality floor.
    """
    chars = F.coalesce(X.char_count(text), F.lit(0))
    known = F.lower(F.trim(F.coalesce(lid, F.lit("")))).isin("zh", "en")
    least = F.when(dialect, F.lit(dialect_floor)).otherwise(F.lit(floor))
    return (
        F.when((F.trim(F.coalesce(text, F.lit(""))) == "") & (F.coalesce(lang, F.lit("")) == ""), "no_result")
        .when(~F.coalesce(accepted, F.lit(False)), "lang")
        .when(repeated >= 0.8, "asr_repetition")
        .when(chars < fewest, "text")
        .when(F.coalesce(lang.isin("zh", "en"), F.lit(False)) & ~known & (q.isNull() | (q < least)), "post_asr_zh_en")
        .when(~X.seconds_per_char_ok(seconds, chars, lang), "ratio")
    )


def run_members(items: DataFrame, max_gap_ms: int = 3000) -> DataFrame:
    """Rows of (sid, win, s, e, idx, spk, role, ...) that make up runs, with ``piece`` and ``part``: BREAK rows part runs, ends that
    aren't OK are trimmed, and a gap between OK rows above ``max_gap_ms`` parts them. Windows bound the rows of a partition."""
    w = W.partitionBy("sid", "win").orderBy("s", "idx")
    d = items.withColumn("piece", F.sum((F.col("role") == "BREAK").cast("int")).over(w.rowsBetween(W.unboundedPreceding, 0))).where("role <> 'BREAK'")
    wp = W.partitionBy("sid", "win", "piece").orderBy("s", "idx")
    ok_end = F.last(F.when(F.col("role") == "OK", F.col("e")), True).over(wp.rowsBetween(W.unboundedPreceding, -1))
    d = d.withColumn("new", F.when((F.col("role") == "OK") & (F.col("s") - ok_end > max_gap_ms), 1).otherwise(0))
    d = d.withColumn("part", F.sum("new").over(wp.rowsBetween(W.unboundedPreceding, 0)))
    span = W.partitionBy("sid", "win", "piece", "part")
    pos = F.struct("s", "idx")
    d = d.withColumn("lo", F.min(F.when(F.col("role") == "OK", pos)).over(span)).withColumn("hi", F.max(F.when(F.col("role") == "OK", pos)).over(span))
    return d.where((pos >= F.col("lo")) & (pos <= F.col("hi"))).drop("new", "lo", "hi")


_RUN = ["sid", "win", "piece", "part"]


def _run_spans(members: DataFrame, least_ms: int, voices: int) -> DataFrame:
    g = members.groupBy(*_RUN).agg(F.min("s").alias("run_start"), F.max("e").alias("run_end"), F.count(F.lit(1)).alias("n"), F.countDistinct(F.when(F.col("role") == "OK", F.col("spk"))).alias("voices"))
    return g.where((F.col("run_end") - F.col("run_start") >= least_ms) & (F.col("voices") >= voices))


def assembled_runs(items: DataFrame, max_gap_ms: int = 3000, least_ms: int = 5000, voices: int = 1) -> DataFrame:
    """F14. Runs of ``run_members``; those shorter than ``least_ms`` or with fewer OK voices are dropped."""
    return _run_spans(run_members(items, max_gap_ms), least_ms, voices).select("sid", F.col("win").alias("win_start"), "run_start", "run_end", "n", "voices")


def split_windows(items: DataFrame, max_gap_ms: int = 3000, least_ms: int = 5000, voices: int = 1) -> DataFrame:
    """F15. The runs of each window measured and gated anew as windows of their own: sid, win_start, run_start, run_end, speakers,
    reason, ``whole`` (1 where all rows of the window are OK and in the run: the window stays as it is) and name.

    Runs that pass the gates are named ``D<window>_p<i>`` from 0 in order of time within their window; others have a null name.
    ``items`` carry sid, win, idx, s, e, spk, q and role.
    """
    m = settle(run_members(items.select("sid", "win", "idx", "s", "e", "spk", "q", "role"), max_gap_ms))
    spans = _run_spans(m, least_ms, voices)
    key = F.concat_ws("#", *_RUN).alias("sid")
    own = m.join(spans.select(*_RUN), _RUN, "left_semi").select(key, "idx", "s", "e", "spk", "q")
    gated = gate_windows(window_metrics(own, 1 << 50)).select(F.col("sid").alias("run_key"), "speakers", "reason")
    rows = items.groupBy("sid", "win").agg(F.count(F.lit(1)).alias("n_items"), F.min((F.col("role") == "OK").cast("int")).alias("all_ok"))
    d = spans.withColumn("run_key", F.concat_ws("#", *_RUN)).join(gated, "run_key").join(rows, ["sid", "win"])
    d = d.withColumn("whole", ((F.col("all_ok") == 1) & (F.col("n") == F.col("n_items"))).cast("int"))
    # windows are named by their start, so a kept run's number is its place among the kept of its window
    kept = F.sum((F.col("reason") == "kept").cast("int")).over(W.partitionBy("sid", "win").orderBy("run_start", "piece", "part").rowsBetween(W.unboundedPreceding, 0))
    name = F.when(F.col("reason") == "kept", F.concat(F.lit("D"), F.col("win").cast("string"), F.lit("_p"), (kept - 1).cast("string")))
    return d.withColumn("name", name).select("sid", F.col("win").alias("win_start"), "run_start", "run_end", "speakers", "reason", "whole", "name")


def best_window(members: DataFrame, most_ms: int = 30_000) -> DataFrame:
    """F18. Per (sid, run) the stretch of rows from some start within ``most_ms`` with the greatest speech, the earliest at ties: sid, run, s, e, speech_ms.

    A range frame looks ahead over the starts, so nothing is paired.
    """
    ahead = W.partitionBy("sid", "run").orderBy("s").rangeBetween(0, most_ms)
    d = members.withColumn("in_reach", F.collect_list(F.struct("s", "e")).over(ahead))
    fits = F.filter("in_reach", lambda x: x["e"] <= F.col("s") + most_ms)
    d = d.withColumn("speech", F.aggregate(fits, F.lit(0).cast("long"), lambda a, x: a + x["e"] - x["s"])).withColumn("until", F.array_max(F.transform(fits, lambda x: x["e"])))
    best = d.where("until is not null").groupBy("sid", "run").agg(F.max(F.struct("speech", (-F.col("s")).alias("ns"), "until")).alias("x"))
    return best.select("sid", "run", (-F.col("x.ns")).alias("win_s"), F.col("x.until").alias("win_e"), F.col("x.speech").alias("speech_ms"))
