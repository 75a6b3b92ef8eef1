"""Ordered rules over rows: verdicts, roles, routes, gates and names, each as a Column or a small DataFrame step."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions import scalars as X
from ..sources.files import safe_path
from .verdicts import most_repeats, repeated_text_share

# What a verdict makes of an item; anything else breaks.
ROLES = {"blank": "SILENCE", "too_short": "SILENCE"}


def with_repetition(df: DataFrame, text: str, out: str = "repeats", share: str = "repeated") -> DataFrame:
    """Adds the I2 count and the I3 share of ``text``; one Arrow pass over the text for both. Null texts have 1 and 0."""

    def count(texts: pd.Series) -> pd.Series:
        return texts.map(most_repeats)

    def part(texts: pd.Series) -> pd.Series:
        return texts.map(repeated_text_share).astype(float)

    t = F.coalesce(F.col(text), F.lit(""))
    return df.withColumn(out, F.pandas_udf(count, "long")(t)).withColumn(share, F.pandas_udf(part, "double")(t))


def chunk_verdict(text: Column, lang: Column, accepted: Column, seconds: Column, repeated: Column, fewest: int = 1) -> Column:
    """C4. no_result, lang_rejected, asr_repetition, blank, too_short, ratio; null where all pass. ``repeated`` is the I3 share."""
    chars = F.coalesce(X.char_count(text), F.lit(0))
    return (
        F.when((F.trim(F.coalesce(text, F.lit(""))) == "") & (F.coalesce(lang, F.lit("")) == ""), "no_result")
        .when(~F.coalesce(accepted, F.lit(False)), "lang_rejected")
        .when(repeated >= 0.8, "asr_repetition")
        .when(chars == 0, "blank")
        .when(chars < fewest, "too_short")
        .when(~F.coalesce(seconds > 0, F.lit(False)) | ~X.seconds_per_char_ok(seconds, chars, lang), "ratio")
    )


def role_of(reason: Column) -> Column:
    """C28. OK without a reason, SILENCE for blank and too short, else BREAK."""
    return F.when(reason.isNull(), "OK").when(reason.isin(*ROLES), "SILENCE").otherwise("BREAK")


def routed(rows: DataFrame, final: DataFrame, key: list[str], code: str) -> DataFrame:
    """C8, C9. Adds ``route``: secondary where the language is accepted and the row not final yet, primary where it is
    unset, unknown or accepted and final, unsupported where it is known to no table (a BREAK as a member)."""
    lang = F.lower(F.trim(F.coalesce(F.col(code), F.lit(""))))
    done = final.select(*key).distinct().withColumn("__final", F.lit(True))
    ok = L.accepted_language(lang)
    route = F.when(ok & F.col("__final").isNull(), "secondary").when(ok | lang.isin("", "unknown"), "primary").otherwise("unsupported")
    return rows.join(done, key, "left").withColumn("route", route).drop("__final")


def rescued(units: DataFrame, heard: str, seconds: Column) -> DataFrame:
    """C27. Adds ``rescue``: blank, degenerate, asr_repetition or ok for units whose second result is ``heard``."""
    d = with_repetition(units, heard)
    chars = F.coalesce(X.char_count(F.col(heard)), F.lit(0))
    degenerate = (chars > 80) & (seconds > 0) & (chars / seconds > 25) & (F.col("repeats") >= 3)
    blank = F.trim(F.coalesce(F.col(heard), F.lit(""))) == ""
    return d.withColumn("rescue", F.when(blank, "blank").when(degenerate, "degenerate").when(F.col("repeated") >= 0.8, "asr_repetition").otherwise("ok")).drop("repeats", "repeated")


def input_gate(rate: Column, seconds: Column, channels: Column) -> Column:
    """C13. low_rate below 24 kHz, too_long from five hours, too_large above 3.5e9 decoded bytes (unknown channels count two); null where all pass."""
    size = seconds * rate * F.coalesce(channels, F.lit(2)) * 4
    return F.when(F.coalesce(rate, F.lit(0)) < 24_000, "low_rate").when(seconds >= 5 * 3600, "too_long").when(size > 3.5e9, "too_large")


def safe_name(name: Column) -> Column:
    """C30. Whether a name may be a file's: not blank, no NUL, no separator, neither ``.`` nor ``..``. Null is not."""
    return F.coalesce((F.trim(name) != "") & ~F.contains(name, F.lit("\x00")) & ~F.contains(name, F.lit("/")) & ~F.contains(name, F.lit("\\")) & ~name.isin(".", ".."), F.lit(False))


def placed_interval(lo: Column, hi: Column, start: Column, end: Column) -> tuple[Column, Column, Column]:
    """C29. (problem, start, end) of an item within its parent [lo, hi]: ``missing``, ``empty`` (not ending after its start), ``outside``, else null and the clamped bounds."""
    missing = start.isNull() | end.isNull() | hi.isNull()
    why = F.when(missing, "missing").when(end <= start, "empty").when((start >= hi) | (end <= lo), "outside")
    return why, F.when(why.isNull(), F.greatest(start, lo)), F.when(why.isNull(), F.least(end, hi))


def usable_manifest(rows: DataFrame, shard: int | None = None, of: int = 1, strict: bool = False) -> DataFrame:
    """A5. Manifest rows (id, wav_path, source_tar, source_member, parent_id) of a shard that name audio: by a safe path or by an archive's member.

    The shard goes first, by crc32 of the parent or else the id. A row without id takes the last part of
    its path. With ``strict`` an unusable row raises, else it is left out. Extra columns stay.
    """
    d = rows if shard is None else rows.where(F.coalesce(X.crc_shard(F.coalesce("parent_id", "id"), of), F.lit(0)) == shard)
    path = F.col("wav_path")
    inside = safe_path(path)
    packed = F.col("source_tar").isNotNull() & F.col("source_member").isNotNull()
    d = d.withColumn("__ok", inside | packed)
    if strict and not d.where("not __ok").isEmpty():
        raise ValueError("a manifest row names no usable audio")
    name = F.regexp_extract(F.coalesce(path, F.col("source_member")), r"([^/]+)$", 1)
    return d.where("__ok").withColumn("id", F.coalesce("id", name)).withColumn("via", F.when(path.isNotNull() & inside, "path").otherwise("archive")).drop("__ok")


# The marks a boundary stands after.
BOUNDARY = ".!?。！？；;，,"


_AFTER = re.compile(rf"[{BOUNDARY}]\s*")


def boundary_places(text: str) -> list[int]:
    """I23. Character positions where an insertion may stand: 0, after each boundary mark and the blanks behind it, and the end; ascending."""
    return sorted({0, len(text), *(m.end() for m in _AFTER.finditer(text))})


def boundaries(text: Column) -> Column:
    """``boundary_places`` as a column, in Arrow batches: a fold over the parts in the JVM would copy the array at every step. Null has one place."""

    def run(texts: pd.Series) -> pd.Series:
        return texts.map(boundary_places)

    return F.pandas_udf(run, "array<int>")(F.coalesce(text, F.lit("")))


def speaker_at(text: Column, position: Column) -> Column:
    """I23. The last turn tag that is closed by ``position``; null without any."""
    return F.nullif(F.regexp_extract(F.substring(text, F.lit(1), position.cast("int") + 1), r"(?s)\A.*\[(S\d+)\]", 1), F.lit(""))


# Words that speak for a sound, in the order ties are settled.
KEYWORDS = {
    "Laughter": "haha laugh laughing funny joke hilarious amusing 哈哈 笑 好笑 玩笑 滑稽 恭喜".split(),
    "Crying": "cry crying tears funeral murder killed bereaved heartbroken grief tragic tragedy sobbing 哭 泪 病逝 去世 身亡 悲痛 悲伤 丧生 遇难 诀别 恸哭 心碎".split(),
    "Sigh": ["sigh", "sorry", "regret", "difficult", "worry", "worried", "uncertain", "unfortunately", "disaster", "failed", "failure", "wrong", "struggle", "don.t know", "do not know",
             *"抱歉 遗憾 不知道 不容易 困难 担心 无奈 可怕 糟糕 失败 问题 不确定 没办法 痛苦 难过".split()],
}
#: what is drawn where no word speaks, by the number drawn from 0..7
DRAWN = ("Breathing", "Breathing", "Breathing", "Laughter", "Sigh", "Breathing", "Cough", "Cough")


def _speaks(context: Column, word: str) -> Column:
    if word.isascii() and word.replace("'", "").replace(" ", "").isalpha():
        return context.rlike(rf"(?i)(?<![A-Za-z]){word}(?![A-Za-z])")
    return F.contains(F.lower(context), F.lit(word.lower()))


def keyword_scores(context: Column) -> dict[str, Column]:
    """I22. Per sound the number of its words in a stretch of text; Latin words count between non-letters, others anywhere."""
    return {tag: sum((F.coalesce(_speaks(context, w), F.lit(False)).cast("int") for w in words), F.lit(0)) for tag, words in KEYWORDS.items()}


def sound_for(context: Column, key: Column) -> Column:
    """I22. The sound with the most words, the first of the list at ties; where none speaks, one drawn by the sha256 of ``key``."""
    scores = keyword_scores(context)
    best = F.greatest(*scores.values())
    drawn = F.element_at(F.array(*[F.lit(x) for x in DRAWN]), (F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("long") % 8 + 1).cast("int"))
    chosen = F.when(best == 0, drawn)
    for tag, n in scores.items():
        chosen = chosen.when(n == best, tag)
    return chosen


def insertion_points(text: str, start: float, end: float, targets: list[float]) -> list[tuple[float, int]]:
    """F25. For each target time the free boundary nearest to its share of the text, the lower at ties: (target, position).

    A taken boundary isn't used again; targets that find none free are left out. Looks outward from the
    ideal place, so a text of n boundaries and k targets takes k steps beyond those taken.
    """
    places = boundary_places(text)
    span, taken, out = max(end - start, 0.001), set(), []
    for t in targets:
        ideal = round(min(1.0, max(0.0, (t - start) / span)) * len(text))
        hi = bisect_left(places, ideal)
        lo = hi - 1
        while lo >= 0 or hi < len(places):
            below = ideal - places[lo] if lo >= 0 else None
            above = places[hi] - ideal if hi < len(places) else None
            if above is None or below is not None and below <= above:
                p, lo = places[lo], lo - 1
            else:
                p, hi = places[hi], hi + 1
            if p not in taken:
                taken.add(p)
                out.append((t, p))
                break
    return out


def insertions(texts: DataFrame, every: int = 30) -> DataFrame:
    """F25. (id, event, target, position) for rows (id, text, seconds): targets every ``every`` seconds, a last one close to the end moved as in F24.

    Null and blank texts and durations below one step give no row; one text at a time is held.
    """
    kind = texts.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for i, t, sec in zip(b["id"], b["text"], b["seconds"]):
                at = [float(every * k) for k in range(1, int(sec // every) + 1)]
                if at and sec - at[-1] < 10:
                    at[-1] = round(max((at[-2] if len(at) > 1 else 0.0) + every / 2, sec - 10), 3)
                rows += [(i, k, x, p) for k, (x, p) in enumerate(insertion_points(t, 0.0, sec, at), 1)]
            if rows:
                yield pd.DataFrame(rows, columns=["id", "event", "target", "position"])

    ok = texts.where("id is not null and trim(text) <> '' and seconds > 0")
    return ok.select("id", "text", F.col("seconds").cast("double").alias("seconds")).mapInPandas(run, f"id {kind}, event int, target double, position int")


def prompt_fits(tokens: Column, answer: int, most: int = 8192) -> Column:
    """C31. Whether a prompt and its answer stay within the model's length; null tokens don't."""
    return F.coalesce(tokens + answer <= most, F.lit(False))


def with_insertions(text: str, marks: list[tuple[int, str]]) -> str:
    """L5. ``text`` with each bracketed tag put in at its position; equal positions keep the order given."""
    for _, p, tag in sorted(((i, p, t) for i, (p, t) in enumerate(marks)), key=lambda m: (m[1], m[0]), reverse=True):
        text = f"{text[:p]}[{tag}]{text[p:]}"
    return text


def without_insertions(text: str, marks: list[tuple[int, str]]) -> str:
    """L5. The text before ``with_insertions``: tags are taken out where they were put in; a tag that isn't there raises."""
    for p, tag in sorted(marks, key=lambda m: m[0]):
        piece = f"[{tag}]"
        if not text.startswith(piece, p):
            raise ValueError(f"no {piece} at {p}")
        text = text[:p] + text[p + len(piece) :]
    return text


def tagged_texts(texts: DataFrame, every: int = 30) -> DataFrame:
    """F25, L5. (id, n_tags, tagged, lossless) for rows (id, text, seconds): sounds drawn by I15 put in at the distinct boundaries of F25, and
    whether taking them out gives the text again. Texts without an insertion come back as they are with n_tags 0; null and blank texts give no row."""
    at = insertions(texts, every)
    tag = F.element_at(F.array(*[F.lit(x) for x in DRAWN]), (F.conv(F.substring(F.sha2(F.concat(F.col("id").cast("string"), F.lit(":"), F.col("event").cast("string")).cast("binary"), 256), 1, 8), 16, 10).cast("long") % 8 + 1).cast("int"))
    marks = at.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("position", "event", tag.alias("tag")))).alias("marks"))
    d = texts.where("id is not null and trim(text) <> ''").select("id", "text").join(marks, "id", "left")
    kind = texts.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for i, t, m in zip(b["id"], b["text"], b["marks"]):
                put = [(int(x["position"]), x["tag"]) for x in m] if m is not None else []
                out = with_insertions(t, put)
                rows.append((i, len(put), out, int(without_insertions(out, put) == t)))
            if rows:
                yield pd.DataFrame(rows, columns=["id", "n_tags", "tagged", "lossless"])

    return d.mapInPandas(run, f"id {kind}, n_tags int, tagged string, lossless int")


def gated_label(label: Column, confidence: Column, tau: float) -> tuple[Column, Column]:
    """C14. (label, confidence to four places) where the confidence reaches ``tau`` and the label is set and not ``unknown``; else null and the confidence.

    ``tau`` must be given and lie in [0, 1]; that is checked while planning. A null or NaN confidence reaches nothing.
    """
    if not 0 <= tau <= 1:
        raise ValueError(f"tau must lie in [0, 1], not {tau}")
    sure = confidence.isNotNull() & ~F.isnan(confidence) & (confidence >= tau)
    return F.when(sure & (F.coalesce(label, F.lit("")) != "") & (label != "unknown"), label), F.round(confidence, 4)
