"""Scalar functions as Column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Seconds per character allowed, by language.
RATIO_BOUNDS = {"zh": (0.04, 2.0), "yue": (0.04, 2.0), "ja": (0.04, 2.0), "ko": (0.04, 2.0), "th": (0.04, 2.0)}
RATIO_DEFAULT = (0.015, 1.0)
# Edges of loudness in LUFS and of pitch in Hz.
VOLUME_EDGES, PITCH_MALE, PITCH_FEMALE = (-27.0, -19.0), (115.7, 149.7), (141.6, 184.5)


def char_count(text: Column) -> Column:
    """I1. Characters that are neither white space nor of Unicode class P or Z; null stays null."""
    return F.length(F.regexp_replace(text, r"[\s\p{P}\p{Z}]", ""))


def split_tags(text: Column) -> tuple[Column, Column]:
    """I4. Text without bracketed tags, blanks collapsed, and the tags in order."""
    tags = F.regexp_extract_all(text, F.lit(r"\[([A-Za-z][A-Za-z-]*)\]"), F.lit(1))
    clean = F.trim(F.regexp_replace(F.regexp_replace(text, r"\[[A-Za-z][A-Za-z-]*\]", " "), r"\s+", " "))
    return clean, tags


def length_ratio(heard: Column, reference: Column) -> Column:
    """I5. Length of the heard text over the reference's, punctuation and spaces aside, two places; null without reference.

    Rounded as the binary number is, so 0.575, which lies below itself, gives 0.57.
    """
    h, r = char_count(heard), char_count(reference)
    return F.when(r > 0, F.floor(h / r * 100 + 0.5) / 100)


def bucket(value: Column, edges: tuple[float, float], names: Sequence[str]) -> Column:
    """I6. First name below the lower edge, third above the upper, else the second; null and NaN stay null."""
    ok = value.isNotNull() & ~F.isnan(value)
    return F.when(ok & (value < edges[0]), names[0]).when(ok & (value > edges[1]), names[2]).when(ok, names[1])


def by_language(lang: Column, values: Mapping[str, float], default: float) -> Column:
    """A per-language constant, the language compared in lower case without blanks."""
    table = F.create_map(*[F.lit(x) for kv in values.items() for x in kv])
    return F.coalesce(F.try_element_at(table, F.lower(F.trim(lang))), F.lit(default))


def seconds_per_char_ok(seconds: Column, chars: Column, lang: Column) -> Column:
    """C5. Whether seconds a character lie within the language's bounds, both included; false without characters or time."""
    lo = by_language(lang, {k: v[0] for k, v in RATIO_BOUNDS.items()}, RATIO_DEFAULT[0])
    hi = by_language(lang, {k: v[1] for k, v in RATIO_BOUNDS.items()}, RATIO_DEFAULT[1])
    r = seconds / F.nullif(chars, F.lit(0))
    return F.coalesce((seconds > 0) & r.between(lo, hi), F.lit(False))


def speech_rate(chars: Column, seconds: Column) -> Column:
    """I8. Characters a second; null below half a second or without characters."""
    return F.when((seconds >= 0.5) & (chars > 0), chars / seconds)


def text_rate(text: Column, seconds: Column) -> Column:
    """I8. Characters of the raw text a second of the whole duration; null below half a second or without text."""
    return speech_rate(F.length(text), seconds)


def heard_rate(text: Column, seconds: Column, cap: float = 30.0) -> Column:
    """I8. Characters of recognised text a second, the duration capped, as a recogniser hears no more."""
    return speech_rate(char_count(text), F.least(seconds, F.lit(cap)))


def relative_distance(a: Column, b: Column) -> Column:
    """I9. |a - b| over the greater absolute value; unknown counts as 0."""
    return F.coalesce(F.abs(a - b) / F.nullif(F.greatest(F.abs(a), F.abs(b)), F.lit(0)), F.lit(0.0))


def age_band(years: Column, label: Column | None = None) -> Column:
    """I10. Band of an age by the edges 13, 18, 43 and 60; the label child wins."""
    band = F.when(years < 13, "child").when(years < 18, "teen").when(years < 43, "young").when(years < 60, "middle").when(years >= 60, "senior")
    return band if label is None else F.when(label == "child", "child").otherwise(band)


def truncated_sample(seconds: Column, rate: int, total: Column) -> Column:
    """I14. Sample position by truncation, within [0, total]."""
    return F.greatest(F.lit(0), F.least((seconds * rate).cast("long"), total))


def nearest_sample(seconds: Column, rate: int) -> Column:
    """I14. Sample position by rounding to the nearest, half to even."""
    return F.bround(seconds * rate).cast("long")


# Coefficients of the quality polynomials, the highest power first.
QUALITY = {"sig": (-0.08397278, 1.22083953, 0.0052439), "bak": (-0.13166888, 1.60915514, -0.39604546), "ovr": (-0.06766283, 1.11546468, 0.04602535)}
QUALITY_PERSONAL = {
    "sig": (-0.01019296, 0.02751166, 1.19576786, -0.24348726), "bak": (-0.04976499, 0.44276479, -0.1644611, 0.96883132), "ovr": (-0.00533021, 0.005101, 1.18058466, -0.11236046),
}


def polynomial(x: Column, coefficients: Sequence[float]) -> Column:
    """I25. A polynomial by Horner's rule, the highest power first."""
    out = F.lit(float(coefficients[0]))
    for c in coefficients[1:]:
        out = out * x + F.lit(float(c))
    return out


def clip_id(stem: Column) -> Column:
    """I20. What follows seven digits and an underscore in a clip's name; null for any other name."""
    return F.nullif(F.regexp_extract(stem, r"^[0-9]{7}_(.+)$", 1), F.lit(""))


def pitch_label(hz: Column, gender: Column) -> Column:
    """I7, I26. low, medium or high by the gender's edges; an unknown gender takes those of female."""
    return F.when(gender == "male", bucket(hz, PITCH_MALE, ("low", "medium", "high"))).otherwise(bucket(hz, PITCH_FEMALE, ("low", "medium", "high")))


def hex_modulo(hexes: Column, n: int) -> Column:
    """I15, I17. A hexadecimal string modulo ``n``, by Horner's rule: exact for any length."""
    digits = F.split(hexes, "")
    step = lambda acc, d: F.pmod(acc * 16 + F.conv(d, 16, 10).cast("long"), F.lit(n))
    return F.aggregate(F.filter(digits, lambda d: d != ""), F.lit(0).cast("long"), step)


def draw(prefix: str, seed: int, key: Column, n: int) -> Column:
    """I15. Deterministic draw from 0..n-1 by the md5 of prefix, seed and key."""
    return hex_modulo(F.md5(F.concat(F.lit(f"{prefix}{seed}:"), key).cast("binary")), n)


def crc_shard(key: Column, n: int) -> Column:
    """I16. Shard of a key by crc32."""
    return F.crc32(key.cast("binary")) % n


def round_robin(position: Column, weights: Sequence[int]) -> Column:
    """I18. Worker of a position when workers take turns round by round, each as often as its weight."""
    turns = [w for r in range(max(weights)) for w, k in enumerate(weights) if k > r]
    return F.element_at(F.array(*[F.lit(t) for t in turns]), (F.pmod(position, F.lit(len(turns))) + 1).cast("int"))


def clipped(text: Column, most: int, suffix: str = " ...") -> Column:
    """I21. At most ``most`` characters, cut at the last space if one lies in the second half."""
    head = F.substring(text, 1, most)
    last = most - F.locate(" ", F.reverse(head)) + 1
    cut = F.when((F.locate(" ", head) > 0) & (last > most / 2), F.substring(head, F.lit(1), (last - 1).cast("int"))).otherwise(head)
    return F.when(F.length(text) <= most, text).otherwise(F.concat(cut, F.lit(suffix)))


def time_label(ms: Column) -> Column:
    """I24. Minutes and seconds as m:ss."""
    s = F.floor(ms / 1000)
    return F.format_string("%d:%02d", F.floor(s / 60), s % 60)


def top_labels(scores: Column, k: int = 3) -> Column:
    """G3. The ``k`` greatest (label, score) entries of an array of structs, label at ties."""
    order = lambda a, b: F.when(a["score"] > b["score"], -1).when(a["score"] < b["score"], 1).when(a["label"] < b["label"], -1).when(a["label"] > b["label"], 1).otherwise(0)
    return F.slice(F.array_sort(scores, order), 1, k)
