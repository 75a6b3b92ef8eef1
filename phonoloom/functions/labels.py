"""Language names, acceptance tables, accents and heads: label rules as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names a recogniser gives its languages, with their codes.
NAMES = {
    "chinese": "zh", "cantonese": "yue", "english": "en", "arabic": "ar", "german": "de", "french": "fr", "spanish": "es", "portuguese": "pt", "indonesian": "id", "italian": "it",
    "korean": "ko", "russian": "ru", "thai": "th", "vietnamese": "vi", "japanese": "ja", "turkish": "tr", "hindi": "hi", "malay": "ms", "dutch": "nl", "swedish": "sv",
    "danish": "da", "finnish": "fi", "polish": "pl", "czech": "cs", "filipino": "fil", "persian": "fa", "greek": "el", "hungarian": "hu", "macedonian": "mk", "romanian": "ro",
}
# Regional labels of the same recogniser.
ZH_REGIONS = "anhui dongbei fujian gansu guizhou hebei henan hubei hunan jiangxi ningxia shandong shaanxi shanxi sichuan tianjin yunnan zhejiang".split()
REGIONS = {
    **{r: "zh" for r in ZH_REGIONS}, "wu language": "zh", "minnan language": "zh", "cantonese (hong kong accent)": "yue", "cantonese (guangdong accent)": "yue",
}
# Languages never accepted though in the table, and second parts of a detector's label that name a dialect.
SKIPPED = ("ms", "id")
DIALECTS = ("yue", "wu", "min", "xinan", "xiang", "hakka", "gan", "jin", "kejia", "hui", "pinghua", "cantonese")
# Accent heads by language.
HEADS = {"en": "voxlect_english", "zh": "voxlect_mandarin", "yue": "voxlect_mandarin", "ar": "voxlect_arabic"}
# Characters a second between slow, measured and fast.
SPEED_EDGES = {"en": (12.5, 19.8), "zh": (3.4, 5.4), "de": (14.2, 22.4), "ar": (10.4, 16.4), "ru": (8.0, 12.7), "pt": (10.2, 16.2), "ja": (5.9, 9.3)}


def _lookup(table: dict, key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), key)


def name_code(name: Column) -> Column:
    """I12. Code of a language name: the first of a list, a regional label, any Cantonese; ``unk`` for null and blank, ``unknown`` for any other."""
    low = F.lower(F.trim(F.coalesce(name, F.lit(""))))
    head = F.trim(F.split(low, ",")[0])
    return F.when(low == "", "unk").otherwise(F.coalesce(_lookup(NAMES, head), _lookup(REGIONS, low), F.when(F.contains(low, F.lit("cantonese")), "yue"), F.lit("unknown")))


def is_dialect(name: Column) -> Column:
    """I12. Whether a name's first part is set and no canonical name."""
    head = F.trim(F.split(F.lower(F.trim(F.coalesce(name, F.lit("")))), ",")[0])
    return (head != "") & _lookup(NAMES, head).isNull()


def lid_is_dialect(label: Column) -> Column:
    """I12. Whether a detector's label is ``zh`` and a dialect."""
    parts = F.split(F.lower(F.trim(F.coalesce(label, F.lit("")))), r"\s+")
    return F.coalesce((F.size(parts) >= 2) & (parts[0] == "zh") & F.try_element_at(parts, F.lit(2)).isin(*DIALECTS), F.lit(False))


def accepted_language(code: Column, supported: tuple[str, ...] = tuple(NAMES.values()), skipped: tuple[str, ...] = SKIPPED) -> Column:
    """C7. Whether a code is set, known, supported and not skipped."""
    return F.coalesce((code != "") & (code != "unknown") & code.isin(*supported) & ~code.isin(*skipped), F.lit(False))


def cascaded_dialect(coarse: Column, fine: Column) -> Column:
    """I11. A coarse label over a fine one: north and other leave it to the fine label, known varieties win in the order of the list; else the fine label."""
    low = F.lower(F.coalesce(coarse, F.lit("")))
    has = lambda w: F.contains(low, F.lit(w))
    # The order of the tests counts.
    out = F.when(has("north") | has("other"), fine)
    for word, variety in (("mandarin", "Standard Mandarin"), ("xinan", "Southwestern"), ("yue", "Cantonese"), ("wu", "wu"), ("min", "min"), ("xiang", "xiang")):
        out = out.when(has(word), variety)
    return out.otherwise(fine)


def accent_head(code: Column) -> Column:
    """K10. The head for a language's accents; null where there is none."""
    return _lookup(HEADS, code)


def speed_label(rate: Column, code: Column) -> Column:
    """I7. slow, measured or fast by the language's edges, on the unrounded rate; null without edges."""
    lo, hi = _lookup({k: v[0] for k, v in SPEED_EDGES.items()}, code), _lookup({k: v[1] for k, v in SPEED_EDGES.items()}, code)
    return F.when(rate.isNull() | F.isnan(rate) | lo.isNull(), F.lit(None)).when(rate < lo, "slow").when(rate > hi, "fast").otherwise("measured")


def age_of(label: Column, *years: Column) -> Column:
    """I10. Band of the median of the ages there are; the label child wins; null without any."""
    from .scalars import age_band

    held = F.array_sort(F.array_compact(F.array(*years)))
    n = F.size(held)
    mid = (F.try_element_at(held, F.floor((n + 1) / 2).cast("int")) + F.try_element_at(held, F.floor(n / 2).cast("int") + 1)) / 2
    return F.when(F.lower(label) == "child", "child").when(n > 0, age_band(mid))
