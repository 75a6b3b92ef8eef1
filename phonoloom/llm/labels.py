"""What a language label means, however it is spelled."""

from __future__ import annotations

import re
from functools import lru_cache

# The twelve languages with their three-letter codes and names in English and in themselves.
LANGUAGES = {
    "en": "eng english englisch anglais inglés",
    "de": "deu ger german deutsch allemand",
    "fr": "fra fre french français francais französisch",
    "es": "spa spanish español espanol castellano castilian",
    "pt": "por portuguese português portugues",
    "ru": "rus russian русский",
    "uk": "ukr ukrainian українська",
    "zh": "zho chi cmn chinese mandarin 中文 汉语 漢語 普通话",
    "ja": "jpn japanese 日本語 jp",
    "ko": "kor korean 한국어 kr",
    "th": "tha thai ไทย ภาษาไทย",
    "hi": "hin hindi हिन्दी हिंदी",
}
_CODES = {name: code for code, names in LANGUAGES.items() for name in (code, *names.split())}


@lru_cache(maxsize=10_000)
def label_code(label: str | None) -> str | None:
    """Two-letter code of a label in any known spelling, with or without region or script; None where it names no known language."""
    if label is None:
        return None
    s = label.strip().lower()
    if s in _CODES:
        return _CODES[s]
    head = re.split(r"[-_ .(@/]", s, maxsplit=1)[0]
    return _CODES.get(head)
