"""One spelling per speaker: numbered voices as ``S`` and the number, people by their bare name."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

# Words that name nobody, and the roles people are given beside their name.
NOBODY = frozenset(
    "unknown unk none null nan n/a na nil anonymous anon undefined unidentified tbd - -- . ... ? ?? ??? * _ "
    "unbekannt anonym inconnu anonyme desconocido desconhecido anonimo anônimo anónimo неизвестно неизвестный аноним "
    "невідомо невідомий анонім 未知 匿名 不明 알수없음 익명 ไม่ทราบ अज्ञात speaker spk".split()
)
ROLES = frozenset(
    "host guest moderator interviewer interviewee narrator presenter anchor caller reporter speaker cohost co-host "
    "panelist expert announcer guide chair audience".split()
)
# a single word, whatever the language, then a number
_NUMBERED = re.compile(r"^[\[<({]?\s*[^\s\d]*?[\s_:#.\-]*(\d+)\s*[\]>)}]?[\s:.]*$")
_ASIDE = re.compile(r"\([^)]*\)|\[[^\]]*\]|\{[^}]*\}|<[^>]*>")
_DASH_ROLE = re.compile(r"\s+[-–—/|,]\s*.*$|,.*$")


@lru_cache(maxsize=100_000)
def speaker_key(label: str | None) -> str | None:
    """The one name of a speaker label, or None where it names nobody.

    Null, blank, placeholders and labels without letters give None; ``SPK-02`` and ``話者 2`` give
    ``S2``; ``Ann  Lee (host)`` gives ``ann lee``.
    """
    if label is None:
        return None
    s = " ".join(unicodedata.normalize("NFKC", label).replace("_", " ").split())
    if s.casefold() in NOBODY or not any(c.isalnum() for c in s):
        return None
    if m := _NUMBERED.match(s):
        return f"S{int(m[1])}"
    bare = _ASIDE.sub(" ", s)
    if not any(c.isalpha() for c in bare):  # the whole label stood in brackets
        bare = s.strip("[](){}<> :")
        return speaker_key(bare) if bare != s else None
    bare = _DASH_ROLE.sub("", bare)
    words = [w for w in re.split(r"[\s_]+", bare.strip(" :;.,-–—").lower()) if w]
    kept = [w for w in words if w.strip(":.,") not in ROLES] or []
    name = " ".join(kept).strip(" :;.,-–—")
    return None if not name or name in NOBODY else name


def is_person(key: str | None) -> bool:
    """Whether a speaker_key names a person and not a numbered voice."""
    return key is not None and not re.fullmatch(r"S\d+", key)
