"""Words of a text for matching: markup, accents, case, joiners, broken lines and letter variants do not count."""

from __future__ import annotations

import html
import re
import sys
import unicodedata

_TAG = re.compile(r"</?[a-zA-Z][a-zA-Z0-9]*(?:\s[^<>]{0,200})?/?>")
_BROKEN = re.compile(r"(?<=\w)[-‐­][ \t]*\r?\n[ \t]*(?=\w)")
_WORD = re.compile(r"[^\W_]+")
#: what stands between ASCII characters that are no letters or digits
_RUN = re.compile(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
#: fixed values: Arabic-script letters written for one another
LETTERS = {"أ": "ا", "إ": "ا", "آ": "ا", "ٱ": "ا", "ى": "ي", "ئ": "ي", "ی": "ي", "ة": "ه", "ۀ": "ه", "ؤ": "و", "ک": "ك", "ـ": ""}


def _fold_table() -> dict[int, str]:
    """What each marked, formatting, digit or variant character becomes, from the character database."""
    table = {}
    for n in range(sys.maxunicode + 1):
        c = chr(n)
        kind = unicodedata.category(c)
        if kind in ("Mn", "Cf"):
            table[n] = ""
        elif kind == "Nd" and n > 127:
            table[n] = str(unicodedata.digit(c))
    return table | {ord(k): v for k, v in LETTERS.items()}


_FOLD = _fold_table()


def _plain(text: str) -> str:
    """Without tags, entities and words broken over lines."""
    if "<" in text:
        text = _TAG.sub("", text)
    if "&" in text:
        text = html.unescape(text)
    if "-" in text or "­" in text or "‐" in text:
        text = _BROKEN.sub("", text)
    return text


def fold(text: str) -> str:
    text = _plain(text)
    return text.lower() if text.isascii() else _folded(text)


def _folded(text: str) -> str:
    # Letter variants once before decomposition (which would split some) and marks after it.
    return unicodedata.normalize("NFKD", text.translate(_FOLD)).translate(_FOLD).casefold()


_seen: dict[str, list[str]] = {}


def words(text: str | None) -> list[str]:
    """The words of the whole text in order; [] for null, empty and wordless texts. The same as _WORD.findall(fold(text)).

    Folding looks at no character beyond the ASCII marks and blanks around a run, so a run is folded once for a worker.
    """
    if not text:
        return []
    text = _plain(text)
    if text.isascii():
        return _WORD.findall(text.lower())
    if len(_seen) > 200_000:
        _seen.clear()
    out: list[str] = []
    for run in _RUN.findall(text):
        own = _seen.get(run)
        if own is None:
            own = _WORD.findall(_folded(run))
            if len(run) <= 64:
                _seen[run] = own
        out += own
    return out
