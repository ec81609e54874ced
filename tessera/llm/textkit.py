"""Shared text primitives of the training-data operators: look of characters, comparison words, sentence cuts."""

from __future__ import annotations

import re
import unicodedata

# Letters of other scripts drawn like a Latin letter.
CYRILLIC = dict(zip("АВЕЅІЈКМНОРСТУХаеѕіјорсухһԁ", "ABESIJKMHOPCTYXaesijopcyxhd", strict=True))
GREEK = dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧονα", "ABEZHIKMNOPTYXova", strict=True))
LOOKALIKES = CYRILLIC | GREEK
# Characters without width or ink. Joiners (200C, 200D) shape Indic conjuncts and are handled apart.
INVISIBLE = "\u00ad\u034f\u061c\u180e\u200b\u200e\u200f\u202a\u202b\u202c\u202d\u202e\u2060\u2061\u2062\u2063\u2064\u2066\u2067\u2068\u2069\ufeff"
JOINERS = "\u200c\u200d"
# Single blanks other than the space itself; a line break or tab is seen.
BLANKS = "\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"

SCRIPT_OF_LANGUAGE = {"mni": ("meitei", "bengali", "latin"), "bn": ("bengali",), "hi": ("devanagari",), "en": ("latin",)}
LANGUAGES = ("mni", "bn", "en", "hi")
MARKUP = re.compile(r"<[^<>]{0,300}>|&(?:[a-zA-Z]{2,8}|#\d{1,6});|\]\([^()\s]*\)|https?://\S+|www\.\S+")
SENTENCE_END = "।॥꯫.!?？！．"
_CUT = re.compile(r"(?<=[।॥꯫!?？！])[\"'”’)\]*_]*\s*|(?<=[.．])[\"'”’)\]*_]*(?=\s)|\n+")


class _Fold(dict):
    """Character to its comparison form, filled in on first sight: case, width and look-alikes folded, marks and letters
    kept, punctuation a blank, invisible characters nothing."""

    def __missing__(self, code: int) -> str:
        ch = chr(code)
        if ch in INVISIBLE or ch in JOINERS:
            out = ""
        elif ch in LOOKALIKES:
            out = LOOKALIKES[ch].lower()
        else:
            out = "".join(c if unicodedata.category(c)[0] in "LMN" else " " for c in unicodedata.normalize("NFKC", ch).lower())
        self[code] = out
        return out


FOLD = _Fold()


def words(text: str | None) -> list[str]:
    """Comparison words of a text: apart from case, punctuation, markup, spacing and look of characters. Null: none."""
    if not text:
        return []
    if "<" in text or "&" in text or "](" in text or "://" in text or "www." in text:
        text = MARKUP.sub(" ", text)
    if not unicodedata.is_normalized("NFC", text):
        text = unicodedata.normalize("NFC", text)
    return text.translate(FOLD).split()


def script_of(ch: str) -> str | None:
    """Script of a letter or vowel sign among the four of the corpus; None for anything else."""
    o = ord(ch)
    if o < 0x80:
        return "latin" if ch.isalpha() else None
    if 0xC0 <= o < 0x250:
        return "latin"
    if 0x900 <= o < 0x980:
        return None if 0x964 <= o <= 0x96F else "devanagari"
    if 0x980 <= o < 0xA00:
        return None if 0x9E6 <= o <= 0x9EF else "bengali"
    if 0xABC0 <= o < 0xABEB or 0xAAE0 <= o < 0xAAF7 or o in (0xABEC, 0xABED):
        return "meitei"
    return None


def sentences(text: str) -> list[tuple[int, int]]:
    """(start, end) of the stretches between sentence ends and line breaks; blank ones left out. The number of a list item
    is no sentence of its own."""
    out, at = [], 0
    for m in _CUT.finditer(text):
        if m.end() > at and (own := text[at : m.end()].strip()) and not (len(own) < 5 and own[-1] == "." and own[:-1].isdigit()):
            out.append((at, m.end()))
            at = m.end()
    if text[at:].strip():
        out.append((at, len(text)))
    return out
