"""Column functions: normalisation, cleaning, keys and snippets. All but `nfc` stay in the JVM. Null in, null out."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Fixed values.
DOUBLE_QUOTES = "“”„‟«»″‶"
SINGLE_QUOTES = "‘’‚‛′‵`´"
ZERO_WIDTH = r"[​﻿]"
CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f\xad]"
CONTROL_ASCII = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"
URL = r"(?U)(?:https?://|www\.|ftp://)\S+?(?=[.,;:?!]*(?:\s|$))"
EMAIL = r"(?U)\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b"
FOREIGN = {"gujarati": "઀-૿", "odia": "଀-୿", "tamil": "஀-௿", "telugu": "ఀ-౿", "kannada": "ಀ-೿", "malayalam": "ഀ-ൿ", "gurmukhi": "਀-੿"}
CATEGORIES = ("grammar", "textbook", "dictionary", "story", "government", "news", "literature", "books")


def rsub(c: Column, pattern: str, to: str = "") -> Column:
    return F.regexp_replace(c, pattern, to)


def strip(c: Column) -> Column:
    """Without white space of any kind at either end."""
    return rsub(rsub(c, r"(?U)^\s+"), r"(?U)\s+$")


@F.pandas_udf(StringType())
def nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda t: t if t is None or unicodedata.is_normalized("NFC", t) else unicodedata.normalize("NFC", t))


def fold_quotes(c: Column) -> Column:
    return F.translate(c, DOUBLE_QUOTES + SINGLE_QUOTES, '"' * len(DOUBLE_QUOTES) + "'" * len(SINGLE_QUOTES))


def tidy_punctuation(c: Column) -> Column:
    return rsub(rsub(rsub(c, r"(?U)\s+([.,!?])", "$1"), r"\.\.\.+", "..."), " +", " ")


def normalise(c: Column) -> Column:
    return tidy_punctuation(fold_quotes(rsub(rsub(nfc(c), ZERO_WIDTH), CONTROL)))


def strip_markup(c: Column) -> Column:
    return rsub(rsub(c, r"<\?[^?>]+\?>|<![^>]+>"), r"<[^>]+>")


def strip_markdown(c: Column) -> Column:
    return rsub(rsub(rsub(c, r"!?\[([^\]]*)\]\([^)]*\)", "$1"), r"(?m)^#{1,6}\s+"), r"[*_`]|~~")


def drop_addresses(c: Column) -> Column:
    return rsub(rsub(c, URL), EMAIL)


def drop_foreign(c: Column) -> Column:
    return rsub(c, "[" + "".join(FOREIGN.values()) + "]")


def foreign_counts(c: Column) -> Column:
    """Map of script to number of its characters, those with any."""
    pairs = [x for k, v in FOREIGN.items() for x in (F.lit(k), F.regexp_count(c, F.lit(f"[{v}]")))]
    return F.map_filter(F.create_map(*pairs), lambda _, n: n > 0)


def tidy_lines(c: Column) -> Column:
    lines = F.transform(F.split(F.translate(c, "\t", " "), r"\R"), lambda x: rsub(strip(x), " +", " "))
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


def drop_scan_noise(c: Column) -> Column:
    return strip(rsub(rsub(rsub(c, r"(?U)^\s*\([ivxIVX0-9]+\)\s*"), r"[.\-_=~]{3,}", " "), " +", " "))


def clean(c: Column, markup: bool = True, markdown: bool = True, addresses: bool = True, control: bool = True, foreign: bool = True, lines: bool = True, noise: bool = True) -> Column:
    """The cleaning steps in their order, each of which can be left out."""
    for wanted, step in ((markup, strip_markup), (markdown, strip_markdown), (addresses, drop_addresses), (control, lambda x: rsub(x, CONTROL_ASCII)), (foreign, drop_foreign), (lines, tidy_lines), (noise, drop_scan_noise)):
        c = step(c) if wanted else c
    return c


def canonical_spaces(c: Column) -> Column:
    return strip(rsub(c, r"(?U)\s+", " "))


def dedup_key(c: Column) -> Column:
    return canonical_spaces(F.lower(c))


def words(c: Column) -> Column:
    """Parts between white space of any kind; no empty ones."""
    return F.filter(F.split(c, r"(?U)\s+"), lambda w: w != "")


def word_count(c: Column) -> Column:
    return F.size(words(F.coalesce(c, F.lit(""))))


def category(c: Column, default: str = "unknown") -> Column:
    low = F.lower(strip(c))
    out = F.when(low.isNull() | low.isin("", "unknown"), default)
    for name in CATEGORIES:
        out = out.when(low.contains(name), name)
    return out.otherwise(low)


def snippet(c: Column, n: int) -> Column:
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("..."))).otherwise(c)


def token_estimate(c: Column) -> Column:
    return F.floor(word_count(c) * F.lit(1.4))
