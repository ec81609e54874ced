"""Problem 4: visually identical text with different characters, brought to one form.

Script-aware repair: width, blanks, invisible characters and composition follow fixed rules. Look-alike letters are replaced
in tokens of more than one script only, by the letters of the script dominant in the token: that of most of its letters
without a look-alike, without such letters the text's, else that of most letters; and only if the result is a word of the corpus, which
stands there in letters of that script alone. A token of one script made of look-alikes only, in a text whose other letters
are mostly of another script, mixes the text's scripts and is treated alike. All else of one script stays as it is. Digits,
case, accents and raised figures stay, being visible."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.runtime import table, written
from tessera.llm.textkit import BLANKS, CYRILLIC, GREEK, INVISIBLE, JOINERS, LOOKALIKES
from tessera.llm.wordtable import split_join

LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st"}
WIDE = {0xFF01 + i: chr(0x21 + i) for i in range(94)}
RULES = WIDE | {ord(k): v for k, v in LIGATURES.items()} | dict.fromkeys(map(ord, INVISIBLE), "") | dict.fromkeys(map(ord, BLANKS), " ")
# Letter to its look-alike, by the script to turn to.
ALIKE = {
    "latin": {ord(k): v for k, v in LOOKALIKES.items()},
    "cyrillic": {ord(v): k for k, v in reversed(CYRILLIC.items())} | {ord(g): c for g, x in GREEK.items() for c, y in CYRILLIC.items() if x == y},
    "greek": {ord(v): k for k, v in reversed(GREEK.items())} | {ord(c): g for c, x in CYRILLIC.items() for g, y in GREEK.items() if x == y},
}
# Letters and signs that no rule touches: a text of these alone, without a split vowel sign, is its own form.
SETTLED = "[^\u0009-\u007e\uaae0-\uabff\u0980-\u09d6\u09d8-\u09db\u09de\u09e0-\u09ff\u0900-\u0928\u092a-\u0930\u0932\u0933\u0935-\u0957\u0960-\u097f\u00c0-\u024f\u2014\u201c\u201d]"
SPLIT_VOWEL = "\u09c7\u09be"
TOKEN = re.compile(r"[^\W\d_]+")
FAMILY = re.compile("([A-Za-z\u00c0-\u024f])|([\u0400-\u052f])|([\u0370-\u03ff])")
SCRIPTS = ("latin", "cyrillic", "greek")
ASKED = re.compile("[\u0370-\u03ff\u0400-\u052f]")
BOUND = 200_000  # words looked up by broadcast; more are joined by shuffle
_JOINER = re.compile("(?<![\u094d\u09cd\uabed])[\u200c\u200d]")


def plain(text: str) -> str:
    """Everything but look-alikes: invisible characters out, joiners kept only after a virama, blanks to spaces, full
    width and ligatures to ordinary letters, canonical composition."""
    text = text.translate(RULES)
    if JOINERS[0] in text or JOINERS[1] in text:
        text = _JOINER.sub("", text)
    return unicodedata.normalize("NFC", text)


def family(ch: str) -> str | None:
    """latin, cyrillic or greek; None for any other letter."""
    m = FAMILY.match(ch)
    return SCRIPTS[m.lastindex - 1] if m else None


def leading(counts: dict[str, int], among: set[str]) -> str | None:
    """The script counted most often among some, None on a tie or without any."""
    top = sorted(((counts.get(s, 0), s) for s in among), reverse=True)
    return top[0][1] if top and top[0][0] and (len(top) == 1 or top[0][0] > top[1][0]) else None


def repairs(text: str) -> dict[str, str]:
    """Token to what it would be in its dominant script, of the tokens of a plain text that mix scripts (or the text's)."""
    if not ASKED.search(text):
        return {}
    tokens = set(TOKEN.findall(text))
    read, whole = {}, {}
    for token in tokens:
        counts: dict[str, int] = {}
        sure: dict[str, int] = {}  # letters that look like none of another script
        for c in token:
            s = family(c) or "other"
            counts[s] = counts.get(s, 0) + 1
            if not any(ord(c) in ALIKE[t] for t in SCRIPTS if t != s):
                sure[s] = sure.get(s, 0) + 1
        read[token] = counts, sure
        for s, n in (sure or counts).items():
            whole[s] = whole.get(s, 0) + n
    main = leading(whole, set(SCRIPTS))
    out = {}
    for token, (counts, sure) in read.items():
        own = set(counts)
        if "other" in own:
            continue
        if len(own) > 1:
            to = leading(sure, own) if sure else main if main in own else leading(counts, own)
        else:
            to = main if not sure and main not in own else None
        if to and (fixed := "".join(c if family(c) == to else ALIKE[to].get(ord(c), c) for c in token)) != token and all(family(c) == to for c in fixed):
            out[token] = fixed
    return out


def repair(text: str, known: set[str]) -> str:
    """A plain text with its mixed tokens replaced where the result, in lower case, is known."""
    told = {k: v for k, v in repairs(text).items() if v.lower() in known}
    return TOKEN.sub(lambda m: told.get(m[0], m[0]), text) if told else text


def odd(text: Column) -> Column:
    """Whether a text holds a character that a rule may change."""
    return text.rlike(SETTLED) | text.contains(SPLIT_VOWEL)


def mended(base: DataFrame) -> DataFrame:
    """(doc_id, own, form) of the rows (doc_id, text) that hold a character some rule may change; own: hash of the text."""
    kind = base.schema["doc_id"].dataType.simpleString()

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            forms = pdf["text"].map(plain)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "own": pdf["own"], "form": forms, "words": forms.map(lambda t: sorted({x.lower() for x in repairs(t).values()}))})

    rows = written(base.where(odd(F.col("text"))).withColumn("own", F.xxhash64("text")).mapInPandas(read, f"doc_id {kind}, own long, form string, words array<string>"), "odd")
    cases = rows.where(F.size("words") > 0).select("doc_id", F.explode("words").alias("word"))
    wanted = cases.select("word").distinct()
    # the corpus vocabulary, as far as asked for: a mixed token stays one and is no word asked for
    cut = base.where(F.col("text").rlike("[A-Za-z\u0370-\u03ff\u0400-\u052f]")).select(F.explode(F.split(F.lower("text"), "[^a-z\u00e0-\u024f\u0370-\u03ff\u0400-\u052f]+")).alias("word"))
    real = cut.join(F.broadcast(wanted) if wanted.limit(BOUND + 1).count() <= BOUND else wanted, "word", "left_semi").distinct()
    known = cases.join(real, "word").groupBy("doc_id").agg(F.collect_set("word").alias("known"))

    @F.pandas_udf("string")
    def mend(t: pd.Series, k: pd.Series) -> pd.Series:
        return pd.Series([repair(x, set(y)) for x, y in zip(t, k, strict=True)])

    fixed = rows.where(F.size("words") > 0).join(known, "doc_id").select("doc_id", "own", mend("form", "known").alias("form"))
    return rows.join(known, "doc_id", "left_anti").select("doc_id", "own", "form").unionByName(fixed)


def one_form(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, own, form): hash and consistent form of each text of df. Null texts stay null; ids must be unique."""
    base = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    same = base.where(~F.coalesce(odd(F.col("text")), F.lit(False)))
    return same.select("doc_id", F.xxhash64("text").alias("own"), F.col("text").alias("form")).unionByName(mended(base))


def p4_pairs(forms: DataFrame) -> DataFrame:
    """Pairs of ids, smaller first, of one form and different text. Forms without a letter are no cases. Classes of equal
    texts are paired first, their copies after that, those of a class with many split over tasks."""
    some = forms.where(F.col("form").rlike("[a-zA-Z\\p{L}]")).select("doc_id", F.sha2(F.encode("form", "UTF-8"), 256).alias("look"), "own")
    some = written(some, "forms")
    several = some.groupBy("look").agg(F.min("own").alias("x"), F.max("own").alias("y")).where("x <> y").select("look")
    rows = some.join(several, "look", "left_semi").select(F.col("doc_id").alias("id"), F.xxhash64("look", "own").alias("key"), "look")
    rows = written(rows, "same_look")
    classes = rows.select("look", "key").distinct()
    a, b = classes.alias("a"), classes.alias("b")
    pairs = a.join(b, F.col("a.look") == F.col("b.look")).where("a.key < b.key").select(F.col("a.key").alias("key"), F.col("b.key").alias("other"))
    members = rows.select("key", "id")
    left = split_join(pairs.withColumn("id", F.col("other")), members, "key").select(F.col("x.other").alias("key"), F.col("y.id").alias("id"))
    both = split_join(left, members, "key")
    return both.select(F.least("x.id", "y.id").alias("doc_id_a"), F.greatest("x.id", "y.id").alias("doc_id_b"))


def p4_found(spark, sf_dir: str) -> DataFrame:
    return p4_pairs(one_form(table(spark, sf_dir, "documents"), "doc_id", "text"))


def p4_form(spark, sf_dir: str) -> DataFrame:
    """Every document in its one form, and whether that differs from the text; null texts stay null."""
    return one_form(table(spark, sf_dir, "documents"), "doc_id", "text").select("doc_id", "form", (F.xxhash64("form") != F.col("own")).alias("changed"))
