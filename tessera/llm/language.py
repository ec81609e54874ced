"""Problem 3: missing or wrong language labels, and mixed-language documents.

Scripts narrow the candidate languages of a word; letter trigrams of the labelled samples score it among them; a Viterbi
path over all words of a document, with a penalty for each switch, labels spans. Borrowed words cost less than two
switches, so they stay in their span. A sentence has the language of most of its words on the path."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.runtime import table
from tessera.llm.textkit import FOLD, LANGUAGES, MARKUP, SCRIPT_OF_LANGUAGE, script_of, sentences

BORROWED = -4.0  # a word in a script its language isn't written in
FLOOR = -3.0
SWITCH = 6.0
MIN_WORDS = 3  # of a sentence that counts as evidence for the document's main language
MIN_OTHER, SURE = 5, 0.9  # words and confidence of a sentence that counts as evidence for another
SAMPLES = 20_000  # labelled texts the model is fitted on at most
MAX_CACHE = 500_000
MAIL = re.compile(r"\S+@\S+")
# Codes and names of the four languages, lower case, without region or script.
NAMES = {
    "mni": "mni", "manipuri": "mni", "meiteilon": "mni", "meitei": "mni", "meetei": "mni", "mei": "mni",
    "bn": "bn", "ben": "bn", "bengali": "bn", "bangla": "bn",
    "en": "en", "eng": "en", "english": "en",
    "hi": "hi", "hin": "hi", "hindi": "hi",
}


def named(label: str | None) -> str | None:
    """The language a label names: one of the four, "other", or None if it names none."""
    base = re.split(r"[-_ (/]", (label or "").strip().lower().strip("?.-"))[0]
    if base in NAMES:
        return NAMES[base]
    return None if base in ("", "und", "unknown", "n", "na", "none", "null", "mul", "mixed", "zxx", "xx") or not base.isalpha() else "other"


class Model:
    """Trigram counts by language and script, and a cache of word scores."""

    def __init__(self, samples: list[tuple[str, str]]):
        self.grams: dict[tuple[str, str], dict[str, float]] = {}
        counts: dict[tuple[str, str], Counter] = {}
        for text, language in samples:
            for w in text.translate(FOLD).split():
                s = self.script(w)
                if s and s in SCRIPT_OF_LANGUAGE.get(language, ()):
                    counts.setdefault((language, s), Counter()).update(self.parts(w))
        for key, c in counts.items():
            total, kinds = sum(c.values()), len({g for (_, s), x in counts.items() if s == key[1] for g in x})
            self.grams[key] = {g: math.log((n + 0.3) / (total + 0.3 * kinds)) for g, n in c.items()} | {"": math.log(0.3 / (total + 0.3 * kinds))}
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.rows: list[list[float]] = []
        self.table = np.zeros((0, len(LANGUAGES)))

    @staticmethod
    def parts(word: str) -> list[str]:
        w = f"^{word}$"
        return [w[i : i + 3] for i in range(len(w) - 2)]

    @staticmethod
    def script(word: str) -> str | None:
        found = Counter(s for s in map(script_of, word) if s)
        return found.most_common(1)[0][0] if found else None

    def score(self, word: str) -> list[float]:
        script = self.script(word)
        if script is None:
            return [0.0] * len(LANGUAGES)
        own = {x: sum(g.get(p, g[""]) for p in self.parts(word)) for x in LANGUAGES if (g := self.grams.get((x, script)))}
        if not own:
            return [0.0 if script in SCRIPT_OF_LANGUAGE[x] else BORROWED for x in LANGUAGES]
        top = max(own.values())
        norm = top + math.log(sum(math.exp(v - top) for v in own.values()))
        return [max(FLOOR, own[x] - norm) if x in own else BORROWED for x in LANGUAGES]

    def numbers(self, ws: list[str]) -> list[int]:
        n, out = self.number, []
        for w in ws:
            k = n.get(w)
            if k is None:
                k = n[w] = len(self.rows)
                self.rows.append(self.score(w))
            out.append(k)
        return out

    def scores(self) -> np.ndarray:
        if len(self.table) < len(self.rows):
            self.table = np.concatenate([self.table, np.array(self.rows[len(self.table) :])])
        return self.table


def paths(emit: np.ndarray, length: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Viterbi state of every word; documents lie one after another in emit. All documents of a step advance together."""
    out = np.zeros(len(emit), np.int8)
    order = np.argsort(-length, kind="stable")
    first = np.concatenate([[0], np.cumsum(length)])[:-1][order]
    size = length[order]
    most = int(size[0]) if len(size) else 0
    live = np.searchsorted(-size, -np.arange(1, most + 1), side="right")
    back = np.zeros((len(emit), emit.shape[1]), np.int8)
    v = np.zeros((len(size), emit.shape[1]))
    own = np.arange(emit.shape[1], dtype=np.int8)
    for t in range(most):
        k = live[t]
        at = first[:k] + t
        if t:
            best = v[:k].argmax(axis=1)
            jump = v[np.arange(k), best][:, None] - switch
            stay = v[:k] >= jump
            back[at] = np.where(stay, own[None, :], best[:, None])
            v[:k] = np.where(stay, v[:k], jump) + emit[at]
        else:
            v[:k] = emit[at]
    state = v.argmax(axis=1)
    for t in range(most - 1, -1, -1):
        k = live[t]
        at = first[:k] + t
        out[at] = state[:k]
        if t:
            state[:k] = back[at, state[:k]]
    return out


def labelled(texts: list[str | None], model: Model) -> list[list[tuple[int, int, int, float, int]]]:
    """For each text its sentences with a word: (start, end, language number, confidence, words), after markup and mail
    addresses are blanked out, which keeps the offsets."""
    blank = lambda m: " " * len(m[0])
    spans, ids, length = [], [], []
    if len(model.rows) > MAX_CACHE:
        model.clear()
    for t in texts:
        own, n = [], 0
        if t:
            if "<" in t or "&" in t or "://" in t or "www." in t or "](" in t:
                t = MARKUP.sub(blank, t)
            if "@" in t:
                t = MAIL.sub(blank, t)
            for a, b in sentences(t):
                ws = t[a:b].translate(FOLD).split()
                if ws:
                    k = model.numbers(ws)
                    ids.extend(k)
                    own.append((a, b, n, n + len(k)))
                    n += len(k)
        spans.append(own)
        length.append(n)
    if not ids:
        return [[] for _ in texts]
    emit = model.scores()[np.array(ids)]
    state = paths(emit, np.array(length))
    size = np.array(length)
    starts = np.cumsum(size) - size
    cuts = np.array([k + i for own, k in zip(spans, starts, strict=True) for _, _, i, _ in own])
    count = np.add.reduceat(state[:, None] == np.arange(len(LANGUAGES)), cuts, axis=0, dtype=int)
    total = np.add.reduceat(emit, cuts, axis=0)
    known = np.add.reduceat((emit != 0).any(axis=1), cuts, dtype=int)
    which = count.argmax(axis=1)
    p = np.exp((total - total.max(axis=1, keepdims=True)) / np.sqrt(np.maximum(known, 1))[:, None])
    sure = p[np.arange(len(cuts)), which] / p.sum(axis=1)
    flat = list(zip(which.tolist(), sure.tolist(), known.tolist(), strict=True))
    at, out = 0, []
    for own in spans:
        out.append([(a, b, *flat[at + i]) for i, (a, b, _, _) in enumerate(own)])
        at += len(own)
    return out


def held_languages(own: list[tuple[int, int, int, float, int]]) -> dict[int, float]:
    """Languages with a whole sentence and their confidence; none for a text without a sentence."""
    words = Counter()
    for _, _, x, _, n in own:
        words[x] += n
    held: dict[int, float] = {}
    main = words.most_common(1)[0][0] if words else -1
    for _, _, x, p, n in own:
        if n >= MIN_WORDS if x == main else n >= MIN_OTHER and p >= SURE:
            held[x] = max(p, held.get(x, 0.0))
    return held


def fitted(samples: DataFrame) -> Model:
    """Of at most SAMPLES labelled texts, those of the least ids; the same for all inputs."""
    rows = samples.where("text is not null and language is not null").orderBy("sample_id").limit(SAMPLES).select("text", "language").collect()
    return Model([(r[0], named(r[1]) or "") for r in rows])


def segments(docs: DataFrame, doc_id: str, text: str, samples: DataFrame) -> DataFrame:
    """(doc_id, segment, start, end, language, confidence, words): runs of sentences of one language, offsets in code
    points. Null texts and texts without a letter have no rows."""
    model = docs.sparkSession.sparkContext.broadcast(fitted(samples))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for d, own in zip(pdf["doc_id"], labelled(pdf["text"].tolist(), model.value), strict=True):
                merged: list[list] = []
                for a, b, x, p, n in own:
                    if not n:
                        continue
                    if merged and merged[-1][2] == x:
                        last = merged[-1]
                        last[1], last[3], last[4] = b, (last[3] * last[4] + p * n) / (last[4] + n), last[4] + n
                    else:
                        merged.append([a, b, x, p, n])
                rows += [(d, i, a, b, LANGUAGES[x], round(p, 4), n) for i, (a, b, x, p, n) in enumerate(merged)]
            yield pd.DataFrame(rows, columns=["doc_id", "segment", "start", "end", "language", "confidence", "words"])

    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return base.mapInPandas(run, f"doc_id {base.schema['doc_id'].dataType.simpleString()}, segment int, start int, end int, language string, confidence double, words int")


def defects(docs: DataFrame, samples: DataFrame) -> DataFrame:
    """(doc_id, language, confidence) of documents (doc_id, text, language) whose label names no language or another one
    than the text's, or that hold whole sentences in several: a row for each language with a whole sentence."""
    model = docs.sparkSession.sparkContext.broadcast(fitted(samples))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for d, label, own in zip(pdf["doc_id"], pdf["label"], labelled(pdf["text"].tolist(), model.value), strict=True):
                held = held_languages(own)
                if held and (len(held) > 1 or named(label) != LANGUAGES[min(held)]):
                    rows += [(d, LANGUAGES[x], round(p, 4)) for x, p in sorted(held.items())]
            yield pd.DataFrame(rows, columns=["doc_id", "language", "confidence"])

    base = docs.select("doc_id", "text", F.col("language").alias("label"))
    return base.mapInPandas(run, f"doc_id {base.schema['doc_id'].dataType.simpleString()}, language string, confidence double")


def p3_found(spark, sf_dir: str) -> DataFrame:
    return defects(table(spark, sf_dir, "documents"), table(spark, sf_dir, "lang_samples")).select("doc_id", "language")


def p3_segments(spark, sf_dir: str) -> DataFrame:
    return segments(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "lang_samples"))
