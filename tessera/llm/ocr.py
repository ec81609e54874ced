"""Problem 2: noise in text from scanned pages.

A linear-chain conditional random field labels the lines of a page as header, page number, heading, figure, body, body that
breaks inside a word, or blank, from layout features: place on the page, neighbours, ends, the page's own number, and on
how many pages of the document the line recurs at an edge. It is trained on pages set by fixed rules from the language
samples. Misread words are told by shapes no word has (signs or digits among letters), by a vocabulary counted over all
pages in which characters often taken for each other are folded together, and, for words it lacks, by letter trigrams."""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.crf import Crf, feature, fit
from tessera.llm.runtime import table, written
from tessera.llm.textkit import sentences

LINES = ["body", "break", "header", "number", "heading", "figure", "blank"]
SIZE = 1 << 12
HYPHENS = "-‐‑–¬­⁃"
TRIGRAM_BUCKETS = 1 << 22  # letter triples are counted by hash, so the table has a fixed size however many there are
LIKELIER = {"latin": 5.0}  # nats by which a corrected spelling must be likelier than an unknown one
LIKELIER_ELSE = 6.5
EDGE = 2
# What recognition takes for what, wrong to right.
SINGLE = {
    "latin": {"0": "o", "1": "l", "|": "l", "5": "s", "9": "g", "8": "b", "c": "e", "f": "t", "@": "a"},
    "bengali": {"f": "ি", "l": "া", "c": "ে", "3": "ত", "ফ": "ক", "ল": "ন", "র": "ব", "য": "ম", "ড": "ঙ", "খ": "থ", "|": "া"},
    "meitei": {"°": "ꯤ", "l": "ꯥ", "ꯀ": "ꯒ", "ꯌ": "ꯔ", "9": "ꯑ", "7": "ꯀ", "ꯄ": "ꯃ", "ꯁ": "ꯅ", "ꯝ": "ꯟ", "ꯈ": "ꯂ"},
    "devanagari": {"l": "ा", "|": "ा", "व": "ब", "भ": "म", "घ": "ध", "प": "ष"},
}
SEVERAL = {"bengali": {"ম": "স"}}  # a second right character for one sign
DOUBLE = {"vv": "w", "rn": "m", "ri": "n", "ii": "u", "cl": "d", "li": "h"}
_WORD = re.compile(r"[^\s.,;:?!।꯫॥\"“”'’()\[\]<>/]+")
_DIGITS = re.compile(r"\d")
_LETTER = re.compile(r"[^\W\d_]")
_PAGE = re.compile(r"^[\s\-–—~=\[\](){}|.·•*_]*(?:page|pg|p|পৃষ্ঠা|পৃ|पृष्ठ|ꯂꯥꯃꯥꯏ)?[\s.:\-–—\[\](){}|]*([\d\s]{1,9}|[ivxlIVXL]{1,6})[\s\-–—~=\[\](){}|.·•*_]*$", re.I)


def script(word: str) -> str:
    for c in word:
        o = ord(c)
        if 0x980 <= o < 0xA00:
            return "bengali"
        if 0xAAE0 <= o < 0xAC00:
            return "meitei"
        if 0x900 <= o < 0x980:
            return "devanagari"
    return "latin"


_TABLES = {s: str.maketrans({**m, **({"স": "ম", "য": "ম"} if s == "bengali" else {}), **({"7": "ꯒ"} if s == "meitei" else {})}) for s, m in SINGLE.items()}


def folded(word: str) -> str:
    """A word with characters taken for each other made equal."""
    s = script(word)
    if s == "latin":
        for a, b in DOUBLE.items():
            word = word.replace(a, b)
    return word.translate(_TABLES[s])


def tokens(line: str) -> list[str]:
    return [w for x in _WORD.findall(line) if (w := unicodedata.normalize("NFC", x.strip(HYPHENS + "_*~")).lower()) and _LETTER.search(w)]


def odd_shape(word: str) -> bool:
    """Signs or digits among letters, or letters of another script in one word."""
    s = script(word)
    if s == "latin":
        return bool(re.search(r"[a-zà-ɏ][01589@|°]|[01589@|°][a-zà-ɏ]", word)) and not re.fullmatch(r"\d+(?:st|nd|rd|th|s|[a-z])", word)
    return bool(re.search(r"[a-z\d@|°]", word)) and not re.search(r"[a-z]{3}", word)


def variants(word: str) -> Iterator[str]:
    s = script(word)
    for i, c in enumerate(word):
        for right in (SINGLE[s].get(c), SEVERAL.get(s, {}).get(c)):
            if right:
                yield word[:i] + right + word[i + 1 :]
        if s == "latin" and (d := DOUBLE.get(word[i : i + 2])):
            yield word[:i] + d + word[i + 2 :]


def grams(word: str) -> list[str]:
    w = f"^{word}$"
    return [w[i : i + 3] for i in range(len(w) - 2)]


def bucket(gram: str) -> int:
    return zlib.crc32(gram.encode("utf-8", "surrogatepass")) % TRIGRAM_BUCKETS


class Letters:
    """Trigram likelihood of a word given its script's words: counts by bucket of the triples and of their first two."""

    def __init__(self, counts: dict[int, int]):
        self.counts = counts
        self.seen: dict[str, float] = {}

    def one(self, g: str) -> float:
        got = self.seen.get(g)
        if got is None:
            if len(self.seen) > 500_000:
                self.seen.clear()
            got = self.seen[g] = math.log((self.counts.get(bucket(g), 0) + 0.05) / (self.counts.get(bucket(g[:2]), 0) + 2.0))
        return got

    def score(self, word: str) -> float:
        return sum(map(self.one, grams(word)))

    def better(self, word: str) -> str | None:
        if len(word) < 4:
            return None
        own = self.score(word)
        top = max(((self.score(v), v) for v in variants(word)), default=(-1e9, ""))
        return top[1] if top[0] - own > LIKELIER.get(script(word), LIKELIER_ELSE) else None


def edge_key(line: str) -> str:
    """A running title apart from number, case, punctuation and misread characters; "" if nothing is left."""
    s = unicodedata.normalize("NFC", line).lower()
    s = re.sub(r"(?:^|\s)\W*(?:page|p\.)\s*[\dlioIOsz|]+\W*(?=$|\s|\|)", " ", s)
    s = re.sub(r"^\W*(?:page|p\.)\s*[\d]+|^[\W\d]*[\d][\W\d]*|[\W\d]*[\d][\W]*$", " ", s) if _DIGITS.search(s) else s
    return "".join(folded(w) for w in tokens(s))


def number_of(line: str) -> int | None:
    """The number a line holds and nothing else, decimal in any script or roman."""
    m = _PAGE.match(line)
    if not m:
        return None
    d = "".join(m[1].split())
    if d.isdigit():
        return int("".join(str(unicodedata.digit(c)) for c in d))
    values = {"i": 1, "v": 5, "x": 10, "l": 50}
    n = [values[c] for c in d.lower()]
    return sum(-a if k + 1 < len(n) and a < n[k + 1] else a for k, a in enumerate(n))


def edges(lines: list[str]) -> list[int]:
    """Numbers of the lines at the page's edge that hold more than a number: two at the top, two at the bottom."""
    full = [i for i, x in enumerate(lines) if x.strip()]
    some = [i for i in full if number_of(lines[i]) is None]
    return sorted({i for i in some if i in full[: EDGE + 1] and i in some[:EDGE]} | {i for i in some if i in full[-EDGE - 1 :] and i in some[-EDGE:]})


def ends_inside(line: str) -> bool:
    s = line.rstrip()
    return len(s) > 1 and s[-1] in HYPHENS and (bool(_LETTER.match(s[-2])) or unicodedata.category(s[-2])[0] == "M")


def line_features(lines: list[str], page_no: int | None, recurs: dict[str, int]) -> list[list[int]]:
    full = [i for i, x in enumerate(lines) if x.strip()]
    rank = {i: k for k, i in enumerate(full)}
    longest = max((len(lines[i].strip()) for i in full), default=1)
    at_edge = set(edges(lines))
    out = []
    for i, raw in enumerate(lines):
        s = raw.strip()
        if not s:
            out.append([feature("blank", SIZE)])
            continue
        top, bottom = min(3, rank[i]), min(3, len(full) - 1 - rank[i])
        rep = min(3, recurs.get(edge_key(raw), 1)) if i in at_edge else 0
        own = number_of(raw)
        digits = re.findall(r"\d+", s)
        near = {int(d) for d in digits if len(d) < 7}
        number = "same" if own is not None and own == page_no else "other" if own is not None else "has" if page_no is not None and digits and (int(digits[0]) == page_no if len(digits[0]) < 7 else False) and rank[i] < 3 and re.match(r"^\W*(?:page|p)?\W*\d+\b", s, re.I) else "tail" if page_no in near and re.search(r"\d+\W*$", s) else "none"
        ws = s.split()
        end = "stop" if s[-1] in ".।꯫?!|" else "hyphen" if ends_inside(raw) else "comma" if s[-1] in ",;:" else "word"
        cased = [w for w in ws if w[0].isascii() and w[0].isalpha()]
        case = "none" if not cased else "upper" if all(w.isupper() for w in cased) else "title" if all(w[0].isupper() for w in cased) and len(cased) > 1 else "lower" if cased[0][0].islower() else "mixed"
        short = min(4, int(5 * len(s) / longest))
        pb, nb = i == 0 or not lines[i - 1].strip(), i + 1 == len(lines) or not lines[i + 1].strip()
        bits = ["b", f"top={top}", f"bot={bottom}", f"rep={rep}", f"num={number}", f"end={end}", f"case={case}", f"short={short}", f"pb={pb}", f"nb={nb}", f"rep={rep},end={end}", f"rep={rep},num={number}", f"num={number},top={top},bot={bottom}", f"rep={rep},top={top},bot={bottom}", f"case={case},pb={pb},nb={nb}", f"short={short},end={end}", f"rep={rep},short={short}", f"pb={pb},nb={nb},end={end},short={short}"]
        out.append([feature(x, SIZE) for x in bits])
    return out


def training(samples: list[str], pages: int = 500, seed: int = 5) -> list[tuple[list[list[int]], list[int]]]:
    """Pages set from sentences of the samples by a fixed stream of choices."""
    rng = np.random.default_rng(seed)
    pool = [x for t in samples for a, b in sentences(t) if len(x := t[a:b].strip()) > 20]
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    out = []
    for p in range(pages):
        no = int(rng.integers(2, 300))
        title = " ".join(pick(pool).rstrip(".।꯫?!").split()[: int(rng.integers(2, 7))])
        title = title.upper() if p % 5 == 0 else title.title() if p % 5 in (1, 2) else title
        width = int(rng.integers(40, 75))
        rows: list[tuple[str, str]] = []
        for _ in range(int(rng.integers(1, 5))):
            if rng.random() < 0.15:
                h = " ".join(pick(pool).rstrip(".।꯫?!").split()[: int(rng.integers(2, 6))])
                rows += [(h.upper() if rng.random() < 0.5 else h.title(), "heading")] + ([("", "blank")] if rng.random() < 0.4 else [])
            line = ""
            for w in " ".join(pick(pool) for _ in range(int(rng.integers(1, 6)))).split():
                if len(line) + len(w) + 1 <= width:
                    line = f"{line} {w}".strip()
                elif len(w) > 5 and rng.random() < 0.4:
                    k = int(rng.integers(2, len(w) - 2))
                    rows.append((f"{line} {w[:k]}{pick(HYPHENS)}".strip(), "break"))
                    line = w[k:]
                else:
                    rows.append((line, "body"))
                    line = w
                if rng.random() < 0.006:
                    rows += [(line, "body")] + [(str(int(rng.integers(100, 9999))), "figure") for _ in range(int(rng.integers(1, 4)))]
                    line = ""
            if line:
                rows.append((line, "body"))
            if rng.random() < 0.7:
                rows.append(("", "blank"))
        last = max((i for i, (_, k) in enumerate(rows) if k == "body"), default=None)
        if p % 3 == 0 and last is not None and len(w := (cut := rows[last][0].rstrip(".।꯫?! ")).rpartition(" ")[2]) > 3:
            rows[last] = (cut[: len(cut) - len(w) + int(rng.integers(2, len(w) - 1))] + pick(HYPHENS), "break")  # goes on overleaf
            del rows[last + 1 :]
        style = int(rng.integers(8))
        number = (f"{no}", f"[{no}]", f"- {no} -", f"Page {no}", f"p. {no}", f"{no}.", " ".join(str(no)), f"({no})")[int(rng.integers(8))]
        gap = [("", "blank")] if rng.random() < 0.4 else []
        if style == 0:
            rows = [(title, "header"), *gap, *rows, (number, "number")]
        elif style == 1:
            rows = [(number, "number"), (title, "header"), *gap, *rows]
        elif style == 2:
            rows = [(f"{number} | {title}", "header"), *gap, *rows]
        elif style == 3:
            rows = [(f"{title}    {no}", "header"), *gap, *rows]
        elif style == 4:
            rows = [(f"{no}  {title}", "header"), *gap, *rows]
        elif style == 5:
            rows = [*rows, *gap, (title, "header"), (number, "number")]
        elif style == 6:
            rows = [*rows, *gap, (number, "number")]
        lines = [x for x, _ in rows]
        times = int(rng.integers(2, 12)) if rng.random() < 0.93 else 1
        out.append((line_features(lines, no, {edge_key(x): times for x, k in rows if k == "header"}), [LINES.index(k) for _, k in rows]))
    return out


def trained(samples: list[str]) -> Crf:
    return fit(training(samples), LINES, SIZE, rounds=60, rate=0.2, decay=1e-3)


def clues(pages: DataFrame, samples: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(recurring, bad, trigrams): edge lines on more than one page of a document (page_id, edge, pages); words taken for a
    misreading (page_id, word, right); letter triples of the known words and their beginnings, by bucket (gram, n)."""
    kind = pages.schema["page_id"].dataType.simpleString()

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for d, p, no, t in zip(pdf["page_id"], pdf["document_id"], pdf["page_no"], pdf["text"], strict=True):
                lines = (t or "").split("\n")
                rows += [(d, p, no, "e", k, "") for k in {edge_key(lines[i]) for i in edges(lines)} if k]
                inside, cut = set(), ""
                for x in lines:
                    ws = tokens(x)
                    if cut and ws:
                        inside.add(cut + ws[0])
                        ws, cut = ws[1:], ""
                    if ends_inside(x) and ws:
                        cut, ws = ws[-1], ws[:-1]
                    inside.update(ws)
                rows += [(d, p, no, "w", folded(w), w) for w in inside]
            yield pd.DataFrame(rows, columns=["page_id", "document_id", "page_no", "what", "fold", "word"])

    base = pages.select("page_id", "document_id", "page_no", "text")
    read_out = written(base.mapInPandas(read, f"page_id {kind}, document_id string, page_no int, what string, fold string, word string"), "page_words")
    edge = read_out.where("what = 'e' and document_id is not null")
    often = edge.where("page_no is not null").select("document_id", "fold", "page_no").distinct().groupBy("document_id", "fold").agg(F.count("*").alias("pages"))
    recurring = edge.select("page_id", "document_id", "fold").distinct().join(often.where("pages > 1"), ["document_id", "fold"]).select("page_id", F.col("fold").alias("edge"), F.col("pages").cast("int").alias("pages"))

    def known(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ws = [w for t in pdf["text"] if t for w in tokens(t)]
            yield pd.DataFrame({"fold": [folded(w) for w in ws], "word": ws, "n": np.full(len(ws), 5, dtype="int64")})

    words = read_out.where("what = 'w'")
    once = pages.groupBy(F.sha2("text", 256)).agg(F.min("page_id").alias("page_id")).select("page_id")  # a page given again counts once
    counted = words.join(once, "page_id", "left_semi").select("page_id", "fold", "word").distinct()
    counted = counted.groupBy("fold", "word").agg(F.count("*").alias("n")).unionByName(samples.select("text").mapInPandas(known, "fold string, word string, n long")).groupBy("fold", "word").agg(F.sum("n").alias("n"))
    counted = written(counted, "words_counted")
    best = counted.where("n > 1").groupBy("fold").agg(F.max(F.struct("n", "word")).alias("top"))
    wrong = counted.join(best, "fold").where("word <> top.word and n * 4 <= top.n").select("word", F.col("top.word").alias("right"))
    bad = words.select("page_id", "word").join(wrong, "word").select("page_id", "word", "right")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            c = Counter(g for w in pdf["word"] if not odd_shape(w) for g in grams(w))
            c.update(Counter(x[:2] for x in c.elements()))
            yield pd.DataFrame({"gram": [bucket(g) for g in c], "n": list(c.values())})

    trigrams = counted.where("n > 1").select("word").mapInPandas(cut, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    told = counted.where("n > 1").select("word").unionAll(wrong.select("word")).distinct()
    unknown = words.select("page_id", "word").join(told, "word", "left_anti")
    return recurring, bad.unionByName(unknown.select("page_id", "word", F.lit(None).cast("string").alias("right"))), trigrams


def labelled(pages: DataFrame, samples: DataFrame) -> DataFrame:
    """(page_id, line_no, line, state, kinds, repaired) of every line of pages (page_id, document_id, page_no, text). Null
    texts have no lines."""
    recurring, bad, trigrams = clues(pages, samples)
    texts = [r[0] for r in samples.where("text is not null").orderBy("sample_id").limit(2000).select("text").collect()]
    rows = trigrams.toPandas()  # no more than there are buckets
    counts = dict(zip(rows["gram"].tolist(), rows["n"].tolist(), strict=True))
    held = pages.sparkSession.sparkContext.broadcast((trained(texts), counts))
    edge = recurring.groupBy("page_id").agg(F.map_from_entries(F.collect_list(F.struct("edge", "pages"))).alias("edges"))
    words = bad.groupBy("page_id").agg(F.map_from_entries(F.collect_set(F.struct("word", F.coalesce("right", F.lit("")).alias("right")))).alias("words"))
    full = pages.where("text is not null").select("page_id", "page_no", "text").join(edge, "page_id", "left").join(words, "page_id", "left")
    kind = pages.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        crf, counts = held.value
        letters = Letters(counts)
        seen: dict[str, str | None] = {}
        for pdf in batches:
            lines = [t.split("\n") for t in pdf["text"]]
            feats = [line_features(x, None if pd.isna(no) else int(no), dict(e or {})) for x, no, e in zip(lines, pdf["page_no"], pdf["edges"], strict=True)]
            states = crf.decode([f for x in feats for f in x], np.array([len(x) for x in feats]))
            at, rows = 0, []
            for pid, no, own, ws in zip(pdf["page_id"], pdf["page_no"], lines, pdf["words"], strict=True):
                tags = [LINES[k] for k in states[at : at + len(own)]]
                at += len(own)
                rows += page_rows(pid, None if pd.isna(no) else int(no), own, tags, dict(ws or {}), letters, seen)
            yield pd.DataFrame(rows, columns=["page_id", "line_no", "line", "state", "kinds", "repaired"])

    return full.mapInPandas(run, f"page_id {kind}, line_no int, line string, state string, kinds array<string>, repaired string")


def right_form(word: str, listed: dict[str, str], letters: Letters, seen: dict[str, str | None]) -> str | None:
    """What a word was before it was misread; the word itself if that's unknown but its shape is odd; None if it's right."""
    if listed.get(word):
        return listed[word]
    if odd_shape(word):
        return letters.better(word) or word
    if word in listed:
        if word not in seen:
            if len(seen) > 500_000:
                seen.clear()
            seen[word] = letters.better(word)
        return seen[word]
    return None


def page_rows(pid: object, page_no: int | None, lines: list[str], tags: list[str], listed: dict[str, str], letters: Letters, seen: dict) -> list[tuple]:
    rows = []
    running = [i for i, t in enumerate(tags) if t in ("body", "break")]
    joined: dict[int, str] = {}  # line to the word it ends or begins with another line's part of
    for a, b in zip(running, running[1:], strict=False):
        x, y = tokens(lines[a]), tokens(lines[b])
        if ends_inside(lines[a]) and x and y:
            whole = x[-1] + y[0]
            got = right_form(whole, listed, letters, seen)
            if got:
                joined[a if not got.startswith(x[-1]) or odd_shape(x[-1]) else b] = whole
    for i, (line, tag) in enumerate(zip(lines, tags, strict=True)):
        kinds, fixed = [], line
        if tag == "header":
            kinds.append("header")
        elif tag == "number" and (page_no is None or number_of(line) == page_no):
            kinds.append("page_number")
        elif tag in ("body", "break"):
            if tag == "break" and ends_inside(line):
                kinds.append("hyphen")
            ws = tokens(line)
            skip = {0} if i in running and running.index(i) and ends_inside(lines[running[running.index(i) - 1]]) else set()
            skip |= {0} if running[:1] == [i] else set()  # may go on from the page before
            skip |= {len(ws) - 1} if ends_inside(line) else set()
            changes = {}
            for k, w in enumerate(ws):
                if odd_shape(w) or k not in skip:
                    got = right_form(w, listed, letters, seen)
                    if got:
                        changes[w] = got
            sign = bool(re.search(r"[A-Za-z][!|][a-z]|[ঀ-৿ऀ-ॣꯀ-꯭]\s?\|(?:\s|$)", line))
            if changes or sign or i in joined:
                kinds.append("misread")
            if changes:
                fixed = _WORD.sub(lambda m: m[0] if (g := changes.get(unicodedata.normalize("NFC", m[0].strip(HYPHENS + "_*~")).lower())) is None or g == m[0].lower() else m[0].replace(m[0].strip(HYPHENS + "_*~"), g.capitalize() if m[0][:1].isupper() else g), line)  # noqa: B023
            if sign:
                fixed = re.sub(r"(?<=[ঀ-৿ऀ-ॣ])(\s?)\|(?=\s|$)", r"\1।", re.sub(r"(?<=[ꯀ-꯭])(\s?)\|(?=\s|$)", r"\1꯫", fixed))
        rows.append((pid, i, line, tag, kinds, fixed))
    return rows


def p2_found(spark, sf_dir: str) -> DataFrame:
    got = labelled(table(spark, sf_dir, "ocr_pages"), table(spark, sf_dir, "lang_samples"))
    return got.select("page_id", "line_no", F.explode("kinds").alias("kind"))


BLOCK = 512  # pages of one document whose paragraphs are numbered in one task


def paragraphs(pages: DataFrame, samples: DataFrame) -> DataFrame:
    """(document_id, page_no, paragraph, text): continuous paragraphs, one page's last going on in the next page's first.
    Of a page given twice the least page_id counts. A paragraph stands under the page it begins on. A page without
    document_id or page_no is a document of its own."""
    lone = F.col("document_id").isNull() | F.col("page_no").isNull()
    named = pages.withColumn("own", F.when(lone, F.concat(F.lit("?"), F.col("page_id").cast("string"))).otherwise(F.concat(F.lit("="), "document_id")))
    named = named.withColumn("no", F.coalesce("page_no", F.lit(0)))
    once = named.join(named.groupBy("own", "no").agg(F.min("page_id").alias("page_id")).select("page_id"), "page_id", "left_semi")
    lines = labelled(once, samples)
    body = lines.where(F.col("state").isin("body", "break", "blank", "heading")).groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("line_no", "state", "repaired"))).alias("lines"))

    @F.pandas_udf("array<string>")
    def joined(rows: pd.Series) -> pd.Series:
        def one(page: list) -> list[str]:
            out, now, inside = [], "", False
            for r in page:
                s = r["repaired"].strip()
                if r["state"] in ("blank", "heading") and now and not inside:
                    out, now = [*out, now], ""
                if r["state"] == "heading":
                    out.append(s)
                elif s:
                    now = now[:-1] + s if now and inside and now[-1] in HYPHENS else f"{now} {s}".strip()
                    inside = r["state"] == "break"
            return [*out, now] if now else out

        return rows.map(one)

    texts = once.select("page_id", "own", "document_id", "page_no", "no").join(body.select("page_id", joined("lines").alias("paragraphs")), "page_id")
    texts = written(texts, "page_paragraphs")
    flat = texts.select("own", "document_id", "page_no", "no", F.posexplode("paragraphs").alias("k", "text"))
    # whether a page's last paragraph goes on: told to the next page by a join, whichever block that is in
    last = F.element_at("paragraphs", -1)
    goes_on = texts.where(F.size("paragraphs") > 0).where(~last.rlike("[.।꯫?!|:]\\W*$")).select("own", (F.col("no") + 1).alias("no"), F.lit(0).alias("k"), F.lit(0).alias("starts"))
    marked = flat.join(goes_on, ["own", "no", "k"], "left").withColumn("starts", F.coalesce("starts", F.lit(1))).withColumn("part", F.floor(F.col("no") / BLOCK))
    # numbers of paragraphs: counted by block, then summed over the blocks before
    blocks = marked.groupBy("own", "part").agg(F.sum("starts").alias("many"))
    before = F.coalesce(F.sum("many").over(Window.partitionBy("own").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = F.sum("starts").over(Window.partitionBy("own", "part").orderBy("no", "k"))
    numbered = marked.withColumn("in", inside).join(blocks.select("own", "part", before.alias("before")), ["own", "part"]).withColumn("g", F.col("before") + F.col("in"))
    whole = numbered.groupBy("own", "g").agg(F.min("document_id").alias("document_id"), F.min("page_no").alias("page_no"), F.array_sort(F.collect_list(F.struct("no", "k", "text"))).alias("parts"))
    text = F.regexp_replace(F.array_join(F.transform("parts", lambda p: p["text"]), " "), f"(?<=\\p{{L}}|\\p{{M}})[{HYPHENS}] (?=\\p{{L}})", "")
    return whole.select("document_id", "page_no", F.col("g").cast("int").alias("paragraph"), text.alias("text"))


def p2_paragraphs(spark, sf_dir: str) -> DataFrame:
    return paragraphs(table(spark, sf_dir, "ocr_pages"), table(spark, sf_dir, "lang_samples"))
