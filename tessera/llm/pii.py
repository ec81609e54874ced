"""Problem 10: personal information inside free text.

A linear-chain conditional random field over word-shape features tags tokens as parts of e-mail addresses, phone numbers,
identity numbers, street addresses and names. Its labelled table is made here: values of each kind (and things that only look
like them) are put at any place into the sentences of `lang_samples`, so no wording around them is given; names are made of
parts of the given list, half of which the field isn't told, so that context and shape are learnt too. Every token of every
line is scored, in numpy batches; Viterbi leaves out only lines that a bound on its own scores proves to be free of all
kinds. A span is what the field tags, without closing signs and titles; a number of a length its kind can't have is dropped."""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.crf import Crf, fit
from tessera.llm.runtime import table

KINDS = ("email", "phone", "id_number", "address", "name")
TAGS = ["O", *(f"{p}-{k}" for k in KINDS for p in "BI")]
SIZE = 1 << 16
SAMPLES = 2000  # labelled sample texts the field is trained on, at most
MAX_CACHE = 1_000_000
SEEN = 6  # training lines a feature must be in

_TOKEN = re.compile(r"\d+|[^\W\d_]\.(?=\s|$|,)|[^\s\d!-/:-@\[-`{-~।॥꯫“”‘’—–‑•]+|\S")
# Titles, as they stand before names.
TITLES = {
    "latin": ("Mr", "Mrs", "Ms", "Miss", "Dr", "Prof", "Shri", "Smt", "Sri", "Kumari"),
    "bengali": ("শ্রী", "শ্রীমতী", "ডাঃ", "ডঃ", "অধ্যাপক", "ইবেম্মা", "ওঝা"),
    "devanagari": ("श्री", "श्रीमती", "डॉ", "प्रो", "सुश्री"),
    "meitei": ("ꯑꯣꯖꯥ",),
}
# Words that announce a kind in each script's languages.
LABELS = {
    "latin": {
        "name": ("name", "full name", "signature", "author", "said", "maming"), "phone": ("phone", "tel", "mobile", "cell", "fax", "WhatsApp"), "email": ("email", "e-mail", "mail", "mailto"),
        "id_number": ("Aadhaar", "UID", "PAN", "passport", "voter ID", "voter card", "driving licence", "identity card"), "address": ("address", "residence", "home", "leipham"),
    },
    "bengali": {
        "name": ("নাম", "লেখক", "মমিং"), "phone": ("ফোন", "মোবাইল", "টেলিফোন"), "email": ("ইমেল", "ই-মেইল"),
        "id_number": ("আধার", "প্যান", "পেন", "পাসপোর্ট", "ভোটার কার্ড"), "address": ("ঠিকানা", "বাসা", "লৈফম"),
    },
    "devanagari": {
        "name": ("नाम", "लेखक"), "phone": ("फ़ोन", "फोन", "मोबाइल", "दूरभाष"), "email": ("ईमेल", "ई-मेल"),
        "id_number": ("आधार", "पैन", "पासपोर्ट", "मतदाता पत्र"), "address": ("पता", "निवास"),
    },
    "meitei": {
        "name": ("ꯃꯃꯤꯡ",), "phone": ("ꯐꯣꯟ", "ꯃꯣꯕꯥꯏꯜ"), "email": ("ꯏꯃꯦꯜ",),
        "id_number": ("ꯑꯥꯙꯥꯔ", "ꯄꯦꯟ", "ꯄꯥꯁꯄꯣꯔꯠ", "ꯚꯣꯇꯔ ꯀꯥꯔꯗ"), "address": ("ꯂꯩꯐꯝ",),
    },
}
NUMBER = {"latin": ("No.", "number", "no"), "bengali": ("নং", "নম্বর"), "devanagari": ("नं", "सं.", "नंबर"), "meitei": ("ꯅꯪ",)}
COUNTING = {"no", "number", "no.", "নং", "নম্বর", "नं", "सं", "नंबर", "ꯅꯪ"}
# What follows a name in that of a place or institution, and what counts things.
PLACES = {
    "latin": ("Road", "Street", "Library", "School", "College", "Bridge", "Market", "Cup", "Trophy", "Shield", "Hall", "Stadium", "Museum", "Bank", "Society", "Foundation", "Press", "Memorial", "Lake", "River", "Hills", "District", "Hospital", "Club", "Temple", "Ground"),
    "bengali": ("সড়ক", "স্কুল", "কলেজ", "বাজার", "সেতু", "ব্যাঙ্ক", "গ্রন্থাগার", "মেমোরিয়াল", "জেলা", "নদী"),
    "devanagari": ("मार्ग", "विद्यालय", "महाविद्यालय", "बाज़ार", "पुल", "बैंक", "पुस्तकालय", "स्मारक", "ज़िला", "नदी"),
    "meitei": ("ꯂꯝꯕꯤ", "ꯁ꯭ꯀꯨꯜ", "ꯀꯣꯂꯦꯖ", "ꯀꯩꯊꯦꯜ", "ꯊꯣꯡ", "ꯕꯦꯉ꯭ꯛ"),
}
THINGS = {
    "latin": ("order", "batch", "invoice", "receipt", "ISBN", "serial", "catalogue", "archive", "account", "ticket", "lot", "file", "model", "version", "accession", "parcel", "block", "shelf"),
    "bengali": ("অর্ডার", "রসিদ", "ISBN", "নথি", "খণ্ড"),
    "devanagari": ("आदेश", "रसीद", "ISBN", "फ़ाइल", "खंड"),
    "meitei": ("ISBN", "ꯐꯥꯏꯜ"),
}
_GROUP = re.compile(r"[+＋]?[(]?\d(?:[\s().\-–‑/]{0,2}\d)*")
_SOME = re.compile(r"\d\D{0,3}\d\D{0,3}\d")
_MAIL = re.compile(r"[\w.%+\-]+\s?(?:[@＠]|\(\s?at\s?\)|\[\s?at\s?\]|\sat\s)\s?[\w\-]+(?:\s?(?:[.．]|\(\s?dot\s?\)|\[\s?dot\s?\]|\sdot\s)\s?[A-Za-z\w\-]+)+")
_TITLE = re.compile(r"(?:" + "|".join(t for x in TITLES.values() for t in x) + r")\.?\s+")


def shape(w: str) -> str:
    if w[0].isdigit():
        return f"0{min(len(w), 12)}"
    o = ord(w[0])
    if o < 0x250 and w[0].isalpha():
        kind = "X." if len(w) == 2 and w[1] == "." else "X" if len(w) == 1 and w.isupper() else "XX" if w.isupper() else "Xx" if w[0].isupper() else "x"
        return kind + (str(len(w)) if kind == "XX" and len(w) < 7 else "")
    return {0x9: "d" if o < 0x980 else "b", 0xA: "m", 0xAB: "m", 0xAA: "m"}.get(o >> 8, "s") if w[0].isalpha() or o > 0x900 else w


def code(s: str) -> int:
    return zlib.crc32(s.encode("utf-8", "surrogatepass")) + 1


class Tokens(dict):
    """Token to its number, filled in on first sight; by number: codes of its lower case (digits: of their count), of its
    shape, and of the list it is on."""

    def __init__(self, listed: dict[str, str]):
        super().__init__()
        self.listed, self.rows, self.made = listed, [], np.zeros((0, 4), np.uint64)

    def __missing__(self, raw: str) -> int:
        w = unicodedata.normalize("NFKC", raw) or raw
        s = shape(w)
        on = self.listed.get(w) or self.listed.get(w.title() if w.isascii() else w, "")
        speaks = (w[0].isalpha() or ord(w[0]) > 0x900) and w.lower() not in COUNTING
        self.rows.append((code(s if w[0].isdigit() else w.lower()), code(s), {"": 1, "G": 2, "F": 3}[on], speaks))
        k = self[raw] = len(self.rows) - 1
        return k

    def codes(self) -> np.ndarray:
        if len(self.made) < len(self.rows):
            self.made = np.concatenate([self.made, np.array(self.rows[len(self.made) :], np.uint64)])
        return self.made

    def fresh(self) -> None:
        if len(self.rows) > MAX_CACHE:
            self.clear()
            self.rows, self.made = [], np.zeros((0, 4), np.uint64)

    def __reduce__(self):
        return Tokens, (self.listed,)


def features(lines: list[str], tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """(feature numbers of each token, one template a column; tokens of each line)."""
    cut = [_TOKEN.findall(x) for x in lines]
    length = np.array([len(x) for x in cut], np.int64)
    n = int(length.sum())
    ids = np.fromiter(map(tokens.__getitem__, chain.from_iterable(cut)), np.int64, n)
    w, s, l, speaks = (np.ascontiguousarray(c) for c in tokens.codes()[ids].T) if n else (np.zeros(0, np.uint64),) * 4  # noqa: E741
    row = np.repeat(np.arange(len(lines)), length)
    digits, form, mail, first = np.zeros(n, np.uint64), np.zeros(n, np.uint64), np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    start = np.cumsum(length) - length
    for i, line in enumerate(lines):
        numbers, post = _SOME.search(line), "@" in line or "＠" in line or "dot" in line
        if not numbers and not post:
            continue
        spans = [m.span() for m in _TOKEN.finditer(line)]
        k = 0
        for m in _GROUP.finditer(line) if numbers else ():
            count = sum(c.isdigit() for c in m[0])
            if count < 3:
                continue
            look = code("".join("0" if c.isdigit() else "_" if c.isspace() else c for c in m[0]))
            while k < len(spans) and spans[k][0] < m.start():
                k += 1
            at = int(start[i]) + k
            if k < len(spans):
                first[at] = 1
            while k < len(spans) and spans[k][1] <= m.end():
                digits[start[i] + k], form[start[i] + k] = count, look
                k += 1
        for m in _MAIL.finditer(line) if post else ():
            if re.search(r"[@＠\[(]|\sdot\s", m[0]):
                for j, (a, b) in enumerate(spans):
                    if m.start() <= a and b <= m.end():
                        mail[start[i] + j] = 1

    def near(x: np.ndarray, k: int) -> np.ndarray:
        """x of the token k places before (after, if negative), 0 outside the line."""
        out = np.zeros(n, np.uint64)
        if k > 0 and k < n:
            out[k:] = np.where(row[k:] == row[:-k], x[:-k], 0)
        elif k < 0 and -k < n:
            out[:k] = np.where(row[:k] == row[-k:], x[-k:], 0)
        return out

    w1, w2, w3, v1, v2 = near(w, 1), near(w, 2), near(w, 3), near(w, -1), near(w, -2)
    s1, s2, t1, t2 = near(s, 1), near(s, 2), near(s, -1), near(s, -2)
    l1, k1 = near(l, 1), near(l, -1)
    # the word that may announce a token: the nearest of the three before it that isn't a sign or "No."
    told = np.where(near(speaks, 1) > 0, w1, np.where(near(speaks, 2) > 0, w2, np.where(near(speaks, 3) > 0, w3, 0)))
    number = digits > 0
    parts = [(), (s,), (w,), (w1,), (w2,), (w3,), (v1,), (v2,), (s1, s), (s, t1), (s2, s1, s), (s, t1, t2), (l, s), (l1, l), (l, k1), (w1, s), (s, v1), (told,), (told, s), (mail, near(mail, 1)), (digits,), (form,), (form, first), (np.where(first > 0, told, 1), digits)]
    out = np.empty((n, len(parts)), np.int32)
    with np.errstate(over="ignore"):
        for j, own in enumerate(parts):
            x = np.full(n, (j + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF, np.uint64)
            for y in own:
                x = (x ^ y) * np.uint64(0xD6E8FEB86659FD93)
                x ^= x >> np.uint64(32)
            out[:, j] = 1 + (((x >> np.uint64(32)) * np.uint64(SIZE - 1)) >> np.uint64(32)).astype(np.int32)
            if j >= len(parts) - 4:
                out[~number, j] = 0
    return out, length


# Forms of addresses, phone numbers, mail addresses and identity numbers. {L} a place, {h} a house, {w} a ward,
# {z} a postal code, {dN} N digits, {uN} N capitals, {a} and {b} five digits each, others names or words.
STREETS = {  # house; street; what may follow; postal code
    "latin": (
        ("House No. {h}, ", "H/No {h}, ", "{h} ", "{h}, ", "{h}/{w} ", "Flat {w}{u1}, {h} ", "Flat {w}, ", "Plot {h}, ", "Qtr. No. {h}, "),
        ("{L} Road", "{L} Cross Road", "{L} Street", "{L} Lane", "{L} Avenue", "{L} Path", "{L} Bazar Road", "{L} Leikai", "{L} Colony"),
        (", {L}", ", Ward {w}, {L}", ", P.O. {L}", ", {L}, {L}"),
        (" {z}", " - {z}", "-{z}", ", {z}", ", PIN {z}"),
    ),
    "bengali": (
        ("{h} ", "{h}, ", "{h}/{w} ", "বাড়ি {h}, ", "বাড়ি নং {h}, ", "য়ুম নং {h}, "),
        ("{L} সড়ক", "{L} রোড", "{L} গলি", "{L} লৈকাই"),
        (", {L}", ", ওয়ার্ড {w}, {L}", ", ডাকঘর {L}"),
        (" {z}", " - {z}", ", {z}"),
    ),
    "devanagari": (
        ("{h} ", "{h}, ", "{h}/{w} ", "मकान {h}, ", "मकान नं {h}, "),
        ("{L} मार्ग", "{L} सड़क", "{L} गली", "{L} रोड"),
        (", {L}", ", वार्ड {w}, {L}", ", डाकघर {L}"),
        (" {z}", " - {z}", ", {z}"),
    ),
    "meitei": (
        ("{h} ", "{h}, ", "{h}/{w} ", "ꯌꯨꯝ {h}, ", "ꯌꯨꯝ ꯅꯪ {h}, "),
        ("{L} ꯂꯩꯀꯥꯏ", "{L} ꯂꯝꯕꯤ"),
        (", {L}", ", ꯋꯥꯔ꯭ꯗ {w}, {L}"),
        (" {z}", " - {z}", ", {z}"),
    ),
}
PHONES = ("+91{a}{b}", "+91-{a}{b}", "+91 {a} {b}", "0091 {a}.{b}", "{a}{b}", "{a} {b}", "0{a}-{b}", "0385-2{d6}", "(0385) 2{d3} {d3}", "{d3}-{d3}-{d4}", "0385 2{d6}", "91 {a}-{b}", "+91 (385) 2{d6}")
MAILS = ("{x}@{y}.test", "{x}.{z}@{y}.example", "{x}_{d2}@mail.{y}.invalid", "{x}+{z}@{y}.test", "{x}.{z} [at] {y} [dot] example", "{x}[at]{y}[dot]ac[dot]test", "{x}.{z} at {y} dot ac dot test", "{x}_{d2} @ mail.{y}.invalid", "{x}-{z}＠{y}-press.test", "{x} (at) {y} (dot) test")
IDS = ("{d4} {d4} {d4}", "{d4}-{d4}-{d4}", "{d12}", "{u1}{d7}", "{u5}{d4}{u1}", "{u5} {d4} {u1}", "{u3}{d7}", "{d4} {d4} {d4}", "{d4}-{d4}-{d4}")
DIGITS = {"latin": "0123456789", "bengali": "০১২৩৪৫৬৭৮৯", "devanagari": "०१२३४५६७८९", "meitei": "꯰꯱꯲꯳꯴꯵꯶꯷꯸꯹"}


def filled(pattern: str, script: str, rng: np.random.Generator, names: list[str], pool: list[str]) -> str:
    """A form with its places filled by digits, names and words."""
    ds = DIGITS[script] if script != "latin" and rng.random() < 0.5 else DIGITS["latin"]
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    num = lambda n: "".join(ds[int(i)] for i in rng.integers(0, 10, n))

    def one(m: re.Match) -> str:
        k = m[1]
        if k in "ab":
            return num(5)
        if k[0] == "d" and k[1:]:
            return num(int(k[1:]))
        if k[0] == "u":
            return "".join(chr(65 + int(i)) for i in rng.integers(0, 26, int(k[1:])))
        if k == "L":
            w = pick(names) if rng.random() < 0.5 else pick(pool)
            return w.title() if script == "latin" else w
        if k == "h":
            return num(int(rng.integers(1, 4))).lstrip(ds[0]) or ds[1]
        if k == "w":
            return num(int(rng.integers(1, 3)))
        if k in "xy" or pattern in MAILS:
            return (pick(names) if rng.random() < 0.6 else pick(pool)).lower()
        return ds[int(rng.integers(1, 9))] + num(5) if rng.random() < 0.8 else ds[int(rng.integers(1, 9))] + num(2) + " " + num(3)

    return re.sub(r"\{(\w+)\}", one, pattern)


def training(parts: list[tuple[str, str, str]], samples: list[tuple[str, str]], many: int = 6000, seed: int = 11) -> tuple[list, dict[str, str]]:
    """Labelled sequences, and the full name list; parts: (name, kind, script), samples: (text, script)."""
    rng = np.random.default_rng(seed)  # one fixed stream: the table is the same every time
    listed = {n: ("G" if k == "given" else "F") for n, k, _ in parts}
    told = Tokens({n: k for i, (n, k) in enumerate(listed.items()) if i % 2})
    by = {s: [n for n, _, t in parts if t == s] or ["x"] for s in LABELS}
    texts = {s: [" ".join(t.split()) for t, x in samples if x == s] or ["x y z."] for s in LABELS}
    pool = {s: [w for t in texts[s] for w in re.findall(r"[^\s\d!-/:-@।꯫“”]+", t)] or ["x"] for s in LABELS}
    own_letters = {"latin": "x", "bengali": "b", "devanagari": "d", "meitei": "m"}
    pool = {s: [w for w in ws if shape(w)[0].lower() == own_letters[s]] or ws for s, ws in pool.items()}
    known = {s: [n for n in by[s] if n in told.listed] or ["x"] for s in LABELS}
    scripts = list(LABELS)
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    lot = rng.random

    def mixed(w: str) -> str:
        """A word no sample has, of the same look: most words of texts are none of the samples'."""
        if not w.isalpha() and w.isascii() or len(w) < 4:
            return w
        end = w[-1] if w[-1] in ".,;:?!।꯫" else ""
        inside = list(w[1 : len(w) - len(end)])
        rng.shuffle(inside)
        return w[0] + "".join(inside) + end

    def name(script: str, bare: bool) -> str:
        """bare: nothing announces it. Letters without capitals then show a name by parts on the list only."""
        made = lambda: pick(by[script]) if lot() < 0.75 else pick(pool[script]).title() if script == "latin" else pick(pool[script])
        x = [made() for _ in range(2 if lot() < (0.9 if script == "latin" else 0.97) else 3)]
        if bare and script != "latin":
            x = [v if v in told.listed or (j and lot() < 0.3) else pick(known[script]) for j, v in enumerate(x)]
        if script == "latin" and lot() < 0.25:
            x[int(rng.integers(2))] = chr(65 + int(rng.integers(26))) + "."
        v = (", " if script == "latin" and lot() < 0.1 else " ").join(x)
        return v.upper() if script == "latin" and lot() < 0.15 else v

    def value(kind: str, script: str, label: str) -> str:
        if kind == "id_number":
            short = re.search(r"(?i)aadhaar|uid|আধার|आधार|ꯑꯥꯙꯥꯔ", label)
            long = re.search(r"(?i)pan\b|passport|voter|licence|প্যান|পেন|পাস|ভোটার|पैन|पास|मतदाता|ꯄꯦꯟ|ꯄꯥꯁ|ꯚꯣ", label)
            form = pick([f for f in IDS if ("{u" in f) == bool(long)] if short or long else IDS)
        else:
            form = "".join(pick(x) for x in STREETS[script]) if kind == "address" else pick(PHONES if kind == "phone" else MAILS)
        own = script if kind == "address" or "{u" not in form and kind != "email" else "latin"
        return filled(form, own, rng, by[own if kind != "phone" else script], pool[own])

    def held(kind: str, script: str) -> list[tuple[str, str | None]]:
        """A value with or without what announces it."""
        label = pick(LABELS[script][kind]) if lot() < {"name": 0.5, "email": 0.5, "phone": 0.65, "id_number": 0.85, "address": 0.5}[kind] else ""
        out: list[tuple[str, str | None]] = []
        if label:
            label = label.capitalize() if lot() < 0.4 and not label.isupper() else label
            if kind in ("phone", "id_number") and lot() < 0.3:
                label += " " + pick(NUMBER[script])
            out.append((label + pick((": ", " ", ":", " - ", " ") if kind != "name" or script != "latin" or lot() < 0.7 else (" of ", ": ")), None))
        elif kind == "name" and lot() < 0.6:
            out.append((pick(TITLES[script]) + pick((". ", " ")), None))
        if kind == "email" and lot() < 0.2:
            return [*out, (value(kind, script, label).upper(), kind)]
        out.append((name(script, not out) if kind == "name" else value(kind, script, label), kind))
        return out

    def other(script: str) -> list[tuple[str, str | None]]:
        """What only looks like a value."""
        k = pick((0, 0, 1, 2, 2, 2, 3, 4, 5, 6))
        own = pick(by[script]) if lot() < 0.6 else pick(pool[script]).title()
        if k == 0:
            v = " ".join([own, *([pick(by[script])] if lot() < 0.4 else []), *(["Memorial"] if script == "latin" and lot() < 0.25 else []), pick(PLACES[script]), *([pick(PLACES[script])] if lot() < 0.2 else [])])
        elif k == 1:
            v = own
        elif k == 2:
            form = pick(("{d3}-{d3}-{d4}", "{d10}", "{d4} {d4} {d4}", "{d12}", "{d4}-{d4}-{d4}", "{u1}{d7}", "{u5}{d4}{u1}", "{d8}", "{d4}-{d4}", "978-{d1}-{d4}-{d4}-{d1}", "{d6}", "{u2}-{d4}"))
            v = pick(THINGS[script]) + pick((" ", " no. ", ": ")) + filled(form, script, rng, by[script], pool[script])
        elif k == 3:
            v = filled(pick(("{d2}-{d2}-{d4}", "{d4}", "{d3}", "{d2}.{d2}.{d4}", "{d1},{d3}", "{d1}.{d1}.{d2}", "{d2}:{d2}", "{d4}-{d2}")), script, rng, by[script], pool[script])
        elif k == 4:
            v = pick(("https://www.{y}.example/{d4}", "http://{y}.test/{x}?id={d6}", "www.{y}.test/{d3}"))
            v = filled(v, "latin", rng, by["latin"], pool["latin"])
        elif k == 5 and script != "latin":  # words of another script
            v = " ".join(pick(pool["latin"]).lower() for _ in range(int(rng.integers(1, 3))))
        elif k == 5:
            v = pick(pool[scripts[int(rng.integers(1, 4))]])
        else:
            v = " ".join(pick(pool[script]).title() for _ in range(int(rng.integers(3, 6)))) if script == "latin" else pick(by[script])
        return [(v, None)]

    out = []
    for i in range(many):
        script = "latin" if i % 5 == 4 else scripts[i % 4]
        ws = [mixed(w) if lot() < 0.6 else w for w in pick(texts[script]).split(" ")]
        if i % 7 in (2, 5) and len(ws) > 2:  # a sample as it is, sometimes as a heading
            line = " ".join(ws)
            line = line.upper() if i % 21 == 5 else line.title() if i % 21 == 12 else line
            pieces: list[tuple[str, str | None]] = [(line, None)]
        else:
            at = int(rng.integers(len(ws) + 1)) if lot() < 0.8 else 0
            lo, hi = max(0, at - int(rng.integers(1, 9))), at + int(rng.integers(0, 9))
            kind = pick(("name", "name", "name", "name", "phone", "phone", "id_number", "id_number", "address", "address", "email", "email"))
            inner = held(kind, script) if i % 4 else other(script)
            if lot() < 0.2:
                inner += [(pick((", ", " (", "; ", " ")), None), *(held(pick(KINDS), script) if lot() < 0.6 else other(script))]
            if lot() < 0.12:
                inner = [(pick("(<[\"“"), None), *inner, (pick(")>]\"”"), None)]
            before, after = " ".join(ws[lo:at]), " ".join(ws[at:hi])
            pieces = [(before + " " if before else "", None), *inner, (pick(("", ",", ".", " ", "")) + (" " + after if after else ""), None)]
        text, marks = "", []
        for v, kind in pieces:
            if kind:
                marks.append((len(text), len(text) + len(v), kind))
            text += v
        feats, length = features([text], told)
        if not length[0]:
            continue
        tags = []
        for m in _TOKEN.finditer(text):
            own = next(((x, k) for x, y, k in marks if x <= m.start() < y), None)
            tags.append(0 if own is None else TAGS.index(("B-" if m.start() == own[0] else "I-") + own[1]))
        out.append((feats.tolist(), tags))
    return out, listed


def trained(parts: list[tuple[str, str, str]], samples: list[tuple[str, str]]) -> tuple[Crf, Tokens]:
    seqs, listed = training(parts, samples)
    # a feature seen in few lines tells of those lines, not of a kind
    often = np.bincount(np.concatenate([np.unique(f) for f, _ in seqs]), minlength=SIZE) >= SEEN
    seqs = [([[x if often[x] else 0 for x in row] for row in f], y) for f, y in seqs]
    return fit(seqs, TAGS, SIZE, rounds=60, rate=0.1, decay=1.5e-3), Tokens(listed)


def digits_in(s: str) -> int:
    return sum(c.isdigit() for c in s)


def exact(text: str, a: int, b: int, kind: str) -> tuple[int, int] | None:
    """The tagged stretch without titles, closing signs and a bracket left open, or None if it can't be of its kind."""
    if kind == "name" and (m := _TITLE.match(text, a, b)):
        a = m.end()
    while b > a and not (text[b - 1].isalnum() or unicodedata.category(text[b - 1])[0] == "M"):
        if kind == "name" and text[b - 1] == "." and b - 2 >= a and text[b - 2].isupper() and (b - 3 < a or not text[b - 3].isalpha()):
            break
        b -= 1
    while a < b and not (text[a].isalnum() or kind == "phone" and (text[a] in "+＋" or text[a] == "(" and ")" in text[a:b])):
        a += 1
    v = text[a:b]
    n = digits_in(v)
    if kind == "email":
        good = bool(re.search(r"[@＠]|\bat\b", v)) and bool(re.search(r"[.．]|\bdot\b", v))
    elif kind == "phone":
        good = 10 <= n <= 13
    elif kind == "id_number":
        good = n == 12 or (v[:1].isalpha() and 4 <= n <= 8)
    elif kind == "address":
        good = n >= 6 and bool(re.search(r"\d$", v))
    else:
        good = 2 <= len(re.findall(r"[^\s,]+", v)) <= 4 and not n and "\n" not in v
    return (a, b) if v and good else None


def spans_of(texts: list[str | None], crf: Crf, tokens: Tokens) -> list[list[tuple[int, int, str]]]:
    """(start, end, kind) in each text, in order and apart from each other."""
    out: list[list[tuple[int, int, str]]] = [[] for _ in texts]
    lines, where = [], []
    for i, t in enumerate(texts):
        at = 0
        for line in (t or "").split("\n"):
            if line and not line.isspace():
                lines.append(line)
                where.append((i, at))
            at += len(line) + 1
    step = 4000
    for lo in range(0, len(lines), step):
        tokens.fresh()
        own, places = lines[lo : lo + step], where[lo : lo + step]
        feats, length = features(own, tokens)
        u = crf.scores(feats)
        open_ = np.flatnonzero(~crf.settled(u, length))
        if not len(open_):
            continue
        start = np.cumsum(length) - length
        some = np.concatenate([np.arange(start[k], start[k] + length[k]) for k in open_])
        tags = crf.viterbi(u[some], length[open_])
        at = 0
        for k in open_:
            line_tags = tags[at : at + length[k]]
            at += length[k]
            if line_tags.any():
                i, base = places[k]
                for a, b, kind in tagged(own[k], line_tags.tolist()):
                    out[i].append((base + a, base + b, kind))
    return [sorted(x) for x in out]


def tagged(line: str, tags: list[int]) -> list[tuple[int, int, str]]:
    """The stretches of a line that its tags name."""
    spans = [m.span() for m in _TOKEN.finditer(line)]
    out: list[tuple[int, int, str]] = []
    k, n = 0, len(tags)
    while k < n:
        if tags[k] == 0:
            k += 1
            continue
        kind = TAGS[tags[k]][2:]
        j = k + 1
        while j < n and TAGS[tags[j]] == f"I-{kind}":
            j += 1
        while j < n and kind == "name" and TAGS[tags[j]] == "B-name" and line[spans[j - 1][1] : spans[j][0]] == " ":
            j += 1
            while j < n and TAGS[tags[j]] == "I-name":
                j += 1
        got = exact(line, spans[k][0], spans[j - 1][1], kind)
        if got and not any(x < got[1] and got[0] < y for x, y, _ in out):
            out.append((*got, kind))
        k = j
    return out


def masked(text: str | None, spans: list[tuple[int, int, str]]) -> str | None:
    if not text or not spans:
        return text
    out, at = [], 0
    for a, b, kind in spans:
        out += [text[at:a], f"<{kind.upper()}>"]
        at = b
    return "".join([*out, text[at:]])


def _held(docs: DataFrame, names: DataFrame, samples: DataFrame):
    # the name list is used whole: a stated list that is as large as its rows, not as the documents
    parts = [tuple(r) for r in names.where("name_part is not null").select("part_id", "name_part", "kind", "script").orderBy("part_id", "name_part").select("name_part", "kind", "script").collect()]
    texts = [tuple(r) for r in samples.where("text is not null").orderBy("sample_id").limit(SAMPLES).select("text", "script").collect()]
    return docs.sparkSession.sparkContext.broadcast(trained(parts, texts))


def found(docs: DataFrame, names: DataFrame, samples: DataFrame) -> DataFrame:
    """(doc_id, kind, value), each once per document, of docs (doc_id, text). Null and blank texts hold none."""
    held = _held(docs, names, samples)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        crf, listed = held.value
        for pdf in batches:
            texts = pdf["text"].tolist()
            rows = [(d, k, v) for d, t, own in zip(pdf["doc_id"], texts, spans_of(texts, crf, listed), strict=True) for k, v in dict.fromkeys((kind, t[a:b]) for a, b, kind in own)]
            yield pd.DataFrame(rows, columns=["doc_id", "kind", "value"])

    base = docs.select("doc_id", "text")
    return base.mapInPandas(run, f"doc_id {base.schema['doc_id'].dataType.simpleString()}, kind string, value string")


def replaced(docs: DataFrame, names: DataFrame, samples: DataFrame) -> DataFrame:
    """(doc_id, text, spans): the text with a placeholder such as <EMAIL> for each span, all else as it was."""
    held = _held(docs, names, samples)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        crf, listed = held.value
        for pdf in batches:
            texts = pdf["text"].tolist()
            own = spans_of(texts, crf, listed)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "text": [masked(t, s) for t, s in zip(texts, own, strict=True)], "spans": np.array([len(s) for s in own], dtype="int32")})

    base = docs.select("doc_id", "text")
    return base.mapInPandas(run, f"doc_id {base.schema['doc_id'].dataType.simpleString()}, text string, spans int")


def p10_found(spark, sf_dir: str) -> DataFrame:
    return found(table(spark, sf_dir, "documents"), table(spark, sf_dir, "name_parts"), table(spark, sf_dir, "lang_samples"))


def p10_replaced(spark, sf_dir: str) -> DataFrame:
    return replaced(table(spark, sf_dir, "documents"), table(spark, sf_dir, "name_parts"), table(spark, sf_dir, "lang_samples"))
