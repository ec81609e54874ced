"""Problem 1: broken prompt and response pairs.

The response is cut into clauses; a conditional random field tags each as answer, refusal, echo, foreign or unfinished
from its words, its end, its overlap with the prompt and its language; the clauses' coverage decides on the pair."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.crf import Crf, feature, fit
from tessera.llm.language import Model, fitted, labelled, named
from tessera.llm.runtime import table
from tessera.llm.textkit import LANGUAGES, SENTENCE_END, sentences, words

TAGS = ["answer", "refusal", "echo", "foreign", "unfinished"]
SIZE = 1 << 14
# Fillers that say nothing, as comparison words.
FILLERS = {"n a", "na", "null", "none", "nil", "nan", "blank", "empty", "undefined", "tbd", "todo", "no output", "no answer", "no response", "not available", "not applicable", "left blank", "q", "a", "output", "answer", "response"}
# What a prompt calls the four languages.
CALLED = {
    "mni": ("manipuri", "meiteilon", "meitei", "মণিপুরি", "মৈতৈলোন", "মণিপুরী", "मणिपुरी", "ꯃꯩꯇꯩꯂꯣꯟ"),
    "bn": ("bengali", "bangla", "বাংলা", "बंगाली", "बांग्ला"),
    "en": ("english", "ইংরেজি", "अंग्रेजी", "अंग्रेज़ी"),
    "hi": ("hindi", "হিন্দি", "हिन्दी", "हिंदी"),
}
_ASKED = re.compile(r"\b(?:in|into|to)\s+([A-Z][a-z]+)|\b([A-Z][a-z]+)\s+(?:version|translation)", re.I)
COPYING = re.compile(r"\b(copy|repeat|quote|verbatim|word for word|echo|exactly as|without any change|reproduce|restate the)\b|হুবহু|উদ্ধৃত|পুনরাবৃত্তি|ज्यों का त्यों|दोहरा|हूबहू", re.I)
LABEL = re.compile(r"\b(?:suggest|give|write|propose|choose|find|invent)\b[^.?!]{0,20}\b(?:title|headline|heading)\b|\b(?:classify|categori[sz]e|which (?:label|category|tag)|label (?:the|this))|শিরোনাম|শ্রেণি|शीर्षक|श्रेणी", re.I)
LIST = re.compile(r"\b(?:list|name|give|enumerate)\s+(?:\d+|three|four|five|six|some)\b|তালিকা|सूची", re.I)
_ITEM = re.compile(r"^\s*(?:\d+[.)]|[-*•])\s*")
_LEAD = re.compile(r"^\s*(?:[>\"'“”‘’(\[*_]|(?:q|question|instruction|input|a|answer|output|response)\s*:)+\s*", re.I)

# The labelled table the field is trained on, with the sentences of the language samples: refusals, and answers that sound
# like some, are put together from the parts below in all ways or a fixed share of them; {} is a thing.
OPENERS = {
    "en": ("", "", "I'm sorry, but ", "Sorry, ", "I apologise, but ", "Unfortunately, ", "Regrettably, ", "I'm afraid ", "As an AI model, ", "As a language model, ", "Thank you for asking, but ", "No, "),
    "bn": ("", "", "দুঃখিত, ", "মাফ করবেন, ", "ক্ষমা করবেন, ", "ভাষা মডেল হিসেবে "),
    "hi": ("", "", "क्षमा करें, ", "माफ़ कीजिए, ", "खेद है, ", "भाषा मॉडल के रूप में "),
    "mni": ("", "ঙাকপিয়ু, ", "ꯉꯥꯛꯄꯤꯌꯨ, ", "Ngaakpiyu, "),
}
UNABLE = ("cannot", "can't", "can not", "could not", "am unable to", "am not able to", "won't", "won't be able to", "will not", "must decline to", "have to decline to", "decline to", "refuse to", "am not allowed to", "am not permitted to", "would rather not", "prefer not to", "do not want to", "don't feel able to", "am in no position to", "have no way to")
ACTS = ("help with {}", "help you", "assist with {}", "answer", "answer that", "respond", "respond to this", "say anything about {}", "discuss {}", "comment on {}", "talk about {}", "write about {}", "provide that", "provide {}", "complete this", "fulfil this", "comply", "do that", "give an answer", "share that", "offer an opinion on {}")
SELVES = (
    "I don't know.", "I do not know the answer.", "I have no information about {}.", "I don't have the information needed.", "I do not have access to that.", "this goes beyond what I can do.", "this is not something I can do.", "that is not something I will do.", "{} lies beyond my abilities.", "my rules forbid this.", "my instructions do not allow this.", "it is against my policy to discuss {}.",
    "it would be wrong of me to answer.", "it isn't possible for me to answer.", "please ask someone else.", "please ask me something else.", "you could ask a specialist instead.", "is there something else you need?", "thanks for understanding.", "I'd be glad to help with another question.",
)
PARTS = {  # refusals of the other languages: in turn one of each row
    "bn": (("আমি ", "আমার পক্ষে ", ""), ("এই বিষয়ে ", "এ ব্যাপারে ", "এই প্রশ্নের ", "এটি ", "এই কাজটি "), ("সাহায্য করতে ", "উত্তর দিতে ", "মন্তব্য করতে ", "কিছু বলতে ", "লিখতে ", "করতে "), ("পারব না।", "পারছি না।", "পারি না।", "চাই না।", "অক্ষম।", "রাজি নই।", "অপারগ।")),
    "hi": (("मैं ", "मेरे लिए ", ""), ("इस विषय में ", "इस बारे में ", "इस पर ", "यह ", "इस प्रश्न का "), ("सहायता ", "मदद ", "उत्तर ", "टिप्पणी ", "काम ", "राय "), ("नहीं कर सकता।", "नहीं दे सकता।", "नहीं करूँगा।", "करने में असमर्थ हूँ।", "देने में असमर्थ हूँ।", "संभव नहीं है।", "नहीं लिख सकता।")),
    "mni": (("ঐ ", "ঐনা "), ("মসিদা ", "মসিগী ", "হায়রিবা অসিদা "), ("মতেং পাংবা ", "পাওখুম পীবা ", "ৱা ঙাংবা ", "ইবা "), ("ঙমদে।", "ঙমলোই।", "য়ারোই।", "পাম্দে।")),
    "mni-mayek": (("ꯑꯩ ", "ꯑꯩꯅꯥ "), ("ꯃꯁꯤꯗꯥ ", "ꯃꯁꯤꯒꯤ "), ("ꯃꯇꯦꯡ ꯄꯥꯡꯕꯥ ", "ꯄꯥꯎꯈꯨꯝ ꯄꯤꯕꯥ ", "ꯏꯕꯥ "), ("ꯉꯃꯗꯦ꯫", "ꯉꯃꯂꯣꯏ꯫", "ꯌꯥꯔꯣꯏ꯫")),
    "mni-latin": (("Ei ", "Eina "), ("masida ", "masigi "), ("mateng paangba ", "paukhum piba ", "iba "), ("ngamde.", "ngamloi.", "yaaroi.")),
}


def _turns(rows: tuple[tuple[str, ...], ...], many: int) -> list[str]:
    """Clauses of one part of each row, the parts of every row in turn."""
    return list(dict.fromkeys("".join(x[(i * (2 * k + 1) + i // len(x)) % len(x)] for k, x in enumerate(rows)) for i in range(many)))


REFUSALS = {
    "en": [f"I {u} {a}." for i, u in enumerate(UNABLE) for j, a in enumerate(ACTS) if (i + j) % 4 == 0] + list(SELVES),
    "bn": _turns(PARTS["bn"], 60),
    "hi": _turns(PARTS["hi"], 60),
    "mni": _turns(PARTS["mni"], 16) + _turns(PARTS["mni-mayek"], 12) + _turns(PARTS["mni-latin"], 12),
}
THINGS = ("this", "that", "this request", "the barn", "any canal", "such things", "this topic", "any ferry")
OTHERS = ("The clerk", "The {}", "They", "Nobody at the {}", "Her neighbour", "The owner of the {}", "Two of the guards")
ABOUT = ("could not help the {}", "cannot help the {}", "refused to answer the letter", "declined to comment on the {}", "was unable to assist anyone", "is not able to open the {}", "was not allowed to discuss the {}", "would rather not sell the {}", "will not do that again", "won't write about the {}")
ANSWERS = (
    *[f"{o} {x}." for o in OTHERS for x in ABOUT],
    "Here it is.", "Here is what the notes say.", "Certainly, here is the text.", "Of course.", "I cannot praise the {} enough.", "I can't stress enough how {} it was.", "We could not have wished for a better {}.", "Sorry for the {} as they were, they left at noon.", "Unfortunately the {} was closed.", "I don't know a better {} than this.", "No, the {} is still open.", "The answer is {}.",
    "news", "story", "notice", "Story.", "News.", "The Old {} of the Valley", "1. narrow {}", "2. bright lamp", "3. old {}",
)
FILL = ("bell", "river", "market", "orchard", "kiln", "quiet", "stubborn", "field", "school", "clinic")


def _grams(text: str) -> list[str]:
    w = ["^", *words(text)]
    return [f"w2={a}_{b}" for a, b in zip(w, w[1:], strict=False)] + [f"w3={'_'.join(w[i : i + 3])}" for i in range(len(w) - 2)]


# Word features are those of the refusals: what tells a refusal, not what texts are about.
LEXICON = {g for k, v in OPENERS.items() for o in v for x in REFUSALS[k] for y in (x, x[0].lower() + x[1:]) for g in _grams(o + y.format("it"))} - {"w2=of_the", "w2=in_the", "w2=for_the", "w2=^_the"}


# Words by what they do in a clause that declines, in each language.
ROLES = {
    "me": "i me my mine myself we us our আমি আমার আমাকে আমরা मैं मुझे मेरे मेरा मेरी हम ঐ ঐনা ঐগী ঐহাক ꯑꯩ ꯑꯩꯅꯥ ꯑꯩꯒꯤ ei eina eigi",
    "not": "not no t cannot never none nothing unable decline declined refuse refused without beyond outside against forbid forbids prevent prevents wrong unwilling না নেই নয় নই নি অক্ষম অপারগ নারাজ नहीं न मत असमर्थ अक्षम मना",
    "aid": "help assist answer answers respond reply discuss comment opinion request requests question questions information topic guidelines policy rules able allowed permitted appropriate possible provide know understand guess write সাহায্য উত্তর মন্তব্য প্রশ্ন প্রশ্নের বিষয়ে অনুরোধ তথ্য জানা সম্ভব মত মতামত मदद सहायता उत्तर जवाब राय प्रश्न जानकारी संभव टिप्पणी अनुरोध মতেং পাওখুম ꯃꯇꯦꯡ ꯄꯥꯎꯈꯨꯝ mateng paukhum",
    "you": "you your yours please someone somebody else another ask আপনি আপনার আপনাকে অন্য দয়া कृपया आप आपकी आपका",
    "sorry": "sorry apologise apologize apologies apology unfortunately regrettably regret afraid pardon respect দুঃখিত মাফ ক্ষমা দুর্ভাগ্য क्षमा माफ़ माफ खेद ঙাকপিয়ু ꯉꯥꯛꯄꯤꯌꯨ ngaakpiyu",
    "machine": "ai model assistant language ভাষা মডেল মডেল भाषा मॉडल",
}
_ROLE = {w: r for r, x in ROLES.items() for t in x.split() for w in words(t)}
_MNI_NOT = ("দে", "লোই", "রোই", "ꯗꯦ", "ꯂꯣꯏ", "ꯔꯣꯏ", "amde", "loi", "roi")  # endings of verbs that deny


def roles(ws: list[str]) -> list[str]:
    """What the words of a clause do if it declines: the roles it has, in pairs, and their share of its words."""
    own = [_ROLE.get(w) or ("not" if len(w) > 3 and w.endswith(_MNI_NOT) else None) for w in ws]
    have = sorted({r for r in own if r})
    share = sum(r is not None for r in own) / max(1, len(ws))
    return [f"r={r}" for r in have] + [f"rr={a}_{b}" for a in have for b in have if a < b] + [f"rs={int(5 * share)}", f"rn={len(have)}", f"rns={len(have)}_{int(3 * share)}"]


def asked_language(instruction: str, own: str | None) -> str | None:
    """The language a prompt asks for, or else is in."""
    for m in _ASKED.finditer(instruction):
        for language, names in CALLED.items():
            if (m[1] or m[2]).lower() in names:
                return language
    for language, names in CALLED.items():
        if any(not x.isascii() and re.search(re.escape(x) + r"(?:তে|য়|ভাষায়|\s*(?:ভাষায়|में|भाषा में|ꯗꯥ))", instruction) for x in names):
            return language
    return own


def share_in(part: list[str], whole: list[str], run: int = 3) -> float:
    """Share of the words of part that lie in runs of at least `run` words (or all of part) that whole has too."""
    if not part or not whole:
        return 0.0
    if len(part) < run:  # a word or two is an echo only of a prompt as short
        return float(part == whole)
    n = run
    grams = {tuple(whole[i : i + n]) for i in range(len(whole) - n + 1)}
    held = np.zeros(len(part), bool)
    for i in range(len(part) - n + 1):
        if tuple(part[i : i + n]) in grams:
            held[i : i + n] = True
    return float(held.mean())


def clause_features(text: str, first: bool, last: bool, echo: float, copying: bool, language: str, short: bool, wording: bool = True) -> list[int]:
    """language: same, other or unclear; short: the prompt asks for a label, title or list; wording: tell turns of phrase."""
    ws = words(text)
    end = text.rstrip().rstrip("\"'”’)]*_​﻿⁠­>").rstrip()[-1:]
    done = end in SENTENCE_END and not text.rstrip().endswith(("…", "...", "—")) if end else False
    mark = "end" if done else "list" if _ITEM.match(text) else "open" if end in "(“\"'‘[{,;:-–—…" or end == "" else "word"
    where = f"{int(first)}{int(last)}"
    bits = ["b", f"end={mark}", f"end={mark},last={int(last)},short={int(short)}", f"echo={min(4, int(echo * 5))}", f"echo={min(4, int(echo * 5))},copy={int(copying)}", f"lang={language}", f"lang={language},echo={int(echo > 0.75)}", f"at={where}", f"n={min(6, len(ws) // 3)}"]
    bits += roles(ws)
    if wording:
        bits += [g for g in _grams(text) if g in LEXICON]
    return [feature(x, SIZE) for x in bits]


def training(samples: list[tuple[str, str]]) -> list[tuple[list[list[int]], list[int]]]:
    """Labelled clause sequences made of the language samples and the own clauses, by fixed rules."""
    cut = [(t[a:b].strip(), lang) for t, lang in samples for a, b in sentences(t)]
    plain = [(s, lang) for s, lang in cut if len(s.split()) > 3]
    out = []

    def add(clauses: list[tuple[str, float, str, str]], copying: bool = False, short: bool = False) -> None:
        k = len(clauses)
        clauses = [(s, e, "unclear" if len(words(s)) < 3 else lang, y) for s, e, lang, y in clauses]
        # every other sequence shows no turns of phrase: the field must tell refusals by what their words do as well
        wording = len(out) % 2 == 0
        out.append(([clause_features(s, i == 0, i == k - 1, e, copying, lang, short, wording) for i, (s, e, lang, _) in enumerate(clauses)], [TAGS.index(y) for *_, y in clauses]))

    for i in range(len(plain) // 3):
        k, j = 1 + i % 5, 3 * i  # clauses of the run, where it starts
        run = [x for x, _ in plain[j : j + k]]
        tail = plain[(j + k) % len(plain)][0].split()
        broken = " ".join(tail[: max(1, len(tail) * (1 + i % 4) // 5)]) + ("", "", "", " (", "", ",", "", "…", " -")[i % 9]
        add([(x, (i % 4) * 0.1, "same", "answer") for x in run])
        add([(x, 0.0, "same", "answer") for x in run[: i % 4]] + [(broken, 0.0, ("same", "same", "unclear")[i % 3], "unfinished")])
        if i % 2 == 0:
            add([(x, 0.0, "other", "foreign") for x in run])
            add([(x, 1.0 - 0.1 * (i % 4 // 2), ("same", "same", "other")[i % 3], "echo") for x in run])
        if i % 4 == 0:
            add([(x, 1.0, "same", "answer") for x in run], copying=True)
            add([("Here is what the records say.", 0.0, "same", "answer")] + [(x, 0.0, "same", "answer") for x in run])
        if i % 4 == 1:
            add([(run[0].rstrip(SENTENCE_END), 1.0, "same", "echo")])
            items = [f"{n + 1}. " + " ".join(plain[(i + 7 * n) % len(plain)][0].split()[:2]) for n in range(2 + i % 5)]
            add([(x, 0.0, "unclear", "answer") for x in items], short=True)
        if i % 8 == 3:
            add([(run[0], 1.0, "same", "echo")] + [(x, 0.0, "same", "answer") for x in run])
    # sentences that tell of denying and helping, of others than the speaker
    script = {"en": str.isascii, "bn": lambda w: "\u0980" <= w[0] < "\u0a00", "hi": lambda w: "\u0900" <= w[0] < "\u0980"}
    for i, (x, lang) in enumerate(plain):
        if lang in script:
            own = [w for r in ("not", "aid", "you", "not", "aid") for w in sorted(k for k, v in _ROLE.items() if v == r and script[lang](k) and len(k) > 1)]
            ws = x.split()
            for k in range(1 + i % 3):
                ws.insert(1 + (i * 7 + k * 5) % max(1, len(ws) - 1), own[(i * 11 + k * 17) % len(own)])
            ws = ws[: 8 + i % 5]  # short ones too, in which such words weigh more
            add([(" ".join(ws).rstrip(SENTENCE_END) + ("." if lang == "en" else "।"), 0.0, "same", "answer")] + ([(plain[i - 1][0], 0.0, "same", "answer")] if i % 3 == 0 and plain[i - 1][1] == lang else []))
    for i, s in enumerate(ANSWERS):
        for j, f in enumerate(FILL[:3] if i < len(OTHERS) * len(ABOUT) else FILL[:6]):
            x = s.replace("{}", f)
            label = i >= len(ANSWERS) - 9
            add([(x, 0.0, "same", "answer")] + ([] if label else [(plain[(i * 31 + j * 7) % len(plain)][0], 0.0, "same", "answer")]), short=label)
    for lang, cores in REFUSALS.items():
        for i, core in enumerate(cores):
            for j, opener in enumerate(OPENERS[lang]):
                x = opener + (core if not opener or core.startswith("I ") or core.startswith("I'") else core[0].lower() + core[1:])
                x = x.format(THINGS[(i + j) % len(THINGS)])
                x = x.upper() if (i + j) % 13 == 0 else x
                if lang == "en" and (i + j) % 3:
                    continue
                add([(x, 0.0, ("same", "other")[(i + j) % 2], "refusal")] + ([(cores[(i * 5 + j) % len(cores)].format("it"), 0.0, "same", "refusal")] if j % 3 == 0 else []))
    return out


def trained(samples: list[tuple[str, str]]) -> Crf:
    return fit(training(samples), TAGS, SIZE, rounds=60, decay=1e-4)


def defects_of(instructions: list, inputs: list, outputs: list, languages: list, model: Model, crf: Crf) -> list[str | None]:
    """The defect of each pair, None for a sound one. A null instruction or input is an empty one."""
    n = len(outputs)
    told = [x or "" for x in instructions]
    lines = labelled(told, model)
    spoken = []
    for own, label in zip(lines, languages, strict=True):
        votes: dict[int, int] = {}
        for _, _, x, _, k in own:
            votes[x] = votes.get(x, 0) + k
        got = LANGUAGES[max(votes, key=lambda x: votes[x])] if votes else None
        spoken.append(got or (named(label) if named(label) in LANGUAGES else None))
    wanted = [asked_language(t, s) for t, s in zip(told, spoken, strict=True)]
    tongue = labelled(outputs, model)
    feats: list[list[int]] = []
    length = np.zeros(n, int)
    weight: list[int] = []
    facts = []
    for i in range(n):
        text = outputs[i]
        joined = words(text)
        if not joined or " ".join(joined) in FILLERS:
            facts.append("empty")
            continue
        facts.append(None)
        copying, short = bool(COPYING.search(told[i])), bool(LABEL.search(told[i]) or LIST.search(told[i]))
        source = words(told[i]), words(inputs[i])
        clauses = tongue[i] or [(0, len(text), 0, 0.0, 0)]
        for k, (a, b, x, p, m) in enumerate(clauses):
            s = text[a:b]
            ws = words(_LEAD.sub("", s))
            echo = max(share_in(ws, source[0]), share_in(ws, source[1]))
            sure = m >= 3 and p >= 0.8
            lang = "unclear" if not sure or wanted[i] is None else "same" if LANGUAGES[x] == wanted[i] else "other"
            feats.append(clause_features(s, k == 0, k == len(clauses) - 1, echo, copying, lang, short))
            weight.append(len(ws))
        length[i] = len(clauses)
    tags = crf.decode(feats, length)
    at = 0
    size = np.array(weight)
    for i in range(n):
        if facts[i]:
            continue
        k = length[i]
        tag, w = tags[at : at + k], size[at : at + k]
        at += k
        total = max(1, w.sum())
        cover = [float(w[tag == t].sum()) / total for t in range(len(TAGS))]
        if cover[1] > 0.5 or (cover[1] > 0.25 and tag[0] == 1):
            facts[i] = "refusal"
        elif cover[2] >= 0.75:
            facts[i] = "copied"
        elif cover[3] > 0.5:
            facts[i] = "other_language"
        elif tag[-1] == 4:
            facts[i] = "truncated"
    return facts


def found(pairs: DataFrame, samples: DataFrame) -> DataFrame:
    """(pair_id, defect) of the defective rows of pairs (pair_id, instruction, input, output, language)."""
    spark = pairs.sparkSession
    rows = samples.where("text is not null and language is not null").orderBy("sample_id").limit(2000).select("text", "language").collect()
    held = spark.sparkContext.broadcast((fitted(samples), trained([(r[0], r[1]) for r in rows])))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, crf = held.value
        for pdf in batches:
            got = defects_of(*(pdf[c].tolist() for c in ("instruction", "input", "output", "language")), model, crf)
            out = pd.DataFrame({"pair_id": pdf["pair_id"], "defect": got})
            yield out[out["defect"].notna()]

    base = pairs.select("pair_id", "instruction", "input", "output", "language")
    return base.mapInPandas(run, f"pair_id {base.schema['pair_id'].dataType.simpleString()}, defect string")


def p1_found(spark, sf_dir: str) -> DataFrame:
    return found(table(spark, sf_dir, "instructions"), table(spark, sf_dir, "lang_samples"))
