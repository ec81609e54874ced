"""The operators against brute force, exact round trips and held-out accuracy, on small fixtures."""

import difflib
import functools
import glob
import random
import re

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import history, language, leakage, lookalike, ocr, overlap, packing, pairs, pii, tokens
from tessera.llm.textkit import sentences, words
from tessera.llm.wordtable import chain, chain_distance, split_join, word_distance, word_table


def read(data, name):
    return pd.read_parquet(f"{data}/{name}.parquet")


def alike(a, b):
    s = difflib.SequenceMatcher(None, a, b, autojunk=False)
    return sum(x.size for x in s.get_matching_blocks()) / max(len(a), len(b), 1)


# words
def test_words_fold_what_does_not_count():
    assert words("<b>The</b>  Cаt ｆｕｌｌ, ze​ro!") == ["the", "cat", "full", "zero"]
    assert words(None) == words("") == words(" .,! ") == []


@given(st.lists(st.integers(0, 3), max_size=8), st.lists(st.integers(0, 3), max_size=8), st.integers(0, 8))
@settings(max_examples=200, deadline=None)
def test_word_distance_is_levenshtein(a, b, limit):
    d = [[i + j if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
    assert word_distance(np.array(a), np.array(b), limit) == min(d[-1][-1], limit + 1)


def test_split_join_is_the_join(spark):
    x = spark.createDataFrame([(1, i, i) for i in range(23)] + [(2, 50, 0), (3, 51, 0)], "key long, id long, v int")
    y = spark.createDataFrame([(1, 100 + i, i) for i in range(17)] + [(2, 200, 0)], "key long, id long, w int")
    got = sorted((r[0], r[1]) for r in split_join(x, y, "key", small=4, large=5).select("x.id", "y.id").collect())
    assert got == sorted([(i, 100 + j) for i in range(23) for j in range(17)] + [(50, 200)])


# 5 and 6
def test_new_rows_against_history(spark, data):
    c, i = read(data, "corpus_rows"), read(data, "incoming_rows")
    every = pd.concat([c.assign(o=-1), i.assign(o=i.batch_no)]).sort_values(["o", "row_id"])
    seen, want = [], set()
    for r in every.itertuples():
        w = words(r.text)
        if w and r.o >= 0 and any(abs(len(w) - len(x)) <= 0.2 * max(len(w), len(x)) and alike(x, w) >= 0.85 for x in seen):
            want.add(r.row_id)
        if w:
            seen.append(w)
    assert {r.row_id for r in history.p5_found(spark, data).collect()} == want


def test_history_folder_is_appended_to(spark, tmp_path):
    h = history.History(spark, str(tmp_path / "h"))
    schema = "id long, batch int, text string"
    text = "one two three four five six seven eight nine ten eleven twelve"
    h.append(spark.createDataFrame([(1, 0, text), (2, 0, None)], schema))
    new = [(10, 1, text.upper()), (11, 1, text.replace("six", "666")), (12, 1, "quite another text of some words that nobody has seen"), (13, 1, ""), (14, 1, "quite another text of some words that nobody has seen")]
    assert {r.id for r in h.check(spark.createDataFrame(new, schema)).collect()} == {10, 11, 14}
    h.append(spark.createDataFrame(new[2:3], schema))
    later = spark.createDataFrame([(20, 2, "Quite another text of some words that NOBODY has seen!")], schema)
    assert [(r.id, r.earlier) for r in h.check(later).collect()] == [(20, 12)]


def test_check_reads_only_the_ranges_it_touches(spark, tmp_path):
    """Files of untouched ranges are damaged: a check that opened one would fail."""
    rng = random.Random(3)
    h = history.History(spark, str(tmp_path / "h"), bits=8)
    schema = "id long, batch int, text string"
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(12)) for _ in range(200)]
    h.append(spark.createDataFrame([(i, 0, t) for i, t in enumerate(texts)], schema))
    asked = texts[7].split()
    asked[5] = "changed"
    fresh = spark.createDataFrame([(1000, 1, " ".join(asked)), (1001, 1, texts[9])], schema)
    want = {(1000, 7, 1), (1001, 9, 0)}
    assert {tuple(r) for r in h.check(fresh).collect()} == want
    new = history.unique_texts(history.word_rows(fresh), 8)
    rows = history.pivot_rows(new, h._order(new), bits=8)
    ranges = {r[0] for r in rows.select("range").collect()}
    parts = {r[0] for r in new.select("part").collect()} | {r[0] for r in h._read("texts").where("id = 7").select("part").collect()}
    met = {r[0] for r in rows.select("key").collect()}
    parts |= {r["part"] for r in h._read("ranges").collect() if r["key"] in met}
    damaged = 0
    for name, kept in (("ranges", ranges), ("texts", parts)):
        for f in glob.glob(f"{tmp_path}/h/{name}/*/*.parquet"):
            if int(f.split("/")[-2].split("=")[1]) not in kept:
                damaged += 1
                with open(f, "wb") as out:
                    out.write(b"none")
    spark.catalog.clearCache()
    assert damaged > 200
    assert {tuple(r) for r in h.check(fresh).collect()} == want


def test_hot_pivots_are_split(spark, monkeypatch):
    monkeypatch.setattr(history, "split_join", functools.partial(split_join, small=2, large=3))
    rng = random.Random(2)
    base = [f"w{rng.randrange(10**6)}" for _ in range(20)]
    rows = [(k, 0 if k < 10 else 1, " ".join(base[:10] + [f"y{k}-{j}" for j in range(4 if k % 2 else 2)] + base[10:])) for k in range(40)]
    t = word_table(spark.createDataFrame(rows, "id long, batch int, text string"), "text", ["id", "batch"])
    got = {r.id for r in history.repeats(t.where("batch = 0"), t.where("batch = 1")).collect()}
    w = {k: words(x) for k, _, x in rows}
    want = {k for k in range(10, 40) if any(word_distance(np.array(w[k]), np.array(w[j]), 99) <= int(0.15 * max(len(w[k]), len(w[j])) + 1e-9) for j in range(k))}
    assert got == want


def test_many_near_copies_are_all_found(spark):
    rng = random.Random(1)
    base = [f"w{rng.randrange(10**6)}" for _ in range(60)]
    rows = []
    for k in range(300):
        t = list(base)
        t[rng.randrange(60)] = f"x{k}"
        rows.append((k, 0 if k < 100 else 1, " ".join(t)))
    df = spark.createDataFrame(rows, "id long, batch int, text string")
    t = word_table(df, "text", ["id", "batch"])
    got = history.repeats(t.where("batch = 0"), t.where("batch = 1")).collect()
    assert {r.id for r in got} == set(range(100, 300)) and len(got) == 200


def test_overlaps_against_brute_force(spark, data):
    c = read(data, "corpus_rows")
    w = [(r.row_id, r.split == "train", words(r.text)) for r in c.itertuples()]
    w = [x for x in w if x[2]]
    want = set()
    for k, (a, ta, x) in enumerate(w):
        for b, tb, y in w[k + 1 :]:
            if ta != tb and abs(len(x) - len(y)) <= 0.2 * max(len(x), len(y)) and len(set(x) & set(y)) > 0.6 * len(set(x)) and alike(x, y) >= 0.85:
                want.add((min(a, b), max(a, b)))
    assert {tuple(r) for r in overlap.p6_found(spark, data).collect()} == want


def test_chain_runs_forward():
    a, b = np.array([0, 5, 9, 12]), np.array([1, 6, 3, 13])
    got = chain(a, b)  # two chains are longest
    assert got in ([0, 1, 3], [0, 2, 3])


@given(st.lists(st.integers(0, 3), max_size=12), st.lists(st.integers(0, 3), max_size=12))
@settings(max_examples=200, deadline=None)
def test_chain_never_beats_the_distance(a, b):
    u, v = np.array(a, int), np.array(b, int)
    seeds = np.array([(i << 32) | j for i in range(len(u)) for j in range(len(v)) if u[i] == v[j]], np.int64)
    true = word_distance(u, v, 99)
    assert true <= chain_distance(u, v, seeds, 99) <= max(len(a), len(b), true) + min(len(a), len(b))
    assert chain_distance(u, u, np.array([(i << 32) | i for i in range(len(u))], np.int64), 99) == 0


def test_shared_run_shares_a_fingerprint():
    rng = np.random.default_rng(0)
    for _ in range(50):
        run = rng.integers(0, 2**32, overlap.K + overlap.WINDOW - 1, dtype=np.uint32)
        rows = [np.concatenate([rng.integers(0, 2**32, int(rng.integers(0, 9)), dtype=np.uint32), run, rng.integers(0, 2**32, int(rng.integers(0, 9)), dtype=np.uint32)]).astype("<u4").tobytes() for _ in range(2)]
        r, _, f = overlap.winnow(pd.Series(rows), np.zeros(0, "uint32"), np.zeros(0))
        assert set(f[r == 0]) & set(f[r == 1])


# 4
def test_dominant_script_decides(spark):
    df = spark.createDataFrame(
        [
            (1, "сор и вор"),  # Cyrillic alone stays, though its look is a Latin word's
            (2, "the cop and mother"),
            (3, "мaма мыла раму"),  # a Latin letter in a Cyrillic word
            (4, "мама мыла раму"),
            (5, "the сор and mоthеr"),  # a token of look-alikes in a Latin text, and mixed ones
            (6, "the xоz"),  # no word of the corpus
            (7, "κόσμoς φως"),  # a Latin letter in a Greek word
            (8, "κόσμος φως"),
        ],
        "doc_id long, text string",
    )
    form = {r.doc_id: r.form for r in lookalike.one_form(df, "doc_id", "text").collect()}
    assert form[1] == "сор и вор" and form[3] == form[4] == "мама мыла раму" and form[5] == "the cop and mother" and form[6] == "the xоz" and form[7] == form[8]
    many = spark.createDataFrame([(i, "full wіdth" if i % 3 else "full width") for i in range(90)] + [(100, "width")], "doc_id long, text string")
    got = {tuple(r) for r in lookalike.p4_pairs(lookalike.one_form(many, "doc_id", "text")).collect()}
    assert got == {(i, j) for i in range(90) for j in range(i + 1, 90) if (i % 3 == 0) != (j % 3 == 0)}


def test_look_alikes_become_one_form(spark):
    rows = [(1, "The cat sat"), (2, "The cаt sat"), (3, "Ｔｈｅ cat sat"), (4, "The cat​ sat"), (5, "The cat\u00a0sat"), (6, "the cat sat"), (7, "The cat  sat"), (8, None), (9, "..."), (10, "．．．"), (11, "café x²"), (12, "cafe\u0301 x²"), (13, "cafe x2"), (14, "The cat sat")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {tuple(r) for r in lookalike.p4_pairs(lookalike.one_form(df, "doc_id", "text")).collect()}
    same = (1, 2, 3, 4, 5, 14)
    assert got == {(a, b) for a in same for b in same if a < b and (a, b) != (1, 14)} | {(11, 12)}


def test_foreign_word_stays_where_no_such_word_is_known(spark):
    df = spark.createDataFrame([(1, "кот sat"), (2, "cаt"), (3, "dog")], "doc_id long, text string")
    assert {r.doc_id: r.form for r in lookalike.one_form(df, "doc_id", "text").collect()} == {1: "кот sat", 2: "cаt", 3: "dog"}


# 9
def test_leak_tolerates_changed_words(spark, data):
    items = read(data, "bench_items").head(20)
    rng = random.Random(3)
    docs, want = [], set()
    for k, r in enumerate(items.itertuples()):
        w = r.text.split()
        part = w[: int(len(w) * (0.7 if k % 2 else 0.2))]
        if k % 2:
            part[len(part) // 2] = "zzz"
            want.add((k, r.item_id))
        docs.append((k, " ".join([f"q{rng.randrange(10**6)}" for _ in range(30)] + part + ["the end"])))
    for k, r in enumerate(items.itertuples()):
        want |= {(d, r.item_id) for d, _ in want if words(items.text.iloc[d]) == words(r.text)}
    df = spark.createDataFrame([*docs, (99, None), (98, "")], "doc_id long, text string")
    bench = spark.createDataFrame(items[["item_id", "text"]])
    assert {(r.doc_id, r.item_id) for r in leakage.leaked(df, "doc_id", "text", bench).collect()} == want


def test_blocks_of_items_give_the_same(spark, data, monkeypatch):
    docs, bench = spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/bench_items.parquet")
    whole = {(r.doc_id, r.item_id) for r in leakage.leaked(docs, "doc_id", "text", bench).collect()}
    monkeypatch.setattr(leakage, "BLOCK", 70)
    assert whole == {(r.doc_id, r.item_id) for r in leakage.leaked(docs, "doc_id", "text", bench).collect()}


# 7 and 8
def test_bpe_count_is_exact():
    P = pytest.importorskip("public_tokenizers")
    import tiktoken

    b = tokens.BpeCounter.from_file(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    e = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=b.ranks, special_tokens={})
    rng = random.Random(5)
    texts = ["".join(rng.choice("aeiou  tnshr.,é東\n0123ABকি") for _ in range(rng.randrange(200))) for _ in range(200)]
    assert [b.count(t) for t in texts] == [len(e.encode_ordinary(t)) for t in texts]


def test_piece_count_is_the_best_path(data):
    v = read(data, "vocab_pieces")
    c = tokens.PieceCounter(list(zip(v.piece, v.score, v.kind, strict=True)))
    score = {p: s for p, s, k in zip(v.piece, v.score, v.kind, strict=True) if k == "normal"}

    def brute(w):
        best = [(0.0, 0)]
        for e in range(1, len(w) + 1):
            cands = [(best[s][0] + score[w[s:e]], -best[s][1] - 1) for s in range(e) if w[s:e] in score]
            if w[e - 1] not in score:
                n = len(w[e - 1].encode())
                cands.append((best[e - 1][0] - 20.0 * n, -best[e - 1][1] - n))
            top = max(cands, key=lambda x: (round(x[0], 9), x[1]))
            best.append((top[0], -top[1]))
        return best[-1][1]

    for w in {w for t in read(data, "documents").text.dropna().head(40) for w in t.split()[:40]}:
        assert c.word(w) == brute("▁" + w)
    assert c.count(None) == c.count("") == c.count(" \n") == 0


def test_containers_hold_what_they_may(spark):
    rng = random.Random(2)
    sizes = spark.createDataFrame([(i, rng.choice((0, 1, 30, 200, 511, 512, 700, 5000))) for i in range(400)], "doc_id long, tokens long")
    packs = spark.createDataFrame([(512, 3, 2), (1024, 3, 2)], "seq_len int, pad_id int, eos_id int")
    items = packing.pieces(sizes, packs)
    rows = packing.packed(items, max_documents=40, attention_share=1.0).toPandas()
    for cap, g in rows.groupby("seq_len"):
        per = g.groupby("container")
        assert (per.tokens.sum() <= cap).all() and (per.size() <= 40).all() and (per.tokens.apply(lambda x: (x**2).sum()) <= cap * cap).all()
    want = {(r.seq_len, r.doc_id, r.part): r.tokens for r in items.collect()}
    assert {(r.seq_len, r.doc_id, r.part): r.tokens for r in rows.itertuples()} == want and len(rows) == len(want)
    whole = rows.groupby(["seq_len", "doc_id"]).tokens.sum()
    assert all(whole[(512, r.doc_id)] == r.tokens + 1 for r in sizes.collect() if r.tokens)


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_best_fit_fills_well(rule):
    rng = np.random.default_rng(1)
    size = rng.integers(1, 400, 1500)
    got = packing.best_fit(size, 1024, 128, 1024.0**2, rule)
    load = np.bincount(got, size)
    assert load.max() <= 1024 and len(load) <= 1.03 * np.ceil(size.sum() / 1024) + 1


# 3
def test_held_out_language_accuracy(data):
    s = read(data, "lang_samples")
    m = language.Model(list(zip(s.text[::2], s.language[::2], strict=True)))
    got = [(language.LANGUAGES[x], lang) for t, lang in zip(s.text[1::2], s.language[1::2], strict=True) for own in language.labelled([t], m) for _, _, x, _, n in own if n > 2]
    assert sum(a == b for a, b in got) / len(got) > 0.98


def test_labels_name_languages():
    assert [language.named(x) for x in ("MNI", "mni-Mtei", "Bengali", "en-IN", "hin", "fr", "", None, "??", "N/A", "und")] == ["mni", "mni", "bn", "en", "hi", "other", None, None, None, None, None]


def test_sentence_offsets():
    t = "One two. Three!\n4. four ২।five"
    assert "".join(t[a:b] for a, b in sentences(t)).replace(" ", "") == t.replace(" ", "")


# 1, 2, 10
def test_pairs(data):
    s = read(data, "lang_samples")
    both = list(zip(s.text, s.language, strict=True))
    m, c = language.Model(both), pairs.trained(both)
    ask = "Describe the old mill near the river."
    text = "The old mill stands near the river. It was repaired before the rains came to the valley."
    rows = [(ask, None, text), (ask, "", None), (ask, "", " n/a "), (ask, "", "I'm sorry, but I cannot help with this request."), (ask, "", ask), (ask, "", text[:-20]), (ask, "", both[-1][0] if both[-1][1] == "hi" else next(t for t, x in both if x == "hi")), ("Classify the text as news or story.", text, "story"), ("Copy the input without any change.", text, text), (None, None, None)]
    got = pairs.defects_of(*(list(x) for x in zip(*rows, strict=True)), ["en"] * len(rows), m, c)
    assert got == [None, "empty", "empty", "refusal", "copied", "truncated", "other_language", None, None, "empty"]


def test_page_lines(data):
    assert [ocr.number_of(x) for x in ("[41]", "- 12 -", "Page 7", "১৩৬.", "ix", "1 2 7", "1 apple", "")] == [41, 12, 7, 136, 9, 127, None, None]
    assert ocr.ends_inside("repa-") and not ocr.ends_inside("axle -") and not ocr.ends_inside("end.")
    assert ocr.odd_shape("s0mbre") and ocr.odd_shape("রাকc") and not ocr.odd_shape("sombre") and not ocr.odd_shape("3rd")
    assert ocr.folded("vveek") == ocr.folded("week") and ocr.folded("thc") == ocr.folded("the")


def test_line_states_held_out(data):
    s = read(data, "lang_samples").text.tolist()
    crf = ocr.fit(ocr.training(s[::2], 200, 1), ocr.LINES, ocr.SIZE, rounds=40, rate=0.2, decay=1e-3)
    test = ocr.training(s[1::2], 60, 2)
    got = crf.decode([f for x, _ in test for f in x], np.array([len(x) for x, _ in test]))
    want = np.array([y for _, l in test for y in l])
    assert (got == want).mean() > 0.97


def test_pii_spans_and_round_trip(data):
    n, s = read(data, "name_parts"), read(data, "lang_samples")
    crf, listed = pii.trained(list(zip(n.name_part, n.kind, n.script, strict=True)), list(zip(s.text, s.script, strict=True)))
    g = n[(n.script == "latin") & (n.kind == "given")].name_part.iloc[3]
    f = n[(n.script == "latin") & (n.kind == "family")].name_part.iloc[5]
    text = f"The mill was signed by Dr. {g} {f}. Phone: +91 73096 93268\nEmail: {g.lower()}.mill@reedmail.test\nAddress: House No. 195, Louhom Road, Thomchom 795216\nThe Aadhaar 4073-8825-4938 belongs to the owner. Order 3361371252 for the mill was late.\n"
    spans = pii.spans_of([text, None, ""], crf, listed)
    assert [(k, text[a:b]) for a, b, k in spans[0]] == [("name", f"{g} {f}"), ("phone", "+91 73096 93268"), ("email", f"{g.lower()}.mill@reedmail.test"), ("address", "House No. 195, Louhom Road, Thomchom 795216"), ("id_number", "4073-8825-4938")]
    assert spans[1:] == [[], []]
    hidden = pii.masked(text, spans[0])
    back = hidden
    for a, b, k in spans[0]:
        back = back.replace(f"<{k.upper()}>", text[a:b], 1)
    assert back == text and pii.masked(None, []) is None


def test_a_page_given_again_counts_its_words_once(spark):
    texts = [f"line {'abcdefghijkl'[i] * 2} of the mountain" for i in range(12)] + ["a view of the rnountain"] * 50
    pages = spark.createDataFrame([(i, f"d{i}", 1, t) for i, t in enumerate(texts)], "page_id long, document_id string, page_no int, text string")
    bad = ocr.clues(pages, spark.createDataFrame([], "text string"))[1].where("right is not null").collect()
    assert {(r.page_id, r.word, r.right) for r in bad} == {(i, "rnountain", "mountain") for i in range(12, 62)}


@pytest.fixture(scope="module")
def field(data):
    """The field, trained on two thirds of the samples and of the names; the rest is held out."""
    n, t = read(data, "name_parts"), read(data, "lang_samples")
    told, kept = n[n.part_id % 3 > 0], n[n.part_id % 3 == 0]
    crf, tokens = pii.trained(list(zip(told.name_part, told.kind, told.script, strict=True)), list(zip(t.text[t.sample_id % 3 > 0], t.script[t.sample_id % 3 > 0], strict=True)))
    return crf, tokens, told, kept, t[t.sample_id % 3 == 0]


def test_lines_left_out_hold_nothing(field, data):
    """What the bound leaves out, Viterbi over every token tags O."""
    crf, tokens, *_ = field
    lines = [x for t in read(data, "documents").text.dropna() for x in t.split("\n") if x.strip()]
    feats, length = pii.features(lines, tokens)
    u = crf.scores(feats)
    tags, row = crf.viterbi(u, length), np.repeat(np.arange(len(lines)), length)
    settled = crf.settled(u, length)
    assert settled.mean() > 0.2 and not tags[settled[row]].any()


HELD_OUT = (  # wordings that the training never uses: values stand between words of their own
    ("Kindly ring {P} once you have arrived in town.", "phone"), ("My new number since Monday is {P}, so delete the old one.", "phone"), ("Complaints may be sent to {E} until Friday.", "email"), ("She asked whether {E} still works.", "email"),
    ("Deliver the parcels to {A} before noon.", "address"), ("Our branch has shifted to {A} since last year.", "address"), ("The applicant produced Aadhaar {I} at the counter.", "id_number"), ("Copies of passport {J} were attached to the claim.", "id_number"),
    ("Yesterday {N} sang for us.", "name"), ("The prize went to {N} after a long wait.", "name"), ("According to Dr. {N} the well is safe.", "name"), ("দয়া করে {P} নম্বরে জানান।", "phone"), ("कृपया {P} पर सूचित करें।", "phone"), ("আপনার চিঠি {E} এ পাঠাবেন।", "email"),
)


def test_held_out_wordings(field):
    crf, tokens, told, kept, _ = field
    rng = np.random.default_rng(4)
    latin = [n[n.script == "latin"].name_part.tolist() for n in (told, kept)]
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    form = lambda f: pii.filled(f, "latin", rng, latin[1], ["stone", "hill"])
    texts, want = [], []
    for _ in range(20):
        for sentence, kind in HELD_OUT:
            value = {"P": lambda: form(pick(pii.PHONES)), "E": lambda: form(pick(pii.MAILS)), "A": lambda: form("".join(pick(x) for x in pii.STREETS["latin"])), "I": lambda: form(pick(("{d4} {d4} {d4}", "{d12}", "{d4}-{d4}-{d4}"))), "J": lambda: form("{u1}{d7}"), "N": lambda: f"{pick(latin[0])} {pick(latin[1])}"}[re.search(r"\{(\w)\}", sentence)[1]]()
            texts.append(re.sub(r"\{\w\}", lambda m: value, sentence))  # noqa: B023
            want.append((kind, value))
    got = [{(k, t[a:b]) for a, b, k in own} for t, own in zip(texts, pii.spans_of(texts, crf, tokens), strict=True)]
    hit = [w in g for w, g in zip(want, got, strict=True)]
    by = pd.DataFrame({"kind": [k for k, _ in want], "hit": hit}).groupby("kind").hit.mean()
    print(by.to_dict(), sum(map(len, got)), len(want), [(t, g) for t, w, g in zip(texts, want, got, strict=True) if w not in g and w[0] in ("id_number", "name")][:14])
    assert np.mean(hit) >= 0.85 and by.min() >= 0.7 and sum(map(len, got)) <= 1.1 * len(want)


def test_plain_sentences_hold_nothing(field):
    crf, tokens, _, _, rest = field
    got = pii.spans_of(rest.text.tolist(), crf, tokens)
    assert sum(map(len, got)) <= 0.02 * len(rest)


def test_near_texts_of_any_length_share_seeds(spark):
    """Random texts of 4 to 60 words and edited copies: exactly the pairs of brute force, and those of problem 5."""
    rng = random.Random(8)
    rows = []
    for i in range(260):
        t = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(4, 61) if i % 3 else rng.randrange(4, 20))]
        rows.append((len(rows), True, " ".join(t)))
        for _ in range(2):
            c = list(t)
            for _ in range(rng.randrange(0, int(0.2 * len(t)) + 2)):
                at = rng.randrange(len(c))
                c[at : at + 1] = rng.choice(([], [f"x{rng.randrange(400)}"], [c[at], f"x{rng.randrange(400)}"])) if len(c) > 3 else [c[at]]
            rows.append((len(rows), False, " ".join(c)))
    w = [np.array([hash(x) for x in words(t)]) for _, _, t in rows]
    want = set()
    for i, (_, ti, _) in enumerate(rows):
        for j in range(i):
            limit = int(0.15 * max(len(w[i]), len(w[j])) + 1e-9)
            if rows[j][1] != ti and word_distance(w[i], w[j], limit) <= limit:
                want.add((j, i))
    t = word_table(spark.createDataFrame(rows, "id long, train boolean, text string"), "text", ["id", "train"])
    classes, links = overlap.overlaps(t)
    got = {tuple(r) for r in overlap.row_pairs(classes, links).collect()}
    assert got == want and len(want) > 200


def test_very_long_texts_may_overlap(spark):
    a = [f"w{i}" for i in range(40_000)]
    b = list(a)
    b[20_000] = "x"
    t = word_table(spark.createDataFrame([(1, True, " ".join(a)), (2, False, " ".join(b))], "id long, train boolean, text string"), "text", ["id", "train"])
    classes, links = overlap.overlaps(t)
    assert [tuple(r) for r in overlap.row_pairs(classes, links).collect()] == [(1, 2)]


def test_short_items_and_ids_of_several_texts(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "so the green heron waits"), (2, "green tea"), (3, "Heron!"), (4, "one two three four five six seven eight"), (5, "nine ten eleven twelve thirteen fourteen")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "green heron"), (2, "heron"), (3, "one two three four five six seven eight"), (3, "nine ten eleven twelve thirteen fourteen"), (3, "nine ten eleven twelve thirteen fourteen")], "item_id long, text string")
    for block in (1, 2, 100):
        monkeypatch.setattr(leakage, "BLOCK", block)
        assert sorted((r.doc_id, r.item_id) for r in leakage.leaked(docs, "doc_id", "text", bench).collect()) == [(1, 1), (1, 2), (3, 2), (4, 3), (5, 3)]


def test_each_capacity_decides():
    size = np.array([60, 40, 40, 30, 10, 5, 5, 5])
    free = packing.best_fit(size, 100, 99, 1e9, "norm")
    assert len(set(free)) == 2  # tokens alone: 195 in two containers
    few = packing.best_fit(size, 100, 2, 1e9, "norm")
    assert np.bincount(few).max() == 2 and len(set(few)) == 4
    dear = packing.best_fit(size, 100, 99, 0.45 * 100**2, "norm")
    assert all((size[dear == c] ** 2).sum() <= 4500 for c in set(dear))
    assert any((size[free == c] ** 2).sum() > 4500 for c in set(free))
    alone = packing.best_fit(np.array([98, 2, 50, 50]), 100, 99, 0.9 * 100**2, "norm")
    assert (alone == alone[0]).sum() == 1 and alone[2] == alone[3]


def test_paragraphs_go_on_over_any_page(spark, data, monkeypatch):
    """One sentence over many pages is one paragraph, whichever blocks these are numbered in; pages without an id stay apart."""
    samples = spark.read.parquet(f"{data}/lang_samples.parquet")
    things = "mill barn gate wall ford kiln shed loft dock yard pier well".split()

    def page(i):
        a, b, c = (things[(i * k + k) % 12] for k in (1, 5, 7))
        return f"The old {a} by the river near the {b} was sold to the\nmiller of the next village {i} and his two sons, who\nkept the {c} for many years and then went on to say"

    rows = [(i, "d", i, page(i)) for i in range(1, 8)] + [(20, None, 3, page(9)), (21, None, 3, page(10)), (22, "e", None, page(11)), (23, "e", None, page(12))]
    pages = spark.createDataFrame(rows, "page_id long, document_id string, page_no int, text string")
    got = {}
    for block in (2, 3, 512):
        monkeypatch.setattr(ocr, "BLOCK", block)
        got[block] = sorted(tuple(map(str, r)) for r in ocr.paragraphs(pages, samples).collect())
    assert got[2] == got[3] == got[512]
    assert len([r for r in got[2] if r[0] == "d"]) == 1 and len([r for r in got[2] if r[0] == "None"]) == 2 and len([r for r in got[2] if r[0] == "e"]) == 2


REFUSED = (  # wordings of their own, none of which the training puts together
    "This isn't a subject I'm comfortable getting into.", "I'm going to leave that question alone.", "My maker has told me not to speak about that.", "There is nothing I may tell you on this.", "I do not possess the knowledge you are asking for.",
    "You had better ask a doctor about this, not me.", "Apologies, I was not built to reply to such requests.", "আমি এ কথা জানাতে পারছি না, দুঃখিত।", "मुझे खेद है, मैं इसका उत्तर नहीं जानता।", "I really should not be the one to answer your question.",
)
SOUND = (
    "The river rises in the hills and is not deep in winter.", "Nobody could help the farmer, so he sold the cart.", "The teacher refused to answer and went home.", "They do not know who built the tower.", "He was not allowed to open the gate, the guard said.",
    "The museum has nothing older than this bell.", "Please note that the market opens at six and never closes before nine.", "The clerk declined the request because the form was wrong.", "Without rain the fields give no rice at all.", "A model of the bridge stands outside the hall.",
)


def test_held_out_refusals(spark, data):
    t = read(data, "lang_samples")
    crf = pairs.trained(list(zip(t.text, t.language, strict=True)))
    model = language.fitted(spark.createDataFrame(t))
    ask = lambda texts: pairs.defects_of(["Describe the town and its people."] * len(texts), [None] * len(texts), list(texts), ["en"] * len(texts), model, crf)
    refused, sound = ask(REFUSED), ask(SOUND)
    print(refused, sound)
    assert sum(x == "refusal" for x in refused) >= 7 and sum(x == "refusal" for x in sound) <= 1
