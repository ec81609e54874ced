"""Column functions over hand-made vectors, at least one per branch."""

import pytest
from pyspark.sql import functions as F

from tessera.functions import chat, metrics, quality, script, text


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    ("value", "want"),
    [(None, None), ("", ""), ("ড়", "ড়"), ("a​b﻿", "ab"), ("a\x07b\x85c", "abc"), ("“q” ‘r’ `", "\"q\" 'r' '"), ("wait ....  what ?", "wait... what?"), ("a‌b", "a‌b")],
)
def test_normalise(spark, value, want):
    assert one(spark, value, text.normalise) == want


@pytest.mark.parametrize(
    ("value", "want"),
    [
        (None, None), ("<p>Hi <b>you</b></p>", "Hi you"), ("# Head\n**bold** [link](http://x.y) `c`", "Head\nbold link c"), ("see https://a.b/c, or www.d.e.", "see , or ."), ("mail a.b@c.org now", "mail now"), ("કx", "x"), ("\t a \n\n  b  c ", "a\nb c"), ("(iv) text ----- end", "text end"), ("<!DOCTYPE html>x", "x"),
    ],
)
def test_clean(spark, value, want):
    assert one(spark, value, text.clean) == want


@pytest.mark.parametrize(
    ("value", "want"),
    [
        (None, "empty"), ("   ", "empty"), ("a�", "corrupted_unicode"), ("!!! ।", "only_punctuation"), ("১২৩ 45", "only_numbers"), ("aaaaa", "repeated_chars"), ("aaaa", None), ("\n\n\n\n\n\nab", None), ("কখ abc", "repeated_chars"), ("কখগঘঙচছ ab", None), ("fine text", None),
    ],
)
def test_reject_reason(spark, value, want):
    assert one(spark, value, quality.reject_reason) == want


@pytest.mark.parametrize(("value", "want"), [(None, 0.0), ("", 0.0), ("two words", 0.2), ("a b ?!?!?!", 0.3), ("a b c", 0.35), ("one two three", 0.85), ("word " * 15, 0.95), ("কি কি কি", 0.3)])
def test_quality(spark, value, want):
    assert one(spark, value, quality.quality_score) == pytest.approx(want)


@pytest.mark.parametrize(("value", "want"), [(None, "unknown"), ("12", "unknown"), ("ꯀꯀক", "mixed"), ("aaক", "mixed"), ("aaaaaaaaaক", "latin"), ("aক", "mixed"), ("কখ", "bengali")])
def test_script(spark, value, want):
    assert one(spark, value, lambda c: script.dominant(c)["script"]) == want


def test_mayek(spark):
    assert one(spark, "আমৃড়ক১x", script.to_mayek) == "ꯑꯥꯃ꯭ꯔꯤꯔꯀ꯱x"
    assert one(spark, "latin only", script.transliterated) == "latin only"


def test_masking(spark):
    got = one(spark, "a.b@c.org 9876543210 10.0.0.1 ABCDE1234F 1234-5678-9012 https://x.y/z", quality.masked)
    assert got["text"] == "<EMAIL> <PHONE> <IP_ADDRESS> <PAN_CARD> <AADHAAR> <URL>"
    assert got["counts"] == dict.fromkeys(("email", "phone", "ip_address", "pan_card", "aadhaar", "url"), 1)
    assert one(spark, "x a.b@c.org y", lambda c: quality.masked(c, remove=True))["text"] == "x y"
    assert one(spark, None, quality.masked)["text"] is None


def test_blocked(spark):
    assert one(spark, "Go KILL Yourself", quality.blocked_term) == "kill yourself" and one(spark, "kind", quality.blocked_term) is None


def test_category(spark):
    assert [one(spark, v, text.category) for v in (None, "", "Unknown", "School Textbook ", "poems")] == ["unknown", "unknown", "unknown", "textbook", "poems"]


def test_conversation(spark):
    df = spark.createDataFrame([([{"from": "human", "value": "hi"}, {"from": "gpt", "value": "yo"}, {"from": "x", "value": "?"}],), ([{"from": "gpt", "value": "yo"}],), (None,)], "t array<struct<`from`: string, value: string>>")
    rows = [r.m for r in df.select(chat.conversation(F.col("t")).alias("m")).collect()]
    assert [m.role for m in rows[0]] == ["system", "user", "assistant"] and rows[1] is None and rows[2] is None
    got = df.limit(1).select(chat.rendered(chat.conversation(F.col("t"), prompt=None), "gemma", True).alias("m")).first().m
    assert got == "<start_of_turn>user\nhi<end_of_turn>\n<start_of_turn>model\nyo<end_of_turn>\n<start_of_turn>model\n"


def test_metrics(spark):
    df = spark.createDataFrame([("the cat sat", "the cat ran", 1.0), (None, "x", float("nan")), ("", "", 3.0)], "p string, r string, l double")
    p, r = F.col("p"), F.col("r")
    row = df.select(metrics.overlap_f1(p, r).alias("f"), metrics.token_set_f1(p, r).alias("t"), metrics.char_fscore(p, r).alias("c")).collect()
    assert row[0].f == pytest.approx(2 / 3) and row[0].t == pytest.approx(2 / 3) and row[1].f == row[2].c == 0.0 and 0 < row[0].c < 100
    agg = df.agg(metrics.unigram_precision(p, r).alias("u"), metrics.perplexity(F.col("l")).alias("x")).first()
    assert agg.u == pytest.approx(200 / 3) and agg.x == pytest.approx(2.718281828**2)


def test_pair_score(spark):
    df = spark.createDataFrame([("a b c d", "x"), ("a b c d e", "x"), ("a", "w x y z"), ("", "x"), (None, None), ("a b c d e", "u v w x y z")], "a string, b string")
    assert [r.s for r in df.select(metrics.pair_score(F.col("a"), F.col("b")).alias("s")).collect()] == [0.76, 0.2, 0.39, 0.0, 0.0, 0.95]


def test_templates_and_formats(spark):
    from tessera.operators import chunks, tokenizers

    df = spark.sql("select array(struct('user' as role, 'hi' as content), struct('assistant' as role, 'yo' as content)) as m")
    got = {t: df.select(chat.rendered(F.col("m"), t).alias("x")).first().x for t in chat.TEMPLATES}
    assert got["mistral"] == "[INST] hi [/INST] yo</s>"
    assert got["generic"] == "<user>\nhi\n<assistant>\nyo\n"
    assert df.select(chat.plainly(F.col("m")).alias("x")).first().x == "<user>\nhi\n<assistant>\nyo"
    steps = spark.createDataFrame([(22, 10, True), (30, 10, True), (35, 10, True), (50, 10, True), (51, 10, True), (9, 3, False), (0, 0, True)], "t int, w int, i boolean")
    assert [r[0] for r in steps.select(tokenizers.boundary_quality(F.col("t"), F.col("w"), F.col("i"))).collect()] == [1.0, 0.9, 0.8, 0.6, 0.35, 0.85, 1.0]
    small = chunks.task_split(spark.range(2), "id")
    assert small.count() == 6 and small.groupBy("id").count().where("count = 3").count() == 2
    assert {r.split: r["count"] for r in chunks.task_split(spark.range(3), "id").groupBy("split").count().collect()} == {"train": 2, "test": 1}
    sizes = {r.split: r["count"] for r in chunks.task_split(spark.range(40), "id").groupBy("split").count().collect()}
    assert sizes == {"train": 36, "validation": 2, "test": 2}
    one = chunks.fingerprint(spark.sql("select sha2(cast(id % 7 as string), 256) as h from range(50)"), "h").first()
    two = chunks.fingerprint(spark.sql("select sha2(cast(id % 7 as string), 256) as h from range(50) order by -id"), "h").first()
    three = chunks.fingerprint(spark.sql("select sha2(cast(id % 7 as string), 256) as h from range(49)"), "h").first()
    assert one == two and one.fingerprint != three.fingerprint and one.rows == 50
