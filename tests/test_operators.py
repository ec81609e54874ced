"""Relational operators against sequential models, invariants, sources, sinks and streams."""

import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.operators import chunks, dedup, packing, sampling, stats
from tessera.plans import presets
from tessera.plans.shared import shared_dir
from tessera.sources import readers, sinks
from tessera.streaming import jobs


@given(st.text("abc", max_size=12), st.text("abc", max_size=12))
@settings(max_examples=200, deadline=None)
def test_lcs(a, b):
    d = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            d[i + 1][j + 1] = d[i][j] + 1 if x == y else max(d[i][j + 1], d[i + 1][j])
    assert dedup.lcs_ratio(a, b) == pytest.approx(200 * d[-1][-1] / (len(a) + len(b)) if a or b else 100)


def test_greedy_keeps_in_order(spark):
    links = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (10, 11)], "a long, b long")  # 1~2~3~4: 1 and 3 stay
    assert {(r.id, r.kept_by) for r in dedup.greedy(links, shared_dir(spark)).collect()} == {(2, 1), (4, 3), (11, 10)}
    rng = random.Random(4)
    pairs = {tuple(sorted(rng.sample(range(60), 2))) for _ in range(90)}
    gone: set[int] = set()
    for b in range(60):
        if any((a, b) in pairs and a not in gone for a in range(b)):
            gone.add(b)
    assert {r.id for r in dedup.greedy(spark.createDataFrame(sorted(pairs), "a long, b long"), shared_dir(spark)).collect()} == gone


def test_fuzzy_and_minhash_links(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    rows = []
    for k in range(12):
        t = [word() for _ in range(40)]
        rows += [(3 * k, " ".join(t)), (3 * k + 1, " ".join([*t[:-1], word()])), (3 * k + 2, " ".join(t).upper() + " ")]
    df = spark.createDataFrame([*rows, (900, None), (901, "")], "doc_id long, text string")
    want = {(3 * k, 3 * k + 1) for k in range(12)}
    assert {tuple(r) for r in dedup.fuzzy_links(df, "text", "doc_id").collect()} == want
    links = {tuple(r) for r in dedup.minhash_links(dedup.signatures(df, "text", "doc_id"), "doc_id").collect()}
    assert {(3 * k, 3 * k + 2) for k in range(12)} <= links and links <= want | {(a, b + 1) for a, b in want} | {(b, b + 1) for _, b in want}


def test_copies_of_a_near_duplicate_go(spark):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(60)]
    kept, near = " ".join(words), " ".join([*words[:-1], "zzzzzz"])
    df = spark.createDataFrame([(1, kept), (2, near), (3, near.upper()), (4, near), (5, kept), (6, "another text altogether")], "doc_id long, text string")
    gone = dedup.minhash_gone(dedup.signatures(df, "text", "doc_id"), "doc_id", shared_dir(spark))
    assert {(r.id, r.kept_by) for r in gone.collect()} == {(i, 1) for i in (2, 3, 4, 5)}


def test_fuzzy_window_counts_kept_rows(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    families = [[word() for _ in range(30)] for _ in range(8)]
    rows = []
    for i in range(150):
        if rows and rng.random() < 0.2:
            t = rng.choice(rows)[1].upper()
        elif rng.random() < 0.6:
            t = list(rng.choice(families[: 1 + i // 15]))
            t[rng.randrange(30)] = word()
            t = " ".join(t)
        else:
            t = rng.choice([" ".join(word() for _ in range(30)), "  "])
        rows.append((i, t))
    seen, want = {}, {}  # the sequential rule: keys of kept rows, the last 5 of them compared
    for i, t in rows:
        key = " ".join(t.lower().split())
        by = [seen[key]] if key in seen else [seen[k] for k in list(seen)[-5:] if dedup.lcs_ratio(k, key) >= 90]
        if by:
            want[i] = by[0]
        else:
            seen[key] = i
    got = dedup.fuzzy_gone(spark.createDataFrame(rows, "doc_id long, text string"), "text", "doc_id", shared_dir(spark), window=5, block=16)
    assert {r.id: r.kept_by for r in got.collect()} == want


def test_first_rows_and_history(spark):
    df = spark.createDataFrame([(1, "A b"), (2, "a  B"), (3, None), (4, None), (5, "A b")], "doc_id long, text string")
    assert {r.doc_id for r in dedup.exact(df).collect()} == {1, 2, 3}
    assert {r.doc_id for r in dedup.normalised(df).collect()} == {1, 3}
    assert {r.doc_id for r in dedup.against(df, spark.createDataFrame([(" A b ",)], "text string")).collect()} == {2, 3, 4}


@pytest.mark.parametrize(("n", "want"), [(0, 0), (5, 1), (10, 1), (11, 2), (18, 2), (19, 3)])
def test_chunk_counts(spark, n, want):
    df = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(n)))], "doc_id long, text string")
    rows = chunks.chunked(df, "text", 10, 2).orderBy("chunk_id").collect()
    assert len(rows) == want and all(r.total_chunks == want for r in rows)
    for x, y in zip(rows, rows[1:], strict=False):
        assert x.text.split()[-2:] == y.text.split()[:2]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 20, 137])
def test_split_sizes(spark, n):
    got = {r.split: r.n for r in chunks.split_rows(spark.range(n).withColumnRenamed("id", "doc_id"), "doc_id", 0.8, 0.1, 0.1).groupBy("split").agg(F.count("*").alias("n")).collect()}
    k = -(-n // 10) if n >= 3 else 0
    assert got == {s: v for s, v in (("train", n - 2 * k), ("validation", k), ("test", k)) if v}


def test_packing_conserves_tokens(spark):
    rng = random.Random(1)
    docs = [(i, [rng.randrange(100) for _ in range(rng.choice((0, 1, 5, 16, 40)))]) for i in range(30)]
    df = spark.createDataFrame(docs, "doc_id long, ids array<int>")
    rows = packing.packed(df, "doc_id", "ids", 16, -1).orderBy("block").collect()
    flat = [t for r in rows for t, m in zip(r.input_ids, r.attention_mask, strict=True) if m]
    assert flat == [t for _, ids in docs for t in ids] and all(len(r.input_ids) == 16 for r in rows)
    assert len(packing.packed(df, "doc_id", "ids", 16, -1, drop_rest=True).collect()) == len(flat) // 16
    assert packing.packed(df.limit(0), "doc_id", "ids", 16, -1).collect() == []


def test_percentiles(spark):
    one = stats.percentiles(spark.createDataFrame([(7,)], "v int"), "v").first()
    ten = stats.percentiles(spark.createDataFrame([(i,) for i in range(10)], "v int"), "v").first()
    assert tuple(one) == (7, 7, 7, 7, 7) and tuple(ten) == (1, 5, 9, 9, 9)


def test_probabilities(spark):
    df = spark.createDataFrame([("a", 1.0, ["mni"]), ("b", None, ["en"])], "name string, w double, l array<string>")
    got = {r.name: r.p for r in sampling.probabilities(df, F.col("w"), "l", temperature=1.0).collect()}
    assert got["a"] == pytest.approx(1 / 1.1)
    assert {r.p for r in sampling.probabilities(df.withColumn("w", F.lit(0.0)), F.col("w"), "l").collect()} == {0.5}


def test_readers_and_sinks(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"text": " long enough text ", "quality": 0}\nbad\n\n{"text": "short"}\n')
    assert [r.text for r in readers.json_lines(spark, str(tmp_path / "a.jsonl"), "text string, quality double").collect()] == ["long enough text"]
    (tmp_path / "b.tsv").write_text("first sentence here\tenglish\n\nonly one column\n")
    assert [(r.line, r.english_parallel) for r in readers.parallel_lines(spark, str(tmp_path / "b.tsv")).orderBy("line").collect()] == [(1, "english"), (3, None)]
    gates = spark.createDataFrame([(None, None), (40.0, 90.0), (60.0, 0.0), (60.0, 80.0)], "ocr_confidence double, quality double")
    assert sorted(r.quality_score for r in readers.scan_gates(gates).collect()) == [0.8, 1.0]
    df = spark.createDataFrame([("x", "mni", "meitei", "s", "train"), ("y", "en", "latin", "s", "test")], "text string, language string, script string, source string, split string")
    for kind in sinks.FORMATS:
        sinks.export(df, str(tmp_path / kind), kind, split="split")
    with pytest.raises(ValueError, match="unknown format"):
        sinks.export(df, str(tmp_path / "z"), "xml")
    for s in ("train", "test"):
        df.where(F.col("split") == s).drop("split").write.parquet(str(tmp_path / f"snap/{s}"))
    assert {r.split for r in readers.split_dirs(spark, str(tmp_path / "snap")).collect()} == {"train", "test"}
    files = sinks.verify(spark, str(tmp_path / "snap"))
    made = sinks.manifest(files, str(tmp_path / "manifest.json"), version="v1")
    assert json.loads((tmp_path / "manifest.json").read_text())["version"] == "v1" and all(f["ok"] and len(f["sha256"]) == 64 for f in made["files"])
    with pytest.raises(ValueError, match="columns missing"):
        sinks.verify(spark, str(tmp_path / "snap"), ("nothing",))
    assert readers.read(spark, "x", "odd") is None
    assert sinks.markdown(df.select("text"), "T").startswith("# T")


def test_arrow_and_logs(spark, tmp_path):
    import pyarrow as pa

    t = pa.table({"text": ["one", "two"], "n": [1, 2]})
    with pa.OSFile(str(tmp_path / "a.arrow"), "wb") as f, pa.ipc.new_stream(f, t.schema) as w:
        w.write_table(t)
    assert {(r.text, r.n) for r in readers.arrow(spark, str(tmp_path)).collect()} == {("one", 1), ("two", 2)}
    (tmp_path / "state.json").write_text(json.dumps({"log_history": [{"step": 1, "loss": 2.0}, {"step": 2, "eval_loss": 1.5}]}))
    assert [r.step for r in readers.trainer_log(spark, str(tmp_path / "state.json")).orderBy("step").collect()] == [1, 2]
    (tmp_path / "v.vec").write_text("2 3\nab 1 2 3\ncd 4 5 6\n")
    assert [r.word for r in readers.vectors(spark, str(tmp_path / "v.vec")).orderBy("line").collect()] == ["ab", "cd"]


def test_streams(spark, tmp_path):
    src = str(tmp_path / "in")
    rows = [("2024-01-01 00:00:00", "Same text"), ("2024-01-01 00:01:00", "same  TEXT"), ("2024-01-01 00:02:00", "other")]
    spark.createDataFrame(rows, "t string, text string").select(F.to_timestamp("t").alias("t"), "text").write.parquet(src)
    stream = lambda: spark.readStream.schema("t timestamp, text string").parquet(src)
    q = jobs.first_seen(stream(), "text", "t").writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c1")).option("path", str(tmp_path / "out")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
    for _ in range(2):  # a second run has nothing left to do
        jobs.write_shards(stream(), str(tmp_path / "sh"), str(tmp_path / "c2"), 2).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "sh")).count() == 3
    q = jobs.windowed(stream(), "t", ["text"]).writeStream.format("memory").queryName("w").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("w").count() == 3


def test_corpus_drops_near_duplicates_and_repeated_chunks(spark):
    rng = random.Random(10)
    text = lambda n: ["".join(rng.sample("abcdefghijklmnop", 6)) for _ in range(n)]
    first, head = text(60), text(2048 - 60)
    shifted = [*first[30:], *first[:30]]  # the same 5-grams but for the seam: MinHash sees it, the fuzzy ratio doesn't
    rows = [first, [*first[:-1], "zyxwvu"], shifted, [*head, *text(60), *first[:5]], [*head, *text(60), *text(2500)]]
    rows[4][: 2048] = rows[3][: 2048]  # one chunk in common
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(rows)], "doc_id long, text string")
    kept = {(r.doc_id, r.chunk_id) for r in presets.corpus(df).collect()}
    assert kept == {(0, 0), (3, 0), (3, 1), (4, 1), (4, 2)}
    assert {r.reason: r.n for r in presets.funnel(df).collect()} == {None: 3, "duplicate": 1, "near_duplicate": 1}


def test_presets(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    n = {r.reason: r.n for r in presets.funnel(docs).collect()}
    assert sum(n.values()) == docs.count() and n[None] > 0
    out = presets.corpus(docs)
    assert 0 < out.select("doc_id").distinct().count() <= n[None] and out.where("total_chunks < 1").count() == 0
    assert presets.corpus(docs.limit(0)).collect() == []


