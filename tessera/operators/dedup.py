"""Deduplication: keep the first of equal or alike rows.

Alike rows are kept greedily in order: a row goes if it is alike an earlier row that was itself kept. The links are found by
joins on distinct texts; the greedy rule is then run in rounds over the links, each of which settles every row whose earlier
partners are all settled, so no component is ever gathered in one place."""

from __future__ import annotations

import uuid
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import dedup_key


def first_rows(df: DataFrame, key: list, order: str) -> DataFrame:
    """Of rows with equal keys the one that comes first; the least order value is found by partial aggregation, so a key
    that many rows share is no burden. Order values must be unique; null keys are equal to each other."""
    keyed = df.select(*key, F.col(order).alias("__o"))
    names = keyed.columns[:-1]
    firsts = keyed.groupBy(*names).agg(F.min("__o").alias("__o")).select("__o")
    return df.join(firsts, df[order] == firsts["__o"], "left_semi")


def exact(df: DataFrame, text: str = "text", order: str = "doc_id") -> DataFrame:
    return first_rows(df, [F.sha2(text, 256).alias("__k")], order)


def normalised(df: DataFrame, text: str = "text", order: str = "doc_id") -> DataFrame:
    return first_rows(df, [F.sha2(dedup_key(F.col(text)), 256).alias("__k")], order)


def on_columns(df: DataFrame, columns: list[str], order: str) -> DataFrame:
    return first_rows(df, [F.sha2(F.concat_ws("||", *columns), 256).alias("__k")], order)


def against(df: DataFrame, history: DataFrame, text: str = "text", order: str | None = None) -> DataFrame:
    """Rows whose stripped text none of the history has."""
    from tessera.functions.text import strip

    key = F.sha2(strip(F.col(text)), 256)
    seen = history.select(F.sha2(strip(F.col(text)), 256).alias("__k")).distinct()
    return df.withColumn("__k", key).join(seen, "__k", "left_anti").drop("__k")


def consolidated(first: DataFrame, second: DataFrame, text: str, order: str) -> DataFrame:
    """Both snapshots without repeated texts; the first snapshot's rows win."""
    both = first.withColumn("__p", F.lit(0)).unionByName(second.withColumn("__p", F.lit(1)), allowMissingColumns=True)
    least = both.groupBy(F.sha2(text, 256).alias("__k")).agg(F.min(F.struct("__p", order)).alias("__m")).select("__m.*")
    return both.join(least, ["__p", order], "left_semi").drop("__p")


def signatures(df: DataFrame, text: str, order: str, permutations: int = 128, size: int = 5) -> DataFrame:
    """(order, sig): MinHash of character n-grams of the folded text, one 32-bit minimum per permutation. Blank: none."""
    mult = np.arange(1, permutations + 1, dtype=np.uint64)
    add = np.arange(permutations, dtype=np.uint64) * np.uint64(0x5BD1E995)
    kind = df.schema[order].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ids, sigs = [], []
            for o, t in zip(pdf["o"], pdf["t"], strict=True):
                s = " ".join((t or "").lower().split())
                if not s:
                    continue
                k = min(size, len(s))
                h = np.array([xxhash.xxh64_intdigest(g.encode("utf-8", "surrogatepass")) & 0xFFFFFFFF for g in {s[i : i + k] for i in range(len(s) - k + 1)}], np.uint64)
                best = np.full(permutations, 0xFFFFFFFF, np.uint64)
                for i in range(0, len(h), 4096):
                    best = np.minimum(best, ((h[i : i + 4096, None] * mult + add) & np.uint64(0xFFFFFFFF)).min(axis=0))
                ids.append(o)
                sigs.append(best.astype(np.int64))
            yield pd.DataFrame({order: ids, "sig": sigs})

    return df.select(F.col(order).alias("o"), F.col(text).alias("t")).mapInPandas(run, f"`{order}` {kind}, sig array<long>")


def signature_firsts(sigs: DataFrame, order: str) -> tuple[DataFrame, DataFrame]:
    """(first, order) of every row with a signature: the first row that has the same one; and the signatures of the firsts."""
    whole = sigs.withColumn("s", F.xxhash64("sig"))
    firsts = whole.groupBy("s").agg(F.min(order).alias("first"))
    members = whole.join(firsts, "s").select("first", order)
    return members, whole.join(firsts, whole[order] == firsts["first"], "left_semi").select(order, "sig")


def near_signatures(reps: DataFrame, order: str, bands: int = 16, threshold: float = 0.85) -> DataFrame:
    """(a, b) with a before b: signatures that agree in a band and in at least threshold of all places."""
    rows = F.size("sig") / bands
    banded = reps.select(order, "sig", F.explode(F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda i: F.struct(i.alias("band"), F.xxhash64(F.slice("sig", (i * rows + 1).cast("int"), rows.cast("int"))).alias("h")))).alias("k"))
    keys = banded.select(order, "k.band", "k.h")
    x, y = keys.alias("x"), keys.alias("y")
    pairs = x.join(y, (F.col("x.band") == F.col("y.band")) & (F.col("x.h") == F.col("y.h")) & (F.col(f"x.{order}") < F.col(f"y.{order}"))).select(F.col(f"x.{order}").alias("a"), F.col(f"y.{order}").alias("b")).distinct()
    both = pairs.join(reps.select(F.col(order).alias("a"), F.col("sig").alias("sa")), "a").join(reps.select(F.col(order).alias("b"), F.col("sig").alias("sb")), "b")
    equal = F.aggregate(F.zip_with("sa", "sb", lambda p, q: (p == q).cast("int")), F.lit(0), lambda n, v: n + v)
    return both.where(equal >= threshold * F.size("sa")).select("a", "b")


def minhash_links(sigs: DataFrame, order: str, bands: int = 16, threshold: float = 0.85) -> DataFrame:
    """(a, b) with a before b: near signatures, and rows of one and the same signature linked to their first only. To see
    which rows go, take minhash_gone: greedy() on these links alone would keep the copies of a row that goes."""
    members, reps = signature_firsts(sigs, order)
    same = members.where(F.col(order) > F.col("first")).select(F.col("first").alias("a"), F.col(order).alias("b"))
    return same.unionByName(near_signatures(reps, order, bands, threshold))


def minhash_gone(sigs: DataFrame, order: str, shared: str, bands: int = 16, threshold: float = 0.85) -> DataFrame:
    """(id, kept_by): the rows that go. Which signatures go is settled between their first rows; every copy then shares its
    first row's fate, or goes by that first row itself."""
    path = f"{shared}/signatures-{uuid.uuid4().hex}"
    small = sigs.withColumn("sig", F.transform("sig", lambda v: (v - F.lit(1 << 31)).cast("int")))  # only compared; half the bytes
    small.write.parquet(path)
    members, reps = signature_firsts(sigs.sparkSession.read.schema(small.schema).parquet(path), order)
    gone = greedy(near_signatures(reps, order, bands, threshold), shared)
    fate = members.join(gone.select(F.col("id").alias("first"), "kept_by"), "first", "left")
    return fate.where(F.col("kept_by").isNotNull() | (F.col(order) > F.col("first"))).select(F.col(order).alias("id"), F.coalesce("kept_by", "first").alias("kept_by"))


def greedy(links: DataFrame, shared: str) -> DataFrame:
    """(id, kept_by): the rows that go, and an earlier kept row each is alike; links (a, b) with a before b. Every round
    drops the rows with a kept earlier partner and keeps those whose earlier partners are all gone."""
    spark = links.sparkSession

    def out(df: DataFrame, name: str) -> DataFrame:
        path = f"{shared}/{name}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    open_ = out(links.select("a", "b").distinct(), "links")
    gone = None
    while open_.limit(1).count():
        waits = open_.select(F.col("b").alias("id")).distinct()
        kept = open_.select(F.col("a").alias("id")).distinct().join(waits, "id", "left_anti")  # no open earlier partner
        hit = out(open_.join(kept.withColumnRenamed("id", "a"), "a", "left_semi").groupBy("b").agg(F.min("a").alias("kept_by")).withColumnRenamed("b", "id"), "gone")
        gone = hit if gone is None else gone.unionByName(hit)
        drop = hit.select("id")
        open_ = out(open_.join(drop.withColumnRenamed("id", "a"), "a", "left_anti").join(drop.withColumnRenamed("id", "b"), "b", "left_anti"), "links")
    return gone if gone is not None else links.select(F.col("b").alias("id"), F.col("a").alias("kept_by")).limit(0)


def lcs_ratio(a: str, b: str) -> float:
    """200 * longest common subsequence / total length; 100 for two empty texts. Bit-parallel over the characters."""
    if not a and not b:
        return 100.0
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for c in b:
        u = v & where.get(c, 0)
        v = ((v + u) | (v - u)) & full
    return 200.0 * (len(a) - v.bit_count()) / (len(a) + len(b))


def folded_rows(df: DataFrame, text: str, order: str) -> DataFrame:
    """(o, k, key) of every text that isn't empty: k is the first row of the same folded key; key stands on that row only."""
    rows = df.where(F.col(text) != "").select(F.col(order).alias("o"), dedup_key(F.col(text)).alias("key")).withColumn("h", F.sha2("key", 256))
    firsts = rows.groupBy("h").agg(F.min("o").alias("k"))
    return rows.join(firsts, "h").select("o", "k", F.when(F.col("o") == F.col("k"), F.col("key")).alias("key"))


def alike_keys(placed: DataFrame, threshold: float, span: int, block: int) -> DataFrame:
    """(o, k, near): other keys alike by lcs_ratio at most span places before each row of placed (o, k, key, i, fresh), if there
    are any; pairs without a fresh row are left out. Rows go in blocks with the span before each, so no task sees more than
    block + span of them; within a block lengths and counts of characters and of pairs of them, whose difference bounds the
    edits (one edit changes one character and at most three pairs), leave few keys to compare."""
    rows = placed.withColumn("block", F.explode(F.sequence(F.floor(F.col("i") / block), F.floor((F.col("i") + span) / block))))

    def pairs(at: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("i", kind="stable")
        keys, place, ids, ks, fresh = pdf["key"].tolist(), pdf["i"].to_numpy(), pdf["o"].to_numpy(), pdf["k"].to_numpy(), pdf["fresh"].to_numpy()
        size = np.array([len(k) for k in keys])
        counts, twos = np.zeros((len(keys), 64), np.int32), np.zeros((len(keys), 1024), np.int32)
        for n, k in enumerate(keys):
            c = np.frombuffer(k.encode("utf-32-le", "surrogatepass"), np.uint32)
            counts[n] = np.bincount(c & 63, minlength=64)
            twos[n] = np.bincount((c[:-1] * 37 + c[1:]) & 1023, minlength=1024)
        out = []
        known: dict[tuple, bool] = {}
        for n in np.flatnonzero(place // block == at[0]):
            lo = np.searchsorted(place, place[n] - span)
            both = size[lo:n] + size[n]
            room = both * (1 - threshold / 100) + 1e-9
            near = np.flatnonzero((np.abs(size[lo:n] - size[n]) <= room) & (ks[lo:n] != ks[n]) & (fresh[lo:n] | fresh[n])) + lo
            near = near[np.abs(counts[near] - counts[n]).sum(axis=1) <= room[near - lo]]
            near = near[np.abs(twos[near] - twos[n]).sum(axis=1) <= 3 * room[near - lo]]
            got = []
            for m in {ks[m]: m for m in near}.values():
                pair = (ks[m], ks[n])
                if pair not in known:
                    known[pair] = lcs_ratio(keys[m], keys[n]) >= threshold
                if known[pair]:
                    got.append(ks[m])
            if got:
                out.append((ids[n], ks[n], got))
        return pd.DataFrame(out, columns=["o", "k", "near"])

    kind = placed.schema["o"].dataType.simpleString()
    return rows.groupBy("block").applyInPandas(pairs, f"o {kind}, k {kind}, near array<{kind}>")


def fuzzy_links(df: DataFrame, text: str, order: str, threshold: float = 90.0, window: int = 1000, block: int = 4096) -> DataFrame:
    """(a, b), a before b: folded keys alike by lcs_ratio, at most `window` distinct keys apart in row order. The window of kept
    rows depends on what goes: see fuzzy_gone."""
    from tessera.operators.packing import positions

    firsts = folded_rows(df, text, order).where("o = k and key <> ''")
    placed = positions(firsts.withColumn("one", F.lit(1).cast("long")), "o", "one").select("o", "k", "key", F.col("start").alias("i"), F.lit(True).alias("fresh"))
    return alike_keys(placed, threshold, window, block).select(F.explode("near").alias("a"), F.col("o").alias("b"))


def fuzzy_gone(df: DataFrame, text: str, order: str, shared: str, threshold: float = 90.0, window: int = 1000, block: int = 4096) -> DataFrame:
    """(id, kept_by): the rows that go because a kept row has the same folded key, or one of the last `window` kept rows has
    one alike. A key that goes isn't remembered: its copies are compared again, and take up no place. Alike keys are
    found in blocks, a span of rows back; only rows that have any, or that others are alike, then pass in order through
    one task, which counts the rows kept. Where so many go that the span holds fewer than `window` kept rows, its part
    beyond the window is doubled, so that nothing within the window is missed."""
    from tessera.operators.packing import positions

    spark = df.sparkSession

    def out(df: DataFrame, name: str) -> DataFrame:
        path = f"{shared}/{name}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    rows = out(folded_rows(df, text, order), "folded")
    firsts, copies = rows.where("o = k"), rows.where("o > k").select("o", "k")
    kind = rows.schema["o"].dataType.simpleString()
    span = window + max(window // 8, 1)
    loose = links = None  # loose: keys that may go
    entries = firsts.select("o", "k", F.lit(True).alias("fresh"))
    while True:
        placed = out(positions(entries.withColumn("one", F.lit(1).cast("long")), "o", "one").select("o", "k", F.col("start").alias("i"), "fresh"), "placed")
        new = out(alike_keys(placed.join(firsts.select("k", "key"), "k"), threshold, span, block), "alike")
        links = new if links is None else links.unionByName(new)
        found = new.select("k").distinct()
        added = out(found if loose is None else found.join(loose, "k", "left_anti"), "added")
        loose = added if loose is None else loose.unionByName(added)
        more = copies.join(added, "k", "left_semi").select("o", "k")
        if more.limit(1).count():  # rows may only move apart, so pairs of old rows are known
            entries = placed.select("o", "k", F.lit(False).alias("fresh")).unionByName(more.withColumn("fresh", F.lit(True)))
            continue
        concerned = loose.unionByName(links.select(F.explode("near").alias("k"))).distinct()
        waiting = placed.join(concerned, "k", "left_semi").join(links.groupBy("o").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")), "o", "left")
        total = placed.count()

        def decide(batches: Iterator[pd.DataFrame], span: int = span, total: int = total) -> Iterator[pd.DataFrame]:
            kept: dict = {}  # key to the number of rows kept before it and its row
            gone, recent = 0, deque()
            for pdf in batches:
                ids, by, short = [], [], []
                for o, k, i, near in zip(pdf["o"], pdf["k"], pdf["i"], pdf["near"], strict=True):
                    rank = i - gone
                    hits = [kept[k]] if k in kept else [] if near is None else [kept[j] for j in near if j in kept and kept[j][0] >= rank - window]
                    if not hits:
                        kept[k] = (rank, o)
                        continue
                    gone += 1
                    recent.append(i)
                    while recent[0] <= i - span:
                        recent.popleft()
                    ids.append(o)
                    by.append(min(hits)[1])
                    short.append(total > span and len(recent) > span - window)
                yield pd.DataFrame({"id": ids, "kept_by": by, "short": short})

        went = out(waiting.select("o", "k", "i", "near").repartition(1).sortWithinPartitions("i").mapInPandas(decide, f"id {kind}, kept_by {kind}, short boolean"), "went")
        if not went.where("short").limit(1).count():
            rest = copies.join(loose, "k", "left_anti")
            return went.select("id", "kept_by").unionByName(rest.select(F.col("o").alias("id"), F.col("k").alias("kept_by")))
        span += span - window
        entries, links = placed.select("o", "k", F.lit(True).alias("fresh")), None
