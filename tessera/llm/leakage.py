"""Problem 9: evaluation passages leaking into training text, by spaced-seed hashing.

A mask keeps some word positions of a window and ignores the others, so a changed word under an ignored position leaves
the hash equal. The seeds of the evaluation items (a stated query set; larger ones go block by block, each block of
bounded size broadcast) are looked up at every position of every document. Around each hit, document and item are compared
word by word along the diagonal, tolerating substitutions; stretches on neighbouring diagonals (an inserted or lost word)
are put together."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.runtime import table
from tessera.llm.textkit import words
from tessera.llm.wordtable import mix

MASKS = ("11011", "1101011", "1011101", "11100111")
WHOLE = ("1", "11", "111", "1111")  # of items shorter than any mask: all their words
CELLS = 4_000_000  # of a match matrix
SHARE = 0.45  # half, less what a changed word at its edge takes away
MISMATCH = -3  # a match scores 1: a stretch goes on over a changed word once three words around it agree
BLOCK = 20_000  # items broadcast at once; with the words of one, below 100 MB
SHIFT = 3


def seeds(ids: np.ndarray, row: np.ndarray, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose window lies in one row and has a known word at each kept position, and their hashes."""
    span = len(mask)
    if len(ids) < span:
        return np.zeros(0, int), np.zeros(0, np.uint64)
    m = len(ids) - span + 1
    good = row[:m] == row[span - 1 :]
    h = np.full(m, len(mask) * 131 + int(mask, 2), np.uint64)
    with np.errstate(over="ignore"):
        for o, kept in enumerate(mask):
            if kept == "1":
                part = ids[o : o + m]
                good &= part > 0
                h = h * np.uint64(0x9E3779B97F4A7C15) + part.astype(np.uint64)
    at = np.flatnonzero(good)
    return at, mix(h[at])


class Items:
    """The items' words as numbers (0: no item's), their concatenation and sorted seed table."""

    def __init__(self, ids: list[int], texts: list[str | None]):
        lists = [words(t) for t in texts]
        keep = [i for i, w in enumerate(lists) if w]
        self.ids = np.array([ids[i] for i in keep], np.int64)
        self.number: dict[str, int] = {}
        lists = [[self.number.setdefault(w, len(self.number) + 1) for w in lists[i]] for i in keep]
        self.length = np.array([len(x) for x in lists], int)
        self.start = np.concatenate([[0], np.cumsum(self.length)])[:-1].astype(int)
        self.flat = np.array([x for y in lists for x in y], np.int64)
        row = np.repeat(np.arange(len(lists)), self.length)
        self.masks = MASKS + tuple(m for m in WHOLE if (self.length == len(m)).any())
        got = [seeds(self.flat, row, m) for m in self.masks]
        got = [(at, h) if m in MASKS else (at[k := self.length[row[at]] == len(m)], h[k]) for m, (at, h) in zip(self.masks, got, strict=True)]
        at, h = np.concatenate([g[0] for g in got]), np.concatenate([g[1] for g in got])
        order = np.argsort(h, kind="stable")
        self.seed, self.at = h[order], at[order]
        self.row = row


def segments(match: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best-scoring stretch [start, end) of each row of a match matrix whose row i has width[i] columns."""
    rows = len(match)
    score, start = np.zeros(rows, int), np.zeros(rows, int)
    best, lo, hi = np.zeros(rows, int), np.zeros(rows, int), np.zeros(rows, int)
    for j in range(match.shape[1]):
        inside = j < width
        fresh = score <= 0
        start = np.where(fresh, j, start)
        score = np.where(fresh, 0, score) + np.where(match[:, j], 1, MISMATCH)
        better = inside & (score > best)
        best, lo, hi = np.where(better, score, best), np.where(better, start, lo), np.where(better, j + 1, hi)
    return lo, hi


def leaks(texts: list[str | None], items: Items, share: float = SHARE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, item id, covered share) of the texts that hold a stretch of at least share of an item's words."""
    number = items.number
    lists = [[number.get(w, 0) for w in words(t)] for t in texts]
    length = np.array([len(x) for x in lists], int)
    none = np.zeros(0, int), np.zeros(0, np.int64), np.zeros(0)
    if not length.sum() or not len(items.seed):
        return none
    ids = np.fromiter((x for y in lists for x in y), np.int64, length.sum())
    row = np.repeat(np.arange(len(lists)), length)
    first = np.concatenate([[0], np.cumsum(length)])[:-1]
    pa, pi = [], []
    for mask in items.masks:
        at, h = seeds(ids, row, mask)
        lo, hi = np.searchsorted(items.seed, h), np.searchsorted(items.seed, h, side="right")
        hit = np.flatnonzero(hi > lo)
        k = (hi - lo)[hit]
        pa.append(np.repeat(at[hit], k))
        pi.append(items.at[np.repeat(lo[hit], k) + np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)])
    a, i = np.concatenate(pa), np.concatenate(pi)
    if not len(a):
        return none
    r, q = row[a], items.row[i]
    diagonal = (a - first[r]) - (i - items.start[q])
    keys = np.unique(np.stack([r, q, diagonal]), axis=1)
    keys = keys[:, np.argsort(items.length[keys[1]], kind="stable")]  # like lengths together
    out: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
    size = np.cumsum(items.length[keys[1]]) // CELLS
    for s, e in zip(*(lambda x: (x[:-1], x[1:]))(np.concatenate([np.flatnonzero(np.diff(size, prepend=-1)), [keys.shape[1]]])), strict=True):
        r, q, d = keys[:, s:e]
        col = np.arange(items.length[q].max())
        here = col[None, :] < items.length[q][:, None]
        p = col[None, :] + d[:, None]
        here &= (p >= 0) & (p < length[r][:, None])
        match = np.zeros(here.shape, bool)
        x, y = np.nonzero(here)
        match[x, y] = ids[first[r[x]] + p[x, y]] == items.flat[items.start[q[x]] + y]
        lo, hi = segments(match, items.length[q])
        for z in np.flatnonzero(hi - lo >= np.minimum(6, items.length[q])):
            out.setdefault((int(r[z]), int(q[z])), []).append((int(lo[z]), int(hi[z]), int(d[z])))
    found = []
    for (r, q), parts in out.items():
        n, best = int(items.length[q]), 0
        parts.sort()
        for s, (lo, hi, d) in enumerate(parts):
            end, at = hi, d
            for lo2, hi2, d2 in parts[s + 1 :]:
                if abs(d2 - at) <= SHIFT and lo2 <= end + SHIFT and hi2 > end:
                    end, at = hi2, d2
            best = max(best, end - lo)
        if best >= share * n:
            found.append((r, int(items.ids[q]), best / n))
    if not found:
        return none
    r, q, c = zip(*found, strict=True)
    return np.array(r), np.array(q, np.int64), np.minimum(np.array(c), 1.0)


def leaked(docs: DataFrame, doc_id: str, text: str, bench: DataFrame, share: float = SHARE) -> DataFrame:
    """Rows (doc_id, item_id, covered), once for each text under an id. Null and blank texts on either side hold and leak nothing; every item id of a
    passage counts; a document given twice comes out twice."""
    spark = docs.sparkSession
    rows = bench.select(F.col("item_id").cast("long"), "text", F.sha2("text", 256).alias("h")).where("text is not null").distinct().orderBy("item_id", "h")
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("__text")).where(F.col("__text").isNotNull())
    out, low = None, None
    while True:
        block = (rows if low is None else rows.where((F.col("item_id") > low[0]) | ((F.col("item_id") == low[0]) & (F.col("h") > low[1])))).limit(BLOCK).collect()
        if not block and out is not None:
            return out
        held = spark.sparkContext.broadcast(Items([b[0] for b in block], [b[1] for b in block]))

        def run(batches: Iterator[pd.DataFrame], held=held) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                r, q, c = leaks(pdf["__text"].tolist(), held.value, share)
                yield pd.DataFrame({"doc_id": pdf["doc_id"].to_numpy()[r], "item_id": q, "covered": c})

        part = source.mapInPandas(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, item_id long, covered double")
        out = part if out is None else out.unionByName(part)
        if len(block) < BLOCK:
            return out
        low = block[-1][0], block[-1][2]


def p9_found(spark, sf_dir: str) -> DataFrame:
    return leaked(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "bench_items")).select("doc_id", "item_id").distinct()


def p9_report(spark, sf_dir: str) -> DataFrame:
    """Per task and language of the items: items, leaked items, documents that hold one, mean covered share."""
    bench = table(spark, sf_dir, "bench_items")
    got = leaked(table(spark, sf_dir, "documents"), "doc_id", "text", bench)
    by = bench.select(F.col("item_id").cast("long").alias("item_id"), "task", "language").join(got, "item_id", "left")
    return by.groupBy("task", "language").agg(F.countDistinct("item_id").alias("items"), F.countDistinct(F.when(F.col("doc_id").isNotNull(), F.col("item_id"))).alias("leaked_items"), F.countDistinct("doc_id").alias("documents"), F.round(F.avg("covered"), 4).alias("covered"))
