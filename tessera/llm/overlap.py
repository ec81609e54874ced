"""Problem 6: same or near-same records across splits, by winnowing fingerprints.

Each text's rolling hashes over K words are winnowed: of the neighbouring hashes of a window the least is kept, in an order
that puts K-grams of rare words before those of frequent ones, so a turn of phrase common to many is seldom one. The window
is at most WINDOW and narrower where the edits allowed could cut a text into shorter runs, hence every near pair shares a
fingerprint. Exact copies are taken together first; fingerprints of one representative each of evaluation and train texts
are joined (frequent ones split over many tasks), the seeds of a pair chained where they are collinear, and the chain
extended by alignment; only a pair whose chain leaves too many edits is aligned as a whole."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.runtime import table, written
from tessera.llm.wordtable import common_words, distinct_texts, flat, mix, split_join, verified, wide_pivots, within, word_table

K, WINDOW = 4, 3
SHORT = 3  # words of the grams of texts so short that one edit may leave no K words in a row
RATE = 0.15


def rolling(values: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Polynomial hash of the k words from each position, and whether those lie in one row."""
    h = np.zeros(len(values), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            part = np.zeros(len(values), np.uint64)
            part[: len(values) - j] = values[j:]
            h = h * np.uint64(0x9E3779B97F4A7C15) + part
    end = np.concatenate([row[k - 1 :], np.full(min(k - 1, len(row)), -1)])[: len(row)]
    return mix(h), end == row


def shared_run(n: np.ndarray, rate: float = RATE) -> np.ndarray:
    """How many words in a row a text of n words shares at least with one that is near: d edits leave the other words of
    the longer one in d + 1 runs at most, whichever length the longer has."""
    n = np.asarray(n, np.int64)
    longest = np.floor(n / (1 - rate) + 1e-9).astype(np.int64)
    out = np.full(n.shape, np.iinfo(np.int64).max)
    for more in range(int((longest - n).max(initial=0)) + 1):
        m = n + more
        edits = np.floor(rate * m + 1e-9).astype(np.int64)
        out = np.where(m <= longest, np.minimum(out, -(-(m - edits) // (edits + 1))), out)
    return out


def winnow(seqs: pd.Series, common: np.ndarray, often: np.ndarray, k: int = K, window: int = WINDOW, rate: float = RATE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, word position and hash of the fingerprints of a batch: k-grams, the least of each window. The window of a text
    is as wide as its shared run allows, so no near text is missed; texts whose run is shorter than k words give all their
    grams of SHORT words too."""
    values, row = flat(seqs)
    if not len(values):
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0, np.int64)
    lengths = np.bincount(row, minlength=len(seqs))
    start = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    place = np.arange(len(values)) - start[row]
    weight = np.zeros(len(values))
    if len(common):
        at = np.minimum(np.searchsorted(common, values), len(common) - 1)
        weight = np.where(common[at] == values, 1 + np.log2(np.maximum(often[at], 1)), 0)
    total = np.convolve(weight, np.ones(k))[k - 1 :][: len(values)]
    h, whole = rolling(values, row, k)
    code = (np.minimum(np.round(total * 8), 1023).astype(np.uint64) << np.uint64(54)) | (h >> np.uint64(10))
    code = np.where(whole, code, np.uint64(2**64 - 1))
    # the least of each window that lies in one row; a row with fewer k-grams than a window is one window
    run = shared_run(np.unique(lengths), rate)[np.searchsorted(np.unique(lengths), lengths)]
    wide = np.clip(run - k + 1, 1, window)
    pick = np.zeros(len(values), bool)
    grams = np.maximum(lengths - k + 1, 0)
    best, where = code.copy(), np.arange(len(values))
    for j in range(1, window):
        other = np.concatenate([code[j:], np.full(min(j, len(code)), np.uint64(2**64 - 1))])[: len(code)]
        inside = (place + j < grams[row]) & (j < wide[row])
        less = inside & (other < best)
        best, where = np.where(less, other, best), np.where(less, np.arange(len(values)) + j, where)
    head = whole & (place <= np.maximum(grams[row] - wide[row], 0))
    pick[where[head]] = True
    r, p, f = row[pick], place[pick], h[pick]
    if (run < k).any():
        h, whole = rolling(values, row, SHORT)
        pick = whole & (run[row] < k)
        r, p, f = np.concatenate([r, row[pick]]), np.concatenate([p, place[pick]]), np.concatenate([f, mix(h[pick] + np.uint64(SHORT))])
    return r, p, f.view(np.int64)


def fingerprints(words: DataFrame, common: np.ndarray, often: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            r, p, f = winnow(pdf["seq"], common, often)
            wide = wide_pivots(*flat(pdf["seq"]), len(pdf))
            yield pd.DataFrame({"print": f, "id": pdf["id"].to_numpy()[r], "pos": p.astype("int32"), "n": pdf["n"].to_numpy()[r], "wide": wide[r]})

    return words.select("id", "n", "seq").mapInPandas(run, "print long, id long, pos int, n int, wide long")


def candidates(left: DataFrame, right: DataFrame, rate: float = RATE) -> DataFrame:
    """Pairs (a, b) of different ids with their seeds (place in a, place in b): fingerprints in common at places that
    differ by no more than the edits allowed, beyond which no aligned word lies, of texts whose word counts allow it. A
    text has no more seeds than words, so the list of a pair is bounded by its texts."""
    longer = "greatest(x.n, y.n)"
    met = split_join(left, right, "print").where(f"x.id <> y.id and {within('x', 'y', rate)} and abs(x.pos - y.pos) <= {rate} * {longer} + 1e-9")
    place = lambda a, b: F.shiftleft(F.col(a).cast("long"), 32).bitwiseOR(F.col(b).cast("long"))
    seed = F.when(F.col("x.id") < F.col("y.id"), place("x.pos", "y.pos")).otherwise(place("y.pos", "x.pos"))
    return met.groupBy(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).agg(F.collect_set(seed).alias("seeds"))


def overlaps(words: DataFrame, rate: float = RATE) -> tuple[DataFrame, DataFrame]:
    """From a written word table with id and train: (classes, links). classes (id, rep, train, has_train, has_eval): every
    text with words, rep the least id of its exact copies. links (rep_a, rep_b, distance): different representatives
    nearly the same, one with a train copy and the other with an evaluation copy; distance: edits along their chain."""
    flags = [F.min("id").alias("rep"), F.max(F.col("train").cast("int")).alias("has_train"), F.max((~F.col("train")).cast("int")).alias("has_eval")]
    reps = written(distinct_texts(words, *flags).withColumn("id", F.col("rep")), "reps")
    classes = words.where("n > 0").select("id", "train", "exact").join(reps.select("exact", "rep", "has_train", "has_eval"), "exact").drop("exact")
    common, often = common_words(reps)
    ev = fingerprints(reps.where("has_eval = 1"), common, often)
    tr = fingerprints(reps.where("has_train = 1"), common, often)
    pairs = written(candidates(ev, tr, rate), "candidates")
    links = verified(pairs, reps, rate, seeds="seeds")
    return classes, links.select(F.col("a").alias("rep_a"), F.col("b").alias("rep_b"), "distance")


def split_words(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "corpus_rows").select(F.col("row_id").alias("id"), F.lower(F.trim("split")).alias("split"), "source", "text")
    rows = rows.where("split in ('train', 'validation', 'test')").withColumn("train", F.col("split") == "train")
    return written(word_table(rows, "text", ["id", "split", "source", "train"]), "words")


def row_pairs(classes: DataFrame, links: DataFrame) -> DataFrame:
    """All (row_id_a, row_id_b) of one train and one evaluation row: the copies of linked representatives and of one."""
    tr, ev = classes.where("train").select("rep", F.col("id").alias("t")), classes.where("not train").select("rep", F.col("id").alias("e"))
    key = lambda v, i: v.select("rep", F.col(i).alias("id"))
    same = split_join(key(ev, "e"), key(tr, "t"), "rep").select(F.col("y.id").alias("t"), F.col("x.id").alias("e"))
    both = links.select("rep_a", "rep_b").unionAll(links.select("rep_b", "rep_a"))
    near = both.join(tr.withColumnRenamed("rep", "rep_a"), "rep_a").join(ev.withColumnRenamed("rep", "rep_b"), "rep_b").select("t", "e")
    return same.unionByName(near).select(F.least("t", "e").alias("row_id_a"), F.greatest("t", "e").alias("row_id_b"))


def p6_found(spark, sf_dir: str) -> DataFrame:
    classes, links = overlaps(split_words(spark, sf_dir))
    return row_pairs(classes, written(links, "links"))


def p6_report(spark, sf_dir: str) -> DataFrame:
    """Per split and source (trimmed, lower case): rows, rows that overlap a train row exactly or nearly, their share, and
    the mean share of words of the overlapping rows that the train text covers."""
    words = split_words(spark, sf_dir)
    classes, links = overlaps(words)
    links = written(links, "links")
    both = links.select(F.col("rep_a").alias("rep"), "rep_b", "distance").unionAll(links.select("rep_b", F.col("rep_a"), "distance"))
    trained = classes.where("id = rep and has_train = 1").select(F.col("rep").alias("rep_b"))
    near = both.join(trained, "rep_b", "left_semi").groupBy("rep").agg(F.min("distance").alias("distance"))
    rows = words.where("not train").select("id", "split", "source", "n")
    state = classes.where("not train").join(near, "rep", "left").select("id", F.when(F.col("has_train") == 1, 0).otherwise(F.col("distance")).alias("distance"))
    got = rows.join(state, "id", "left")
    cover = F.when(F.col("distance").isNotNull(), 1 - F.col("distance") / F.greatest("n", F.lit(1)))
    return got.groupBy("split", F.lower(F.trim(F.coalesce("source", F.lit("")))).alias("source")).agg(F.count("*").alias("rows"), F.count("distance").alias("overlapping"), F.round(F.count("distance") / F.count("*"), 4).alias("share"), F.round(F.avg(cover), 4).alias("coverage"))
