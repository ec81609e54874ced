"""The word table: one compact row per text (word hashes in order, exact key, length), written once and read by the
near-duplicate operators, so that texts themselves are never shuffled. Nulls and texts without a word get n = 0."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.runtime import written
from tessera.llm.textkit import words

MAX_CACHE = 2_000_000
COMMON_SHARE = 0.002  # a word in more than this share of the texts counts as common; so at most mean length / share words do


class WordHashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > MAX_CACHE:
            self.clear()
        h = self[word] = xxhash.xxh32_intdigest(word.encode("utf-8", "surrogatepass"))
        return h


HASHES = WordHashes()


def word_table(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """keep columns, n (words), exact (128 bits of the words), seq (uint32 of each word, little endian)."""
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField("n", T.IntegerType()), T.StructField("exact", T.BinaryType()), T.StructField("seq", T.BinaryType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            n, exact, seq = [], [], []
            for t in pdf["__text"]:
                s = np.array([HASHES[w] for w in words(t)], dtype="<u4").tobytes()
                n.append(len(s) // 4)
                seq.append(s)
                exact.append(xxhash.xxh3_128_digest(s))
            out = pdf[keep].copy()
            out["n"], out["exact"], out["seq"] = np.array(n, dtype="int32"), exact, seq
            yield out

    return df.select(*keep, F.col(text).alias("__text")).mapInPandas(run, schema)


def flat(seqs: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """All word hashes of a batch in a row, and the row number of each."""
    values = np.frombuffer(b"".join(seqs), dtype="<u4")
    return values, np.repeat(np.arange(len(seqs)), [len(s) // 4 for s in seqs])


def common_words(table: DataFrame, share: float = COMMON_SHARE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, sorted, and document frequencies of the words in more than `share` of the texts, counted over all of them.
    A text of n words holds n at most, hence no more than mean(n) / share words come back."""
    rows = max(1, table.where("n > 0").count())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, counts = np.zeros(0, "int64"), np.zeros(0, "int64")
        for pdf in batches:
            values, row = flat(pdf["seq"])
            pairs = np.unique((row.astype("uint64") << np.uint64(32)) | values.astype("uint64"))
            k, c = np.unique((pairs & np.uint64(0xFFFFFFFF)).astype("int64"), return_counts=True)
            keys, at = np.unique(np.concatenate([keys, k]), return_inverse=True)
            counts = np.bincount(at, weights=np.concatenate([counts, c]), minlength=len(keys)).astype("int64")
            if len(keys) > MAX_CACHE:
                yield pd.DataFrame({"word": keys, "df": counts})
                keys, counts = np.zeros(0, "int64"), np.zeros(0, "int64")
        yield pd.DataFrame({"word": keys, "df": counts})

    got = table.select("seq").mapInPandas(run, "word long, df long").groupBy("word").agg(F.sum("df").alias("df")).where(F.col("df") > share * rows).orderBy("word").toPandas()
    return got["word"].to_numpy("uint32"), got["df"].to_numpy("float64") / (share * rows)


PAIR_SHARE = 0.0003  # a pair of common words in more than this share of the texts is common itself


def word_pairs(values: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Hash of each word and the one before it in its text, zero before the first."""
    first = np.concatenate([[True], row[1:] != row[:-1]])
    before = np.where(first, 0, np.concatenate([[0], values[:-1]])).astype(np.uint64)
    return mix((before << np.uint64(32)) | values.astype(np.uint64))


def common_pairs(table: DataFrame, common: np.ndarray, share: float = PAIR_SHARE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the pairs of common words (or of a text's beginning and a common word) in more than `share` of the
    texts, and how many times that share, counted over all texts; no more than mean(n) / share."""
    rows = max(1, table.where("n > 0").count())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, counts = np.zeros(0, np.uint64), np.zeros(0, "int64")
        for pdf in batches:
            values, row = flat(pdf["seq"])
            if not len(values) or not len(common):
                continue
            often = common[np.minimum(np.searchsorted(common, values), len(common) - 1)] == values
            both = often & np.concatenate([[True], often[:-1] | (row[1:] != row[:-1])])
            pair, r = word_pairs(values, row)[both], row[both]
            order = np.lexsort((r, pair))
            pair, r = pair[order], r[order]
            new = np.concatenate([[True], (pair[1:] != pair[:-1]) | (r[1:] != r[:-1])])[: len(pair)]
            k, c = np.unique(pair[new], return_counts=True)
            keys, at = np.unique(np.concatenate([keys, k]), return_inverse=True)
            counts = np.bincount(at, weights=np.concatenate([counts, c]), minlength=len(keys)).astype("int64")
            if len(keys) > MAX_CACHE:
                yield pd.DataFrame({"pair": keys.view(np.int64), "df": counts})
                keys, counts = np.zeros(0, np.uint64), np.zeros(0, "int64")
        yield pd.DataFrame({"pair": keys.view(np.int64), "df": counts})

    got = table.select("seq").mapInPandas(run, "pair long, df long").groupBy("pair").agg(F.sum("df").alias("df")).where(F.col("df") > share * rows).toPandas()
    pairs = got["pair"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(pairs)
    return pairs[order], got["df"].to_numpy("float64")[order] / (share * rows)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (fixed multipliers of the splitmix generator)."""
    x = x.astype(np.uint64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


CLASSES = 32
# Codes of counts modulo 4 in two bits, one bit changing from each to the next: how many bits two codes differ in is how
# far their counts are apart around the circle of four.
_RING = np.array([0b00, 0b01, 0b11, 0b10], np.uint64)


def wide_pivots(values: np.ndarray, row: np.ndarray, texts: int) -> np.ndarray:
    """Per text, how many of its words lie in each of 32 hash classes, a ring code of two bits each."""
    counts = np.bincount(row * CLASSES + (mix(values) % np.uint64(CLASSES)).astype(np.int64), minlength=texts * CLASSES).reshape(-1, CLASSES)
    return (_RING[counts % 4] << (np.arange(CLASSES, dtype=np.uint64) * np.uint64(2))).sum(axis=1, dtype=np.uint64).view(np.int64)


def within(a: str, b: str, rate: float) -> str:
    """SQL: texts a and b (n, wide) may be within rate of the longer one. Each edit changes the length by one at most and
    moves two class counts by one at most; ring codes differ in no more bits than the counts are apart."""
    longer = f"greatest({a}.n, {b}.n)"
    return f"abs({a}.n - {b}.n) <= {rate} * {longer} + 1e-9 and bit_count({a}.wide ^ {b}.wide) <= 2 * floor({rate} * {longer} + 1e-9)"


def word_distance(a: np.ndarray, b: np.ndarray, limit: int) -> int:
    """Levenshtein distance of two word sequences, a metric; limit + 1 if above the limit."""
    if abs(len(a) - len(b)) > limit:
        return limit + 1
    lo = 0
    while lo < min(len(a), len(b)) and a[lo] == b[lo]:
        lo += 1
    a, b = a[lo:], b[lo:]
    while len(a) and len(b) and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    if not len(a) or not len(b):
        return max(len(a), len(b))
    far = limit + 1
    cols = np.arange(len(b) + 1)
    row = cols.copy()
    for i, x in enumerate(a, 1):
        new = np.minimum(row[1:] + 1, row[:-1] + (b != x))
        new = np.concatenate([[i], new])
        row = np.minimum.accumulate(new - cols) + cols
        if row.min() > limit:
            return far
    return min(int(row[-1]), far)


_STEP, _SHIFT = "20000000000000000000BD", "9223372036854775808BD"


def order_key(upper: str, id_: str) -> Column:
    """(upper, id) as one number that sorts alike, for any long id, so that a least one is found by hash aggregation."""
    return F.expr(f"cast({upper} as decimal(38,0)) * {_STEP} + (cast({id_} as decimal(38,0)) + {_SHIFT})")


def upper_of(key: str) -> Column:
    return F.expr(f"cast(floor({key} / {_STEP}) as int)")


def id_of(key: str) -> Column:
    return F.expr(f"cast({key} - floor({key} / {_STEP}) * {_STEP} - {_SHIFT} as bigint)")


def distinct_texts(words: DataFrame, *more: Column) -> DataFrame:
    """One row (exact, n, seq, more...) for each distinct text of a word table, however often it is repeated: copies are
    put together before the shuffle. Texts without a word are left out."""
    return words.where("n > 0").groupBy("exact").agg(F.first("n").alias("n"), F.first("seq").alias("seq"), *more)


def may_be_near(a: pd.Series, b: pd.Series, rate: float, classes: int = 64) -> np.ndarray:
    """Whether the counts of words by hash class allow the edits: each moves two of them by one at most."""
    sides = []
    for s in (a, b):
        values, row = flat(s)
        sides.append(np.bincount(row * classes + (mix(values) >> np.uint64(58)).astype(np.int64), minlength=len(s) * classes).reshape(-1, classes))
    n = np.maximum(sides[0].sum(axis=1), sides[1].sum(axis=1))
    return np.abs(sides[0] - sides[1]).sum(axis=1) <= 2 * np.floor(rate * n + 1e-9)


def verified(pairs: DataFrame, table: DataFrame, rate: float, seeds: str | None = None) -> DataFrame:
    """Of written pairs (a, b), those whose word sequences in table (id, seq) are at most floor(rate * longer length)
    apart, with that distance. The table moves once, joined with the ids asked for. seeds: column of places in common
    (place in a << 32 | place in b); the alignment then runs along their chain, and over the whole texts only where the
    chain alone leaves too many edits."""
    asked = pairs.select(F.col("a").alias("id")).unionAll(pairs.select(F.col("b").alias("id"))).distinct()
    need = written(table.select("id", "seq").join(asked.hint("shuffle_hash"), "id"), "asked")
    side = lambda x: need.select(F.col("id").alias(x), F.col("seq").alias(f"seq_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    columns = ["a", "b", "seq_a", "seq_b", *([seeds] if seeds else [])]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf = pdf[may_be_near(pdf["seq_a"], pdf["seq_b"], rate)]
            d = []
            for x, y, z in zip(pdf["seq_a"], pdf["seq_b"], pdf[seeds] if seeds else [None] * len(pdf), strict=True):
                u, v = np.frombuffer(x, "<u4"), np.frombuffer(y, "<u4")
                limit = int(rate * max(len(u), len(v)) + 1e-9)
                k = limit + 1 if z is None else chain_distance(u, v, z, limit)
                k = k if k <= limit else word_distance(u, v, limit)
                d.append(k if k <= limit else -1)
            out = pdf[["a", "b"]].copy()
            out["distance"] = np.array(d, dtype="int32")
            yield out[out["distance"] >= 0]

    return both.select(*columns).mapInPandas(run, "a long, b long, distance int")


def chain(pa: np.ndarray, pb: np.ndarray) -> list[int]:
    """Numbers of the seeds of a longest chain that runs forward in both texts, by patience sorting."""
    tails: list[int] = []
    at: list[int] = []
    before = [-1] * len(pa)
    for k in np.lexsort((-pb, pa)).tolist():  # places in b fall where those in a are equal
        i = bisect_left(tails, int(pb[k]))
        tails[i : i + 1], at[i : i + 1] = [int(pb[k])], [k]
        before[k] = at[i - 1] if i else -1
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(k)
        k = before[k]
    return out[::-1]


def chain_distance(u: np.ndarray, v: np.ndarray, seeds: np.ndarray, limit: int) -> int:
    """Edits of the alignment that holds the chain's seeds fixed: each is extended over equal words, the gaps between are
    aligned alone. No less than the distance; limit + 1 if above the limit."""
    pa, pb = (np.asarray(seeds) >> 32).astype(int), (np.asarray(seeds) & 0xFFFFFFFF).astype(int)
    x = y = total = 0
    for k in chain(pa, pb):
        a, b = int(pa[k]), int(pb[k])
        if a < x or b < y:  # inside the stretch before it
            continue
        total += word_distance(u[x:a], v[y:b], limit - total)
        if total > limit:
            return limit + 1
        n = min(len(u) - a, len(v) - b)
        off = np.flatnonzero(u[a : a + n] != v[b : b + n])
        n = int(off[0]) if len(off) else n
        x, y = a + n, b + n
    return min(limit + 1, total + word_distance(u[x:], v[y:], limit - total))


SMALL_SHARE, LARGE_SHARE = 5_000, 20_000  # rows of one key on either side that meet in one task; more are split


def split_join(x: DataFrame, y: DataFrame, key: str, small: int = SMALL_SHARE, large: int = LARGE_SHARE) -> DataFrame:
    """x (aliased x, the smaller side) joined with y (aliased y) on a long key; both have id. The rows of a key with more
    than `small` rows of x or `large` of y meet in a grid of shares, each row standing in one line of it, so that no task
    gets more than small * large pairs of a key. Counts are taken of all rows of x, and of y for the keys many in x or y."""
    counted = lambda v, n, name: v.groupBy(key).agg(F.count("*").alias(name)).where(F.col(name) > n)
    many = written(counted(x, min(small, 100), "cx"), "many")
    if many.isEmpty():
        return x.alias("x").join(y.alias("y"), key)
    both = many.join(y.join(many.select(key), key, "left_semi").groupBy(key).agg(F.count("*").alias("cy")), key)
    grid = both.select(key, F.ceil(F.col("cx") / small).cast("int").alias("__s"), F.ceil(F.col("cy") / large).cast("int").alias("__l")).where("__s > 1 or __l > 1")
    grid = written(grid, "grid")
    if grid.isEmpty():
        return x.alias("x").join(y.alias("y"), key)
    one = F.lit(1)
    s, l = F.coalesce("__s", one), F.coalesce("__l", one)  # noqa: E741
    left = x.join(grid, key, "left").withColumn("__j", F.explode(F.sequence(F.lit(0), l - 1))).withColumn("__cell", F.pmod(F.xxhash64("id"), s) * l + F.col("__j"))
    right = y.join(grid, key, "left").withColumn("__i", F.explode(F.sequence(F.lit(0), s - 1))).withColumn("__cell", F.col("__i") * l + F.pmod(F.xxhash64("id"), l))
    left, right = left.drop("__s", "__l", "__j"), right.drop("__s", "__l", "__i")
    return left.alias("x").join(right.alias("y"), [key, "__cell"])
