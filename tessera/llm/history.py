"""Problem 5: deduplicating new batches against all history by a pivot-distance table.

Metric: Levenshtein distance on comparison words; two texts are nearly the same within RATE of the longer one. The bag
distance (multiset difference of words) is a metric too and at most twice that. Two kinds of fixed pivots:

* thirty-two wide pivots: the words of one hash class each. d(x, P_j) differs from d(y, P_j) by at most d(x, y), and over the
  disjoint classes these bounds add up, so a pair is pruned if they exceed twice the allowed edits;
* narrow pivots: one word pair each. A text lies nearer to those it holds. Two texts within L edits hold all but 2 L of
  each other's, so the first 2 L + 1 of either, in one fixed order, have one in common: these are its table rows, by whose
  range the join is partitioned. Pairs of
  rare words come first in the order, by the words' counts, and pairs common themselves last, by their own counts, hence a turn of phrase common to
  many is hardly a key.

The table is kept in a folder: `order` (counts of common words and pairs, fixed by the first append, so that every row's
ranges follow one order for good), `texts` (distinct texts as word hashes, by ranges of their exact key) and `ranges` (the
pivot rows, by ranges of the pivot's number). Appending writes new files only. A check makes pivot rows of the new batch
alone and reads, of the stored ones, the ranges these touch, and of the stored texts those it must verify; nothing held is
counted, hashed or cut again. Exact copies meet by a 128-bit key first. A row that matches the earliest row in one of its
first ranges is settled before the full join, which keeps a group of thousands of near copies from being compared with
itself."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.runtime import shared_dir, table, written
from tessera.llm.wordtable import common_pairs, common_words, distinct_texts, flat, id_of, order_key, split_join, upper_of, verified, wide_pivots, within, word_pairs, word_table

RATE = 0.15
FIRST = 4
BITS = 5  # 2 ** BITS ranges of pivot numbers, and as many of exact keys
TABLES = {
    "order": "kind string, hash long, often double",
    "texts": "exact binary, id long, batch int, n int, seq binary, part int",
    "ranges": "key long, pos byte, id long, batch int, n int, wide long, part int, range int",
}


class Order:
    """The fixed order of pivots: common words and pairs with how common they are, anything else being rare."""

    def __init__(self, words: tuple[np.ndarray, np.ndarray], pairs: tuple[np.ndarray, np.ndarray]):
        self.words, self.pairs = words, pairs

    @staticmethod
    def fitted(unique: DataFrame) -> Order:
        words = common_words(unique)
        return Order(words, common_pairs(unique, words[0]))

    def rows(self) -> pd.DataFrame:
        parts = [pd.DataFrame({"kind": k, "hash": h.astype(np.uint64).view(np.int64), "often": o}) for k, (h, o) in (("word", self.words), ("pair", self.pairs))]
        return pd.concat(parts, ignore_index=True)

    @staticmethod
    def of(rows: pd.DataFrame) -> Order:
        def side(kind: str, dtype: type) -> tuple[np.ndarray, np.ndarray]:
            own = rows[rows["kind"] == kind]
            h = own["hash"].to_numpy(np.int64).view(np.uint64).astype(dtype)
            at = np.argsort(h)
            return h[at], own["often"].to_numpy("float64")[at]

        return Order(side("word", np.uint32), side("pair", np.uint64))

    def weights(self, values: np.ndarray, row: np.ndarray, pair: np.ndarray) -> np.ndarray:
        """How late each word pair of a batch comes: rare words' pairs first, pairs common themselves last."""
        (common, often), (held, often_held) = self.words, self.pairs
        weight = np.zeros(len(values))
        if len(common):
            at = np.minimum(np.searchsorted(common, values), len(common) - 1)
            weight = np.where(common[at] == values, 1 + np.log2(np.maximum(often[at], 1)), 0)
        first = np.concatenate([[True], row[1:] != row[:-1]])
        total = weight + np.where(first, 8, np.concatenate([[0], weight[:-1]]))
        if len(held):
            at = np.minimum(np.searchsorted(held, pair), len(held) - 1)
            total = np.where(held[at] == pair, 64 + 2 * np.log2(np.maximum(often_held[at], 1)), total)
        return np.minimum(np.round(total * 8), 1023).astype(np.uint64)


def pivot_rows(words: DataFrame, order: Order, rate: float = RATE, bits: int = BITS) -> DataFrame:
    """Rows (range, key, pos, id, batch, n, wide, part) of the pivot-distance table for texts (id, batch, n, seq, part)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            values, row = flat(pdf["seq"])
            if not len(values):
                continue
            n = pdf["n"].to_numpy()
            wide = wide_pivots(values, row, len(n))
            pair = word_pairs(values, row)
            by = np.lexsort((pair, order.weights(values, row, pair), row))
            r, k = row[by], pair[by]
            new = np.concatenate([[True], (r[1:] != r[:-1]) | (k[1:] != k[:-1])])
            r, k = r[new], k[new]
            start = np.searchsorted(r, np.arange(len(n)))
            pos = np.arange(len(r)) - start[r]
            edits = np.floor(rate * np.floor(n / (1 - rate)) + 1e-9).astype(np.int64)
            take = pos < 2 * edits[r] + 1
            r, k, pos = r[take], k[take], pos[take]
            out = {"range": (k >> np.uint64(64 - bits)).astype("int32"), "key": k.view(np.int64), "pos": np.minimum(pos, FIRST).astype("int8"), "id": pdf["id"].to_numpy()[r], "batch": pdf["batch"].to_numpy()[r], "n": n[r], "wide": wide[r], "part": pdf["part"].to_numpy()[r]}
            yield pd.DataFrame(out)

    return words.select("id", "batch", "n", "seq", "part").mapInPandas(run, "range int, key long, pos byte, id long, batch int, n int, wide long, part int")


def _near(a: str, b: str, rate: float) -> str:
    """Triangle inequality on lengths and wide pivots, and b earlier than a."""
    return f"({b}.batch < {a}.batch or ({b}.batch = {a}.batch and {b}.id < {a}.id)) and {within(a, b, rate)}"


def _touched(df: DataFrame, column: str) -> list[int]:
    """The ranges that occur in a column: at most 2 ** BITS."""
    return sorted(r[0] for r in df.select(column).distinct().collect())


def _least(df: DataFrame, by: str, upper: str) -> DataFrame:
    """(by, b, upper): per value, the row of the least (upper, id), found by hash aggregation."""
    got = df.groupBy(by).agg(F.min(order_key(upper, "id")).alias("o"))
    return got.select(by, id_of("o").alias("b"), upper_of("o").alias(upper))


def _closest(v: DataFrame) -> DataFrame:
    """(id, earlier, distance): of each a, the nearest b, the least on ties."""
    got = v.groupBy("a").agg(F.min(order_key("distance", "b")).alias("m"))
    return got.select(F.col("a").alias("id"), id_of("m").alias("earlier"), upper_of("m").alias("distance"))


def unique_texts(words: DataFrame, bits: int = BITS) -> DataFrame:
    """(part, exact, id, batch, n, seq): the distinct texts of a word table with id and batch, each under its earliest row;
    part: range of the exact key's first byte."""
    got = distinct_texts(words, F.min(order_key("batch", "id")).alias("o"))
    part = F.expr(f"cast(shiftright(cast(conv(hex(substring(exact, 1, 1)), 16, 10) as int), {8 - bits}) as int)")
    return got.select(part.alias("part"), "exact", id_of("o").alias("id"), upper_of("o").alias("batch"), "n", "seq")


class History:
    """The accepted history as a folder of tables that are only appended to."""

    def __init__(self, spark, path: str, rate: float = RATE, bits: int = BITS):
        """rate: share of the longer text's words that may differ, fixed for the folder. bits (1 to 8): 2 ** bits ranges;
        choose it so that one range of one batch is a file of ordinary size."""
        self.spark, self.path, self.rate, self.bits = spark, path, rate, bits

    def _read(self, name: str) -> DataFrame | None:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        there = folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder)
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.path}/{name}") if there else None

    def _order(self, unique: DataFrame) -> Order:
        held = self._read("order")
        if held is None:
            order = Order.fitted(unique)
            self.spark.createDataFrame(order.rows(), TABLES["order"]).coalesce(1).write.parquet(f"{self.path}/order")
            return order
        return Order.of(held.toPandas())

    def append(self, rows: DataFrame) -> None:
        """rows (id, batch, text): new files of texts and pivot rows; nothing held is read but the order."""
        self.append_words(word_rows(rows))

    def append_words(self, words: DataFrame) -> None:
        unique = written(unique_texts(words, self.bits), "appended")
        order = self._order(unique)
        unique.hint("rebalance", "part").write.partitionBy("part").mode("append").parquet(f"{self.path}/texts")
        pivot_rows(unique, order, self.rate, self.bits).hint("rebalance", "range").write.partitionBy("range").mode("append").parquet(f"{self.path}/ranges")

    def check(self, rows: DataFrame) -> DataFrame:
        """The rows (id, earlier, distance) among rows (id, batch, text) that repeat an earlier row by (batch, id), of
        history or of each other: the first of its exact copies, or a near copy. Batches must be above those held. Rows
        without words are no cases. Any number of copies is settled against one row, never against each other."""
        return self.check_words(word_rows(rows))

    def check_words(self, words: DataFrame) -> DataFrame:
        fresh = written(words.where("n > 0"), "fresh")
        new = written(unique_texts(fresh, self.bits), "new")
        exact = fresh.select("id", "exact").join(new.select("exact", F.col("id").alias("earlier")), "exact").where("id <> earlier").select("id", "earlier", F.lit(0).alias("distance"))
        texts, ranges = self._read("texts"), self._read("ranges")
        order = self._order(new)
        if texts is not None:
            own = texts.where(F.col("part").isin(_touched(new, "part"))).select("exact", "id", "batch")
            # texts held already: their rows repeat the earliest row that holds them
            asked = new.select("exact", F.col("id").alias("first"))
            same = _least(own.join(asked, "exact").select("first", "batch", "id"), "first", "batch").drop("batch")
            same = written(same.withColumnRenamed("b", "held"), "same")
            new = written(new.join(same.select(F.col("first").alias("id")), "id", "left_anti"), "rest")
            exact = fresh.select("id", "exact").join(asked, "exact").join(same, "first", "left").where("held is not null or id <> first").select("id", F.coalesce("held", "first").alias("earlier"), F.lit(0).alias("distance"))
        asked = written(pivot_rows(new, order, self.rate, self.bits), "asked_ranges")
        head = asked.where(F.col("pos") < FIRST)
        quick = head.join(_least(head, "key", "batch").withColumnRenamed("batch", "bb"), "key").where("bb < batch or (bb = batch and b < id)").select(F.col("id").alias("a"), "b", F.lit(None).cast("int").alias("part"))
        old = None
        if ranges is not None:
            old = ranges.where(F.col("range").isin(_touched(asked, "range"))).select("key", "pos", "id", "batch", "n", "wide", "part")
            held = old.where(F.col("pos") < FIRST).join(head.select("key").distinct(), "key", "left_semi")
            quick = quick.unionByName(head.select("key", "id").join(_least(held, "key", "part"), "key").select(F.col("id").alias("a"), "b", "part"))
        settled = written(_closest(self._verified(written(quick.distinct(), "quick"), new, texts)), "settled")
        rest = asked.join(settled.select("id"), "id", "left_anti")
        rows = asked.select("key", "id", "batch", "n", "wide", F.lit(None).cast("int").alias("part"))
        rows = rows if old is None else rows.unionByName(old.drop("pos"))
        met = split_join(rest.select("key", "id", "batch", "n", "wide"), rows, "key").where(_near("x", "y", self.rate))
        full = met.select(F.col("x.id").alias("a"), F.col("y.id").alias("b"), F.col("y.part").alias("part")).distinct()
        late = _closest(self._verified(written(full, "full"), new, texts))
        return exact.unionByName(settled).unionByName(late)

    def _verified(self, pairs: DataFrame, new: DataFrame, texts: DataFrame | None) -> DataFrame:
        """The pairs (a, b, part) that are near, b of the held texts where part is not null."""
        side = new.select("id", "seq")
        if texts is not None:
            side = side.unionByName(texts.where(F.col("part").isin(_touched(pairs.where("part is not null"), "part"))).select("id", "seq"))
        return verified(pairs.select("a", "b"), side, self.rate)


def repeats(history: DataFrame, fresh: DataFrame, rate: float = RATE) -> DataFrame:
    """History.check of a word table fresh against a word table history, in a folder of their own."""
    held = History(fresh.sparkSession, f"{shared_dir(fresh.sparkSession)}/history-{uuid.uuid4().hex}", rate)
    held.append_words(history)
    return held.check_words(fresh)


def word_rows(rows: DataFrame) -> DataFrame:
    return word_table(rows, "text", ["id", "batch"])


def p5_found(spark, sf_dir: str) -> DataFrame:
    history = table(spark, sf_dir, "corpus_rows").select(F.col("row_id").alias("id"), F.lit(0).alias("batch"), "text")
    fresh = table(spark, sf_dir, "incoming_rows").select(F.col("row_id").alias("id"), (F.coalesce("batch_no", F.lit(0)) + 1).alias("batch"), "text")
    return repeats(word_rows(history), word_rows(fresh)).select(F.col("id").alias("row_id"))
