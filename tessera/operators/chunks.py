"""Overlapping chunks, exact-count splits, shards and fingerprints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import strip, words
from tessera.operators.packing import positions

GROUPS = 4096


def chunked(df: DataFrame, text: str = "text", size: int = 2048, overlap: int = 128, unit: str = "words") -> DataFrame:
    """df with chunk_id, total_chunks and the chunk in place of the text: windows of `size` words or code points, each
    `overlap` into the last; a text no longer than one window is its own stripped self. Blank windows and rows without a
    chunk go, null and blank texts among them. Each step is its own column, lest a lambda compute the words again."""
    step = size - overlap
    if step <= 0:
        raise ValueError("overlap must be below size")
    rows = df.withColumn("__t", strip(F.coalesce(F.col(text), F.lit(""))))
    rows = rows.withColumn("__w", words(F.col("__t")) if unit == "words" else F.lit(None).cast("array<string>"))
    rows = rows.withColumn("__n", F.size("__w") if unit == "words" else F.length("__t"))
    k = F.greatest(F.ceil((F.col("__n") - overlap) / step), F.lit(1)).cast("int")
    at = F.sequence(F.lit(0), k - 1)
    parts = F.transform(at, lambda i: F.array_join(F.slice("__w", i * step + 1, F.lit(size)), " ")) if unit == "words" else F.transform(at, lambda i: strip(F.substr("__t", i * step + 1, F.lit(size))))
    rows = rows.withColumn("__c", F.filter(F.when(F.col("__n") <= size, F.array("__t")).otherwise(parts), lambda x: x != ""))
    made = rows.select("*", F.posexplode("__c").alias("chunk_id", "__x"), F.size("__c").alias("total_chunks"))
    return made.withColumn(text, F.col("__x")).drop("__c", "__x", "__t", "__w", "__n")


def ranked(df: DataFrame, by: list[Column], name: str = "rank") -> DataFrame:
    """df with its row's place, from 1, in the order of `by`, without sorting all rows in one task: the first column's hash
    order is cut into groups, group sizes give offsets, and places are counted within groups. by[0] must be a number."""
    if not by:
        raise ValueError("an order is needed")
    cut = F.shiftright(by[0], 52)  # 4096 groups of equal width in the order of a 64-bit hash
    grouped = df.withColumn("__g", cut)
    sizes = grouped.groupBy("__g").agg(F.count("*").alias("__n"))
    offset = F.sum("__n").over(Window.orderBy("__g").rowsBetween(Window.unboundedPreceding, -1))  # at most 4096 rows
    starts = sizes.select("__g", F.coalesce(offset, F.lit(0)).alias("__s"))
    place = F.row_number().over(Window.partitionBy("__g").orderBy(*by))
    return grouped.join(F.broadcast(starts), "__g").withColumn(name, F.col("__s") + place).drop("__g", "__s")


def hash_order(key: str, seed: int) -> list:
    """A fixed order that looks like chance: by the first 60 bits of the MD5 of seed and key, then the key."""
    digits = F.substring(F.md5(F.concat_ws("-", F.lit(str(seed)), F.col(key).cast("string"))), 1, 15)
    return [F.conv(digits, 16, 10).cast("long") * 8, F.col(key)]


def split_rows(df: DataFrame, key: str, train: float = 0.98, validation: float = 0.01, test: float = 0.01, seed: int = 42) -> DataFrame:
    """df with a split column of exact sizes, in hash order of the key: test first, validation of the rest, then train. All
    train for fewer than three rows. Ratios are taken in relation to their sum."""
    total = train + validation + test
    n = df.count()
    n_test = int(-(-n * test // total)) if n >= 3 and test > 0 else 0
    n_validation = int(-(-n * validation // total)) if n >= 3 and validation > 0 else 0
    rows = ranked(df, hash_order(key, seed), "__r")
    return rows.withColumn("split", F.when(F.col("__r") <= n_test, "test").when(F.col("__r") <= n_test + n_validation, "validation").otherwise("train")).drop("__r")


def sharded(df: DataFrame, order: str, size: int = 10_000, by: str | None = None) -> DataFrame:
    """df with shard number and row in shard, by split if `by` is given, in the order of a unique number."""
    rows = positions(df.withColumn("__one", F.lit(1)), order, "__one", by, "__place").drop("__one")
    return rows.withColumn("shard", F.floor(F.col("__place") / size)).withColumn("shard_row", F.col("__place") % size).drop("__place")


def fingerprint(hashes: DataFrame, column: str) -> DataFrame:
    """One row: the number of rows and the hash of all rows' hex hashes, whatever their order. Equal hashes are counted
    first; the sorted ones of a group (first five digits) are hashed, then the groups' hashes by their first two digits,
    then those, so that no list grows with one hash, nor any beyond its share of the different ones."""
    lines = hashes.groupBy(F.col(column).alias("h")).agg(F.count("*").alias("n")).where("h is not null")
    joined = lambda x: F.sha2(F.array_join(F.array_sort(F.collect_list(x)), ","), 256).alias("h")
    groups = lines.groupBy(F.substring("h", 1, 5).alias("g")).agg(F.sum("n").alias("n"), joined(F.concat_ws(":", "h", F.col("n").cast("string"))))
    some = groups.groupBy(F.substring("g", 1, 2).alias("g")).agg(F.sum("n").alias("n"), joined(F.concat_ws(":", "g", "h")))
    return some.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), joined(F.concat_ws(":", "g", "h")).alias("fingerprint"))


def task_split(df: DataFrame, key: str, train: float = 0.90, validation: float = 0.05, test: float = 0.05, seed: int = 42) -> DataFrame:
    """df with a split column: floor(n * train) rows of train, at least one of validation, the rest test, of three rows
    two and one; in hash order of the key. Of fewer rows each is in all three. Ratios must sum to one."""
    if round(train + validation + test, 4) != 1.0:
        raise ValueError("the ratios must sum to 1.0")
    n = df.count()
    if n < 3:
        return df.withColumn("split", F.explode(F.array(F.lit("train"), F.lit("validation"), F.lit("test"))))
    first = int(n * train)
    last = first + max(1, int(n * validation))
    if first == n:
        first, last = n - 2, n - 1
    elif last >= n:
        last = n - 1
    rows = ranked(df, hash_order(key, seed), "__r")
    return rows.withColumn("split", F.when(F.col("__r") <= first, "train").when(F.col("__r") <= last, "validation").otherwise("test")).drop("__r")
