"""Problem 8: filling fixed-capacity containers by vector best-fit.

A container has three capacities: tokens, documents (seq_len / 16 by default) and attention cost, the sum of squared lengths
(0.9 of seq_len squared by default). An item goes to the open container that all three allow and whose residual vector, in
shares of the capacities, has the largest weighted dot product with the item's, or the least residual norm after it. An
item that alone exceeds the attention capacity has a container to itself. Items are dealt by hash into blocks of bounded
size, packed block by block from the largest item down; what is left in containers below GOOD is dealt again in fewer
blocks."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.runtime import table, written
from tessera.llm.tokens import counted, piece_counter

BLOCK = 4096  # items packed in one task at once
GOOD = 0.98
CAPACITIES = 1000  # of a stated list; more are an error
DOCUMENTS, ATTENTION = 16, 0.9
EOS = 1  # tokens that end each item
WEIGHTS = (1.0, 0.05, 0.1)


def best_fit(size: np.ndarray, capacity: int, documents: int, attention: float, rule: str = "norm", weights: tuple[float, float, float] = WEIGHTS) -> np.ndarray:
    """Container number of each item; sizes between 1 and capacity. Ties go to the earlier item and container."""
    out = np.zeros(len(size), np.int64)
    cap = np.array([capacity, documents, attention], float)
    w = np.array(weights)
    need = np.stack([size, np.ones(len(size)), size.astype(float) ** 2], axis=1) / cap
    room = np.ones((max(1, len(size)), 3))
    used = 0
    lo = 0  # containers before this one are full
    need = np.minimum(need, 1.0)  # an item above a capacity takes it all
    for i in np.argsort(-size, kind="stable"):
        r = room[lo:used]
        fits = (r >= need[i] - 1e-12).all(axis=1)
        at = np.flatnonzero(fits)
        if len(at):
            left = r[at] - need[i]
            k = at[((left * left) @ w).argmin() if rule == "norm" else ((r[at] * need[i]) @ w).argmax()] + lo
        else:
            k = used
            used += 1
        room[k] -= need[i]
        out[i] = k
        while lo < used and room[lo].min() < 1e-9:
            lo += 1
    return out


def pieces(sizes: DataFrame, packs: DataFrame) -> DataFrame:
    """(seq_len, doc_id, part, tokens): every item once per capacity; only those above it are cut, into full containers and
    a rest. Items of no token are left out."""
    items = sizes.where("tokens > 0").withColumn("whole", F.col("tokens") + EOS)
    caps = sorted({int(r[0]) for r in packs.where("seq_len > 1").select("seq_len").distinct().limit(CAPACITIES + 1).collect()})
    if len(caps) > CAPACITIES:
        raise ValueError(f"more than {CAPACITIES} capacities")
    both = items.withColumn("seq_len", F.explode(F.array(*[F.lit(c) for c in caps]).cast("array<int>")))
    cut = both.withColumn("part", F.explode(F.sequence(F.lit(0), F.floor((F.col("whole") - 1) / F.col("seq_len")).cast("int"))))
    return cut.select("seq_len", "doc_id", "part", F.least(F.col("seq_len").cast("long"), F.col("whole") - F.col("part") * F.col("seq_len")).alias("tokens"))


def packed(items: DataFrame, max_documents: int | None = None, attention_share: float = ATTENTION, rule: str = "norm") -> DataFrame:
    """(seq_len, container, doc_id, part, tokens) for items (seq_len, doc_id, part, tokens). max_documents: of a container,
    seq_len / 16 if None; attention_share: its attention capacity as a share of seq_len squared."""
    kind = items.schema["doc_id"].dataType.simpleString()
    schema = f"seq_len int, container string, doc_id {kind}, part int, tokens long, fill double"

    def one(stage: str):
        def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            cap = int(key[0])
            pdf = pdf.sort_values(["doc_id", "part"], kind="stable").reset_index(drop=True)
            got = best_fit(pdf["tokens"].to_numpy(), cap, max_documents or max(1, cap // DOCUMENTS), attention_share * cap * cap, rule)
            total = np.bincount(got, pdf["tokens"].to_numpy())
            out = pdf[["seq_len", "doc_id", "part", "tokens"]].copy()
            out["container"] = [f"{stage}{int(key[1])}-{c}" for c in got]
            out["fill"] = total[got] / cap
            return out[["seq_len", "container", "doc_id", "part", "tokens", "fill"]]

        return run

    def dealt(rows: DataFrame, stage: str) -> DataFrame:
        many = {r["seq_len"]: max(1, -(-r["n"] // BLOCK)) for r in rows.groupBy("seq_len").agg(F.count("*").alias("n")).collect()}
        if not many:
            return items.sparkSession.createDataFrame([], schema)
        blocks = F.create_map(*[F.lit(x) for k, v in many.items() for x in (int(k), int(v))])
        block = F.pmod(F.xxhash64("doc_id", "part", F.lit(stage)), blocks[F.col("seq_len")])
        return rows.withColumn("block", block).groupBy("seq_len", "block").applyInPandas(one(stage), schema)

    full = items.where("tokens = seq_len").select("seq_len", F.concat(F.lit("f"), F.col("doc_id").cast("string"), F.lit("-"), F.col("part").cast("string")).alias("container"), "doc_id", "part", "tokens")
    first = written(dealt(items.where("tokens < seq_len"), "a"), "packed")
    again = first.where(F.col("fill") < GOOD).select("seq_len", "doc_id", "part", "tokens")
    return full.unionByName(first.where(F.col("fill") >= GOOD).drop("fill")).unionByName(dealt(again, "b").drop("fill"))


def filled(spark, sf_dir: str) -> DataFrame:
    docs, vocab = table(spark, sf_dir, "documents"), table(spark, sf_dir, "vocab_pieces")
    items = written(pieces(counted(docs, ["doc_id"], "text", piece_counter(vocab)), table(spark, sf_dir, "pack_sizes")), "items")
    return packed(items)


def p8_containers(spark, sf_dir: str) -> DataFrame:
    """The container of every item and part, for each capacity."""
    return filled(spark, sf_dir)


def p8_fill(spark, sf_dir: str) -> DataFrame:
    """Per capacity: items, containers, tokens, unused share, and the least number of containers any packing could have."""
    one = filled(spark, sf_dir).groupBy("seq_len", "container").agg(F.count("*").alias("items"), F.sum("tokens").alias("tokens"))
    return one.groupBy("seq_len").agg(F.sum("items").alias("items"), F.count("*").alias("containers"), F.sum("tokens").alias("tokens"), F.ceil(F.sum("tokens") / F.first("seq_len")).alias("least_containers"), F.round(1 - F.sum("tokens") / (F.count("*") * F.first("seq_len")), 5).alias("unused_share"))
