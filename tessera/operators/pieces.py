"""Encoding with a scored piece vocabulary, and what follows from it for a tokenizer's fitness."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Pieces:
    """Best path by score over the pieces of a word with its start mark; UTF-8 bytes for what no piece covers."""

    def __init__(self, rows: list[tuple[int, str, float, str]]):
        self.score = {p: (s, i) for i, p, s, k in rows if k == "normal"}
        self.byte = {int(p[3:5], 16): i for i, p, _, k in rows if k == "byte"}
        self.unknown = next((i for i, _, _, k in rows if k == "unknown"), 0)
        self.piece = {i: p for i, p, _, k in rows if k == "normal"}
        self.back = {i: b for b, i in self.byte.items()}
        self.longest = max(map(len, self.score), default=1)
        self.seen: dict[str, list[int]] = {}

    def word(self, word: str) -> list[int]:
        w = "▁" + word
        best: list[tuple[float, int, list[int]]] = [(0.0, 0, [])]
        for end in range(1, len(w) + 1):
            c = w[end - 1].encode("utf-8", "surrogatepass")
            s, _, ids = best[end - 1]
            top = (s - 20.0 * len(c), end - 1, [self.byte.get(b, self.unknown) for b in c])
            for start in range(max(0, end - self.longest), end):
                if (got := self.score.get(w[start:end])) and best[start][0] + got[0] > top[0]:
                    top = (best[start][0] + got[0], start, [got[1]])
            best.append(top)
        out: list[int] = []
        at = len(w)
        while at:
            _, before, ids = best[at]
            out = ids + out
            at = before
        return out

    def encode(self, text: str | None) -> list[int]:
        out: list[int] = []
        for w in (text or "").split():
            if (ids := self.seen.get(w)) is None:
                ids = self.word(w)
                if len(self.seen) < 500_000 and len(w) < 65:
                    self.seen[w] = ids
            out += ids
        return out

    def decode(self, ids: list[int]) -> str:
        raw = b"".join(bytes([self.back[i]]) if i in self.back else self.piece.get(i, "").encode() for i in ids)
        return raw.decode("utf-8", "replace").replace("▁", " ").strip()


def load(vocab: DataFrame, most: int = 2_000_000) -> Pieces:
    """The vocabulary on the driver; it is one table of a tokenizer, of at most `most` rows."""
    rows = vocab.select("piece_id", "piece", "score", "kind").where("piece is not null").orderBy("piece_id").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows are no vocabulary")
    return Pieces([tuple(r) for r in rows])


def encoded(df: DataFrame, text: str, vocab: DataFrame, keep: list[str], limit: int | None = None) -> DataFrame:
    """keep columns, input_ids, and whether the text comes back but for white space. limit truncates the ids."""
    held = df.sparkSession.sparkContext.broadcast(load(vocab))
    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep) + ", input_ids array<int>, round_trip boolean"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = held.value
        for pdf in batches:
            out = pdf[keep].copy()
            ids = [p.encode(t) for t in pdf["__text"]]
            out["input_ids"] = [x[:limit] for x in ids]
            out["round_trip"] = [p.decode(x) == " ".join((t or "").split()) for x, t in zip(ids, pdf["__text"], strict=True)]
            yield out

    return df.select(*keep, F.col(text).alias("__text")).mapInPandas(run, schema)
