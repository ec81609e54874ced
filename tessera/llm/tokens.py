"""Problem 7: token budget per source, language and category under an existing tokenizer.

Counting never builds identifiers. A vocabulary is compiled into an Aho-Corasick automaton over its pieces, and the
distinct words of a worker are counted once.

* BpeCounter: byte-pair vocabularies with merge ranks. At each end of a match the longest token that may follow the last
  token of the prefix before it is the one of the exact encoding; whether two tokens may stand side by side is checked once
  per pair by merging their concatenation.
* PieceCounter: vocab_pieces. Its scores are log probabilities and most pieces have no two-piece split in it, hence it's a
  unigram vocabulary and no merge order exists: the same automaton feeds a best-path count instead of the pair check."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.language import NAMES
from tessera.llm.runtime import table

MAX_CACHE = 1_000_000
MAX_PIECES = 2_000_000  # a vocabulary of more rows isn't taken for one
CATEGORIES = ("grammar", "textbook", "dictionary", "story", "government", "news", "literature", "books")


class PieceCounter:
    """Tokens of a text under a unigram vocabulary: white space runs become a word start mark, the best path by score is
    taken, fewer tokens on ties; a character no piece covers costs its UTF-8 bytes."""

    def __init__(self, pieces: list[tuple[str, float, str]]):
        self.rows = pieces
        self.compile()

    def compile(self) -> None:
        self.auto = ahocorasick.Automaton()
        self.byte = -20.0
        for piece, score, kind in self.rows:
            if kind == "normal" and piece:
                self.auto.add_word(piece, (len(piece), score))
            elif kind == "byte":
                self.byte = score
        self.auto.make_automaton()
        self.seen: dict[str, int] = {}

    def __getstate__(self) -> dict:
        return {"rows": self.rows}

    def __setstate__(self, state: dict) -> None:
        self.rows = state["rows"]
        self.compile()

    def word(self, word: str) -> int:
        marked = "▁" + word
        n = len(marked)
        score, count = [0.0] + [-1e18] * n, [0] * (n + 1)
        at = 0
        found: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        for end, value in self.auto.iter(marked):
            found[end].append(value)
        for at in range(n):
            k = at + 1
            if not any(size == 1 for size, _ in found[at]):
                b = len(marked[at].encode("utf-8", "surrogatepass"))
                score[k], count[k] = score[at] + b * self.byte, count[at] + b
            for size, s in found[at]:
                total = score[k - size] + s
                if total > score[k] + 1e-9 or (total > score[k] - 1e-9 and count[k - size] + 1 < count[k]):
                    score[k], count[k] = total, count[k - size] + 1
        return count[n]

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        seen, total = self.seen, 0
        for w in text.split():
            k = seen.get(w)
            if k is None:
                if len(seen) > MAX_CACHE:
                    seen.clear()
                k = self.word(w)
                if len(w) <= 64:
                    seen[w] = k
            total += k
        return total


class BpeCounter:
    """Exact token counts under byte-pair merge ranks and a pretokenizing pattern, in time linear in the text but for the
    number of matches at a place, which the longest token bounds."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, pattern
        self.compile()

    @classmethod
    def from_file(cls, path: str, pattern: str) -> BpeCounter:
        with open(path, "rb") as f:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}, pattern)

    def compile(self) -> None:
        import regex

        self.cut = regex.compile(self.pattern)
        self.auto = ahocorasick.Automaton()
        self.own = {}
        for token in self.ranks:
            s = token.decode("latin-1")
            self.auto.add_word(s, s)
        self.auto.make_automaton()
        self.fits: dict[tuple[str, str], bool] = {}
        self.seen: dict[str, int] = {}

    def __getstate__(self) -> dict:
        return {"ranks": self.ranks, "pattern": self.pattern}

    def __setstate__(self, state: dict) -> None:
        self.__init__(state["ranks"], state["pattern"])

    def merged(self, s: str) -> list[str]:
        """The encoding of a short string by the merges themselves."""
        parts = list(s)
        while len(parts) > 1:
            best = min(((self.ranks.get((parts[i] + parts[i + 1]).encode("latin-1"), 1 << 60), i) for i in range(len(parts) - 1)), default=(1 << 60, 0))
            if best[0] == 1 << 60:
                break
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        return parts

    def whole(self, a: str) -> bool:
        k = self.own.get(a)
        if k is None:
            k = self.own[a] = self.merged(a) == [a]
        return k

    def beside(self, a: str, b: str) -> bool:
        k = self.fits.get((a, b))
        if k is None:
            if len(self.fits) > MAX_CACHE:
                self.fits.clear()
            k = self.fits[(a, b)] = self.merged(a + b) == [a, b]
        return k

    def word(self, word: str) -> int:
        s = word.encode("utf-8", "surrogatepass").decode("latin-1")
        found: list[list[str]] = [[] for _ in s]
        for end, token in self.auto.iter(s):
            found[end].append(token)
        last: list[str | None] = [""] + [None] * len(s)
        count = [0] * (len(s) + 1)
        for end, tokens in enumerate(found):
            for token in sorted(tokens, key=len, reverse=True):
                start = end + 1 - len(token)
                before = last[start]
                if before is not None and self.whole(token) and (not before or self.beside(before, token)):
                    last[end + 1], count[end + 1] = token, count[start] + 1
                    break
        return count[len(s)]

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        total = 0
        for w in self.cut.findall(text):
            k = self.seen.get(w)
            if k is None:
                if len(self.seen) > MAX_CACHE:
                    self.seen.clear()
                k = self.word(w)
                if len(w) <= 64:
                    self.seen[w] = k
            total += k
        return total


def piece_counter(vocab: DataFrame) -> PieceCounter:
    rows = vocab.select("piece", "score", "kind").where("piece is not null").orderBy("piece_id").limit(MAX_PIECES + 1).collect()
    if len(rows) > MAX_PIECES:
        raise ValueError(f"more than {MAX_PIECES} rows are no vocabulary")
    return PieceCounter([(r[0], float(r[1] or 0.0), r[2] or "normal") for r in rows])


def counted(docs: DataFrame, keep: list[str], text: str, counter: PieceCounter | BpeCounter) -> DataFrame:
    """The keep columns and tokens; null and blank texts have none."""
    held = docs.sparkSession.sparkContext.broadcast(counter)
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep) + ", tokens long"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = held.value
        for pdf in batches:
            out = pdf[keep].copy()
            out["tokens"] = [own.count(t) for t in pdf["__text"]]
            yield out

    return docs.select(*keep, F.col(text).alias("__text")).mapInPandas(run, schema)


def tidy(c: str) -> Column:
    """Lower case, trimmed, blanks and hyphens as one underscore; unknown for null, blank and signs."""
    x = F.regexp_replace(F.lower(F.trim(F.regexp_replace(c, r"(?U)\s+", " "))), "[ \\-_]+", "_")
    return F.when(x.isNull() | ~x.rlike("[a-z0-9\\u0900-\\uabff]") | x.isin("n/a", "na", "none", "null", "und", "unknown"), "unknown").otherwise(x)


def language_code(c: str) -> Column:
    base = F.regexp_extract(F.lower(F.trim(c)), r"^([a-z]+)", 1)
    names = F.create_map(*[F.lit(x) for k, v in NAMES.items() for x in (k, v)])
    return F.when(base.isNull() | base.isin("", "und", "unknown", "n"), "unknown").otherwise(F.coalesce(names[base], base))


def category_of(c: str) -> Column:
    x = tidy(c)
    out = F.lit(None).cast("string")
    for name in reversed(CATEGORIES):
        out = F.when(x.contains(name), name).otherwise(out)
    return F.coalesce(out, x)


def budget(docs: DataFrame, vocab: DataFrame) -> DataFrame:
    """Documents, tokens and characters for every combination of source, language and category and all their totals: a
    null there is the total, told by level (1: category summed up, 2: language, 4: source)."""
    base = docs.select("text", tidy("source").alias("source"), language_code("language").alias("language"), category_of("category").alias("category"), F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("chars"))
    each = counted(base, ["source", "language", "category", "chars"], "text", piece_counter(vocab))
    fine = each.groupBy("source", "language", "category").agg(F.count("*").alias("documents"), F.sum("tokens").alias("tokens"), F.sum("chars").alias("chars"))
    return fine.cube("source", "language", "category").agg(F.grouping_id().cast("int").alias("level"), F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"), F.sum("chars").alias("chars"))


def p7_budget(spark, sf_dir: str) -> DataFrame:
    return budget(table(spark, sf_dir, "documents"), table(spark, sf_dir, "vocab_pieces"))


def p7_documents(spark, sf_dir: str) -> DataFrame:
    return counted(table(spark, sf_dir, "documents"), ["doc_id"], "text", piece_counter(table(spark, sf_dir, "vocab_pieces")))
