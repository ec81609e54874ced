"""Column functions and aggregates: reference-based text metrics under honest names. A null text is an empty one."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.text import strip, words


def _w(c: Column) -> Column:
    return words(F.lower(F.coalesce(c, F.lit(""))))


def hits(pred: Column, ref: Column) -> Column:
    """Words of pred that ref has, repeats counted."""
    r = _w(ref)
    return F.size(F.filter(_w(pred), lambda w: F.array_contains(r, w)))


def unigram_precision(pred: Column, ref: Column) -> Column:
    """Aggregate, in percent over all rows together."""
    n = F.sum(F.size(_w(pred)))
    return F.when(n > 0, 100.0 * F.sum(hits(pred, ref)) / n).otherwise(0.0)


def char_fscore(pred: Column, ref: Column, n: int = 3, beta: float = 2.0) -> Column:
    """Per row, in percent: n-grams of pred found in ref, repeats counted, over all of either's distinct n-grams. Sets of
    n-grams in Python: as arrays in the JVM each look-up would be a scan."""
    b = beta * beta

    @F.pandas_udf("double")
    def score(p: pd.Series, r: pd.Series) -> pd.Series:
        def one(x: str | None, y: str | None) -> float:
            x, y = x or "", y or ""
            have = {y[i : i + n] for i in range(len(y) - n + 1)}
            own = [x[i : i + n] for i in range(len(x) - n + 1)]
            same = sum(g in have for g in own)
            if not same:
                return 0.0
            prec, rec = same / len(set(own)), same / len(have)
            return 100.0 * (1 + b) * prec * rec / (b * prec + rec)

        return pd.Series([one(x, y) for x, y in zip(p, r, strict=True)])

    return score(pred, ref)


def overlap_f1(pred: Column, ref: Column) -> Column:
    """Per row: common distinct words over the word counts of either, as an F1."""
    p, r = _w(pred), _w(ref)
    k = F.size(F.array_intersect(p, r))
    return F.when((F.size(p) == 0) | (F.size(r) == 0) | (k == 0), 0.0).otherwise(2.0 * (k / F.size(p)) * (k / F.size(r)) / (k / F.size(p) + k / F.size(r)))


def token_set_f1(pred: Column, ref: Column) -> Column:
    p, r = F.array_distinct(_w(pred)), F.array_distinct(_w(ref))
    k = F.size(F.array_intersect(p, r))
    return F.when(k == 0, 0.0).otherwise(2.0 * k / (F.size(p) + F.size(r)))


def exact_match(pred: Column, ref: Column) -> Column:
    return strip(F.lower(F.coalesce(pred, F.lit("")))) == strip(F.lower(F.coalesce(ref, F.lit(""))))


def perplexity(loss: Column, cap: float = 20.0) -> Column:
    """Aggregate: exp of the mean of the finite losses, capped; null without any."""
    finite = F.when(~F.isnan(loss) & (F.abs(loss) < float("inf")), loss)
    return F.exp(F.least(F.avg(finite), F.lit(cap)))


def band(value: Column, cuts: tuple[tuple[float, str], ...], otherwise: str) -> Column:
    """The first label whose limit the value doesn't exceed."""
    out = F.lit(otherwise)
    for limit, label in reversed(cuts):
        out = F.when(value <= limit, label).otherwise(out)
    return out


def cosine(a: Column, b: Column) -> Column:
    """0 for a missing or zero vector."""
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, v: s + v)
    norm = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    n = norm(a) * norm(b)
    return F.coalesce(F.when(n > 0, dot / n), F.lit(0.0))


def pair_score(source: Column, target: Column) -> Column:
    """Quality of a parallel pair from its length ratio; 0 for an empty side, 0.2 out of bounds."""
    s, t = F.size(words(F.coalesce(source, F.lit("")))), F.size(words(F.coalesce(target, F.lit(""))))
    ratio = t / s
    score = F.round(F.least(F.greatest(F.lit(0.95) - 0.2 * F.abs(ratio - 1.2), F.lit(0.0)), F.lit(1.0)), 3)
    return F.when((s == 0) | (t == 0), 0.0).when((ratio < 0.25) | (ratio > 4.0), 0.2).otherwise(score)


def grade(perplexity: Column, switch_rate: Column, unknown_rate: Column) -> Column:
    """A+ to C from perplexity, script switches and unknown tokens; B+ where the perplexity is not known."""
    bad = (unknown_rate > 0.05) | (switch_rate > 0.3) | (perplexity > 100)
    best = (perplexity <= 20) & (switch_rate < 0.05) & (unknown_rate == 0)
    return F.when(bad, "C").when(best, "A+").when((perplexity <= 50) & (switch_rate < 0.1), "A").when(perplexity <= 100, "B").otherwise("B+")


def pair_valid(source: Column, target: Column) -> Column:
    """Whether a parallel pair has two sides whose lengths in words are in bounds."""
    s, t = F.size(words(F.coalesce(source, F.lit("")))), F.size(words(F.coalesce(target, F.lit(""))))
    return (s > 0) & (t > 0) & F.coalesce(F.try_divide(t, s).between(0.25, 4.0), F.lit(False))
