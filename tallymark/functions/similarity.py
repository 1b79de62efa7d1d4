"""Pairwise similarity: Column expressions, and one Arrow function for subsequence ratios."""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .text import tokenize


def both_equal(a: Column, b: Column) -> Column:
    return ((a == b) & (a != "")).cast("int")


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays as sets; 0 if both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def characters(text: Column) -> Column:
    return F.when(F.length(text) == 0, F.array().cast("array<string>")).otherwise(F.array_distinct(F.filter(F.split(text, ""), lambda c: c != "")))


def length_diff(a: Column, b: Column) -> Column:
    return F.abs(F.length(a) - F.length(b))


def numeric_overlap(a: Column, b: Column) -> Column:
    """The share of a's tokens, repeats counted, that b has."""
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(F.size(F.filter(a, lambda x: F.array_contains(b, x))) / F.size(a))


def lcs_native(a: Column, b: Column) -> Column:
    """The length of the longest common subsequence as nested folds; slow, for checks."""
    zeros = F.array_repeat(F.lit(0), F.length(b) + 1)

    def row(before, ca):
        def step(acc, j):
            here = F.when(F.substr(b, j, F.lit(1)) == ca, F.get(before, j - 1) + 1).otherwise(F.greatest(F.get(before, j), F.get(acc, j - 1)))
            return F.concat(acc, F.array(here))

        return F.aggregate(F.sequence(F.lit(1), F.length(b)), F.array(F.lit(0)), step)

    folded = F.aggregate(F.filter(F.split(a, ""), lambda c: c != ""), zeros, row)
    return F.when((F.length(a) == 0) | (F.length(b) == 0), F.lit(0)).otherwise(F.element_at(folded, -1))


def lcs(a: str, b: str) -> int:
    """Bit-parallel: a row of the table is one integer."""
    masks: dict[str, int] = {}
    for k, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << k
    full = (1 << len(a)) - 1
    state = full
    for c in b:
        u = state & masks.get(c, 0)
        state = ((state + u) | (state - u)) & full
    return len(a) - state.bit_count()


def indel_ratio(a: str, b: str) -> float:
    return 200.0 * lcs(a, b) / (len(a) + len(b)) if a and b else 0.0


def _windows(short: str, long: str) -> float:
    """The best ratio of short with a window of its size in long, cut short at the ends."""
    m, spare, common, bounds = len(short), Counter(short), 0, []
    for at in range(len(long) + m - 1):  # the window that ends with this character
        for c, step in ((long[at] if at < len(long) else "", -1), (long[at - m] if at >= m else "", 1)):
            if c in spare:
                # characters in common, repeats counted: no subsequence has more
                common -= step if (spare[c] > 0 if step < 0 else spare[c] >= 0) else 0
                spare[c] += step
        first = max(0, at - m + 1)
        bounds.append((200.0 * common / (m + min(at + 1, len(long)) - first), first, min(at + 1, len(long))))
    best = 0.0
    for most, first, end in sorted(bounds, reverse=True):
        if most <= best:
            break
        best = max(best, indel_ratio(short, long[first:end]))
    return best


def best_window_ratio(a: str, b: str) -> float:
    """The best ratio of the shorter text with a window of the longer; of two as long, either may slide."""
    short, long = sorted((a, b), key=len)
    if not short:
        return 0.0
    if short in long:
        return 100.0
    best = _windows(short, long)
    return max(best, _windows(long, short)) if len(a) == len(b) else best


def token_sort_ratio(a: str, b: str) -> float:
    return indel_ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set_ratio(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, left, right = " ".join(sorted(x & y)), " ".join(sorted(x - y)), " ".join(sorted(y - x))
    if both and (not left or not right):
        return 100.0
    gap = 1 if both else 0
    size_l, size_r = len(both) + gap + len(left), len(both) + gap + len(right)
    apart = len(left) + len(right) - 2 * lcs(left, right)
    best = 100.0 * (1 - apart / (size_l + size_r))
    if both:
        best = max(best, *(100.0 * (1 - (gap + len(z)) / (len(both) + s)) for z, s in ((left, size_l), (right, size_r))))
    return best


RATIOS = {"fuzzy_ratio": indel_ratio, "partial_ratio": best_window_ratio, "token_sort_ratio": token_sort_ratio, "token_set_ratio": token_set_ratio}


def ratios(a: Column, b: Column, *names: str) -> Column:
    """A struct of the named ratios, in one pass; each pair of a batch is computed once, and equal ones not at all."""
    schema = StructType([StructField(n, DoubleType(), False) for n in names])
    functions = [RATIOS[n] for n in names]

    @F.pandas_udf(schema)
    def run(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        known: dict[tuple[str, str], list[float]] = {}
        out = []
        for pair in zip(a.fillna(""), b.fillna("")):
            if pair not in known:
                x, y = pair
                known[pair] = [0.0] * len(functions) if not x or not y else [100.0] * len(functions) if x == y and x.strip() else [f(x, y) for f in functions]
            out.append(known[pair])
        return pd.DataFrame(out, columns=list(names), dtype="float64")

    return run(a, b)


def fuzzy_ratio(a: Column, b: Column) -> Column:
    return ratios(a, b, "fuzzy_ratio")["fuzzy_ratio"]


def token_sort(a: Column, b: Column) -> Column:
    return ratios(a, b, "token_sort_ratio")["token_sort_ratio"]


def token_sets(a: Column, b: Column) -> tuple[Column, Column]:
    return F.array_distinct(tokenize(a)), F.array_distinct(tokenize(b))
