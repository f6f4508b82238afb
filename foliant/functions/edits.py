"""Edit distances and common grams of lists of words, as Arrow-batched functions: words become small numbers, and the
distance is computed a whole column of the matrix at a time in the bits of one whole number."""

from __future__ import annotations

from collections import Counter
from collections.abc import Hashable, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def edits(a: Sequence[Hashable], b: Sequence[Hashable]) -> int:
    """Insertions, deletions and replacements between two sequences, bit-parallel: a bit of `more` (or `less`) says that
    the distance grows (or falls) by one from one row of the column to the next."""
    lo, hi, most = 0, 0, min(len(a), len(b))
    while lo < most and a[lo] == b[lo]:
        lo += 1
    while hi < most - lo and a[-1 - hi] == b[-1 - hi]:
        hi += 1
    a, b = a[lo : len(a) - hi], b[lo : len(b) - hi]
    if not len(a) or not len(b):
        return len(a) + len(b)
    where: dict[Hashable, int] = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    all_, top = (1 << len(a)) - 1, len(a) - 1
    more, less, distance = all_, 0, len(a)
    for x in b:
        same = where.get(x, 0)
        diagonal = (((same & more) + more) ^ more) | same | less
        right_more, right_less = less | (all_ & ~(diagonal | more)), more & diagonal
        distance += (right_more >> top) - (right_less >> top)
        right_more = right_more << 1 | 1
        more, less = (right_less << 1 | ~(diagonal | right_more)) & all_, right_more & diagonal & all_
    return distance


@F.pandas_udf(T.LongType())
def word_edits(truth: pd.Series, guess: pd.Series) -> pd.Series:
    """Edits between two lists of words; null where either is."""
    return pd.Series([None if a is None or b is None else edits(a.tolist(), b.tolist()) for a, b in zip(truth, guess, strict=True)], dtype="Int64")


def common(a: Sequence[str], b: Sequence[str], n: int) -> int:
    grams = [Counter(zip(*(ws[i:] for i in range(n)), strict=False)) for ws in (a, b)]
    return (grams[0] & grams[1]).total()


def gram_hits(truth: Column, guess: Column, most: int = 4) -> Column:
    """array<long>: for n = 1 to `most`, the n-grams that two lists of words have in common, each as often as both do."""

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def hits(truth: pd.Series, guess: pd.Series) -> pd.Series:
        return pd.Series([None if a is None or b is None else [common(a.tolist(), b.tolist(), n) for n in range(1, most + 1)] for a, b in zip(truth, guess, strict=True)])

    return hits(truth, guess)
