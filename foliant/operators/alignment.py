"""Token alignment scores: each token of one text meets the most similar token of the other, weighted by rarity."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.functions import text as X

LETTERS = "abcdefghijklmnopqrstuvwxyz"
#: Encodes tokens, a list of texts, as rows of a matrix.
Encoder = Callable[[list[str]], np.ndarray]


def letters(tokens: list[str]) -> np.ndarray:
    """A stand-in encoder: how often a token holds each letter, and how many other characters."""
    known = np.array([[t.count(c) for c in LETTERS] for t in tokens], float).reshape(len(tokens), len(LETTERS))
    return np.column_stack((known, np.array([len(t) for t in tokens], float) - known.sum(axis=1)))


def best_cosines(a: np.ndarray, b: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest cosine of each row of a with a row of b, and the other way round; block * block of them at a time."""
    unit = lambda m: m / np.maximum(np.sqrt((m * m).sum(axis=1, keepdims=True)), 1e-300)
    a, b = unit(a), unit(b)
    best = np.full(len(a), -np.inf), np.full(len(b), -np.inf)
    for i in range(0, len(a), block):
        for j in range(0, len(b), block):
            cos = a[i : i + block] @ b[j : j + block].T
            best[0][i : i + block] = np.maximum(best[0][i : i + block], cos.max(axis=1))
            best[1][j : j + block] = np.maximum(best[1][j : j + block], cos.max(axis=0))
    return best


def align(reference: list[str], prediction: list[str], weight: dict[str, float], encode: Encoder, block: int = 1024) -> tuple[float, float, float]:
    """(precision, recall, F1) of a prediction's tokens; all 0 where either has none."""
    if not reference or not prediction:
        return 0.0, 0.0, 0.0
    sides = [np.unique(np.array(x, object), return_counts=True) for x in (reference, prediction)]
    recall, precision = (
        float((n * w * best).sum() / (n * w).sum())
        for (names, n), best in zip(sides, best_cosines(*(np.asarray(encode(s[0].tolist()), float) for s in sides), block), strict=True)
        for w in [np.array([weight[t] for t in names])]
    )
    return precision, recall, 2 * precision * recall / (precision + recall) if precision + recall > 0 else 0.0


def bert_scores(pairs: DataFrame, reference: str, prediction: str, encode: Encoder = letters, block: int = 1024) -> DataFrame:
    """Every column of pairs, with precision, recall and f1 of the prediction's lower-case words.

    A word's weight is 1 + ln((N + 1) / (n + 1)) where n of the N references hold it. Null texts have no words, and pairs
    without words on either side score 0. Equal pairs are scored once. The vocabulary is joined, never broadcast or
    collected; one pair's words meet in blocks.
    """
    rows = pairs.withColumn("__k", F.sha2(F.to_json(F.array(F.coalesce(reference, F.lit("")), F.coalesce(prediction, F.lit("")))), 256))
    words = lambda c: X.words(F.lower(F.coalesce(c, F.lit(""))))
    total = pairs.agg(F.count("*").alias("__n"))
    held = pairs.select(F.explode(F.array_distinct(words(reference))).alias("t")).groupBy("t").agg(F.count("*").alias("held"))
    texts = rows.groupBy("__k").agg(F.first(reference).alias("r"), F.first(prediction).alias("p")).select("__k", words("r").alias("r"), words("p").alias("p"))
    tokens = texts.select("__k", F.explode(F.array_distinct(F.concat("r", "p"))).alias("t")).join(held, "t", "left")
    weight = 1 + F.ln((F.col("__n") + 1) / (F.coalesce("held", F.lit(0)) + 1))
    weighted = tokens.crossJoin(F.broadcast(total)).groupBy("__k").agg(F.collect_list(F.struct("t", weight.alias("w"))).alias("ws"))  # one row

    @F.pandas_udf(T.StructType([T.StructField(c, T.DoubleType()) for c in ("precision", "recall", "f1")]))
    def score(r: pd.Series, p: pd.Series, names: pd.Series, weights: pd.Series) -> pd.DataFrame:
        out = [align(list(a), list(b), dict(zip(n, w, strict=True)), encode, block) for a, b, n, w in zip(r, p, names, weights, strict=True)]
        return pd.DataFrame(out, columns=["precision", "recall", "f1"], dtype=float)

    empty = F.array().cast("array<struct<t:string,w:double>>")
    scored = texts.join(weighted, "__k", "left").withColumn("ws", F.coalesce("ws", empty)).select("__k", score("r", "p", F.col("ws.t"), F.col("ws.w")).alias("s"))
    return rows.join(scored, "__k").select(*pairs.columns, "s.precision", "s.recall", "s.f1")
