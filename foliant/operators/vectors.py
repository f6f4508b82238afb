"""Vector index as a table: chunks of elements, their unit vectors and where they came from."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.functions import text as X
from foliant.operators.documents import chunked
from foliant.operators.nearest import top_similar

#: Lengths that a vector may be cut to.
DIMENSIONS = (128, 256, 512, 768)


def unit(vector: Column) -> Column:
    """The vector at length one; one of no length stays as it is. The norm is made once a vector, not once a number."""
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, x: s + x * x))
    return X.let(norm, lambda n: F.when(n > 0, F.transform(vector, lambda x: x / n)).otherwise(F.transform(vector, lambda x: x.cast("double"))))


def truncated(vector: Column, dims: int) -> Column:
    """The first dims numbers, at length one again."""
    return unit(F.slice(vector, 1, dims))


def hashed_vectors(dims: int) -> Callable[[pd.Series], pd.Series]:
    """Stand-in for an embedding model: each lower-case word adds a sign to one of dims places, both by its CRC."""
    import zlib

    class Places(dict):
        """Word -> twice its place, and one more for a positive sign; held for up to a million words."""

        def __missing__(self, w: str) -> int:
            h = zlib.crc32(w.encode())
            if len(self) >= 1_000_000:
                self.clear()
            self[w] = 2 * (h % dims) + (h >> 31)
            return self[w]

    places = Places()

    def encode(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            n = np.bincount(np.array([places[w] for w in (t or "").lower().split()], np.int64), minlength=2 * dims)
            out.append((n[1::2] - n[::2]).astype(float))
        return pd.Series(out)

    return encode


def encoder(encode: Callable[[int], Callable[[pd.Series], pd.Series]], dims: int) -> Callable[[Column], Column]:
    """A column function from a maker of batch encoders; the model is made once a task."""
    if dims not in DIMENSIONS:
        raise ValueError(f"{dims} dimensions; one of {', '.join(map(str, DIMENSIONS))} is needed")

    @F.pandas_udf("array<double>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = encode(dims)
        for p in parts:
            yield model(p)

    return run


def build_index(elements: DataFrame, dims: int = 256, encode: Callable[[int], Callable[[pd.Series], pd.Series]] = hashed_vectors, size: int = 220, overlap: int = 30) -> DataFrame:
    """(vec_id, document_id, page, class, x, y, w, h, source_element_idx, chunk_no, content, embedding): the chunks of
    every element with content, in vectors of length one. vec_id is a hash of where a chunk came from, so that building
    again gives the same; source_element_idx is the element's elem_pos."""
    keys = ["document_id", "page", "class", "x", "y", "w", "h", F.col("elem_pos").alias("source_element_idx")]
    rows = chunked(elements, [*keys, "content"], size, overlap).drop("content").withColumnRenamed("chunk", "content")
    rows = rows.withColumn("vec_id", F.xxhash64("document_id", "source_element_idx", "chunk_no")).withColumn("embedding", encoder(encode, dims)(F.col("content"))).withColumn("embedding", unit(F.col("embedding")))
    return rows.select("vec_id", "document_id", "page", "class", "x", "y", "w", "h", "source_element_idx", "chunk_no", "content", "embedding")


def save_index(index: DataFrame, path: str) -> None:
    index.write.mode("overwrite").parquet(path)


def load_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def search(index: DataFrame, queries: DataFrame, k: int = 5, encode: Callable[[int], Callable[[pd.Series], pd.Series]] = hashed_vectors, dims: int = 256) -> DataFrame:
    """(query_id, rank, score, then the index's columns but the vector): the k chunks nearest to each query (query_id,
    text); scores to four places, halves to even. An empty index gives no rows."""
    q = queries.select("query_id", encoder(encode, dims)(F.col("text")).alias("e")).select("query_id", unit(F.col("e")).alias("embedding"))
    hits = top_similar(index.select("vec_id", "embedding"), q, k)
    return hits.join(index.drop("embedding"), "vec_id").select("query_id", "rank", F.bround("score", 4).alias("score"), *(c for c in index.columns if c not in ("vec_id", "embedding")))
