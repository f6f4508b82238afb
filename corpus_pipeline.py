"""A corpus pipeline over the documents: toxicity, near duplicates, repeated passages, source mix, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.llm import mixing, ngramjoin, packing, queries, shards, substring, toxicity


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go; null and empty texts are scored as any others, repeated rows alike.
    Without toxic or without other labels the model is blank and all stay."""
    model = toxicity.learn(docs, queries.read(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, model).where("predicted = 0").select(*shards.own_columns(docs, "score", "predicted", "hits").values())


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates one row stays: that of smallest id, null ids last, then the first written. Rows
    have a written number, so rows of null and repeated ids are told apart. Rows without words link with nothing and
    stay."""
    path = f"{shards.shared_dir(spark)}/numbered"
    docs.withColumn("__row", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    classes = ngramjoin.near_duplicates(rows, "__row").select("__row", "class_id").join(rows.select("__row", "doc_id"), "__row")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__row"))
    kept = classes.groupBy("class_id").agg(first.alias("r")).select(F.col("r.__row").alias("__row"))
    return rows.join(kept, "__row", "left_semi").select(*docs.columns)


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 20 words or more that stand earlier go from the texts; every row stays, an emptied text as an empty
    one, a null text too. n_chars, where there is one, follows the text."""
    out = substring.dedup_substrings(docs)
    texts = {"text": F.col("kept_text").alias("text")}
    if "n_chars" in docs.columns:
        texts["n_chars"] = F.length("kept_text").cast(docs.schema["n_chars"].dataType).alias("n_chars")
    own = shards.own_columns(docs, "kept_text", "n_words", "n_removed")
    return out.select(*(texts.get(c, column) for c, column in own.items()))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: documents as often as the mix takes them. Rows without words go, for nothing can
    be taken of them; null sources are a source of their own."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2,048 ids; every row is packed, repeated ones as often as they are there."""
    return packing.pack_documents(docs, queries.tokenizer_path()).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids")


STAGES = [("toxicity", clean), ("near_duplicates", distinct), ("repeated_passages", unrepeated), ("source_mix", mixed), ("packing", packed)]

#: Stages learn, hash and tokenise: no SQL gives these rows; tests hold the first three stages' rows against
#: brute force, and the words and ids of the last two against plain counts.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again in the session's checkpoint folder."""
    docs, path = queries.read(spark, sf_dir, "documents"), shards.shared_dir(spark)
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{path}/{k}_{name}")
        docs = spark.read.parquet(f"{path}/{k}_{name}")
    return docs
