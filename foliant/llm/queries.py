"""The thin queries opN_<name>: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.llm import embeddings, fingerprints, langid, licenses, mixing, ngramjoin, oracles, packing, pointintime, substring, suffix, toxicity, urls, vptree

#: The list of op2: sites of unwanted pages, one a line.
LISTED = Path(__file__).with_name("listed_urls.txt")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix_sources(docs).select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken")


def listed_urls(path: Path = LISTED) -> list[str]:
    return path.read_text(encoding="utf-8").split()


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = spark.range(1).select(F.explode(F.array(*map(F.lit, listed_urls()))).alias("url"))
    return urls.filter_urls(read(spark, sf_dir, "pages").select("page_id", "url"), listed).select("page_id", "host", "path", "rule", "verdict")


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    return embeddings.dedup_embeddings(vectors).select("vec_id", "n_links", "component_id", "kept")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan_licenses(docs).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return substring.dedup_substrings(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramjoin.near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.learn(docs, read(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, model).select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", "predicted")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack_documents(docs, tokenizer_path(), with_ids=False).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix.dedup_suffixes(docs).select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"), "n_passage")


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    docs = fingerprints.with_next(docs, "doc_id", "text", fingerprints.fingerprint_documents, ("sketch",)).withColumn("edited", fingerprints.edited_text(F.col("text"), F.col("next_text")))
    docs = fingerprints.add_sketch(docs, F.col("edited"), "edited_sketch")
    likeness = lambda other: fingerprints.resemblance(F.col("sketch"), F.col(other))
    return docs.select(
        "doc_id", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        fingerprints.as_text(F.col("sketch")).alias("fingerprint"), fingerprints.as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness("edited_sketch").alias("near_edited"), likeness("next_sketch").alias("near_next"),
    )


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.learn(docs.where(~langid.held_out("doc_id")))
    return langid.predict(docs.select("doc_id", "text"), model).select("doc_id", langid.held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", "embedding", label.alias("label"))
    return vptree.hard_negatives(vectors, F.col("vec_id") % 100 == 0)


def op13_point_in_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pointintime.point_in_time(read(spark, sf_dir, "sales"), read(spark, sf_dir, "clicks"), read(spark, sf_dir, "sale_lines"))


_ALL = (op1_mix_sources, op2_url_filter, op3_embedding_dedup, op4_license_scan, op5_substring_dedup, op6_ngram_join, op7_toxicity, op8_packing, op9_suffix_dedup, op10_fingerprints, op11_language_id, op12_hard_negatives, op13_point_in_time)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in _ALL}


ORACLES: dict[str, str] = {
    "op1_mix_sources": oracles.mix_sql(), "op2_url_filter": oracles.urls_sql(LISTED), "op3_embedding_dedup": oracles.embeddings_sql(), "op4_license_scan": oracles.licenses_sql(),
    "op5_substring_dedup": oracles.substring_sql(), "op6_ngram_join": oracles.ngram_sql(), "op9_suffix_dedup": oracles.suffix_sql(), "op12_hard_negatives": oracles.hard_negatives_sql(), "op13_point_in_time": oracles.point_in_time_sql(),
}
