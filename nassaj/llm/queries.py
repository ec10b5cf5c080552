"""One query per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from nassaj.llm import bpe, html, jaccard, langid, lines, nra, packing, pii, quality, refine, sharding, vafile, whitening
from nassaj.llm.staging import new_path, small_batches

#: Of the registered query alone; who pseudonymises data keeps a key of their own.
SHOWN_KEY = "shown"

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def op1_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten largest inner products of every hundredth vector with all others."""
    rows = _table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return vafile.top_k(rows, "vec_id", "embedding", F.col("vec_id") % 100 == 0, k=10, scale=1024)


def op2_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line-first cleaning of every document: measures and verdict."""
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    judged = docs.select("doc_id", lines.line_rules("text").alias("v")).select("doc_id", "v.*")
    return judged.withColumn("cleaned_sha256", F.sha2("cleaned", 256)).drop("cleaned")


def op3_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document by the tree, and what they decode to, as digests."""
    path = bpe.vocabulary_file()
    ids = bpe.encode(_table(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", "text", path)
    return ids.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(bpe.decode_column("ids", path), 256).alias("decoded_sha256"),
    )


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share 85 % of their four-word shingles."""
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return jaccard.jaccard_components(docs, "doc_id", "text", shingle=4, percent=85)


def op5_string_kernels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those not held out."""
    docs = _table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    out = langid.held_out("doc_id")
    model = langid.fit(docs.where(~out), "doc_id", "text", "lang")
    found = docs.select("doc_id", out.alias("held_out"), langid.identify("text", model).alias("v"))
    return found.select("doc_id", "held_out", "v.*")


def op6_shard_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document written to its shard, of 64; where each one lies, as read from the shards."""
    docs = _table(spark, sf_dir, "documents", "*")
    placed, path = sharding.place(docs, "doc_id", [f"shard-{k:02d}" for k in range(64)]), new_path(spark, "shards")
    sharding.write(placed, path)
    return spark.read.schema(placed.schema).parquet(path).select("doc_id", "slot", "shard")


def op7_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document, learned from the labels not held out."""
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    labels = _table(spark, sf_dir, "labels", "doc_id", "quality").where(~langid.held_out("doc_id"))
    model = quality.fit(docs, labels, "doc_id", "text", "quality")
    scored = docs.select("doc_id", langid.held_out("doc_id").alias("held_out"), quality.quality("text", model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= quality.THRESHOLD).cast("int"))


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = _table(spark, sf_dir, "pages", "page_id", "url", "html")
    found = pages.select("page_id", "url", html.extract("html").alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("bigint"))


def op9_feistel_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal values under pseudonyms, and how many it has."""
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    found = docs.select("doc_id", pii.pseudonyms("text", SHOWN_KEY).alias("new"), F.size(pii.values("text")).cast("bigint").alias("n_values"))
    return found.withColumnRenamed("new", "text")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in sequences of at most 2048 tokens, mixed by source in proportion."""
    docs = _table(spark, sf_dir, "documents", "doc_id", "source", "text")
    return packing.pack(docs, bpe.vocabulary_file(), key="doc_id", source="source", text="text")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten highest-scoring documents of every benchmark item."""
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return nra.search(docs, _table(spark, sf_dir, "benchmark", "item_id", "text"), k=10)


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal documents, the row that stays, and the digest of every text."""
    return refine.exact_duplicates(_table(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", "text", digest_all=True)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding on the 32 leading components, whitened."""
    return whitening.whiten(_table(spark, sf_dir, "embeddings", "vec_id", "embedding"), "vec_id", "embedding", components=32)


QUERIES: dict[str, Query] = {
    "op1_vector_search": op1_vector_search,
    "op2_line_rules": op2_line_rules,
    "op3_tree_bpe": op3_tree_bpe,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_string_kernels": op5_string_kernels,
    "op6_shard_lookup": op6_shard_lookup,
    "op7_quality_gam": op7_quality_gam,
    "op8_main_text": op8_main_text,
    "op9_feistel_pii": op9_feistel_pii,
    "op10_packing": op10_packing,
    "op11_ranked_search": op11_ranked_search,
    "op12_exact_dedup": op12_exact_dedup,
    "op13_whitening": op13_whitening,
    "pipeline": corpus_pipeline.run,
}
