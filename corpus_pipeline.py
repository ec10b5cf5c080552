"""From raw documents to packed sequences: language, quality, near copies, personal data, packing.

Every stage reads what the one before it kept, as Parquet. All but the last return the columns of
documents. Null texts have no language and go with the first stage; null ids are kept throughout. Empty
tables stay empty.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nassaj.llm import bpe, jaccard, langid, packing, pii, quality
from nassaj.operators.sieve import marked
from nassaj.llm.staging import small_batches, stage
from nassaj.shipping import ship

#: A language has to be likelier than all others together.
LEAST_LANGUAGE_SCORE = 0.5
#: Where a session names the secret key of its pseudonyms; the one shown here is for trials.
KEY_NAME, SHOWN_KEY = "spark.nassaj.pseudonym.key", "shown"


def _judged(docs: DataFrame, measure: Column, keeps: Callable[[Column], Column]) -> DataFrame:
    """Rows whose measure passes, their columns as they were; the measure is computed once for a row."""
    name = "measure"
    while name in docs.columns:
        name += "_"
    return docs.withColumn(name, measure).where(keeps(F.col(name))).select(*docs.columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach; others go."""
    ship(spark)
    small_batches(spark)
    model = langid.fit(docs.where(~langid.held_out("doc_id")), "doc_id", "text", "lang")
    return _judged(docs, langid.identify("text", model), lambda m: (
        (m["lang_pred"] != langid.UNDETERMINED) & (m["score"] >= LEAST_LANGUAGE_SCORE)
    ))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as label 1 does; others go."""
    ship(spark)
    small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~langid.held_out("doc_id"))
    model = quality.fit(docs, labels, "doc_id", "text", "quality")
    return _judged(docs, quality.quality("text", model), lambda score: score >= quality.THRESHOLD)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by 80 % of their five-word shingles, the one with the smallest id.

    Rows are told apart by all their columns. Where the smallest id is on several rows, or all ids are null, the one
    with the smallest digest stays; of rows that are equal throughout, one. Texts without words stay. Only rows that can
    be in a group are moved, told by a sieve.
    """
    ship(spark)
    small_batches(spark)
    digest = F.xxhash64(*docs.columns)
    row = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), digest)
    named = docs.select(F.struct(*docs.columns).alias("doc"), row.alias("row"), F.xxhash64(row).alias("hash"))
    classes = stage(jaccard.jaccard_labels(named.select("row", "doc.text"), "row", "text"), "pipeline-classes")
    number = F.substring_index("row", ":", 1)
    number = F.when(number != "", number).cast("bigint")
    first = F.min(F.struct(number.isNull().alias("nameless"), number.alias("id"), "row")).alias("first")
    groups = classes.where("label IS NOT NULL").groupBy("label").agg(F.count("*").alias("rows"), first).where("rows > 1")
    groups = stage(groups, "pipeline-groups")  # a written side lets adaptive execution split a large group's rows
    grouped = classes.join(groups, "label").select("row", F.xxhash64("row").alias("hash"), (F.col("first.row") == F.col("row")).alias("stays"))
    grouped = stage(grouped.distinct(), "pipeline-grouped")
    told = marked(named, "hash", grouped.select("hash"))
    met = told.where("open").join(grouped.select("row", "stays"), "row", "left")
    kept = [told.where("NOT open"), met.where("stays IS NULL"), met.where("stays").dropDuplicates(["row"])]
    return reduce(DataFrame.unionByName, [rows.select("doc.*") for rows in kept])


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their personal values under pseudonyms, with the key that the session names."""
    kept = pii.pseudonymise(docs, "text", spark.conf.get(KEY_NAME, SHOWN_KEY)).select(*docs.columns)
    if "n_chars" not in docs.columns:
        return kept
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return kept.withColumn("n_chars", F.coalesce(length, "n_chars")).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens, mixed by source in proportion."""
    ship(spark)
    small_batches(spark)
    return packing.pack(docs, bpe.vocabulary_file(), key="doc_id", source="source", text="text")


STAGES = [
    ("language", language),
    ("quality", good_quality),
    ("near_copies", one_of_each),
    ("private", private),
    ("packing", packed),
]

#: The stages learn models and cut tokens, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents; each result is written to the shared folder and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
