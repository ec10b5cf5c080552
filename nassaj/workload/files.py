"""Queries of the readers, the writers and the file-to-file jobs.

The given tables are written to files; what the jobs read and write are these files.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nassaj.functions import tokens
from nassaj.functions.arrays import unnest
from nassaj.functions.clean import clean, remove_extra_whitespace
from nassaj.operators.sizes import named_folder
from nassaj.plans import jobs
from nassaj.sources import readers, writers
from nassaj.workload import queries, views
from nassaj.workload.queries import Query, big, joined

#: Words of the benchmark up to this length are the listed stopwords.
SHORT_WORD = 4


def work_folder(spark: SparkSession) -> str:
    """A new folder below the shared one, removed when the application's JVM ends.

    A local session that names no shared folder gets a temporary one; a cluster has to name it.
    """
    shared = named_folder(spark)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.gettempdir()
    folder = f"{shared.rstrip('/')}/files-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(path)
    system.deleteOnExit(path)
    return folder


def _read_lines(spark, sf):
    path = f"{work_folder(spark)}/documents.txt"
    writers.save_results(path, views.table(spark, sf, "documents", "doc_id", "text").orderBy("doc_id"))
    return readers.load_text_data(spark, path, row_ids=True).select("row_id", "text")


def _csv_round_trip(spark, sf):
    docs, path = views.table(spark, sf, "documents"), f"{work_folder(spark)}/documents.csv"
    writers.save_csv(docs, path)
    return readers.read_any(spark, path, schema=docs.schema)


def _json_round_trip(spark, sf):
    docs, path = views.table(spark, sf, "documents"), f"{work_folder(spark)}/documents.jsonl"
    writers.save_json(docs, path)
    return readers.read_any(spark, path, schema=docs.schema)


def _save_tagged(spark, sf, path: str, tags: str) -> None:
    """``id, tokens, tags`` as JSON Lines, in the order of the ids."""
    rows = views.tagged(spark, sf, ordered=True)
    writers.save_json(rows.select("id", "tokens", F.col(tags).alias("tags")), path)


def _read_tagged(spark, sf):
    path = f"{work_folder(spark)}/tagged.jsonl"
    _save_tagged(spark, sf, path, "truth")
    read = readers.read_tagged(spark, path, "id")
    return read.select("id", joined("tokens").alias("tokens"), joined("tags").alias("tags"))


def _save_pairs(spark, sf, path: str) -> None:
    pairs = views.turn_pairs(spark, sf)
    writers.save_csv(pairs.select("id", F.col("truth").alias("text"), F.col("prediction").alias("summary")), path)


def _read_summary_pairs(spark, sf):
    path = f"{work_folder(spark)}/pairs.csv"
    _save_pairs(spark, sf, path)
    return readers.read_summary_pairs(spark, path)


def _custom_stages(spark, sf):
    """All three stages of the processor replaced."""
    processor = tokens.TextProcessor(
        cleaner=lambda c: F.lower(remove_extra_whitespace(c)),
        tokenizer=lambda c: F.split(c, " "),
        stemmer=lambda t: F.transform(t, lambda w: F.substring(w, 1, 4)),
    )
    run = processor.run(F.col("text"), remove_stops=False, apply_stemming=True)
    return views.documents(spark, sf).select("doc_id", run.alias("r")).select(
        "doc_id", "r.original", "r.cleaned", joined("r.tokens").alias("tokens"),
        joined("r.stemmed_tokens").alias("stemmed_tokens"),
    )


def _preprocessed(spark, sf, stopwords: bool = False, **options) -> DataFrame:
    at, corpus = work_folder(spark), views.docs_ar(spark, sf)
    writers.save_csv(corpus, f"{at}/corpus.csv")
    if stopwords:
        text = views.respell(F.col("text"))
        listed = unnest(views.table(spark, sf, "benchmark"), tokens.tokenize(clean(text)), name="text")
        writers.save_text(listed.where(F.length("text") <= SHORT_WORD), f"{at}/stopwords.txt")
        options["stopwords_path"] = f"{at}/stopwords.txt"
    jobs.preprocess(spark, f"{at}/corpus.csv", f"{at}/clean", apply_stemming=True,
                    reader_options={"schema": corpus.schema}, **options)
    return spark.read.parquet(f"{at}/clean").select(
        "doc_id", "lang", "cleaned_text", joined("tokens").alias("tokens"),
        joined("stemmed_tokens").alias("stemmed_tokens"),
    )


def _parts(spark, folder: str) -> DataFrame:
    """The training and the validation rows of a prepared folder."""
    train, val = (spark.read.parquet(f"{folder}/{part}") for part in ("train", "validation"))
    return train.withColumn("is_validation", F.lit(False)).unionByName(val.withColumn("is_validation", F.lit(True)))


def _prepare_ner(spark, sf):
    """Rows without an id: they are numbered by their place in the file."""
    at = work_folder(spark)
    _save_tagged(spark, sf, f"{at}/tagged.jsonl", "truth")
    jobs.prepare_ner(spark, f"{at}/tagged.jsonl", f"{at}/ner", views.word_ids)
    rows = _parts(spark, f"{at}/ner")
    return rows.select("id", joined(F.col("labels").cast("array<string>")).alias("labels"), "is_validation")


def _prepare_seq2seq(spark, sf):
    at = work_folder(spark)
    _save_pairs(spark, sf, f"{at}/pairs.csv")
    jobs.prepare_seq2seq(spark, f"{at}/pairs.csv", f"{at}/ids", queries.word_lengths)
    rows = _parts(spark, f"{at}/ids")
    ids = ("input_ids", "attention_mask", "labels")
    return rows.select("id", *[joined(F.col(c).cast("array<string>")).alias(c) for c in ids], "is_validation")


def _infer_classification(spark, sf):
    """A model saved, loaded and applied to a file; its predictions read back."""
    at, docs = work_folder(spark), views.documents(spark, sf)
    queries.stated_classifier(spark, docs).save(spark, f"{at}/models")
    writers.save_csv(docs, f"{at}/documents.csv")
    jobs.infer(spark, "classification", f"{at}/documents.csv", f"{at}/predictions.csv", f"{at}/models",
               reader_options={"schema": docs.schema})
    read = readers.read_csv(spark, f"{at}/predictions.csv")
    return read.select(big(F.col("doc_id")).alias("doc_id"), "prediction")


def _infer_ner(spark, sf):
    at, docs = work_folder(spark), views.documents(spark, sf)
    writers.save_csv(docs, f"{at}/documents.csv")
    jobs.infer(spark, "ner", f"{at}/documents.csv", f"{at}/entities.jsonl", model_factory=queries.capital_tagger,
               reader_options={"schema": docs.schema})
    kind = "doc_id bigint, entities array<struct<entity_group:string,word:string,start:bigint,end:bigint>>"
    read = readers.read_jsonl(spark, f"{at}/entities.jsonl", kind)
    return unnest(read, F.col("entities"), "doc_id", name="e").select(
        "doc_id", "e.entity_group", "e.word", F.col("e.start").alias("start_at"), F.col("e.end").alias("end_at")
    )


def _infer_summarization(spark, sf):
    at, docs = work_folder(spark), views.documents(spark, sf).select(F.col("doc_id").alias("id"), "text")
    writers.save_csv(docs, f"{at}/documents.csv")
    jobs.infer(spark, "summarization", f"{at}/documents.csv", f"{at}/summaries.csv",
               reader_options={"schema": docs.schema})
    read = readers.read_csv(spark, f"{at}/summaries.csv")
    return read.select(big(F.col("id")).alias("doc_id"), "summary")


def _report_row(spark, path: str, digits: int) -> DataFrame:
    """The single values of a stored report."""
    report = writers.load_document(spark, path)
    single = {k: v for k, v in report.items() if isinstance(v, (int, float))}
    return spark.createDataFrame([{k: round(v, digits) if isinstance(v, float) else v for k, v in single.items()}])


def _evaluate_classification(spark, sf):
    at, pairs = work_folder(spark), views.event_pairs(spark, sf)
    writers.save_csv(pairs.select("id", F.col("truth").alias("label")), f"{at}/truth.csv")
    writers.save_csv(pairs.select("id", "prediction"), f"{at}/predictions.csv")
    jobs.evaluate(spark, "classification", f"{at}/truth.csv", f"{at}/predictions.csv", output_dir=at, prefix="events_")
    return _report_row(spark, f"{at}/events_classification_report.json", 6)


def _evaluate_ner(spark, sf):
    """Rows of two files, paired by their places in them."""
    at = work_folder(spark)
    for name in ("truth", "prediction"):
        _save_tagged(spark, sf, f"{at}/{name}.jsonl", name)
    jobs.evaluate(spark, "ner", f"{at}/truth.jsonl", f"{at}/prediction.jsonl", output_dir=at, by_position=True)
    return _report_row(spark, f"{at}/ner_report.json", 6)


def _evaluate_summarization(spark, sf):
    at, pairs = work_folder(spark), views.turn_pairs(spark, sf)
    writers.save_csv(pairs.select("id", F.col("truth").alias("label")), f"{at}/truth.csv")
    writers.save_csv(pairs.select("id", "prediction"), f"{at}/predictions.csv")
    jobs.evaluate(spark, "summarization", f"{at}/truth.csv", f"{at}/predictions.csv", output_dir=at)
    return _report_row(spark, f"{at}/summarization_report.json", 4)


def _preprocess(**options) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf: _preprocessed(spark, sf, **options)


QUERIES: dict[str, Query] = {
    "read_lines": _read_lines,
    "csv_round_trip": _csv_round_trip,
    "json_round_trip": _json_round_trip,
    "read_tagged": _read_tagged,
    "read_summary_pairs": _read_summary_pairs,
    "process_custom_stages": _custom_stages,
    "preprocess_job": _preprocess(config=queries.ALL_FLAGS),
    "preprocess_job_listed": _preprocess(stopwords=True),
    "prepare_ner_job": _prepare_ner,
    "prepare_seq2seq_job": _prepare_seq2seq,
    "infer_classification_job": _infer_classification,
    "infer_ner_job": _infer_ner,
    "infer_summarization_job": _infer_summarization,
    "evaluate_classification_job": _evaluate_classification,
    "evaluate_ner_job": _evaluate_ner,
    "evaluate_summarization_job": _evaluate_summarization,
}
