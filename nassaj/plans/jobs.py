"""File-to-file jobs: preprocess, train, infer, evaluate."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nassaj.functions import fixed
from nassaj.functions.clean import CleanConfig
from nassaj.functions.tokens import TextProcessor, stopword_list
from nassaj.operators import hooks
from nassaj.operators.extract import extractive_summary
from nassaj.operators.gazetteer import gazetteer_entities
from nassaj.operators.pairing import pair, pick_column
from nassaj.operators.sequences import check_pairs, check_tagged, prepare_summary_pairs, prepare_tagged
from nassaj.operators.split import validation_flag
from nassaj.operators.stoplists import normal_words, remove_listed_tokens
from nassaj.operators.tfidf import TfidfModel
from nassaj.plans.classify import Classifier, train_text_classification
from nassaj.plans.evaluate import evaluate_classification, evaluate_ner, evaluate_summarization
from nassaj.sources.readers import (
    read_any, read_inference_input, read_numbered, read_stopwords, read_summary_pairs, read_tagged, with_row_id,
)
from nassaj.sources.writers import save_csv, save_predictions

logger = logging.getLogger(__name__)

TASKS = ("classification", "ner", "summarization")


def _check_task(task: str) -> None:
    if task not in TASKS:
        raise ValueError(f"Unknown task: {task}")


def preprocess(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    config: CleanConfig | Mapping[str, bool] | None = None,
    remove_stops: bool = True,
    apply_stemming: bool = False,
    text_column: str = "text",
    stopwords_path: str | None = None,
    normalize_stopwords: bool = False,
    output_type: str = "parquet",
    reader_options: Mapping | None = None,
) -> None:
    """Clean and tokenize a corpus; every input column is kept.

    A text file gives one document per line. One narrow stage, whatever the size; a stopword file, of
    any length, adds a join of the distinct tokens. ``normalize_stopwords`` rewrites the letters of the
    stopwords as cleaning does. ``reader_options`` go to the reader of the input.
    """
    corpus = read_any(spark, input_path, **(reader_options or {}))
    config = CleanConfig.of(config)
    processor = TextProcessor(config, stopword_list((), normalize_stopwords, config))
    if stopwords_path and remove_stops:
        words = read_stopwords(spark, stopwords_path)
        listed = normal_words(words, config) if normalize_stopwords else words
        tokens = processor.run_on_dataframe(corpus, text_column, True)
        result = remove_listed_tokens(tokens, listed, "tokens")
        if apply_stemming:
            result = result.withColumn("stemmed_tokens", processor.stems(F.col("tokens")))
    else:
        result = processor.run_on_dataframe(corpus, text_column, remove_stops, apply_stemming)
    if output_type == "csv":
        save_csv(result, output_path)
    else:
        result.write.mode("overwrite").format(output_type).save(output_path)


def _with_id(df: DataFrame, id_col: str) -> DataFrame:
    return df if id_col in df.columns else with_row_id(df, id_col)


def _read_with_id(spark: SparkSession, path: str, id_col: str, options: Mapping | None) -> DataFrame:
    df = read_any(spark, path, **(options or {}))
    return df if id_col in df.columns else read_numbered(spark, path, id_col, **(options or {}))


def train_classifier(
    spark: SparkSession,
    data_path: str,
    output_dir: str,
    model_type: str = "logistic_regression",
    text_column: str | None = None,
    label_column: str = "label",
    id_col: str = "id",
    hyperparameter_tuning: bool = False,
    reader_options: Mapping | None = None,
    **params,
) -> tuple[Classifier, DataFrame]:
    """Train on a file; cleaned text is used when the file has it.

    Rows without an id are numbered by file name and place, so that the split is the same however the
    files are read.
    """
    df = _read_with_id(spark, data_path, id_col, reader_options)
    text = text_column or ("cleaned_text" if "cleaned_text" in df.columns else "text")
    return train_text_classification(
        df, model_type, text, label_column, id_col, output_dir=output_dir,
        hyperparameter_tuning=hyperparameter_tuning, **params,
    )


def _write_parts(df: DataFrame, val: DataFrame | None, output_dir: str, id_col: str) -> None:
    """Training and validation folders; a tenth is held out where no file was given."""
    if val is None:
        flagged = validation_flag(df, id_col, None, fixed.SEQUENCE_TEST_SIZE)
        df, val = flagged.where(~F.col("is_validation")), flagged.where("is_validation")
        df, val = df.drop("is_validation"), val.drop("is_validation")
    df.write.mode("overwrite").parquet(f"{output_dir}/train")
    val.write.mode("overwrite").parquet(f"{output_dir}/validation")


def prepare_ner(
    spark: SparkSession,
    train_path: str,
    output_dir: str,
    split_words: Callable[[Column], Column],
    val_path: str | None = None,
    label_all_tokens: bool = True,
    max_length: int = fixed.TAGGER_MAX_LENGTH,
) -> None:
    """Aligned label rows for a token tagger.

    ``split_words`` maps the token array to the word index of every subword piece,
    null for special pieces.
    """

    def ready(path: str) -> DataFrame:
        df = check_tagged(_with_id(read_tagged(spark, path), "id"))
        df = df.withColumn("word_ids", split_words(F.col("tokens")))
        return prepare_tagged(df, "word_ids", "tags", label_all_tokens, max_length)

    _write_parts(ready(train_path), ready(val_path) if val_path else None, output_dir, "id")


def prepare_seq2seq(
    spark: SparkSession,
    train_path: str,
    output_dir: str,
    encode: Callable[[Column], Column],
    val_path: str | None = None,
    reader_options: Mapping | None = None,
    **lengths,
) -> None:
    """Padded id rows for a summarizer; ``encode`` maps text to its piece ids."""

    def ready(path: str) -> DataFrame:
        df = read_summary_pairs(spark, path, **(reader_options or {}))
        if "id" not in df.columns and path.lower().endswith(".csv"):
            df = read_summary_pairs(spark, path, row_id="id", **(reader_options or {}))
        df = check_pairs(_with_id(df, "id"))
        df = df.withColumns({"input_ids": encode(F.col("text")), "target_ids": encode(F.col("summary"))})
        return prepare_summary_pairs(df, **lengths).drop("target_ids")

    _write_parts(ready(train_path), ready(val_path) if val_path else None, output_dir, "id")


def batch_process(
    df: DataFrame,
    task: str,
    text_col: str = "text",
    classifier: Classifier | None = None,
    model_factory: hooks.ModelFactory | None = None,
    return_proba: bool = False,
    aggregation_strategy: str = "simple",
    batch_size: int = fixed.BATCH_SIZE,
    output_path: str | None = None,
    output_type: str | None = None,
    gazetteer: DataFrame | None = None,
) -> DataFrame:
    """Predict for every row of ``df`` and optionally save.

    Classification needs a loaded classifier; the other tasks run ``model_factory``.
    Without one, entities are the phrases of ``gazetteer`` (``phrase, entity_type``), and
    summaries are extracted from the texts themselves.
    """
    _check_task(task)
    text = F.col(text_col)
    if task == "classification":
        if classifier is None:
            raise RuntimeError("Classification model not loaded. Pass a classifier.")
        output = "label" if return_proba else "prediction"
        result = classifier.predict(df, text_col, return_proba, output)
    elif task == "ner":
        if model_factory is not None:
            result = df.withColumn("entities", hooks.tagger(model_factory, aggregation_strategy, batch_size)(text))
        elif gazetteer is not None:
            keyed = _with_id(df, "id")
            found = gazetteer_entities(keyed, gazetteer, "id", text_col, strategy=aggregation_strategy)
            result = keyed.join(found, "id", "left").withColumn(
                "entities", F.coalesce("entities", F.array().cast(found.schema["entities"].dataType))
            )
        else:
            raise RuntimeError("NER model not loaded. Pass a model factory or a gazetteer.")
    elif model_factory is not None:
        result = df.withColumn("summary", hooks.summarizer(model_factory, batch_size)(text))
    else:
        keyed = _with_id(df, "id")
        model = TfidfModel.fit(keyed, text_col)
        summaries = extractive_summary(keyed, model, "id", text_col)
        result = keyed.join(summaries, "id", "left").withColumn(
            "summary", F.coalesce("summary", F.lit(""))
        )
    if output_path:
        save_predictions(result, output_path, task, output_type)
    return result


def infer(
    spark: SparkSession,
    task: str,
    input_path: str,
    output_path: str,
    model_path: str | None = None,
    model_factory: hooks.ModelFactory | None = None,
    batch_size: int = fixed.BATCH_SIZE,
    model_type: str | None = None,
    gazetteer_path: str | None = None,
    reader_options: Mapping | None = None,
    **options,
) -> DataFrame | None:
    """Load the model, read texts, predict, save. No input means no output.

    ``model_type`` chooses where ``model_path`` holds more than one classifier.
    """
    _check_task(task)
    classifier = None
    if task == "classification":
        if model_path is None:
            raise ValueError("classification needs model_path")
        classifier = Classifier.load(spark, model_path, model_type)
    gazetteer = read_any(spark, gazetteer_path) if gazetteer_path else None
    df, text_col = read_inference_input(spark, input_path, **(reader_options or {}))
    if df.isEmpty():
        logger.warning("No input texts found in %s", input_path)
        return None
    return batch_process(df, task, text_col, classifier, model_factory,
                         batch_size=batch_size, output_path=output_path, gazetteer=gazetteer, **options)


def _paired(truth: DataFrame, prediction: DataFrame, id_col: str, by_position: bool, t: str, p: str,
            cast: str | None = "string") -> DataFrame:
    """Rows that were read by position have their number in ``_row``."""
    return pair(truth, prediction, "_row" if by_position else id_col, t, p, cast)


def evaluate(
    spark: SparkSession,
    task: str,
    input_path: str,
    prediction_path: str | None = None,
    model_path: str | None = None,
    output_dir: str | None = None,
    id_col: str = "id",
    text_column: str = "text",
    label_column: str = "label",
    prediction_column: str = "prediction",
    by_position: bool = False,
    prefix: str = "",
    model_type: str | None = None,
    label_names: Sequence[str] | None = None,
    reader_options: Mapping | None = None,
) -> dict:
    """Score stored predictions, or a classifier's, against a labelled file.

    Rows are paired by ``id_col``; ``by_position`` pairs them by their place instead, in the order of
    the files' names and of the rows in them. ``model_type`` chooses between classifiers,
    ``label_names`` orders the confusion matrix.
    """
    _check_task(task)
    read = partial(read_any, spark, **(reader_options or {}))
    if by_position:
        read = partial(read_numbered, spark, name="_row", **(reader_options or {}))
    if task == "classification":
        if not prediction_path and not model_path:
            raise ValueError("Either model_path or prediction_path is required for classification.")
        truth = read(input_path)
        label = pick_column(truth.drop("_row"), label_column, 1)
        if prediction_path:
            predicted = read(prediction_path)
            column = pick_column(predicted.drop("_row"), prediction_column, 1)
            pairs = _paired(truth, predicted, id_col, by_position, label, column)
        else:
            text = pick_column(truth.drop("_row"), text_column, 0)
            pairs = Classifier.load(spark, model_path, model_type).predict(truth, text, output_col="_predicted").select(
                F.col(label).cast("string").alias("truth"), F.col("_predicted").alias("prediction")
            )
        return evaluate_classification(pairs, label_names, output_dir=output_dir, prefix=prefix)
    if not prediction_path:
        raise ValueError(f"prediction_path is required for {task}.")
    if task == "ner":
        key = None if by_position else id_col
        truth, predicted = read_tagged(spark, input_path, key), read_tagged(spark, prediction_path, key)
        if by_position:
            truth, predicted = with_row_id(truth, "_row"), with_row_id(predicted, "_row")
        pairs = _paired(truth, predicted, id_col, by_position, "tags", "tags", None)
        return evaluate_ner(pairs, output_dir, prefix)
    truth, predicted = read(input_path), read(prediction_path)
    reference = label_column if label_column in truth.columns else "summary"
    hypothesis = prediction_column if prediction_column in predicted.columns else "summary"
    pairs = _paired(truth, predicted, id_col, by_position, reference, hypothesis)
    return evaluate_summarization(pairs, output_dir, prefix)
