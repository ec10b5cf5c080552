"""The registered queries: one per operator, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nassaj.functions import clean as cl
from nassaj.functions import fixed, stats, tokens
from nassaj.functions.arrays import unnest, value_counts
from nassaj.operators import entities, extract, gazetteer, hooks, metrics, pairing, roc, rouge, sequences, spans, split, tfidf
from nassaj.operators.stoplists import remove_listed_tokens
from nassaj.plans import classify
from nassaj.sources.readers import with_summary_columns
from nassaj.workload import views

Query = Callable[[SparkSession, str], DataFrame]

# Respelled common words, for the custom stopword list.
CUSTOM_STOPWORDS = [
    views.respelled(w).translate({ord(c): None for c in fixed.DIACRITICS + fixed.TATWEEL})
    .translate({ord(c): fixed.ALEF for c in fixed.ALEF_FORMS})
    for w in ("the", "and", "of", "is", "on", "with")
]
ALL_FLAGS = {"remove_english": True, "remove_numbers": True}


def joined(c: Column | str) -> Column:
    return F.array_join(c, " ")


def big(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("bigint")


def _texts(op: Callable[[Column], Column]) -> Query:
    return lambda spark, sf: views.docs_ar(spark, sf).select("doc_id", op(F.col("text")).alias("cleaned"))


def _cleaned(config: dict | None) -> Query:
    return lambda spark, sf: cl.clean_dataframe(
        views.docs_ar(spark, sf), "text", "cleaned", config
    ).select("doc_id", "cleaned")


def _tokens(op: Callable[[Column], Column]) -> Query:
    def run(spark, sf):
        found = views.docs_ar(spark, sf).select("doc_id", op(F.col("text")).alias("t"))
        return found.select("doc_id", big(F.size("t")).alias("n"), joined("t").alias("tokens"))

    return run


def _by_list(spark, sf):
    words = spark.createDataFrame([(w,) for w in tokens.stopword_list(CUSTOM_STOPWORDS)], "word string")
    docs = views.docs_ar(spark, sf).select("doc_id", tokens.tokenize(cl.clean(F.col("text"))).alias("tokens"))
    kept = remove_listed_tokens(docs, words)
    return kept.select("doc_id", big(F.size("tokens")).alias("n"), joined("tokens").alias("tokens"))


def _process_struct(spark, sf):
    run = tokens.TextProcessor(stopwords=tokens.stopword_list(CUSTOM_STOPWORDS)).run(
        F.col("text"), apply_stemming=True
    )
    return views.docs_ar(spark, sf).select("doc_id", run.alias("r")).select(
        "doc_id", "r.original", "r.cleaned", joined("r.tokens").alias("tokens"),
        joined("r.stemmed_tokens").alias("stemmed_tokens"),
    )


def _process_columns(spark, sf):
    df = tokens.TextProcessor(ALL_FLAGS).run_on_dataframe(views.docs_ar(spark, sf), "text", True, True)
    return df.select("doc_id", "lang", "cleaned_text", joined("tokens").alias("tokens"),
                     joined("stemmed_tokens").alias("stemmed_tokens"))


def top_stems(spark, sf, top: int = 20):
    """The most frequent stems of every language."""
    df = tokens.TextProcessor().run_on_dataframe(views.docs_ar(spark, sf), "text", True, True)
    stems = unnest(df, F.col("stemmed_tokens"), "lang", name="stem")
    counts = stems.groupBy("lang", "stem").agg(F.count(F.lit(1)).alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "stem"))
    return counts.withColumn("rank", big(rank)).where(F.col("rank") <= top)


def _text_stats(spark, sf):
    return views.docs_ar(spark, sf).select("doc_id", stats.summary(F.col("text")).alias("s")).select(
        "doc_id", *[big(f"s.{c}").alias(c) for c in ("word_count", "char_count", "unique_words")],
        "s.avg_word_length", "s.arabic_char_ratio", "s.lexical_diversity",
    )


def _stat_columns(spark, sf):
    c = F.col("text")
    return views.documents(spark, sf).select(
        "doc_id", big(stats.word_count(c)).alias("words"), big(stats.char_count(c)).alias("chars"),
        F.round(stats.avg_word_length(c), 6).alias("avg_length"),
        F.round(stats.arabic_char_ratio(c), 6).alias("arabic_ratio"),
        big(stats.unique_word_count(c)).alias("unique_words"),
        F.round(stats.lexical_diversity(c), 6).alias("diversity"),
    )


def _stats_by_lang(spark, sf):
    df = stats.corpus_summary(views.docs_ar(spark, sf), "text", "lang")
    return df.select(
        "lang", "documents", "words", "chars", "unique_words",
        *[F.round(c, 6).alias(c) for c in ("avg_word_length", "avg_arabic_char_ratio", "lexical_diversity")],
    )


def _label_dictionary(spark, sf):
    d = split.label_dictionary(views.table(spark, sf, "labels"), "quality")
    return d.select("label", big("label_id").alias("label_id"))


def _stratified_split(spark, sf):
    df = views.table(spark, sf, "labels").select("doc_id", F.col("quality").cast("string").alias("label"))
    return split.validation_flag(df, "doc_id", "label").select("doc_id", "label", "is_validation")


def _plain_split(spark, sf):
    df = views.table(spark, sf, "documents", "doc_id")
    return split.validation_flag(df, "doc_id", None, fixed.SEQUENCE_TEST_SIZE)


def _folds(spark, sf):
    df = views.table(spark, sf, "documents", "doc_id", "lang")
    ranked = split.stratified_folds(df, "doc_id", "lang", fixed.GRID_FOLDS)
    return ranked.select("doc_id", "lang", big("fold").alias("fold"))


def _ngram_terms(spark, sf):
    counted = value_counts(tfidf.document_terms(F.col("text")))
    return unnest(views.documents(spark, sf), counted, "doc_id", name="t").select(
        "doc_id", F.col("t.value").alias("term"), big("t.n").alias("n")
    )


def _vocabulary(spark, sf):
    return tfidf.vocabulary(views.documents(spark, sf), "text")


def _tfidf_fit(spark, sf):
    return tfidf.fit_table(views.documents(spark, sf), "text").select(
        "term", "tf", "df", F.round("idf", 6).alias("idf")
    )


def _tfidf_transform(spark, sf):
    docs = views.documents(spark, sf)
    long = tfidf.TfidfModel.fit(docs, "text").weights_long(docs, "doc_id", "text")
    return long.select("doc_id", "term", F.round("weight", 6).alias("weight"))


def _tfidf_join(spark, sf):
    docs = views.documents(spark, sf)
    long = tfidf.weights_by_join(docs, tfidf.fit_table(docs, "text"), "doc_id", "text")
    return long.select("doc_id", "term", F.round("weight", 6).alias("weight"))


def _classify(model_type: str, proba: bool = False, **params) -> Query:
    def run(spark, sf):
        df = views.labelled(spark, sf)
        model, _ = classify.train_text_classification(df, model_type, **params)
        out = model.predict(df, "text", proba).drop("text")
        if proba:
            out = out.withColumn("probabilities", F.to_json("probabilities"))
        return out

    return run


def _validation_report(spark, sf):
    return classify.train_text_classification(views.labelled(spark, sf))[1]


def _tag_dictionary(spark, sf):
    d = split.tag_dictionary(views.tagged(spark, sf), "truth")
    return d.select("tag", big("tag_id").alias("tag_id"))


def _align_labels(all_tokens: bool) -> Query:
    def run(spark, sf):
        df = views.subword_ids(spark, sf)
        ids = {r["tag"]: r["tag_id"] for r in split.tag_dictionary(df).collect()}
        labels = sequences.align_labels(F.col("word_ids"), F.col("tags"), ids, all_tokens)
        return df.select("id", joined(labels.cast("array<string>")).alias("labels"))

    return run


def _pad_truncate(spark, sf):
    df = views.subword_ids(spark, sf)
    ids = F.transform("word_ids", lambda w: F.coalesce(w, F.lit(-1)))
    fitted = sequences.fit_length(ids, fixed.TAGGER_MAX_LENGTH, 0)
    return df.select("id", big(F.size(fitted)).alias("n"), joined(fitted.cast("array<string>")).alias("ids"))


def _prepared_tags(spark, sf):
    df = sequences.prepare_tagged(views.subword_ids(spark, sf))
    return df.select("id", joined(F.col("labels").cast("array<string>")).alias("labels"))


def _entities(strategy: str) -> Query:
    def run(spark, sf):
        df = views.piece_predictions(spark, sf)
        found = unnest(df, entities.entity_groups(F.col("pieces"), strategy), "id", name="e", pos="k")
        return found.select(
            "id", big("k").alias("k"), "e.entity_group", F.round("e.score", 6).alias("score"), "e.word",
            big("e.start").alias("start_at"), big("e.end").alias("end_at"),
        )

    return run


def _gazetteer(spark, sf):
    docs = views.documents(spark, sf).select(
        "doc_id", F.regexp_replace("text", r"[.!?\n]+", " ").alias("text")
    )
    tags = gazetteer.gazetteer_tags(docs, views.benchmark_phrases(spark, sf), "doc_id")
    return tags.select("doc_id", big("pos").alias("pos"), "token", "tag")


def _seq2seq_pairs(spark, sf):
    pairs = views.turn_pairs(spark, sf).select(
        "id", F.col("truth").alias("source"), F.col("prediction").alias("target")
    )
    return with_summary_columns(pairs)


def word_lengths(c: Column) -> Column:
    """Stand-in piece ids: the length of every word."""
    return F.transform(tokens.tokenize(c), lambda t: F.length(t))


def _seq2seq_ids(mask: bool) -> Query:
    def run(spark, sf):
        df = views.turn_pairs(spark, sf).select(
            "id", word_lengths(F.col("truth")).alias("input_ids"), word_lengths(F.col("prediction")).alias("target_ids")
        )
        out = sequences.prepare_summary_pairs(df, mask_pad=mask)
        return out.select("id", *[
            joined(F.col(c).cast("array<string>")).alias(c) for c in ("input_ids", "attention_mask", "labels")
        ])

    return run


def _extractive(spark, sf):
    docs = views.documents(spark, sf)
    model = tfidf.TfidfModel.fit(docs, "text")
    return extract.extractive_summary(docs, model, "doc_id", "text")


def _predict_labels(spark, sf):
    names = ["click", "error", "view"]
    number = (F.col("user_id") % 5).cast("double")
    return views.table(spark, sf, "events").select(
        "event_id", classify.label_of(number, names).alias("label")
    )


def word_counter():
    """A stand-in model: the number of words of every text."""
    return lambda texts: [str(len(t.split())) for t in texts]


def _batch_hook(spark, sf):
    run = hooks.batch_model(word_counter, "string")
    return views.documents(spark, sf).select("doc_id", run(F.col("text")).alias("result"))


def capital_tagger():
    """A stand-in tagger: words with a capital first letter are one piece each."""

    def tag(texts):
        out = []
        for text in texts:
            at, pieces = 0, []
            for word in text.split(" "):
                name = "NAME" if word[:1].isupper() else "O"
                pieces.append({"tag": name, "score": 1.0, "word": word, "start": at,
                               "end": at + len(word), "is_subword": False})
                at += len(word) + 1
            out.append(pieces)
        return out

    return tag


def _tagger_hook(spark, sf):
    run = hooks.tagger(capital_tagger)
    found = unnest(views.documents(spark, sf), run(F.col("text")), "doc_id", name="e")
    return found.select("doc_id", "e.entity_group", "e.word", big("e.start").alias("start_at"),
                        big("e.end").alias("end_at"))


def _confusion(spark, sf):
    return metrics.confusion_matrix(metrics.confusion_counts(views.event_pairs(spark, sf)))


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _class_metrics(spark, sf):
    df = metrics.classification_metrics(metrics.confusion_counts(views.event_pairs(spark, sf)))
    return _rounded(df, *df.columns)


def _class_report(spark, sf):
    df = metrics.classification_report(metrics.confusion_counts(views.event_pairs(spark, sf)))
    return _rounded(df, "precision", "recall", "f1")


def _roc_points(spark, sf):
    return _rounded(roc.roc_points(views.event_scores(spark, sf), positive="error"), "fpr", "tpr")


def _roc_auc(spark, sf):
    return _rounded(roc.roc_auc(views.event_scores(spark, sf), positive="error"), "roc_auc")


def _ner_spans(spark, sf):
    df = spans.span_rows(views.tagged(spark, sf), "id", "prediction")
    return df.select("id", "entity_type", big("first").alias("first"), big("last").alias("last"))


def _ner_accuracy(spark, sf):
    return _rounded(spans.token_accuracy(views.tagged(spark, sf)), "accuracy")


def _ner_metrics(spark, sf):
    return _rounded(spans.ner_metrics(views.tagged(spark, sf)), "precision", "recall", "f1")


def _ner_report(spark, sf):
    return _rounded(spans.ner_report(views.tagged(spark, sf)), "precision", "recall", "f1")


def _rouge(*measures: str, tokenizer: str = "unicode") -> Query:
    def run(spark, sf):
        df = rouge.rouge_scores(views.turn_pairs(spark, sf), measures=measures, tokenizer=tokenizer)
        return _rounded(df.drop("truth", "prediction"), *[c for c in df.columns if c.startswith("rouge")])

    return run


def _rouge_summary(*measures: str) -> Query:
    def run(spark, sf):
        return rouge.rouge_summary(rouge.rouge_scores(views.turn_pairs(spark, sf), measures=measures))

    return run


def _paired(spark, sf):
    labels = views.table(spark, sf, "labels")
    pairs = pairing.pair(labels, labels, "doc_id", "quality", "toxic", "string")
    return pairs.select("id", "truth", "prediction")


def _paired_tables(spark, sf):
    """Quality labels against a guess from the text, from two tables."""
    labels = views.table(spark, sf, "labels", "doc_id", "quality")
    docs = views.table(spark, sf, "documents", "doc_id", "n_chars").join(labels.select("doc_id"), "doc_id", "left_semi")
    guess = docs.select("doc_id", (F.col("n_chars") > 500).cast("int").alias("guess"))
    return pairing.pair(labels, guess, "doc_id", "quality", "guess", "string").select("id", "truth", "prediction")


def stated_classifier(spark, docs) -> classify.Classifier:
    """A model with stated coefficients over the corpus' own TF-IDF weights."""
    fitted = tfidf.TfidfModel.fit(docs, "text")
    weights = [((7 * len(t) + ord(t[0])) % 11 - 5) / 2 for t in fitted.terms]
    java = spark._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(
        "stated", _py2java(spark.sparkContext, Vectors.dense(weights)), 0.1
    )
    model = LogisticRegressionModel(java)
    return classify.Classifier("logistic_regression", ["0", "1"], fitted, PipelineModel([model]))


def _stated_predictions(spark, sf):
    docs = views.documents(spark, sf)
    out = stated_classifier(spark, docs).predict(docs, "text", return_proba=True)
    return out.select("doc_id", "prediction", F.round(F.col("probabilities")["1"], 6).alias("probability"))


def _stated_report(spark, sf):
    model = stated_classifier(spark, views.documents(spark, sf))
    pairs = model.predict(views.labelled(spark, sf), "text").select(F.col("label").alias("truth"), "prediction")
    report = metrics.classification_report(metrics.confusion_counts(pairs))
    return _rounded(report, "precision", "recall", "f1")


QUERIES: dict[str, Query] = {
    "clean_default": _cleaned(None),
    "clean_all_flags": _cleaned(ALL_FLAGS),
    "clean_flag_off_tatweel": _cleaned({"remove_tatweel": False}),
    "clean_keep_whitespace": _cleaned({"remove_extra_whitespace": False, "remove_punctuation": False}),
    "remove_diacritics": _texts(cl.remove_diacritics),
    "remove_tatweel": _texts(cl.remove_tatweel),
    "normalize_alef": _texts(cl.normalize_alef),
    "normalize_teh_marbuta": _texts(cl.normalize_teh_marbuta),
    "remove_punctuation": _texts(cl.remove_punctuation),
    "remove_english": lambda spark, sf: views.documents(spark, sf).select(
        "doc_id", cl.remove_english(F.col("text")).alias("cleaned")),
    "remove_numbers": _texts(cl.remove_numbers),
    "collapse_whitespace": _texts(cl.remove_extra_whitespace),
    "tokenize": _tokens(tokens.tokenize),
    "tokenize_punctuation": _tokens(lambda c: tokens.tokenize(c, split_punct=True)),
    "remove_stopwords": _tokens(lambda c: tokens.remove_stopwords(
        tokens.tokenize(cl.clean(c)), tokens.stopword_list(CUSTOM_STOPWORDS))),
    "remove_listed_stopwords": _by_list,
    "process_tokens": _tokens(lambda c: tokens.process_tokens(cl.clean(c))),
    "stem_tokens": _tokens(lambda c: tokens.stem_tokens(tokens.tokenize(cl.remove_diacritics(c)))),
    "process_struct": _process_struct,
    "process_columns": _process_columns,
    "top_stems_by_lang": top_stems,
    "text_stats": _text_stats,
    "stat_columns": _stat_columns,
    "text_stats_by_lang": _stats_by_lang,
    "label_dictionary": _label_dictionary,
    "stratified_split": _stratified_split,
    "unstratified_split": _plain_split,
    "stratified_folds": _folds,
    "ngram_terms": _ngram_terms,
    "vocabulary_topk": _vocabulary,
    "tfidf_fit": _tfidf_fit,
    "tfidf_transform": _tfidf_transform,
    "tfidf_transform_join": _tfidf_join,
    "classify_lr": _classify("logistic_regression"),
    "classify_svc": _classify("linear_svc"),
    "classify_grid": _classify("logistic_regression", hyperparameter_tuning=True),
    "validation_report": _validation_report,
    "tag_dictionary": _tag_dictionary,
    "align_labels": _align_labels(True),
    "align_labels_first_piece": _align_labels(False),
    "pad_truncate": _pad_truncate,
    "prepared_tags": _prepared_tags,
    "entity_groups_none": _entities("none"),
    "entity_groups_simple": _entities("simple"),
    "entity_groups_first": _entities("first"),
    "gazetteer_tags": _gazetteer,
    "seq2seq_pairs": _seq2seq_pairs,
    "seq2seq_ids": _seq2seq_ids(False),
    "seq2seq_ids_masked": _seq2seq_ids(True),
    "extractive_summary": _extractive,
    "predict_labels": _predict_labels,
    "predict_proba": _classify("logistic_regression", proba=True),
    "batch_hook": _batch_hook,
    "tagger_hook": _tagger_hook,
    "confusion_matrix": _confusion,
    "classification_metrics": _class_metrics,
    "classification_report": _class_report,
    "roc_points": _roc_points,
    "roc_auc": _roc_auc,
    "ner_spans": _ner_spans,
    "ner_token_accuracy": _ner_accuracy,
    "ner_metrics": _ner_metrics,
    "ner_report": _ner_report,
    "rouge_n": _rouge("rouge1", "rouge2"),
    "rouge_n_ascii": _rouge("rouge1", "rouge2", tokenizer="ascii"),
    "rouge_l": _rouge("rougeL"),
    "rouge_summary_n": _rouge_summary("rouge1", "rouge2"),
    "rouge_summary": _rouge_summary("rouge1", "rouge2", "rougeL"),
    "paired_eval": _paired,
    "paired_tables": _paired_tables,
    "stated_predictions": _stated_predictions,
    "stated_report": _stated_report,
}
