"""Time the headline queries and print one JSON line.

Every query is computed in full into the no-op sink; a second run is timed, so that
code generation and the Python workers' start are not.
"""

import importlib.util
import json
import os
import time

from pyspark.sql import SparkSession

HERE = os.path.dirname(os.path.abspath(__file__))
HEADLINE = [
    "clean_default", "clean_all_flags", "tokenize", "remove_stopwords", "stem_tokens", "process_columns",
    "top_stems_by_lang", "text_stats", "text_stats_by_lang",
    "stratified_split", "ngram_terms", "vocabulary_topk", "tfidf_fit", "tfidf_transform", "classify_lr",
    "align_labels", "entity_groups_first", "gazetteer_tags", "extractive_summary", "batch_hook",
    "classification_report", "roc_auc", "ner_spans", "ner_report", "rouge_n", "rouge_l", "rouge_summary",
    "paired_eval",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spec = importlib.util.spec_from_file_location("spark_entry", f"{HERE}/__spark_entry__.py")
    entry = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(entry)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    queries, seconds = entry.queries(), {}
    for name in names:
        for _ in range(2):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    print(json.dumps({
        "metric": "headline queries, total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": sf_dir.rsplit("sf", 1)[-1], "documents": documents, "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
