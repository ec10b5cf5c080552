import collections
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from nassaj.functions import fixed
from nassaj.operators import terms, tfidf
from nassaj.operators.svc import _Rows, _pack
from tests.conftest import plan_of


def texts(rows: int, seed: int = 5) -> list[str | None]:
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(400)] + ["x", "İß", "كتاب"]
    return [None, "", "one"] + [" ".join(words[i] for i in np.minimum(rng.zipf(1.3, 30) - 1, 402)) + "." for _ in range(rows)]


def counted(found: list[str | None], ngram_range: tuple[int, int]) -> tuple[collections.Counter, collections.Counter]:
    tf, df = collections.Counter(), collections.Counter()
    for text in found:
        words = re.findall(r"\w{2,}", (text or "").lower())
        all_terms = [" ".join(words[i : i + n]) for n in range(ngram_range[0], ngram_range[1] + 1) for i in range(len(words) - n + 1)]
        tf.update(all_terms)
        df.update(set(all_terms))
    return tf, df


@pytest.mark.parametrize("ngram_range", [(1, 2), (2, 3)])
def test_the_sieve_loses_no_frequent_term(spark, ngram_range):
    rows = texts(300)
    tf, df = counted(rows, ngram_range)
    docs = spark.createDataFrame(list(enumerate(rows)), "id long, text string").repartition(3)
    for limit in (1, 50, 100_000):
        wanted = sorted(tf, key=lambda t: (-tf[t], t))[:limit]
        found = tfidf.vocabulary(docs, "text", limit, ngram_range).collect()
        assert [(r["term"], r["tf"], r["df"]) for r in found] == [(t, tf[t], df[t]) for t in wanted]


def test_rare_terms_are_not_grouped(spark):
    """The shuffle holds what can be in the vocabulary, not all terms of the corpus."""
    docs = spark.createDataFrame([(f"often again r{i} s{i}",) for i in range(2000)], "text string")
    documents, sieve = tfidf._survey(docs, "text", 3, (1, 2))
    assert documents == 2000 and sieve.sum() == 3
    assert tfidf.term_statistics(docs, "text", (1, 2), sieve).count() < 20
    assert tfidf.term_statistics(docs, "text", (1, 2)).count() == 3 + 2000 * 4


def test_words_are_those_of_the_pattern(spark):
    """Over all code points, Python's words in the prepared text are Java's in the lowercase one."""
    c = F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32")
    points = spark.range(0x110000).where("id < 55296 OR id > 57343").select(F.concat(c, F.lit("a"), c).alias("c"))
    both = points.select(
        terms.prepared(F.col("c")).alias("sent"),
        F.array_join(F.regexp_extract_all(F.lower("c"), F.lit(fixed.TERM), F.lit(0)), "|").alias("java"),
    ).toPandas()
    assert ["|".join(re.findall(r"\w{2,}", x)) for x in both["sent"]] == both["java"].tolist()


def test_arrays_of_terms_are_counted_whole(spark):
    rows = [(1, ["a b", "c", "a b", None]), (2, None), (3, [])]
    docs = spark.createDataFrame(rows, "id long, terms array<string>")
    assert {tuple(r) for r in tfidf.term_statistics(docs, "terms").collect()} == {("a b", 2, 1), ("c", 1, 1)}
    model = tfidf.TfidfModel.fit(docs, "terms")
    assert model.terms == ["a b", "c"]
    assert {r["id"]: r["indices"] for r in model.weights(docs, "terms").collect()} == {1: [0, 1], 2: [], 3: []}


def test_rows_of_weights_need_no_generator(spark):
    docs = spark.createDataFrame([(1, "some text")], "id long, text string")
    model = tfidf.TfidfModel(["some", "some text"], [1.0, 2.0])
    plan = plan_of(model.weights_long(docs, "id", "text"))
    assert "Generate" not in plan and "Join" not in plan
    assert "from_json" not in plan_of(model.features_in_batches(docs, "text"))


def test_packed_rows_are_the_rows():
    batch = pa.RecordBatch.from_arrays(
        [pa.array([1.0, 0.0]), pa.array([2, -2], pa.int32()), pa.array([[1, 4], []], pa.list_(pa.int32())), pa.array([[0.5, 2.0], []], pa.list_(pa.float64()))],
        ["label", "fold", "indices", "values"],
    )
    plain, (packed,) = _Rows.of(batch), _Rows.packed(_pack(iter([batch])))
    for name in ("label", "fold", "row", "indices", "values"):
        assert getattr(plain, name).tolist() == getattr(packed, name).tolist()
