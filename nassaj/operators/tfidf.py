"""TF-IDF features (M4-M8)."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nassaj.functions import fixed
from nassaj.functions.arrays import let, ngrams, unnest, value_counts
from nassaj.operators import terms
from nassaj.operators.sizes import kept

#: Parts of a sketch that are summed apart, and rows sent together.
SKETCH_PARTS = 64
SENT_ROWS = 1 << 16
_ROWS, _TERM, _SKETCH = range(3)


def document_terms(c: Column, ngram_range: tuple[int, int] = fixed.NGRAM_RANGE) -> Column:
    """Lowercase words of at least two word characters, and their n-grams."""
    low, high = ngram_range
    words = F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(fixed.TERM), F.lit(0))
    if (low, high) == (1, 1):
        return words
    return let(words, lambda w: F.concat(*[ngrams(w, n) for n in range(low, high + 1)]))


def _terms_of(df: DataFrame, column: str, ngram_range: tuple[int, int]) -> Column:
    """The terms of a text column, or the array of a column that holds terms already."""
    return F.col(column) if _holds_terms(df, column) else document_terms(F.col(column), ngram_range)


def _holds_terms(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.ArrayType)


def _sent(df: DataFrame, column: str, ngram_range: tuple[int, int]) -> tuple[Column, tuple[int, int]]:
    """What a task counts, and the lengths of its n-grams; an array's elements are whole terms."""
    if _holds_terms(df, column):
        return F.col(column).cast("array<string>"), (1, 1)
    return terms.prepared(F.col(column)), tuple(ngram_range)


def term_statistics(
    df: DataFrame, text_col: str, ngram_range=fixed.NGRAM_RANGE, sieve: np.ndarray | None = None
) -> DataFrame:
    """``term, tf, df`` over the corpus; with a ``sieve``, of the terms whose place in it is set.

    Every task counts some million words at a time; the only shuffle carries partial sums by term.
    """
    text, lengths = _sent(df, text_col, ngram_range)
    sent = None if sieve is None else df.sparkSession.sparkContext.broadcast(sieve)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in terms.chunks(b.column(0) for b in batches):
            for found in terms.grams(chunk, lengths):
                wanted = np.ones(found.size, bool)
                if sent is not None:
                    wanted = sent.value[terms.place(found, len(sent.value).bit_length() - 1)]
                some = np.flatnonzero(wanted)
                tf, rows = found.counts()[some], found.rows(chunk, wanted)[some]
                for i in range(0, len(some), SENT_ROWS):
                    part = slice(i, i + SENT_ROWS)
                    yield pa.RecordBatch.from_arrays(
                        [found.terms(some[part]), pa.array(tf[part], pa.int64()), pa.array(rows[part], pa.int64())], ["term", "tf", "df"]
                    )

    counted = df.select(text.alias("text")).mapInArrow(run, "term string, tf long, df long")
    return counted.groupBy("term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))


def _survey(df: DataFrame, text_col: str, max_features: int, ngram_range: tuple[int, int]) -> tuple[int, np.ndarray | None]:
    """The number of rows, and a sieve that lets through all of the ``max_features`` most frequent terms.

    Every task sends its chunks' most frequent terms and adds all its counts up in a sketch. The sums of the first give a
    count that the last of the wanted terms has at least; a term whose counter in the summed sketch is below it is not
    among them. No sieve where there are not so many terms.
    """
    text, lengths = _sent(df, text_col, ngram_range)
    bits = terms.bits_for(max_features)
    tasks = 4 * df.sparkSession.sparkContext.defaultParallelism  # each sends a sketch

    def batch(kind: int, term, n, counters=None) -> pa.RecordBatch:
        counters = [None] * len(n) if counters is None else counters
        arrays = [pa.array([kind] * len(n), pa.int32()), pa.array(term, pa.string()), pa.array(n, pa.int64()), pa.array(counters, pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, ["kind", "term", "n", "counters"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, sketch = 0, terms.Sketch(bits)
        for chunk in terms.chunks(b.column(0) for b in batches):
            rows += chunk.rows
            found = terms.grams(chunk, lengths)
            counts = [g.counts() for g in found]
            for g, n in zip(found, counts, strict=True):
                sketch.add(g, n)
            yield batch(_TERM, *terms.most_frequent(found, counts, max_features))
        yield batch(_ROWS, [None], [rows])
        for k, part in enumerate(np.split(sketch.counters, SKETCH_PARTS)):
            if part.any():
                yield batch(_SKETCH, [None], [k], [part.tobytes()])

    found = df.select(text.alias("text")).coalesce(tasks).mapInArrow(run, "kind int, term string, n long, counters binary")
    with kept(found) as found:
        rows = found.where(F.col("kind") == _ROWS).agg(F.sum("n")).first()[0] or 0
        sums = found.where(F.col("kind") == _TERM).groupBy("term").agg(F.sum("n").alias("n"))
        least = sums.orderBy(F.desc("n")).limit(max_features).agg(F.count("*").alias("terms"), F.min("n").alias("n")).first()
        if least["terms"] < max_features:
            return rows, None
        bound = least["n"]

        def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, np.ndarray] = {}
            for b in batches:
                for k, counters in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                    sums[k] = sums.get(k, 0) + np.frombuffer(counters.as_py(), np.int64)
            packed = [np.packbits(n >= bound).tobytes() for n in sums.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array(packed, pa.binary())], ["n", "places"])

        sketches = found.where(F.col("kind") == _SKETCH).select("n", "counters").repartition(SKETCH_PARTS, "n")
        places = np.zeros((SKETCH_PARTS, (1 << bits) // SKETCH_PARTS), bool)
        for r in sketches.mapInArrow(passing, "n long, places binary").collect():  # 2^22 bits at most
            places[r["n"]] = np.unpackbits(np.frombuffer(r["places"], np.uint8))
    return rows, places.ravel()


def _vocabulary(df: DataFrame, text_col: str, max_features: int, ngram_range: tuple[int, int]) -> tuple[int, DataFrame]:
    documents, sieve = _survey(df, text_col, max_features, ngram_range)
    found = term_statistics(df, text_col, ngram_range, sieve)
    return documents, found.orderBy(F.desc("tf"), "term").limit(max_features)


def vocabulary(
    df: DataFrame,
    text_col: str,
    max_features: int = fixed.MAX_FEATURES,
    ngram_range=fixed.NGRAM_RANGE,
) -> DataFrame:
    """The ``max_features`` most frequent terms; equal counts in term order.

    A first pass, when called, finds which terms can be among them; a second counts only these.
    """
    return _vocabulary(df, text_col, max_features, ngram_range)[1]


def fit_table(
    df: DataFrame,
    text_col: str,
    max_features: int = fixed.MAX_FEATURES,
    ngram_range=fixed.NGRAM_RANGE,
) -> DataFrame:
    """``term, tf, df, idf`` of the vocabulary; idf is ln((1+n)/(1+df)) + 1."""
    documents, found = _vocabulary(df, text_col, max_features, ngram_range)
    return found.withColumn("idf", F.log((documents + 1) / (F.col("df") + 1)) + 1.0)


def weights_by_join(
    df: DataFrame,
    table: DataFrame,
    id_col: str,
    text_col: str,
    ngram_range=fixed.NGRAM_RANGE,
) -> DataFrame:
    """``id, term, weight`` for a vocabulary of any size, by joining on the term.

    Each document sends one row per distinct term. No side is broadcast by hint;
    a term found in most documents makes a skewed partition, which adaptive
    execution splits because the vocabulary side is unique.
    """
    terms = value_counts(_terms_of(df, text_col, ngram_range))
    counted = unnest(df, terms, id_col, name="t").select(id_col, F.col("t.value").alias("term"), F.col("t.n").alias("n"))
    raw = counted.join(table.select("term", "idf"), "term").select(
        id_col, "term", ((F.log("n") + 1.0) * F.col("idf")).alias("w")
    )
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(id_col)))
    return raw.select(id_col, "term", (F.col("w") / norm).alias("weight"))


def sparse_vector(size: int, indices: Column, values: Column) -> Column:
    """An ML vector from its indices and values.

    No function makes one from arrays, but JSON is parsed into any type by its storage form.
    """
    stored = F.struct(
        F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"), indices.alias("indices"), values.alias("values")
    )
    text = F.to_json(F.struct(stored.alias("v")))
    return F.from_json(text, T.StructType([T.StructField("v", VectorUDT())]))["v"]


def _log(n: np.ndarray) -> np.ndarray:
    """1 + ln n; few counts differ."""
    different, which = np.unique(n, return_inverse=True)
    return np.array([math.log(x) + 1.0 for x in different.tolist()], float)[which]


def _entries(lookup: terms.Lookup, idf: np.ndarray, chunk: terms.Words, unit: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``row, term, weight`` of the known terms, by row and term."""
    row, term, n = lookup.counts(chunk)
    w = _log(n) * (n * idf[term] / n)
    if unit:
        w = w / np.sqrt(np.bincount(row, w * w, chunk.rows))[row]
    return row, term, w


@dataclass
class TfidfModel:
    """A fitted vocabulary with its idf; terms are numbered in sort order.

    The driver and every executor hold the vocabulary: ``max_features`` terms, as the caller chose.
    Where that is too many, ``weights_by_join`` takes a vocabulary of any size. A text column may also
    be one of term arrays.
    """

    terms: list[str]
    idf: list[float]
    ngram_range: tuple[int, int] = fixed.NGRAM_RANGE
    _vectorizer: CountVectorizerModel | None = field(default=None, repr=False, compare=False)
    _sent: Broadcast | None = field(default=None, repr=False, compare=False)

    @classmethod
    def fit(
        cls,
        df: DataFrame,
        text_col: str,
        max_features: int = fixed.MAX_FEATURES,
        ngram_range=fixed.NGRAM_RANGE,
    ) -> TfidfModel:
        """Two passes over the texts, when called: one finds which terms can be frequent, one counts these."""
        if max_features < 1:
            raise ValueError("max_features must be at least 1")
        rows = fit_table(df, text_col, max_features, ngram_range).select("term", "idf").collect()
        rows.sort(key=lambda r: r["term"].encode("utf-8"))
        return cls([r["term"] for r in rows], [r["idf"] for r in rows], tuple(ngram_range))

    @property
    def size(self) -> int:
        return len(self.terms)

    def _broadcast(self, df: DataFrame) -> Broadcast:
        if self._sent is None:
            self._sent = df.sparkSession.sparkContext.broadcast((self.terms, np.array(self.idf, float)))
        return self._sent

    def _weighted(self, df: DataFrame, text_col: str, unit: bool, vector: bool) -> Column:
        """Indices and weights of every row's known terms: a struct of two arrays, or an ML vector."""
        text, lengths = _sent(df, text_col, self.ngram_range)
        lengths = None if _holds_terms(df, text_col) else lengths
        size = self.size
        sent = self._broadcast(df)

        def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
            lookup, idf = terms.Lookup(sent.value[0], lengths), sent.value[1]
            for texts in columns:
                chunk = terms.words_of(texts)
                row, term, w = _entries(lookup, idf, chunk, unit)
                ends = pa.array(np.append(0, np.cumsum(np.bincount(row, minlength=chunk.rows))), pa.int32())
                arrays = {
                    "indices": pa.ListArray.from_arrays(ends, pa.array(term, pa.int32())),
                    "weights": pa.ListArray.from_arrays(ends, pa.array(w, pa.float64())),
                }
                if vector:  # the form that Spark stores a sparse vector in
                    fixed_parts = {"type": pa.array(np.zeros(chunk.rows), pa.int8()), "size": pa.array(np.full(chunk.rows, size), pa.int32())}
                    arrays = {**fixed_parts, "indices": arrays["indices"], "values": arrays["weights"]}
                yield pa.StructArray.from_arrays(list(arrays.values()), list(arrays))

        kind = VectorUDT() if vector else "struct<indices:array<int>,weights:array<double>>"
        return F.arrow_udf(run, kind)(text)

    def raw_weights(self, df: DataFrame, text_col: str, unit: bool = False) -> DataFrame:
        """Add ``indices`` and ``weights``: (1 + ln tf) * idf, before scaling to length 1.

        Counting and scaling run within the task, a batch at a time; nothing is shuffled.
        """
        weighted = df.withColumn("_weighted", self._weighted(df, text_col, unit, False))
        return weighted.withColumns({
            "indices": F.col("_weighted.indices"), "weights": F.col("_weighted.weights"),
        }).drop("_weighted")

    def weights(self, df: DataFrame, text_col: str) -> DataFrame:
        """Add ``indices`` and ``weights`` of unit length; empty where no term is known."""
        return self.raw_weights(df, text_col, unit=True)

    def term_table(self, spark: SparkSession) -> DataFrame:
        """``idx, term, idf``; as many rows as the model has features."""
        rows = [(i, t, w) for i, (t, w) in enumerate(zip(self.terms, self.idf, strict=True))]
        return spark.createDataFrame(rows, "idx int, term string, idf double")

    def weights_long(self, df: DataFrame, id_col: str, text_col: str) -> DataFrame:
        """``id, term, weight``, one row per document and known term."""
        text, lengths = _sent(df, text_col, self.ngram_range)
        lengths = None if _holds_terms(df, text_col) else lengths
        sent = self._broadcast(df)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lookup, idf, known = terms.Lookup(sent.value[0], lengths), sent.value[1], pa.array(sent.value[0], pa.string())
            for b in batches:
                row, term, w = _entries(lookup, idf, terms.words_of(b.column(1)), True)
                for i in range(0, len(row), SENT_ROWS):
                    part = slice(i, i + SENT_ROWS)
                    ids, names = b.column(0).take(pa.array(row[part])), known.take(pa.array(term[part]))
                    yield pa.RecordBatch.from_arrays([ids, names, pa.array(w[part], pa.float64())], [id_col, "term", "weight"])

        kind = T.StructType([df.select(id_col).schema[0], T.StructField("term", T.StringType()), T.StructField("weight", T.DoubleType())])
        return df.select(id_col, text.alias("_text")).mapInArrow(run, kind)

    def _counts(self, df: DataFrame, text_col: str) -> DataFrame:
        if self._vectorizer is None:
            self._vectorizer = CountVectorizerModel.from_vocabulary(
                self.terms, inputCol="_terms", outputCol="_tf"
            )
        scale = ElementwiseProduct(
            scalingVec=Vectors.dense(self.idf), inputCol="_tf", outputCol="_tf_idf"
        )
        terms = df.withColumn("_terms", _terms_of(df, text_col, self.ngram_range))
        return scale.transform(self._vectorizer.transform(terms)).drop("_terms")

    def _row_weights(self, df: DataFrame, text_col: str) -> DataFrame:
        """:meth:`raw_weights` on the JVM, within the row."""
        counted = self._counts(df, text_col).withColumns({
            "_tf": F.unwrap_udt("_tf"), "_tf_idf": F.unwrap_udt("_tf_idf"),
        })
        weight = F.zip_with(
            "_tf.values", "_tf_idf.values", lambda tf, scaled: (F.log(tf) + 1.0) * (scaled / tf)
        )
        return counted.withColumns({
            "indices": F.col("_tf.indices"), "weights": weight,
        }).drop("_tf", "_tf_idf")

    def features(self, df: DataFrame, text_col: str, output_col: str = "features") -> DataFrame:
        """Add the weights as a sparse ML vector, made on the JVM: a saved model is applied without Python."""
        vector = sparse_vector(self.size, F.col("indices"), F.col("weights"))
        raw = self._row_weights(df, text_col).withColumn("_raw", vector).drop("indices", "weights")
        return Normalizer(p=2.0, inputCol="_raw", outputCol=output_col).transform(raw).drop("_raw")

    def features_in_batches(self, df: DataFrame, text_col: str, output_col: str = "features") -> DataFrame:
        """:meth:`features` in Arrow batches, for training."""
        return df.withColumn(output_col, self._weighted(df, text_col, True, True))
