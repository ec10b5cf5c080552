"""Language identification with string kernels.

The kernel of two texts is the number of n-grams of letters, of 1 to ``MAX_N`` at a time (a blended
spectrum), that are present in both, over the root of the product of their own numbers. Letters are
lowered and everything else is a word border; a letter of the Latin alphabet has a code of its own and
others share the remaining 37, so letters of larger scripts meet in one code.

Training takes, per language, the ``PER_LANGUAGE`` labelled keys with the smallest hash, a bound that does not grow
with the input; of rows that share key and language the one whose text hashes lowest. More than ``MAX_LANGUAGES``
languages raise. ``LANDMARKS`` of the rows, dealt evenly over the languages, are the
Nystroem landmarks: kernel ridge regression, one language against the rest, is solved in the space
they span. A text is scored by two matrix products, its n-gram presence with the landmarks' and
their kernel values with the coefficients; batches hold as many texts as fit ``BATCH_CELLS``.

Null texts and texts without a letter get ``und`` and score 0. Scores are a softmax over the languages.
Rows without a label or a key do not train. Without any training text every text is ``und``. Texts are read whole; ties go to the
language that comes first by name; repeated rows get the same answer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nassaj.operators.sizes import collect_bounded

MAX_N = 3
ALPHABET = 64
PER_LANGUAGE = 300
MAX_LANGUAGES = 5_000
LANDMARKS = 192
RIDGE = 1e-2
SHARPNESS = 8.0
BATCH_CELLS = 4_000_000
UNDETERMINED = "und"

_OFFSETS = [sum(ALPHABET**k for k in range(1, n)) for n in range(1, MAX_N + 1)]
CELLS = sum(ALPHABET**n for n in range(1, MAX_N + 1))


def _codes() -> np.ndarray:
    """The code of every character of the basic plane: 0 for what is no letter."""
    table = np.zeros(0x10000, np.int32)
    for point in range(0x10000):
        c = chr(point)
        if c.isalpha():
            low = c.lower()[0]
            table[point] = ord(low) - 96 if "a" <= low <= "z" else 27 + ord(low) % (ALPHABET - 27)
    return table


_table: list[np.ndarray] = []


def letters(text: str) -> np.ndarray:
    """Codes of a text, with one border between words and at both ends; empty without letters."""
    if not _table:
        _table.append(_codes())
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    code = _table[0][np.minimum(points, 0xFFFF)]
    high = points > 0xFFFF
    if high.any():
        code = np.where(high, [27 + p % (ALPHABET - 27) if chr(p).isalpha() else 0 for p in points.tolist()], code)
    if not code.any():
        return code[:0]
    code = np.concatenate([[0], code, [0]])
    return code[np.concatenate([[True], (code[1:] != 0) | (code[:-1] != 0)])]


def present(text: str, seen: np.ndarray) -> np.ndarray:
    """Cells of the n-grams present in a text, sorted. ``seen`` is an all-false scratch row."""
    code = letters(text)
    if not len(code):
        return np.empty(0, np.int64)
    for n, offset in zip(range(1, MAX_N + 1), _OFFSETS, strict=True):
        if len(code) >= n:
            key = code[: len(code) - n + 1].astype(np.int64)
            for k in range(1, n):
                key = key * ALPHABET + code[k : len(code) - n + 1 + k]
            seen[key + offset] = True
    seen[0] = False  # a border alone says nothing
    cells = np.flatnonzero(seen)
    seen[cells] = False
    return cells


class Model:
    """Landmarks' n-grams, ridge coefficients and languages."""

    def __init__(self, texts: list[np.ndarray], langs: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> None:
        self.languages = sorted(set(langs))
        by_lang = {lang: [i for i, x in enumerate(langs) if x == lang] for lang in self.languages}
        turn = sorted((k, lang, i) for lang, own in by_lang.items() for k, i in enumerate(own))
        chosen = [i for _, _, i in turn[:landmarks]]
        self.vocabulary = np.unique(np.concatenate([texts[i] for i in chosen])) if chosen else np.empty(0, np.int64)
        self.column = np.full(CELLS, -1, np.int32)
        self.column[self.vocabulary] = np.arange(len(self.vocabulary))
        self.landmarks = np.zeros((len(self.vocabulary), len(chosen)), np.float32)
        for k, i in enumerate(chosen):
            self.landmarks[self.column[texts[i]], k] = 1 / np.sqrt(len(texts[i]))
        kernel = self.kernel(texts)
        between = kernel[chosen]
        value, vector = np.linalg.eigh(between.astype(float))
        root = vector / np.sqrt(np.maximum(value, 1e-6))
        z = kernel @ root
        target = np.array([[1.0 if x == lang else -1.0 for lang in self.languages] for x in langs])
        inner = np.linalg.solve(z.T @ z + ridge * len(texts) * np.eye(z.shape[1]), z.T @ target)
        self.coefficients = (root @ inner).astype(np.float32)

    def kernel(self, texts: list[np.ndarray]) -> np.ndarray:
        """Kernel values of texts with the landmarks."""
        out = np.empty((len(texts), self.landmarks.shape[1]), np.float32)
        step = max(1, BATCH_CELLS // max(1, len(self.vocabulary)))
        for at in range(0, len(texts), step):
            some = texts[at : at + step]
            rows = np.zeros((len(some), len(self.vocabulary)), np.float32)
            for row, cells in zip(rows, some, strict=True):
                known = self.column[cells]
                row[known[known >= 0]] = 1 / np.sqrt(max(1, len(cells)))
            out[at : at + step] = rows @ self.landmarks
        return out

    def predict(self, texts: list[np.ndarray]) -> tuple[list[str], np.ndarray]:
        scores = self.kernel(texts) @ self.coefficients
        e = np.exp(SHARPNESS * (scores - scores.max(1, keepdims=True)))
        p = e / e.sum(1, keepdims=True)
        best = p.argmax(1)
        found = [self.languages[b] if len(t) else UNDETERMINED for b, t in zip(best, texts, strict=True)]
        return found, np.where([len(t) > 0 for t in texts], p[np.arange(len(p)), best], 0.0).astype(float)


def _cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    seen = np.zeros(CELLS, bool)
    for df in batches:
        yield pd.DataFrame({"lang": df["lang"], "cells": [present(t, seen) for t in df["text"]]})


def smallest_hashes(keyed: DataFrame, group: str, count: int, max_groups: int = MAX_LANGUAGES) -> DataFrame:
    """The ``count`` different rows of each group with the smallest hash ``h`` of their key. Rows whose hash is far too
    large to be among them are dropped where they are read, and equal rows met in a task are one, so a group or a key
    with most of the rows gathers no more than another."""
    sizes = collect_bounded(keyed.groupBy(group).agg(F.approx_count_distinct("h").alias("size")), f"values of {group}", max_groups)
    table = keyed.sparkSession.createDataFrame(sizes, keyed.select(group, F.lit(0).cast("long").alias("size")).schema)
    likely = keyed.join(F.broadcast(table), group).where(
        (F.col("size") <= 2 * count) | (F.col("h").cast("double") / 2.0**63 < 4.0 * count / F.col("size") - 1)
    ).drop("size").distinct()
    nth = F.row_number().over(Window.partitionBy(group).orderBy("h", *[c for c in keyed.columns if c not in (group, "h")]))
    return likely.withColumn("nth", nth).where(F.col("nth") <= count).drop("nth")


def fit(docs: DataFrame, key: str, text: str, lang: str, per_language: int = PER_LANGUAGE, landmarks: int = LANDMARKS):
    """A broadcast model from labelled rows, or one without a model if there are none."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    rows = rows.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    keyed = rows.select("key", "lang", F.xxhash64(F.col("key").cast("string")).alias("h"))
    chosen = smallest_hashes(keyed, "lang", per_language)
    sample = rows.join(F.broadcast(chosen.select("key", "lang")), ["key", "lang"], "left_semi")
    sample = sample.groupBy("key", "lang").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    found = sample.select("lang", "text").mapInPandas(_cells, "lang string, cells array<int>").collect()
    kept = sorted(((r["lang"], r["cells"]) for r in found if r["cells"]), key=lambda x: (x[0], len(x[1]), x[1][:50]))
    model = Model([np.array(c) for _, c in kept], [x for x, _ in kept], landmarks) if kept else None
    return docs.sparkSession.sparkContext.broadcast(model)


def identify(text: Column | str, model) -> Column:
    """``lang_pred`` and ``score`` of each text, as a struct."""

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        seen, m = np.zeros(CELLS, bool), model.value
        for texts in batches:
            cells = [present(t, seen) if t else np.empty(0, np.int64) for t in texts]
            found = m.predict(cells) if m and len(cells) else ([UNDETERMINED] * len(cells), np.zeros(len(cells)))
            yield pd.DataFrame({"lang_pred": found[0], "score": found[1]})

    return predict.asNondeterministic()(text)


def held_out(key: Column | str) -> Column:
    """Whether a row is kept from training."""
    c = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.crc32(c.cast("string")) % 4 == 2, F.lit(False))
