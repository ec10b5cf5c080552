"""Quality classification by a generalised additive model with pairwise interactions.

Each text is measured (``FEATURES``), each measure falls into one of at most ``BINS`` bins, and the score
is the logistic function of a sum of table entries: one table per measure, and one per chosen pair of
measures. The tables are learned by boosting: round by round, measure after measure, a tree of at most
three leaves is fitted to what the sum still gets wrong, and a fraction of it is added to the measure's
table. Then the pairs whose two-level trees explain most of the rest are boosted in the same way. A text is
scored by adding its bins' entries, all texts of a batch at once.

Training takes the ``SAMPLE`` labelled rows with the smallest hash of their key, a bound that does not
grow with the input; null labels do not train. Without labels every score is 0.5. Null texts count as empty, and
empty texts are measured and scored like others. Texts are read whole; repeated rows get the same score.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nassaj.llm.langid import smallest_hashes
from nassaj.llm.lines import repeated_words

SAMPLE = 20_000
BINS, PAIR_BINS, PAIRS = 32, 8, 8
ROUNDS, PAIR_ROUNDS, RATE = 120, 60, 0.1
THRESHOLD = 0.7

SYMBOLS = "#*$%&|<>{}[]=_~^\\@"
FEATURES = (
    "log_words", "word_length", "symbols_per_word", "exclamations_per_word", "upper_share", "digit_share", "letter_share",
    "distinct_share", "repeated_share", "same_as_previous", "top_word_share", "bars_per_word", "marks_per_word",
    "symbol_endings", "log_line_words", "ended_lines", "repeated_lines",
)


def measures(text: str) -> list[float]:
    words = text.split()
    n = len(words)
    lines = [x for x in (line.strip() for line in text.split("\n")) if x]
    if not n:
        return [0.0] * len(FEATURES)
    chars = sum(map(len, words))
    upper = sum(map(str.isupper, text)) if text != text.lower() else 0
    letters = sum(map(str.isalpha, text))
    digits = sum(map(text.count, "0123456789"))
    counts = Counter(words)
    return [
        np.log1p(n), chars / n, sum(map(text.count, SYMBOLS)) / n, text.count("!") / n, upper / max(1, letters),
        digits / chars, letters / chars, len(counts) / n ** 0.9, repeated_words(words) / n,
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / n, max(counts.values()) / n,
        text.count("|") / n, sum(map(text.count, ".,;:?")) / n, sum(w[-1] in SYMBOLS for w in words) / n,
        np.log1p(n / len(lines)), sum(x[-1] in ".!?…\"')" for x in lines) / len(lines), 1 - len(set(lines)) / len(lines),
    ]


def _leaf(g: float, h: float) -> float:
    return g / (h + 1.0)


def _best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best cut of a histogram; the place is where the right part begins."""
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    if not len(left_g):
        return 0.0, 0
    total_g, total_h = g.sum(), h.sum()
    gain = left_g**2 / (left_h + 1) + (total_g - left_g) ** 2 / (total_h - left_h + 1) - total_g**2 / (total_h + 1)
    at = int(gain.argmax())
    return float(gain[at]), at + 1


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Values by bin of a tree of at most three leaves."""
    parts = [(0, len(g))]
    for _ in range(2):
        cuts = [(*_best_cut(g[a:b], h[a:b]), a, b) for a, b in parts]
        gain, at, a, b = max(cuts)
        if gain <= 1e-9:
            break
        parts.remove((a, b))
        parts += [(a, a + at), (a + at, b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = _leaf(g[a:b].sum(), h[a:b].sum())
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of a tree that cuts one measure, then the other on both sides."""
    best = (0.0, np.zeros(g.shape))
    for flip in (False, True):
        a, b = (g.T, h.T) if flip else (g, h)
        for at in range(1, a.shape[0]):
            gain, out = 0.0, np.zeros(a.shape)
            for part in (slice(None, at), slice(at, None)):
                pg, ph = a[part].sum(0), b[part].sum(0)
                more, cut = _best_cut(pg, ph)
                gain += more + pg.sum() ** 2 / (ph.sum() + 1)
                if cut:
                    out[part, :cut] = _leaf(pg[:cut].sum(), ph[:cut].sum())
                    out[part, cut:] = _leaf(pg[cut:].sum(), ph[cut:].sum())
            gain -= a.sum() ** 2 / (b.sum() + 1)
            if gain > best[0]:
                best = (gain, out.T if flip else out)
    return best


class Model:
    """Bin edges, tables of measures and of pairs of measures."""

    def __init__(self, x: np.ndarray, y: np.ndarray) -> None:
        share = (y.sum() + 1) / (len(y) + 2)
        self.start = float(np.log(share / (1 - share)))
        self.edges = [_edges(x[:, f], BINS) for f in range(x.shape[1])]
        self.coarse = [_edges(x[:, f], PAIR_BINS) for f in range(x.shape[1])]
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        self.pairs: list[tuple[int, int, np.ndarray]] = []
        if len(set(y.tolist())) < 2:
            return
        bins, margin = self._bins(x, self.edges), np.full(len(y), self.start)
        for _ in range(ROUNDS):
            for f, table in enumerate(self.tables):
                g, h = self._left(margin, y)
                step = RATE * _tree(np.bincount(bins[f], g, len(table)), np.bincount(bins[f], h, len(table)))
                table += step
                margin += step[bins[f]]
        coarse = self._bins(x, self.coarse)
        g, h = self._left(margin, y)
        gains = []
        for i in range(x.shape[1]):
            for j in range(i):
                gains.append((_pair_tree(*self._grid(coarse, i, j, g, h))[0], i, j))
        self.pairs = [(i, j, np.zeros((len(self.coarse[i]) + 1, len(self.coarse[j]) + 1))) for _, i, j in sorted(gains)[::-1][:PAIRS]]
        for _ in range(PAIR_ROUNDS):
            for i, j, table in self.pairs:
                g, h = self._left(margin, y)
                step = RATE * _pair_tree(*self._grid(coarse, i, j, g, h))[1]
                table += step
                margin += step[coarse[i], coarse[j]]

    @staticmethod
    def _left(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-margin))
        return y - p, p * (1 - p)

    @staticmethod
    def _bins(x: np.ndarray, edges: list[np.ndarray]) -> list[np.ndarray]:
        return [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(edges)]

    def _grid(self, bins: list, i: int, j: int, g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        shape = (len(self.coarse[i]) + 1, len(self.coarse[j]) + 1)
        cell = bins[i] * shape[1] + bins[j]
        return tuple(np.bincount(cell, v, shape[0] * shape[1]).reshape(shape) for v in (g, h))

    def score(self, x: np.ndarray) -> np.ndarray:
        bins, coarse = self._bins(x, self.edges), self._bins(x, self.coarse)
        margin = np.full(len(x), self.start)
        for table, b in zip(self.tables, bins, strict=True):
            margin += table[b]
        for i, j, table in self.pairs:
            margin += table[coarse[i], coarse[j]]
        return 1 / (1 + np.exp(-margin))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    """Cuts between bins: quantiles, and even steps, which part rare large values."""
    q = np.quantile(values, np.linspace(0, 1, bins // 2 + 1)[1:-1])
    even = np.linspace(values.min(), values.max(), bins // 2 + 1)[1:-1]
    return np.unique(np.concatenate([q, even]))


def _measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for df in batches:
        yield pd.DataFrame({"label": df["label"], "x": [measures(t or "") for t in df["text"]]})


def fit(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, sample: int = SAMPLE):
    """A broadcast model from the labels; both tables have the key."""
    known = labels.select(F.col(key).alias("key"), F.col(label).cast("double").alias("label")).where("label IS NOT NULL")
    keyed = known.select("key", "label", F.xxhash64(F.col("key").cast("string")).alias("h"), F.lit(0).alias("all"))
    chosen = smallest_hashes(keyed, "all", sample).select("key", "label")
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(F.broadcast(chosen), "key")
    rows = rows.groupBy("key", "label").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    found = rows.select("label", "text").mapInPandas(_measured, "label double, x array<double>").collect()
    found.sort(key=lambda r: (r["label"], r["x"]))
    model = Model(np.array([r["x"] for r in found]), np.array([r["label"] for r in found])) if found else None
    return docs.sparkSession.sparkContext.broadcast(model)


def quality(text: Column | str, model) -> Column:
    """The score of each text, 0 to 1."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = model.value
        for texts in batches:
            x = np.array([measures(t or "") for t in texts]).reshape(len(texts), len(FEATURES))
            yield pd.Series(m.score(x) if m else np.full(len(texts), 0.5))

    return score.asNondeterministic()(text)
