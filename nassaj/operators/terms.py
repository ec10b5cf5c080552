"""Terms of many texts at once, as numbers: what a task does for TF-IDF between the shuffles (M4-M6).

A word gets its number in the batch's own dictionary, an n-gram that of its beginning and its last word. Strings are
made only of the terms that leave the task.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that are counted together in a task.
WORDS = 1 << 21
#: Texts that are split at a time.
TEXTS = 64
_WORD = re.compile(r"\w{2,}")


def prepared(c: Column) -> Column:
    """Lowercase text in which Python's word characters are those of ``fixed.TERM``.

    Python's tables of Unicode are newer than Java's, so that it knows letters which Java takes for unassigned.
    """
    return F.regexp_replace(F.lower(F.coalesce(c.cast("string"), F.lit(""))), r"\p{Cn}", " ")


class Words(NamedTuple):
    """The words of some rows, one after the other, and the row of each."""

    words: pa.Array
    row: np.ndarray
    rows: int


def _split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of some texts, or the elements of some arrays, and their numbers."""
    if pa.types.is_list(texts.type):
        words, lengths = texts.flatten(), pc.fill_null(pc.list_value_length(texts), 0).to_numpy()
        if words.null_count:
            row = np.repeat(np.arange(len(texts)), lengths)[words.is_valid().to_numpy(zero_copy_only=False)]
            return words.drop_null(), np.bincount(row, minlength=len(texts))
        return words, lengths
    found = [_WORD.findall(text or "") for text in texts.to_pylist()]
    return pa.array([w for words in found for w in words], pa.string()), np.array([len(words) for words in found], int)


def _joined(parts: list[tuple[pa.Array, np.ndarray]]) -> Words:
    lengths = np.concatenate([n for _, n in parts] or [np.zeros(0, int)])
    words = pa.concat_arrays([w for w, _ in parts]) if parts else pa.array([], pa.string())
    return Words(words, np.repeat(np.arange(len(lengths)), lengths), len(lengths))


def words_of(texts: pa.Array) -> Words:
    return _joined([_split(texts.slice(i, TEXTS)) for i in range(0, len(texts), TEXTS)])


def chunks(columns: Iterable[pa.Array], most: int = WORDS) -> Iterator[Words]:
    """The words of all rows, about ``most`` at a time; a row is never cut."""
    parts, size = [], 0
    for texts in columns:
        for i in range(0, len(texts), TEXTS):
            parts.append(_split(texts.slice(i, TEXTS)))
            size += len(parts[-1][0])
            if size >= most:
                yield _joined(parts)
                parts, size = [], 0
    if parts:
        yield _joined(parts)


class Grams:
    """The n-grams of one length in a chunk: where they are, and the distinct ones by number."""

    def __init__(self, chunk: Words, shorter: Grams | None = None) -> None:
        self.shorter = shorter
        if shorter is None:
            coded = chunk.words.dictionary_encode()
            self.first, self.words = self, coded.dictionary
            self.code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            self.at, self.length, self.size = np.arange(len(self.code)), 1, len(self.words)
            self.hash = pd.util.hash_array(self.words.to_numpy(zero_copy_only=False)) if self.size else np.zeros(0, np.uint64)
            return
        self.first, self.length = shorter.first, shorter.length + 1
        word, many = self.first.code, max(1, self.first.size)
        end = shorter.at + shorter.length
        inside = end < len(word)
        inside[inside] = chunk.row[end[inside]] == chunk.row[shorter.at[inside]]
        self.at = shorter.at[inside]
        self.code, pairs = pd.factorize(shorter.code[inside] * many + word[end[inside]])
        self.begin, self.last, self.size = pairs // many, pairs % many, len(pairs)
        mixed = shorter.hash[self.begin] * np.uint64(0x9E3779B97F4A7C15) + self.first.hash[self.last]
        mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        self.hash = mixed ^ (mixed >> np.uint64(29))

    def terms(self, numbers: np.ndarray) -> pa.Array:
        """Distinct terms as text."""
        if self.shorter is None:
            return self.words.take(pa.array(numbers))
        last = self.first.words.take(pa.array(self.last[numbers]))
        return pc.binary_join_element_wise(self.shorter.terms(self.begin[numbers]), last, " ")

    def counts(self) -> np.ndarray:
        return np.bincount(self.code, minlength=self.size)

    def rows(self, chunk: Words, wanted: np.ndarray) -> np.ndarray:
        """In how many rows each of the distinct terms is, for those that are ``wanted``."""
        some = wanted[self.code]
        pairs = np.sort(self.code[some] * max(1, chunk.rows) + chunk.row[self.at[some]])
        new = np.ones(len(pairs), bool)
        new[1:] = pairs[1:] != pairs[:-1]
        return np.bincount(pairs[new] // max(1, chunk.rows), minlength=self.size)


def grams(chunk: Words, ngram_range: tuple[int, int]) -> list[Grams]:
    low, high = ngram_range
    found = [Grams(chunk)]
    for _ in range(1, high):
        found.append(Grams(chunk, found[-1]))
    return found[low - 1 :]


class Sketch:
    """Counters that terms share by hash: each is at least the count of any of its terms."""

    def __init__(self, bits: int) -> None:
        self.bits, self.counters = bits, np.zeros(1 << bits, np.int64)

    def add(self, found: Grams, counts: np.ndarray) -> None:
        places = place(found, self.bits)
        self.counters += np.bincount(places, counts, 1 << self.bits).astype(np.int64)  # exact below 2^53


def place(found: Grams, bits: int) -> np.ndarray:
    return (found.hash >> np.uint64(64 - bits)).astype(np.int64)


def most_frequent(found: list[Grams], counts: list[np.ndarray], limit: int) -> tuple[pa.Array, np.ndarray]:
    """At most ``limit`` terms of a chunk, none less frequent than one left out."""
    all_counts = np.concatenate(counts)
    chosen = np.arange(len(all_counts))
    if len(chosen) > limit:
        chosen = np.sort(np.argpartition(-all_counts, limit - 1)[:limit])
    ends = np.cumsum([len(c) for c in counts])
    parts = np.split(chosen, np.searchsorted(chosen, ends[:-1]))
    texts = [g.terms(p - (end - len(c))) for g, p, end, c in zip(found, parts, ends, counts, strict=True)]
    return pa.concat_arrays(texts), all_counts[chosen]


class Lookup:
    """Numbers of known terms, found word by word."""

    def __init__(self, terms: list[str], ngram_range: tuple[int, int] | None) -> None:
        """``ngram_range`` is None where rows are arrays of whole terms."""
        low, high = ngram_range or (1, 1)
        split = [(i, t.split(" ") if ngram_range else [t]) for i, t in enumerate(terms)]
        split = [(i, ws) for i, ws in split if low <= len(ws) <= high]
        numbers = {w: k for k, w in enumerate(dict.fromkeys(w for _, ws in split for w in ws))}
        self.size, self.many = len(terms), max(1, len(numbers))
        self.words = pa.array(list(numbers), pa.string())
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []  # keys in order, and the term that ends there
        known: dict[tuple, int] = {}  # the number of every beginning
        for n in range(1, high + 1):
            ends: dict[int, tuple[int, tuple]] = {}
            for i, ws in split:
                if len(ws) >= n:
                    head = tuple(ws[:n])
                    key = (known[head[:-1]] if n > 1 else 0) * self.many + numbers[ws[n - 1]]
                    whole = i if len(ws) == n else ends.get(key, (-1,))[0]
                    ends[key] = (whole, head)
            ordered = sorted(ends)
            known.update((ends[key][1], k) for k, key in enumerate(ordered))
            self.levels.append((np.array(ordered, np.int64), np.array([ends[key][0] for key in ordered], np.int64)))

    def counts(self, chunk: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``row, term, n`` of the known terms, by row and term."""
        word = pc.fill_null(pc.index_in(chunk.words, value_set=self.words), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        at, code, found = np.arange(len(word)), np.zeros(len(word), np.int64), []
        for n, (keys, whole) in enumerate(self.levels):
            end = at + n
            inside = end < len(word)
            inside[inside] = (word[end[inside]] >= 0) & (chunk.row[end[inside]] == chunk.row[at[inside]])
            at, key = at[inside], code[inside] * self.many + word[end[inside]]
            code = np.searchsorted(keys, key)
            hit = code < len(keys)
            hit[hit] = keys[code[hit]] == key[hit]
            at, code = at[hit], code[hit]
            term = whole[code]
            found.append(chunk.row[at[term >= 0]] * self.size + term[term >= 0])
        pairs = np.sort(np.concatenate(found)) if found else np.zeros(0, np.int64)
        new = np.ones(len(pairs), bool)
        new[1:] = pairs[1:] != pairs[:-1]
        starts = np.flatnonzero(new)
        pairs = pairs[starts]
        return pairs // max(1, self.size), pairs % max(1, self.size), np.diff(np.append(starts, len(new)))


def bits_for(max_features: int) -> int:
    """Counters for some 200 times the terms that are looked for, 2^22 at most."""
    return min(22, max(12, (200 * max_features - 1).bit_length()))
