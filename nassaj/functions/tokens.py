"""Words, stopwords, light stems and their composition (K1-K9)."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nassaj.functions import fixed
from nassaj.functions.clean import CleanConfig, clean

Stage = Callable[[Column], Column]

_PREFIX = "|".join(sorted(fixed.PREFIXES, key=len, reverse=True))
_SUFFIX = "|".join(sorted(fixed.SUFFIXES, key=len, reverse=True))
_ASCII_PUNCTUATION = r"([!-/:-@\[-`{-~])"


def tokenize(c: Column, split_punct: bool = False) -> Column:
    """Whitespace-separated words; ``split_punct`` sets ASCII punctuation apart."""
    text = F.coalesce(c, F.lit(""))
    if split_punct:
        text = F.regexp_replace(text, _ASCII_PUNCTUATION, r" $1 ")
    return F.array_remove(F.split(text, fixed.WHITESPACE + "+"), "")


def stopword_list(
    custom: Iterable[str] = (), normalize: bool = False, config: CleanConfig | None = None
) -> list[str]:
    """The built-in list plus ``custom``.

    Stopwords are matched against cleaned text, in which some of them cannot
    occur any more; ``normalize=True`` rewrites the letters of the list as
    cleaning does.
    """
    words = dict.fromkeys([*fixed.STOPWORDS, *custom])
    if normalize:
        cfg = CleanConfig.of(config)
        letters: dict[int, str] = {}
        if cfg.normalize_alef:
            letters.update(dict.fromkeys(map(ord, fixed.ALEF_FORMS), fixed.ALEF))
        if cfg.normalize_teh_marbuta:
            letters[ord(fixed.TEH_MARBUTA)] = fixed.HEH
        words = dict.fromkeys(w.translate(letters) for w in words)
    return list(words)


def remove_stopwords(tokens: Column, stopwords: Iterable[str] = fixed.STOPWORDS) -> Column:
    """Drop stopwords and every token shorter than two characters."""
    listed = list(stopwords)
    if not listed:
        return F.filter(tokens, lambda t: F.length(t) > 1)
    return F.filter(tokens, lambda t: (F.length(t) > 1) & ~t.isin(listed))


def process_tokens(
    c: Column, remove_stops: bool = True, stopwords: Iterable[str] = fixed.STOPWORDS
) -> Column:
    tokens = tokenize(c)
    return remove_stopwords(tokens, stopwords) if remove_stops else tokens


def _strip_affixes(c: Column, char: str, start: str, end: str) -> Column:
    # Which affix comes next is never ambiguous (no affix ends, or begins, another
    # one), so a counted repetition strips what as many single passes would.
    rest = f"{char}{{{fixed.STEM_MIN_REST}}}"
    times = f"{{1,{fixed.STEM_PASSES}}}"
    c = F.regexp_replace(c, f"{start}(?:(?:{_PREFIX})(?={rest})){times}", "")
    return F.regexp_replace(c, f"(?<={rest})(?:{_SUFFIX}){times}{end}", "")


def stem(word: Column) -> Column:
    """Light stem of one word: up to three prefixes, then up to three suffixes."""
    return _strip_affixes(word, "(?s:.)", r"\A", r"\z")


def stem_tokens(tokens: Column) -> Column:
    return F.transform(tokens, stem)


def stem_words(tokens: Column) -> Column:
    """:func:`stem_tokens` for tokens without whitespace, about twice as fast.

    Runs the two expressions over the joined words instead of once per word.
    """
    stemmed = _strip_affixes(F.array_join(tokens, " "), "[^ ]", "(?<![^ ])", "(?![^ ])")
    return F.array_remove(F.split(stemmed, " "), "")


class TextProcessor:
    """Clean, tokenize, filter, stem; each of the three stages can be replaced.

    A stage is any function from column to column.
    """

    def __init__(
        self,
        config: CleanConfig | Mapping[str, bool] | None = None,
        stopwords: Iterable[str] = fixed.STOPWORDS,
        cleaner: Stage | None = None,
        tokenizer: Stage | None = None,
        stemmer: Stage | None = None,
    ):
        self.stopwords = list(stopwords)
        self._clean = cleaner or (lambda c: clean(c, config))
        self._tokenize = tokenizer or tokenize
        self._stem = stemmer or (stem_tokens if tokenizer else stem_words)

    def columns(
        self, c: Column, remove_stops: bool = True, apply_stemming: bool = False
    ) -> dict[str, Column]:
        cleaned = self._clean(c)
        tokens = self._tokenize(cleaned)
        if remove_stops:
            tokens = remove_stopwords(tokens, self.stopwords)
        stems = self._stem(tokens) if apply_stemming else tokens
        return {"cleaned": cleaned, "tokens": tokens, "stemmed_tokens": stems}

    def stems(self, tokens: Column) -> Column:
        return self._stem(tokens)

    def run(self, c: Column, remove_stops: bool = True, apply_stemming: bool = False) -> Column:
        """One struct ``original, cleaned, tokens, stemmed_tokens`` per text."""
        parts = self.columns(c, remove_stops, apply_stemming)
        return F.struct(c.alias("original"), *[v.alias(k) for k, v in parts.items()])

    def run_on_dataframe(
        self,
        df: DataFrame,
        text_column: str,
        remove_stops: bool = True,
        apply_stemming: bool = False,
    ) -> DataFrame:
        """Add ``cleaned_text``, ``tokens`` and, when stemming, ``stemmed_tokens``."""
        df = df.withColumn("cleaned_text", self._clean(F.col(text_column)))
        tokens = self._tokenize(F.col("cleaned_text"))
        if remove_stops:
            tokens = remove_stopwords(tokens, self.stopwords)
        df = df.withColumn("tokens", tokens)
        if apply_stemming:
            df = df.withColumn("stemmed_tokens", self._stem(F.col("tokens")))
        return df
