"""Cleaning of Arabic-script text as native column expressions."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nassaj.functions import fixed


@dataclass(frozen=True)
class CleanConfig:
    """Which cleaning steps run; Latin letters and digits stay by default."""

    remove_diacritics: bool = True
    remove_tatweel: bool = True
    normalize_alef: bool = True
    normalize_teh_marbuta: bool = True
    remove_punctuation: bool = True
    remove_english: bool = False
    remove_numbers: bool = False
    remove_extra_whitespace: bool = True

    @classmethod
    def of(cls, config: CleanConfig | Mapping[str, bool] | None) -> CleanConfig:
        if config is None:
            return cls()
        if isinstance(config, cls):
            return config
        unknown = sorted(set(config) - {f.name for f in fields(cls)})
        if unknown:
            raise ValueError(f"Unknown cleaning steps: {', '.join(unknown)}")
        return cls(**config)


def remove_diacritics(c: Column) -> Column:
    return F.translate(c, fixed.DIACRITICS, "")


def remove_tatweel(c: Column) -> Column:
    return F.translate(c, fixed.TATWEEL, "")


def normalize_alef(c: Column) -> Column:
    return F.translate(c, fixed.ALEF_FORMS, fixed.ALEF * len(fixed.ALEF_FORMS))


def normalize_teh_marbuta(c: Column) -> Column:
    return F.translate(c, fixed.TEH_MARBUTA, fixed.HEH)


def remove_punctuation(c: Column) -> Column:
    """Also removes tatweel, which is in the punctuation set."""
    return F.translate(c, fixed.PUNCTUATION, "")


def remove_english(c: Column) -> Column:
    """Removes a-z and A-Z only; accented Latin letters stay."""
    return F.translate(c, fixed.LATIN_LETTERS, "")


def remove_numbers(c: Column) -> Column:
    return F.translate(c, fixed.DIGITS, "")


def remove_extra_whitespace(c: Column) -> Column:
    # Runs are single spaces after the replacement, so a plain trim strips the ends.
    return F.trim(F.regexp_replace(c, fixed.WHITESPACE + "+", " "))


def clean(c: Column, config: CleanConfig | Mapping[str, bool] | None = None) -> Column:
    """The configured chain; null and blank give ``""``.

    Every step but the last maps single characters, so all enabled ones run as
    one ``translate`` over the text.
    """
    cfg = CleanConfig.of(config)
    replaced, replacement, deleted = "", "", ""
    if cfg.normalize_alef:
        replaced += fixed.ALEF_FORMS
        replacement += fixed.ALEF * len(fixed.ALEF_FORMS)
    if cfg.normalize_teh_marbuta:
        replaced += fixed.TEH_MARBUTA
        replacement += fixed.HEH
    if cfg.remove_diacritics:
        deleted += fixed.DIACRITICS
    if cfg.remove_tatweel:
        deleted += fixed.TATWEEL
    if cfg.remove_punctuation:
        deleted += fixed.PUNCTUATION
    if cfg.remove_english:
        deleted += fixed.LATIN_LETTERS
    if cfg.remove_numbers:
        deleted += fixed.DIGITS

    text = F.coalesce(c.cast("string"), F.lit(""))
    out = F.translate(text, replaced + deleted, replacement) if replaced or deleted else text
    if cfg.remove_extra_whitespace:
        return remove_extra_whitespace(out)
    has_text = text.rlike("[^" + fixed.WHITESPACE[1:])
    return F.when(has_text, out).otherwise(F.lit(""))


def clean_dataframe(
    df: DataFrame,
    text_column: str,
    new_column: str | None = None,
    config: CleanConfig | Mapping[str, bool] | None = None,
) -> DataFrame:
    """Clean a column in place, or into ``new_column``."""
    return df.withColumn(new_column or text_column, clean(F.col(text_column), config))
