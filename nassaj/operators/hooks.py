"""Plug a model into a batch query.

The user passes a factory that loads the model and returns a function from a list
of texts to a list of results. It runs once per Python worker; results do not
depend on how rows fall into batches.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from nassaj.functions import fixed
from nassaj.operators.entities import PREDICTIONS, entity_groups

ModelFactory = Callable[[], Callable[[list], list]]

_loaded: dict[str, Callable[[list], list]] = {}


def _load_once(key: str, factory: ModelFactory) -> Callable[[list], list]:
    if key not in _loaded:
        _loaded[key] = factory()
    return _loaded[key]


def batch_model(
    factory: ModelFactory, return_type: str, batch_size: int = fixed.BATCH_SIZE
) -> Callable[[Column], Column]:
    """A column function that runs the model over ``batch_size`` rows at a time.

    Results are sent on after every call of the model, so that a worker holds those of one call, however
    many rows an Arrow batch of texts has.
    """
    if batch_size < 1:
        raise ValueError("batch_size must be positive")
    key = uuid.uuid4().hex

    @F.pandas_udf(return_type)
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = _load_once(key, factory)
        for texts in batches:
            for i in range(0, len(texts), batch_size):
                part = list(texts.iloc[i : i + batch_size])
                out = list(model(part))
                if len(out) != len(part):
                    raise ValueError(f"model returned {len(out)} results for {len(part)} texts")
                yield pd.Series(out, dtype=object)

    return predict


def tagger(
    factory: ModelFactory, strategy: str = "simple", batch_size: int = fixed.BATCH_SIZE
) -> Callable[[Column], Column]:
    """Entities of a text from a model that returns piece predictions (see ``PREDICTIONS``)."""
    pieces = batch_model(factory, PREDICTIONS, batch_size)
    return lambda c: entity_groups(pieces(c), strategy)


def summarizer(factory: ModelFactory, batch_size: int = fixed.BATCH_SIZE) -> Callable[[Column], Column]:
    """Summary of a text from a model that returns strings."""
    return batch_model(factory, "string", batch_size)
