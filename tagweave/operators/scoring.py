"""Batch scoring with a trained model."""

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, functions as F


def score_pipeline(df: DataFrame, path: str) -> DataFrame:
    """Add the output columns of a saved Spark ML pipeline; stays on the JVM."""
    return PipelineModel.load(path).transform(df)


def score_with(load_model: Callable[[], Callable], column: Column, returns: str = "float") -> Column:
    """Prediction of any other model, in Arrow batches.

    `load_model` runs once per task, on the worker, and gives a function from a
    series of inputs to as many predictions; nothing but that loader is shipped. A
    filter on the prediction does not make Catalyst evaluate the model a second time.
    """
    @F.pandas_udf(returns)
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        predict = load_model()
        for batch in batches:
            yield pd.Series(predict(batch))

    return score.asNondeterministic()(column)


def linear_model(weight: float, bias: float) -> Callable[[], Callable]:
    """Loader of a one-input linear model."""
    return lambda: lambda inputs: (inputs * weight + bias).astype("float32")
