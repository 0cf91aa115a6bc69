"""Places where a user's own Python runs: per value, per batch, and as a model.

Arrow carries the batches. The functions here only call the user's code and catch its errors.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from notemill import fixed_values as fv

PREDICTION = StructType([StructField("text", StringType()), StructField("error", StringType())])


def per_value(function: Callable, returns: str) -> Callable[[Column], Column]:
    """A function of one value as a column function, for what column expressions cannot say."""
    @F.pandas_udf(returns)
    def apply(values: pd.Series) -> pd.Series:
        return values.map(function)
    return apply


def per_batch(df: DataFrame, function: Callable[[pd.DataFrame], pd.DataFrame], schema: str,
              rows: int = fv.ENCODE_BATCH_ROWS) -> DataFrame:
    """A function of a batch of at most ``rows`` rows; its result replaces all columns."""
    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), rows):
                yield function(frame.iloc[start:start + rows])
    return df.mapInPandas(batches, schema)


def predictions(prompt: Column, make_model: Callable, batch_size: int = 32) -> Column:
    """Struct of text and error from a user's model.

    ``make_model`` is called once per Python worker and returns (sample, greedy): ``sample`` takes a
    list of prompts; when it fails the rows are done one by one with ``greedy``, and a row that fails
    there too gets the error message while the others go on.
    """
    def make_predict():
        sample, greedy = make_model()

        def predict(prompts: np.ndarray):
            try:
                answers = [(text, None) for text in sample(list(prompts))]
            except Exception:  # any error of the user's model means: try the rows one by one
                answers = [_one(greedy, prompt) for prompt in prompts]
            texts, errors = zip(*answers)
            return {"text": np.array(texts, dtype=object), "error": np.array(errors, dtype=object)}
        return predict

    return predict_batch_udf(make_predict, return_type=PREDICTION, batch_size=batch_size)(prompt)


def _one(greedy: Callable, prompt: str) -> tuple[str | None, str | None]:
    try:
        return greedy(prompt), None
    except Exception as error:  # reported in the row
        return None, str(error)
