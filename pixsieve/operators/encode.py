"""Encoder stage for texts; images are encoded where they are decoded (``image_features``)."""

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pixsieve.functions import is_rejected, missing
from pixsieve.models import per_worker


def encode_texts(
    df: DataFrame,
    make_encoder: Callable,
    text: str = "image_prompt",
    into: str = "text_embedding",
    batch_size: int = 32,
    when: Column | None = None,
) -> DataFrame:
    """Add the vector of ``text``.

    ``make_encoder()`` returns an object with ``encode_texts(list of str)`` and is called once
    per Python worker; only the text column travels to Python. Rows that are rejected, have no text or
    fail ``when`` get NULL and never reach the encoder.
    """
    model = per_worker(make_encoder)

    @F.pandas_udf("array<double>")
    def encode(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = model()
        for part in parts:
            out = pd.Series([None] * len(part), dtype=object)
            places = np.nonzero(part.notna().to_numpy())[0]
            for start in range(0, len(places), batch_size):
                chosen = places[start:start + batch_size]
                vectors = encoder.encode_texts(part.iloc[chosen].tolist())
                for place, vector in zip(chosen, vectors):
                    out.iloc[place] = np.asarray(vector, dtype=np.float64)
            yield out

    wanted = ~missing(text)
    if "status" in df.columns:
        wanted = wanted & ~is_rejected()
    if when is not None:
        wanted = wanted & when
    return df.withColumn(into, encode.asNondeterministic()(F.when(wanted, F.col(text))))
