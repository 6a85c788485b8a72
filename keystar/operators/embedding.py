"""Batch model inference over text and a 2-D projection of the vectors."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.ml.feature import PCA, Normalizer
from pyspark.ml.functions import array_to_vector, predict_batch_udf, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keystar import constants as K
from keystar.functions.texts import truncated
from keystar.functions.vectors import has_direction

# A factory runs once per Python worker and returns the batch function:
# texts -> float32 matrix with one row per text.
ModelFactory = Callable[[], Callable[[np.ndarray], np.ndarray]]


def embed(
    df: DataFrame,
    text: str,
    model_factory: ModelFactory,
    batch: int = K.EMBED_BATCH,
    limit: int = K.MAX_SEQUENCE,
) -> DataFrame:
    """Adds ``embedding`` and ``was_truncated``; rows without text are left out.

    Texts longer than the model window are cut to it and flagged.
    """
    clipped, flag = truncated(F.col(text), limit)
    predict = predict_batch_udf(
        model_factory, return_type=T.ArrayType(T.FloatType()), batch_size=batch
    )
    return df.where(F.col(text).isNotNull()).select(
        "*", predict(clipped).alias("embedding"), flag.alias("was_truncated")
    )


def masked_mean(hidden: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Mean over the unmasked tokens: (batch, tokens, dim) and (batch, tokens) -> (batch, dim)."""
    weights = mask[:, :, None].astype(np.float32)
    totals = (hidden.astype(np.float32) * weights).sum(axis=1)
    return totals / np.maximum(weights.sum(axis=1), 1.0)


def project_2d(df: DataFrame, vector: str, x: str = "umap_x", y: str = "umap_y") -> DataFrame:
    """Adds two float coordinates: the first two principal axes of the unit vectors.

    The fit aggregates one dim x dim matrix, so its size depends on the vector width only.
    Each axis points to where its largest weight is positive. Rows without a direction keep
    NULL coordinates.
    """
    placed = F.coalesce(has_direction(F.col(vector)), F.lit(False))
    ready = df.where(placed).withColumn(
        "_vector", array_to_vector(F.col(vector).cast("array<double>"))
    )
    nowhere = F.lit(None).cast("float")
    if ready.isEmpty():
        return df.select("*", nowhere.alias(x), nowhere.alias(y))
    ready = Normalizer(inputCol="_vector", outputCol="_unit", p=2.0).transform(ready)
    model = PCA(k=2, inputCol="_unit", outputCol="_axes").fit(ready)
    weights = model.pc.toArray()
    flips = [1.0 if w[np.abs(w).argmax()] >= 0 else -1.0 for w in weights.T]
    axes = vector_to_array(F.col("_axes"))
    return (
        model.transform(ready)
        .select(
            *df.columns,
            (F.get(axes, F.lit(0)) * flips[0]).cast("float").alias(x),
            (F.get(axes, F.lit(1)) * flips[1]).cast("float").alias(y),
        )
        .unionByName(df.where(~placed).select("*", nowhere.alias(x), nowhere.alias(y)))
    )
