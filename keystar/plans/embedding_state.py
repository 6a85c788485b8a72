"""Embeddings that are kept from run to run: the model sees only what it has not seen."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keystar import constants as K
from keystar.operators.embedding import ModelFactory, embed
from keystar.plans.marts import ANCHOR
from keystar.session import stash

STATE = T.StructType(
    [
        T.StructField(ANCHOR, T.StringType()),
        T.StructField("sequence_digest", T.StringType()),
        T.StructField("model_version", T.StringType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("was_truncated", T.BooleanType()),
    ]
)


def _digested(dim: DataFrame) -> DataFrame:
    rows = dim.where(F.col(ANCHOR).isNotNull() & F.col("sequence").isNotNull())
    return rows.select(ANCHOR, "sequence", F.sha2("sequence", 256).alias("sequence_digest"))


def classify_sequences(dim: DataFrame, state: DataFrame, model_version: str) -> DataFrame:
    """(anchor, sequence_digest, status) of every anchor on either side.

    ``new``: not in the state; ``gone``: in the state, but without a sequence now; ``changed``:
    another sequence or another version of the model; ``same``: neither. Digests and versions
    alone are compared; no sequence or vector moves.
    """
    now = _digested(dim).select(ANCHOR, "sequence_digest")
    before = state.select(
        ANCHOR,
        F.col("sequence_digest").alias("_digest"),
        F.col("model_version").alias("_version"),
    )
    same = (F.col("sequence_digest") == F.col("_digest")) & (F.col("_version") == model_version)
    status = (
        F.when(F.col("_digest").isNull(), "new")
        .when(F.col("sequence_digest").isNull(), "gone")
        .when(same, "same")
        .otherwise("changed")
    )
    return now.join(before, ANCHOR, "full").select(
        ANCHOR, "sequence_digest", status.alias("status")
    )


def unseen_texts(dim: DataFrame, state: DataFrame, model_version: str) -> DataFrame:
    """(sequence_digest, sequence): each text the model has to see, once.

    A text that the state has under any anchor, from the same version, is not among them.
    """
    seen = state.where(F.col("model_version") == model_version).select("sequence_digest")
    texts = _digested(dim).select("sequence_digest", "sequence")
    return texts.join(seen, "sequence_digest", "left_anti").dropDuplicates(["sequence_digest"])


def refresh_embeddings(
    dim: DataFrame,
    state: DataFrame,
    model_factory: ModelFactory,
    model_version: str,
    batch: int = K.EMBED_BATCH,
) -> DataFrame:
    """The state of all sequences of ``dim`` after a run of the model over the unseen texts.

    The vectors of equal texts are equal, so they are joined by digest: kept ones, and those of
    the texts that were sent, which are written once before anything reads them. Anchors that
    are gone are not in the new state. Without a state every distinct text is sent.
    """
    unseen = unseen_texts(dim, state, model_version)
    cores = dim.sparkSession.sparkContext.defaultParallelism
    sent = embed(unseen.repartition(cores, "sequence_digest"), "sequence", model_factory, batch)
    made = stash(sent.select("sequence_digest", "embedding", "was_truncated"), "embeddings")
    kept = (
        state.where(F.col("model_version") == model_version)
        .select("sequence_digest", "embedding", "was_truncated")
        .dropDuplicates(["sequence_digest"])
    )
    known = kept.unionByName(made)
    return (
        _digested(dim)
        .drop("sequence")
        .join(known, "sequence_digest")
        .select(
            ANCHOR,
            "sequence_digest",
            F.lit(model_version).alias("model_version"),
            "embedding",
            "was_truncated",
        )
    )


def as_embedding(state: DataFrame) -> DataFrame:
    """(anchor, embedding, was_truncated), from which the embedding fact is assembled."""
    return state.select(ANCHOR, "embedding", "was_truncated")
