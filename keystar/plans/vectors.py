"""Embedding and neighbour relations of the star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keystar import constants as K
from keystar.operators.embedding import ModelFactory, embed, project_2d
from keystar.operators.neighbors import cosine_topk
from keystar.plans.marts import ANCHOR
from keystar.session import stash


def fact_embedding(
    dim: DataFrame, model_factory: ModelFactory, model_version: str, batch: int = K.EMBED_BATCH
) -> DataFrame:
    """Embedding, 2-D coordinates and truncation flag per protein with a sequence.

    The projection reads the embeddings to fit and again to apply, so they are written once
    and the model runs once per sequence.
    """
    embedded = embed(dim.select(ANCHOR, "sequence"), "sequence", model_factory, batch)
    return assemble_embedding(stash(embedded, "embeddings"), model_version)


def assemble_embedding(embedded: DataFrame, model_version: str) -> DataFrame:
    return project_2d(embedded, "embedding").select(
        ANCHOR,
        "embedding",
        "umap_x",
        "umap_y",
        F.lit(model_version).alias("model_version"),
        "was_truncated",
        F.current_timestamp().alias("computed_at"),
    )


def fact_protein_neighbor(embedding: DataFrame, k: int = K.NEIGHBOR_K) -> DataFrame:
    return cosine_topk(embedding, ANCHOR, "embedding", k).select(
        ANCHOR,
        F.col("neighbor").alias("neighbor_accession"),
        F.col("similarity").cast("float").alias("similarity"),
        "rank",
    )
