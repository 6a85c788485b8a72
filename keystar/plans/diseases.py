"""Therapeutic areas: the topmost terms above each term of the disease ontology."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keystar.operators.graph import reached_from
from keystar.sources.readers import read_parts


def read_disease_terms(spark: SparkSession, path: str) -> DataFrame:
    """(efo_id, parents) from the landed disease parts."""
    parts = read_parts(spark, path, ["id", "parents"])
    return parts.select(F.col("id").alias("efo_id"), F.col("parents").cast("array<string>"))


def parent_links(terms: DataFrame) -> DataFrame:
    """(child, parent) of terms ``efo_id, parents``; parents outside the ontology are left out."""
    links = terms.select(F.col("efo_id").alias("child"), F.explode("parents").alias("parent"))
    known = terms.select(F.col("efo_id").alias("parent")).distinct()
    return links.where("child <> parent").join(known, "parent", "left_semi")


def disease_areas(terms: DataFrame) -> DataFrame:
    """(efo_id, area_id, distance): all topmost terms above each term; a topmost term is its own.

    A term is topmost if none of its parents is known. Terms that only have cycles above them
    have no area.
    """
    links = parent_links(terms)
    below = links.select(F.col("child").alias("root")).distinct()
    roots = terms.select(F.col("efo_id").alias("root")).join(below, "root", "left_anti")
    return reached_from(links, roots).select(
        F.col("node").alias("efo_id"), F.col("root").alias("area_id"), "distance"
    )


def nearest_area(areas: DataFrame, names: DataFrame) -> DataFrame:
    """(efo_id, therapeutic_area): the name of the nearest area, ties by its id.

    An area without a name in ``names`` (efo_id, disease_name) is named by its id.
    """
    nearest = areas.groupBy("efo_id").agg(
        F.min(F.struct("distance", "area_id"))["area_id"].alias("area_id")
    )
    named = names.select(F.col("efo_id").alias("area_id"), F.col("disease_name").alias("_name"))
    return nearest.join(named, "area_id", "left").select(
        "efo_id", F.coalesce("_name", "area_id").alias("therapeutic_area")
    )
