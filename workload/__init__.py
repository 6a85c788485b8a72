"""Queries over the driver tables, each beside the SQL that must return the same rows."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

from workload import activity, generic, graphs, ingest, quality, refresh, star, text, vectors  # noqa: F401
from workload.registry import QUERIES

register_pickle_by_value(sys.modules[__name__])

__all__ = ["QUERIES"]
