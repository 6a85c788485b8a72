"""Spark-native entity analytics: landed sources -> star schema -> batch products."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

from keystar.session import build_session, scratch_path

# Batch functions travel to the executors by value, so only the driver needs this package.
register_pickle_by_value(sys.modules[__name__])

__all__ = ["build_session", "scratch_path"]
