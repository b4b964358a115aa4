"""strata: exploratory analytics and model building on Spark DataFrames.

Sub-packages
------------
sources    readers, writers and generators (CSV, GeoJSON, images, ranges)
functions  column expressions (geo, time, text, vectors, hashing)
operators  DataFrame -> DataFrame verbs (projection, sampling, joins,
           aggregates, windows, pixels, matrices)
models     feature building and ``pyspark.ml`` model flows
plans      derived views on the driver tables and the query catalogue
streaming  Structured Streaming form of the rolling look-back mean
"""

from strata.session import get_session, checkpoint_dir  # noqa: F401

__all__ = ["get_session", "checkpoint_dir"]
