"""Feature building and model flows on ``pyspark.ml``."""
