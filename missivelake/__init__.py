"""missivelake: a Spark-first engine for message archives and text corpora."""

__version__ = "0.1.0"
