"""Spark-native building blocks for a searchable corpus of closed desk tickets.

Sub-packages
------------
functions   Column -> Column helpers (cells, text, dates, redaction, masking)
sources     landed pages, list files, high-water marks
operators   DataFrame -> DataFrame steps (scope, documents, corpus, search ...)
plans       whole jobs (ingest runs) and the registered query catalogue
streaming   the same ingest as a Structured Streaming job
"""

import sys

from pyspark import cloudpickle

# Pandas UDFs carry their helper functions with them, so that workers need no copy of
# this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
