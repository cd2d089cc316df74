"""Semantic search over document corpora, expressed as Spark jobs."""

import sys

from pyspark import cloudpickle

# Executors need no copy of this package: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
