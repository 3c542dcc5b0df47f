"""Operators of a training-data pipeline over documents, pages and embeddings."""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel with their code, so that these need no copy of
# the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
