"""Spark-native cleaning, row-organisation, feature and clustering operators."""

import sys

from pyspark import cloudpickle

# Functions used inside Arrow batches travel with their code, so that executors
# do not need this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
