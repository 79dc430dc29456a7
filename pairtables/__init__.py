"""Spark jobs that build, fill, split, encode and score instruction-answer tables."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with the job, so that they need not
# have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
