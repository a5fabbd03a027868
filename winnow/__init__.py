"""Refine raw web pages into a clean text corpus, audit it and score it, on Spark."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with the job, so the package needs no
# installation there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
