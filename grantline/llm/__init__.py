"""Operations of a training-data pipeline: selection, sharding, deduplication, scoring and encoding of text."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with the job: they need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
