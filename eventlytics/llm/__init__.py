"""Operators for training-data pipelines, and their queries."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the job: workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
