"""Operators of a training-data pipeline (one module each) and their registered queries."""

import sys

from pyspark import cloudpickle

# Task functions travel with the plan, so executors need this package neither installed nor on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
