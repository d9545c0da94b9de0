"""lexikin: look-alike and synonym search over a dictionary table, on Spark."""

import sys

from pyspark import cloudpickle

from lexikin.params import ShapeParams, TrainingParams

# functions that run in Python workers travel with the job, so executors need no install
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["ShapeParams", "TrainingParams"]
