"""Operators for training-data pipelines, one module each; ``queries`` registers them."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package
