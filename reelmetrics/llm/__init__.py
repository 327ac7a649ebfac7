"""Operators for training-data pipelines, one module each; nothing else in the library uses them.

Python tasks get the functions of this package by value, so workers need no installed copy.
"""

from pyspark import cloudpickle

import reelmetrics

cloudpickle.register_pickle_by_value(reelmetrics)
