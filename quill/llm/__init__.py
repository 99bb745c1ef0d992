"""Operators of a training-data pipeline: scans, deduplication, decontamination,
packing, quality rules and scoring. Nothing else in the library imports this
subpackage; ``queries.py`` holds the registered queries."""

import sys

from pyspark import cloudpickle

# tasks carry the operators' code with them: executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
