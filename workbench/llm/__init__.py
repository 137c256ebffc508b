"""Operators of a training-data pipeline: deduplication, decontamination, quality,
tokenising, language-model scores and personal data.

Nothing else in the library imports this subpackage. Functions that run in Python
workers are pickled by value, so executors need the public packages only, not this one.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
