"""Operators for preparing training text. Nothing else in the library imports this package.

Functions that run in Python workers are sent with their code, so executors need numpy,
pyarrow and the tokenizer libraries, but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
