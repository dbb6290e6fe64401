"""Operators of a training-data pipeline: text, tokens, URLs and archive records.

Functions of this subpackage travel to the Python workers by value, so executors
need numpy, pyarrow, xxhash, regex and tokenizers, but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
