"""Operators of a training-data pipeline over documents, conversations and
embeddings. Nothing outside this package imports it.

Functions that run inside Python workers are shipped by value, so executors
need numpy, pyarrow and the tokenizer libraries but not this package."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
