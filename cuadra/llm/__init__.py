"""Operators of a training-data pipeline.

Nothing outside this folder, ``corpus_pipeline.py`` and ``tests/llm`` imports
it.  Task functions are shipped to the Python workers by value, so executors
need no installed copy of the package.
"""

from pyspark import cloudpickle as _cloudpickle

import cuadra.llm as _self

_cloudpickle.register_pickle_by_value(_self)
