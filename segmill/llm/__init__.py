"""Operators for preparing training data, their registered queries and their SQL.

Nothing outside this folder, ``corpus_pipeline.py`` and ``tests/llm`` imports it. Functions that
run in tasks are sent along with them, so executors need numpy, pandas and pyarrow, but
not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
