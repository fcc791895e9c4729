"""Operators for large training corpora: quality, dedup, formatting, archives, tokens,
toxicity, packing, similarity joins and vector search.

Nothing outside this package imports it; :mod:`vitrail.llm.queries` registers its
queries.  Functions that run in Python workers are pickled by value, so executors need
not have this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
