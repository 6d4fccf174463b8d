"""Operators for corpora of text, pages and vectors.

Functions that run in Python workers are sent there by value, so workers need no copy of the
package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
