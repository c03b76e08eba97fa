"""Operators for building training corpora.

Functions of this subpackage that run in Python workers are shipped with the job, so
executors need numpy, pyarrow and the tokenizer libraries, but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
