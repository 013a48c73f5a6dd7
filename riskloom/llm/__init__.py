"""Training-data operators. Nothing else in the library imports this package.

Functions that run inside Spark tasks are pickled by value, so executors need
only numpy, pyarrow and the tokenizer libraries, not this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
