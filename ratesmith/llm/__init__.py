"""Operators of a training-data pipeline over tables of documents.

One module per operator; ``queries`` registers them, ``kernels`` holds the array
helpers that run inside Spark tasks and ``graph`` the distributed connected components.
Nothing outside this package imports it.
"""

import sys

from pyspark import cloudpickle

# Task functions travel with the job, so executors need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
