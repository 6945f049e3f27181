"""Operators for training-data pipelines, with their registered queries.

Nothing else in the library imports this subpackage.  Functions that run on
executors are pickled by value, so a cluster needs no copy of the package on
its workers (numpy, pyarrow and the small libraries named in each module must
be installed there).
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
