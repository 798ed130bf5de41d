"""Training-data operators: search, joins, classifiers, extraction, formats, packing and mixing.

Each module holds one operator with a general interface; ``queries`` derives
the registered query results from them. Nothing outside this subpackage
imports it, except the guarded registration in ``__spark_entry__``.
"""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors with the tasks: nothing has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
