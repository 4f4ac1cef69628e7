"""Column expressions and the few UDFs; functions that run on executors are pickled by value."""

from pyspark import cloudpickle

import lodestar.functions as _own

cloudpickle.register_pickle_by_value(_own)
