"""Training-data operators: ten self-contained operators over document tables.

Nothing outside this subpackage imports it.  Functions that run on executors are
pickled by value, so executors need no copy of the repository.
"""

from pyspark import cloudpickle

import lodestar.llm as _own

cloudpickle.register_pickle_by_value(_own)
