"""Training-data operators: dedup, filters, archives, tokenization, personal data.

Nothing else in the library imports this subpackage.  Its modules are pickled
by value into Python workers, so executors need only numpy and pyarrow.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
