"""Training-data operators: quality, toxicity, PII, de-duplication, decontamination and packing.

Every operator is a function from the ``documents`` frame (``doc_id``, ``text`` and any
other columns) to a DataFrame.  Nothing else in the library imports this package.
"""

import sys

from pyspark import cloudpickle

# Python functions travel to the executors with their code, so that these need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
