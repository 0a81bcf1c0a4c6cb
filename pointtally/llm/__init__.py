"""Training-data operators: similarity join, token files, packing,
decontamination, HTML extraction, WARC files, URL filters, quality
classification, preference formatting and document fingerprints.

Nothing else in the library imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# Task functions travel by value: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
