"""Operators that prepare training text: packing, deduplication, fingerprints, scans, language and token output.

Nothing else in the package imports this subpackage. Its functions travel to executors as code, so executors need
the third-party libraries but not this package.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
