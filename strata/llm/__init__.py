"""Training-data operators: scans, classifiers, rules, dedup, decontamination,
packing and archive handling. Nothing else in the library imports this package.

Functions that run inside Python workers are pickled by value, so executors
need no copy of the package on their path.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

from strata.llm.queries import ORACLE, QUERIES  # noqa: E402

__all__ = ["ORACLE", "QUERIES"]
