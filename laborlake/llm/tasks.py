"""Shipping task-side Python (mapInPandas / applyInPandas helpers) to executors.

Modules holding functions that run inside tasks are pickled by value, so
executors need no installed copy of this package.
"""

from __future__ import annotations

from types import ModuleType

from pyspark import cloudpickle


def ship_by_value(module: ModuleType) -> None:
    cloudpickle.register_pickle_by_value(module)
