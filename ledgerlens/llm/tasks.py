"""Sending this package's batch functions to Python workers.

A task function lives in an operator module and is looked up there by name on
the worker.  The small closure that does the lookup is pickled by value, so a
worker that was started elsewhere (another working directory) first learns
where the package lies; on a cluster the package is shipped with ``--py-files``
or installed, as usual.
"""

from __future__ import annotations

import os
import sys

from pyspark import cloudpickle

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def map_task(func, **params):
    """``func(batches, **params)`` as a function for ``mapInArrow``."""
    module, name, root = func.__module__, func.__name__, _ROOT

    def run(batches):
        import importlib
        import sys

        if root not in sys.path:
            sys.path.append(root)
        return getattr(importlib.import_module(module), name)(batches, **params)

    return run


def group_task(func, **params):
    """``func(key, table, **params)`` as a function for a grouped ``applyInArrow``."""
    module, name, root = func.__module__, func.__name__, _ROOT

    def run(key, table):
        import importlib
        import sys

        if root not in sys.path:
            sys.path.append(root)
        return getattr(importlib.import_module(module), name)(key, table, **params)

    return run


def cogroup_task(func, **params):
    """``func(key, left, right, **params)`` for a cogrouped ``applyInArrow``."""
    module, name, root = func.__module__, func.__name__, _ROOT

    def run(key, left, right):
        import importlib
        import sys

        if root not in sys.path:
            sys.path.append(root)
        return getattr(importlib.import_module(module), name)(key, left, right, **params)

    return run


cloudpickle.register_pickle_by_value(sys.modules[__name__])
