"""Models and tables that stay in a Python worker.

Functions of this package travel to the workers by value, so a module variable would be a new one
in every task. What is to last lives in a module of its own that only exists in the process.
"""

import functools
import hashlib
import sys
import types
from collections.abc import Callable
from typing import Any

from pyspark import cloudpickle


def _kept() -> dict:
    name = "pixsieve_kept_in_process"
    return sys.modules.setdefault(name, types.ModuleType(name)).__dict__


def per_worker(make: Callable[[], Any]) -> Callable[[], Any]:
    """A function for tasks that returns the model of ``make``, made once per worker process.

    Spark keeps Python workers for later tasks and micro-batches. Models are told apart by the
    pickled factory, so the same factory is also shared between jobs.
    """
    key = hashlib.sha256(cloudpickle.dumps(make)).hexdigest()

    def get() -> Any:
        kept = _kept()
        if key not in kept:
            kept[key] = make()
        return kept[key]

    return get


def cached(function: Callable) -> Callable:
    """Keeps what ``function`` returned for its arguments, once per process, driver or worker."""
    name = f"{function.__module__}.{function.__qualname__}"

    @functools.wraps(function)
    def get(*args):
        kept, key = _kept(), (name, args)
        if key not in kept:
            kept[key] = function(*args)
        return kept[key]

    return get
