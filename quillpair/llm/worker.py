"""What a Python worker keeps from task to task."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable
from typing import Any

_NAME = "_quillpair_worker"


def kept(key: Any, make: Callable[[], Any], large: bool = False) -> Any:
    """The worker's one object for key, made at first use.

    The package's functions travel to the workers by value, so module globals are made anew for each task; what is
    costly to build lives in a module of the worker itself. Of large objects only the last one asked for stays, so a
    worker that serves several operators in turn holds one store and not all of them.
    """
    store = sys.modules.setdefault(_NAME, types.ModuleType(_NAME)).__dict__
    if large and store.get("_large") != key:
        store.pop(store.pop("_large", None), None)
        store["_large"] = key
    if key not in store:
        store[key] = make()
    return store[key]
