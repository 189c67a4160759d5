"""What a Python worker keeps between its tasks."""

from __future__ import annotations

import gc
from collections.abc import Callable, Hashable
from typing import TypeVar

import pyarrow as pa

T = TypeVar("T")
_kept: dict[Hashable, object] = {}


def kept(name: Hashable, make: Callable[[], T]) -> T:
    """What ``make`` gave when this worker last asked for ``name``, made anew if it has asked
    for something else since: a worker that goes from stage to stage holds one thing only."""
    if name not in _kept:
        _kept.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        _kept[name] = make()
    return _kept[name]
