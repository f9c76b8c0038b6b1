"""What a Python worker remembers between the tasks that it runs.

A worker is used again for other stages, so what one operator remembers there is dropped as soon as another one runs. Allocators
keep what a task has freed, which on an executor adds up over its workers, so it is given back to the system after each task.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Hashable, Iterator
from functools import cache, wraps
from typing import TypeVar

import pyarrow as pa

T = TypeVar("T")

_held: dict[Hashable, object] = {}


def remembered(key: Hashable, make: Callable[[], T]) -> T:
    """What was made for ``key`` before, or else a new one in place of all that is remembered."""
    if key not in _held:
        forget()
        _held[key] = make()
    return _held[key]


def forget() -> None:
    if _held:
        _held.clear()
        give_back()


@cache
def _trim() -> Callable[[int], int] | None:
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Return free memory to the system."""
    pa.default_memory_pool().release_unused()
    if _trim() is not None:
        _trim()(0)


def frugal(run: Callable[[Iterator[T]], Iterator[T]]) -> Callable[[Iterator[T]], Iterator[T]]:
    """``run``, a function of a task's batches, that gives free memory back when it ends."""

    @wraps(run)
    def wrapped(batches: Iterator[T]) -> Iterator[T]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped
