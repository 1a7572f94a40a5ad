"""What a Python worker remembers from one task to the next."""

from __future__ import annotations

import gc
import sys
from collections.abc import Callable, Hashable, Iterable, Iterator
from contextlib import contextmanager
from types import ModuleType
from typing import TypeVar

T = TypeVar("T")
K = TypeVar("K")
V = TypeVar("V")


def remembered(key: Hashable, make: Callable[[], T]) -> T:
    """``make()``, once for each key in this process.

    Tasks may get functions by value, with globals of their own, so the values are kept in
    a module that belongs to the process.
    """
    module = sys.modules.setdefault("_kinrank_worker", ModuleType("_kinrank_worker"))
    values = module.__dict__.setdefault("values", {})
    if key not in values:
        values[key] = make()
    return values[key]


def slices(values: Iterable[str], size: int) -> Iterator[list[str]]:
    """Consecutive texts of about ``size`` characters together, or one longer text."""
    some, held = [], 0
    for value in values:
        some.append(value)
        held += len(value)
        if held >= size:
            yield some
            some, held = [], 0
    if some:
        yield some


@contextmanager
def without_collection() -> Iterator[None]:
    """No search for reference cycles while very many small objects, none in a cycle, are made."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


class Lately(dict[K, V]):
    """What was met of late. When there is more than ``most``, what has not been met again since the
    last time is forgotten; so the frequent stays, and at most about twice as much is held."""

    def __init__(self, most: int):
        super().__init__()
        self.most = most
        self.before: dict[K, V] = {}

    def missing(self, keys: set[K]) -> set[K]:
        """The keys whose values are not known; all others can be looked up until the next call."""
        if len(self) > self.most:
            self.before = dict(self)
            self.clear()
        new = keys - self.keys()
        again = new & self.before.keys()
        self.update((k, self.before[k]) for k in again)
        return new - again
