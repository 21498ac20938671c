"""What a Python worker remembers between texts, bounded in bytes.

Workers live longer than tasks and serve one operator after the other, so each cache here has a bound that holds for good.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterable

import pyarrow as pa

#: Rows with whole texts that go to a Python worker at once.
TEXT_ROWS = 1024


def give_back() -> None:
    """At the end of a partition: return to the system what the worker holds but does not use."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim is not None:
        trim(0)


class Generations:
    """A table whose missing entries are made many at a time; it keeps those used lately, in two halves of `limit` bytes.

    When the young half is full it becomes the old one, and what the old one held and nobody has asked for since is forgotten.
    `known` always has the keys that `learn` was called with last, whatever the limit.
    """

    def __init__(self, limit: int):
        self.known: dict = {}
        self.old: dict = {}
        self.limit, self.held = limit, 0

    def make(self, keys: list[str]) -> dict:
        """The keys with their values."""
        raise NotImplementedError

    def weigh(self, entries: dict) -> int:
        """About how many bytes the entries take."""
        raise NotImplementedError

    def learn(self, keys: Iterable[str]) -> None:
        """See that `known` has all of these."""
        if self.held > self.limit // 2:
            self.old, self.known, self.held = self.known, {}, 0
        new = set(keys).difference(self.known)
        made = new.difference(self.old)
        if len(made) < len(new):
            again = {k: self.old[k] for k in new.difference(made)}
            self.known.update(again)
            self.held += self.weigh(again)
        if made:
            fresh = self.make(list(made))
            self.known.update(fresh)
            self.held += self.weigh(fresh)
