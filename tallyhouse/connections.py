"""One limit on the connections that jobs submitted together open to a database."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from threading import Condition


class Connections:
    """``limit`` connections, shared by threads. A thread that asks gets as many as are free, one
    at least, and waits while there is none. Threads ask once for all they use, so none waits
    while it holds some."""

    def __init__(self, limit: int):
        if limit < 1:
            raise ValueError("at least one connection is needed")
        self.limit, self._free, self._changed = limit, limit, Condition()

    @contextmanager
    def take(self, wanted: int) -> Iterator[int]:
        with self._changed:
            self._changed.wait_for(lambda: self._free)
            granted = max(1, min(wanted, self._free))
            self._free -= granted
        try:
            yield granted
        finally:
            with self._changed:
                self._free += granted
                self._changed.notify_all()
