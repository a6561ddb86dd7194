"""Steps that are run once, also if several threads of the driver ask for them."""

from __future__ import annotations

import threading

_GUARD = threading.Lock()


class once:
    """``functools.cached_property`` whose first caller computes the value while the others wait for it."""

    def __init__(self, fn):
        self.fn, self.__doc__ = fn, fn.__doc__

    def __set_name__(self, owner, name):
        self.name = name

    def __get__(self, held, owner=None):
        if held is None:
            return self
        with _GUARD:
            lock = held.__dict__.setdefault(f"_{self.name}_lock", threading.RLock())
        with lock:
            if self.name not in held.__dict__:
                held.__dict__[self.name] = self.fn(held)
            return held.__dict__[self.name]
