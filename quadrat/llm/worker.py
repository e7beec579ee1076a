"""What a Python worker keeps between its tasks."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

_STATE: dict[Any, Any] = {}


def state(key: Any, make: Callable[[], Any]) -> Any:
    """What make() returned for this key.  A worker keeps one such object: asking for another lets the last one go."""
    if key not in _STATE:
        drop_state()
        _STATE[key] = make()
    return _STATE[key]


def drop_state() -> None:
    _STATE.clear()
    give_back()


def give_back() -> None:
    """Give memory that is free to the system: workers are used again, beside others."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # there in glibc
    if trim:
        trim(0)


class Generations:
    """A dictionary, ``now``, that keeps what was used lately, within some bytes.

    When full it becomes the old one, from which what is asked for comes back.  What is larger than
    ``most_entry`` bytes is forgotten at the next turn.
    """

    #: What an entry takes beside its key and its value.
    OVERHEAD = 200

    def __init__(self, most_bytes: int, size_of: Callable[[Any], int] = len, most_entry: int = 4096) -> None:
        self.most, self.size_of, self.most_entry = most_bytes // 2, size_of, most_entry
        self.now: dict = {}
        self.old: dict = {}
        self.large: list = []
        self.size = 0

    def absent(self, keys: set) -> list:
        """Those of keys that neither generation has; all others are in ``now`` then."""
        for k in self.large:
            self.now.pop(k, None)
        self.large.clear()
        if self.size > self.most:
            self.now, self.old, self.size = {}, self.now, 0
        now, old = self.now, self.old
        out = []
        for k in keys.difference(now):
            if k in old:
                v = now[k] = old[k]
                self.size += len(k) + self.size_of(v) + self.OVERHEAD
            else:
                out.append(k)
        return out

    def put(self, key: Any, value: Any) -> None:
        self.now[key] = value
        size = len(key) + self.size_of(value) + self.OVERHEAD
        if size > self.most_entry:
            self.large.append(key)
        else:
            self.size += size
