"""A bounded store of results by key."""

from __future__ import annotations

from typing import Any


# Longest key that is kept. Longer ones are rare words, parts without spaces and the like:
# they seldom come again, and a store of them would be bounded in number but not in bytes.
LONGEST_KEY = 64


def _length(key: Any) -> int:
    if isinstance(key, tuple):
        return sum(map(_length, key))
    return len(key) if isinstance(key, str) else 1


class Memo:
    """Keeps up to twice `limit` results; keys are texts, or tuples of texts, of up to
    LONGEST_KEY characters, others are not kept; what was not asked for during the last `limit` additions goes first.
    None stands for a result that is not there."""

    def __init__(self, limit: int) -> None:
        self._limit = limit
        self._new: dict[Any, Any] = {}
        self._old: dict[Any, Any] = {}

    def get(self, key: Any) -> Any:
        found = self._new.get(key)
        if found is None:
            found = self._old.get(key)
            if found is not None:
                self._keep(key, found)
        return found

    def put(self, key: Any, value: Any) -> None:
        if (len(key) if type(key) is str else _length(key)) <= LONGEST_KEY:
            self._keep(key, value)

    def _keep(self, key: Any, value: Any) -> None:
        if len(self._new) >= self._limit:
            self._old, self._new = self._new, {}
        self._new[key] = value
