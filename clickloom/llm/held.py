"""Tables that a Python worker keeps between its tasks, for one kind of work at a time.

Spark hands a worker from one stage to the next. A table that a later stage has no use for would
stay beside that stage's own, so it goes when a task of another kind begins.
"""

from __future__ import annotations

from collections.abc import Callable, Hashable
from typing import Any

_kept: dict[Hashable, Any] = {}
_kind: list[str] = [""]


def only(kind: str) -> None:
    """Drop what other kinds of work left behind."""
    if _kind[0] != kind:
        _kept.clear()
        _kind[0] = kind


def keep(kind: str, key: Hashable, make: Callable[[], Any]) -> Any:
    """What `make` returned for this kind and key, made anew if it was dropped."""
    only(kind)
    if key not in _kept:
        _kept[key] = make()
    return _kept[key]
