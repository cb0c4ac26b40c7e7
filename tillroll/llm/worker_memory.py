"""One long-lived memory per Python worker.

Workers are reused between the tasks of different operators.  What one operator keeps
between its tasks (codes of words it has seen) is dropped when another begins, and given
back at once, so that a worker holds the largest of these memories, not their sum."""

from __future__ import annotations

import gc
from collections.abc import Callable

import pyarrow as pa

_owner: str | None = None
_drop: Callable[[], None] | None = None


def claim(owner: str, drop: Callable[[], None] | None = None) -> None:
    """Say that ``owner`` works in this process now; ``drop`` empties its memory, if it keeps
    one.  Operators that keep none claim, too: else the last one's stays while they run."""
    global _owner, _drop
    if owner != _owner:
        if _drop is not None:
            _drop()
            gc.collect()  # coders and their memories refer to each other
        pa.default_memory_pool().release_unused()
        _owner, _drop = owner, drop
