"""What a Python worker holds from task to task: the encoder of one operator at a time.

Spark hands its workers on from stage to stage. What an operator made once for its own tasks would stay in them
and count beside what the next stage needs, so tasks of operators that hold nothing let go of it.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

import pyarrow as pa

_held: dict[tuple, Any] = {}


def held(kind: Callable[[str], Any], path: str) -> Any:
    """This worker's ``kind(path)``, made once; another operator's goes."""
    if (kind, path) not in _held:
        let_go()
        _held[kind, path] = kind(path)
    return _held[kind, path]


def let_go() -> None:
    """Drop what earlier tasks left in this worker, and give unused memory back to the machine."""
    _held.clear()
    pa.default_memory_pool().release_unused()
