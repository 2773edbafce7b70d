"""What Python workers keep between tasks.

Spark keeps its Python workers and gives them tasks of any operator.  An operator that
memorises something across tasks says so, and when a task of another operator begins in the
worker, that is let go and freed memory goes back to the system, so a worker holds one
operator's memory at a time.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable

import pyarrow as pa

_held: dict[str, Callable[[], None]] = {}
_settled = False
#: Names of the C library's options, and from how many bytes on an allocation is a mapping of its own that goes back when freed.
M_TRIM_THRESHOLD, M_MMAP_THRESHOLD, MAPPED_BYTES = -1, -3, 1 << 20


def _settle() -> None:
    """Once in a worker: large allocations, Arrow's too, are mappings of their own.

    The C library raises that bound by itself as large blocks are freed, and Arrow's own allocator keeps what
    it had; a worker that lives long then holds the sum of what its operators once needed.
    """
    global _settled
    if _settled:
        return
    _settled = True
    pa.set_memory_pool(pa.system_memory_pool())
    try:
        libc = ctypes.CDLL(None)
        libc.mallopt(M_MMAP_THRESHOLD, MAPPED_BYTES)
        libc.mallopt(M_TRIM_THRESHOLD, MAPPED_BYTES)
    except (AttributeError, OSError):
        pass


def hold(owner: str, drop: Callable[[], None]) -> None:
    """``drop`` lets go of what ``owner`` memorises."""
    _held[owner] = drop


def begin(owner: str) -> None:
    """A task of ``owner`` begins: what others hold is dropped."""
    _settle()
    others = [name for name in _held if name != owner]
    for name in others:
        _held.pop(name)()
    if others:
        trim()


def trim() -> None:
    """Give freed memory back to the system, where its C library can."""
    gc.collect()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass
