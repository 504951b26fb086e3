"""Python workers live on between tasks; they give the memory of a task back instead of keeping it for the next."""

from __future__ import annotations

import ctypes

import pyarrow as pa

# Names of the C library's settings.
_TRIM_THRESHOLD, _MMAP_THRESHOLD, _ARENA_MAX = -1, -3, -8


def give_back() -> None:
    """Let large arrays, Arrow's too, come from and go to the system directly.  Nothing happens where the C library has no such settings."""
    try:
        library = ctypes.CDLL(None)
        for name, value in ((_MMAP_THRESHOLD, 1 << 18), (_TRIM_THRESHOLD, 1 << 20), (_ARENA_MAX, 1)):
            library.mallopt(name, value)
    except (OSError, AttributeError):
        return
    pa.set_memory_pool(pa.system_memory_pool())


give_back()
