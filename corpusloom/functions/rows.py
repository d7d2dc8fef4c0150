"""Functions of rows in Arrow UDFs: a batch stays in Arrow, and only a few of its rows at a time are Python objects."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable
from typing import Any

import pyarrow as pa

#: Rows that are Python objects at once.
FEW = 128


def given_back() -> None:
    """Gives memory that the worker no longer uses back, as it outlives its tasks."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library than glibc has no such call
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def of_each(use: Callable[..., Any], kind: pa.DataType, *columns: pa.Array) -> pa.Array:
    """What ``use`` makes of each row of columns of one length."""
    parts = [pa.array([use(*row) for row in zip(*[c.slice(i, FEW).to_pylist() for c in columns], strict=True)], kind) for i in range(0, len(columns[0]), FEW)]
    given_back()
    return pa.concat_arrays(parts) if parts else pa.array([], kind)
