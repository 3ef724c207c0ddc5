"""How this package declares its Arrow UDFs, and what its tasks do about memory."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T


def task_udf(return_type: T.DataType) -> Callable:
    """An Arrow UDF the optimizer evaluates exactly where it is written.

    Declared nondeterministic on purpose: otherwise a filter on something derived
    from the result (also one Spark infers itself, such as ``size(links) > 0``
    below an explode) is pushed through it by copying the call, which runs it
    twice, and cannot run at all once copied into a lambda.
    """

    def declare(function: Callable) -> Callable:
        return F.arrow_udf(function, return_type).asNondeterministic()

    return declare


def give_back() -> None:
    """Return freed memory to the system.

    A Python worker outlives its tasks and waits for more beside stages that need none; what
    its allocators keep for later is counted as the executor's until then.
    """
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):      # glibc has it
        ctypes.CDLL(None).malloc_trim(0)
