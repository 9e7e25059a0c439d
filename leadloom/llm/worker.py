"""Objects that live as long as a Python worker, from task to task."""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable, Hashable
from typing import Any

import pyarrow as pa
from pyspark.sql import SparkSession

#: Documents that go to a Python worker at once.
BATCH_ROWS = 500
#: Arrays from this size on go back to the system as soon as they are freed (glibc's M_MMAP_THRESHOLD).
LARGE_BYTES, _MMAP_THRESHOLD = 1 << 20, -3


def small_batches(spark: SparkSession) -> None:
    """Lets Arrow batches of this session hold BATCH_ROWS rows at most: texts are long, and the JVM and its Python
    workers hold a batch several times over outside the heap. Results do not depend on it."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    rows = int(spark.conf.get(name, "10000"))
    if not 0 < rows <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def _held(owner: str) -> dict[Hashable, Any]:
    """What this process holds for the operator ``owner``; what it held for others is dropped."""
    holder = sys.modules.setdefault("_leadloom_kept", types.ModuleType("_leadloom_kept")).__dict__
    if holder.get("owner") != owner:
        holder["owner"], holder["objects"] = owner, {}
    return holder["objects"]


def kept(owner: str, name: Hashable, make: Callable[[], Any]) -> Any:
    """The object of that name in this process, made at first use. It lives until another operator works in this process."""
    objects = _held(owner)
    if name not in objects:
        objects[name] = make()
    return objects[name]


def give_back(owner: str) -> None:
    """Drops what this process holds for other operators, and returns the memory that it has freed to the system. Workers live on between
    tasks and allocators keep what they once had; without this the next stage would start from the largest of all stages before it."""
    _held(owner)
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):  # glibc
        libc.mallopt(_MMAP_THRESHOLD, LARGE_BYTES)
        libc.malloc_trim(0)
