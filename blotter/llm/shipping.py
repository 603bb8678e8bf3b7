"""What Python workers need: the package, and not to sit on freed memory."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import zipfile

import pyarrow as pa
from pyspark.sql import SparkSession

import blotter

_SHIPPED: set[str] = set()
_CACHES: list = []


def on_workers(spark: SparkSession) -> None:
    """Send the package's sources to the executors, once per application, so
    that functions run there can import it."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.abspath(blotter.__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="blotter-sources-"), "blotter-sources.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(top):
            for name in sorted(n for n in names if n.endswith(".py")):
                file = os.path.join(folder, name)
                out.write(file, os.path.relpath(file, os.path.dirname(top)))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def held_until_needed(clear) -> None:
    """``clear()`` empties a cache that a worker keeps from task to task."""
    _CACHES.append(clear)


def give_back_memory() -> None:
    """Empty this worker's caches and return freed memory to the system.
    Workers live on after a task, next to those of the following stage."""
    for clear in _CACHES:
        clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)
