"""Memory that a task took goes back to the machine when the task ends.

Python workers live on from stage to stage, and a stage may leave several of them idle. What the allocators of numpy and
Arrow keep for later would add up over the stages of a pipeline.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import pyarrow as pa


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def tidy(task: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function over a partition's batches that gives its memory back at the end."""
    @functools.wraps(task)
    def run(frames):
        try:
            yield from task(frames)
        finally:
            give_back()

    return run


def tidy_group(task: Callable) -> Callable:
    """The same for a function over a group."""
    def run(table):
        try:
            return task(table)
        finally:
            give_back()

    return run


def tidy_pair(task: Callable) -> Callable:
    """The same for a function over two groups that meet."""
    def run(left, right):
        try:
            return task(left, right)
        finally:
            give_back()

    return run
