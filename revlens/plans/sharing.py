"""Sharing a frame between actions, for as long as a block of code and no longer."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame


@contextmanager
def shared(*frames: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK, eager: bool = False) -> Iterator[tuple[DataFrame, ...]]:
    """Persist ``frames`` inside a ``with`` block and release them at its end, on success and on failure.

    The first action that reads a frame fills its cache and later ones take it
    from there; ``eager`` fills it on entry. What an executor held is computed
    again where the executor is lost. The handles that were persisted are the
    ones released: a frame derived from them inside the block is not cached, and
    one that was persisted before the block stays so.
    """
    own = [df for df in frames if df.storageLevel == StorageLevel.NONE]
    held: list[DataFrame] = []
    try:
        for df in own:
            held.append(df.persist(level))
        if eager:
            for df in held:
                df.write.format("noop").mode("overwrite").save()
        yield frames
    finally:
        for df in held:
            df.unpersist(blocking=True)
