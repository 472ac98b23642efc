"""Memory of Python workers, which Spark keeps between tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa

Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def release() -> None:
    """Give back what Arrow holds for buffers to come."""
    pa.default_memory_pool().release_unused()


def lean(run: Run) -> Run:
    """``run``, with the buffers of past batches given back before each next one and at the end.

    Else a worker that waits for its next task keeps those of the largest batches it has had, and an executor has one for each core.
    """

    def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch
                del batch
                release()

        try:
            yield from run(each())
        finally:
            release()

    return released
