"""Sorted runs of numbers, compressed with zstd, and their k-way merge.

A run is a list of rows of 64-bit numbers, ascending by the first one, the key. It is
stored in chunks and read back chunk by chunk, so a merge holds one chunk of each run.
"""

from __future__ import annotations

import heapq
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import zstandard

CHUNK = 1 << 13
Columns = tuple[np.ndarray, ...]


def write_run(parts: Iterable[Columns]) -> bytes:
    """A run of the ``parts``' rows; their keys, the first column, go up from part to part."""
    out = []
    for columns in parts:
        for at in range(0, len(columns[0]), CHUNK):
            chunk = [np.asarray(c[at:at + CHUNK], "<i8") for c in columns]
            chunk[0] = np.diff(chunk[0], prepend=0)
            out.append(struct.pack("<I", len(chunk[0])))
            # Bytes of one place together: most numbers are small, and zeros cost nothing.
            out += [np.ascontiguousarray(c.view(np.uint8).reshape(-1, 8).T).tobytes() for c in chunk]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def read_run(run: bytes, columns: int) -> Iterator[Columns]:
    """The chunks of a run with so many ``columns``."""
    with zstandard.ZstdDecompressor().stream_reader(run) as source:
        while head := source.read(4):
            n = struct.unpack("<I", head)[0]
            data = np.frombuffer(source.read(8 * n * columns), np.uint8).reshape(columns, 8, n)
            found = [np.ascontiguousarray(c.T).view("<i8").ravel() for c in data]
            yield np.cumsum(found[0]), *found[1:]


def whole_run(run: bytes, columns: int) -> Columns:
    """All rows of a run at once."""
    parts = list(read_run(run, columns))
    return tuple(np.concatenate([p[i] for p in parts]) if parts else np.empty(0, np.int64)
                 for i in range(columns))


def merged(runs: list[bytes]) -> Iterator[Columns]:
    """(keys, sums) of runs of two columns: each key once, in order, with its numbers added up.

    A heap holds the last key of each run's open chunk. Up to the least of them every
    run's rows are in memory, so these rows are added up and given out, and the runs whose
    chunks are used up go on to their next ones.
    """
    sources = [read_run(r, 2) for r in runs]
    open_: dict[int, Columns] = {}
    heap: list[tuple[int, int]] = []

    def load(i: int) -> None:
        chunk = next(sources[i], None)
        if chunk is None:
            open_.pop(i, None)
        else:
            open_[i] = chunk
            heapq.heappush(heap, (int(chunk[0][-1]), i))

    for i in range(len(runs)):
        load(i)
    while heap:
        limit = heap[0][0]
        taken = []
        for i, (keys, counts) in open_.items():
            n = int(np.searchsorted(keys, limit, "right"))
            if n:
                taken.append((keys[:n], counts[:n]))
                open_[i] = keys[n:], counts[n:]
        while heap and heap[0][0] == limit:
            load(heapq.heappop(heap)[1])
        keys, place = np.unique(np.concatenate([k for k, _ in taken]), return_inverse=True)
        sums = np.zeros(len(keys), np.int64)
        np.add.at(sums, place, np.concatenate([c for _, c in taken]))
        yield keys, sums
