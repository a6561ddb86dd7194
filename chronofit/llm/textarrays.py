"""Texts as NumPy arrays inside tasks: words and shingles of whole texts as 64-bit hashes.

A chunk is a run of rows with up to ``CHUNK_BYTES`` of UTF-8 text (or one longer row),
so a task holds a few arrays of that length whatever the batch.  Strings are hashed by
random tables and a polynomial over 64 bits, then mixed; equal strings hash equally on
every executor.
"""

from __future__ import annotations

import ctypes
import inspect
import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES, CHUNK_ROWS = 1 << 19, 512
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_TABLE = np.random.default_rng(71).integers(1, 1 << 64, 256, dtype=np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Odd multipliers for the words of a shingle.
_PLACES = np.random.default_rng(72).integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


_trimmed = [0.0]


def release_memory() -> None:
    """Give freed memory back to the system, at most once a second.

    A Python worker serves many tasks; what one of them has freed would otherwise stay
    with the process and add up with its neighbours' on the executor.
    """
    now = time.monotonic()
    if now - _trimmed[0] >= 1.0:
        _trimmed[0] = now
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)


#: What modules keep in a worker between tasks, by module: cleared when another module's work begins.
_kept: dict[str, dict] = {}


def kept_between_tasks(module: str) -> dict:
    """A cache of a module in this worker, emptied as soon as another operator's task runs here."""
    return _kept.setdefault(module, {})


def _only(module: str) -> None:
    stale = [cache for name, cache in _kept.items() if name != module and cache]
    for cache in stale:
        cache.clear()
    if stale:
        _trimmed[0] = 0.0
        release_memory()


def releasing(run: Callable) -> Callable:
    """An Arrow map function that releases memory after each batch, and before it what other operators kept."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch
            del batch
            release_memory()

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _only(run.__module__)
        yield from run(each(batches))
        _trimmed[0] = 0.0
        release_memory()
    return wrapped


def releasing_groups(run: Callable) -> Callable:
    """A grouped or cogrouped Arrow function that releases memory after each group."""
    if len(inspect.signature(run).parameters) == 1:
        def one(table: pa.Table) -> pa.Table:
            _only(run.__module__)
            out = run(table)
            release_memory()
            return out
        return one

    def two(left: pa.Table, right: pa.Table) -> pa.Table:
        _only(run.__module__)
        out = run(left, right)
        release_memory()
        return out
    return two


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(kind: str, n: int) -> np.ndarray:
    have = _powers[kind]
    if len(have) < n:
        base = _BASE if kind == "up" else _BASE_INVERSE
        steps = np.full(max(n, CHUNK_BYTES + 1), base, np.uint64)
        steps[0] = 1
        have = _powers[kind] = np.multiply.accumulate(steps)
    return have[:n]


def chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, bytes, offsets)`` per chunk of a string or binary column; null counts as empty."""
    for lo in range(0, len(column), CHUNK_ROWS):  # a batch's texts are not copied as a whole
        for first, end, data, offsets in _chunks(column.slice(lo, CHUNK_ROWS), size):
            yield lo + first, lo + end, data, offsets


def _chunks(column: pa.Array, size: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    binary = pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type)
    values = column.cast(pa.large_binary()).fill_null(b"") if binary else column.cast(pa.large_string()).fill_null("")
    n = len(values)
    _, offsets, data = values.buffers()
    offsets = np.frombuffer(offsets, np.int64)[values.offset: values.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        yield first, end, data[offsets[first]:offsets[end]], offsets[first:end + 1] - offsets[first]
        first = end


def prefix_hash(data: np.ndarray, table: np.ndarray = _TABLE) -> np.ndarray:
    """Prefix sums for :func:`span_hash`; one longer than ``data``."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * _power("up", len(data)), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the byte spans; equal contents hash equally wherever they stand."""
    down = _power("down", len(prefix))
    return mix64((prefix[ends] - prefix[starts]) * down[starts])


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words and the row of each; words never cross rows."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~_IS_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    after = np.empty_like(inside)
    after[-1], after[:-1] = False, inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


_LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def distinct_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One span of each kind, and the kind of every span; spans are of one kind if their bytes are equal.

    Up to 15 bytes and the length fit in two numbers; longer spans are numbered by a table.
    """
    size = ends - starts
    raw = data.tobytes()
    eight = np.ndarray((len(raw) + 9,), "<u8", raw + bytes(16), strides=(1,))
    short = np.minimum(size, 15)
    first = eight[starts] & _LOW_BYTES[np.minimum(short, 8)]
    second = eight[np.minimum(starts + 8, len(raw))] & _LOW_BYTES[np.maximum(short, 8) - 8] | short.astype(np.uint64) << np.uint64(56)
    number: dict[bytes, int] = {}
    long = np.flatnonzero(size > 15)
    if len(long):
        first[long] = [number.setdefault(raw[x:y], len(number)) for x, y in zip(starts[long].tolist(), ends[long].tolist())]
        second[long] = np.uint64(255) << np.uint64(56)
    _, one, kind = np.unique(mix64(mix64(first) ^ second * _BASE), return_index=True, return_inverse=True)
    if (first[one][kind] != first).any() or (second[one][kind] != second).any():  # two kinds share a hash
        _, one, kind = np.unique(np.stack([first, second]), axis=1, return_index=True, return_inverse=True)
    return one, kind.ravel()


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every word of a chunk (A-Z lower-cased first if asked)."""
    starts, ends, rows = word_spans(data, offsets)
    prefix = prefix_hash(_LOWER[data] if lower else data)
    return span_hash(prefix, starts, ends), rows


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int, lower: bool = True) -> list[np.ndarray]:
    """Sorted distinct hashes of the ``k``-word shingles per row.

    A row with fewer words has its whole word sequence as its one shingle; a row without
    words has none.
    """
    hashes, rows = word_hashes(data, offsets, lower)
    n = len(offsets) - 1
    counts = np.bincount(rows, minlength=n)
    ends = np.cumsum(counts)
    combined = np.zeros(max(0, len(hashes) - k + 1), np.uint64)
    for j in range(k):
        combined += hashes[j:len(hashes) - k + 1 + j] * _PLACES[j]
    combined = mix64(combined)
    out = []
    for count, end in zip(counts.tolist(), ends.tolist()):
        if count >= k:
            out.append(np.unique(combined[end - count:end - k + 1]))
        elif count:
            short = (hashes[end - count:end] * _PLACES[:count]).sum(dtype=np.uint64) + np.uint64(count)
            out.append(mix64(np.array([short], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
