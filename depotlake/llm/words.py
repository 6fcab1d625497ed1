"""Words of many texts at once, as 64-bit hashes: numpy over the UTF-8 bytes of an Arrow batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes that separate words: space and 0x09 to 0x0D.
SEPARATORS = np.zeros(256, bool)
SEPARATORS[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_BASE = 0x9E3779B97F4A7C55
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes hashed at once; longer texts are cut between words.
CHUNK = 1 << 20


def release() -> None:
    """Gives back Arrow memory that nothing uses. Workers are used again, and Arrow would keep it for the next task."""
    pa.default_memory_pool().release_unused()


def mix(x: np.ndarray) -> np.ndarray:
    """Scatters 64-bit numbers (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash base and of its inverse, modulo 2**64."""
    size = max(CHUNK + 4096, 1 << (n - 1).bit_length()) if n else CHUNK + 4096
    if size not in _powers:
        if size > CHUNK + 4096:  # a rare long run: not kept
            return _table(size)
        _powers[size] = _table(size)
    return _powers[size]


def _table(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, _INVERSE):
        row = np.full(n, base, np.uint64)
        row[0] = 1
        out.append(np.cumprod(row, dtype=np.uint64))
    return out[0], out[1]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Sums of byte times power of the base before each place; one entry more than data has."""
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the strings from starts to ends."""
    _, down = powers(len(prefix))
    return mix((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def batches(batch: pa.RecordBatch, column: str = "text", size: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """Slices of about size bytes of text, of one row at least. The column becomes binary, null becomes empty."""
    place = batch.schema.get_field_index(column)
    text = batch.column(place).cast(pa.large_binary())
    if text.null_count:
        text = text.fill_null(b"")
    batch = batch.set_column(place, pa.field(column, pa.large_binary()), text)
    offsets = np.frombuffer(text.buffers()[1], np.int64, len(text) + 1, text.offset * 8) if len(text) else np.zeros(1, np.int64)
    start = 0
    while start < len(text):
        end = int(np.searchsorted(offsets, offsets[start] + size, "right")) - 1
        end = min(max(end, start + 1), len(text))
        yield batch.slice(start, end - start)
        start = end


def buffer(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a large_binary column without nulls, and where each row begins in them."""
    if not len(text):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(text.buffers()[1], np.int64, len(text) + 1, text.offset * 8)
    data = text.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and where the words of each row begin among them."""
    if len(data) <= CHUNK:
        return _word_hashes(data, offsets, lower)
    hashes, firsts = [], [np.zeros(1, np.int64)]
    done = 0
    for start, end in zip(offsets[:-1], offsets[1:]):  # a long row: piece by piece
        for begin, stop in _pieces(data, int(start), int(end)):
            found, _ = _word_hashes(data[begin:stop], np.array([0, stop - begin]), lower)
            hashes.append(found)
            done += len(found)
        firsts.append(np.array([done]))
    return np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), np.concatenate(firsts)


def _pieces(data: np.ndarray, start: int, end: int) -> Iterator[tuple[int, int]]:
    while start < end:
        stop = min(start + CHUNK, end)
        while stop < end:
            gaps = np.flatnonzero(SEPARATORS[data[stop : min(stop + CHUNK, end)]])
            stop = min(stop + (int(gaps[0]) if len(gaps) else CHUNK), end)
            if len(gaps):
                break
        yield start, stop
        start = stop


def _word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    starts, ends = runs(~SEPARATORS[data], offsets)
    prefix = prefix_hash(LOWER[data] if lower else data)
    return span_hash(prefix, starts, ends), np.searchsorted(starts, offsets)


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of places that are inside; a run ends where its row does."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    inner = offsets[(offsets > 0) & (offsets < len(inside))]
    first[inner] = inside[inner]
    last[inner - 1] = inside[inner - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def shingles(words: np.ndarray, firsts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of width words within rows, repeats kept, and where each row's begin.

    A row of fewer words has its whole sequence as its only shingle; a row without words has none.
    """
    counts = np.diff(firsts)
    full = np.maximum(counts - width + 1, 0)
    short = (counts > 0) & (counts < width)
    sizes = full + short
    begins = np.concatenate([[0], np.cumsum(sizes)])
    place = np.repeat(firsts[:-1] - begins[:-1], sizes) + np.arange(begins[-1])
    left = np.repeat(firsts[1:], sizes) - place
    out = np.full(len(place), width, np.uint64)
    for k in range(width):
        inside = left > k
        step = words[np.minimum(place + k, max(len(words) - 1, 0))] if len(words) else out
        out = np.where(inside, mix(out * np.uint64(0x9FB21C651E98DF25) + step), out)
    return out, begins
