"""Words, hashes and sets of whole texts as numpy arrays, for use inside Arrow functions.

A word is a run of characters other than space and U+0009 to U+000D. All of these are single bytes in UTF-8, so the bytes are
scanned without decoding. Work goes in pieces of bounded size, however long one text is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
PIECE_BYTES = 1 << 20
SLICE_BYTES = 2 << 20
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits all depend on all input bits."""
    x = x.astype(U, copy=True)
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x ^= x >> U(shift)
        x *= U(factor)
    x ^= x >> U(33)
    return x


def constants(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit constants by rule."""
    return mix(np.arange(1, n + 1, dtype=U) * U(_BASE) + U(seed)) | U(1)


BYTE_VALUES = constants(256, 17)
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        n = max(n, PIECE_BYTES + 4096)
        _powers[:] = [np.cumprod(np.array([1] + [b] * (n - 1), U), dtype=U) for b in (_BASE, _INVERSE)]
    return _powers[0], _powers[1]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column (null: empty) and the n + 1 offsets of its texts in them."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    if column.null_count:
        column = pc.fill_null(column, "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in runs whose texts have about `size` bytes, one row at least."""
    lengths = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), np.int64)
    at, total = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if total and total + n > size:
            yield batch.slice(at, i - at)
            at, total = i, 0
        total += n
    if at < len(lengths):
        yield batch.slice(at)


def _cuts(data: np.ndarray, bounds: np.ndarray, separators: np.ndarray) -> list[int]:
    """Places that no word crosses, about a piece apart."""
    at, found = 0, [0]
    while at < len(data):
        end = min(at + PIECE_BYTES, len(data))
        if end < len(data):
            k = int(np.searchsorted(bounds, end, "right")) - 1
            blanks = np.flatnonzero(separators[data[max(at + 1, end - 4096) : end]])
            if len(blanks):
                end = max(at + 1, end - 4096) + int(blanks[-1])
            elif bounds[k] > at:
                end = int(bounds[k])
            else:
                while end < len(data) and end < bounds[k + 1]:
                    blanks = np.flatnonzero(separators[data[end : end + 65536]])
                    if len(blanks):
                        end += int(blanks[0])
                        break
                    end += 65536
                end = int(min(end, bounds[k + 1]))
        found.append(end)
        at = end
    return found


def hash_words(data: np.ndarray, offsets: np.ndarray, lower: bool = False, separators: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash for each word of the texts, in order, and the n + 1 offsets of the texts in them."""
    table = BYTE_VALUES[LOWER] if lower else BYTE_VALUES
    hashes, begins = [np.zeros(0, U)], [np.zeros(0, np.int64)]
    cuts = _cuts(data, offsets, separators)
    for a, b in zip(cuts, cuts[1:], strict=False):
        piece = data[a:b]
        inside = ~separators[piece]
        edge = np.zeros(len(piece) + 1, bool)
        inner = offsets[np.searchsorted(offsets, a) : np.searchsorted(offsets, b, "right")] - a
        edge[inner] = True
        edge[0] = edge[-1] = True
        first = inside & edge[:-1]
        first[1:] |= inside[1:] & ~inside[:-1]
        last = inside & edge[1:]
        last[:-1] |= inside[:-1] & ~inside[1:]
        start, end = np.flatnonzero(first), np.flatnonzero(last)
        power, inverse = powers(len(piece))
        terms = table[piece]
        terms *= power[: len(piece)]
        total = np.cumsum(terms, dtype=U)
        hashes.append(mix((total[end] - total[start] + terms[start]) * inverse[start] + (end - start + 1).astype(U)))
        begins.append(start + a)
    begin = np.concatenate(begins)
    return np.concatenate(hashes), np.searchsorted(begin, offsets).astype(np.int64)


def rolling(hashes: np.ndarray, n: int) -> np.ndarray:
    """The hash of each run of n consecutive values, at the run's start; n - 1 fewer values than given."""
    if len(hashes) < n:
        return np.zeros(0, U)
    total = None
    for i, factor in enumerate(constants(n, 101 + n)):
        part = hashes[i : len(hashes) - n + 1 + i] * factor
        total = part if total is None else np.add(total, part, out=total)
    return mix(total)


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def member(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which values are in the sorted array `among`."""
    if not len(among):
        return np.zeros(len(values), bool)
    at = np.searchsorted(among, values)
    at[at == len(among)] = 0
    return among[at] == values
