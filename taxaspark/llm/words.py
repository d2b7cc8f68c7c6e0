"""Words and word n-grams of Arrow text columns as 64-bit hashes, in whole-array steps.

A word is ``[^\\x20\\x09-\\x0D]+`` over the UTF-8 bytes (all six separators are
ASCII). Hashes are polynomials over a table of random 64-bit values, then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
SEGMENT = 1 << 18  # bytes hashed at once
CHUNK = 1 << 19  # bytes of text that the callers take at once (a longer document is taken alone)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> U(33))
    h *= U(0xFF51AFD7ED558CCD)
    h ^= h >> U(33)
    h *= U(0xC4CEB9FE1A85EC53)
    h ^= h >> U(33)
    return h


def randoms(n: int, seed: int) -> np.ndarray:
    """n fixed 64-bit values (splitmix of a counter)."""
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=U) + U(seed) * U(0x632BE59BD9B4E019)) * U(0x9E3779B97F4A7C15))


def powers(base: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        out = np.full(n + 1, base & (2**64 - 1), dtype=U)
        out[0] = 1
        return np.cumprod(out, dtype=U)


BASE = (0x9E3779B97F4A7C15 & ~7) | 5  # 5 mod 8: its powers differ in a low bit soon
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: separators if a word is a run of ASCII letters, digits and bytes beyond ASCII
IS_MARK = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32


class Hasher:
    """Holds the tables; made once in a task."""

    def __init__(self, lower: bool) -> None:
        table = randoms(256, 1)
        self.table = table[LOWERED] if lower else table
        self.up = powers(BASE, SEGMENT)
        self.down = powers(pow(BASE, -1, 2**64), SEGMENT)

    def words(self, data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = IS_SPACE):
        """(starts, ends, word hashes, first word of each document and the total)."""
        space = separators[data]
        before = np.empty(len(data), dtype=bool)
        after = np.empty(len(data), dtype=bool)
        before[1:], after[:-1] = space[:-1], space[1:]
        full = offsets[:-1] < offsets[1:]
        before[offsets[:-1][full]] = True
        after[offsets[1:][full] - 1] = True
        starts = np.flatnonzero(~space & before)
        ends = np.flatnonzero(~space & after) + 1
        first = np.searchsorted(starts, offsets)
        return starts, ends, self.spans(data, starts, ends), first

    def spans(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A hash of each byte range; the ranges are in order and do not overlap."""
        out = np.empty(len(starts), dtype=U)
        a = 0
        with np.errstate(over="ignore"):
            while a < len(starts):
                b = max(a + 1, int(np.searchsorted(ends, starts[a] + SEGMENT, "right")))
                lo, hi = int(starts[a]), int(ends[b - 1])
                if hi - lo > SEGMENT:  # one very long word
                    up, down = powers(BASE, hi - lo), self.down
                else:
                    up, down = self.up, self.down
                total = np.zeros(hi - lo + 1, dtype=U)
                np.cumsum(self.table[data[lo:hi]] * up[: hi - lo], out=total[1:], dtype=U)
                s, e = starts[a:b] - lo, ends[a:b] - lo
                out[a:b] = mix((total[e] - total[s]) * down[s] + (e - s).astype(U))
                a = b
        return out


def ngrams(h: np.ndarray, n: int, seed: int = 2) -> np.ndarray:
    """The hash of each n consecutive words (across documents too; callers mask those): len(h) - n + 1 values."""
    m = len(h) - n + 1
    if m <= 0:
        return np.empty(0, dtype=U)
    factors = randoms(n, seed) | U(1)
    with np.errstate(over="ignore"):
        out = h[:m] * factors[0]
        for k in range(1, n):
            out += h[k : k + m] * factors[k]
        return mix(out)


def text_chunks(column: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, UTF-8 bytes, offsets) of runs of rows with at most ``limit`` bytes (one row at least). Null: empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("") if column.null_count else column
    if not len(column):
        return
    _, offsets, data = column.buffers()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    off = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(off, off[a] + limit, "right")) - 1)
        b = min(b, len(column))
        yield a, b, raw[off[a] : off[b]], off[a : b + 1] - off[a]
        a = b


def lists(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and the length of each list."""
    offsets = np.zeros(len(sizes) + 1, dtype=np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))


def fixed_binary(rows: np.ndarray) -> pa.Array:
    """A binary column from a matrix of bytes, a value from each line."""
    rows = np.ascontiguousarray(rows)
    n, width = rows.shape
    offsets = np.arange(0, (n + 1) * width, max(width, 1), dtype=np.int32)[: n + 1]
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(rows)])


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Whole groups from sorted batches: a table and the row at which each of its groups begins, with the end as last.

    A group that crosses batches is put together; a table has at least one group.
    """
    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(pa.Table.from_batches([batch]))
        table = pa.concat_tables(held)
        cuts = group_starts(table, keys)
        if len(cuts) == 1:
            held = [table]
            continue
        yield table.slice(0, int(cuts[-1])), cuts
        held = [table.slice(int(cuts[-1]))]
    if held:
        table = pa.concat_tables(held)
        yield table, np.append(group_starts(table, keys), table.num_rows)


def group_starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    change = np.zeros(table.num_rows, dtype=bool)
    change[0] = True
    for k in keys:
        v = table.column(k).to_numpy()
        change[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(change)
