"""Numpy passes over the UTF-8 bytes of a batch of texts.

A batch is worked on in chunks of about ``CHUNK`` bytes, so a task's memory
doesn't depend on how many rows an Arrow batch holds; one longer text is a
chunk of its own. Nulls are empty texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

CHUNK = 1 << 19
MULT = np.uint64(0x9E3779B97F4A7C15)
MIX1 = np.uint64(0xBF58476D1CE4E5B9)
MIX2 = np.uint64(0x94D049BB133111EB)
SPACES = b" \t\n\x0b\x0c\r"
#: Code points of scripts written without spaces: Thai, Lao, Tibetan; Myanmar; Khmer; kana; Han with its extensions.
UNSPACED = ((0xE00, 0xFFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3005, 0x3007), (0x3040, 0x30FF), (0x31F0, 0x31FF),
            (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x20000, 0x3FFFF))


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit scrambling."""
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


def word_table(lower: bool = True, letters: bool = False, digits: bool = False) -> np.ndarray:
    """Byte to byte, 0 where a byte separates words.

    Words are runs of non-space bytes, or with ``letters`` of ASCII letters and
    bytes of multi-byte characters, with ``digits`` also of digits. A zero byte
    counts as byte 255 of a word.
    """
    t = np.arange(256, dtype=np.uint8)
    t[0] = 255
    if letters:
        keep = np.zeros(256, bool)
        keep[65:91] = keep[97:123] = keep[128:] = True
        keep[48:58] = digits
        t[~keep] = 0
    else:
        t[list(SPACES)] = 0
    if lower:
        t[65:91] = np.arange(97, 123)
    return t


def chunks(column, limit: int = CHUNK):
    """Yield ``(first row, last row + 1, bytes, offsets)`` of an Arrow string column."""
    arr = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    arr = arr.cast(pa.large_binary())
    n = len(arr)
    if n == 0:
        return
    offsets = np.frombuffer(arr.buffers()[1], dtype=np.int64, count=n + 1 + arr.offset)[arr.offset:]
    if arr.null_count:
        arr = arr.fill_null(b"")
        offsets = np.frombuffer(arr.buffers()[1], dtype=np.int64, count=n + 1 + arr.offset)[arr.offset:]
    buf = arr.buffers()[2]
    data = np.frombuffer(buf, dtype=np.uint8) if buf is not None and buf.size else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        b = min(b, n)
        yield a, b, data[offsets[a]:offsets[b]], (offsets[a:b + 1] - offsets[a]).astype(np.int64)
        a = b


def lean() -> None:
    """Let freed Arrow memory of a Python worker go back to the machine."""
    pa.set_memory_pool(pa.system_memory_pool())


def slices(batch: pa.RecordBatch, column: int, limit: int = CHUNK):
    """``batch`` in slices of about ``limit`` bytes of one string or binary column."""
    arr = batch.column(column).cast(pa.large_binary())
    n = len(arr)
    if n == 0:
        return
    offsets = np.frombuffer(arr.buffers()[1], dtype=np.int64, count=n + 1 + arr.offset)[arr.offset:]
    a = 0
    while a < n:
        b = min(n, max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1))
        yield batch.slice(a, b - a)
        a = b


_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd multiplier and of its inverse modulo 2**64."""
    have = _POWERS.get("p")
    if have is None or len(have) < n:
        size = max(n, CHUNK + 4096)
        p, q = np.full(size, MULT), np.full(size, np.uint64(pow(int(MULT), -1, 1 << 64)))
        p[0] = q[0] = 1
        p, q = np.cumprod(p, dtype=np.uint64), np.cumprod(q, dtype=np.uint64)
        if size > 8 * CHUNK:  # one very long text: not worth keeping
            return p, q
        _POWERS["p"], _POWERS["q"] = p, q
    return _POWERS["p"], _POWERS["q"]


def unspaced(data: np.ndarray) -> np.ndarray:
    """Places where a character of a script without spaces begins, and where the next one does."""
    at = np.flatnonzero(data >= 0xE0)
    if not len(at):
        return at
    lead, *more = (data[np.minimum(at + k, len(data) - 1)].astype(np.int64) & 63 for k in range(4))
    long = data[at] >= 0xF0
    point = np.where(long, (lead & 7) << 18 | more[0] << 12 | more[1] << 6 | more[2], (lead & 15) << 12 | more[0] << 6 | more[1])
    alone = np.zeros(len(at), bool)
    for low, high in UNSPACED:
        alone |= (point >= low) & (point <= high)
    at, size = at[alone], np.where(long[alone], 4, 3)
    return np.concatenate([at, (at + size)[at + size < len(data)]])


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray, cut: np.ndarray | None = None):
    """Starts and ends of words, a 64-bit hash of each, and each text's first word index.

    ``cut`` has places where a word ends and another begins, as of ``unspaced``.
    """
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    low = table[data]
    inside = low != 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edge = offsets[:-1][(offsets[:-1] < n)]
    first[edge] = inside[edge]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edge = offsets[1:][offsets[1:] > 0] - 1
    last[edge] = inside[edge]
    if cut is not None and len(cut):
        first[cut] = inside[cut]
        last[:-1] |= inside[:-1] & first[1:]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    p, q = powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(low.astype(np.uint64) * p[:n], out=total[1:])
    hashes = mix((total[ends] - total[starts]) * q[starts] + (ends - starts).astype(np.uint64))
    return starts, ends, hashes, np.searchsorted(starts, offsets)


def ngrams(hashes: np.ndarray, first: np.ndarray, n: int):
    """Hashes of the ``n`` words from each word on, and whether they lie in one text.

    ``first`` has each text's first word index, with the end as last entry.
    """
    m = len(hashes)
    out = np.zeros(m, np.uint64)
    if m < n:
        return out, np.zeros(m, bool)
    acc = hashes[: m - n + 1].copy()
    for j in range(1, n):
        acc = acc * MULT + hashes[j: m - n + 1 + j]
    out[: m - n + 1] = mix(acc)
    stop = np.repeat(first[1:], np.diff(first))
    return out, np.arange(m) + n <= stop
