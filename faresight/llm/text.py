"""Words of texts as numpy arrays, shared by the operators that scan whole documents.

A word is a run of characters other than space and U+0009..U+000D. In UTF-8 those separators are single
bytes that occur in no other character, so words are found on the encoded bytes of many texts at once.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

SPACES = b" \t\n\x0b\x0c\r"
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True
_BLOCK = 1 << 20                              # bytes hashed at a time
_ODD = 0x9E3779B97F4A7C15 | 1                 # base of the polynomial; odd, so it has an inverse mod 2^64
_tables: dict[str, np.ndarray] = {}
_LONG_BLOCK = 8 << 20                         # powers beyond it (for a single very long word) are not kept
_held: dict[str, list] = {"by": [""], "kept": []}


def kept(forget: Callable[[], None]) -> None:
    """Name what empties the tables that a module keeps in its worker."""
    _held["kept"].append(forget)


def take_over(name: str) -> None:
    """A worker serves one operator after the other. The first task of another one drops what the one before has kept, and gives the memory back."""
    if _held["by"][0] != name:
        _held["by"][0] = name
        for forget in _held["kept"]:
            forget()
        gc.collect()
        give_back()


def give_back() -> None:
    """Return freed memory to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def held_by(name: str, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for mapInArrow, in a worker that holds nothing of other operators when it begins and no spare memory when it ends."""
    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_over(name)
        yield from run(batches)
        give_back()
    return alone


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (xor-shift-multiply): spreads every input bit over the word."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def slices(batch: pa.RecordBatch, column: str, limit: int = 2 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of ``batch`` whose texts hold about ``limit`` bytes together (one longer text stands alone)."""
    sizes = batch.column(column).cast(pa.large_string()).to_numpy(zero_copy_only=False)
    lo, held = 0, 0
    for i, t in enumerate(sizes):
        n = 0 if t is None else len(t)
        if held and held + n > limit:
            yield lo, i
            lo, held = i, 0
        held += n
    if lo < len(sizes):
        yield lo, len(sizes)


def join_texts(texts: list[str | None], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one byte array with a space after each, and where each begins (one more than texts)."""
    parts = [b"" if t is None else t.encode() for t in texts]
    at = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) + 1 for p in parts], out=at[1:])
    data = b" ".join(parts) + b" "
    return np.frombuffer(data.lower() if lower else data, np.uint8), at


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of every word of ``data``."""
    inside = np.empty(len(data) + 2, bool)
    inside[0] = inside[-1] = False
    np.logical_not(_IS_SPACE[data], out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if "byte" not in _tables:
        _tables["byte"] = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    if len(_tables.get("up", ())) < n:
        for name, base in (("up", _ODD), ("down", pow(_ODD, -1, 1 << 64))):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            _tables[name] = np.multiply.accumulate(p)
    powers = _tables["byte"], _tables["up"], _tables["down"]
    if n > _LONG_BLOCK:
        _tables.clear()
    return powers


kept(_tables.clear)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of every word: a polynomial in a fixed odd base, finalised.

    The prefix sums of a block of bytes give all its words at once. Blocks are cut between words, so
    memory does not grow with the text.
    """
    out = np.empty(len(starts), np.uint64)
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + _BLOCK, "right")))
        a, b = int(starts[lo]), int(ends[hi - 1])
        byte, up, down = _powers(max(_BLOCK, b - a))
        sums = np.zeros(b - a + 1, np.uint64)
        np.cumsum(byte[data[a:b]] * up[: b - a], out=sums[1:])
        s, e = starts[lo:hi] - a, ends[lo:hi] - a
        out[lo:hi] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        lo = hi
    return out


def words_of(texts: list[str | None], lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, word begins, word ends, and for every text the index of its first word (one more than texts)."""
    data, at = join_texts(texts, lower)
    starts, ends = word_spans(data)
    return data, starts, ends, np.searchsorted(starts, at)
