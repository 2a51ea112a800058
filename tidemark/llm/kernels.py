"""Vectorised text kernels shared by the training-data operators.

Everything here works on one Arrow string array at a time, as UTF-8 bytes in a
single flat buffer, so that a batch costs a fixed number of numpy passes
whatever its number of documents.  Hashes are 64 bits wide: a polynomial over
the bytes (or over the word hashes of a window), finished by a mixing step.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MASK = (1 << 64) - 1
#: Odd multipliers (odd numbers have inverses modulo 2**64).
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD6E8FEB86659FD93
#: Bytes handled at once; a longer document is a chunk of its own.
CHUNK_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every bit depends on every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BYTE_BASE))
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class _Powers:
    """base**i and base**-i modulo 2**64, grown as longer inputs come."""

    def __init__(self, base: int) -> None:
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 1 << 16)
            for name, base in (("up", self.base), ("down", self.inverse)):
                x = np.full(size, base, np.uint64)
                x[0] = 1
                setattr(self, name, np.multiply.accumulate(x))
        return self.up, self.down


_BYTES, _WORDS = _Powers(BYTE_BASE), _Powers(WORD_BASE)


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and the offsets of each (null: empty)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not (pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)):
        texts = texts.cast(pa.large_binary() if pa.types.is_binary(texts.type) else pa.large_string())
    texts = pc.fill_null(texts, b"" if pa.types.is_large_binary(texts.type) else "")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    body = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return (body[at[0] : at[-1]], at - at[0]) if len(at) else (body[:0], np.zeros(1, np.int64))


def _libc_trim():
    try:
        return ctypes.CDLL("libc.so.6").malloc_trim
    except (OSError, AttributeError):  # another C library: nothing to give back by hand
        return lambda _: 0


_TRIM = _libc_trim()


def give_back() -> None:
    """Return freed memory to the system: idle workers stay, and share an executor's memory with those at work."""
    pa.default_memory_pool().release_unused()
    _TRIM(0)


def chunks(batch: pa.RecordBatch, column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about `limit` bytes of text, and of whole rows."""
    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = np.cumsum(sizes) // limit
    cuts = np.flatnonzero(np.diff(part)) + 1
    for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
        yield batch.slice(a, b - a)
    give_back()


class Words:
    """The words `[^ \\t-\\r]+` of a chunk of texts.

    start, end: byte bounds in `body`; doc: row of each word; first: index of
    each row's first word (length rows + 1); hash: 64 bits a word.
    """

    def __init__(self, texts: pa.Array, lower: bool = False) -> None:
        self.body, self.at = flat(texts)
        body = LOWER[self.body] if lower else self.body
        inside = ~IS_SPACE[body]
        edge = np.zeros(len(body) + 1, bool)
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        starts_of_docs = self.at[:-1][self.at[:-1] < self.at[1:]]
        begins[starts_of_docs] = inside[starts_of_docs]
        edge[:-1] = begins
        self.start = np.flatnonzero(edge[:-1])
        # a word ends at the next blank, the end of its document, or the end of all
        stops = ~inside
        stop_at = np.zeros(len(body) + 1, bool)
        stop_at[:-1] = stops
        stop_at[self.at] = True
        where = np.flatnonzero(stop_at)
        self.end = where[np.searchsorted(where, self.start, side="right")] if len(self.start) else self.start
        self.first = np.searchsorted(self.start, self.at)
        self.doc = np.repeat(np.arange(len(self.at) - 1), np.diff(self.first))
        up, down = _BYTES.get(len(body) + 1)
        total = np.zeros(len(body) + 1, np.uint64)
        np.cumsum(BYTE_VALUE[body] * up[: len(body)], out=total[1:])
        length = (self.end - self.start).astype(np.uint64)
        self.hash = mix((total[self.end] - total[self.start]) * down[self.start] + length * np.uint64(WORD_BASE))

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def windows(self, k: int) -> np.ndarray:
        """Hash of the k words from each word on; those that leave their document are to be masked by fits()."""
        n = len(self.hash)
        if n < k:
            return np.zeros(n, np.uint64)
        up, down = _WORDS.get(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(self.hash * up[:n], out=total[1:])
        out = np.zeros(n, np.uint64)
        out[: n - k + 1] = mix((total[k:] - total[: n - k + 1]) * down[: n - k + 1] + np.uint64(k))
        return out

    def fits(self, k: int) -> np.ndarray:
        """Whether the k words from each word on lie in one document."""
        return np.arange(len(self.hash)) + k <= self.first[1:][self.doc]

    def spans(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of words begin..end (exclusive) for each pair of bounds."""
        n = len(self.hash)
        up, down = _WORDS.get(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(self.hash * up[:n], out=total[1:])
        return mix((total[end] - total[begin]) * down[begin] + (end - begin).astype(np.uint64))


def shingles(words: Words, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every k-word shingle; a shorter text is one shingle, an empty one none.  Repeats stay."""
    fit = words.fits(k)
    short = np.flatnonzero((words.counts > 0) & (words.counts < k))
    doc = np.concatenate([words.doc[fit], short])
    value = np.concatenate([words.windows(k)[fit], words.spans(words.first[short], words.first[short + 1])])
    return doc, value


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """min(x[i:i+w]) for each i (the tail takes what is left)."""
    out, have = x.copy(), 1
    while have < w:
        step = min(have, w - have)
        np.minimum(out[:-step], out[step:].copy(), out=out[:-step])
        have += step
    return out


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


class Bloom:
    """A set of 64-bit hashes, two bits a value.  A false hit costs work downstream, never a result."""

    def __init__(self, bits: np.ndarray) -> None:
        self.bits = bits
        self.shift = np.uint64(64 - int(np.log2(len(bits) * 8)))

    def __contains__(self, x):  # pragma: no cover - use has()
        raise TypeError("use has(array)")

    def has(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for p in bloom_positions(x, self.shift):
            out &= (self.bits[p >> 3] >> (p & 7).astype(np.uint8)) & 1 == 1
        return out


def bloom_positions(x: np.ndarray, shift: np.uint64) -> list[np.ndarray]:
    x = np.ascontiguousarray(x).view(np.uint64)
    return [((x * np.uint64(m)) >> shift).astype(np.int64) for m in (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


#: Bits a value of a Bloom filter, and log2 of its least and most bits: 128 KB to 128 MB.
PER_VALUE, LEAST_BITS, MOST_BITS = 24, 20, 30


def bloom_size(values: int) -> int:
    """log2 of the bits of a filter for so many values: a false hit is rarer than 1 in 150 up to 2**30 / 24 values."""
    return min(max((max(values, 1) * PER_VALUE - 1).bit_length(), LEAST_BITS), MOST_BITS)


def bloom(frame, column: str, log2_bits: int | None = None) -> np.ndarray:
    """Bits of a Bloom filter over a LONG column of a written table: 2**log2_bits bits, or bloom_size of its rows.

    Tasks turn values into (64-bit word of the filter, bits), joined by OR on
    both sides of one shuffle; the driver gets at most the filter's words.
    """
    from pyspark.sql import functions as F

    if log2_bits is None:
        log2_bits = bloom_size(frame.count())

    shift = np.uint64(64 - log2_bits)

    def words(batches):
        for b in batches:
            if not b.num_rows:
                continue
            at = np.sort(np.concatenate(bloom_positions(b.column(0).to_numpy(zero_copy_only=False), shift)))
            cut = np.flatnonzero(np.r_[True, (at[1:] >> 6) != (at[:-1] >> 6)])
            bits = np.bitwise_or.reduceat(np.uint64(1) << (at & 63).astype(np.uint64), cut)
            yield pa.record_batch([pa.array(at[cut] >> 6), pa.array(bits.view(np.int64))], ["i", "w"])

    rows = frame.select(column).where(F.col(column).isNotNull()).mapInArrow(words, "i long, w long").groupBy("i").agg(F.bit_or("w").alias("w")).toArrow()
    bits = np.zeros(1 << (log2_bits - 6), np.int64)
    bits[rows["i"].to_numpy()] = rows["w"].to_numpy()
    return bits.view(np.uint8)
