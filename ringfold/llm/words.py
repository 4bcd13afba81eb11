"""Words of Arrow text columns as integer codes, for the operators that work in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash


def chunks(batch: pa.RecordBatch, column: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of at most `limit` bytes of text, or one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    at, total = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if total + n > limit and i > at:
            yield batch.slice(at, i - at)
            at, total = i, 0
        total += n
    if at < batch.num_rows:
        yield batch.slice(at)


def coded(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words, the code of each word of all texts in a row, and where each text begins (and the last ends).

    Words are runs of anything but ASCII white space; null has none.
    """
    split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    words = pc.dictionary_encode(split.flatten())
    code = words.indices.to_numpy(zero_copy_only=False)
    count = pc.list_value_length(split).to_numpy(zero_copy_only=False)
    bounds = np.r_[0, np.cumsum(count, dtype=np.int64)]
    if (empty := pc.index(words.dictionary, "").as_py()) >= 0:
        real = code != empty
        bounds = np.r_[0, np.cumsum(real, dtype=np.int64)][bounds]
        code = code[real]
    return words.dictionary, code, bounds


def hashed(words: pa.Array, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each distinct word."""
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(w, seed) for w in words.cast(pa.binary()).to_numpy(zero_copy_only=False)), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values one to one."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


def rolling(values: np.ndarray, width: int, base: int) -> np.ndarray:
    """Polynomial hash (mod 2**64) of every `width` consecutive values, by doubling."""
    power, span, block = np.uint64(base), 1, values
    out, done = None, 0
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    while True:
        if width & span:
            part = block[done : done + n]
            out = part if out is None else out * power + part
            done += span
        span *= 2
        if span > width:
            return out
        block = block[: len(block) - span // 2] * power + block[span // 2 :]
        power = np.uint64(int(power) ** 2 % 2**64)
