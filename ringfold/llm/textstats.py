"""Per-document statistics of whole texts, computed in Arrow batches with numpy.

Counts of words, characters by class, lines and repetitions. Null text counts as empty.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow
from .words import chunks, coded

CHUNK_BYTES = 2 << 20

#: Byte classes: white space, continuation byte, symbol, upper-case letter, digit, other punctuation, sentence end.
_SPACE, _INNER, _SYMBOL, _UPPER, _DIGIT, _PUNCT, _END = range(1, 8)


def _classes() -> np.ndarray:
    out = np.zeros(256, np.uint8)
    for chars, k in (
        (" \t\n\v\f\r", _SPACE),
        ("#*$%&|<>", _SYMBOL),
        ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", _UPPER),
        ("0123456789", _DIGIT),
        ("\"'(),-/:;=@[\\]^_`{}~+", _PUNCT),
        (".!?", _END),
    ):
        out[list(chars.encode())] = k
    out[0x80:0xC0] = _INNER
    return out


CLASSES = _classes()

#: The columns of a row of statistics, all long.
COLUMNS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_chars", "n_upper", "n_digits", "n_punct",
    "n_ends", "n_exclaims", "n_lines", "n_distinct", "max_word", "n_same_next",
)
SCHEMA = ", ".join(f"{c} long" for c in COLUMNS)


def per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values between bounds; an empty stretch sums to 0."""
    out = np.zeros(len(bounds) - 1, np.int64)
    full = np.flatnonzero(np.diff(bounds) > 0)
    if len(full):
        out[full] = np.add.reduceat(values, bounds[full], dtype=np.int64)
    return out


def repeats(code: np.ndarray, bounds: np.ndarray, n_codes: int, width: int = 3) -> np.ndarray:
    """Per text, the words in windows of `width` words found twice or more in it."""
    n = len(code) - width + 1
    if n <= 0:
        return np.zeros(len(bounds) - 1, np.int64)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    key = code[:n].astype(np.int64)
    for k in range(1, width):
        key, seen = pd.factorize(key * n_codes + code[k : k + n])
    same = doc[:n] == doc[width - 1 :]
    key, _ = pd.factorize(doc[:n][same] * np.int64(len(seen)) + key[same])
    again = np.zeros(n, bool)
    again[same] = np.bincount(key)[key] > 1 if len(key) else False
    inside = np.zeros(len(code), bool)
    for k in range(width):
        inside[k : k + n] |= again
    return per_text(inside, bounds)


def duplicate_lines(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Per text, lines and how many of those with a word equal an earlier line of the text."""
    split = pc.split_pattern(texts, "\n")
    count = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    lines = pc.dictionary_encode(split.flatten())
    word = pc.match_substring_regex(lines.dictionary, r"[^\x20\x09-\x0D]").to_numpy(zero_copy_only=False)
    code = lines.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    doc = np.repeat(np.arange(len(count)), count)
    real = word[code]
    again = pd.Series(doc[real] * len(word) + code[real]).duplicated().to_numpy()
    return count, np.bincount(doc[real][again], minlength=len(count))


def measure(texts: pa.Array) -> dict[str, np.ndarray]:
    texts = pc.fill_null(texts.cast(pa.string()), "")
    texts = pa.concat_arrays([texts])  # own buffers, from offset 0
    words, code, bounds = coded(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4).astype(np.int64)
    raw = np.frombuffer(texts.buffers()[2], np.uint8)[: offsets[-1]] if texts.buffers()[2] and offsets[-1] else np.zeros(0, np.uint8)
    kind = CLASSES[raw]
    count = lambda k: per_text(kind == k, offsets)
    chars = np.diff(offsets) - count(_INNER)
    size = pc.utf8_length(words).to_numpy(zero_copy_only=False)[code] if len(code) else np.zeros(0, np.int32)
    n = len(texts)
    longest = np.zeros(n, np.int64)
    full = np.flatnonzero(np.diff(bounds) > 0)
    if len(full):
        longest[full] = np.maximum.reduceat(size, bounds[full])
    doc = np.repeat(np.arange(n), np.diff(bounds))
    distinct = pd.unique(doc * np.int64(max(1, len(words))) + code) // max(1, len(words))
    next_same = np.zeros(len(code), bool)
    next_same[:-1] = (code[1:] == code[:-1]) & (doc[1:] == doc[:-1])
    lines, dup = duplicate_lines(texts)
    return {
        "n_words": np.diff(bounds),
        "word_chars": per_text(size, bounds),
        "n_symbols": count(_SYMBOL),
        "n_dup_lines": dup,
        "n_repeat_words": repeats(code, bounds, max(1, len(words))),
        "n_chars": chars,
        "n_upper": count(_UPPER),
        "n_digits": count(_DIGIT),
        "n_punct": count(_PUNCT),
        "n_ends": count(_END),
        "n_exclaims": per_text(raw == ord("!"), offsets),
        "n_lines": lines,
        "n_distinct": np.bincount(distinct.astype(np.int64), minlength=n),
        "max_word": longest,
        "n_same_next": per_text(next_same, bounds),
    }


def text_stats(docs: DataFrame, keep: dict[str, str], more: Callable | None = None, more_schema: str = "") -> DataFrame:
    """The columns in keep (name: type) and the statistics of column text, a row per document.

    more: takes the statistics of a chunk, returns further columns by name (types in more_schema).
    """

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch, len(keep), CHUNK_BYTES):
                found = measure(chunk.column(len(keep)))
                added = more(found) if more else {}
                yield pa.RecordBatch.from_arrays(
                    [*chunk.columns[: len(keep)], *[pa.array(found[c], pa.int64()) for c in COLUMNS], *map(pa.array, added.values())],
                    [*keep, *COLUMNS, *added],
                )

    rows = docs.select(*[F.col(c).cast(t).alias(c) for c, t in keep.items()], F.col("text").cast("string").alias("__text"))
    schema = ", ".join([f"{c} {t}" for c, t in keep.items()] + [SCHEMA] + [more_schema] * bool(more_schema))
    return map_arrow(rows, measured, schema)
