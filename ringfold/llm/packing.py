"""Best-fit packing of documents into token sequences, bulk-synchronous.

Documents are tokenised once into pieces of at most `capacity` ids (the staged table holds lengths and
checksums, not ids). Pieces are packed by classes of length, longest first, in supersteps over the
tables of unplaced pieces and of sequences with a gap:

* Range-sort pieces and gaps together by size, gaps before pieces of their size.
* Successor sweep: read in falling order, a gap opens a bracket and a piece closes one; matching brackets pair
  each piece with the least free gap that holds it. The depth of every row is a distributed prefix sum (counts of
  sizes, then ranks within hash ranges of a size), and rows of one depth alternate, so one more shuffle by depth
  finds the pairs.
* Conflicts: pieces of one size that want gaps of one size take them by rank.
* Update the gaps and repeat while pieces find gaps; what finds none opens new sequences, `capacity // length`
  pieces in each by rank, and the next class follows.

A gap offers a place for each piece of the class that fits it whatever their lengths (64 at most in one superstep).
The driver sees counts alone. No row set is sorted by one task: a size is dealt over RANKED_RANGES hash
ranges, and a depth holds a row for each size at most. The offsets follow from one pass over all
supersteps' pairs at the end.

Edge cases: null text is empty; an empty text is one piece that holds only the end id; null
doc_id packs like any other; repeated rows are packed each; an empty table gives no rows; other
columns are not read; texts of any length are cut into as many pieces as they need.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import documents, map_arrow, release, staged, uncompiled, work_path
from .words import chunks

CAPACITY = 2048
END = 0
TOKENIZER = "word_bpe_49k.json"
RANKED_RANGES = 64
#: A class of lengths reaches from one of these parts of the capacity to the next.
CLASSES = (1, 2, 4, 8, 16, 64, 512)
#: Supersteps of a class end when fewer than this share of its pieces find gaps.
SETTLED = 0.02
MOST_SWEEPS = 12
MOST_PLACES = 64
#: Bytes of text encoded at once, and pieces of plain words and other words whose ids a worker keeps.
CHUNK_BYTES = 4 << 20
CACHE_PIECES = 1 << 19
CACHE_WORDS = 100_000

#: Characters of which a word can be split and merged on its own: no white space, no special
#: token, nothing that normalisation changes but case.
_PLAIN = re.compile(r"[\x21-\x3b\x3d-\x7e\xc0-\xff]+").fullmatch
#: Those without an apostrophe, of one character at least; for Arrow.
_PLAIN_WORD = r"^[\x21-\x26\x28-\x3b\x3d-\x7e\x{c0}-\x{ff}]+$"
#: Kind of each byte of a plain lower-case word; a letter's first byte takes the kind of its second.
_SIGN, _LETTER, _DIGIT, _INNER = range(4)
_KINDS = np.zeros(256, np.uint8)
_KINDS[0x61:0x7B], _KINDS[0x30:0x3A], _KINDS[0x80:0xC0] = _LETTER, _DIGIT, _INNER
# The vocabulary file's own split pattern.
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+").findall


def _byte_letters() -> list[str]:
    """The letter that byte-level vocabularies use for each byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


def _spread(flat: np.ndarray, start: np.ndarray, size: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches of flat that each code stands for, in a row, and where each begins (and the last ends)."""
    count = size[code]
    bounds = np.r_[0, np.cumsum(count, dtype=np.int64)]
    return flat[np.repeat(start[code] - bounds[:-1], count) + np.arange(bounds[-1])], bounds


class PieceIds:
    """Ids of lower-case pieces of words, each distinct piece merged once. Arrow and numpy hold what is known, in about 30 bytes a piece."""

    def __init__(self, merge, most: int) -> None:
        self.merge, self.most, self.letters = merge, most, _byte_letters()
        self.known, self.flat, self.size = pa.array([], pa.string()), np.zeros(0, "<u4"), np.zeros(0, np.int64)
        self.used = np.zeros(0, bool)

    def ids(self, piece: str) -> list[int]:
        return [t.id for t in self.merge(piece if piece.isascii() else "".join([self.letters[b] for b in piece.encode()]))]

    def of(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For distinct pieces: ids, where those of each piece begin, and how many they are."""
        at = pc.fill_null(pc.index_in(pieces, pa.array(self.known)), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        new = np.flatnonzero(at < 0)
        if len(new):
            fresh = pieces.take(pa.array(new))
            lists = [self.ids(p) for p in fresh.to_numpy(zero_copy_only=False)]
            own = np.fromiter(map(len, lists), np.int64, len(lists))
            at[new] = len(self.known) + np.arange(len(new))
            self.known = pa.concat_arrays([self.known, fresh])
            self.flat = np.r_[self.flat, np.fromiter((i for x in lists for i in x), "<u4", int(own.sum()))]
            self.size = np.r_[self.size, own]
            self.used = np.r_[self.used, np.zeros(len(new), bool)]
        self.used[at] = True
        flat, size = self.flat, self.size
        start = np.cumsum(size) - size
        if len(self.known) > self.most:  # what no text has used since the last time goes, or all but this call's
            keep = np.flatnonzero(self.used)
            if len(keep) > self.most // 2:
                keep = at
            self.known, self.flat, self.size = self.known.take(pa.array(keep)), _spread(flat, start, size, keep)[0], size[keep]
            self.used = np.zeros(len(keep), bool)
        return flat, start[at], size[at]


class WordEncoder:
    """Ids of white-space-separated words by a vocabulary file.

    The vocabulary drops white space and never merges across it, so a text's ids are those of
    its words in order. Words of plain characters are cut into the vocabulary's pieces in numpy, all distinct
    words of a chunk at once; others, and those with an apostrophe, are encoded one by one.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.pieces = PieceIds(self.whole.model.tokenize, CACHE_PIECES)
        self.words: dict[str, bytes] = {"": b""}

    def word(self, word: str) -> bytes:
        if (ids := self.words.get(word)) is None:
            if _PLAIN(word):
                ids = np.array([i for p in _PIECES(word.lower()) for i in self.pieces.ids(p)], "<u4").tobytes()
            else:
                ids = np.array(self.whole.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
            if len(self.words) >= CACHE_WORDS:
                self.words = {"": b""}
            self.words[word] = ids
        return ids

    def plain(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain words without apostrophes, and where each word begins (and the last ends)."""
        lower = pa.concat_arrays([pc.utf8_lower(words)])
        ends = np.frombuffer(lower.buffers()[1], np.int32, len(lower) + 1).astype(np.int64)
        text = lower.buffers()[2]
        raw = np.frombuffer(text, np.uint8)[: ends[-1]]
        kind = _KINDS[raw]
        inner = np.flatnonzero(kind == _INNER)  # the second byte of a letter or of a sign (multiplied by, divided by)
        kind[inner] = kind[inner - 1] = np.where((raw[inner] == 0x97) | (raw[inner] == 0xB7), _SIGN, _LETTER)
        cut = np.r_[True, (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)]
        cut[ends[:-1]] = True
        first = np.flatnonzero(cut)
        offsets = np.r_[first, len(raw)].astype(np.int32)
        coded = pc.dictionary_encode(pa.StringArray.from_buffers(len(first), pa.py_buffer(offsets), text))
        ids, at = _spread(*self.pieces.of(coded.dictionary), coded.indices.to_numpy(zero_copy_only=False))
        return ids, at[np.searchsorted(first, ends)]

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text begins (and the last ends)."""
        split = pc.ascii_split_whitespace(texts)
        coded = pc.dictionary_encode(split.flatten())
        plain = pc.match_substring_regex(coded.dictionary, _PLAIN_WORD).to_numpy(zero_copy_only=False).astype(bool)
        size, start = np.zeros(len(plain), np.int64), np.zeros(len(plain), np.int64)
        flat = np.zeros(0, "<u4")
        if plain.any():
            flat, bounds = self.plain(coded.dictionary.filter(pa.array(plain)))
            start[plain], size[plain] = bounds[:-1], np.diff(bounds)
        if not plain.all():
            each = [self.word(w) for w in coded.dictionary.filter(pa.array(~plain)).to_numpy(zero_copy_only=False)]
            size[~plain] = n = np.fromiter(map(len, each), np.int64, len(each)) // 4
            start[~plain] = len(flat) + np.cumsum(n) - n
            flat = np.r_[flat, np.frombuffer(b"".join(each), "<u4")]
        ids, ends = _spread(flat, start, size, coded.indices.to_numpy(zero_copy_only=False))
        words = pc.list_value_length(split).to_numpy(zero_copy_only=False)
        return ids, ends[np.r_[0, np.cumsum(words)]]


_encoders: dict[str, WordEncoder] = {}


def _piecer(path: str | None, capacity: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = path
        if at is None:
            import public_tokenizers

            at = public_tokenizers.path(TOKENIZER)
        encoder = _encoders.setdefault(at, None) or WordEncoder(at)
        _encoders[at] = encoder
        for batch in batches:
            for chunk in chunks(batch, 1, CHUNK_BYTES):
                ids, bounds = encoder.texts(pc.fill_null(chunk.column(1), ""))
                rows: list[tuple[int, int, int, int, int]] = []
                for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                    own = np.append(ids[a:b], np.uint32(END))
                    for k, s in enumerate(range(0, len(own), capacity)):
                        one = own[s : s + capacity]
                        rows.append((i, k, s, len(one), zlib.crc32(one.tobytes())))
                row, *rest = (np.array(x) for x in zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [chunk.column(0).take(pa.array(row)), pa.array(rest[0].astype(np.int32)), *map(pa.array, rest[1:])],
                    ["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return cut


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece. tokenizer: a path that executors can open."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return map_arrow(texts, _piecer(tokenizer, capacity), schema)


def _before(counts: DataFrame, within: list[str], order: list[str], value: str) -> DataFrame:
    """Add `start`: the sum of value over the rows before, by `within` and then `order`."""
    w = (W.partitionBy(*within) if within else W.partitionBy()).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return counts.withColumn("start", F.coalesce(F.sum(value).over(w), F.lit(0)))


def _ranked(rows: DataFrame, sizes: list[str], order: list[str]) -> DataFrame:
    """Add rank, from 1: the place among the rows of equal `sizes`. Each size is dealt over hash ranges."""
    rows = rows.withColumn("range", F.pmod(F.xxhash64("id"), F.lit(RANKED_RANGES)).cast("int"))
    starts = _before(rows.groupBy(*sizes, "range").agg(F.count("*").alias("n")), sizes, ["range"], "n").drop("n")
    own = F.row_number().over(W.partitionBy(*sizes, "range").orderBy(*order))
    return rows.withColumn("own", own).join(starts, [*sizes, "range"]).withColumn("rank", F.col("start") + F.col("own")).drop("start", "own", "range")


def sweep(gaps: DataFrame, active: DataFrame, longest: int, capacity: int) -> DataFrame:
    """One superstep: pieces (id, size) and gaps (id, size) as rows kind, id, size, mate, used.

    kind 1: a piece and the sequence it found; kind 0: a gap's place and the tokens it took.
    """
    places = F.sequence(F.lit(1), F.greatest(F.lit(1), F.least(F.lit(MOST_PLACES), F.floor(F.col("size") / longest).cast("int"))))
    offered = gaps.select(F.lit(0).alias("kind"), "id", "size", F.explode(places).alias("place"))
    rows = offered.union(active.select(F.lit(1), "id", "size", F.lit(0)))
    rows = rows.withColumn("key", ((F.lit(capacity) - F.col("size")) * 2 + F.col("kind")).cast("int"))
    sign = F.when(F.col("kind") == 0, 1).otherwise(-1)
    depths = _before(rows.groupBy("key", "kind").agg(F.sum(sign).alias("n")), [], ["key"], "n").select("key", F.col("start").alias("depth"))
    rows = _ranked(rows, ["key"], ["id", "place"]).join(F.broadcast(depths), "key")  # a row for each size: 2 * capacity at most
    level = F.when(F.col("kind") == 0, F.col("depth") + F.col("rank")).otherwise(F.col("depth") - F.col("rank") + 1)
    by = W.partitionBy("level").orderBy("key")
    paired = rows.withColumn("level", level).select(
        "kind", "id", "size",
        F.when((F.col("kind") == 1) & (F.lag("kind").over(by) == 0), F.lag("id").over(by)).alias("mate"),
        F.when((F.col("kind") == 0) & (F.lead("kind").over(by) == 1), F.lead("size").over(by)).otherwise(0).alias("used"),
    )
    return paired


def opened(active: DataFrame, first: int, capacity: int, whole: bool = False) -> DataFrame:
    """New sequences from id `first` on for all pieces (id, size): kind, id, size, mate, used as in `sweep`.

    whole: only sequences with all their capacity // size pieces; others have no mate.
    """
    rows = active.withColumn("each", F.floor(F.lit(capacity) / F.col("size")).cast("int"))
    counts = rows.groupBy("each", "size").agg(F.count("*").alias("n"))
    after = _before(counts.withColumn("short", -F.col("size")), ["each"], ["short"], "n").select("each", "size", F.col("start").alias("longer"))
    full = counts.groupBy("each").agg((F.floor if whole else F.ceil)(F.sum("n") / F.col("each")).alias("n"))
    full = _before(full, [], ["each"], "n").select("each", F.col("start").alias("base"), "n")
    rows = _ranked(rows, ["each", "size"], ["id"]).join(F.broadcast(after), ["each", "size"]).join(F.broadcast(full), "each")
    nth = F.floor((F.col("longer") + F.col("rank") - 1) / F.col("each"))
    mate = F.when(nth < F.col("n"), F.lit(first) + F.col("base") + nth).cast("long")
    return rows.select(F.lit(1).alias("kind"), "id", "size", mate.alias("mate"), F.lit(0).alias("used"))


def pairs(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame | None:
    """The rows of all supersteps, in which each piece has its sequence (mate) once. cut: id, size of the pieces."""
    bounds = [capacity // k for k in CLASSES if capacity // k] + [0]
    of = F.size(F.filter(F.array(*map(F.lit, bounds[1:-1])), lambda b: F.col("size") <= b)) if len(bounds) > 2 else F.lit(0)
    present = {r["of"]: r["n"] for r in cut.groupBy(of.alias("of")).agg(F.count("*").alias("n")).collect()}
    left = lambda m: m.filter("kind = 1 AND mate IS NULL").select("id", "size")
    rest = lambda m: m.filter("kind = 0").groupBy("id").agg((F.min("size") - F.sum("used")).cast("int").alias("size")).filter("size > 0")
    spark, done, gaps, first = cut.sparkSession, [], None, 0

    root = work_path(spark, "pack-steps")

    def written(step: DataFrame) -> DataFrame:
        done.append(f"{root}/step={len(done)}")
        step.write.parquet(done[-1])
        return spark.read.schema(step.schema).parquet(done[-1])

    def swept(active: DataFrame, gaps: DataFrame, n: int, most: int, hi: int) -> tuple[DataFrame, DataFrame, int]:
        for _ in range(MOST_SWEEPS):
            step = written(sweep(gaps, active, hi, capacity))
            active, gaps = left(step), rest(step)
            was, n = n, active.count()
            if n == 0 or was - n < SETTLED * most:
                break
        return active, gaps, n

    for k in sorted(present):
        release(spark)
        hi, n = bounds[k], present[k]
        active = cut.filter((F.col("size") <= hi) & (F.col("size") > bounds[k + 1])).select("id", "size")
        if gaps is not None:
            active, gaps, n = swept(active, gaps, n, n, hi)
        # no shorter pieces will fill what the last class leaves open: its rest is matched with just enough new sequences
        for whole in (True, False) if k == max(present) else (False,):
            if n == 0:
                break
            step = written(opened(active, first, capacity, whole))
            fresh = step.filter("mate IS NOT NULL").groupBy(F.col("mate").alias("id"))
            fresh = fresh.agg((F.lit(capacity) - F.sum("size")).cast("int").alias("size")).filter("size > 0")
            gaps = fresh if gaps is None else gaps.union(fresh)
            first = max(first, step.agg(F.coalesce(F.max("mate") + 1, F.lit(0))).first()[0])
            active = left(step)
            n, tokens = active.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
            if whole and n:
                new = -(-tokens // capacity)
                gaps = gaps.union(spark.range(first, first + new).select("id", F.lit(capacity).alias("size")))
                first += new
                active, gaps, n = swept(active, gaps, n, n, hi)
    return spark.read.schema(T.StructType([*step.schema.fields, T.StructField("step", T.IntegerType())])).option("basePath", root).parquet(*done) if done else None


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to a table of pieces."""
    cut = staged(cut.withColumn("id", F.monotonically_increasing_id()), "pieces")
    with uncompiled(cut.sparkSession):
        steps = pairs(cut.select("id", F.col("length").cast("int").alias("size")), capacity)
    if steps is None:
        return cut.select(*cut.columns[:-1], F.lit(None).cast("long").alias("sequence_id"), F.lit(None).cast("long").alias("offset"))
    found = steps.filter("kind = 1 AND mate IS NOT NULL").withColumnRenamed("mate", "sequence_id")
    before = W.partitionBy("sequence_id").orderBy("step", "id").rowsBetween(W.unboundedPreceding, -1)
    placed = found.select("id", "sequence_id", F.coalesce(F.sum("size").over(before), F.lit(0)).cast("long").alias("offset"))
    return cut.join(placed, "id").select(*cut.columns[:-1], "sequence_id", "offset")


def best_fit(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece, packed: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(pieces(docs, tokenizer, capacity), capacity)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit(documents(spark, sf_dir))
