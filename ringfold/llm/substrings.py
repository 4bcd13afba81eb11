"""Removal of repeated passages, by repeated-phrase automata.

1. 8-word phrases are sampled by their hash alone (so equal passages sample equal phrases) and
   counted over the corpus; the repeated ones set bits in a bitmap. Runs of 35-word windows all of
   whose sampled phrases are in the bitmap are the segments that may repeat.
2. Confirm: the windows of the segments are counted over the corpus by a 96-bit hash (combined in
   the task and on the map side before the shuffle), with one place of each. The places of windows
   seen twice or more, one place a window, are cut into the confirmed passages.
3. Compile: each window has an anchor, the phrase of least hash in it, which is the same wherever
   the window stands. A shard holds the passages of its anchors and compiles these phrases into an
   Aho-Corasick automaton over spelled word codes.
4. Locate: the segments of all documents, cut where the anchor changes, stream through the automaton
   of their anchor's shard. Only windows around a hit are compared with the passages' windows; what
   they cover is removed from the documents. No place but the automata's hits leads to a removal.

A shard whose segments are many (an anchor that a third of all documents hold) is dealt over several
tasks, each with the shard's automaton. The shards' number follows the segments' words.

The bitmap filters and never decides: false hits cost only rows in step 2. Its bits follow the number of
repeated phrases up to MOST_BITS (128 MB); beyond that more segments are carried, with the same result.

Edge cases: null or empty text has no words and hashes the empty string; documents of under
35 words lose nothing; repeated rows are occurrences of their own; null doc_id is kept as such;
an empty table gives no rows; other columns are not read. Rows are told apart by 128 bits of hash
of doc_id and text; rows equal in both lose the same words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, map_arrow, release, staged
from .words import chunks, coded, hashed, mixed, rolling

WIDTH = 35
PHRASE = 8
#: One phrase of so many is sampled.
SAMPLED = 7
#: log2 of the bits of the bitmap: at least, at most, and over that of the repeated phrases.
LEAST_BITS, MOST_BITS, SPARE_BITS = 20, 30, 5
CHUNK_BYTES = 6 << 20
SHARD_WORDS = 1_000_000
#: Windows of a segment at most; longer runs are cut.
LONG = 4096
#: Shards' task counts are broadcast up to so many (16 bytes each); beyond it they are joined by a shuffle.
BROADCAST_SHARDS = 100_000
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_BUCKET = 32768


def _left(bounds: np.ndarray) -> np.ndarray:
    """Words from each word to the end of its text, itself included."""
    return np.repeat(bounds[1:], np.diff(bounds)) - np.arange(bounds[-1])


def _phrases(h: np.ndarray, left: np.ndarray, width: int, phrase: int, sampled: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the phrase at each word, and whether it is sampled."""
    g = np.zeros(len(h), np.uint64)
    rolled = mixed(rolling(h, phrase, BASES[0]))
    g[: len(rolled)] = rolled
    return g, (g < np.uint64(2**64 // sampled)) & (left >= phrase)


def _phrase_counter(width: int, phrase: int, sampled: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch, 0, CHUNK_BYTES):
                words, code, bounds = coded(chunk.column(0))
                size = np.diff(bounds)
                g, picked = _phrases(hashed(words)[code], _left(bounds), width, phrase, sampled)
                picked &= np.repeat(size >= width, size)
                found, n = np.unique(g[picked], return_counts=True)
                keys = pa.concat_arrays([pa.array(found.view(np.int64)), pa.nulls(1, pa.int64())])
                yield pa.RecordBatch.from_arrays([keys, pa.array(np.r_[np.minimum(n, 2), bounds[-1]].astype(np.int64))], ["phrase", "n"])

    return count


def _in_bitmap(bitmap: np.ndarray, g: np.ndarray, bits: int) -> np.ndarray:
    x = (g >> np.uint64(64 - bits)).astype(np.int64)
    return (bitmap[x >> 3] >> (x & 7).astype(np.uint8)) & 1 == 1


def _least(g: np.ndarray, span: int) -> np.ndarray:
    """Least of every `span` consecutive values, by doubling."""
    done, block = 1, g
    while 2 * done <= span:
        block = np.minimum(block[: len(block) - done], block[done:])
        done *= 2
    rest = span - done
    return np.minimum(block[: len(block) - rest], block[rest:]) if rest else block


def _segmenter(bitmap_of, width: int, phrase: int, sampled: int, bits: int):
    """Rows (r1, r2, at, text, anchors, cuts): runs of windows that may repeat; windows from cuts[i] on have anchors[i]."""
    names = ["r1", "r2", "at", "text", "anchors", "cuts"]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.frombuffer(bitmap_of.value, np.uint8)
        for batch in batches:
            for chunk in chunks(batch, 2, CHUNK_BYTES):
                words, code, bounds = coded(chunk.column(2))
                if bounds[-1] < width:
                    continue
                h, left = hashed(words)[code], _left(bounds)
                g, picked = _phrases(h, left, width, phrase, sampled)
                lone = np.zeros(len(h), bool)
                lone[picked] = ~_in_bitmap(bitmap, g[picked], bits)
                seen = np.r_[0, np.cumsum(lone)]
                n, span = len(h) - width + 1, width - phrase + 1
                at = np.flatnonzero((left[:n] >= width) & (seen[span : span + n] == seen[:n]))
                if not len(at):
                    continue
                doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[at]
                starts, lengths = _runs(doc, at)
                within = np.arange(len(at)) - np.repeat(starts, lengths)
                starts = np.flatnonzero(within % LONG == 0)
                lengths = np.diff(np.r_[starts, len(at)])
                anchor = _least(g[: len(h) - phrase + 1], span)[at]
                new = np.flatnonzero((within % LONG == 0) | np.r_[True, anchor[1:] != anchor[:-1]])
                own = np.searchsorted(starts, new, side="right") - 1
                lists = np.r_[np.searchsorted(new, starts), len(new)].astype(np.int32)
                spelled = words.cast(pa.binary()).to_pylist()
                texts = [
                    b" ".join([spelled[c] for c in code[a : a + k + width - 1].tolist()]) for a, k in zip(at[starts].tolist(), lengths.tolist())
                ]
                row = pa.array(doc[starts])
                yield pa.RecordBatch.from_arrays(
                    [
                        chunk.column(0).take(row), chunk.column(1).take(row), pa.array((at[starts] - bounds[doc[starts]]).astype(np.int64)),
                        pa.array(texts, pa.binary()).cast(pa.string()), pa.ListArray.from_arrays(pa.array(lists), pa.array(anchor[new].view(np.int64))),
                        pa.ListArray.from_arrays(pa.array(lists), pa.array((at[new] - at[starts[own]]).astype(np.int32))),
                    ],
                    names,
                )

    return find


def _windows(h: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of the window at each word where one fits into the array."""
    return rolling(h, width, BASES[0]), mixed(rolling(mixed(h ^ np.uint64(BASES[1])), width, BASES[1])) >> np.uint64(33)


def _runs(doc: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index and length of each run of consecutive places in a document."""
    starts = np.flatnonzero(np.r_[True, (np.diff(at) != 1) | (np.diff(doc) != 0)]) if len(at) else np.zeros(0, np.int64)
    return starts, np.diff(np.r_[starts, len(at)])


def _window_counter(width: int):
    """Rows (h1, h2, n, place) of segments (row, text): each window of a batch once, with its count and the place row * LONG + at."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch, 1, CHUNK_BYTES):
                words, code, bounds = coded(chunk.column(1))
                at = np.flatnonzero(_left(bounds) >= width)
                h1, h2 = (x[at] for x in _windows(hashed(words)[code], width))
                order = np.argsort(h1)
                h1, h2 = h1[order], h2[order]
                new = np.flatnonzero(np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]) if len(at) else at
                at = at[order[new]]
                doc = np.searchsorted(bounds, at, side="right") - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(h1[new].view(np.int64)), pa.array(h2[new].astype(np.int32)), pa.array(np.diff(np.r_[new, len(h1)])),
                        pa.array(chunk.column(0).to_numpy()[doc] * LONG + at - bounds[doc]),
                    ],
                    ["h1", "h2", "n", "place"],
                )

    return count


def _cutter(width: int):
    """Rows (anchor, known, r1, r2, at, text) of segments with the places `ats` of confirmed windows: the stretches of one
    anchor, and (known) the passages of the windows at ats."""
    names = ["anchor", "known", "r1", "r2", "at", "text"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            r1, r2, at, texts, anchors, cuts, ats = (batch.column(k) for k in range(7))
            for i in range(batch.num_rows):
                text = texts[i].as_py().encode()
                space = np.flatnonzero(np.frombuffer(text, np.uint8) == 32)
                begin, end = np.r_[0, space + 1], np.r_[space, len(text)]
                own, first = anchors[i].values.to_numpy(), cuts[i].values.to_numpy()
                place, last = at[i].as_py(), np.r_[first[1:], len(begin) - width + 1]
                key = (r1[i].as_py(), r2[i].as_py())
                for a, x, y in zip(own.tolist(), first.tolist(), last.tolist()):
                    rows.append((a, False, *key, place + x, text[begin[x] : end[y + width - 2]]))
                if ats[i].is_valid:
                    w = np.sort(ats[i].values.to_numpy())
                    piece = np.searchsorted(first, w, side="right") - 1
                    starts, lengths = _runs(piece, w)
                    for x, k, a in zip(w[starts].tolist(), lengths.tolist(), own[piece[starts]].tolist()):
                        rows.append((a, True, *key, place + x, text[begin[x] : end[x + k + width - 2]]))
            kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            cols = [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 6, kinds)]
            yield pa.RecordBatch.from_arrays([*cols[:5], cols[5].cast(pa.string())], names)

    return cut


def locate(code: np.ndarray, bounds: np.ndarray, h: np.ndarray, known: int, anchors: np.ndarray, width: int, phrase: int) -> np.ndarray:
    """Starts, in ascending order, of the windows of the texts after the first `known` that equal a window of these.

    anchors: for each of the first texts, the hash of a phrase that all its windows hold. These phrases are compiled
    into the automaton; the windows around its hits are compared.
    """
    import ahocorasick

    split = bounds[known]
    g = mixed(rolling(h[:split], phrase, BASES[0]))
    want = np.repeat(anchors.view(np.uint64), np.diff(bounds[: known + 1]))[: len(g)]
    hold = np.flatnonzero((g == want) & (_left(bounds[: known + 1])[: len(g)] >= phrase))
    starts = hold[np.unique(g[hold], return_index=True)[1]]
    text, span = _spelled(code, starts[:, None] + np.arange(phrase), int(code.max()) + 1)
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for p in starts.tolist():
        automaton.add_word(text[p * span : (p + phrase) * span], 1)
    automaton.make_automaton()
    first, left = np.repeat(bounds[:-1], np.diff(bounds)), _left(bounds)
    ends = np.fromiter((end for end, _ in automaton.iter(text, int(split) * span)), np.int64) // span
    hit = ends - phrase + 1
    hit = hit[first[hit] == first[ends]]  # not across two texts
    near = np.zeros(len(code) + 1, np.int64)
    np.add.at(near, np.maximum(hit - (width - phrase), first[hit]), 1)
    np.add.at(near, hit + 1, -1)
    at = np.flatnonzero((np.cumsum(near[:-1]) > 0) & (left >= width))
    h1, h2 = _windows(h, width)
    both = (h1 << np.uint64(1)) ^ (h2 << np.uint64(34)) ^ (h1 >> np.uint64(63))
    wanted = np.unique(both[np.flatnonzero(left[: min(split, len(both))] >= width)])
    place = np.minimum(np.searchsorted(wanted, both[at]), len(wanted) - 1)
    return at[wanted[place] == both[at]]


def _finder(width: int, phrase: int):
    """Places (r1, r2, at, length) of a shard's passages in its segments."""

    def find(rows: pa.Table) -> pa.Table:
        known = rows.column("known").to_numpy()
        order = np.argsort(~known, kind="stable")
        n = int(known.sum())
        found = at = np.zeros(0, np.int64)
        doc = found
        if 0 < n < len(order):
            rows = rows.take(pa.array(order))
            words, code, bounds = coded(rows.column("text").combine_chunks())
            at = locate(code, bounds, hashed(words)[code], n, rows.column("anchor").to_numpy()[:n], width, phrase)
            doc = np.searchsorted(bounds, at, side="right") - 1
            at = at - bounds[doc]
        starts, lengths = _runs(doc, at)
        row = pa.array(doc[starts])
        return pa.table(
            {
                "r1": rows.column("r1").take(row), "r2": rows.column("r2").take(row),
                "at": pa.array(rows.column("at").to_numpy()[doc[starts]] + at[starts]), "length": pa.array(lengths.astype(np.int64)),
            }
        )

    return find


def _spelled(code: np.ndarray, phrases: np.ndarray, n_codes: int) -> tuple[str, int]:
    """Words as a text of `span` letters each, and span. Only words of phrases have letters of their own.

    Each place within a word has its own few letters: nodes of the automaton stay small, and matches start at words.
    """
    used = np.unique(code[phrases])
    span = 3 if len(used) <= 80**3 else 4
    base = 80 if span == 3 else 60
    letters = np.full((n_codes, span), 255, np.uint8)
    for k in range(span):
        letters[used, k] = np.arange(len(used)) // base**k % base + k * base
    return letters[code].tobytes().decode("latin-1"), span


def _cleaner(width: int):
    """doc_id, n_words, n_removed, kept_sha256 of (doc_id, text, places)."""

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch, 1, CHUNK_BYTES):
                words, code, bounds = coded(chunk.column(1))
                places = chunk.column(2)
                flat = places.flatten()
                size = pc.fill_null(pc.list_value_length(places), 0).to_numpy(zero_copy_only=False)
                begin = np.repeat(bounds[:-1], size) + flat.field("at").to_numpy(zero_copy_only=False)
                reach = flat.field("length").to_numpy(zero_copy_only=False) + width - 1
                step = np.zeros(len(code) + 1, np.int64)
                np.add.at(step, begin, 1)
                np.add.at(step, begin + reach, -1)
                drop = np.cumsum(step[:-1]) > 0
                gone = np.r_[0, np.cumsum(drop)]
                spelled = words.cast(pa.binary()).to_pylist()
                out = []
                for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                    own = code[a:b] if gone[b] == gone[a] else code[a:b][~drop[a:b]]
                    out.append(hashlib.sha256(b" ".join([spelled[c] for c in own.tolist()])).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [chunk.column(0), pa.array(np.diff(bounds)), pa.array(gone[bounds[1:]] - gone[bounds[:-1]]), pa.array(out, pa.string())],
                    ["doc_id", "n_words", "n_removed", "kept_sha256"],
                )

    return clean


def bitmap(phrases: DataFrame, bits: int) -> bytes:
    """Bits of the phrases counted twice, at the place that their hash's first bits give. 2**bits / 8 bytes."""
    place = F.shiftrightunsigned("phrase", 64 - bits)
    rows = (
        phrases.groupBy(F.floor(place / _BUCKET).cast("long").alias("bucket"))
        .agg(F.bitmap_construct_agg((place % _BUCKET).cast("long")).alias("map"))
        .collect()
    )
    out = np.zeros(max(1 << bits, _BUCKET) // 8, np.uint8)
    size = _BUCKET // 8
    for r in rows:
        out[r["bucket"] * size : (r["bucket"] + 1) * size] = np.frombuffer(r["map"], np.uint8)[: len(out)]
    return out.tobytes()


def _dealt(pieces: DataFrame, segs: DataFrame, width: int, phrase: int, shard_words: int) -> DataFrame:
    """Add shard and part to pieces: shards by anchor, each in as many parts as its segments need; passages go to all parts."""
    anchors = segs.select(F.explode("anchors").alias("anchor"))
    total = segs.agg(F.sum(F.size("anchors"))).first()[0] or 0
    most = max(1, shard_words // (2 * width))
    shards = max(1, -(-total // most))
    shard = F.pmod("anchor", F.lit(shards)).cast("int").alias("shard")
    parts = staged(
        anchors.groupBy(shard).agg(F.count("*").alias("n")).select("shard", F.ceil(F.col("n") / (2 * most)).cast("int").alias("parts")), "shard-parts"
    )
    parts = F.broadcast(parts) if shards <= BROADCAST_SHARDS else parts
    whole, own = F.sequence(F.lit(0), F.col("parts") - 1), F.array(F.pmod(F.xxhash64("r1", "at"), F.col("parts")).cast("int"))
    return pieces.withColumn("shard", shard).join(parts, "shard").withColumn("part", F.explode(F.when(F.col("known"), whole).otherwise(own)))


def repeated_places(
    docs: DataFrame, width: int = WIDTH, phrase: int = PHRASE, sampled: int = SAMPLED, shard_words: int = SHARD_WORDS, bits: int | None = None
) -> DataFrame:
    """Places (r1, r2, at, length) of runs of repeated windows. docs: r1, r2, text."""
    spark = docs.sparkSession
    counted = map_arrow(docs.select("text"), _phrase_counter(width, phrase, sampled), "phrase long, n long")
    counted = staged(counted.groupBy("phrase").agg(F.sum("n").alias("n")).filter("n > 1 AND phrase IS NOT NULL"), "phrases")
    bits = bits or min(MOST_BITS, max(LEAST_BITS, counted.count().bit_length() + SPARE_BITS))
    bit_map = spark.sparkContext.broadcast(bitmap(counted, bits))
    segs = map_arrow(
        docs.select("r1", "r2", "text"), _segmenter(bit_map, width, phrase, sampled, bits),
        "r1 long, r2 long, at long, text string, anchors array<long>, cuts array<int>",
    )
    # partition and place in it, so that a row and a window in it fit one long
    nth = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    segs = staged(segs.withColumn("row", F.shiftleft(F.spark_partition_id().cast("long"), 28) + nth), "segments")
    release(spark)
    windows = map_arrow(segs.select("row", "text"), _window_counter(width), "h1 long, h2 int, n long, place long")
    row, at = F.shiftright("place", LONG.bit_length() - 1).alias("row"), F.col("place").bitwiseAND(F.lit(LONG - 1)).cast("int")
    confirmed = (
        windows.groupBy("h1", "h2").agg(F.sum("n").alias("n"), F.min("place").alias("place"))
        .filter("n > 1").groupBy(row).agg(F.collect_list(at).alias("ats"))
    )
    # written, so that the windows' shuffle, the largest, is gone before the pieces are shuffled
    confirmed = staged(confirmed, "confirmed-windows")
    release(spark)
    marked = segs.join(confirmed, "row", "left").select("r1", "r2", "at", "text", "anchors", "cuts", "ats")
    pieces = map_arrow(marked, _cutter(width), "anchor long, known boolean, r1 long, r2 long, at long, text string")
    return (
        _dealt(pieces, segs, width, phrase, shard_words)
        .groupBy("shard", "part")
        .applyInArrow(_finder(width, phrase), "r1 long, r2 long, at long, length long")
    )


def drop_repeats(
    docs: DataFrame, width: int = WIDTH, phrase: int = PHRASE, sampled: int = SAMPLED, shard_words: int = SHARD_WORDS, bits: int | None = None
) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = docs.withColumns({"r1": F.xxhash64("doc_id", "text"), "r2": F.xxhash64(F.lit("2"), "text", "doc_id")})
    found = repeated_places(docs, width, phrase, sampled, shard_words, bits)
    places = staged(found.groupBy("r1", "r2").agg(F.collect_set(F.struct("at", "length")).alias("places")), "repeated-places")
    release(docs.sparkSession)
    rows = docs.join(places.hint("shuffle_hash"), ["r1", "r2"], "left").select("doc_id", "text", "places")
    return map_arrow(rows, _cleaner(width), "doc_id long, n_words long, n_removed long, kept_sha256 string")


def op9_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeats(documents(spark, sf_dir))
