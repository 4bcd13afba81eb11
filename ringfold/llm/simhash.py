"""SimHash near-duplicates by a segment-popcount embedding.

A fingerprint's 64 bits are 32 segments of two bits; the vector of their bit counts (each 0, 1
or 2) embeds it so that the Manhattan distance of two vectors never exceeds the Hamming distance
of the fingerprints. The vector is kept in unary code in one long, so that this distance is the
popcount of an XOR.

Grid range-join: the 32 counts are cut into m sub-vectors. Two vectors at Manhattan distance 4 or
less differ in at most 4 of them, so they agree in m - 4 at least, and each fingerprint is dealt to
the cells (m - 4 sub-vectors, their counts) of all choices. m is 6 (15 cells a fingerprint), and 8 or 10 for
more fingerprints (70, 210), whose cells are finer; the pairs found are the same. Pairs within a cell pass the Manhattan bound
first and the exact Hamming distance then. Only distinct fingerprints enter the grid, a cell emits
a spanning forest and not its pairs, and a cell of over BLOCK fingerprints is dealt as pairs of
blocks, so that no task holds more than two blocks of it.

Edge cases: null or empty text (or one without a word) has fingerprint zero, linked like any
other; fewer than `width` words form one shingle; repeated rows and equal fingerprints share a
component; a null doc_id is never a component's id unless no other is reachable; an empty table
gives no rows; other columns are not read. Rows are told apart by 128 bits of hash of doc_id and text.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, map_arrow, release, staged
from .graph import components

WIDTH = 4
SEED = 42
MAX_BITS = 4
#: Sub-vectors by the number of fingerprints: up to so many, and beyond.
PARTS = ((6, 1 << 24), (8, 1 << 30), (10, 1 << 62))
BLOCK = 1024
EVEN = 0x5555555555555555
#: Shingles whose bits are counted at once.
STEP = 1 << 15


def fingerprint(text: bytes, width: int = WIDTH, seed: int = SEED) -> int:
    """The fingerprint of one text, unsigned."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        return xxhash.xxh64_intdigest(joined, seed)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    starts = (ends - size)[: 1 - width].tolist()
    ends = ends[width - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for k in range(0, len(starts), STEP):
        hashes = [digest(joined[a:b], seed) for a, b in zip(starts[k : k + STEP], ends[k : k + STEP])]
        bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * counts > len(starts)).tobytes(), "big")


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.fromiter((fingerprint(t.as_py() or b"") for t in batch.column(2)), np.uint64, batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found.view(np.int64))], ["doc_id", "rid", "fp"])


def row_key():
    return F.struct(F.xxhash64("doc_id", "text").alias("a"), F.xxhash64(F.lit("2"), "text", "doc_id").alias("b"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, rid (hashes of doc_id and text) and fp of every document."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("rid"), F.encode(F.col("text"), "UTF-8").alias("text")
    )
    return map_arrow(rows, _fingerprints, "doc_id long, rid struct<a:long,b:long>, fp long")


def unary(fp: str = "fp"):
    """The bit counts of the 32 segments, each in unary code, as a long."""
    low, high = F.col(fp), F.shiftrightunsigned(F.col(fp), 1)
    return low.bitwiseOR(high).bitwiseAND(F.lit(EVEN)).bitwiseOR(
        F.shiftleft(low.bitwiseAND(high).bitwiseAND(F.lit(EVEN)), 1)
    )


def cells(nodes: DataFrame, parts: int = 6, max_bits: int = MAX_BITS) -> DataFrame:
    """fp, embed and cell: the grid cells of each fingerprint. A cell's key: the choice, then the embedding with all others zero."""
    edges = [round(32 * i / parts) * 2 for i in range(parts + 1)]
    mask = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    keys = []
    for k, own in enumerate(combinations(range(parts), parts - max_bits)):
        m = sum(mask[i] for i in own)
        keys.append(F.struct(F.lit(k).alias("choice"), F.col("embed").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m)).alias("counts")))
    return nodes.withColumn("embed", unary()).select("fp", "embed", F.explode(F.array(*keys)).alias("cell"))


def forest(key: np.ndarray, side: np.ndarray, fp: np.ndarray, embed: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that span what the rows of equal keys (sorted) connect. side: 0, or the block (1, 2) of a pair of
    blocks, of which only pairs across are compared."""
    n, links = len(key), []
    parent = list(range(n))
    label = np.arange(n)

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    left, k = np.arange(n - 1), 1
    while len(left := left[left < n - k]) and len(left := left[key[left] == key[left + k]]):
        right = left + k
        near = np.bitwise_count(embed[left] ^ embed[right]) <= max_bits
        near &= (side[left] == 0) | (side[left] != side[right])
        a, b = left[near], right[near]
        near = (np.bitwise_count(fp[a] ^ fp[b]) <= max_bits) & (label[a] != label[b])
        for i, j in zip(a[near].tolist(), b[near].tolist()):
            x, y = find(i), find(j)
            if x != y:
                parent[max(x, y)] = min(x, y)
                links.append((i, j))
        if near.any():
            label = np.array(parent)
            while (up := label[label]) is not None and (up != label).any():
                label = up
        k += 1
    return links


def _linker(max_bits: int):
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            # order: choice, counts, pair, side, fp, embed
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols)]
            last = (cols[0] == cols[0][-1]) & (cols[1] == cols[1][-1]) & (cols[2] == cols[2][-1])
            cut = int(np.argmax(last))
            held = [c[cut:] for c in cols]
            if cut:
                yield from spanned([c[:cut] for c in cols])
        if held is not None:
            yield from spanned(held)

    def spanned(cols: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        choice, counts, pair, side, fp, embed = cols
        key = np.cumsum(np.r_[0, (np.diff(choice) != 0) | (counts[1:] != counts[:-1]) | (np.diff(pair) != 0)])
        if found := forest(key, side, fp.view(np.uint64), embed.view(np.uint64), max_bits):
            a, b = np.array(found).T
            yield pa.RecordBatch.from_arrays([pa.array(fp[a]), pa.array(fp[b])], ["a", "b"])

    return link


def links(nodes: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK, parts: int | None = None) -> DataFrame:
    """Links (a, b) of distinct fingerprints at max_bits or fewer differing bits, up to connectivity."""
    parts = parts or next(m for m, most in PARTS if nodes.count() <= most)
    dealt = cells(nodes, parts, max_bits)
    full = staged(
        dealt.groupBy("cell").agg(F.count("*").alias("n")).filter(F.col("n") > block)
        .select("cell", F.ceil(F.col("n") / block).cast("int").alias("blocks")), "full-cells",
    )
    if (n := full.count()) == 0:
        split = dealt.select("cell", F.lit(0).alias("pair"), F.lit(0).alias("side"), "fp", "embed")
    else:
        own = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("blocks")).cast("int")
        dealt = dealt.join(F.broadcast(full) if n <= 100_000 else full, "cell", "left").withColumn("own", own)
        other = F.explode(
            F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))
        )
        split = dealt.withColumn("other", other).select(
            "cell",
            F.coalesce(F.greatest("own", "other") * F.col("blocks") + F.least("own", "other"), F.lit(0)).alias("pair"),
            F.when(F.col("blocks").isNull() | (F.col("own") == F.col("other")), 0)
            .when(F.col("own") < F.col("other"), 1)
            .otherwise(2)
            .alias("side"),
            "fp",
            "embed",
        )
    dealt = split.repartition("cell", "pair").sortWithinPartitions("cell", "pair")
    dealt = dealt.select(F.col("cell.choice").alias("choice"), F.col("cell.counts").alias("counts"), "pair", "side", "fp", "embed")
    return map_arrow(dealt, _linker(max_bits), "a long, b long")


def near_duplicates(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: doc_id, rid, fp (signed long), component_id and the rid of the one that stays."""
    if max_bits > PARTS[0][0] - 2:
        raise ValueError(f"the grid finds distances up to {PARTS[0][0] - 2}")
    rows = staged(fingerprints(docs), "fingerprints")
    release(docs.sparkSession)
    first = F.min(F.struct(F.coalesce("doc_id", F.lit(2**63 - 1)).alias("id"), "rid")).alias("first")
    nodes = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), first), "fp-nodes")
    linked = components(links(nodes.select("fp"), max_bits)).withColumnRenamed("node", "fp")
    named = staged(
        nodes.join(linked, "fp", "left").select("fp", "least", "first", F.coalesce("label", "fp").alias("label")), "fp-labels"
    )
    ids = named.groupBy("label").agg(F.min("least").alias("component_id"), F.min("first").alias("stays"))
    ids = named.join(ids, "label").select("fp", "component_id", F.col("stays.rid").alias("stays"))
    return rows.join(ids, "fp").select("doc_id", "rid", "fp", "component_id", "stays")


#: Documents to drop are broadcast up to this many (8 bytes each); beyond it the rows are shuffled.
BROADCAST_ROWS = 500_000


def keep_one(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """The document with the smallest doc_id of every component, with all its columns. Of rows equal in doc_id and text, one of them."""
    found = staged(near_duplicates(docs, max_bits).select("rid", "stays"), "near-judged")
    lost = found.filter("rid <> stays").select("rid").distinct()
    same = found.filter("rid = stays").groupBy("rid").agg(F.count("*").alias("n")).filter("n > 1").select("rid")
    own = "__row"
    while own in docs.columns:
        own += "_"
    names = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.withColumn(own, row_key())

    def of(keys: DataFrame, how: str) -> DataFrame:
        keys = staged(keys.toDF(f"{own}key"), "near-keys")
        keys = F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys
        return rows.join(keys, F.col(own) == F.col(f"{own}key"), how)

    rows = of(lost, "left_anti")
    if same.isEmpty():
        return rows.select(*names)
    return of(same, "left_anti").select(*names).unionByName(of(same, "left_semi").dropDuplicates([own]).select(*names))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return near_duplicates(documents(spark, sf_dir)).select("doc_id", hexed.alias("fingerprint"), "component_id")
