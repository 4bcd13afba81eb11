"""Exact deduplication by stateful streaming (DataFrame operations only).

A staged table of (doc_id, row, key) is streamed through an aggregation keyed by the text's
SHA-256. Its state lives in RocksDB without expiry and keeps per digest the stable identifier
(largest doc_id), the content locator (the row number of the staged scan, which names the scan
partition and the position in it) and the number of rows. A digest that is hit more than once
has its full bytes compared; if two texts ever shared a digest, the pass repeats with the whole
text as key, so the result is exact in all cases.

The hot key of a third of all rows is combined on the map side before the state shuffle; the
join that returns one row per document carries 50-byte rows and is left to AQE's skew split.

Edge cases: null text counts as empty; null doc_id sorts lowest; repeated rows with one doc_id
and text form a group of which exactly one row is kept; an empty table gives no rows; columns
other than doc_id and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, staged, work_path

#: Digests of repeated texts are broadcast up to this many (48 bytes each); beyond it the check shuffles.
BROADCAST_GROUPS = 100_000
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def digest_state(rows: DataFrame, path: str, max_files_per_trigger: int) -> DataFrame:
    """Stream the staged rows through keyed RocksDB state; return the final state as a table."""
    spark = rows.sparkSession
    own = spark.newSession()
    for k, v in {
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
        "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
        "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
        # many small stores: no disk is set aside ahead of use
        "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
        "spark.sql.shuffle.partitions": spark.conf.get("spark.sql.shuffle.partitions"),
    }.items():
        own.conf.set(k, v)
    checkpoint = work_path(spark, "dedup-state")
    arriving = own.readStream.schema(rows.schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(path)
    state = arriving.groupBy("key").agg(
        F.max(F.struct("doc_id", "row")).alias("keeper"), F.count(F.lit(1)).alias("group_size")
    )
    query = (
        state.writeStream.outputMode("update")
        .format("noop")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if not query.recentProgress and rows.isEmpty():
        return own.createDataFrame([], "key binary, keep_id long, keep_row long, group_size long")
    kept = spark.read.format("statestore").load(checkpoint)
    keeper, size = (f"value.{f.name}" for f in kept.schema["value"].dataType.fields)
    return kept.select(
        F.col("key.key").alias("key"),
        F.col(f"{keeper}.doc_id").alias("keep_id"),
        F.col(f"{keeper}.row").alias("keep_row"),
        F.col(size).alias("group_size"),
    )


def clashes(docs: DataFrame, key, groups: DataFrame) -> bool:
    """Compare full bytes on hits: whether rows that share a key differ in their texts."""
    hit = groups.filter("group_size > 1").select("key")
    if (n := hit.count()) == 0:
        return False
    if n <= BROADCAST_GROUPS:
        hit = F.broadcast(hit)
    texts = docs.select(key(F.col("text")).alias("key"), "text").join(hit, "key", "left_semi")
    several = texts.groupBy("key", "text").agg(F.lit(1).alias("one")).groupBy("key").agg(F.count("*").alias("n"))
    return not several.filter("n > 1").isEmpty()


def exact_dedup(docs: DataFrame, key=sha256, max_files_per_trigger: int = 10_000) -> DataFrame:
    """One row per document: doc_id, row, keep_id, group_size, kept, text_sha256.

    key: the digest, a function of the text column; max_files_per_trigger: files of a micro-batch.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    for content_key in (key, lambda text: F.encode(text, "UTF-8")):
        plain = content_key is sha256
        rows = docs.select(
            "doc_id",
            F.monotonically_increasing_id().alias("row"),
            content_key(F.col("text")).alias("key"),
            *([] if plain else [sha256(F.col("text")).alias("sha")]),
        )
        path = work_path(docs.sparkSession, "dedup-rows")
        rows.write.parquet(path)
        rows = docs.sparkSession.read.schema(rows.schema).parquet(path)
        groups = staged(digest_state(rows, path, max_files_per_trigger), "dedup-groups")
        if not clashes(docs, content_key, groups):
            break
    return rows.join(groups, "key").select(
        "doc_id",
        "row",
        "keep_id",
        "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("key" if plain else "sha")).alias("text_sha256"),
    )


def keep_last(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns.

    Rows to drop are named by doc_id and digest; where rows agree in both, one of them is taken.
    """
    found = staged(exact_dedup(docs), "dedup-rows-judged")
    lost = found.filter("NOT kept")
    other = lost.filter(~F.col("doc_id").eqNullSafe(F.col("keep_id"))).select("doc_id", "text_sha256").distinct()
    same = lost.filter(F.col("doc_id").eqNullSafe(F.col("keep_id"))).select("doc_id", "text_sha256").distinct()
    sized = lambda df: F.broadcast(df) if df.count() <= BROADCAST_GROUPS else df
    names = [f"`{c}`" for c in docs.columns]
    rows = docs.withColumn("__sha", F.sha2(F.coalesce("text", F.lit("")), 256)).alias("d")

    def of(keys: DataFrame, how: str) -> DataFrame:
        keys = sized(keys.toDF("__id", "__key"))
        return rows.join(
            keys, F.col("d.__sha").eqNullSafe(F.col("__key")) & F.col("d.doc_id").cast("long").eqNullSafe(F.col("__id")), how
        )

    rows = of(other, "left_anti").alias("d")
    if same.isEmpty():
        return rows.select(*names)
    once = of(same, "left_semi").dropDuplicates(["doc_id", "__sha"])
    return of(same, "left_anti").select(*names).unionByName(once.select(*names))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup(documents(spark, sf_dir))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLE = """
SELECT doc_id,
       max(doc_id) OVER w AS keep_id,
       count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
