"""Mixing sources to target weights (DataFrame operations only).

Every document gets a hash-random key. The keys are uniform, so equal key ranges are a range
partition: 4096 ranges of each source are summed, the sums are turned into running sums, and
each range is then sorted on its own. A hot source is thus dealt over 4096 ranges and no window
holds more than one of them. The budget of a source is taken in key order, in whole epochs and
then up to the exact word of the last one.

Edge cases: null text counts zero words; a null source is a source of its own and comes last;
null doc_id is hashed as the empty text; repeated rows are documents of their own; a source
without words has target 0; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, documents, staged

#: Weights by the order of the sources, repeating.
WEIGHTS = (1, 2, 3)
#: A source is repeated at most so often.
MAX_EPOCHS = 3
RANGE_BITS = 12


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Add weight and target to a table with a row per source (src, source, source_size).

    The fill level at which the shares min(weight * level, max_epochs * size) meet the budget is
    found over the sources in the order of their caps per weight. One task, a row per source.
    """
    everything = W.partitionBy().rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    order = W.orderBy(F.col("cap") / F.col("weight"), "src")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(x) for x in weights]), (rank % len(weights) + 1).cast("int"))
    return (
        sizes.withColumn("weight", weight.cast("long"))
        .withColumn("cap", F.col("source_size") * max_epochs)
        .withColumn("place", F.row_number().over(order))
        .withColumn(
            "level",
            (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))).cast("double")
            / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))),
        )
        .withColumn("fits", F.col("weight") * F.col("level") <= F.col("cap"))
        .withColumn("first", F.min(F.when(F.col("fits"), F.col("place"))).over(everything))
        .withColumn("level", F.min(F.when(F.col("place") == F.col("first"), F.col("level"))).over(everything))
        .withColumn(
            "target",
            F.when(F.col("place") < F.col("first"), F.col("cap").cast("double")).otherwise(
                F.least(F.col("weight") * F.col("level"), F.col("cap").cast("double"))
            ),
        )
        .select("src", "source", "source_size", "weight", "target")
    )


def _measured(docs: DataFrame, seed: str) -> DataFrame:
    """docs with src, size, key and range, all with a __ before their names."""
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    key = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), doc_id)), 1, 15), 16, 10).cast("long")
    return docs.withColumns(
        {
            "__src": F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n")),
            "__size": F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long"),
            "__key": key,
            "__range": F.shiftrightunsigned(key, 60 - RANGE_BITS).cast("int"),
        }
    )


def _dealt(rows: DataFrame, ranges: DataFrame, weights: tuple[int, ...], max_epochs: int) -> DataFrame:
    """Add source_size, target, epochs, cut and taken to measured rows. ranges: the sizes of all ranges."""
    sums = targets(
        ranges.groupBy("__src", "source").agg(F.sum("range_size").alias("source_size")).withColumnRenamed("__src", "src"),
        weights,
        max_epochs,
    )
    before = W.partitionBy("__src").orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        ranges.select("__src", "__range", F.coalesce(F.sum("range_size").over(before), F.lit(0)).alias("__start"))
        .join(sums.select(F.col("src").alias("__src"), "source_size", "target").toDF("__src", "__source_size", "__target"), "__src")
    )
    inside = (
        W.partitionBy("__src", "__range").orderBy("__key", "doc_id", "__size").rowsBetween(W.unboundedPreceding, -1)
    )
    size, total = F.col("__size"), F.col("__source_size")
    epochs = F.when(total > 0, F.floor(F.col("__target") / total)).otherwise(0).cast("long")
    rest = F.floor(F.col("__target") - F.col("__epochs") * total + 0.5).cast("long")
    return (
        rows.join(starts, ["__src", "__range"])
        .withColumn("__before", F.col("__start") + F.coalesce(F.sum("__size").over(inside), F.lit(0)))
        .withColumn("__epochs", epochs)
        .withColumn("__cut", F.greatest(F.lit(0), F.least(size, rest - F.col("__before"))))
        .withColumn("__taken", F.col("__epochs") * size + F.col("__cut"))
    )


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = "mix"
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, epochs, cut, taken.

    The mix takes the document `epochs` times whole and then its first `cut` words.
    """
    rows = _measured(docs.select("doc_id", F.col("source").cast("string").alias("source"), "text"), seed).drop("text")
    rows = staged(rows, "mix-base")
    ranges = rows.groupBy("__src", "source", "__range").agg(F.sum("__size").alias("range_size"))
    found = _dealt(rows, ranges, weights, max_epochs)
    return found.select("doc_id", "source", *[F.col(f"__{c}").alias(c) for c in ("size", "source_size", "target", "epochs", "cut", "taken")])


def mixed_documents(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = "mix"
) -> DataFrame:
    """The mix itself, with the columns of docs: a row for each time a document is taken. The last
    document of a source may be cut at the budget's last word; its n_chars follows."""
    names = [F.col(f"`{c}`") for c in docs.columns]
    rows = _measured(docs.select(*names), seed)
    slim = staged(rows.select("__src", F.col("source").cast("string").alias("source"), "__range", "__size"), "mix-base")
    ranges = staged(slim.groupBy("__src", "source", "__range").agg(F.sum("__size").alias("range_size")), "mix-ranges")
    found = _dealt(rows, ranges, weights, max_epochs)
    times = F.flatten(
        F.array(
            F.array_repeat(F.lit(False), F.col("__epochs").cast("int")),
            F.array_repeat(F.lit(True), F.when(F.col("__cut") > 0, 1).otherwise(0)),
        )
    )
    found = found.withColumn("__part", F.explode(times))
    part = F.col("__part") & (F.col("__cut") < F.col("__size"))
    spaced = F.regexp_extract_all("text", F.lit(rf"[\x20\x09-\x0D]*{WORD}"), F.lit(0))
    text = F.when(part, F.array_join(F.slice(spaced, 1, F.col("__cut").cast("int")), "")).otherwise(F.col("text"))
    out = found.withColumn("text", text)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(part, F.char_length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(*names)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = r"""
WITH base AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS key
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
  FROM base GROUP BY source),
placed AS (
  SELECT *, 3 * source_size AS cap,
         row_number() OVER o AS place,
         ((sum(source_size) OVER ())::BIGINT
           - coalesce(sum(3 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)::DOUBLE
         / ((sum(weight) OVER ())::BIGINT
           - coalesce(sum(weight) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT) AS level
  FROM sources WINDOW o AS (ORDER BY 3 * source_size / weight, source NULLS LAST)),
first AS (SELECT place, level FROM placed WHERE weight * level <= cap ORDER BY place LIMIT 1),
target AS (
  SELECT p.source, source_size,
         CASE WHEN p.place < f.place THEN cap::DOUBLE ELSE least(weight * f.level, cap::DOUBLE) END AS target
  FROM placed p, first f),
sums AS (
  SELECT b.doc_id, b.size, t.source_size, t.target,
         CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs,
         coalesce(sum(b.size) OVER (PARTITION BY b.source ORDER BY b.key, b.doc_id, b.size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM base b JOIN target t ON b.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       epochs * size + greatest(0, least(size, floor(target - epochs * source_size + 0.5)::BIGINT - before)) AS taken
FROM sums
"""
