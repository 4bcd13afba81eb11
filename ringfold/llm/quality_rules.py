"""Quality rules: base rules, then robust multivariate outliers.

Each document's statistics become a vector (mean word length, symbols, repeated words, upper-case
share, repeated lines; logs, roots and arcsines of ratios). For each language and source the
minimum-covariance-determinant estimate is searched over all documents of the group: four
deterministic starts (medians with quartile scales, plain moments, spatial signs, tanh scores; Hubert,
Rousseeuw and Verdonck 2012) are concentrated, each on the three quarters of the group nearest to it,
until the determinant falls no more; the smallest determinant wins, and one reweighted estimate
follows. A document farther from its group's centre than a chi-square tail of 1e-7 allows is rejected.

The scatter is regularised (Boudt, Rousseeuw, Vanduffel and Verdonck 2020), so that it is defined for
every group, of one document too: a least scale for each coordinate is added, and the final estimate of
n documents is weighted n to SHRINK with that of its language, which is so weighted with that of all
documents. There is no size at which another rule takes over.

A concentration step joins the vectors with the estimates of their groups and adds up moments by
group, start and distance bin, combined on the map side, so a hot group is no burden; the nearest part
is read off the bins, the last one in part (groups of up to EXACT documents: bins so fine that documents
are ranked one by one). Estimates are tables, a row for a group and start, broadcast up to
BROADCAST_GROUPS of them and else joined by a shuffle; the driver holds none.

Edge cases: null or empty text fails the base rules; documents that fail them are not part of the
estimates; a null language or source is a group of its own; repeated rows are judged each; an
empty table gives no rows; extra columns are ignored (the pipeline stage keeps them, whatever their names).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import documents, map_arrow, release, ship, staged, uncompiled
from .textstats import CHUNK_BYTES, COLUMNS, measure, text_stats
from .words import chunks

MIN_WORDS = 50
#: Least scale of each coordinate, so that a statistic that hardly varies in a group rejects nothing by itself.
FLOORS = (0.06, 0.25, 0.15, 0.35, 0.2)
NEAREST = 0.75
MOST_STEPS = 30
#: A start has settled when the log of its determinant falls by less.
SETTLED = 1e-5
#: Documents that a group's parent counts for.
SHRINK = 100
#: Groups of up to so many documents are ranked one by one; larger ones by bins of 1/32 of a doubling.
EXACT = 1000
BROADCAST_GROUPS = 20_000
TAIL = 1e-7
P = len(FLOORS)
X = [f"x{i}" for i in range(P)]
_PAIRS = [(i, j) for i in range(P) for j in range(i, P)]
_SUMS = ["m", *[f"s{i}" for i in range(P)], *[f"q{i}{j}" for i, j in _PAIRS]]
_ESTIMATE = "centre array<double>, inverse array<double>, scatter array<double>, log_det double"


def chi2_cdf(x: float, k: int) -> float:
    """Chi-square distribution function, by the series of the incomplete gamma function."""
    if x <= 0:
        return 0.0
    a, h = k / 2, x / 2
    term = total = 1 / a
    for n in range(1, 500):
        term *= h / (a + n)
        total += term
        if term < total * 1e-16:
            break
    return min(1.0, total * math.exp(a * math.log(h) - h - math.lgamma(a)))


def chi2_quantile(p: float, k: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, k) < p else (low, mid)
    return high


def consistency(share: float) -> float:
    """Factor by which the covariance of the nearest share of a normal sample is to be raised."""
    return share / chi2_cdf(chi2_quantile(share, P), P + 2)


def vector(stats: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """base_failed and the coordinates of each document."""
    n = np.maximum(stats["n_words"], 1)
    chars = np.maximum(stats["word_chars"], 1)
    coordinates = (
        np.log(chars / n),
        np.log1p(20 * stats["n_symbols"] / n),
        np.arcsin(np.sqrt(stats["n_repeat_words"] / n)),
        np.log(0.01 + stats["n_upper"] / chars),
        np.sqrt(stats["n_dup_lines"] / np.maximum(stats["n_lines"], 1)),
    )
    failed = (stats["n_words"] < MIN_WORDS) | (100 * stats["n_repeat_words"] > 50 * stats["n_words"])
    return {"base_failed": failed} | dict(zip(X, coordinates))


def _moments(x: list[Column]) -> list[Column]:
    cols = [F.count("*").cast("double"), *map(F.sum, x), *[F.sum(x[i] * x[j]) for i, j in _PAIRS]]
    return [c.alias(n) for c, n in zip(cols, _SUMS)]


def _sized(estimates: DataFrame) -> DataFrame:
    return F.broadcast(estimates) if estimates.count() <= BROADCAST_GROUPS else estimates


def square_distance(x: list[Column], of: str = "") -> Column:
    """Squared Mahalanobis distance by the columns (or fields of column `of`) centre and inverse."""
    off = [c - F.element_at(f"{of}centre", i + 1) for i, c in enumerate(x)]
    terms = [F.element_at(f"{of}inverse", i * P + j + 1) * (off[i] * off[j] * (2 if i < j else 1)) for i, j in _PAIRS]
    return F.greatest(sum(terms[1:], terms[0]), F.lit(0.0))


def described(centre: np.ndarray, scatter: np.ndarray) -> dict:
    return {
        "centre": centre.tolist(), "inverse": np.linalg.inv(scatter).ravel().tolist(), "scatter": scatter.ravel().tolist(),
        "log_det": float(np.linalg.slogdet(scatter)[1]),
    }


def estimate(sums: np.ndarray, share: float, whole: float) -> tuple[np.ndarray, np.ndarray]:
    """Centre and scatter of the nearest share of a group's documents, from its bins in order."""
    want = math.ceil(share * sums[:, 0].sum() - 1e-9)
    before = np.cumsum(sums[:, 0]) - sums[:, 0]
    part = np.clip((want - before) / sums[:, 0], 0, 1)
    total = (sums * part[:, None]).sum(axis=0)
    centre = total[1 : P + 1] / total[0]
    return centre, (_square(total[P + 1 :] / total[0]) - np.outer(centre, centre)) * consistency(whole) + np.diag(np.square(FLOORS))


def _square(values) -> np.ndarray:
    out = np.zeros((P, P))
    for (i, j), v in zip(_PAIRS, values):
        out[i, j] = out[j, i] = v
    return out


def starts(rows: DataFrame) -> DataFrame:
    """key, parent, n, start and an estimate for each of the four starts. rows: key, parent, x0.. ."""
    quarts = F.percentile_approx
    base = staged(
        rows.groupBy("key", "parent").agg(F.count("*").alias("n"), *[quarts(x, [0.25, 0.5, 0.75], 10000).alias(f"{x}_q") for x in X]), "rule-quartiles"
    )
    middle = [F.element_at(f"{x}_q", 2) for x in X]
    scale = [F.greatest((F.element_at(f"{x}_q", 3) - F.element_at(f"{x}_q", 1)) / 1.349, F.lit(f)) for x, f in zip(X, FLOORS)]
    z = [(F.col(x) - m) / s for x, m, s in zip(X, middle, scale)]
    named = rows.join(_sized(base), ["key", "parent"])
    named = named.select("key", *X, *[c.alias(f"z{i}") for i, c in enumerate(z)])
    size = F.sqrt(sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(P)), F.lit(1e-12)))
    sets = {"b": [F.col(x) for x in X], "c": [F.col(f"z{i}") / size for i in range(P)], "d": [F.tanh(f"z{i}") for i in range(P)]}
    sums = named.groupBy("key").agg(*[m.alias(f"{name}_{n}") for name, x in sets.items() for m, n in zip(_moments(x), _SUMS)])
    sums = sums.join(base.select("key", "parent", "n", F.array(*middle).alias("middle"), F.array(*scale).alias("scale")), "key")

    def begin(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        floor = np.diag(np.square(FLOORS))
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                middle, scale, n = np.array(r.middle), np.diag(r.scale), float(r.n)
                first = lambda k: np.array([getattr(r, f"{k}_s{i}") for i in range(P)]) / n  # noqa: B023, E731
                second = lambda k: _square([getattr(r, f"{k}_q{i}{j}") / n for i, j in _PAIRS])  # noqa: B023, E731
                mean = first("b")
                plain = second("b") - np.outer(mean, mean)
                tanh = second("d") - np.outer(first("d"), first("d")) + 1e-3 * np.eye(P)
                root = np.sqrt(np.diag(tanh))
                found = (middle, scale**2), (mean, plain + floor), (middle, scale @ (P * second("c")) @ scale + floor), (middle, scale @ (tanh / np.outer(root, root)) @ scale)
                out += [{"key": r.key, "parent": r.parent, "n": r.n, "start": k} | described(*e) for k, e in enumerate(found)]
            yield pd.DataFrame(out, columns=["key", "parent", "n", "start", "centre", "inverse", "scatter", "log_det"])

    ship(rows.sparkSession)
    return sums.mapInPandas(begin, f"key string, parent string, n long, start int, {_ESTIMATE}")


def _updated(sums: DataFrame, share: float, whole: float) -> DataFrame:
    """key, start and the estimate of the nearest share. sums: moments by key, start and bin."""

    def update(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        found = described(*estimate(pdf.sort_values("bin")[_SUMS].to_numpy(), share, whole))
        return pd.DataFrame([{"key": key[0], "start": key[1]} | found])

    return sums.groupBy("key", "start").applyInPandas(update, f"key string, start int, {_ESTIMATE}")


def concentrated(rows: DataFrame, share: float = NEAREST) -> DataFrame:
    """The estimate of least determinant of each group, before reweighting: key, parent, n, start, centre, ... ."""
    names = ["key", "parent", "n", "start", "centre", "inverse", "scatter", "log_det"]
    d2 = square_distance([F.col(x) for x in X])
    log = F.log2(d2 + F.lit(1e-12))
    grain = F.floor(log * F.when(F.col("n") <= EXACT, float(1 << 20)).otherwise(32.0))
    open_, settled = staged(starts(rows), "rule-starts"), None
    for _ in range(MOST_STEPS):
        near = rows.select("key", *X).join(_sized(open_.select("key", "n", "start", "centre", "inverse")), "key")
        sums = near.groupBy("key", "start", grain.alias("bin")).agg(*_moments([F.col(x) for x in X]))
        new = _updated(sums, share, share).join(open_.select("key", "parent", "n", "start", F.col("log_det").alias("before")), ["key", "start"])
        new = staged(new, "rule-step")
        still = new.filter(F.col("log_det") < F.col("before") - SETTLED).select(*names)
        done = new.filter(F.col("log_det") >= F.col("before") - SETTLED).select(*names)
        settled = done if settled is None else settled.union(done)
        open_ = still
        if still.isEmpty():
            break
    best = settled.union(open_).groupBy("key").agg(F.min_by(F.struct(*names[1:]), F.struct("log_det", "start")).alias("one"))
    return staged(best.select("key", "one.*"), "rule-best")


def fit(vectors: DataFrame, shrink: float = SHRINK) -> DataFrame:
    """key, centre and inverse of each language and source. vectors: k0, k1, k2 and x0.. of the documents to learn from."""
    release(vectors.sparkSession)
    levels = [("k0", F.col("k1")), ("k1", F.col("k2")), ("k2", F.lit("").alias("k3"))]
    named = F.explode(F.array(*[F.struct(F.col(k).alias("key"), p.alias("parent")) for k, p in levels])).alias("of")
    rows = vectors.select(named, *X).select("of.key", "of.parent", *X)
    with uncompiled(rows.sparkSession):
        best = concentrated(rows)
    d2 = square_distance([F.col(x) for x in X])
    inside = rows.select("key", *X).join(_sized(best.select("key", "start", "centre", "inverse")), "key").filter(d2 <= chi2_quantile(0.975, P))
    sums = inside.groupBy("key", "start", F.lit(0).alias("bin")).agg(*_moments([F.col(x) for x in X]))
    own = best.select("key", "parent", "n").join(_updated(sums, 1.0, 0.975).select("key", "centre", "scatter"), "key")
    own = staged(own, "rule-reweighted")
    # a language and source, then its language, then all: each weighted with the next
    mean = lambda a, b: F.zip_with(a, b, lambda x, y: (F.col("n") * x + shrink * y) / (F.col("n") + shrink))
    above = own.filter("parent = ''").select("key", "centre", "scatter")
    for test in ("parent = '*'", "parent NOT IN ('', '*')"):
        up = above.select(F.col("key").alias("parent"), F.col("centre").alias("up_centre"), F.col("scatter").alias("up_scatter"))
        above = own.filter(test).join(up, "parent").select("key", mean("centre", "up_centre").alias("centre"), mean("scatter", "up_scatter").alias("scatter"))

    def inverted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["inverse"] = [np.linalg.inv(np.array(s).reshape(P, P)).ravel().tolist() for s in batch["scatter"]]
            yield batch[["key", "centre", "inverse"]]

    return staged(above.mapInPandas(inverted, "key string, centre array<double>, inverse array<double>"), "rule-estimates")


def _named(lang, source):
    name = lambda c: F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("null"))
    return {"k0": F.concat_ws("\t", name(lang), name(source)), "k1": name(lang), "k2": F.lit("*")}


_COORDINATES = ", ".join(f"{x} double" for x in X)


def quality_rules(docs: DataFrame, shrink: float = SHRINK, tail: float = TAIL) -> DataFrame:
    """One row per document: doc_id, lang, source, the statistics, base_failed, distance, kept."""
    stats = text_stats(docs, {"doc_id": "long", "lang": "string", "source": "string"}, vector, f"base_failed boolean, {_COORDINATES}")
    rows = staged(stats.withColumns(_named(F.col("lang"), F.col("source"))), "rule-stats")
    found = _sized(fit(rows.filter("NOT base_failed"), shrink))
    out = rows.join(found, F.col("k0") == F.col("key"), "left").withColumn("distance", square_distance([F.col(x) for x in X]))
    far = F.coalesce(F.col("distance") > chi2_quantile(1 - tail, P), F.lit(False))
    kept = (~F.col("base_failed") & ~far).alias("kept")
    return out.select("doc_id", "lang", "source", *COLUMNS, "base_failed", "distance", kept)


def keep_good(docs: DataFrame, shrink: float = SHRINK, tail: float = TAIL) -> DataFrame:
    """The documents that pass, with all their columns. Texts are measured once and written with what was measured."""
    names, own = docs.columns, "__measured"
    while own in names:
        own += "_"
    at = names.index("text")
    keys = F.struct(*[v.alias(k) for k, v in _named(F.col("lang"), F.col("source")).items()])
    kinds = pa.struct([("base_failed", pa.bool_()), *[(x, pa.float64()) for x in X]])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch, at, CHUNK_BYTES):
                found = vector(measure(chunk.column(at)))
                packed = pa.StructArray.from_arrays([pa.array(found[f.name], f.type) for f in kinds], fields=list(kinds))
                yield pa.RecordBatch.from_arrays([*chunk.columns, packed], schema=pa.schema([*chunk.schema, pa.field(own, kinds)]))

    fields = [T.StructField("base_failed", T.BooleanType()), *[T.StructField(x, T.DoubleType()) for x in X]]
    schema = T.StructType([*docs.schema.fields, T.StructField(own, T.StructType(fields))])
    rows = staged(map_arrow(docs, add, schema), "rule-rows")
    passed = rows.filter(~F.col(f"{own}.base_failed"))
    found = fit(passed.select(keys.alias("k"), f"{own}.*").select("k.*", *X), shrink)
    found = _sized(found.select(F.struct("key", "centre", "inverse").alias(f"{own}e")))
    judged = passed.join(found, F.col(f"{own}e.key") == keys["k0"], "left")
    off = [F.col(f"{own}.{x}") for x in X]
    far = square_distance(off, f"{own}e.") > chi2_quantile(1 - tail, P)
    return judged.filter(~F.coalesce(far, F.lit(False))).select(*[F.col(f"`{c}`") for c in names])


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance"
    )
