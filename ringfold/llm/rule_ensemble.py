"""Quality classifier: a sparse rule ensemble over text statistics.

Small gradient-boosted trees are grown on a bounded sample of labelled rows; every path from a
root to a node below it is a conjunctive rule over statistics; a lasso logistic regression keeps
the few rules that matter; these are compiled into one Spark column expression that scores all
documents in generated code. Only the statistics themselves come from Arrow batches.

Labels are read from rows outside the held-out fold, at most SAMPLE of them, taken by a hash of
doc_id. Labels, lang, source and doc_id are never inputs of a score.

Edge cases: null or empty text has statistics 0 and is scored like any other; rows without a
label, or with a null one, teach nothing; without two classes the score is the share of label 1
(0.5 without labels); repeated rows are scored each; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, staged
from .textstats import text_stats

#: Most labelled rows that the rules are learned from.
SAMPLE = 20_000
TREES = 24
DEPTH = 3
#: Rows that one tree sees.
TREE_ROWS = 4000
PENALTY = 0.001
FOLDS, HELD_OUT = 3, 1

#: Statistics that rules test, as SQL over the columns of text_stats.
FEATURES = {
    "words": "n_words",
    "mean_word": "word_chars / greatest(n_words, 1)",
    "longest_word": "max_word",
    "symbols": "n_symbols / greatest(n_words, 1)",
    "punctuation": "n_punct / greatest(n_words, 1)",
    "sentence_ends": "n_ends / greatest(n_words, 1)",
    "exclamations": "n_exclaims / greatest(n_words, 1)",
    "digits": "n_digits / greatest(n_words, 1)",
    "upper": "n_upper / greatest(word_chars, 1)",
    "distinct": "n_distinct / greatest(n_words, 1)",
    "repeated": "n_repeat_words / greatest(n_words, 1)",
    "same_next": "n_same_next / greatest(n_words, 1)",
    "duplicate_lines": "n_dup_lines / greatest(n_lines, 1)",
    "words_per_line": "n_words / greatest(n_lines, 1)",
}

#: A condition: (feature, whether the value is to be above, threshold).
Rule = tuple[tuple[int, bool, float], ...]


def _split(x: np.ndarray, target: np.ndarray, features: np.ndarray, least: int) -> tuple[int, float] | None:
    """The feature and threshold that lower the squared error most."""
    best, found = 1e-9, None
    whole = target.sum() ** 2 / len(target)
    for f in features:
        order = np.argsort(x[:, f], kind="stable")
        v, t = x[order, f], np.cumsum(target[order])
        cut = np.flatnonzero(v[1:] > v[:-1]) + 1
        cut = cut[(cut >= least) & (cut <= len(v) - least)]
        if len(cut):
            gain = t[cut - 1] ** 2 / cut + (t[-1] - t[cut - 1]) ** 2 / (len(v) - cut) - whole
            if gain[k := int(gain.argmax())] > best:
                best, found = gain[k], (int(f), float((v[cut[k] - 1] + v[cut[k]]) / 2))
    return found


def _grow(x, target, rows, rng, path: Rule, depth: int, rules: list[Rule], out: np.ndarray, rate: float) -> None:
    """Grow below a node: add the rules of its children, and the leaves' means to out."""
    features = rng.permutation(x.shape[1])[: max(2, x.shape[1] // 2)]
    found = _split(x[rows], target[rows], features, max(5, len(rows) // 200)) if depth else None
    if found is None:
        step = rate * target[rows].mean() if len(rows) else 0.0
        out[holds(x, path)] += step
        return
    f, at = found
    for above in (False, True):
        rules.append((*path, (f, above, at)))
        _grow(x, target, rows[(x[rows, f] > at) == above], rng, rules[-1], depth - 1, rules, out, rate)


def holds(x: np.ndarray, rule: Rule) -> np.ndarray:
    out = np.ones(len(x), bool)
    for f, above, at in rule:
        out &= (x[:, f] > at) == above
    return out


def grow_rules(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, seed: int = 7) -> list[Rule]:
    rng = np.random.default_rng(seed)
    score, rules = np.full(len(x), np.log(y.mean() / (1 - y.mean()))), []
    for _ in range(trees):
        rows = rng.permutation(len(x))[:TREE_ROWS]
        _grow(x, y - 1 / (1 + np.exp(-score)), rows, rng, (), depth, rules, score, 2.0)
    unique: dict[bytes, Rule] = {}
    for rule in rules:
        hit = holds(x, rule)
        if 0 < hit.sum() < len(x):
            unique.setdefault(np.packbits(hit).tobytes(), rule)
    return list(unique.values())


def lasso_logistic(z: np.ndarray, y: np.ndarray, penalty: float = PENALTY, steps: int = 300) -> tuple[float, np.ndarray]:
    """Intercept and weights, by accelerated proximal gradient steps."""
    n, m = z.shape
    lip = 0.25 * np.linalg.norm(np.c_[np.ones(n), z], 2) ** 2 / n
    w = v = np.r_[np.log(y.mean() / (1 - y.mean())), np.zeros(m)]
    t = 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(v[0] + z @ v[1:])))
        grad = np.r_[(p - y).mean(), z.T @ (p - y) / n]
        new = v - grad / lip
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - penalty / lip, 0)
        t, s = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        v, w = new + (s - 1) / t * (new - w), new
    return float(w[0]), w[1:]


def learn(x: np.ndarray, y: np.ndarray) -> tuple[float, list[tuple[Rule, float]]]:
    """Intercept and weighted rules. x: statistics in the order of FEATURES; y: 0 or 1."""
    if len(y) == 0 or y.min() == y.max():
        share = y.mean() if len(y) else 0.5
        return float(np.clip(np.log((share + 1e-6) / (1 - share + 1e-6)), -6, 6)), []
    rules = grow_rules(x, y)
    z = np.stack([holds(x, r) for r in rules], axis=1).astype(float)
    scale = np.maximum(z.std(axis=0), 0.05)
    intercept, weights = lasso_logistic(z / scale, y)
    return intercept, [(r, float(w / s)) for r, w, s in zip(rules, weights, scale) if w]


def compiled(intercept: float, rules: list[tuple[Rule, float]]) -> Column:
    """The score as a column over the features."""
    names = list(FEATURES)
    total = F.lit(intercept)
    for rule, weight in rules:
        tests = [f"{names[f]} {'>' if above else '<='} {at!r}D" for f, above, at in rule]
        total = total + F.when(F.expr(" AND ".join(tests)), F.lit(weight)).otherwise(F.lit(0.0))
    return 1 / (1 + F.exp(-total))


def with_features(stats: DataFrame) -> DataFrame:
    return stats.select("doc_id", *[F.expr(f"cast({e} AS double)").alias(n) for n, e in FEATURES.items()])


def fold(folds: int, one: int) -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == one, F.lit(False))


def score(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = FOLDS, held_out: int = HELD_OUT, sample: int = SAMPLE) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    stats = staged(with_features(text_stats(docs, {"doc_id": "long"})), "classifier-stats")
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("double").alias("y")).dropna()
    drawn = (
        known.filter(~fold(folds, held_out)).orderBy(F.xxhash64("doc_id", F.lit("draw")), "doc_id", "y").limit(sample)
    )
    rows = stats.join(F.broadcast(drawn), "doc_id").orderBy("doc_id", *FEATURES).select(*FEATURES, "y").limit(2 * sample)
    seen = np.array(rows.collect(), float).reshape(-1, len(FEATURES) + 1)
    intercept, rules = learn(seen[:, :-1], seen[:, -1])
    scored = stats.select("doc_id", fold(folds, held_out).alias("held_out"), compiled(intercept, rules).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op3_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
