from collections import Counter

import corpus_pipeline
import helpers
from ringfold.llm.common import staged
from test_exact_and_mixing import fill
from test_simhash_packing_substrings import brute_fingerprint, check_packing, groups


def stages(spark, docs):
    out = [docs]
    for name, f in corpus_pipeline.STAGES:
        out.append(staged(f(spark, out[-1], ""), f"test-{name}"))
    return out


def rows_of(df):
    return [tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]


def test_stages_against_brute_force(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    first, ruled, exact, near, mixed, packed = stages(spark, docs)
    for df in (ruled, exact, near, mixed):
        assert df.columns == docs.columns
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{data}/labels.parquet").collect()}
    ids = {r.doc_id for r in ruled.collect()}
    for r in rows_of(first):
        if truth.get(r[0]) == 1 and len(helpers.words(r[1])) >= 50:
            assert r[0] in ids
        if truth.get(r[0]) == 0:
            assert r[0] not in ids
    best = {}
    for r in rows_of(ruled):
        best[r[1]] = max(r, best.get(r[1], r))
    assert Counter(rows_of(exact)) == Counter(best.values())
    rows = sorted(rows_of(exact))
    label = groups([brute_fingerprint(r[1]) for r in rows])
    assert Counter(rows_of(near)) == Counter({c: r for r, c in zip(reversed(rows), reversed(label))}.values())
    size, taken = Counter(), Counter()
    for r in rows_of(near):
        size[r[3]] += len(helpers.words(r[1]))
    for r in rows_of(mixed):
        taken[r[3]] += len(helpers.words(r[1]))
    target = fill(size, {s: 1 + i % 3 for i, s in enumerate(sorted(size))})
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in size)
    used, least = check_packing(packed.collect(), rows_of(mixed), 2048)
    assert used <= 1.02 * least + 2


def test_stages_on_edge_cases(spark):
    *_, packed = stages(spark, helpers.frame(spark))
    assert packed.count() > 0
    *_, packed = stages(spark, helpers.frame(spark, []))
    assert packed.collect() == []


def test_run(spark, data):
    assert corpus_pipeline.run(spark, data).columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
