import hashlib
from collections import Counter, defaultdict

import helpers
import pytest
from pyspark.sql import functions as F
from ringfold.llm import exact_dedup, mixing


def expected(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1] or ""].append(r[0])
    out = Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        for k, i in enumerate(sorted(ids, key=lambda i: (i is not None, i or 0), reverse=True)):
            out[i, keep, len(ids), k == 0, sha] += 1
    return out


@pytest.mark.parametrize("key", [exact_dedup.sha256, lambda text: F.encode(F.substring(text, 1, 3), "UTF-8")])
def test_exact_dedup(spark, key):
    found = exact_dedup.exact_dedup(helpers.frame(spark).repartition(3), key=key, max_files_per_trigger=1)
    got = Counter(tuple(r) for r in found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect())
    assert got == expected(helpers.corpus())


def test_exact_dedup_of_nothing(spark):
    assert exact_dedup.exact_dedup(helpers.frame(spark, [])).collect() == []


def test_keep_last(spark):
    docs = helpers.frame(spark)
    got = exact_dedup.keep_last(docs)
    assert got.columns == docs.columns
    texts = Counter(r["text"] or "" for r in got.collect())
    assert texts == Counter({t: 1 for t in {r[1] or "" for r in helpers.corpus()}})
    repeated = [(5, "a b", "en", "s", 3, 1, "", "")] * 3
    assert len(exact_dedup.keep_last(helpers.frame(spark, repeated)).collect()) == 1


def fill(sizes, weights, most=3):
    """Targets by repeated resharing."""
    target = dict.fromkeys(sizes, 0.0)
    open_, left = dict(weights), float(sum(sizes.values()))
    while open_ and left > 1e-9:
        share = {s: left * w / sum(open_.values()) for s, w in open_.items()}
        left = 0.0
        for s, x in share.items():
            target[s] += x
            if target[s] > most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = float(most * sizes[s])
                del open_[s]
    return target


def test_mixing(spark):
    rows = helpers.corpus()
    got = mixing.mix(helpers.frame(spark)).collect()
    size = Counter()
    for r in rows:
        size[r[3]] += len(helpers.words(r[1]))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    target = fill(size, {s: 1 + i % 3 for i, s in enumerate(order)})
    taken = Counter()
    for r in got:
        assert r.source_size == size[r.source] and r.target == pytest.approx(target[r.source], rel=1e-12)
        assert r.taken <= 3 * r["size"]
        taken[r.source] += r.taken
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in size)
    assert Counter((r.doc_id, r["size"]) for r in got) == Counter((r[0], len(helpers.words(r[1]))) for r in rows)
    again = Counter((r.doc_id, r.taken) for r in mixing.mix(helpers.frame(spark).repartition(5)).collect())
    assert again == Counter((r.doc_id, r.taken) for r in got)


def test_mixing_of_nothing(spark):
    assert mixing.mix(helpers.frame(spark, [])).collect() == []
    assert [r.taken for r in mixing.mix(helpers.frame(spark, [(1, None, None, None, 0, 0, "", "")])).collect()] == [0]


def test_mixed_documents(spark):
    docs = helpers.frame(spark)
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    took = Counter()
    for r in mixing.mix(docs).collect():
        took[r.source] += r.taken
    got = Counter()
    for r in out.collect():
        got[r.source] += len(helpers.words(r.text))
    assert {s: n for s, n in took.items() if n} == dict(got)
    whole = {r[1] for r in helpers.corpus()}
    cut = [r.text for r in out.collect() if r.text not in whole]
    assert len(cut) <= len(took) and all(any((w or "").startswith(c) for w in whole) for c in cut)


@pytest.mark.parametrize("name", ["op1_mixing", "op10_exact_dedup"])
def test_oracle(spark, duck, data, name):
    from ringfold.llm import registry

    got = registry.QUERIES[name](spark, data)
    want = duck.sql(registry.ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(got.columns)
    want = want.df()[cols]
    assert Counter(map(str, map(tuple, got.select(*cols).toPandas().itertuples(index=False)))) == Counter(map(str, map(tuple, want.itertuples(index=False))))
