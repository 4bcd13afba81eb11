import hashlib
import random
import zlib
from collections import Counter, defaultdict

import helpers
import numpy as np
import pytest
import xxhash
from ringfold.llm import graph, packing, simhash, substrings


def brute_fingerprint(text, width=4):
    w = helpers.words((text or "").translate(helpers.LOWER))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + width]) for i in range(len(w) - width + 1)] or [" ".join(w)]
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def groups(fps, most=4):
    """Component of each fingerprint by brute force."""
    label = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= most:
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    return label


def test_near_duplicates(spark):
    rows = helpers.corpus()
    got = simhash.near_duplicates(helpers.frame(spark)).collect()
    fps = [brute_fingerprint(r[1]) for r in rows]
    label = groups(fps)
    least = defaultdict(lambda: None)
    for r, c in zip(rows, label):
        if r[0] is not None and (least[c] is None or r[0] < least[c]):
            least[c] = r[0]
    want = Counter((r[0], f, least[c]) for r, f, c in zip(rows, fps, label))
    assert Counter((r.doc_id, r.fp % 2**64, r.component_id) for r in got) == want
    kept = simhash.keep_one(helpers.frame(spark))
    assert kept.columns == helpers.frame(spark).columns
    assert kept.count() == len(set(label))  # of repeated rows one stays too


def test_links_across_blocks(spark):
    rng = random.Random(3)
    centres = [rng.getrandbits(64) for _ in range(40)]
    fps = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(7))) for c in centres for _ in range(12)}
    fps = sorted(fps)
    nodes = spark.createDataFrame([(f - 2**64 if f >= 2**63 else f,) for f in fps], "fp long")
    label = groups(fps)
    for block, parts in ((1024, None), (7, 6), (1024, 8), (50, 10)):
        found = graph.components(simhash.links(nodes, block=block, parts=parts))
        got = {r.node % 2**64: r.label for r in found.collect()}
        own = defaultdict(set)
        for f, c in zip(fps, label):
            own[c].add(got.get(f, f"alone {f}"))
        assert all(len(x) == 1 for x in own.values())
        assert len({next(iter(x)) for x in own.values()}) == len(own)


def test_manhattan_is_a_lower_bound(spark):
    rng = random.Random(5)
    pairs = [(rng.getrandbits(63), rng.getrandbits(63)) for _ in range(200)]
    from pyspark.sql import functions as F

    df = spark.createDataFrame(pairs, "a long, b long").select("a", "b", simhash.unary("a").alias("ua"), simhash.unary("b").alias("ub"))
    for r in df.collect():
        manhattan = sum(abs((r.a >> i & 3).bit_count() - (r.b >> i & 3).bit_count()) for i in range(0, 64, 2))
        assert ((r.ua ^ r.ub) % 2**64).bit_count() == manhattan <= ((r.a ^ r.b) % 2**64).bit_count()
    assert F is not None


def test_components_of_a_path(spark):
    n = 300
    edges = [(i, i + 1) for i in range(n)] + [(1000, 1001), (5, 5)]
    got = {r.node: r.label for r in graph.components(spark.createDataFrame(edges, "x long, y long")).collect()}
    assert got == {i: 0 for i in range(n + 1)} | {1000: 1000, 1001: 1000}
    assert graph.components(spark.createDataFrame([], "x long, y long")).collect() == []


def test_near_duplicates_of_nothing(spark):
    assert simhash.near_duplicates(helpers.frame(spark, [])).collect() == []


def check_packing(got, rows, capacity):
    import public_tokenizers
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    want = Counter()
    for r in rows:
        ids = np.array([*whole.encode(r[1] or "", add_special_tokens=False).ids, 0], "<u4")
        for k, s in enumerate(range(0, len(ids), capacity)):
            part = ids[s : s + capacity]
            want[r[0], k, s, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by), -(-sum(r.length for r in got) // capacity)


def test_packing(spark):
    rows = helpers.corpus() + [
        (90 + i, t, None, None, 0, 0, "", "")
        for i, t in enumerate(["It's <|endoftext|> here", "a b　c \x1cd", "İstanbul ΣΑΣ éx", "don't 1234 ½ €5 ––", "x" * 500, "日本語 テキスト"])
    ]
    for capacity in (64, 2048):
        used, least = check_packing(packing.best_fit(helpers.frame(spark, rows), capacity=capacity).collect(), rows, capacity)
        assert used <= least + 2
    assert packing.best_fit(helpers.frame(spark, [])).collect() == []


def test_ids_of_odd_words_and_of_a_small_cache(monkeypatch):
    import public_tokenizers
    import pyarrow as pa

    rng = random.Random(6)
    letters = "aAzZ09'’sStTrRvVeEmMlLdD.,;!<>|&×÷ÀÉßÿþÞªº²½éñ-_ 日İς\t"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(600)] + ["é" * 3000, "'s", "it's", "<|endoftext|>", "", " "]
    for most in (1 << 19, 50):
        monkeypatch.setattr(packing, "CACHE_PIECES", most)
        encoder = packing.WordEncoder(public_tokenizers.path(packing.TOKENIZER))
        for k in range(0, len(texts), 100):
            own = texts[k : k + 100]
            ids, bounds = encoder.texts(pa.array(own))
            want = [encoder.whole.encode(t, add_special_tokens=False).ids for t in own]
            assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == want
    assert encoder.texts(pa.array([], pa.string()))[1].tolist() == [0]


def test_pieces_are_merged_once():
    """Words are many, their pieces few: case and punctuation make new words but no new merges."""
    import public_tokenizers
    import pyarrow as pa

    encoder = packing.WordEncoder(public_tokenizers.path(packing.TOKENIZER))
    asked = []
    for holder in (encoder, getattr(encoder, "pieces", encoder)):
        if hasattr(holder, "merge"):
            holder.merge = lambda p, merge=holder.merge: asked.append(p) or merge(p)
    real, words = encoder.word, []
    encoder.word = lambda w: words.append(w) or real(w)
    encoder.texts(pa.array([f"{a} {a.upper()} {a}, {a}; {a}.{b}" for a in ("alpha", "beta", "gamma") for b in ("one", "two")]))
    assert sorted(asked) == sorted(["alpha", "beta", "gamma", "one", "two", ",", ";", "."]) and not words


def test_supersteps_are_not_compiled(spark, monkeypatch):
    key, seen, real = "spark.sql.codegen.wholeStage", [], packing.sweep
    monkeypatch.setattr(packing, "sweep", lambda *a: seen.append(spark.conf.get(key)) or real(*a))
    before = spark.conf.get(key)
    packing.pack(spark.createDataFrame([(i, 3 + i % 5) for i in range(20)], "doc_id long, length long"), 8)
    assert seen and set(seen) == {"false"} and spark.conf.get(key) == before


def one_at_a_time(lengths, capacity):
    """Sequences of best fit, largest first, each piece into the fullest sequence that holds it."""
    from bisect import bisect_left, insort

    gaps, used = [], 0
    for n in sorted(lengths, reverse=True):
        if (k := bisect_left(gaps, n)) < len(gaps):
            gap = gaps.pop(k)
        else:
            gap, used = capacity, used + 1
        insort(gaps, gap - n)
    return used


@pytest.mark.parametrize("kind", ["mixed", "equal", "third", "long", "short", "two"])
def test_packing_of_many_lengths(spark, kind):
    rng = random.Random(kind)
    n, capacity = 3000, 256
    make = {
        "mixed": lambda: min(capacity, 1 + int(rng.lognormvariate(3.5, 1.2))), "equal": lambda: 70, "third": lambda: 100 if rng.random() < 0.4 else rng.randrange(1, 257),
        "long": lambda: rng.randrange(90, 257), "short": lambda: rng.randrange(1, 9), "two": lambda: rng.choice([129, 127]),
    }[kind]
    lengths = [make() for _ in range(n)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lengths)], "doc_id long, length long")
    got = packing.pack(df, capacity).collect()
    assert Counter((r.doc_id, r.length) for r in got) == Counter(enumerate(lengths))
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    least = max(-(-sum(lengths) // capacity), sum(x > capacity / 2 for x in lengths))
    assert least <= len(by) <= 1.01 * one_at_a_time(lengths, capacity) + 1


def brute_repeats(rows, width):
    seen = Counter()
    for r in rows:
        w = helpers.words(r[1])
        seen.update(tuple(w[i : i + width]) for i in range(len(w) - width + 1))
    out = Counter()
    for r in rows:
        w = helpers.words(r[1])
        gone = set()
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                gone.update(range(i, i + width))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out[r[0], len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return out


@pytest.mark.parametrize(("width", "bits", "shard"), [(35, 20, 10**6), (35, 10, 200), (12, 16, 500)])
def test_substrings(spark, width, bits, shard):
    rng = random.Random(9)
    passage = [helpers.prose(n, 50 + n) for n in (34, 35, 36, 60, 300)]
    rows = helpers.corpus()
    for i in range(40):
        parts = [rng.choice(passage) if rng.random() < 0.4 else helpers.prose(rng.randrange(60), 100 + 10 * i + k, 5000) for k in range(5)]
        rows.append((200 + i, "  ".join(parts), None, None, 0, 0, "", ""))
    got = substrings.drop_repeats(helpers.frame(spark, rows), width=width, bits=bits, shard_words=shard)
    assert Counter(tuple(r) for r in got.collect()) == brute_repeats(rows, width)


def test_substrings_of_nothing(spark):
    assert substrings.drop_repeats(helpers.frame(spark, []), bits=10).collect() == []
    few = [(i, helpers.prose(20, i), None, None, 0, 0, "", "") for i in range(3)]
    assert {r.n_removed for r in substrings.drop_repeats(helpers.frame(spark, few)).collect()} == {0}


def test_only_the_automata_find_places():
    """One passage is known; its occurrences in other texts come from the automaton's hits alone."""
    import ahocorasick
    import pyarrow as pa
    from ringfold.llm.words import coded, hashed, mixed, rolling

    passage = helpers.prose(40, 1, 10**6)
    texts = [passage, f"x y {passage} z", helpers.prose(80, 2, 10**6), f"{passage} {passage}"]
    words, code, bounds = coded(pa.array(texts))
    h = hashed(words)[code]
    anchors = mixed(rolling(h, 8, substrings.BASES[0]))[10:11]  # a phrase that all its windows hold
    at = substrings.locate(code, bounds, h, 1, anchors, 35, 8)
    want = [bounds[1] + 2 + k for k in range(6)] + [bounds[3] + k for k in range(6)] + [bounds[3] + 40 + k for k in range(6)]
    assert at.tolist() == want
    real = ahocorasick.Automaton

    class Deaf:
        def __init__(self, *a):
            self.of = real(*a)

        def __getattr__(self, name):
            return getattr(self.of, name)

        def iter(self, *a):
            return iter(())

    ahocorasick.Automaton = Deaf
    try:
        assert substrings.locate(code, bounds, h, 1, anchors, 35, 8).tolist() == []
    finally:
        ahocorasick.Automaton = real
