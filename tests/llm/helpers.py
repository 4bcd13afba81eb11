"""Brute-force versions that the tests compare the operators with."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key long, row string, size string"


def words(text):
    return WORD.findall(text or "")


def prose(n, seed, vocabulary=400):
    import random

    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def corpus():
    """Documents with nulls, empty, very long and repeated texts, ties, and columns with clashing names."""
    base = prose(300, 1)
    near = base.split()
    near[150] = "changed"
    texts = [
        base, base, " ".join(near), None, "", " \t\n", "one", "two words here now", prose(80, 2) + "\n" + prose(80, 3),
        prose(60, 4), "Ünïcode wörds " + prose(60, 5), prose(20_000, 6, 5000), base + " " + prose(40, 7),
        "!!! ### " * 40, "same " * 200, prose(70, 8),
    ]
    rows = [(i, t, ["en", "de", None][i % 3], ["a", "b", None, "c"][i % 4], len(t or ""), 7, "x", "y") for i, t in enumerate(texts)]
    rows.append((0, base, "en", "a", len(base), 7, "x", "y"))  # a repeated row
    rows.append((None, base, "en", "a", len(base), None, None, None))
    rows.append((None, prose(90, 9), None, None, None, None, None, None))
    return rows


def frame(spark, rows=None):
    return spark.createDataFrame(corpus() if rows is None else rows, SCHEMA)
