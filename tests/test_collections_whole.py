"""List, set and map queries over events beyond the first 2,000, against plain Python."""

from collections import Counter, defaultdict

KINDS = ("click", "view", "error", "buy")


def test_all_events_are_read(spark, tmp_path):
    from ringfold.plans import catalogue

    rows = [(i, i % 7 if i < 2000 else i % 11, KINDS[i * i % 5 % 4]) for i in range(2600)]
    spark.createDataFrame(rows, "event_id long, user_id long, event_type string").write.parquet(f"{tmp_path}/events.parquet")
    of = defaultdict(list)
    for _, user, kind in rows:
        of[user].append(kind)
    lists, sets, maps = set(), set(), set()
    for user, xs in of.items():
        xs.sort()
        rest = [x for x in xs if x not in ("click", "view")]
        lists.add((user, ",".join([*xs, "z", "z"]), ",".join(["a", "b", *xs]), ",".join(rest) or None))
        sets.add((user, ",".join(sorted({*xs, "z", "click"})), ",".join(sorted(set(rest))) or None))
        n = Counter(xs)
        shown = lambda m: ",".join(f"{k}={v}" for k, v in sorted(m.items()))
        maps.add((user, shown(n | {"click": 0, "new": 1}), shown({k: v for k, v in n.items() if k != "view"})))
    for name, want in (("list_ops_all", lists), ("set_ops_all", sets), ("map_ops_all", maps)):
        got = [tuple(r) for r in catalogue.QUERIES[name](spark, str(tmp_path)).collect()]
        assert len(got) == len(want) == 11 and set(got) == want
