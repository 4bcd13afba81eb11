import csv
import datetime
import json
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T
from ringfold import catalog, errors, ranges, types
from ringfold.functions import collections as C
from ringfold.functions import text as X
from ringfold.functions.tokens import native, portable
from ringfold.operators import bulk, mutations, paging, sensors, telemetry
from ringfold.ranges import Ring, TokenRange
from ringfold.sinks import export, render, snapshots
from ringfold.sources import files, ring

SMALL = Ring(-50, 49)


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(-50, 49), min_size=1, max_size=12), st.integers(1, 40))
def test_ranges_cover_the_ring_once(tokens, target):
    found = ranges.discover({t: ("a",) for t in tokens}, SMALL)
    assert ranges.covers(found, SMALL) and sum(r.fraction(SMALL) for r in found) == pytest.approx(1)
    parts = ranges.split_proportionally(found, target, SMALL)
    assert ranges.covers(parts, SMALL)
    for t in range(-50, 50):
        assert sum(p.contains(t) for p in parts) == 1


def test_ranges_of_the_full_ring():
    one = ranges.discover({7: ("x",)})
    assert one[0].size() == 2**64 and len(ranges.split(one[0], 8)) == 8 and ranges.covers(ranges.split(one[0], 8))
    assert ranges.covers(ranges.whole(16, ranges.PORTABLE), ranges.PORTABLE) and ranges.covers(ranges.whole(1))
    assert not ranges.covers([TokenRange(0, 10), TokenRange(5, 0)])
    assert ranges.by_replicas([TokenRange(0, 1, ("b", "a")), TokenRange(1, 2, ("a", "b"))]) == {("a", "b"): [TokenRange(0, 1, ("b", "a")), TokenRange(1, 2, ("a", "b"))]}
    assert ranges.predicate(TokenRange(-(2**63), 5)) == f"(token >= {-(2**63)} AND token <= 5)"
    assert ranges.predicate(TokenRange(9, 5)) == "(token > 9 OR token <= 5)"
    with pytest.raises(errors.ConfigError):
        ranges.predicate(TokenRange(1, 2), "token; DROP")
    with pytest.raises(errors.ConfigError):
        ranges.discover({})


def test_counts(spark, data):
    orders = catalog.table(spark, data, "orders")
    n = orders.count()
    parts = ranges.whole(7, ranges.FULL)
    assert bulk.count_ranges(orders, native("o_orderkey"), parts) == n
    for k in (1, 3, 16):
        assert bulk.count_by_range(orders, portable("o_orderkey"), k).agg(F.sum("n")).first()[0] == n
    with pytest.raises(errors.BulkError) as e:
        bulk.count_ranges(orders, F.col("no_such_column"), parts)
    assert e.value.failed


def test_types():
    assert types.spark_type("map<frozen<map<text, int>>, frozen<list<int>>>").simpleString() == "map<map<string,int>,array<int>>"
    assert types.spark_type("tuple<text, int, boolean>").simpleString() == "struct<_0:string,_1:int,_2:boolean>"
    assert types.spark_type("address", {"address": T.StructType([T.StructField("street", T.StringType())])}).simpleString() == "struct<street:string>"
    assert types.spark_type("unknown_type") == T.StringType()
    schema = types.spark_schema({"id": "uuid", "hits": "counter"}, ("id",))
    assert not schema["id"].nullable and schema["hits"].metadata == {"counter": True}
    for bad in ("list<int", "list<int>>", "map<int>", "list<a,b>"):
        with pytest.raises(errors.ConfigError):
            types.spark_type(bad)


def test_empty_collections_are_null(spark):
    df = spark.createDataFrame([([], {}, ["b", "a", "b"]), (None, {"x": 1}, [])], "xs array<string>, m map<string,int>, s array<string>")
    assert [tuple(r) for r in types.normalised(df, ("s",)).collect()] == [(None, None, ["a", "b"]), (None, {"x": 1}, None)]


def test_collection_updates(spark):
    df = spark.createDataFrame([(["a", "b", "a"], {"k": 1})], "xs array<string>, m map<string,int>")
    a = lambda *x: F.array(*map(F.lit, x))
    r = df.select(
        C.list_remove(F.col("xs"), a("a")).alias("l"), C.list_remove(F.col("xs"), a("a", "b")).alias("e"), C.set_add(F.col("xs"), a("c")).alias("s"),
        C.map_put(F.col("m"), F.lit("k"), F.lit(2)).alias("p"), C.map_delete(F.col("m"), F.lit("k")).alias("d"),
    ).first()
    assert (r.l, r.e, r.s, r.p, r.d) == (["b"], None, ["a", "b", "c"], {"k": 2}, None)


def test_pages(spark):
    df = spark.range(2500).repartition(3)
    seen = []
    got = paging.PagedResult(df, paging.StreamConfig(1000, page_callback=lambda p, n: seen.append((p, n))))
    pages = list(got.pages())
    assert [len(p) for p in pages] == [1000, 1000, 500] and seen == [(1, 1000), (2, 1000), (3, 500)]
    assert sorted(r.id for p in pages for r in p) == list(range(2500))
    assert sum(1 for _ in paging.PagedResult(df, paging.StreamConfig(100, max_pages=3))) == 300
    assert sum(1 for _ in paging.PagedResult(df, paging.StreamConfig(1000, max_pages=0))) == 2500
    empty = paging.PagedResult(df.limit(0))
    assert list(empty) == [] and empty.schema.names == ["id"]

    def broken(page, rows):
        raise RuntimeError("ignored")

    assert len(list(paging.PagedResult(df, paging.StreamConfig(2000, page_callback=broken)).pages())) == 2
    with paging.PagedResult(df) as one:
        next(one.pages())
    one.close()
    assert one.closed
    with pytest.raises(errors.ConfigError):
        paging.StreamConfig(0)


def test_timeout(spark):
    slow = spark.range(4).select(F.expr("java_method('java.lang.Thread', 'sleep', 3000L + id)").alias("x"))
    with pytest.raises(errors.QueryTimeout):
        list(paging.PagedResult(slow, paging.StreamConfig(timeout_seconds=0.5)))


def test_cursors_walk_a_table_once(spark, data):
    part, after, seen = catalog.table(spark, data, "part").select("p_partkey"), None, []
    while True:
        rows = paging.cursor_page(part, portable("p_partkey"), after, 70).collect()
        seen += [r.p_partkey for r in rows]
        if not rows[-1].has_next:
            break
        after = int(spark.range(1).select(X.from_cursor(F.lit(rows[-1].next_cursor))).first()[0])
    assert sorted(seen) == sorted(r.p_partkey for r in part.collect())


def values(spark):
    schema = "i int, b boolean, x binary, t timestamp_ntz, d decimal(10,2), xs array<string>, m map<int,string>, s string"
    return spark.createDataFrame(
        [(1, True, bytearray(b"\x01\xff"), datetime.datetime(2024, 1, 2, 3, 4, 5), Decimal("1.50"), ["b", "a"], {1: "x"}, 'quote " and, comma'),
         (2, None, None, None, None, None, None, None)], schema,
    ).coalesce(1)


def test_csv(spark, tmp_path):
    path = str(tmp_path / "out")
    render.write_csv(values(spark), path, null_string="NULL", codec=None)
    text = next((tmp_path / "out").glob("*.csv")).read_text()
    rows = list(csv.reader(text.splitlines()))
    assert rows[0] == ["i", "b", "x", "t", "d", "xs", "m", "s"]
    assert rows[1] == ["1", "true", "01ff", "2024-01-02T03:04:05", "1.50", "[b, a]", "{1: x}", 'quote " and, comma']
    assert rows[2] == ["2", *["NULL"] * 7]
    with pytest.raises(errors.ConfigError):
        render.write_csv(values(spark), path, codec="zip")


def test_json(spark, tmp_path):
    want = [
        {"i": 1, "b": True, "x": "Af8=", "t": "2024-01-02T03:04:05", "d": 1.5, "xs": ["a", "b"], "m": {"1": "x"}, "s": 'quote " and, comma'},
        {"i": 2, **dict.fromkeys(["b", "x", "t", "d", "xs", "m", "s"])},
    ]
    path = str(tmp_path / "a.json")
    assert render.write_json_array(values(spark), path, sets=("xs",)) == 2
    assert json.load(open(path)) == want
    assert render.write_json_array(values(spark).limit(0), path) == 0 and json.load(open(path)) == []
    render.write_jsonl(values(spark), str(tmp_path / "l"), codec="gzip", sets=("xs",))
    assert [json.loads(r.value) for r in spark.read.text(str(tmp_path / "l")).collect()] == want


@pytest.mark.parametrize("codec", ["snappy", "gzip", "lz4", "zstd", "none"])
def test_parquet_codecs(spark, tmp_path, codec):
    render.write_parquet(values(spark), str(tmp_path / "p"), codec=codec, columns=["s", "i", "missing"], where="i = 1")
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "p")).collect()] == [('quote " and, comma', 1, None)]


def test_export_resumes_and_fails_whole(spark, data, tmp_path):
    orders, out = catalog.table(spark, data, "orders"), str(tmp_path / "out")
    calls = []

    def flaky(df, path, **options):
        calls.append(path)
        if len(calls) == 2:
            raise OSError("disk")
        render.write_parquet(df, path, **options)

    export.register_format("flaky", flaky)
    with pytest.raises(errors.BulkError):
        export.export(orders, portable("o_orderkey"), out, "flaky", ranges=8, per_job=2)
    half = export.Progress.load(spark, out)
    assert half.completed == [0, 1] and not half.is_complete and half.percentage == 25 and half.errors
    seen = []
    done = export.export(orders, portable("o_orderkey"), out, "flaky", ranges=8, per_job=2, on_progress=lambda p: seen.append(p.percentage))
    assert done.is_complete and done.rows == orders.count() and seen == [50, 75, 100] and len(calls) == 5
    assert done.rows_per_second > 0
    back = spark.read.parquet(*[f"{out}/{p.name}" for p in (tmp_path / "out").glob("ranges-*")])
    assert back.count() == orders.count() and back.distinct().count() == orders.distinct().count()


def test_snapshots(spark, tmp_path):
    t = snapshots.SnapshotTable(spark, str(tmp_path / "t"))
    with pytest.raises(errors.ConfigError):
        t.read()
    assert t.append(spark.range(5)) == 1 and t.append(spark.range(3)) == 2 and t.overwrite(spark.range(1)) == 3
    assert [t.read(v).count() for v in (1, 2, 3)] == [5, 8, 1] and t.read().count() == 1
    with pytest.raises(errors.ConfigError):
        t.append(spark.range(1).toDF("other"))


def test_mutations(spark):
    log = spark.createDataFrame([("k", 100, 1), ("k", 50, 2), ("k", 200, 3)], "k string, w int, v int")
    assert mutations.last_write_wins(log, "k", ["w"], ["v"]).first().v == 3
    claims = spark.createDataFrame([("r", i, f"o{i}") for i in range(20)], "k string, seq int, owner string")
    won = mutations.insert_if_not_exists(claims, "k", [F.col("seq")], "owner").filter("applied").collect()
    assert [r.owner for r in won] == ["o0"]
    c = spark.createDataFrame([("a", 100), ("a", 50), ("b", -5)], "k string, d long")
    assert {r.k: r.value for r in mutations.counters(c, ["k"], "d").collect()} == {"a": 150, "b": -5}
    with pytest.raises(errors.ConfigError):
        mutations.batch(log, c, counter=[False, True])
    assert mutations.batch(log, log, counter=[False, False]).count() == 6
    many = spark.createDataFrame([("z", i, "insert" if i == 0 else "update", i if i else None, i) for i in range(3000)], "k string, seq int, op string, expected long, value int")
    assert mutations.conditional_fold(many, "k", "seq").filter("applied").count() == 3000


def test_identifiers_and_parameters(spark, data):
    assert catalog.identifier("a_1") == "a_1"
    for bad in ("a b", "x;", "", "a-b"):
        with pytest.raises(errors.ConfigError):
            catalog.identifier(bad)
    df = spark.sql("SELECT * FROM {t} WHERE c_name = :name", args={"name": "x' OR '1'='1"}, t=catalog.table(spark, data, "customer"))
    assert df.count() == 0
    meta = catalog.TABLES["events"]
    one = catalog.clustered(catalog.table(spark, data, "events"), meta, 2).filter("user_id = 3").collect()
    assert [r.ts for r in one] == sorted((r.ts for r in one), reverse=True)


def test_errors_are_wrapped():
    with pytest.raises(errors.QueryError):
        errors.guarded(lambda: 1 / 0)
    with pytest.raises(errors.ConfigError):
        errors.guarded(lambda: catalog.identifier(";"))


def test_text_functions(spark):
    df = spark.range(1).select(
        X.normalised_query(F.lit("  select * from t\n where a = 'x''y' and n = 12  ")).alias("q"),
        X.megabytes_per_second(F.lit(1 << 21), F.lit(2.0)).alias("mb"), X.per_second(F.lit(5), F.lit(0.0)).alias("zero"),
        X.elapsed(F.lit(datetime.datetime(2024, 1, 1)), F.lit(datetime.datetime(2024, 1, 1, 0, 0, 2))).alias("s"),
    )
    assert tuple(df.first()) == ("SELECT * FROM T WHERE A = '?''?' AND N = ?", 1.0, 0.0, 2.0)


def test_alerts_fire_twice(spark):
    df = spark.createDataFrame([(1, 40.0), (2, 20.0)], "id int, v double")
    got = sensors.alerts(df, {"high": F.col("v") > 35, "very": F.col("v") > 39}).select("id", "alert").collect()
    assert sorted(map(tuple, got)) == [(1, "high"), (1, "very")]


def test_rollup_counts_unknown_as_unhealthy(spark):
    df = spark.createDataFrame([("c", True, 2, 0.0), ("c", None, 3, 4.0), ("c", False, 1, None)], "g string, up boolean, n int, ms double")
    r = telemetry.cluster_rollup(df, "g", F.col("up"), F.col("n"), F.col("ms")).first()
    assert (r.healthy, r.unhealthy, r.connections, r.avg_latency) == (1, 2, 6, 4.0)


def test_ring_source_and_storage(spark, data, tmp_path):
    spark.dataSource.register(ring.RingSource)
    got = spark.read.format("ring").option("parts", 5).load()
    assert got.count() == 5 and got.rdd.getNumPartitions() == 5
    path = str(tmp_path / "ring")
    orders = catalog.table(spark, data, "orders")
    ring.write_ring(orders, "o_orderkey", 8, path)
    assert ring.read_ring(spark, path).count() == orders.count()
    part = ring.read_ring(spark, path, [1, 2])
    assert "PartitionFilters: [range_id" in part._jdf.queryExecution().executedPlan().toString() and 0 < part.count() < orders.count()


def test_files_need_declared_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,v\n1,x\n2,\n")
    rows = files.load(spark, str(tmp_path / "a.csv"), "csv", {"id": "int", "v": "text"})
    assert [tuple(r) for r in rows.collect()] == [(1, "x"), (2, None)]
    with pytest.raises(errors.ConfigError):
        files.load(spark, "x", "xml", {})


def test_stream_equals_batch_over_many_files(spark, data, tmp_path):
    from ringfold.streaming.stateful import sensor_windows, trimmed
    from ringfold.streaming.windows import window_counts

    events = catalog.table(spark, data, "events")
    path = str(tmp_path / "events")
    events.repartition(3).write.parquet(path)
    assert window_counts(spark, path).agg(F.sum("n")).first()[0] == events.count()
    got = {r.user_id: (r.n, r.avg_value) for r in sensor_windows(spark, path, 20, 6 * 3600.0).collect()}
    by = {}
    for r in events.collect():
        by.setdefault(r.user_id, []).append((r.ts.replace(tzinfo=datetime.timezone.utc).timestamp(), r.value))
    for user, rows in by.items():
        _, v = trimmed([r[0] for r in rows], [r[1] for r in rows], 20, 6 * 3600.0)
        assert got[user] == (len(v), pytest.approx(sum(v) / len(v), abs=1e-3))


def test_engine(spark, data):
    from ringfold.engine import Engine, MetricsCollector, RecentMetrics

    class Broken(MetricsCollector):
        def record(self, one):
            raise RuntimeError("ignored")

    seen = RecentMetrics(3)
    with Engine(spark, data, collectors=(Broken(), seen)) as engine:
        n = engine.one("SELECT count(*) AS n FROM nation").n
        assert n == 25 == len(engine.execute("SELECT * FROM nation"))
        by_region = engine.prepare("SELECT n_name FROM nation WHERE n_regionkey = :r ORDER BY n_name")
        assert by_region(r=1).count() == 5
        assert engine.execute("SELECT * FROM nation WHERE n_nationkey = ?", [3])[0].n_nationkey == 3
        assert engine.one("SELECT * FROM nation WHERE n_nationkey < 0") is None
        assert sum(len(p) for p in engine.stream("SELECT * FROM orders", config=paging.StreamConfig(400)).pages()) == 1500
        with pytest.raises(Exception):
            engine.execute("SELECT no_such_column FROM nation")
        assert len(seen.rows) == 3 and not seen.rows[-1].success and seen.rows[-1].error_type == "AnalysisException"
        got = seen.frame(spark).select("query_hash", "success").collect()
        assert len(got) == 3 and all(len(r.query_hash) == 12 for r in got)
    with pytest.raises(errors.ConfigError):
        engine.execute("SELECT 1")


def test_a_range_that_fails_at_run_time_is_named(spark):
    rows = spark.range(1000).withColumn("k", F.when(F.col("id") == 700, F.raise_error(F.lit("bad"))).otherwise(F.col("id")).cast("long"))
    parts = [TokenRange(-1, 499), TokenRange(499, 999)]
    bad = F.when(F.col("id") > 499, F.col("k")).otherwise(F.col("id"))
    with pytest.raises(errors.BulkError) as e:
        bulk.count_ranges(rows, bad, parts)
    assert set(e.value.failed) == {0, 1}  # the token of the row is asked for by both
    odd = spark.range(1000).withColumn("k", F.col("id"))
    assert bulk.count_ranges(odd, F.col("k"), parts) == 1000
    assert bulk.count_ranges(odd, F.col("k"), [TokenRange(i - 1, i) for i in range(150)]) == 150


def test_a_read_leaves_the_threads_job_group(spark):
    context = spark.sparkContext
    context.setJobGroup("mine", "work")
    try:
        for page in paging.PagedResult(spark.range(30), paging.StreamConfig(10)).pages():
            assert len(page) == 10 and context.getLocalProperty("spark.jobGroup.id") == "mine"
        assert context.getLocalProperty("spark.jobGroup.id") == "mine" and context.getLocalProperty("spark.job.description") == "work"
    finally:
        for name in ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel"):
            context.setLocalProperty(name, None)


def test_appends_at_once_lose_nothing(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    from ringfold.sinks.snapshots import SnapshotTable

    with ThreadPoolExecutor(4) as pool:
        got = list(pool.map(lambda k: SnapshotTable(spark, str(tmp_path / "t")).append(spark.range(10 * k, 10 * k + 10)), range(4)))
    assert sorted(got) == [1, 2, 3, 4]
    table = SnapshotTable(spark, str(tmp_path / "t"))
    assert sorted(r.id for r in table.read().collect()) == list(range(40)) and table.read(2).count() == 20


def test_clusters_need_a_shared_folder(spark):
    from types import SimpleNamespace

    from ringfold.sinks.scratch import shared_path

    conf = SimpleNamespace(getConf=lambda: {}, master="spark://host:7077")
    with pytest.raises(errors.ConfigError):
        shared_path(SimpleNamespace(sparkContext=conf), "x")



@pytest.mark.parametrize("values", [[], [5.0], [1.0, 2.0], [3.0] * 7 + [None], [float(v * v % 97) for v in range(500)], [1e-9, 1e9, None, -4.0]])
def test_percentiles_are_exact(spark, monkeypatch, values):
    import numpy as np

    df = spark.createDataFrame([(v,) for v in values], "v double")
    known = sorted(v for v in values if v is not None)
    for accuracy in (100_000, 40):  # coarse brackets of many values too
        monkeypatch.setattr(telemetry, "ACCURACY", accuracy)
        got = telemetry.latency_percentiles(df, "v").first()
        want = [round(float(x), 4) for x in np.percentile(known, [50, 95, 99])] if known else [None] * 3
        assert list(got) == pytest.approx(want, abs=1e-4) if known else list(got) == want
        value = telemetry.exclusive_percentile(df, "v", 0.25).first().value
        if not known:
            assert value is None
            continue
        at = 0.25 * (len(known) + 1)
        low = max(1, min(int(at), len(known) - 1))
        assert value == pytest.approx(known[low - 1] + (known[min(low, len(known) - 1)] - known[low - 1]) * (at - low))
