"""The query catalogue: names to (spark, sf_dir) callables, and their DuckDB equivalents.

The engine's operators are bound to the test tables: a sensor or host is an events.user_id, a
reading or latency its value, a time series orders or events, a node's hosts the suppliers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog import table
from ..functions import collections as C
from ..functions import text as X
from ..functions.tokens import portable
from ..operators import bulk, mutations, paging, retry, sensors, telemetry
from ..ranges import PORTABLE, Ring, TokenRange, discover, split_proportionally
from ..sinks import render

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
Q = Callable[[SparkSession, str], DataFrame]


def query(oracle: str | None = None) -> Callable[[Q], Q]:
    def register(f: Q) -> Q:
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return register


def token_sql(key: str) -> str:
    return f"('0x' || substr(md5({key}::VARCHAR), 1, 15))::BIGINT"


RING = PORTABLE.size
WRAP = TokenRange(900_000_000_000_000_000, 100_000_000_000_000_000)

# ---- scans and counts by token range


@query("SELECT count(*) AS n FROM lineitem")
def bulk_count_total(spark, d):
    counted = bulk.count_by_range(table(spark, d, "lineitem"), portable("l_orderkey"), 16)
    return counted.agg(F.sum("n").alias("n"))


@query(
    f"""WITH r AS (SELECT i::INT AS range_id, i * {RING // 16} AS lo, (i + 1) * {RING // 16} - 1 AS hi FROM range(16) t(i)),
    k AS (SELECT {token_sql("o_orderkey")} AS token FROM orders)
    SELECT range_id, lo, hi, count(token) AS n FROM r LEFT JOIN k ON token BETWEEN lo AND hi GROUP BY ALL"""
)
def bulk_count_by_range(spark, d):
    return bulk.count_by_range(table(spark, d, "orders"), portable("o_orderkey"), 16)


@query(f"SELECT count(*) AS n FROM orders WHERE {token_sql('o_orderkey')} > {WRAP.start} OR {token_sql('o_orderkey')} <= {WRAP.end}")
def bulk_count_wraparound(spark, d):
    return bulk.range_scan(table(spark, d, "orders"), portable("o_orderkey"), WRAP).agg(F.count("*").alias("n"))


@query(f"SELECT min({token_sql('o_orderkey')}) AS min_token, max({token_sql('o_orderkey')}) AS max_token FROM orders")
def token_min_max(spark, d):
    t = portable("o_orderkey")
    return table(spark, d, "orders").agg(F.min(t).alias("min_token"), F.max(t).alias("max_token"))


_COVER = [TokenRange(-1, RING // 4), TokenRange(RING // 4 - RING // 16, RING // 2), TokenRange(RING // 2 + RING // 16, RING - 1)]


@query(
    f"""WITH k AS (SELECT {token_sql("o_orderkey")} AS t FROM orders), r(lo, hi) AS (VALUES {", ".join(f"({r.start}, {r.end})" for r in _COVER)}),
    c AS (SELECT t, (SELECT count(*) FROM r WHERE t > lo AND t <= hi) AS k FROM k)
    SELECT least(k, 2)::INT AS covers, count(*) AS n FROM c GROUP BY ALL"""
)
def range_coverage_check(spark, d):
    return bulk.coverage(table(spark, d, "orders"), portable("o_orderkey"), _COVER)


_SMALL = Ring(0, 9_999)
_NODES = {500: ("b", "a"), 2_900: ("a", "c"), 6_100: ("c", "b"), 9_800: ("a", "b")}


@query(
    """WITH r(id, lo, size) AS (VALUES (0, 500, 2400), (1, 2900, 3200), (2, 6100, 3700), (3, 9800, 700)),
    p AS (SELECT *, greatest(1, round_even(size / 10000.0 * 10, 0))::BIGINT AS parts FROM r),
    c AS (SELECT p.*, k, lo + k * (size // parts) AS a, CASE WHEN k = parts - 1 THEN lo + size ELSE lo + (k + 1) * (size // parts) END AS b
          FROM p, range(20) t(k) WHERE k < parts)
    SELECT (row_number() OVER (ORDER BY id, k) - 1)::INT AS range_id, (a % 10000)::BIGINT AS lo, (b % 10000)::BIGINT AS hi, (b % 10000) <= (a % 10000) AS wraps FROM c"""
)
def proportional_splits(spark, d):
    return bulk.range_table(spark, split_proportionally(discover(_NODES, _SMALL), 10, _SMALL))


@query(
    """WITH r(id, s) AS (VALUES (0, 'a,b'), (1, 'a,c'), (2, 'b,c'), (3, 'a,b'))
    SELECT s AS replica_set, count(*) AS n_ranges, string_agg(id::VARCHAR, ',' ORDER BY id) AS range_ids FROM r GROUP BY s"""
)
def replica_grouping(spark, d):
    return bulk.group_by_replicas(spark, discover(_NODES, _SMALL))


@query(f"SELECT count(*) AS n, sum(o_totalprice)::DECIMAL(20,2) AS total FROM orders WHERE {token_sql('o_orderkey')} > 0 AND {token_sql('o_orderkey')} <= {RING // 8}")
def token_range_scan(spark, d):
    rows = bulk.range_scan(table(spark, d, "orders"), portable("o_orderkey"), TokenRange(0, RING // 8))
    return rows.agg(F.count("*").alias("n"), F.sum(F.col("o_totalprice").cast("decimal(20,2)")).cast("decimal(20,2)").alias("total"))


ORACLES["token_range_scan"] = ORACLES["token_range_scan"].replace("sum(o_totalprice)::", "sum(o_totalprice::DECIMAL(20,2))::")

# ---- sinks


@query("SELECT c_name, c_custkey, NULL::VARCHAR AS c_phone, c_mktsegment FROM customer")
def export_projection(spark, d):
    return render.projected(table(spark, d, "customer"), ["c_name", "c_custkey", "c_phone", "c_mktsegment"])


@query(
    """SELECT event_id::VARCHAR AS event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS ts, CASE WHEN event_type = 'error' THEN 'true' ELSE 'false' END AS is_error,
    coalesce(CASE WHEN event_type <> 'click' THEN event_type END, 'NULL') AS event_type, '[' || user_id || ', ' || event_id || ']' AS ids,
    '{type: ' || event_type || '}' AS attrs, lower(hex(encode(event_type))) AS raw FROM (SELECT * REPLACE (date_trunc('second', ts) AS ts) FROM events)"""
)
def csv_rendering(spark, d):
    e = table(spark, d, "events").withColumn("ts", F.date_trunc("second", "ts").cast("timestamp_ntz"))
    kind = F.col("event_type")
    rows = e.select(
        "event_id", "ts", (kind == "error").alias("is_error"), F.when(kind != "click", kind).alias("event_type"),
        F.array("user_id", "event_id").alias("ids"), F.create_map(F.lit("type"), kind).alias("attrs"), F.encode(kind, "UTF-8").alias("raw"),
    )
    return render.csv_text(rows, null_string="NULL")


@query(
    """SELECT '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","segment":' || CASE WHEN c_mktsegment = 'BUILDING' THEN 'null' ELSE '"' || c_mktsegment || '"' END
    || ',"tags":["' || array_to_string(list_sort([c_mktsegment, 'a']), '","') || '"],"raw":"' || base64(encode(c_name)) || '"}' AS json FROM customer"""
)
def jsonl_rendering(spark, d):
    seg = F.col("c_mktsegment")
    rows = table(spark, d, "customer").select(
        "c_custkey", "c_name", F.when(seg != "BUILDING", seg).alias("segment"), F.array(seg, F.lit("a")).alias("tags"), F.encode("c_name", "UTF-8").alias("raw")
    )
    return render.json_text(rows, sets=("tags",))


def _roundtrip(spark, d, kind):
    from ..sinks.scratch import scratch

    rows = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(20,2)").alias("o_totalprice"))
    with scratch(spark) as path:
        if kind == "parquet":
            rows.write.option("compression", "zstd").parquet(path)
            back = spark.read.schema(rows.schema).parquet(path)
        elif kind == "csv":
            render.write_csv(rows, path, codec="gzip")
            back = spark.read.schema(rows.schema).csv(path, header=True)
        else:
            render.write_jsonl(rows, path)
            back = spark.read.schema(rows.schema).json(path)
        found = back.groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.sum("o_totalprice").cast("decimal(20,2)").alias("total")).collect()
    return spark.createDataFrame(found, "o_orderstatus string, n long, total decimal(20,2)")


_ROUND = "SELECT o_orderstatus, count(*) AS n, sum(o_totalprice::DECIMAL(20,2))::DECIMAL(20,2) AS total FROM orders GROUP BY ALL"


@query(_ROUND)
def parquet_roundtrip(spark, d):
    return _roundtrip(spark, d, "parquet")


@query(_ROUND)
def csv_roundtrip(spark, d):
    return _roundtrip(spark, d, "csv")


@query(_ROUND)
def jsonl_roundtrip(spark, d):
    return _roundtrip(spark, d, "jsonl")


@query("SELECT count(*) AS n, sum(o_totalprice)::DECIMAL(20,2) AS total, count(*) AS manifest_rows, 8 AS ranges, 2 AS jobs, 0 AS jobs_again FROM orders")
def export_resumed(spark, d):
    """An export by eight ranges in two jobs, run again over its own output, which writes nothing more."""
    from ..sinks.export import export
    from ..sinks.scratch import scratch

    rows = table(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").cast("decimal(20,2)").alias("o_totalprice"))
    jobs, again = [], []
    with scratch(spark) as path:
        export(rows, portable("o_orderkey"), f"{path}/orders", ranges=8, per_job=4, on_progress=jobs.append)
        done = export(rows, portable("o_orderkey"), f"{path}/orders", ranges=8, per_job=4, on_progress=again.append)
        back = spark.read.schema(rows.schema).parquet(f"{path}/orders/*")
        n, total = back.agg(F.count("*"), F.sum("o_totalprice").cast("decimal(20,2)")).first()
    found = [(n, total, done.rows, len(done.completed), len(jobs), len(again))]
    return spark.createDataFrame(found, "n long, total decimal(20,2), manifest_rows long, ranges int, jobs int, jobs_again int")


_TYPES = {
    "text": "string", "tinyint": "tinyint", "smallint": "smallint", "int": "int", "bigint": "bigint", "counter": "bigint", "varint": "decimal(38,0)",
    "decimal": "decimal(38,10)", "float": "float", "double": "double", "boolean": "boolean", "date": "date", "timestamp": "timestamp", "time": "bigint",
    "blob": "binary", "uuid": "string", "inet": "string", "list<int>": "array<int>", "set<text>": "array<string>",
    "map<text,frozen<map<text,int>>>": "map<string,map<string,int>>", "tuple<int,text>": "struct<_0:int,_1:string>", "frozen<list<double>>": "array<double>",
}


@query("SELECT * FROM (VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in _TYPES.items()) + ") t(cql_type, spark_type)")
def cql_type_map(spark, d):
    from ..types import spark_type

    return spark.createDataFrame([(t, spark_type(t).simpleString()) for t in _TYPES], "cql_type string, spark_type string")


# ---- filters


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderkey = 7")
def key_lookup(spark, d):
    return table(spark, d, "orders").filter(F.col("o_orderkey") == 7).select("o_orderkey", "o_custkey", "o_orderstatus")


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem WHERE l_orderkey = 7 AND l_linenumber = 1")
def multi_key_lookup(spark, d):
    rows = table(spark, d, "lineitem").filter((F.col("l_orderkey") == 7) & (F.col("l_linenumber") == 1))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query("SELECT p_partkey, p_name, p_size FROM part WHERE p_size >= 20 AND p_size <= 30")
def range_filter(spark, d):
    return spark.sql(
        "SELECT p_partkey, p_name, p_size FROM {part} WHERE p_size >= :low AND p_size <= :high", args={"low": 20, "high": 30}, part=table(spark, d, "part")
    )


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')")
def in_filter(spark, d):
    return table(spark, d, "customer").filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select("c_custkey", "c_mktsegment")


@query("SELECT p_partkey, p_name FROM part WHERE starts_with(p_name, 'small')")
def prefix_filter(spark, d):
    return table(spark, d, "part").filter(X.prefix(F.col("p_name"), "small")).select("p_partkey", "p_name")


@query("SELECT event_id, user_id, value FROM events WHERE ts >= '2024-01-10' AND ts < '2024-01-11' AND ts > '2024-01-10 12:00:00'")
def time_lower_bound(spark, d):
    rows = table(spark, d, "events").filter("ts >= timestamp_ntz'2024-01-10' AND ts < timestamp_ntz'2024-01-11' AND ts > timestamp_ntz'2024-01-10 12:00:00'")
    return rows.select("event_id", "user_id", "value")


@query("SELECT event_id, props FROM events WHERE props IS NOT NULL AND nullif(event_type, 'click') IS NOT NULL")
def not_null_filter(spark, d):
    rows = table(spark, d, "events").filter(F.col("props").isNotNull() & F.nullif("event_type", F.lit("click")).isNotNull())
    return rows.select("event_id", "props")


@query("SELECT o_custkey AS customer_id, count(*) AS order_count FROM orders GROUP BY ALL")
def column_alias(spark, d):
    return table(spark, d, "orders").groupBy(F.col("o_custkey").alias("customer_id")).agg(F.count("*").alias("order_count"))


# ---- pages


@query("WITH p AS (SELECT ((row_number() OVER (ORDER BY event_id) - 1) // 1000 + 1)::BIGINT AS page FROM events) SELECT page, count(*) AS rows_in_page FROM p GROUP BY ALL")
def page_numbers(spark, d):
    e = table(spark, d, "events")
    paged = paging.with_page(e, [F.col("event_id").asc()], 1000, F.floor(F.col("event_id") / 4096))
    return paged.groupBy("page").agg(F.count("*").alias("rows_in_page"))


@query("SELECT event_id, event_type FROM events ORDER BY event_id LIMIT 300")
def max_pages_limit(spark, d):
    return paging.first_pages(table(spark, d, "events").select("event_id", "event_type"), [F.col("event_id").asc()], 100, 3)


@query("WITH p AS (SELECT event_id, (row_number() OVER (ORDER BY event_id) - 1) // 100 + 1 AS page FROM events) SELECT page, count(*) AS n, min(event_id) AS first_id, max(event_id) AS last_id FROM p WHERE page <= 3 GROUP BY ALL")
def streamed_pages(spark, d):
    """The first three pages as a streamed read hands them to its caller."""
    read = paging.PagedResult(table(spark, d, "events").select("event_id").orderBy("event_id"), paging.StreamConfig(fetch_size=100, max_pages=3))
    with read:
        pages = [(read.page_number, len(p), p[0].event_id, p[-1].event_id) for p in read.pages()]
    return spark.createDataFrame(pages, "page long, n long, first_id long, last_id long")


@query(
    f"""WITH t AS (SELECT p_partkey, {token_sql("p_partkey")} AS token FROM part), n AS (SELECT * FROM t WHERE token > {RING // 3} ORDER BY token LIMIT 21),
    k AS (SELECT *, row_number() OVER (ORDER BY token) AS i, count(*) OVER () > 20 AS has_next FROM n)
    SELECT p_partkey, token, has_next, base64(encode(token::VARCHAR)) AS next_cursor FROM k WHERE i <= 20"""
)
def cursor_page(spark, d):
    return paging.cursor_page(table(spark, d, "part").select("p_partkey"), portable("p_partkey"), RING // 3, 20)


@query("SELECT event_type, count(*) AS n FROM events GROUP BY ALL")
def event_type_counts(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"))


@query("SELECT event_type, count(*) AS n FROM events WHERE user_id = 5 GROUP BY ALL")
def filtered_type_counts(spark, d):
    return table(spark, d, "events").filter("user_id = 5").groupBy("event_type").agg(F.count("*").alias("n"))


@query("WITH p AS (SELECT event_type, ((row_number() OVER (ORDER BY event_id) - 1) // 1000 + 1)::BIGINT AS page FROM events) SELECT page, event_type, count(*) AS n FROM p GROUP BY ALL")
def page_type_counts(spark, d):
    paged = paging.with_page(table(spark, d, "events"), [F.col("event_id").asc()], 1000, F.floor(F.col("event_id") / 4096))
    return paged.groupBy("page", "event_type").agg(F.count("*").alias("n"))


@query("SELECT count(*) FILTER (value <= 100) AS successful, count(*) FILTER (NOT value <= 100) AS failed, count(*) AS total FROM events")
def outcome_split(spark, d):
    return telemetry.outcome_split(table(spark, d, "events"), F.col("value") <= 100)


# ---- sensors


@query("SELECT user_id, count(*) AS n, arg_min(value, ts) AS first_value, arg_max(value, ts) AS last_value FROM events GROUP BY ALL")
def collect_readings(spark, d):
    return sensors.collected(table(spark, d, "events"), "user_id", "ts", "value")


def _sliding_sql(interval: str) -> str:
    return f"""SELECT event_id, user_id, round(avg(value) OVER w, 6) AS avg_value, min(value) OVER w AS min_value, max(value) OVER w AS max_value, count(*) OVER w AS n
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL {interval} PRECEDING AND CURRENT ROW)"""


def _sliding(spark, d, interval):
    found = sensors.sliding_stats(table(spark, d, "events"), "user_id", "ts", "value", interval)
    return found.select("event_id", "user_id", F.round("avg_value", 6).alias("avg_value"), "min_value", "max_value", "n")


@query(_sliding_sql("5 MINUTES"))
def sliding_window_stats(spark, d):
    return _sliding(spark, d, "5 MINUTES")


@query(_sliding_sql("6 HOURS"))
def sliding_window_stats_6h(spark, d):
    return _sliding(spark, d, "6 HOURS")


@query("SELECT event_id, round(avg(value) OVER w, 6) AS avg_value, count(*) OVER w AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)")
def row_capped_window(spark, d):
    found = sensors.last_rows_stats(table(spark, d, "events"), "user_id", [F.col("ts"), F.col("event_id")], "value", 20)
    return found.select("event_id", F.round("avg_value", 6).alias("avg_value"), "n")


@query(
    """WITH s AS (SELECT user_id, ts, avg(value) OVER w AS a, count(*) OVER w AS n FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 6 HOURS PRECEDING AND CURRENT ROW)),
    l AS (SELECT user_id, arg_max(n, ts) AS n, arg_max(a, ts) AS a FROM s GROUP BY ALL)
    SELECT count(*) AS n_sensors, sum(n)::BIGINT AS n_readings, round(avg(a), 2) AS mean_of_means FROM l"""
)
def sensor_summary(spark, d):
    stats = sensors.sliding_stats(table(spark, d, "events"), "user_id", "ts", "value", "6 HOURS")
    return sensors.sensor_summary(stats, "user_id", "ts")


@query(
    """WITH s AS (SELECT user_id, ts, avg(value) OVER w AS a, count(*) OVER w AS n FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 6 HOURS PRECEDING AND CURRENT ROW)),
    l AS (SELECT user_id, arg_max(n, ts) AS n, arg_max(a, ts) AS a FROM s GROUP BY ALL)
    SELECT count(*) AS n_sensors, sum(n)::BIGINT AS n_readings, round(avg(a), 2) AS mean_of_means,
    (SELECT count(*) FILTER (value > 150 OR value < 1) + count(*) FILTER (value > 220) FROM events) AS n_alerts FROM l"""
)
def sensor_summary_alerts(spark, d):
    stats = sensors.sliding_stats(table(spark, d, "events"), "user_id", "ts", "value", "6 HOURS")
    v = F.col("value")
    return sensors.sensor_summary(stats, "user_id", "ts", [(v > 150) | (v < 1), v > 220])


def _capped_sql(*values: str) -> str:
    frames = {"t": "(PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 6 HOURS PRECEDING AND CURRENT ROW)", "r": "(PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"}
    pick = ", ".join(
        f"{'round(' * (f == 'avg')}CASE WHEN count(*) OVER t <= count(*) OVER r THEN {f}({v}) OVER t ELSE {f}({v}) OVER r END{', 6)' * (f == 'avg')} AS {f}_{v}"
        for v in values for f in ("avg", "min", "max")
    )
    return f"SELECT event_id, least(count(*) OVER t, count(*) OVER r) AS n, {pick} FROM (SELECT *, length(props) AS size FROM events) WINDOW " + ", ".join(f"{k} AS {w}" for k, w in frames.items())


@query(_capped_sql("value", "size"))
def capped_window_stats(spark, d):
    e = table(spark, d, "events").withColumn("size", F.length("props").cast("long"))
    found = sensors.capped_stats(e, "user_id", "ts", "event_id", ["value", "size"], "6 HOURS", 3)
    rounded = [F.round(c, 6).alias(c) if c.startswith("avg") else F.col(c) for c in found.columns[len(e.columns) :]]
    return found.select("event_id", *rounded)


@query(
    """SELECT event_id, value, 'extreme' AS alert FROM events WHERE value > 150 OR value < 1
    UNION ALL SELECT event_id, value, 'high' FROM events WHERE value > 220"""
)
def threshold_alerts(spark, d):
    v = F.col("value")
    found = sensors.alerts(table(spark, d, "events"), {"extreme": (v > 150) | (v < 1), "high": v > 220})
    return found.select("event_id", "value", "alert")


@query(
    """WITH g AS (SELECT user_id, (epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts)) / 1e6 AS gap FROM events)
    SELECT user_id, count(gap) AS n_gaps, round(avg(gap), 3) AS avg_gap, round(max(gap), 3) AS max_gap, count(*) FILTER (gap > 86400) AS n_long FROM g GROUP BY ALL"""
)
def gap_analysis(spark, d):
    return sensors.gaps(table(spark, d, "events"), "user_id", "ts", 86_400)


@query("SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 25")
def latest_n(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_orderdate").orderBy(F.desc("o_orderdate"), "o_orderkey").limit(25)


@query("SELECT event_id, ts FROM events WHERE user_id = 3 ORDER BY ts DESC, event_id LIMIT 10")
def top_k_partition(spark, d):
    return table(spark, d, "events").filter("user_id = 3").select("event_id", "ts").orderBy(F.desc("ts"), "event_id").limit(10)


@query("SELECT user_id, event_id, (row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id))::INT AS rn FROM events QUALIFY rn <= 3")
def latest_n_per_key(spark, d):
    return sensors.latest_per_key(table(spark, d, "events"), "user_id", [F.desc("ts"), F.col("event_id")], 3).select("user_id", "event_id", "rn")


# ---- telemetry

def _query_text():
    return F.concat(
        F.lit("select  *\tfrom t where k = "), (F.col("event_id") % 1000).cast("string"), F.lit(" and kind = '"), F.col("event_type"), F.lit("' limit "),
        F.when(F.col("value") > 60, "10").otherwise("10 "), F.when(F.col("user_id") % 2 == 0, " allow").otherwise(""),
    )


@query(
    r"""WITH q AS (SELECT 'select  *' || chr(9) || 'from t where k = ' || (event_id % 1000) || ' and kind = ''' || event_type || ''' limit '
      || CASE WHEN value > 60 THEN '10' ELSE '10 ' END || CASE WHEN user_id % 2 = 0 THEN ' allow' ELSE '' END AS q FROM events),
    n AS (SELECT regexp_replace(regexp_replace(regexp_replace(upper(trim(q)), '\s+', ' ', 'g'), '''[^'']*''', '''?''', 'g'), '\b\d+\b', '?', 'g') AS q FROM q)
    SELECT substr(md5(q), 1, 12) AS query_hash, count(*) AS n FROM n GROUP BY ALL ORDER BY n DESC, query_hash LIMIT 10"""
)
def query_hash_topk(spark, d):
    return telemetry.top_queries(table(spark, d, "events"), X.query_hash(_query_text()))


@query(
    """SELECT count(*) AS n, round(avg(value), 4) AS avg_ms, min(value) AS min_ms, max(value) AS max_ms,
    round(avg((event_type <> 'error')::INT), 4) AS success_rate, round(count(*) / 86400.0, 6)::DOUBLE AS qps FROM events WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 1 DAY"""
)
def query_stats_window(spark, d):
    e = table(spark, d, "events")
    as_of = e.agg(F.max("ts").alias("as_of"))  # one row
    return telemetry.query_stats(e.crossJoin(F.broadcast(as_of)), "ts", F.col("value"), F.col("event_type") != "error", F.col("as_of"), "1 DAY")


@query("SELECT event_type AS error_type, count(*) AS n FROM events WHERE value > 150 AND event_type IS NOT NULL GROUP BY ALL")
def error_counts(spark, d):
    return telemetry.error_counts(table(spark, d, "events"), F.col("value") > 150, "event_type")


@query("SELECT user_id, max(ts) AS ts, arg_max(event_type, ts) AS event_type, arg_max(value, ts) AS value FROM events GROUP BY ALL")
def last_per_host(spark, d):
    return telemetry.last_per_host(table(spark, d, "events"), "user_id", "ts", "event_type", "value")


@query("SELECT event_id, ts FROM events ORDER BY ts DESC, event_id LIMIT 500")
def retention_last_n(spark, d):
    return telemetry.newest(table(spark, d, "events").select("event_id", "ts"), [F.desc("ts"), F.col("event_id")], 500)


@query(
    """SELECT s_nationkey, count(*) FILTER (s_acctbal >= 0) AS healthy, count(*) FILTER (NOT s_acctbal >= 0) AS unhealthy,
    sum(CASE WHEN s_suppkey % 4 >= 3 THEN 32768 ELSE 128 END)::BIGINT AS connections,
    round(avg(nullif(greatest(s_acctbal, 0), 0)), 4) AS avg_latency FROM supplier GROUP BY ALL"""
)
def cluster_rollup(spark, d):
    return telemetry.cluster_rollup(
        table(spark, d, "supplier"), "s_nationkey", F.col("s_acctbal") >= 0, telemetry.in_flight(F.col("s_suppkey") % 4), F.greatest("s_acctbal", F.lit(0.0))
    )


@query("SELECT round(quantile_cont(value, 0.5), 4) AS p50, round(quantile_cont(value, 0.95), 4) AS p95, round(quantile_cont(value, 0.99), 4) AS p99 FROM events")
def latency_percentiles(spark, d):
    return telemetry.latency_percentiles(table(spark, d, "events"), "value")


@query(
    """WITH o AS (SELECT value, row_number() OVER (ORDER BY value) AS i, count(*) OVER () AS n FROM events), k AS (SELECT max(n) * 0.95 + 0.95 AS p FROM o)
    SELECT round(max(CASE WHEN i = floor(p) THEN value END) + (max(CASE WHEN i = floor(p) + 1 THEN value END) - max(CASE WHEN i = floor(p) THEN value END)) * max(p - floor(p)), 4) AS value FROM o, k"""
)
def exclusive_percentile(spark, d):
    return telemetry.exclusive_percentile(table(spark, d, "events"), "value", 0.95).select(F.round("value", 4).alias("value"))


@query(
    """SELECT event_type, value <= 150 AS success, count(*) FILTER (value <= 10) AS le_10, count(*) FILTER (value <= 50) AS le_50, count(*) FILTER (value <= 100) AS le_100,
    count(*) AS total, round(sum(value), 2) AS sum_value FROM events GROUP BY ALL"""
)
def latency_histogram(spark, d):
    e = table(spark, d, "events").withColumn("success", F.col("value") <= 150)
    return telemetry.histogram(e, ["event_type", "success"], "value", [10, 50, 100])


@query(
    """SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, count(*) AS n, round(count(*) / 3600.0, 6)::DOUBLE AS rate,
    round(count(*) FILTER (event_type <> 'error') / count(*), 4) AS success_ratio, round(count(*) FILTER (value > 100) / count(*), 4) AS slow_fraction
    FROM events GROUP BY ALL"""
)
def windowed_rates(spark, d):
    return telemetry.windowed_rates(table(spark, d, "events"), "ts", "1 hour", F.col("event_type") != "error", F.col("value") > 100)


@query("SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, count(*) AS n, round(count(*) FILTER (value > 100) / count(*), 4) AS slow_fraction FROM events GROUP BY ALL HAVING slow_fraction > 0.1")
def slow_windows(spark, d):
    found = telemetry.windowed_rates(table(spark, d, "events"), "ts", "1 day", F.col("event_type") != "error", F.col("value") > 100)
    return found.filter("slow_fraction > 0.1").select("window_start", "n", "slow_fraction")


_BOUNDS = [10.0, 25.0, 50.0, 100.0, 200.0]
_LE = ", ".join(f"count(*) FILTER (value <= {b})::DOUBLE AS c{i}" for i, b in enumerate(_BOUNDS))
_CASES = " ".join(
    f"WHEN c{i} >= r THEN {lo} + {b - lo} * CASE WHEN c{i} > {c} THEN (r - {c}) / (c{i} - {c}) ELSE 1 END"
    for i, (b, lo, c) in enumerate(zip(_BOUNDS, [0.0, *_BOUNDS], ["0", *[f"c{i}" for i in range(len(_BOUNDS))]]))
)


@query(f"WITH b AS (SELECT event_type, count(*) * 0.95::DOUBLE AS r, {_LE} FROM events GROUP BY ALL) SELECT event_type, round(CASE {_CASES} ELSE {_BOUNDS[-1]} END, 4) AS quantile FROM b")
def histogram_quantile(spark, d):
    return telemetry.bucket_quantile(table(spark, d, "events"), ["event_type"], "value", _BOUNDS, 0.95)


@query(
    """SELECT count(*) FILTER (s_acctbal >= 0) AS up, count(*) FILTER (NOT s_acctbal >= 0) AS down, count(*) AS total,
    sum(CASE WHEN s_suppkey % 4 >= 3 THEN 32768 ELSE 128 END) FILTER (s_acctbal >= 0)::BIGINT AS in_flight FROM supplier"""
)
def connection_summary(spark, d):
    return telemetry.connection_summary(table(spark, d, "supplier"), F.col("s_acctbal") >= 0, F.col("s_suppkey") % 4)


@query("SELECT count(*) AS n, count(DISTINCT o_orderkey) AS n_keys FROM orders")
def range_queries_union(spark, d):
    from ..engine import Engine
    from ..ranges import range_query, whole

    with Engine(spark, d, ["orders"]) as engine:
        parts = [range_query("orders", "o_orderkey", r, ["o_orderkey"]) for r in whole(8)]
        return engine.query(" UNION ALL ".join(parts)).agg(F.count("*").alias("n"), F.countDistinct("o_orderkey").alias("n_keys"))


# ---- mutations


@query("SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY ALL")
def lww_merge(spark, d):
    return mutations.last_write_wins(table(spark, d, "events"), "user_id", ["ts", "event_id"], ["event_type", "value"])


@query(
    """WITH l AS (SELECT o_custkey AS k, o_orderkey AS w, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderstatus END AS status, o_totalprice AS price,
      o_orderkey % 2 = 0 AS set_status, o_orderkey % 3 = 0 AS set_price, o_orderkey % 11 = 0 AS deleted FROM orders),
    g AS (SELECT k, coalesce(max(w) FILTER (deleted), -1) AS gone FROM l GROUP BY k),
    s AS (SELECT l.k, max(w) FILTER (set_status AND NOT deleted) AS sw, max(w) FILTER (set_price AND NOT deleted) AS pw FROM l GROUP BY k),
    m AS (SELECT g.k, CASE WHEN sw > gone THEN sw END AS sw, CASE WHEN pw > gone THEN pw END AS pw FROM g JOIN s USING (k))
    SELECT m.k, a.status, b.price FROM m LEFT JOIN l a ON a.w = m.sw LEFT JOIN l b ON b.w = m.pw WHERE sw IS NOT NULL OR pw IS NOT NULL"""
)
def column_lww_merge(spark, d):
    key = F.col("o_orderkey")
    log = table(spark, d, "orders").select(
        F.col("o_custkey").alias("k"), key.alias("w"), F.when(key % 7 != 0, F.col("o_orderstatus")).alias("status"), F.col("o_totalprice").alias("price"),
        (key % 2 == 0).alias("set_status"), (key % 3 == 0).alias("set_price"), (key % 11 == 0).alias("deleted"),
    )
    return mutations.column_last_write_wins(log, "k", "w", ["status", "price"])


@query(
    """SELECT event_id, user_id, row_number() OVER w = 1 AS applied, first(event_type) OVER w AS standing_event_type FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)"""
)
def insert_if_not_exists(spark, d):
    log = table(spark, d, "events").select("event_id", "user_id", "ts", "event_type")
    return mutations.insert_if_not_exists(log, "user_id", [F.col("ts"), F.col("event_id")], "event_type").drop("ts", "event_type")


_LOG = [
    ("a", 1, "insert", None, 10), ("a", 2, "insert", None, 11), ("a", 3, "update", 1, 12), ("a", 4, "update", 1, 13), ("a", 5, "update", 2, 14),
    ("b", 1, "update", 1, 20), ("b", 2, "insert", None, 21), ("b", 3, "delete", 2, None), ("b", 4, "delete", 1, None), ("b", 5, "update", None, 22),
    ("c", 1, "insert", None, 30), ("c", 2, "update", None, 31), ("c", 3, "delete", None, None), ("c", 4, "insert", None, 32),
]
_LOG_SQL = ", ".join("(" + ", ".join("NULL" if x is None else repr(x) for x in r) + ")" for r in _LOG)


@query(
    f"""WITH RECURSIVE l(k, seq, op, expected, v) AS (VALUES {_LOG_SQL}),
    f AS (
      SELECT k, 0 AS seq, false AS applied, NULL::BIGINT AS version, NULL::INT AS value FROM (SELECT DISTINCT k FROM l)
      UNION ALL
      SELECT l.k, l.seq, c.applied, CASE WHEN NOT c.applied THEN f.version WHEN op = 'delete' THEN NULL ELSE coalesce(f.version, 0) + 1 END,
        CASE WHEN NOT c.applied THEN f.value WHEN op = 'delete' THEN NULL ELSE v END
      FROM f JOIN l ON l.k = f.k AND l.seq = f.seq + 1,
      LATERAL (SELECT CASE WHEN op = 'insert' THEN f.version IS NULL ELSE f.version IS NOT NULL AND (expected IS NULL OR expected = f.version) END AS applied) c)
    SELECT k, seq, applied, version, value FROM f WHERE seq > 0"""
)
def optimistic_lock(spark, d):
    log = spark.createDataFrame(_LOG, "k string, seq int, op string, expected long, value int")
    return mutations.conditional_fold(log, "k", "seq")


@query("SELECT user_id, sum(CASE WHEN event_type IN ('click', 'view') THEN 1 WHEN event_type = 'error' THEN -1 ELSE 0 END)::BIGINT AS value FROM events GROUP BY ALL")
def counter_fold(spark, d):
    kind = F.col("event_type")
    delta = F.when(kind.isin("click", "view"), 1).when(kind == "error", -1).otherwise(0).cast("long")
    return mutations.counters(table(spark, d, "events").select("user_id", delta.alias("delta")), ["user_id"], "delta")


@query("SELECT event_id FROM events WHERE user_id % 5 = 0 OR event_id + user_id % 5 * 100 > 600")
def ttl_filter(spark, d):
    ttl = F.when(F.col("user_id") % 5 != 0, F.col("user_id") % 5 * 100)
    return mutations.live_at(table(spark, d, "events").withColumn("ttl", ttl), "event_id", "ttl", F.lit(600)).select("event_id")


# ---- collections


def _listed(events):
    return events.groupBy("user_id").agg(F.array_sort(F.collect_list("event_type")).alias("xs"))


def _join(c):
    return F.array_join(c, ",")


def _list_ops(events):
    lit = lambda *xs: F.array(*map(F.lit, xs))
    xs = F.col("xs")
    return _listed(events).select(
        "user_id", _join(C.list_append(xs, lit("z", "z"))).alias("appended"), _join(C.list_prepend(xs, lit("a", "b"))).alias("prepended"),
        _join(C.list_remove(xs, lit("click", "view"))).alias("removed"),
    )


def _set_ops(events):
    lit = lambda *xs: F.array(*map(F.lit, xs))
    xs = F.array_distinct("xs")
    return _listed(events).select("user_id", _join(C.set_add(xs, lit("z", "click"))).alias("added"), _join(C.set_remove(xs, lit("click", "view"))).alias("removed"))


def _map_ops(events):
    e = events.groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    m = e.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "n"))).alias("m"))
    shown = lambda c: _join(F.transform(F.array_sort(F.map_entries(c)), lambda x: F.concat_ws("=", x["key"], x["value"].cast("string"))))
    new = F.create_map(F.lit("click"), F.lit(0).cast("long"), F.lit("new"), F.lit(1).cast("long"))
    return m.select("user_id", shown(C.map_merge(F.col("m"), new)).alias("merged"), shown(C.map_delete(F.col("m"), F.lit("view"))).alias("deleted"))


@query(
    """WITH l AS (SELECT user_id, list_sort(list(event_type)) AS xs FROM events GROUP BY ALL)
    SELECT user_id, array_to_string(list_concat(xs, ['z', 'z']), ',') AS appended, array_to_string(list_concat(['a', 'b'], xs), ',') AS prepended,
    nullif(array_to_string(list_filter(xs, lambda x: x NOT IN ('click', 'view')), ','), '') AS removed FROM l"""
)
def list_ops(spark, d):
    return _list_ops(table(spark, d, "events"))


@query(ORACLES["list_ops"])
def list_ops_all(spark, d):
    return _list_ops(table(spark, d, "events"))


@query(
    """WITH l AS (SELECT user_id, list_sort(list_distinct(list(event_type))) AS xs FROM events GROUP BY ALL)
    SELECT user_id, array_to_string(list_sort(list_distinct(list_concat(xs, ['z', 'click']))), ',') AS added,
    nullif(array_to_string(list_filter(xs, lambda x: x NOT IN ('click', 'view')), ','), '') AS removed FROM l"""
)
def set_ops(spark, d):
    return _set_ops(table(spark, d, "events"))


@query(ORACLES["set_ops"])
def set_ops_all(spark, d):
    return _set_ops(table(spark, d, "events"))


@query(
    """WITH c AS (SELECT user_id, event_type AS k, count(*) AS n FROM events GROUP BY ALL),
    keys AS (SELECT DISTINCT user_id FROM c),
    merged AS (SELECT user_id, k, n FROM c WHERE k <> 'click' UNION ALL SELECT user_id, 'click', 0 FROM keys UNION ALL SELECT user_id, 'new', 1 FROM keys)
    SELECT user_id, (SELECT string_agg(k || '=' || n, ',' ORDER BY k) FROM merged m WHERE m.user_id = keys.user_id) AS merged,
    (SELECT string_agg(k || '=' || n, ',' ORDER BY k) FROM c WHERE c.user_id = keys.user_id AND k <> 'view') AS deleted FROM keys"""
)
def map_ops(spark, d):
    return _map_ops(table(spark, d, "events"))


@query(ORACLES["map_ops"])
def map_ops_all(spark, d):
    return _map_ops(table(spark, d, "events"))


@query("SELECT event_id, user_id, event_type FROM events WHERE false")
def empty_result_schema(spark, d):
    return table(spark, d, "events").filter("event_id < -1").select("event_id", "user_id", "event_type")


# ---- decisions

_MATRIX = [
    (i, kind, retry_num, data, received, 2, idem, wt)
    for i, (kind, retry_num, data, received, idem, wt) in enumerate(
        (k, n, x, r, m, w)
        for k in ("read", "write", "unavailable", "request")
        for n in (0, 1, 3)
        for x, r in ((True, 0), (False, 2), (False, 1))
        for m, w in ((True, "SIMPLE"), (True, "COUNTER"), (False, "SIMPLE"), (None, "UNLOGGED_BATCH"), (True, "UNLOGGED_BATCH"))
    )
]
_MATRIX_SQL = ", ".join("(" + ", ".join("NULL" if x is None else repr(x) for x in r) + ")" for r in _MATRIX)


@query(
    f"""SELECT id, CASE WHEN retry_num >= 3 THEN 'RETHROW'
      WHEN kind = 'read' THEN CASE WHEN data_retrieved OR received >= required THEN 'RETRY' ELSE 'RETHROW' END
      WHEN kind = 'write' THEN CASE WHEN idempotent IS TRUE AND write_type IN ('SIMPLE', 'BATCH', 'UNLOGGED_BATCH') THEN 'RETRY' ELSE 'RETHROW' END
      WHEN kind = 'unavailable' THEN CASE WHEN retry_num = 0 THEN 'RETRY_NEXT_HOST' ELSE 'RETRY' END
      ELSE 'RETRY_NEXT_HOST' END AS decision
    FROM (VALUES {_MATRIX_SQL}) t(id, kind, retry_num, data_retrieved, received, required, idempotent, write_type)"""
)
def retry_decisions(spark, d):
    matrix = spark.createDataFrame(
        _MATRIX, "id int, kind string, retry_num int, data_retrieved boolean, received int, required int, idempotent boolean, write_type string"
    )
    return retry.decisions(matrix).select("id", "decision")


@query("SELECT m AS message, CASE WHEN regexp_matches(m, '(?i)no host|unavailable|timed? ?out|timeout|connection|overload') THEN 503 ELSE 500 END AS status FROM (VALUES ('No host available'), ('Syntax error'), ('Request timed out'), ('Connection refused'), ('bad value')) t(m)")
def error_classes(spark, d):
    rows = spark.createDataFrame([(m,) for m in ("No host available", "Syntax error", "Request timed out", "Connection refused", "bad value")], "message string")
    return rows.select("message", X.error_status(F.col("message")).alias("status"))


@query("SELECT c_custkey FROM customer SEMI JOIN orders ON c_custkey = o_custkey AND o_totalprice > 400000")
def exists_check(spark, d):
    o = table(spark, d, "orders").filter("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, d, "customer").select("c_custkey").join(o, "c_custkey", "left_semi")


@query("SELECT c_custkey FROM customer ANTI JOIN orders ON c_custkey = o_custkey AND o_totalprice > 400000")
def absent_check(spark, d):
    o = table(spark, d, "orders").filter("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, d, "customer").select("c_custkey").join(o, "c_custkey", "left_anti")


# ---- streams and sources


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY ALL")
def stream_window_counts(spark, d):
    from ..streaming.windows import window_counts

    return window_counts(spark, f"{d}/events.parquet")


@query(
    """WITH m AS (SELECT user_id, ts, value, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, value DESC) AS k, max(ts) OVER (PARTITION BY user_id) AS last FROM events)
    SELECT user_id, count(*) AS n, round(avg(value), 4) AS avg_value FROM m WHERE epoch_us(ts) >= epoch_us(last) - 300000000 AND k <= 1000 GROUP BY user_id"""
)
def stateful_sensor_window(spark, d):
    from ..streaming.stateful import sensor_windows

    return sensor_windows(spark, f"{d}/events.parquet")


@query(f"SELECT count(*) AS n, sum(o_custkey)::BIGINT AS total FROM orders WHERE {token_sql('o_orderkey')} < {RING // 2}")
def ring_source_scan(spark, d):
    from ..sources.ring import ring_table

    rows = ring_table(table(spark, d, "orders"), "o_orderkey", 16)
    return rows.filter(F.col("range_id") < 8).agg(F.count("*").alias("n"), F.sum("o_custkey").alias("total"))


@query(
    """SELECT o_orderstatus, count(*) AS n, sum(o_totalprice::DECIMAL(20,2))::DECIMAL(20,2) AS total FROM orders GROUP BY ALL"""
)
def snapshot_table(spark, d):
    from ..sinks.scratch import scratch
    from ..sinks.snapshots import SnapshotTable

    rows = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(20,2)").alias("o_totalprice"))
    with scratch(spark) as path:
        t = SnapshotTable(spark, path)
        t.append(rows.filter("o_orderkey % 2 = 0"))
        t.append(rows.filter("o_orderkey % 2 = 1"))
        found = t.read().groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.sum("o_totalprice").cast("decimal(20,2)").alias("total")).collect()
    return spark.createDataFrame(found, "o_orderstatus string, n long, total decimal(20,2)")
