"""Queries over the synthetic tables, one for each operator, with equivalent DuckDB SQL.

events stand in for trips: user_id is the zone (many keys), event_type the vendor (few keys),
ts the pickup, value the fare. Money is taken in whole cents wherever sums are compared.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ambermill.functions.columns import add_derived_columns, cast_columns, day_start, epoch_seconds, hour_of_day, normalize_columns, ratio_clip, run_key_column
from ambermill.operators.asof import as_of_join
from ambermill.operators.relational import dedup_keep_latest, first_per_group
from ambermill.operators.skew import find_hot_keys, hot_key_counts, salted_aggregate
from ambermill.operators.windows import FeatureAgg, TrailingFrame, add_sliced_trailing_windows, add_trailing_windows
from ambermill.plans.bronze import date_range as in_range
from ambermill.plans.features import compute_joined_features, daily_partials, day_grain_features, event_grain_features
from ambermill.plans.specs import FeatureJoin, FeatureSpec
from ambermill.plans.training import baseline_metrics, impute_stats, split_column, training_frame
from ambermill.quality.contracts import TableContract, column, value_counters
from ambermill.quality.gates import check_freshness, check_row_count_floor, duplicate_key_groups, null_rate, partition_counts, partitions_below_floor, results_frame, run_gates
from ambermill.session import checkpoint_root
from ambermill.sources.tables import month_range, read_table
from ambermill.sources.writer import TableWriter

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def cents(col: str):
    return F.round(F.col(col) * 100).cast("long")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", cents("value").alias("cents"))
    return e.withColumn("event_date", F.to_date("ts"))


FRAMES = (TrailingFrame("1h", -3600, -1), TrailingFrame("6h", -21600, -1), TrailingFrame("24h", -86400, -1))
DAYS = (TrailingFrame("7d", -604800, -86400), TrailingFrame("30d", -2592000, -86400))
ZONE = FeatureSpec("zone", ("user_id",), "ts", "event_date", "", frames=FRAMES, aggs=(FeatureAgg("cnt", "count", "cents"), FeatureAgg("mean", "avg", "cents")))
DRIVER = FeatureSpec("driver", ("event_type",), "ts", "event_date", "", "day", DAYS, (FeatureAgg("d_cnt", "count", "cents"), FeatureAgg("d_mean", "avg", "cents")))
TRIP = FeatureSpec(
    "trip", ("user_id", "event_type", "ts"), "ts", "event_date", "",
    joins=(FeatureJoin("zone", ("user_id",), 0, "z"), FeatureJoin("driver", ("event_type",), 86400, "d")),
)

EV = "ev AS (SELECT event_id, ts, user_id, event_type, CAST(round(value * 100) AS BIGINT) AS cents, CAST(ts AS DATE) AS event_date, epoch_us(ts) // 1000000 AS u FROM events)"
ZONE_COLS = ", ".join(
    f"{fn} OVER (PARTITION BY user_id ORDER BY u RANGE BETWEEN {-f.start} PRECEDING AND 1 PRECEDING) AS {name}_{f.name}"
    for name, fn in (("cnt", "count(*)"), ("mean", "avg(cents)"))
    for f in FRAMES
)
ZONE_CTE = f"zone AS (SELECT user_id, ts, event_date, {ZONE_COLS} FROM ev)"
DAY_OVER = "OVER (PARTITION BY event_type ORDER BY u RANGE BETWEEN {a} PRECEDING AND 86400 PRECEDING)"
DRIVER_COLS = ", ".join(
    [f"CAST(coalesce(sum(n) {DAY_OVER.format(a=-f.start)}, 0) AS BIGINT) AS d_cnt_{f.name}" for f in DAYS]
    + [f"CAST(sum(s) {DAY_OVER.format(a=-f.start)} AS DOUBLE) / CAST(sum(c) {DAY_OVER.format(a=-f.start)} AS DOUBLE) AS d_mean_{f.name}" for f in DAYS]
)
DRIVER_CTE = (
    "days AS (SELECT event_type, event_date, count(*) AS n, count(cents) AS c, sum(cents) AS s, epoch_us(CAST(event_date AS TIMESTAMP)) // 1000000 AS u FROM ev GROUP BY 1, 2), "
    f"driver AS (SELECT event_type, CAST(event_date AS TIMESTAMP) AS ts, event_date, {DRIVER_COLS} FROM days)"
)


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def scan_parquet(spark, sf_dir):
    return table(spark, sf_dir, "orders")


@query("SELECT o_orderkey, o_totalprice FROM orders")
def scan_projected(spark, sf_dir):
    return read_table(spark, f"{sf_dir}/orders.parquet", ["o_orderkey", "o_totalprice"])


@query("SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS event_date FROM events")
def sink_roundtrip(spark, sf_dir):
    path = f"{checkpoint_root(spark)}/sink-{uuid.uuid4().hex}/t"
    TableWriter(spark).replace(events(spark, sf_dir).select("event_id", "user_id", "event_type", "event_date"), path, ["event_date"])
    return read_table(spark, path)


@query("SELECT event_id AS vendor_id, user_id AS pu_location_id, value AS trip_distance, event_type AS camel_case_col FROM events")
def normalize_columns_q(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return normalize_columns(e.select(F.col("event_id").alias("VendorID"), F.col("user_id").alias("PULocationID"), F.col("value").alias("trip_distance"), F.col("event_type").alias("camelCaseCol")))


@query(
    "SELECT event_id, TRY_CAST(event_type AS BIGINT) AS vendor_id, TRY_CAST(CAST(user_id AS VARCHAR) AS BIGINT) AS pu_location_id, "
    "TRY_CAST(CASE WHEN user_id % 2 = 0 THEN CAST(user_id AS VARCHAR) ELSE 'bad' END AS DOUBLE) AS fare_amount FROM events"
)
def cast_columns_q(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    text = F.col("user_id").cast("string")
    return cast_columns(
        e.select("event_id", F.col("event_type").alias("vendor_id"), text.alias("pu_location_id"), F.when(F.col("user_id") % 2 == 0, text).otherwise("bad").alias("fare_amount"))
    )


@query("SELECT event_id, CAST(ts AS DATE) AS event_date, epoch_us(ts) // 1000000 AS unix_s FROM events")
def derive_event_date(spark, sf_dir):
    return add_derived_columns(table(spark, sf_dir, "events"), "ts").select("event_id", "event_date", epoch_seconds("ts").alias("unix_s"))


@query(
    "WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey, nullif(l_tax, 0) * l_extendedprice - 500 AS n, CASE WHEN l_linenumber = 1 THEN 0 ELSE l_quantity * 20 END AS d FROM lineitem) "
    "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN d > 0 AND n IS NOT NULL THEN least(greatest(n / d, 0.0), 1.0) END AS ratio FROM x"
)
def ratio_clip_q(spark, sf_dir):
    n = F.nullif(F.col("l_tax"), F.lit(0.0)) * F.col("l_extendedprice") - 500
    d = F.when(F.col("l_linenumber") == 1, F.lit(0.0)).otherwise(F.col("l_quantity") * 20)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", ratio_clip(n, d).alias("ratio"))


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1995-01-01' AND DATE '1996-06-30'")
def date_range(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return in_range(o.withColumn("d", F.to_date("o_orderdate")), "d", "1995-01-01", "1996-06-30").drop("d")


@query(
    f"WITH {EV} SELECT event_id, count(*) OVER w AS cnt_1h, avg(cents) OVER w AS mean_1h FROM ev "
    "WINDOW w AS (PARTITION BY user_id ORDER BY u RANGE BETWEEN 3600 PRECEDING AND 1 PRECEDING)"
)
def trailing_1h(spark, sf_dir):
    e = events(spark, sf_dir).withColumn("u", epoch_seconds("ts"))
    return add_trailing_windows(e, ["user_id"], "u", FRAMES[:1], ZONE.aggs).select("event_id", "cnt_1h", "mean_1h")


@query(f"WITH {EV}, {ZONE_CTE} SELECT * FROM zone")
def zone_demand(spark, sf_dir):
    return event_grain_features(events(spark, sf_dir), ZONE)


@query(f"WITH {EV}, {ZONE_CTE} SELECT * FROM zone")
def zone_demand_hot(spark, sf_dir):
    return event_grain_features(events(spark, sf_dir), ZONE, hot_rows=50)


@query(f"WITH {EV}, {ZONE_CTE} SELECT user_id, ts, cnt_1h, cnt_24h, mean_24h FROM zone")
def zone_demand_sliced(spark, sf_dir):
    e = events(spark, sf_dir).withColumn("u", epoch_seconds("ts"))
    return add_sliced_trailing_windows(e, ["user_id"], "u", FRAMES, ZONE.aggs, 7 * 86400).select("user_id", "ts", "cnt_1h", "cnt_24h", "mean_24h")


@query(f"WITH {EV} SELECT event_type, event_date, count(*) AS n, count(cents) AS cents_n, CAST(sum(cents) AS BIGINT) AS cents_sum FROM ev GROUP BY 1, 2")
def daily_partials_q(spark, sf_dir):
    d = daily_partials(events(spark, sf_dir), ["event_type"], "event_date", ["cents"])
    return d.select("event_type", "event_date", F.col("_n").alias("n"), F.col("_c_cents").alias("cents_n"), F.col("_s_cents").alias("cents_sum"))


@query(f"WITH {EV}, {DRIVER_CTE} SELECT event_type, event_date, d_cnt_7d, d_cnt_30d, d_mean_7d, d_mean_30d FROM driver")
def driver_history(spark, sf_dir):
    return day_grain_features(events(spark, sf_dir), DRIVER).drop("ts")


def _asof_sides(spark, sf_dir):
    e = events(spark, sf_dir)
    spine = e.where(F.col("event_type") == "click").select("event_id", "user_id", "ts")
    return spine, e.where(F.col("event_type") == "purchase").select("user_id", "ts", F.col("cents").alias("paid"))


def _asof_sql(tolerance: int, cols: str = "s.event_id, s.user_id, s.ts") -> str:
    ok = f"f.ts IS NOT NULL AND epoch_us(s.ts) // 1000000 - epoch_us(f.ts) // 1000000 <= {tolerance}"
    return (
        f"WITH {EV}, f AS (SELECT user_id, ts, max(cents) AS paid FROM ev WHERE event_type = 'purchase' GROUP BY 1, 2) "
        f"SELECT {cols}, CASE WHEN {ok} THEN f.ts END AS asof_ts, CASE WHEN {ok} THEN f.paid END AS paid "
        "FROM (SELECT * FROM ev WHERE event_type = 'click') s ASOF LEFT JOIN f ON s.user_id = f.user_id AND s.ts >= f.ts"
    )


@query(_asof_sql(10**9))
def asof_backward(spark, sf_dir):
    return as_of_join(*_asof_sides(spark, sf_dir), "ts", ["user_id"], 10**9)


@query(_asof_sql(86400))
def asof_tolerance(spark, sf_dir):
    return as_of_join(*_asof_sides(spark, sf_dir), "ts", ["user_id"], 86400)


@query(_asof_sql(86400))
def asof_sliced(spark, sf_dir):
    return as_of_join(*_asof_sides(spark, sf_dir), "ts", ["user_id"], 86400, slice_seconds=3 * 3600)


@query(_asof_sql(86400))
def asof_small_side(spark, sf_dir):
    return as_of_join(*_asof_sides(spark, sf_dir), "ts", ["user_id"], 86400, small_features=True)


@query(f"WITH {EV} SELECT event_id, user_id, ts, ts AS asof_ts, max(cents) OVER (PARTITION BY user_id, ts) AS cents FROM ev")
def asof_exact(spark, sf_dir):
    e = events(spark, sf_dir)
    return as_of_join(e.select("event_id", "user_id", "ts"), e.select("user_id", "ts", "cents"), "ts", ["user_id"], 0)


@query(_asof_sql(86400, "s.event_id, s.user_id, s.ts, s.cents AS paid").replace("END AS paid", "END AS asof_paid"))
def asof_collision(spark, sf_dir):
    spine, feats = _asof_sides(spark, sf_dir)
    spine = events(spark, sf_dir).where(F.col("event_type") == "click").select("event_id", "user_id", "ts", F.col("cents").alias("paid"))
    return as_of_join(spine, feats, "ts", ["user_id"], 86400)


@query(
    f"WITH {EV}, {ZONE_CTE}, {DRIVER_CTE}, z AS (SELECT user_id, ts, max(cnt_1h) AS cnt_1h, max(cnt_24h) AS cnt_24h, max(mean_24h) AS mean_24h FROM zone GROUP BY 1, 2) "
    "SELECT e.event_id, e.user_id, e.event_type, e.ts, z.cnt_1h, z.cnt_24h, z.mean_24h, "
    "CASE WHEN e.u - epoch_us(d.ts) // 1000000 <= 86400 THEN d.d_cnt_7d END AS d_cnt_7d, CASE WHEN e.u - epoch_us(d.ts) // 1000000 <= 86400 THEN d.d_mean_30d END AS d_mean_30d "
    "FROM ev e LEFT JOIN z ON e.user_id = z.user_id AND e.ts = z.ts ASOF LEFT JOIN driver d ON e.event_type = d.event_type AND e.ts >= d.ts"
)
def trip_features(spark, sf_dir):
    e = events(spark, sf_dir)
    groups = {"zone": event_grain_features(e, ZONE), "driver": day_grain_features(e, DRIVER).withColumn("ts", F.col("ts").cast("timestamp_ntz"))}
    out = compute_joined_features(e.select("event_id", "user_id", "event_type", "ts", "event_date"), groups, TRIP, small=("driver",))
    return out.select("event_id", "user_id", "event_type", "ts", "cnt_1h", "cnt_24h", "mean_24h", "d_cnt_7d", "d_mean_30d")


SUPP = "SELECT l_suppkey, count(*) AS c_count, CAST(sum(c) AS BIGINT) AS c_sum, avg(c) AS c_avg FROM (SELECT l_suppkey, CAST(round(l_extendedprice * 100) AS BIGINT) AS c FROM lineitem) GROUP BY 1"


@query(SUPP)
def group_agg(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", cents("l_extendedprice").alias("c"))
    return li.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("c_count"), F.sum("c").alias("c_sum"), F.avg("c").alias("c_avg"))


@query("SELECT l_suppkey, est_count FROM (SELECT l_suppkey, count(*) AS est_count FROM lineitem GROUP BY 1) WHERE est_count >= 600")
def hot_keys(spark, sf_dir):
    return hot_key_counts(table(spark, sf_dir, "lineitem"), "l_suppkey", 600)


@query(SUPP)
def salt_agg(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", cents("l_extendedprice").alias("c"))
    return salted_aggregate(li, ["l_suppkey"], "l_suppkey", find_hot_keys(li, "l_suppkey", 600), 16, [("c", "count"), ("c", "sum"), ("c", "avg")])


@query("SELECT l_orderkey, l_linenumber, n FROM (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2) WHERE n > 1")
def pk_unique(spark, sf_dir):
    return duplicate_key_groups(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT avg(CASE WHEN nullif(l_tax, 0) IS NULL THEN 1.0 ELSE 0.0 END) AS tax_rate, avg(CASE WHEN l_shipdate IS NULL THEN 1.0 ELSE 0.0 END) AS ship_rate FROM lineitem")
def null_rates(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(F.nullif(F.col("l_tax"), F.lit(0.0)).alias("l_tax"), "l_shipdate")
    return li.agg(null_rate("l_tax").alias("tax_rate"), null_rate("l_shipdate").alias("ship_rate"))


@query(
    "SELECT count(*) FILTER (WHERE l_quantity < 5 OR l_quantity > 45) AS quantity_bad, count(*) FILTER (WHERE nullif(l_tax, 0) IS NULL) AS tax_null, "
    "count(*) FILTER (WHERE nullif(l_tax, 0) > 0.05) AS tax_bad FROM lineitem"
)
def contract_counts(spark, sf_dir):
    c = TableContract("li", (column("l_quantity", "double", 5, 45), column("l_tax", "double", None, 0.05, nullable=False)))
    li = table(spark, sf_dir, "lineitem").select("l_quantity", F.nullif(F.col("l_tax"), F.lit(0.0)).alias("l_tax"))
    return li.agg(*[x.alias(n) for x, n in zip(value_counters(c).values(), ("quantity_bad", "tax_null", "tax_bad"), strict=True)])


@query("SELECT 'row_count_floor' AS name, count(*) >= 100 AS passed, CAST(count(*) AS VARCHAR) AS measured, '100' AS threshold FROM events")
def row_count_floor(spark, sf_dir):
    return results_frame(spark, [check_row_count_floor(table(spark, sf_dir, "events").count(), 100)])


@query(
    "WITH x AS (SELECT count(*) AS n, count(*) - count(DISTINCT event_id) AS twice, max(ts) AS newest, avg(CASE WHEN nullif(user_id % 10, 0) IS NULL THEN 1.0 ELSE 0.0 END) AS r FROM events) "
    "SELECT 'contract:events' AS name, true AS passed FROM x UNION ALL SELECT 'null_rate:tenth', r <= 0.9 FROM x UNION ALL SELECT 'primary_key_unique', twice = 0 FROM x "
    "UNION ALL SELECT 'row_count_floor', n >= 100 FROM x UNION ALL SELECT 'partition_row_floor', true FROM x "
    "UNION ALL SELECT 'freshness', newest BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-02-10' FROM x"
)
def gates_report(spark, sf_dir):
    e = events(spark, sf_dir).withColumn("tenth", F.nullif(F.col("user_id") % 10, F.lit(0).cast("long")))
    contract = TableContract("events", (column("event_id", "long", 0, None, nullable=False), column("event_date", "date")))
    found, _ = run_gates(e, contract, {"tenth": 0.9}, ["event_id"], 100, e, 0.9, "event_date", {"ts_col": "ts", "lower": "2024-01-01", "upper": "2024-02-10"})
    return results_frame(spark, found).select("name", "passed")


@query("SELECT CAST(ts AS DATE) AS event_date, count(*) AS n FROM events GROUP BY 1")
def partition_counts_q(spark, sf_dir):
    return partition_counts(events(spark, sf_dir))


@query(
    "WITH p AS (SELECT CAST(ts AS DATE) AS event_date, count(*) AS prior_n FROM events GROUP BY 1), "
    "n AS (SELECT CAST(ts AS DATE) AS event_date, count(*) AS now_n FROM events WHERE NOT (day(ts) = 3 OR (day(ts) = 7 AND event_id % 2 = 0)) GROUP BY 1) "
    "SELECT p.event_date, prior_n, coalesce(now_n, 0) AS now_n FROM p LEFT JOIN n ON p.event_date = n.event_date WHERE coalesce(now_n, 0) < prior_n * 0.9"
)
def partition_floor(spark, sf_dir):
    e = events(spark, sf_dir)
    day = F.dayofmonth("ts")
    now = e.where(~((day == 3) | ((day == 7) & (F.col("event_id") % 2 == 0))))
    return partitions_below_floor(now, e, 0.9)


@query("SELECT max(ts) AS newest, max(ts) BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-02-10' AS passed FROM events")
def freshness(spark, sf_dir):
    found = check_freshness(table(spark, sf_dir, "events"), "ts", "2024-01-01", "2024-02-10")
    return results_frame(spark, [found]).select(F.col("measured").cast("timestamp_ntz").alias("newest"), "passed")


@query("SELECT DISTINCT CAST(ts AS DATE) AS event_date FROM events")
def distinct_dates(spark, sf_dir):
    return events(spark, sf_dir).select("event_date").distinct().orderBy("event_date")


@query("SELECT user_id, event_type, event_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1")
def dedup_latest(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "ts")
    return dedup_keep_latest(e, ["user_id", "event_type"], "ts", ["event_id"])


@query("SELECT event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1 AND event_type IN ('click', 'purchase')")
def latest_per_group(spark, sf_dir):
    e = table(spark, sf_dir, "events").where(F.col("event_type").isin("click", "purchase")).select("event_type", "event_id", "ts")
    return first_per_group(e, ["event_type"], [F.col("ts").desc(), F.col("event_id").desc()]).drop("ts")


@query("SELECT event_id, user_id FROM events")
def repartition_identity(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "user_id").repartition("user_id")


SPLITS = {"train": ("2024-01-01", "2024-01-20"), "val": ("2024-01-20", "2024-01-25"), "test": ("2024-01-25", "2024-01-31")}
SPLIT_SQL = "CASE WHEN event_date < DATE '2024-01-20' THEN 'train' WHEN event_date < DATE '2024-01-25' THEN 'val' ELSE 'test' END"
SPLIT_WHERE = "event_date >= DATE '2024-01-01' AND event_date < DATE '2024-01-31'"


@query(f"WITH {EV} SELECT event_id, {SPLIT_SQL} AS split FROM ev WHERE {SPLIT_WHERE} AND cents % 7 <> 0")
def training_split(spark, sf_dir):
    e = events(spark, sf_dir).withColumn("label", F.nullif(F.col("cents") % 7, F.lit(0).cast("long")))
    frame = training_frame(e, SPLITS, "label", "event_date", "ts", numeric=("event_id", "hour_of_day"), categorical=("user_id",))
    return frame.select("event_id", "split")


@query(f"WITH {EV} SELECT event_id, CAST(hour(ts) AS DOUBLE) AS hour_of_day, CAST(event_date AS TIMESTAMP) AS day_start FROM ev")
def training_features(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", hour_of_day("ts").alias("hour_of_day"), day_start("event_date").cast("timestamp_ntz").alias("day_start"))


@query(
    f"WITH {EV}, m AS (SELECT avg(cents) AS mean FROM ev WHERE event_date < DATE '2024-01-20'), t AS (SELECT cents, cents - mean AS e FROM ev, m WHERE event_date >= DATE '2024-01-25' AND event_date < DATE '2024-01-31') "
    "SELECT round(sqrt(avg(e * e)), 4) AS rmse, round(avg(abs(e)), 4) AS mae, round(1 - sum(e * e) / (count(*) * var_pop(cents)), 6) AS r2 FROM t"
)
def baseline_metrics_q(spark, sf_dir):
    e = events(spark, sf_dir).withColumn("split", split_column("event_date", SPLITS))
    m = baseline_metrics(e.where(F.col("split") == "train"), e.where(F.col("split") == "test"), "cents")
    return m.select(F.round("rmse", 4).alias("rmse"), F.round("mae", 4).alias("mae"), F.round("r2", 6).alias("r2"))


@query(
    f"WITH {EV}, c AS (SELECT event_type, count(*) AS n FROM ev GROUP BY 1) SELECT CAST(median(cents) AS DOUBLE) AS cents_median, "
    "(SELECT event_type FROM c ORDER BY n DESC, event_type LIMIT 1) AS event_type_mode FROM ev"
)
def impute_stats_q(spark, sf_dir):
    return impute_stats(events(spark, sf_dir), ["cents"], ["event_type"])


@query(f"WITH {EV}, m AS (SELECT avg(cents) AS m, stddev_pop(cents) AS s FROM ev WHERE event_date < DATE '2024-01-20') SELECT event_id, round((cents - m) / (s + 1e-6), 6) AS z FROM ev, m")
def standardize_q(spark, sf_dir):
    from ambermill.plans.training import standardize

    e = events(spark, sf_dir)
    z = standardize(e.where(F.col("event_date") < F.lit("2024-01-20").cast("date")), e.select("event_id", "cents"), ["cents"])
    return z.select("event_id", F.round("cents", 6).alias("z"))


@query("SELECT CAST(row_number() OVER (ORDER BY d) - 1 AS INTEGER) AS pos, strftime(d, '%Y-%m') AS month FROM (SELECT unnest(range(DATE '2023-11-01', DATE '2024-02-02', INTERVAL 1 MONTH)) AS d)")
def month_range_q(spark, sf_dir):
    return month_range(spark, "2023-11", "2024-02")


@query("SELECT user_id, substr(sha256(event_type || 'abc' || list_aggregate(list_sort(list(CAST(event_id AS VARCHAR))), 'string_agg', '')), 1, 32) AS run_key FROM events GROUP BY user_id, event_type")
def run_key_q(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    runs = e.groupBy("user_id", "event_type").agg(F.collect_list(F.col("event_id").cast("string")).alias("paths"))
    return runs.select("user_id", run_key_column(F.col("event_type"), F.lit("abc"), F.col("paths")).alias("run_key"))


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def tumbling_counts_q(spark, sf_dir):
    from ambermill.streaming.gated import tumbling_counts

    return tumbling_counts(table(spark, sf_dir, "events"), "ts", ["event_type"])


def queries() -> dict[str, Query]:
    return {k.removesuffix("_q"): v for k, v in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k.removesuffix("_q"): v for k, v in ORACLES.items()}
