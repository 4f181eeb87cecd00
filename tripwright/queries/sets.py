"""Set operations, joins of every kind, history, intervals and windows over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripwright.operators import reconcile
from tripwright.operators.intervals import interval_join, overlaps
from tripwright.operators.issues import ISSUES
from tripwright.operators.stations import conflicts, exact_duplicates
from tripwright.plans import enrichment
from tripwright.plans.station_history import islands
from tripwright.queries.trips import TRIPS_SQL, table, trip_view
from tripwright.schemas import CLEAN, struct


def _keyed(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf, "orders")
    left = orders.select((F.col("o_custkey") % 200).alias("k"), "o_orderstatus")
    right = orders.select((F.col("o_custkey") % 150 + 20).alias("k"), "o_orderstatus")
    return left, right


_KEYED_SQL = """
l AS (SELECT o_custkey % 200 AS k, o_orderstatus FROM orders),
r AS (SELECT o_custkey % 150 + 20 AS k, o_orderstatus FROM orders)"""


def q_reconcile(spark: SparkSession, sf: str) -> DataFrame:
    """All orders against themselves with some keys negated and some priorities gone."""
    left = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    key = F.col("o_orderkey")
    right = left.select(
        F.when(key % 7 == 0, -key).otherwise(key).alias("o_orderkey"),
        F.when(key % 11 != 0, F.col("o_orderpriority")).alias("o_orderpriority"), "o_totalprice",
    )
    return reconcile.full_outer_changes(left, right, ["o_orderkey"], ["o_orderpriority", "o_totalprice"]).select("o_orderkey", "status")


def q_null_safe(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    a = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderpriority"))
    b = F.when(F.col("o_custkey") % 2 != 0, F.col("o_orderpriority"))
    return orders.select("o_orderkey", (~a.eqNullSafe(b)).alias("is_distinct"), (a != b).alias("plain"))


def q_running(spark: SparkSession, sf: str) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey").rowsBetween(Window.unboundedPreceding, 0)
    flag = F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)
    return table(spark, sf, "orders").select("o_orderkey", F.sum(flag).over(w).alias("run"))


def _observations(spark: SparkSession, sf: str) -> DataFrame:
    """Daily states per user: the number of event types seen, and whether anything was bought."""
    day = F.to_date("ts")
    return table(spark, sf, "events").groupBy((F.col("user_id") % 60).alias("station_no"), day.alias("applicable_from")).agg(
        F.min("event_type").alias("first_type"),
        F.max(F.when(F.col("event_type") == "purchase", "bought")).alias("bought"),
    ).withColumn("snapshot_seq", F.datediff("applicable_from", F.lit("2023-12-31").cast("date")))


def q_islands(spark: SparkSession, sf: str) -> DataFrame:
    seen = _observations(spark, sf).withColumn("day_text", F.col("applicable_from").cast("string"))
    snapshots = seen.select("snapshot_seq", "applicable_from").distinct()
    out = islands(seen, snapshots, state=("first_type", "bought"), lists={"day_text": "days"})
    return out.withColumn("days", F.array_join("days", ","))


_OBSERVED_SQL = """
seen AS (SELECT user_id % 60 AS station_no, CAST(ts AS DATE) AS applicable_from, min(event_type) AS first_type,
                max(CASE WHEN event_type = 'purchase' THEN 'bought' END) AS bought,
                CAST(CAST(ts AS DATE) - DATE '2023-12-31' AS INTEGER) AS snapshot_seq FROM events GROUP BY 1, 2, 5)"""
_ISLANDS_SQL = (
    _OBSERVED_SQL
    + """,
lagged AS (SELECT *, lag(snapshot_seq) OVER w AS s0, lag(first_type) OVER w AS f0, lag(bought) OVER w AS b0
           FROM seen WINDOW w AS (PARTITION BY station_no ORDER BY snapshot_seq)),
runs AS (SELECT *, sum(CASE WHEN s0 IS NULL OR snapshot_seq <> s0 + 1 OR first_type IS DISTINCT FROM f0
                  OR bought IS DISTINCT FROM b0 THEN 1 ELSE 0 END) OVER (PARTITION BY station_no ORDER BY snapshot_seq) AS run FROM lagged),
made AS (SELECT station_no, min(applicable_from) AS applicable_from, max(snapshot_seq) AS last_seq,
                first(first_type ORDER BY snapshot_seq) AS first_type, first(bought ORDER BY snapshot_seq) AS bought,
                string_agg(CAST(applicable_from AS VARCHAR), ',' ORDER BY snapshot_seq) AS days,
                CAST(count(*) AS INTEGER) AS observation_count FROM runs GROUP BY station_no, run),
snaps AS (SELECT DISTINCT snapshot_seq, applicable_from FROM seen),
history AS (SELECT m.station_no, m.applicable_from, s.applicable_from AS applicable_until, first_type, bought, days, observation_count
            FROM made m LEFT JOIN snaps s ON s.snapshot_seq = m.last_seq + 1)"""
)


def _intervals(spark: SparkSession, sf: str) -> DataFrame:
    """Half-open spans per station: 400 days from every 600th, of three stations in four."""
    parts = spark.range(0, 50).where("id % 4 <> 0").select(F.col("id").cast("string").alias("key"), F.explode(F.sequence(F.lit(0), F.lit(4))).alias("n"))
    start = F.date_add(F.lit("1995-01-01").cast("date"), F.col("n") * 600)
    return parts.select("key", start.alias("valid_from"), F.when(F.col("n") < 4, F.date_add(start, 400)).alias("valid_until"))


_INTERVALS_SQL = """
spans AS (SELECT CAST(s AS VARCHAR) AS key, CAST(DATE '1995-01-01' + CAST(n * 600 AS INTEGER) AS DATE) AS valid_from,
                 CASE WHEN n < 4 THEN CAST(DATE '1995-01-01' + CAST(n * 600 + 400 AS INTEGER) AS DATE) END AS valid_until
          FROM range(50) a(s), range(5) b(n) WHERE s % 4 <> 0)"""


def q_interval(spark: SparkSession, sf: str) -> DataFrame:
    joined = interval_join(trip_view(spark, sf), _intervals(spark, sf), F.col("rent_station_no"), F.to_date("rent_at"), rows_known=250)
    return joined.groupBy("rent_station_no", "valid_from", "valid_until").agg(
        F.count(F.lit(1)).alias("trips"), F.count_if("is_completed_trip").alias("completed")
    )


def q_overlap(spark: SparkSession, sf: str) -> DataFrame:
    spans = _intervals(spark, sf).withColumn("valid_until", F.date_add("valid_until", F.col("key").cast("int") * 10))
    return overlaps(spans, "key", "valid_from", "valid_until")


def q_fact(spark: SparkSession, sf: str) -> DataFrame:
    return trip_view(spark, sf).where("distance_metric_eligible").select("bike_id", F.to_date("rent_at").alias("rent_date"), "rent_station_no", "return_station_no", "usage_min")


def q_fact_enriched(spark: SparkSession, sf: str) -> DataFrame:
    """The fact table's columns through :func:`enrich` and :func:`fact`; a trip that can be measured is trusted."""
    trips = trip_view(spark, sf).withColumns(
        {"trusted_fact_eligible": F.col("distance_metric_eligible"), "dq_issues": F.array().cast(ISSUES), "dq_warning_count": F.lit(0)}
    )
    clean = trips.select(*[n if n in trips.columns else F.lit(None).cast(f.dataType).alias(n) for (n, _), f in zip(CLEAN, struct(CLEAN), strict=True)])
    spans = _intervals(spark, sf)
    history = spans.select(F.col("key").alias("station_no"), F.col("valid_from").alias("applicable_from"), F.col("valid_until").alias("applicable_until"))
    rows = enrichment.fact(enrichment.enrich(clean, history, history_rows=250))
    return rows.select(
        "bike_id", F.to_date("rent_at").alias("rent_date"), "rent_station_no", "return_station_no", "usage_min", "station_history_match",
        "matched_station_applicable_from", "matched_station_applicable_until", "dq_warning_count", F.get("dq_issues", F.lit(0))["rule_id"].alias("rule_id"),
    )


def q_consolidate(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer").select(
        (F.col("c_custkey") % 700).alias("station_no"), F.col("c_nationkey").alias("a"),
        F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).alias("b"),
    )
    return conflicts(rows, "station_no", ("a", "b")).withColumn("conflict_fields", F.array_join("conflict_fields", ","))


def q_repeats(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").withColumn("content", F.concat_ws("|", "event_type", F.to_date("ts").cast("string")))
    return exact_duplicates(rows, "user_id", "content", "event_id").select("event_id", "is_repeat")


def q_months(spark: SparkSession, sf: str) -> DataFrame:
    """Two versions of a yearly source, month by month: NEW, UNCHANGED, REVISED or REMOVED."""
    orders = table(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    moved = lambda a, b: F.when(F.col("month") == a, b).otherwise(F.col("month")).alias("month")
    content = lambda df: df.groupBy("month").agg(F.count(F.lit(1)).alias("size"), F.sum("o_orderkey").alias("sum"))
    old = content(orders.select("o_orderkey", moved("1999-02", "1999-01")))
    new = content(orders.select("o_orderkey", moved("1996-05", "1996-06")))
    joined = old.alias("a").join(new.alias("b"), "month", "full_outer")
    same = F.col("a.size").eqNullSafe(F.col("b.size")) & F.col("a.sum").eqNullSafe(F.col("b.sum"))
    status = F.when(F.col("a.size").isNull(), "NEW").when(F.col("b.size").isNull(), "REMOVED").when(same, "UNCHANGED").otherwise("REVISED")
    return joined.select("month", status.alias("status"))


def q_latest(spark: SparkSession, sf: str) -> DataFrame:
    """The latest event per type; ties go to the larger id."""
    return table(spark, sf, "events").groupBy("event_type").agg(F.max(F.struct("ts", "event_id")).alias("m")).select(
        "event_type", F.col("m.event_id").alias("event_id")
    )


def _pair(name):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        left, right = _keyed(spark, sf)
        return {
            "set": lambda: reconcile.difference(left, right),
            "multiset": lambda: reconcile.multiset_difference(left, right),
            "union": lambda: left.unionByName(right).distinct(),
            "union_all": lambda: left.unionByName(right).groupBy("k").agg(F.count(F.lit(1)).alias("n")),
            "semi": lambda: reconcile.present(left, right, ["k"]),
            "anti": lambda: reconcile.missing(left, right, ["k"]),
        }[name]()

    return run


QUERIES = {
    "set_difference": _pair("set"),
    "multiset_difference": _pair("multiset"),
    "union_distinct": _pair("union"),
    "union_all": _pair("union_all"),
    "semi_missing": _pair("semi"),
    "anti_missing": _pair("anti"),
    "distinct_values": lambda spark, sf: table(spark, sf, "orders").select("o_orderstatus", "o_orderpriority").distinct(),
    "full_outer_reconciliation": q_reconcile,
    "null_safe_compare": q_null_safe,
    "running_total_frame": q_running,
    "station_history_islands": q_islands,
    "interval_enrichment": q_interval,
    "interval_overlap_check": q_overlap,
    "trusted_fact_projection": q_fact,
    "fact_trip_trusted": q_fact_enriched,
    "same_snapshot_consolidation": q_consolidate,
    "exact_duplicate_rows": q_repeats,
    "month_inventory_diff": q_months,
    "latest_event": q_latest,
}

ORACLES = {
    "set_difference": f"WITH {_KEYED_SQL} SELECT * FROM l EXCEPT SELECT * FROM r",
    "multiset_difference": f"WITH {_KEYED_SQL} SELECT * FROM l EXCEPT ALL SELECT * FROM r",
    "union_distinct": f"WITH {_KEYED_SQL} SELECT * FROM l UNION SELECT * FROM r",
    "union_all": f"WITH {_KEYED_SQL}, u AS (SELECT * FROM l UNION ALL SELECT * FROM r) SELECT k, COUNT(*) AS n FROM u GROUP BY k",
    "semi_missing": f"WITH {_KEYED_SQL} SELECT * FROM l WHERE EXISTS (SELECT 1 FROM r WHERE r.k = l.k)",
    "anti_missing": f"WITH {_KEYED_SQL} SELECT * FROM l WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.k = l.k)",
    "distinct_values": "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders",
    "full_outer_reconciliation": """WITH a AS (SELECT * FROM orders),
b AS (SELECT CASE WHEN o_orderkey % 7 = 0 THEN -o_orderkey ELSE o_orderkey END AS o_orderkey,
  CASE WHEN o_orderkey % 11 <> 0 THEN o_orderpriority END AS o_orderpriority, o_totalprice FROM orders),
j AS (SELECT COALESCE(a.o_orderkey, b.o_orderkey) AS o_orderkey, CASE WHEN a.o_orderkey IS NULL THEN 'ONLY_RIGHT'
  WHEN b.o_orderkey IS NULL THEN 'ONLY_LEFT' WHEN a.o_orderpriority IS DISTINCT FROM b.o_orderpriority
  OR a.o_totalprice IS DISTINCT FROM b.o_totalprice THEN 'CHANGED' END AS status FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey)
SELECT * FROM j WHERE status IS NOT NULL""",
    "null_safe_compare": """WITH x AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END AS a,
  CASE WHEN o_custkey % 2 <> 0 THEN o_orderpriority END AS b FROM orders)
SELECT o_orderkey, a IS DISTINCT FROM b AS is_distinct, a <> b AS plain FROM x""",
    "running_total_frame": """SELECT o_orderkey, CAST(SUM(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) OVER (PARTITION BY o_custkey
  ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS run FROM orders""",
    "station_history_islands": f"WITH {_ISLANDS_SQL} SELECT * FROM history",
    "interval_enrichment": f"""WITH {TRIPS_SQL}, {_INTERVALS_SQL}
SELECT rent_station_no, valid_from, valid_until, COUNT(*) AS trips, COUNT(*) FILTER (WHERE is_completed_trip) AS completed
FROM trips LEFT JOIN spans ON key = rent_station_no AND CAST(rent_at AS DATE) >= valid_from
  AND (valid_until IS NULL OR CAST(rent_at AS DATE) < valid_until) GROUP BY 1, 2, 3""",
    "interval_overlap_check": f"""WITH {_INTERVALS_SQL},
longer AS (SELECT key, valid_from, CAST(valid_until + CAST(CAST(key AS INTEGER) * 10 AS INTEGER) AS DATE) AS valid_until FROM spans),
w AS (SELECT *, lag(valid_until) OVER (PARTITION BY key ORDER BY valid_from) AS previous_until,
             row_number() OVER (PARTITION BY key ORDER BY valid_from) AS nth FROM longer)
SELECT key, valid_from, valid_until, previous_until FROM w WHERE nth > 1 AND (previous_until IS NULL OR previous_until > valid_from)""",
    "trusted_fact_projection": f"""WITH {TRIPS_SQL}
SELECT bike_id, CAST(rent_at AS DATE) AS rent_date, rent_station_no, return_station_no, usage_min FROM trips WHERE distance_metric_eligible""",
    "fact_trip_trusted": f"""WITH {TRIPS_SQL}, {_INTERVALS_SQL}
SELECT bike_id, CAST(rent_at AS DATE) AS rent_date, rent_station_no, return_station_no, usage_min, key IS NOT NULL AS station_history_match,
  valid_from AS matched_station_applicable_from, valid_until AS matched_station_applicable_until,
  CASE WHEN key IS NULL THEN 1 ELSE 0 END AS dq_warning_count, CASE WHEN key IS NULL THEN 'station_history_unmatched' END AS rule_id
FROM trips LEFT JOIN spans ON key = rent_station_no AND CAST(rent_at AS DATE) >= valid_from
  AND (valid_until IS NULL OR CAST(rent_at AS DATE) < valid_until) WHERE distance_metric_eligible""",
    "same_snapshot_consolidation": """WITH r AS (SELECT c_custkey % 700 AS station_no, c_nationkey AS a,
  CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS b FROM customer)
SELECT station_no, COUNT(*) AS n_rows, MIN(a) AS a, MIN(b) AS b,
  concat_ws(',', CASE WHEN COUNT(DISTINCT a) > 1 THEN 'a' END, CASE WHEN COUNT(DISTINCT b) > 1 THEN 'b' END) AS conflict_fields
FROM r GROUP BY 1""",
    "exact_duplicate_rows": """SELECT event_id, row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE) ORDER BY event_id) > 1 AS is_repeat FROM events""",
    "month_inventory_diff": """WITH o AS (SELECT *, strftime(o_orderdate, '%Y-%m') AS month FROM orders),
a AS (SELECT CASE WHEN month = '1999-02' THEN '1999-01' ELSE month END AS month, COUNT(*) AS n, SUM(o_orderkey) AS s FROM o GROUP BY 1),
b AS (SELECT CASE WHEN month = '1996-05' THEN '1996-06' ELSE month END AS month, COUNT(*) AS n, SUM(o_orderkey) AS s FROM o GROUP BY 1)
SELECT COALESCE(a.month, b.month) AS month, CASE WHEN a.n IS NULL THEN 'NEW' WHEN b.n IS NULL THEN 'REMOVED'
  WHEN a.n = b.n AND a.s = b.s THEN 'UNCHANGED' ELSE 'REVISED' END AS status FROM a FULL JOIN b ON a.month = b.month""",
    "latest_event": """SELECT event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1""",
}
