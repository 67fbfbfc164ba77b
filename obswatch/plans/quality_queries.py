"""Checks, incidents, gates and reports over the driver's tables."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from obswatch.functions import calendar as cal
from obswatch.functions import text as tx
from obswatch.operators import checks, series, state
from obswatch.plans.registry import query
from obswatch.plans.tables import DAILY, SHIPS, daily_orders, daily_ships, read

_STATUS = "CASE WHEN event_type = 'error' THEN 'failed' ELSE 'succeeded' END"
_RUNS = f"runs AS (SELECT event_id, user_id % 7 AS source, ts AS started_at, {_STATUS} AS status, CASE WHEN event_id % 5 <> 0 THEN value END AS rate FROM events)"


def runs(spark, sf):
    """events as a run log: errors are failed runs."""
    e = read(spark, sf, "events")
    return e.select("event_id", (F.col("user_id") % 7).alias("source"), F.col("ts").alias("started_at"), F.when(F.col("event_type") == "error", "failed").otherwise("succeeded").alias("status"), F.when(F.col("event_id") % 5 != 0, F.col("value")).alias("rate"))


@query("SELECT l_orderkey, l_linenumber, count(*)::BIGINT AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def dup_keys(spark, sf):
    return checks.duplicate_keys(read(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""SELECT l_orderkey, l_linenumber, l_quantity FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC) AS r FROM lineitem) WHERE r = 1""")
def last_wins_dedupe(spark, sf):
    items = read(spark, sf, "lineitem")
    return series.latest(items, ["l_orderkey", "l_linenumber"], *(F.desc(c) for c in ("l_shipdate", "l_partkey", "l_suppkey", "l_quantity"))).select("l_orderkey", "l_linenumber", "l_quantity")


@query("""SELECT c_custkey, 'old' AS origin FROM customer WHERE c_custkey % 3 <> 0 UNION ALL SELECT c_custkey, 'new' FROM customer WHERE c_custkey % 3 = 0""")
def keyed_upsert(spark, sf):
    c = read(spark, sf, "customer").select("c_custkey")
    return state.upsert(c.withColumn("origin", F.lit("old")), c.where("c_custkey % 3 = 0").withColumn("origin", F.lit("new")), ["c_custkey"])


_NULLS = "SELECT CASE WHEN event_id % 4 = 0 THEN NULL ELSE value END AS a, CASE WHEN event_id % 10 = 3 THEN NULL ELSE props END AS b, event_type AS c FROM events"


def _nulls(spark, sf):
    e = read(spark, sf, "events")
    return e.select(F.when(F.col("event_id") % 4 != 0, F.col("value").cast("string")).alias("a"), F.when(F.col("event_id") % 10 != 3, F.col("props")).alias("b"), F.col("event_type").alias("c"))


@query(f"""WITH t AS ({_NULLS}) SELECT unnest(['a', 'b', 'c']) AS "column", unnest([round(avg((a IS NULL)::INT), 6), round(avg((b IS NULL)::INT), 6), round(avg((c IS NULL)::INT), 6)]) AS null_rate FROM t""")
def null_rate_columns(spark, sf):
    return checks.null_rates(_nulls(spark, sf), ["a", "b", "c"]).select("column", F.round("null_rate", 6).alias("null_rate"))


@query(f"WITH t AS ({_NULLS}) SELECT round(sum((a IS NULL)::INT + (b IS NULL)::INT + (c IS NULL)::INT) / (3.0 * count(*)), 6)::DOUBLE AS null_rate FROM t")
def null_rate_cells(spark, sf):
    return checks.cell_null_rate(_nulls(spark, sf), ["a", "b", "c"]).select(F.round("null_rate", 6).alias("null_rate"))


@query(f"""WITH {_RUNS}, l AS (SELECT source, max(started_at) FILTER (WHERE status = 'succeeded') AS last_success FROM runs GROUP BY 1)
SELECT source, last_success, date_diff('day', last_success::DATE, DATE '2024-02-01')::INT AS age_days, coalesce(date_diff('day', last_success::DATE, DATE '2024-02-01') > 2, true) AS failed FROM l""")
def freshness(spark, sf):
    return checks.freshness(checks.latest_success(runs(spark, sf)), F.lit("2024-02-01").cast("date"))


@query(f"""WITH {_RUNS}, c AS (SELECT source, count(*)::BIGINT AS row_count FROM runs WHERE status = 'succeeded' GROUP BY 1), e AS (SELECT * FROM (VALUES (0, 1, NULL), (1, 7, 7), (2, 1, 1000000), (3, 100000000, NULL)) t(source, low, high))
SELECT c.source, row_count, (row_count < low OR coalesce(row_count > high, false)) AS failed FROM c JOIN e ON c.source = e.source""")
def volume(spark, sf):
    counts = runs(spark, sf).where("status = 'succeeded'").groupBy("source").agg(F.count("*").alias("row_count"))
    expected = spark.createDataFrame([(0, 1, None), (1, 7, 7), (2, 1, 1000000), (3, 100000000, None)], "source long, low long, high long")
    return checks.volume(counts, expected).select("source", "row_count", "failed")


@query(f"""WITH {_RUNS}, z AS (SELECT *, timezone('America/New_York', timezone('UTC', started_at::TIMESTAMP))::DATE AS run_date FROM runs), w AS (SELECT *,
  max(started_at) FILTER (WHERE status = 'succeeded') OVER (PARTITION BY source ORDER BY started_at, event_id ROWS UNBOUNDED PRECEDING) AS last_success,
  row_number() OVER (PARTITION BY source, run_date ORDER BY started_at DESC, event_id DESC) AS r,
  list(rate) FILTER (WHERE rate IS NOT NULL) OVER (PARTITION BY source ORDER BY started_at, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM z)
SELECT run_date, source, status, last_success, round(rate, 4) AS null_rate, round(list_avg(list_slice(seen, greatest(len(seen) - 29, 1)::BIGINT, len(seen)::BIGINT)), 8) AS null_rate_normal FROM w WHERE r = 1""")
def source_status(spark, sf):
    order = ["started_at", "event_id"]
    w = W.partitionBy("source").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    log = series.trailing_mean(runs(spark, sf), "rate", ["source"], order, 30, "normal").withColumn("last_success", F.max(F.when(F.col("status") == "succeeded", F.col("started_at"))).over(w)).withColumn("run_date", cal.local_date(F.col("started_at")))
    return series.latest(log, ["source", "run_date"], *map(F.desc, order)).select("run_date", "source", "status", "last_success", F.round("rate", 4).alias("null_rate"), F.round("normal", 8).alias("null_rate_normal"))


@query("""SELECT event_id, array_to_string(list_filter([CASE WHEN coalesce(json_extract_string(props, '$.k') <> '1', true) THEN 'k' END, CASE WHEN coalesce(json_extract_string(props, '$.unit') <> 'C', true) THEN 'unit' END], lambda x: x IS NOT NULL), ',') AS problems FROM events""")
def unit_check_json(spark, sf):
    return read(spark, sf, "events").select("event_id", F.array_join(tx.unit_problems(F.col("props"), {"k": "1", "unit": "C"}), ",").alias("problems"))


@query(f"WITH {DAILY}, {SHIPS}, l AS (SELECT obs_date, CASE WHEN n NOT BETWEEN 2 AND 9 THEN 'n' WHEN quantity NOT BETWEEN 15 AND 35 THEN 'quantity' END AS counter, n, quantity FROM daily JOIN ships USING (obs_date)) SELECT obs_date, counter, CASE counter WHEN 'n' THEN n ELSE quantity END AS value FROM l WHERE counter IS NOT NULL")
def range_suspects(spark, sf):
    both = daily_orders(spark, sf).join(daily_ships(spark, sf), "obs_date")
    return checks.ranges(both, ["obs_date"], {"n": (2, 9), "quantity": (15, 35)})


@query(f"WITH {DAILY}, {SHIPS}, d AS (SELECT DISTINCT obs_date FROM daily WHERE obs_date < DATE '2001-07-01'), j AS (SELECT (ships.obs_date IS NOT NULL)::INT AS t FROM d LEFT JOIN ships USING (obs_date)) SELECT count(*)::BIGINT AS n_days, round(avg(t), 6) AS kept, count(*) >= 5 AS judged, count(*) >= 5 AND avg(t) < 0.9 AS failed FROM j")
def join_retention(spark, sf):
    out = checks.retention(daily_orders(spark, sf), daily_ships(spark, sf), "obs_date", F.lit("2001-07-01").cast("date"))
    return out.withColumn("kept", F.round("kept", 6))


@query("WITH c AS (SELECT ts::DATE AS day, count(*) FILTER (WHERE event_type = 'click') AS a, count(*) FILTER (WHERE event_type = 'view') AS b FROM events GROUP BY 1) SELECT day, (a - b)::BIGINT AS disagreement FROM c WHERE a > 0 AND b > 0")
def counter_disagreement(spark, sf):
    c = read(spark, sf, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count_if(F.col("event_type") == "click").alias("a"), F.count_if(F.col("event_type") == "view").alias("b"))
    return c.where("a > 0 and b > 0").select("day", (F.col("a") - F.col("b")).alias("disagreement"))


def _quarantine(spark, sf):
    o = read(spark, sf, "orders").where("o_orderstatus = 'F'")
    q = o.groupBy("o_custkey").agg(F.max("o_orderdate").alias("opened_at")).select(tx.observation_id("customer", F.col("o_custkey")).alias("obs_id"), "opened_at")
    d = o.where("o_custkey % 3 <> 0").select("o_custkey").distinct().select(tx.observation_id("customer", F.col("o_custkey")).alias("obs_id"), F.when(F.col("o_custkey") % 3 == 1, "confirmed").otherwise("rejected").alias("decision"), F.lit("2002-01-01").cast("timestamp_ntz").alias("decided_at"))
    return q, d


_Q = "q AS (SELECT 'customer:' || o_custkey AS obs_id, max(o_orderdate) AS opened_at, o_custkey FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey), d AS (SELECT obs_id, CASE WHEN o_custkey % 3 = 1 THEN 'confirmed' ELSE 'rejected' END AS decision, TIMESTAMP '2002-01-01' AS decided_at FROM q WHERE o_custkey % 3 <> 0)"


@query(f"WITH {_Q} SELECT q.obs_id FROM q LEFT JOIN d USING (obs_id) WHERE d.obs_id IS NULL")
def anti_open_items(spark, sf):
    q, d = _quarantine(spark, sf)
    return state.open_items(q, d).select("obs_id")


@query(f"WITH {_Q} SELECT c_custkey FROM customer c WHERE NOT EXISTS (SELECT 1 FROM q LEFT JOIN d ON d.obs_id = q.obs_id WHERE q.obs_id = 'customer:' || c.c_custkey AND coalesce(d.decision, 'open') <> 'confirmed')")
def gate_not_exists(spark, sf):
    return state.gate(read(spark, sf, "customer"), tx.observation_id("customer", F.col("c_custkey")), state.held_out(*_quarantine(spark, sf))).select("c_custkey")


@query(f"WITH {_Q} SELECT split_part(q.obs_id, ':', 2)::BIGINT AS held FROM q LEFT JOIN d USING (obs_id) WHERE coalesce(decision, 'open') <> 'confirmed'")
def held_out_keys(spark, sf):
    return state.held_out(*_quarantine(spark, sf)).select(F.split_part("obs_id", F.lit(":"), F.lit(2)).try_cast("long").alias("held"))


@query(f"WITH {_Q} SELECT q.obs_id, coalesce(decision, 'open') AS status, date_diff('day', opened_at::DATE, coalesce(decided_at::DATE, DATE '2002-06-01'))::INT AS days_open FROM q LEFT JOIN d USING (obs_id)")
def quarantine_queue(spark, sf):
    q, d = _quarantine(spark, sf)
    return state.queue(q, d, F.lit("2002-06-01").cast("date")).select("obs_id", "status", "days_open")


@query("SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'O')::BIGINT AS n_open, min(o_orderdate) FILTER (WHERE o_orderstatus = 'O') AS oldest_open, round(median(o_totalprice) FILTER (WHERE o_orderstatus <> 'O'), 4) AS median_closed FROM orders GROUP BY 1")
def filter_aggregates(spark, sf):
    o, is_open = read(spark, sf, "orders"), F.col("o_orderstatus") == "O"
    return o.groupBy("o_orderpriority").agg(F.count_if(is_open).alias("n_open"), F.min(F.when(is_open, F.col("o_orderdate"))).alias("oldest_open"), F.round(F.median(F.when(~is_open, F.col("o_totalprice"))), 4).alias("median_closed"))


_VERDICTS = "v AS (SELECT source, event_type AS check_name, bool_or(k) AS failed FROM (SELECT user_id % 7 AS source, event_type, value > 190 AS k FROM events) GROUP BY 1, 2), i AS (SELECT DISTINCT user_id % 7 AS source, event_type AS check_name, CASE WHEN event_type = 'view' THEN TIMESTAMP '2024-01-05' END AS closed_at FROM events WHERE user_id % 2 = 0)"


@query(f"""WITH {_VERDICTS} SELECT i.source, i.check_name, CASE WHEN i.closed_at IS NULL AND NOT coalesce(failed, true) THEN TIMESTAMP '2024-02-01' ELSE i.closed_at END AS closed_at FROM i LEFT JOIN v USING (source, check_name)
UNION ALL SELECT source, check_name, NULL FROM v WHERE failed AND NOT EXISTS (SELECT 1 FROM i WHERE i.source = v.source AND i.check_name = v.check_name AND closed_at IS NULL)""")
def incident_transitions(spark, sf):
    e = read(spark, sf, "events").withColumn("source", F.col("user_id") % 7).withColumnRenamed("event_type", "check_name")
    v = e.groupBy("source", "check_name").agg(F.bool_or(F.col("value") > 190).alias("failed"))
    i = e.where("user_id % 2 = 0").select("source", "check_name", F.when(F.col("check_name") == "view", F.lit("2024-01-05").cast("timestamp_ntz")).alias("closed_at")).distinct()
    return state.settle(i, v, F.lit("2024-02-01").cast("timestamp_ntz")).select("source", "check_name", F.col("closed_at").cast("timestamp_ntz").alias("closed_at"))


@query("SELECT obs_id, min(event_id)::BIGINT AS event_id FROM (SELECT 'user:' || user_id AS obs_id, event_id, user_id FROM events WHERE value > 150) WHERE user_id % 4 <> 0 GROUP BY 1")
def quarantine_first_wins(spark, sf):
    e = read(spark, sf, "events").withColumn("obs_id", tx.observation_id("user", F.col("user_id")))
    return state.quarantine(e.where("user_id % 4 = 0").select("obs_id").distinct(), e.where("value > 150").select("obs_id", "event_id"), "event_id")


@query("SELECT DISTINCT upper(sha256(ids)) AS fingerprint, n FROM (SELECT string_agg(i, chr(10) ORDER BY i) AS ids, count(*)::BIGINT AS n FROM (SELECT 'user:' || user_id AS i FROM events GROUP BY 1))")
def alert_fingerprint(spark, sf):
    ids = read(spark, sf, "events").select(tx.observation_id("user", F.col("user_id")).alias("i")).distinct()
    return ids.agg(F.upper(tx.fingerprint(F.collect_list("i"))).alias("fingerprint"), F.count("*").alias("n"))
