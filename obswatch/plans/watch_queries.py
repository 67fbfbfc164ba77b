"""The assembled checks, filters and reports over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from obswatch.functions import calendar as cal
from obswatch.operators import baselines, predicates, state, watchlist
from obswatch.plans.quality_queries import _RUNS, runs
from obswatch.plans.registry import query
from obswatch.plans.tables import DAILY, SHIPS, daily_orders, daily_ships, fold, near, read


@query(f"""WITH {_RUNS}, s AS (SELECT unnest(range(0, 9)) AS source), l AS (SELECT s.source, max(started_at) FILTER (WHERE status = 'succeeded') AS last FROM s LEFT JOIN runs USING (source) GROUP BY 1),
a AS (SELECT *, date_diff('day', last::DATE, DATE '2024-02-01') AS age FROM l)
SELECT source::VARCHAR AS source, 'freshness' AS check_name, coalesce(age > 2, true) AS failed, CASE WHEN last IS NULL THEN 'never succeeded' WHEN age > 2 THEN 'last success ' || last::DATE || ', ' || age || ' days ago, limit 2' ELSE '' END AS detail FROM a""")
def watch_freshness(spark, sf):
    """Sources 7 and 8 never ran."""
    return watchlist.freshness(spark.range(9).select(F.col("id").alias("source")), runs(spark, sf), F.lit("2024-02-01").cast("date"))


_LAST = "latest AS (SELECT event_id FROM runs WHERE source = 3 AND status = 'succeeded' ORDER BY started_at DESC, event_id DESC LIMIT 1)"


@query(f"WITH {_RUNS}, {_LAST} SELECT o_orderkey FROM orders WHERE o_orderkey % 5000 IN (SELECT event_id % 5000 FROM latest)")
def latest_run_rows(spark, sf):
    log = runs(spark, sf).withColumn("run_id", F.col("event_id"))
    last = predicates.last_run(log.withColumn("source", F.col("source").cast("string")), "3").select((F.col("run_id") % 5000).alias("run_id"))
    return predicates.of_ids(read(spark, sf, "orders").withColumn("run_id", F.col("o_orderkey") % 5000), "run_id", last).select("o_orderkey")


_REPORTS = "reports AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN value END AS a, CASE WHEN event_id % 5 = 0 THEN value END AS b, CASE WHEN event_id % 7 < 2 THEN event_id % 7 = 0 END AS nc FROM events)"


def _reports(spark, sf):
    e = F.col("event_id")
    return read(spark, sf, "events").select(e, F.when(e % 3 == 0, F.col("value")).alias("a"), F.when(e % 5 == 0, F.col("value")).alias("b"), F.when(e % 7 < 2, e % 7 == 0).alias("nc"))


@query(f"WITH {_REPORTS} SELECT event_id FROM reports WHERE a IS NOT NULL OR b IS NOT NULL OR nc")
def reported_days(spark, sf):
    return _reports(spark, sf).where(predicates.reported(F.col("a"), F.col("b"), not_counted=F.col("nc"))).select("event_id")


@query(f"WITH {_REPORTS} SELECT event_id FROM reports WHERE a IS NOT NULL AND NOT coalesce(nc, false)")
def counted_days(spark, sf):
    return _reports(spark, sf).where(predicates.counted(F.col("a"), F.col("nc"))).select("event_id")


@query(f"WITH {_REPORTS} SELECT event_id, coalesce(a, b) IS NOT NULL AS known FROM reports")
def any_known(spark, sf):
    return _reports(spark, sf).select("event_id", predicates.any_known(F.col("a"), F.col("b")).alias("known"))


@query("SELECT p_partkey, lower(coalesce(p_name, '')) LIKE 'part 1%' AS hit FROM part")
def prefix_predicates(spark, sf):
    return read(spark, sf, "part").select("p_partkey", predicates.starts(F.col("p_name"), "Part 1").alias("hit"))


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 1000")
def optional_predicates(spark, sf):
    return predicates.where_all(read(spark, sf, "orders"), F.col("o_orderstatus") == "F", None, F.col("o_totalprice") > 1000).select("o_orderkey")


@query("SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
def semi_join_ids(spark, sf):
    return predicates.of_ids(read(spark, sf, "orders"), "o_custkey", read(spark, sf, "customer").where("c_acctbal < 0").select("c_custkey")).select("o_orderkey")


@query("SELECT event_id, ts FROM events ORDER BY ts NULLS FIRST, event_id")
def oldest_first(spark, sf):
    return predicates.oldest_first(read(spark, sf, "events").select("event_id", "ts"), "ts", "event_id")


@query("SELECT event_id, CASE WHEN event_id % 3 > 0 THEN event_type END AS t FROM events ORDER BY coalesce(t, ''), event_id")
def blank_first(spark, sf):
    e = read(spark, sf, "events").select("event_id", F.when(F.col("event_id") % 3 > 0, F.col("event_type")).alias("t"))
    return predicates.blank_first(e, ["t"], "event_id")


@query("SELECT event_id, ts - INTERVAL 5 HOUR AS utc FROM events")
def aware_to_utc(spark, sf):
    """Times of a zone five hours ahead of UTC, as UTC without a zone."""
    return read(spark, sf, "events").select("event_id", cal.naive_utc(F.col("ts"), "Asia/Karachi").alias("utc"))


@query("SELECT DISTINCT o_orderdate::DATE AS day, (year(o_orderdate) - CASE WHEN month(o_orderdate) >= 7 THEN 1 ELSE 2 END) || '-' || (year(o_orderdate) - CASE WHEN month(o_orderdate) >= 7 THEN 0 ELSE 1 END) AS before FROM orders")
def season_before(spark, sf):
    d = F.to_date("o_orderdate")
    return read(spark, sf, "orders").select(d.alias("day"), cal.previous_season(cal.season_label(d)).alias("before")).distinct()


@query("SELECT event_id, try_cast(CASE WHEN event_id % 4 = 0 THEN '' WHEN event_id % 4 = 1 THEN 'soon' ELSE ts::DATE::VARCHAR END AS DATE) AS day, try_cast(replace(replace(strftime(ts, '%Y-%m-%dT%H:%M:%SZ'), 'T', ' '), 'Z', '') AS TIMESTAMP) AS at FROM events")
def dates_from_text(spark, sf):
    e = F.col("event_id") % 4
    said = F.when(e == 0, "").when(e == 1, "soon").otherwise(F.to_date("ts").cast("string"))
    return read(spark, sf, "events").select("event_id", cal.csv_date(said).alias("day"), cal.iso_time(cal.utc_text(F.col("ts"))).alias("at"))


@query("SELECT event_id, date_diff('hour', ts, TIMESTAMP '2024-02-01') > 48 AS stale FROM events WHERE date_part('minute', ts) <> 0 OR date_part('second', ts) <> 0")
def stale_data(spark, sf):
    e = read(spark, sf, "events").where((F.minute("ts") != 0) | (F.second("ts") != 0))
    return e.select("event_id", cal.is_stale(F.col("ts").cast("timestamp"), F.lit("2024-02-01").cast("timestamp"), 2).alias("stale"))


_TOLD = "round(100 * rate)::INT || '% null in ' || n || ' rows (the window), limit 10%'"


@query(f"""WITH w AS (SELECT CASE WHEN event_id % 4 <> 0 THEN value END AS a, event_type AS b FROM events WHERE ts::DATE >= DATE '2024-01-21' - 14 AND ts::DATE < DATE '2024-01-21'),
r AS (SELECT unnest(['a', 'b']) AS c, unnest([avg((a IS NULL)::INT), avg((b IS NULL)::INT)]) AS rate, count(*) AS n FROM w)
SELECT 'archive' AS source, 'null_rate:' || c AS check_name, rate > 0.1 AS failed, CASE WHEN rate > 0.1 THEN {_TOLD} ELSE '' END AS detail FROM r WHERE n > 0""")
def watch_null_rates(spark, sf):
    e = read(spark, sf, "events").select("ts", F.when(F.col("event_id") % 4 != 0, F.col("value")).alias("a"), F.col("event_type").alias("b"))
    return watchlist.null_rates(watchlist.lagged_window(e, F.to_date("ts"), F.lit("2024-01-27").cast("date")), ["a", "b"], "archive", "the window")


@query(f"""WITH {DAILY}, long AS (SELECT obs_date, 'total' AS measure, total AS value FROM daily UNION ALL SELECT obs_date, 'n', n FROM daily),
per_day AS (SELECT measure, {fold('obs_date')} AS d, avg(value) AS m, var_samp(value) AS v FROM long GROUP BY 1, 2),
base AS (SELECT measure, t.d AS day_of_year, avg(s.m) AS mean, sqrt(avg(s.v)) AS sd FROM (SELECT unnest(range(1, 366)) AS d) t JOIN per_day s ON {near('t.d', 's.d')} GROUP BY 1, 2 HAVING avg(s.v) IS NOT NULL)
SELECT 'daily:' || obs_date || ':' || l.measure AS obs_id, 'archive' AS source, obs_date AS observation_date, 'weather_normal' AS check_name
FROM long l JOIN base b ON b.measure = l.measure AND b.day_of_year = {fold('obs_date')} WHERE sd > 0 AND abs(value - mean) > 3 * sd AND obs_date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'""")
def watch_weather(spark, sf):
    d = daily_orders(spark, sf)
    base = baselines.smoothed(baselines.unpivoted(d, ["obs_date"], ["total", "n"]), "obs_date", "value", ["measure"])
    return watchlist.weather_suspects(d, base, "daily", "archive", "obs_date", ["total", "n"], F.lit("1996-01-01").cast("date"), F.lit("1998-12-31").cast("date")).drop("value")


@query(f"WITH {DAILY}, {SHIPS}, l AS (SELECT obs_date, CASE WHEN n NOT BETWEEN 2 AND 9 THEN 'n' WHEN quantity NOT BETWEEN 15 AND 35 THEN 'quantity' END AS counter FROM daily JOIN ships USING (obs_date)) SELECT 'daily:' || obs_date AS obs_id, 'counts' AS source, obs_date AS observation_date, 'count_range' AS check_name, counter FROM l WHERE counter IS NOT NULL")
def watch_ranges(spark, sf):
    both = daily_orders(spark, sf).join(daily_ships(spark, sf), "obs_date")
    return watchlist.range_suspects(both, "daily", "counts", "obs_date", {"n": (2, 9), "quantity": (15, 35)}).withColumn("counter", F.split_part("value", F.lit("="), F.lit(1))).drop("value")


@query(f"""WITH {DAILY}, {SHIPS}, p AS (SELECT obs_date, n, lag(n) OVER w AS before, lag(obs_date) OVER w AS before_on, quantity - lag(quantity) OVER w AS warmer FROM daily JOIN ships USING (obs_date) WINDOW w AS (ORDER BY obs_date))
SELECT obs_date AS observation_date, 'daily:' || obs_date AS obs_id FROM p WHERE obs_date - before_on <= 4 AND abs(n - before) >= 3 AND ((n > 1.5 * before AND warmer > 0) OR (n < 0.5 * before AND warmer < 0))""")
def watch_jumps(spark, sf):
    from obswatch.operators.checks import Thresholds

    both = daily_orders(spark, sf).join(daily_ships(spark, sf), "obs_date")
    return watchlist.jump_suspects(both, "daily", "counts", "obs_date", "n", ["quantity"], F.lit("1900-01-01").cast("date"), limits=Thresholds(jump_least=3)).select("observation_date", "obs_id")


@query(f"""WITH {DAILY}, {SHIPS}, pair AS (SELECT obs_date, n - quantity AS diff FROM daily JOIN ships USING (obs_date)),
w AS (SELECT obs_date, diff, count(*) OVER v AS k, quantile_cont(diff, 0.5) OVER v AS med FROM pair WINDOW v AS (ORDER BY obs_date ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING))
SELECT 'ships' AS source, 'cross_source_shift' AS check_name, abs(diff - med) > 2 AS failed FROM w WHERE k >= 5 ORDER BY obs_date DESC LIMIT 1""")
def watch_cross_source(spark, sf):
    both = daily_orders(spark, sf).join(daily_ships(spark, sf), "obs_date")
    return watchlist.cross_source(both, "obs_date", "n", "quantity", "ships").drop("detail")


_REFRESH = f"""{DAILY}, per_day AS (SELECT {fold('obs_date')} AS d, avg(total) AS m, var_samp(total) AS v FROM daily WHERE obs_date < DATE '2000-04-01' GROUP BY 1),
base AS (SELECT t.d AS day_of_year, avg(s.m) AS mean, sqrt(avg(s.v)) AS sd FROM (SELECT unnest(range(1, 366)) AS d) t JOIN per_day s ON {near('t.d', 's.d')} GROUP BY 1 HAVING avg(s.v) IS NOT NULL)"""


def _refreshed(spark, sf):
    log = spark.createDataFrame([("1998-04-01", 1.5), ("1999-04-01", 2.5), ("2001-04-01", 9.0)], "d string, new_value double")
    log = log.select(F.col("d").cast("date").alias("refreshed_on"), F.lit(False).alias("replayed"), F.lit("archive").alias("source"), F.lit("total").alias("measure"), F.lit(None).cast("double").alias("old_value"), "new_value")
    old = spark.range(1, 4).select(F.lit("archive").alias("source"), F.lit("total").alias("measure"), F.col("id").cast("int").alias("day_of_year"), F.lit(0.0).alias("mean"), F.lit(1.0).alias("sd"), F.lit("1999-04-01").cast("date").alias("refreshed_on"))
    kept = old.withColumn("measure", F.lit("gone"))
    long = baselines.unpivoted(daily_orders(spark, sf), ["obs_date"], ["total"])
    return baselines.refresh(long, "obs_date", "archive", old.unionByName(kept), log, "2000-04-01")


@query(f"WITH {_REFRESH} SELECT 'total' AS measure, day_of_year::INT AS day_of_year, round(mean, 1) AS mean, DATE '2000-04-01' AS refreshed_on FROM base UNION ALL SELECT 'gone', d::INT, 0.0, DATE '1999-04-01' FROM range(1, 4) r(d)")
def baseline_refresh(spark, sf):
    return _refreshed(spark, sf)[0].select("measure", "day_of_year", F.round("mean", 1).alias("mean"), "refreshed_on")


@query(f"WITH {_REFRESH} SELECT * FROM (VALUES (DATE '1998-04-01', NULL, 1.5), (DATE '1999-04-01', NULL, 2.5), (DATE '2001-04-01', NULL, 9.0)) t(refreshed_on, old_value, new_value) UNION ALL SELECT DATE '2000-04-01', 2.5, round(avg(mean), 2) FROM base WHERE day_of_year >= 305 OR day_of_year <= 90")
def refresh_log(spark, sf):
    return _refreshed(spark, sf)[1].select("refreshed_on", "old_value", F.round("new_value", 2).alias("new_value"))


def _items(spark, sf):
    s = read(spark, sf, "supplier").where("s_suppkey <= 20").select(F.col("s_suppkey").cast("string").alias("incident_id"), F.col("s_nationkey").cast("string").alias("source"), F.lit("volume").alias("check_name"), F.lit(None).cast("timestamp").alias("closed_at"), F.lit(None).cast("string").alias("detail"), F.lit(None).cast("timestamp").alias("alerted_at"))
    q = s.select(F.concat(F.lit("t:"), "incident_id").alias("obs_id"), F.lit("count_range").alias("check_name"), F.lit("n=1").alias("value"), "alerted_at").where("obs_id < 't:3'")
    return s, q


@query("""WITH s AS (SELECT s_suppkey::VARCHAR AS id, s_nationkey::VARCHAR AS source FROM supplier WHERE s_suppkey <= 20), q AS (SELECT 't:' || id AS id FROM s WHERE 't:' || id < 't:3'),
l AS (SELECT 0 AS k, id, '- ' || source || ' / volume: failed' AS line FROM s UNION ALL SELECT 1, id, '- ' || id || ' (count_range): n=1' FROM q)
SELECT 'Watch of 2024-02-01: ' || count(*) FILTER (WHERE k = 0) || ' new incidents, ' || count(*) FILTER (WHERE k = 1) || ' new quarantined observations' AS subject, string_agg(line, chr(10) ORDER BY k, id) AS text, sha256(string_agg(id, chr(10) ORDER BY id)) AS key FROM l""")
def alert_text(spark, sf):
    return watchlist.alert(*_items(spark, sf), "2024-02-01")


@query("SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'O')::BIGINT AS n_open, min(o_orderdate) FILTER (WHERE o_orderstatus = 'O') AS oldest_open, count(*) FILTER (WHERE o_orderstatus <> 'O')::BIGINT AS n_cleared FROM orders GROUP BY 1")
def open_and_cleared(spark, sf):
    o = read(spark, sf, "orders").withColumn("status", F.when(F.col("o_orderstatus") == "O", "open").otherwise("cleared"))
    return state.summary(o, ["o_orderpriority"], "o_orderdate").select("o_orderpriority", "n_open", F.col("oldest_open"), "n_cleared")


@query("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN TIMESTAMP '2024-02-01' END AS alerted_at FROM events")
def mark_alerted(spark, sf):
    e = read(spark, sf, "events").select("event_id", F.lit(None).cast("timestamp_ntz").alias("alerted_at"))
    return watchlist.mark_alerted(e, "event_id", e.where("event_id % 2 = 0").select("event_id"), F.lit("2024-02-01").cast("timestamp_ntz"))


@query("SELECT conv_id, turn FROM conversations c WHERE text IN (SELECT text FROM conversations WHERE turn = 0)")
def slice_kept(spark, sf):
    c = read(spark, sf, "conversations")
    return predicates.of_ids(c, "text", c.where("turn = 0").select("text").distinct()).select("conv_id", "turn")


@query("SELECT 2 AS x, l_linestatus, n FROM (SELECT l_linestatus, count(*)::BIGINT AS n FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1) UNION ALL SELECT 1, 'O', 0")
def slice_replaced(spark, sf):
    """A slice of a table replaced whole, others as they were."""
    stored = spark.createDataFrame([(1, "O", 0), (1, "F", 7), (1, "F", 8)], "x int, l_linestatus string, n long")
    new = read(spark, sf, "lineitem").where("l_linestatus = 'F'").groupBy("l_linestatus").agg(F.count("*").alias("n")).select(F.lit(2).alias("x"), "l_linestatus", "n")
    return state.replace_slice(stored, new, ["l_linestatus"])

