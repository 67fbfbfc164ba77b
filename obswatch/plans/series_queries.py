"""Baselines, as-of lookups, trailing statistics and windows over the driver's tables."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from obswatch.functions import calendar as cal
from obswatch.operators import baselines, series
from obswatch.plans.registry import query
from obswatch.plans.tables import DAILY, SHIPS, daily_orders, daily_ships, fold, near, read

_PER_DAY = f"SELECT {fold('obs_date')} AS d, avg(total) AS m, var_samp(total) AS v FROM daily GROUP BY 1"
_SMOOTH = f"per_day AS ({_PER_DAY}), base AS (SELECT t.d AS day_of_year, avg(s.m) AS mean, sqrt(avg(s.v)) AS sd FROM (SELECT unnest(range(1, 366)) AS d) t JOIN per_day s ON {near('t.d', 's.d')} GROUP BY 1 HAVING avg(s.v) IS NOT NULL)"


@query(f"WITH {DAILY}, {_SMOOTH} SELECT day_of_year::INT AS day_of_year, round(mean, 1) AS mean, round(sd, 1) AS sd FROM base")
def baseline_doy_normals(spark, sf):
    base = baselines.smoothed(daily_orders(spark, sf), "obs_date", "total")
    return base.select("day_of_year", F.round("mean", 1).alias("mean"), F.round("sd", 1).alias("sd"))


@query(f"WITH {DAILY}, {_SMOOTH} SELECT round(avg(mean), 2) AS season_mean FROM base WHERE day_of_year >= 305 OR day_of_year <= 90")
def baseline_season_average(spark, sf):
    return baselines.season_average(baselines.smoothed(daily_orders(spark, sf), "obs_date", "total")).select(F.round("season_mean", 2).alias("season_mean"))


_REPLAY = f"""
WITH {DAILY},
dates AS (SELECT make_date(y, 4::BIGINT, 1::BIGINT) AS refreshed_on FROM range(1996, 2002) r(y)),
per_day AS (SELECT refreshed_on, {fold('obs_date')} AS d, avg(total) AS m, var_samp(total) AS v FROM daily JOIN dates ON obs_date < refreshed_on AND obs_date >= refreshed_on - INTERVAL 30 YEAR GROUP BY 1, 2),
base AS (SELECT s.refreshed_on, t.d AS day_of_year, avg(s.m) AS mean FROM (SELECT unnest(range(1, 366)) AS d) t JOIN per_day s ON {near('t.d', 's.d')} GROUP BY 1, 2 HAVING avg(s.v) IS NOT NULL),
log AS (SELECT refreshed_on, avg(mean) AS new_value FROM base WHERE day_of_year >= 305 OR day_of_year <= 90 GROUP BY 1)
"""


@query(_REPLAY + "SELECT refreshed_on, round(new_value, 2) AS season_mean FROM log")
def baseline_replay_by_year(spark, sf):
    out = baselines.replayed(daily_orders(spark, sf), "obs_date", "total", (1996, 2001))
    return out.where("season_mean is not null").select("refreshed_on", F.round("season_mean", 2).alias("season_mean"))


@query(_REPLAY + """SELECT refreshed_on, round(new_value, 2) AS new_value, round(lag(new_value) OVER w, 2) AS old_value,
  round(new_value - lag(new_value) OVER w, 2) AS change, round(new_value - first_value(new_value) OVER w, 2) AS cumulative_change
FROM log WINDOW w AS (ORDER BY refreshed_on)""")
def drift_running_sum(spark, sf):
    log = baselines.replayed(daily_orders(spark, sf), "obs_date", "total", (1996, 2001)).where("season_mean is not null").withColumnRenamed("season_mean", "new_value")
    out = baselines.drift(log, [], "refreshed_on", "new_value")
    return out.select("refreshed_on", *(F.round(c, 2).alias(c) for c in ("new_value", "old_value", "change", "cumulative_change")))


@query(f"""
WITH {DAILY}, long AS (SELECT obs_date, 'total' AS measure, total AS value FROM daily UNION ALL SELECT obs_date, 'n', n FROM daily),
per_day AS (SELECT measure, {fold('obs_date')} AS d, avg(value) AS m, var_samp(value) AS v FROM long GROUP BY 1, 2),
base AS (SELECT measure, t.d AS day_of_year, avg(s.m) AS mean, sqrt(avg(s.v)) AS sd FROM (SELECT unnest(range(1, 366)) AS d) t JOIN per_day s ON {near('t.d', 's.d')} GROUP BY 1, 2 HAVING avg(s.v) IS NOT NULL)
SELECT obs_date, l.measure, round(value, 2) AS value, round((value - mean) / sd, 4) AS deviation
FROM long l JOIN base b ON b.measure = l.measure AND b.day_of_year = {fold('obs_date')} WHERE sd > 0 AND abs(value - mean) > 3 * sd
""")
def normal_suspects(spark, sf):
    long = baselines.unpivoted(daily_orders(spark, sf), ["obs_date"], ["total", "n"])
    base = baselines.smoothed(long, "obs_date", "value", ["measure"])
    out = baselines.suspects(long, base, "obs_date")
    return out.select("obs_date", "measure", F.round("value", 2).alias("value"), F.round(baselines.deviation(F.col("value"), F.col("mean"), F.col("sd")), 4).alias("deviation"))


_ASOF_FROM = "(SELECT * FROM events WHERE event_type = 'purchase') p ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'error') e ON p.user_id = e.user_id AND p.ts >= e.ts"


def _asof(spark, sf, tolerance=None):
    e = read(spark, sf, "events")
    spine = e.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    return series.asof(spine, e.where("event_type = 'error'").select("user_id", "ts", "value"), ["user_id"], "ts", "value", tolerance).select("event_id", "user_id", "value", "value_at")


@query(f"SELECT p.event_id, p.user_id, e.value, e.ts AS value_at FROM {_ASOF_FROM}")
def asof_backward(spark, sf):
    return _asof(spark, sf)


@query(f"SELECT p.event_id, p.user_id, CASE WHEN p.ts - e.ts <= INTERVAL 3 DAY THEN e.value END AS value, CASE WHEN p.ts - e.ts <= INTERVAL 3 DAY THEN e.ts END AS value_at FROM {_ASOF_FROM}")
def asof_tolerance(spark, sf):
    return _asof(spark, sf, 3 * 86400)


@query(f"""WITH {DAILY} SELECT a.obs_date, a.n, b.n AS n_before, round(a.total - b.total, 2) AS change,
  (SELECT sum(c.n) FROM daily c WHERE c.obs_date BETWEEN a.obs_date - 2 AND a.obs_date) AS n_three_days
FROM daily a JOIN daily b ON b.obs_date = a.obs_date - 3""")
def offset_join(spark, sf):
    d = daily_orders(spark, sf).withColumn("k", F.datediff("obs_date", F.lit("1970-01-01").cast("date")))
    w = W.partitionBy(F.lit(0)).orderBy("k")  # one row a day: a span of dates, not of observations
    at = lambda c: F.max(c).over(w.rangeBetween(-3, -3))
    out = d.withColumn("n_before", at("n")).withColumn("change", F.round(F.col("total") - at("total"), 2)).withColumn("n_three_days", F.sum("n").over(w.rangeBetween(-2, 0)))
    return out.where("n_before is not null").select("obs_date", "n", "n_before", "change", "n_three_days")


@query(f"""WITH {DAILY}, {SHIPS}, pair AS (SELECT obs_date, n - quantity AS diff FROM daily JOIN ships USING (obs_date)),
w AS (SELECT obs_date, diff, count(*) OVER v AS k, quantile_cont(diff, 0.5) OVER v AS med FROM pair WINDOW v AS (ORDER BY obs_date ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING))
SELECT obs_date, round(diff, 4) AS diff, CASE WHEN k >= 5 THEN round(med, 6) END AS median_before, coalesce(k >= 5 AND abs(diff - med) > 2, false) AS shifted FROM w""")
def trailing_median_shift(spark, sf):
    both = daily_orders(spark, sf).join(daily_ships(spark, sf), "obs_date").withColumn("diff", F.col("n") - F.col("quantity"))
    out = both.withColumn("median_before", series.trailing_median(F.col("diff"), ["obs_date"], 30, 5))
    return out.select("obs_date", F.round("diff", 4).alias("diff"), F.round("median_before", 6).alias("median_before"), F.coalesce(F.abs(F.col("diff") - F.col("median_before")) > 2, F.lit(False)).alias("shifted"))


_RATE = "CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END"


@query(f"""WITH r AS (SELECT event_id, user_id, ts, {_RATE} AS rate FROM events),
l AS (SELECT *, list(rate) FILTER (WHERE rate IS NOT NULL) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM r)
SELECT event_id, rate, round(list_avg(list_slice(seen, greatest(len(seen) - 29, 1)::BIGINT, len(seen)::BIGINT)), 8) AS rate_normal FROM l""")
def trailing_normal_of_known(spark, sf):
    e = read(spark, sf, "events").withColumn("rate", F.when(F.col("event_id") % 7 != 0, F.col("value")))
    return series.trailing_mean(e, "rate", ["user_id"], ["ts", "event_id"], 30, "rate_normal").select("event_id", "rate", F.round("rate_normal", 8).alias("rate_normal"))


@query("SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1")
def latest_per_group(spark, sf):
    return series.latest(read(spark, sf, "events"), ["user_id"], F.desc("ts"), F.desc("event_id")).select("user_id", "event_id", "event_type", "value")


@query("SELECT event_id, event_type FROM events WHERE ts::DATE >= (SELECT max(ts)::DATE FROM events) - 13")
def recent_window(spark, sf):
    e = read(spark, sf, "events")
    last = e.agg(F.to_date(F.max("ts")).alias("last"))
    return e.join(F.broadcast(last), F.to_date("ts") >= F.date_sub("last", 13)).select("event_id", "event_type")


@query("SELECT o_orderkey, o_totalprice FROM (SELECT DISTINCT o_orderkey, o_totalprice FROM orders) ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def top_k(spark, sf):
    return read(spark, sf, "orders").select("o_orderkey", "o_totalprice").distinct().orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)


@query("SELECT l_orderkey, l_linenumber, max(cnt)::BIGINT AS cnt FROM (SELECT l_orderkey, l_linenumber, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS cnt FROM lineitem) WHERE cnt > 1 GROUP BY 1, 2")
def occurrence_flags(spark, sf):
    items = read(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("cnt"))
    return items.where("cnt > 1")


@query(f"""WITH {DAILY}, p AS (SELECT obs_date, n, lag(n) OVER w AS before, lag(obs_date) OVER w AS before_on FROM daily WINDOW w AS (ORDER BY obs_date))
SELECT obs_date, n, before FROM p WHERE obs_date - before_on <= 4 AND abs(n - before) >= 3 AND (n > 1.5 * before OR n < 0.5 * before)""")
def jump_suspects(spark, sf):
    from obswatch.operators import checks

    return checks.jumps(daily_orders(spark, sf), "obs_date", "n", days=4, least=3, rise=1.5, fall=0.5).select("obs_date", "n", "before")


_THIN = "thin AS (SELECT DISTINCT o_orderdate::DATE AS d, year(o_orderdate) AS winter, o_custkey FROM orders WHERE month(o_orderdate) <= 6)"


@query(f"""WITH {_THIN}, gaps AS (SELECT o_custkey, winter, d, coalesce(lead(d) OVER (PARTITION BY o_custkey, winter ORDER BY d), make_date(winter, 7::BIGINT, 1::BIGINT)) AS nx FROM thin),
days AS (SELECT o_custkey, winter, g.d, unnest(generate_series(greatest(g.d + 1, make_date(winter, 3::BIGINT, 1::BIGINT))::TIMESTAMP, (nx - 1)::TIMESTAMP, INTERVAL 1 DAY))::DATE AS day FROM gaps g),
nth AS (SELECT o_custkey, winter, day, row_number() OVER (PARTITION BY o_custkey, winter, d ORDER BY day) AS k FROM days WHERE isodow(day) <= 5)
SELECT o_custkey, winter::INT AS winter, min(day) AS closed_on FROM nth WHERE k = 5 GROUP BY 1, 2""")
def weekday_gap_close(spark, sf):
    o = read(spark, sf, "orders").where(F.month("o_orderdate") <= 6)
    days = o.select("o_custkey", F.to_date("o_orderdate").alias("d"), F.year("o_orderdate").alias("winter"))
    return series.first_silence(days, ["o_custkey", "winter"], "d", F.make_date("winter", F.lit(7), F.lit(1)), F.make_date("winter", F.lit(3), F.lit(1)))


#: Weekdays from Monday 1 January 1900 through a day.
_UPTO = "((({0} - DATE '1900-01-01' + 1) // 7) * 5 + least(({0} - DATE '1900-01-01' + 1) % 7, 5))"


@query(f"""SELECT o_orderkey, date_diff('day', o_orderdate::DATE, DATE '2010-08-01')::INT AS age, ({_UPTO.format("DATE '2010-08-01'")} - {_UPTO.format("o_orderdate::DATE")})::INT AS weekdays FROM orders""")
def weekdays_since(spark, sf):
    day, end = F.to_date("o_orderdate"), F.lit("2010-08-01").cast("date")
    return read(spark, sf, "orders").select("o_orderkey", F.datediff(end, day).alias("age"), cal.weekdays_between(day, end).alias("weekdays"))


@query("""SELECT ((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York')::DATE AS local_day, count(*)::BIGINT AS n, round(sum(value), 4) AS total FROM events GROUP BY 1""")
def local_day_rollup(spark, sf):
    e = read(spark, sf, "events")
    return e.groupBy(cal.local_date(F.col("ts")).alias("local_day")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query(f"""SELECT DISTINCT o_orderdate::DATE AS day, {fold('o_orderdate')}::INT AS folded, (isodow(o_orderdate) <= 5) AS weekday,
  CASE WHEN month(o_orderdate) >= 7 THEN year(o_orderdate) || '-' || (year(o_orderdate) + 1) ELSE (year(o_orderdate) - 1) || '-' || year(o_orderdate) END AS season,
  strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS iso FROM orders""")
def calendar_functions(spark, sf):
    d = F.to_date("o_orderdate")
    return read(spark, sf, "orders").select(d.alias("day"), cal.folded_day(d).alias("folded"), cal.is_weekday(d).alias("weekday"), cal.season_label(d).alias("season"), cal.utc_text(F.col("o_orderdate")).alias("iso")).distinct()


@query("SELECT event_type, date_trunc('day', ts) AS window_start, count(*)::BIGINT AS n, round(avg(value), 8) AS mean FROM events GROUP BY 1, 2")
def tumbling_windows(spark, sf):
    return read(spark, sf, "events").groupBy("event_type", F.window("ts", "1 day").alias("w")).agg(F.count("*").alias("n"), F.round(F.avg("value"), 8).alias("mean")).select("event_type", F.col("w.start").cast("timestamp_ntz").alias("window_start"), "n", "mean")


@query("""SELECT s AS window_start, count(*)::BIGINT AS n FROM (SELECT unnest([time_bucket(INTERVAL 6 HOUR, ts), time_bucket(INTERVAL 6 HOUR, ts) - INTERVAL 6 HOUR]) AS s FROM events) GROUP BY 1""")
def sliding_windows(spark, sf):
    return read(spark, sf, "events").groupBy(F.window("ts", "12 hours", "6 hours").alias("w")).agg(F.count("*").alias("n")).select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "n")


@query("""WITH m AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS new FROM events),
g AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM m)
SELECT user_id, min(ts) AS session_start, count(*)::BIGINT AS n FROM g GROUP BY user_id, s""")
def session_windows(spark, sf):
    e = read(spark, sf, "events")
    return e.groupBy("user_id", F.session_window("ts", "6 hours").alias("w")).agg(F.count("*").alias("n")).select("user_id", F.col("w.start").cast("timestamp_ntz").alias("session_start"), "n")
