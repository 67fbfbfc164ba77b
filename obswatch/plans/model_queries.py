"""Features, regressions and scores over the driver's tables."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from obswatch.operators import model
from obswatch.plans.registry import query
from obswatch.plans.tables import DAILY, SHIPS, daily_orders, daily_ships, read


@query("SELECT l_orderkey, arg_max(l_quantity, (CASE l_returnflag WHEN 'A' THEN 1 ELSE 0 END) * 1000 + l_quantity) AS l_quantity FROM lineitem GROUP BY 1")
def best_status(spark, sf):
    return model.best_by(read(spark, sf, "lineitem"), ["l_orderkey"], "l_quantity", F.when(F.col("l_returnflag") == "A", 1).otherwise(0))


_KNOWN = "SELECT user_id, ts, CASE WHEN event_id % 3 <> 0 THEN value END AS a, CASE WHEN event_id % 2 = 0 THEN value END AS b FROM events"


@query(f"WITH t AS ({_KNOWN}) SELECT user_id, arg_max(a, ts) AS a, arg_max(b, ts) AS b FROM t GROUP BY 1")
def forecast_newest_known(spark, sf):
    e = read(spark, sf, "events").select("user_id", "ts", F.when(F.col("event_id") % 3 != 0, F.col("value")).alias("a"), F.when(F.col("event_id") % 2 == 0, F.col("value")).alias("b"))
    return model.newest_known(e, ["user_id"], ["a", "b"], "ts")


_BOTH = f"{DAILY}, {SHIPS}, pair AS (SELECT obs_date, CASE WHEN day(obs_date) % 4 <> 0 THEN n END AS cnt, quantity FROM daily JOIN ships USING (obs_date))"


def _both(spark, sf):
    return daily_orders(spark, sf).join(daily_ships(spark, sf), "obs_date").select("obs_date", F.when(F.dayofmonth("obs_date") % 4 != 0, F.col("n")).alias("cnt"), "quantity")


_AIR = "air AS (SELECT l_shipdate::DATE AS day, avg(l_discount * 540) - stddev_samp(l_discount * 540) AS low, avg(l_discount * 540) AS mean FROM lineitem GROUP BY 1)"
#: Everything is as of the day on which a prediction is made; only the air of the target's day is later.
_FEATURES = f"""WITH {_BOTH}, {_AIR},
g AS (SELECT a.obs_date AS made_on, (SELECT max(c.obs_date) FROM pair c WHERE c.cnt IS NOT NULL AND c.obs_date <= a.obs_date) AS last_on, (SELECT max(c.obs_date) FROM pair c WHERE c.quantity IS NOT NULL AND c.obs_date BETWEEN a.obs_date - 3 AND a.obs_date) AS level_on FROM pair a),
f AS (SELECT g.*, l.cnt AS last_count, v.quantity AS level, b.quantity AS back, t.low AS low_next, t.mean AS mean_next, n.mean AS mean_now,
  (SELECT sum(24 * greatest(0, 27 - c.quantity)) FROM pair c WHERE c.obs_date BETWEEN g.level_on - 2 AND g.level_on) AS hours
  FROM g LEFT JOIN pair l ON l.obs_date = g.last_on LEFT JOIN pair v ON v.obs_date = g.level_on LEFT JOIN pair b ON b.obs_date = g.level_on - 3 LEFT JOIN air t ON t.day = g.made_on + 1 LEFT JOIN air n ON n.day = g.made_on),
r AS (SELECT *, CASE WHEN last_on IS NULL THEN 'no count on or before the day' WHEN made_on + 1 - last_on > 14 THEN 'last count over 14 days before the target' WHEN level_on IS NULL THEN 'no recent level'
  WHEN back IS NULL THEN 'no level three days earlier' WHEN low_next IS NULL OR mean_next IS NULL THEN 'no air for the target' WHEN mean_now IS NULL THEN 'no air for the day' END AS reason FROM f)"""


@query(_FEATURES + """ SELECT made_on, last_count, last_on AS last_count_date, reason, CASE WHEN reason IS NULL THEN round(ln(1 + last_count), 6) END AS log_last_count, CASE WHEN reason IS NULL THEN (made_on + 1 - last_on)::DOUBLE END AS days_since_last_count,
  CASE WHEN reason IS NULL THEN round(level, 4) END AS gauge_temp, CASE WHEN reason IS NULL THEN round(level - back, 4) END AS gauge_change_3d, CASE WHEN reason IS NULL THEN round(hours, 3) END AS gauge_degree_hours_below,
  CASE WHEN reason IS NULL THEN round(low_next, 6) END AS air_min, CASE WHEN reason IS NULL THEN round(greatest(0, 27 - mean_now) + greatest(0, 27 - mean_next), 6) END AS air_degree_days_below FROM r""")
def feature_frame(spark, sf):
    counts, levels, air = _series(spark, sf)
    out = model.feature_rows(counts.select("day"), counts, levels, air, 27.0)
    return out.select("made_on", "last_count", "last_count_date", "reason", "days_since_last_count", *(F.round(c, d).alias(c) for c, d in (("log_last_count", 6), ("gauge_temp", 4), ("gauge_change_3d", 4), ("gauge_degree_hours_below", 3), ("air_min", 6), ("air_degree_days_below", 6))))


@query(_FEATURES + """, t AS (SELECT r.*, p.cnt AS y FROM r JOIN pair p ON p.obs_date = r.made_on + 1 WHERE r.reason IS NULL AND p.cnt IS NOT NULL)
SELECT count(*)::BIGINT AS training_rows, 0::BIGINT AS estimate_rows, min(made_on + 1) AS first_target, max(made_on + 1) AS last_target FROM t""")
def training_summary(spark, sf):
    return model.training_summary(_training(spark, sf).withColumn("is_estimate", F.lit(False)))


@query(f"WITH {DAILY}, s AS (SELECT obs_date, n, lag(n) OVER w AS p, avg(n) OVER (ORDER BY obs_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS m FROM daily WINDOW w AS (ORDER BY obs_date)) SELECT count(*)::BIGINT AS n, round(avg(abs(m - n)), 4) AS mae_model, round(avg(abs(p - n)), 4) AS mae_persistence FROM s WHERE p IS NOT NULL")
def mae_vs_persistence(spark, sf):
    w = W.partitionBy(F.lit(0)).orderBy("obs_date")  # one row a day
    s = daily_orders(spark, sf).withColumn("p", F.lag("n").over(w)).withColumn("m", F.avg("n").over(w.rowsBetween(-7, -1))).where("p is not null")
    return model.errors(s, "m", "p", "n").select("n", F.round("mae_model", 4).alias("mae_model"), F.round("mae_persistence", 4).alias("mae_persistence"))


@query(f"WITH {SHIPS} SELECT round(sum(24 * greatest(0, 27 - quantity)), 2) AS degree_hours FROM ships")
def degree_hours(spark, sf):
    return daily_ships(spark, sf).agg(F.round(F.sum(model.degree_sum(F.col("quantity"), 27.0)), 2).alias("degree_hours"))


def _series(spark, sf):
    """Counts, levels, and as air the mean discount of a day's items, scaled to about 27, and a deviation under it."""
    both, day, air = _both(spark, sf), F.col("obs_date").alias("day"), F.col("l_discount").cast("double") * 540
    air = read(spark, sf, "lineitem").groupBy(F.to_date("l_shipdate").alias("day")).agg((F.avg(air) - F.stddev(air)).alias("low"), F.avg(air).alias("mean"))
    return both.select(day, F.col("cnt").alias("count")), both.select(day, F.col("quantity").cast("double").alias("level")), air


def _training(spark, sf):
    """The frame of all days up to the last; a target without the day before it among the days still has its features as of that day."""
    counts, levels, air = _series(spark, sf)
    rows = model.feature_rows(counts.select("day"), counts, levels, air, 27.0).where("reason is null")
    return rows.join(counts.where("count is not null").select(F.col("day").alias("target"), "count"), "target")


_SCORED = """p AS (SELECT o_orderkey, o_orderdate::DATE AS made_on, (o_orderdate::DATE + 1) AS target_date, o_totalprice / 1000 AS predicted, CASE WHEN o_orderkey % 2 = 0 THEN 'm1' ELSE 'm2' END AS model_version FROM orders),
i AS (SELECT o_orderdate::DATE AS made_on, (o_orderdate::DATE + 1) AS target_date, count(*)::DOUBLE AS last_count FROM orders GROUP BY ALL),
c AS (SELECT o_orderdate::DATE AS report_date, sum(o_totalprice) / 1000 AS cnt, day(o_orderdate::DATE) % 5 = 0 AS is_estimate FROM orders GROUP BY ALL)"""


def _scored(spark, sf, **asked):
    o = read(spark, sf, "orders").withColumn("made_on", F.to_date("o_orderdate")).withColumn("target_date", F.date_add("made_on", 1))
    p = o.select("made_on", "target_date", (F.col("o_totalprice") / 1000).alias("predicted"), F.when(F.col("o_orderkey") % 2 == 0, "m1").otherwise("m2").alias("model_version"))
    i = o.groupBy("made_on", "target_date").agg(F.count("*").cast("double").alias("last_count"))
    c = o.groupBy(F.col("made_on").alias("day")).agg((F.sum("o_totalprice") / 1000).alias("count"), (F.dayofmonth("made_on") % 5 == 0).alias("is_estimate"))
    return model.scored(p, i, c, **asked)


@query(f"WITH {_SCORED} SELECT made_on, target_date, model_version, round(predicted, 6) AS predicted, last_count AS persistence, round(abs(predicted - cnt), 6) AS model_error, round(abs(last_count - cnt), 6) AS persistence_error FROM p JOIN i USING (made_on, target_date) JOIN c ON c.report_date = p.target_date")
def scored_predictions(spark, sf):
    return _scored(spark, sf).select("made_on", "target_date", "model_version", F.round("predicted", 6).alias("predicted"), "persistence", F.round("model_error", 6).alias("model_error"), F.round("persistence_error", 6).alias("persistence_error"))


@query(f"WITH {_SCORED} SELECT count(*)::BIGINT AS n, round(avg(abs(predicted - cnt)), 3) AS mae_model, round(avg(abs(last_count - cnt)), 3) AS mae_persistence FROM p JOIN i USING (made_on, target_date) JOIN c ON c.report_date = p.target_date WHERE model_version = 'm1' AND NOT is_estimate")
def scores_of_one_version(spark, sf):
    out = model.errors(_scored(spark, sf, version="m1", estimates=False).withColumnRenamed("persistence", "before"), "predicted", "before", "count")
    return out.select("n", F.round("mae_model", 3).alias("mae_model"), F.round("mae_persistence", 3).alias("mae_persistence"))


@query("SELECT c_name AS model_version, c_acctbal AS trained_at FROM customer ORDER BY c_acctbal DESC, c_name DESC LIMIT 1")
def current_model(spark, sf):
    c = read(spark, sf, "customer").select(F.col("c_name").alias("model_version"), F.col("c_acctbal").alias("trained_at"))
    return model.current(c)


@query(f"WITH {DAILY}, q AS (SELECT 'daily:' || obs_date || ':n' AS obs_id, CASE WHEN n < 3 THEN 'confirmed' END AS decision FROM daily WHERE n > 8 OR n < 3) SELECT obs_date, total, CASE WHEN NOT (n > 8) THEN n END AS n FROM daily")
def held_out_values(spark, sf):
    d = daily_orders(spark, sf)
    ids = d.where("n > 8 or n < 3").select(F.concat_ws(":", F.lit("daily"), F.col("obs_date").cast("string"), F.lit("n")).alias("obs_id"), "n")
    odd = spark.createDataFrame([("daily:never:n",), ("daily:2001-01-01",), ("other:1998-01-01:n",)], "obs_id string")
    decided = ids.where("n < 3").select("obs_id", F.lit("confirmed").alias("decision"))
    return model.held_values(d, "daily", "obs_date", ["total", "n"], ids.select("obs_id").unionByName(odd), decided)


@query()
def poisson_fit(spark, sf):
    f = _training(spark, sf).persist()
    enough = f.count() >= model.LEAST_ROWS
    beta = model.glm(f, model.FEATURES, "count") if enough else []
    f.unpersist()
    return spark.createDataFrame([(n, round(float(b), 6)) for n, b in zip(["const", *model.FEATURES] if enough else [], beta, strict=True)], "name string, coefficient double")


@query()
def negative_binomial_fit(spark, sf):
    f = _training(spark, sf).persist()
    got = model.train(f)
    f.unpersist()
    return spark.createDataFrame([(got.family, got.alpha, got.to_json())] if got else [], "family string, alpha double, params string")
