"""Unions, differences, faults and orders over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from obswatch.operators import faults
from obswatch.plans.registry import query
from obswatch.plans.tables import read


@query("SELECT NULL::BIGINT AS k, 'placeholder' AS name UNION ALL SELECT n_nationkey, n_name FROM nation")
def union_placeholder(spark, sf):
    one = spark.range(1).select(F.lit(None).cast("long").alias("k"), F.lit("placeholder").alias("name"))
    return one.unionByName(read(spark, sf, "nation").select(F.col("n_nationkey").cast("long").alias("k"), F.col("n_name").alias("name")))


@query("SELECT DISTINCT o_orderdate::DATE AS d FROM orders EXCEPT SELECT DISTINCT l_shipdate::DATE FROM lineitem")
def except_dates(spark, sf):
    o = read(spark, sf, "orders").select(F.to_date("o_orderdate").alias("d")).distinct()
    return o.join(read(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("d")).distinct(), "d", "left_anti")


@query("SELECT coalesce(a.d, b.d) AS d, CASE WHEN b.d IS NULL THEN 'missing' WHEN a.d IS NULL THEN 'extra' WHEN a.n = b.n THEN 'agree' ELSE 'disagree' END AS verdict FROM (SELECT o_orderdate::DATE AS d, count(*) AS n FROM orders GROUP BY 1) a FULL JOIN (SELECT l_shipdate::DATE AS d, count(DISTINCT l_orderkey) AS n FROM lineitem GROUP BY 1) b ON a.d = b.d")
def agreement_score(spark, sf):
    a = read(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("d")).agg(F.count("*").alias("n"))
    b = read(spark, sf, "lineitem").groupBy(F.to_date("l_shipdate").alias("d")).agg(F.countDistinct("l_orderkey").alias("m"))
    verdict = F.when(F.col("m").isNull(), "missing").when(F.col("n").isNull(), "extra").when(F.col("n") == F.col("m"), "agree").otherwise("disagree")
    return a.join(b, "d", "full").select("d", verdict.alias("verdict"))


@query("SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem ORDER BY ALL")
def order_all(spark, sf):
    return read(spark, sf, "lineitem").select("l_returnflag", "l_linestatus").distinct().orderBy("l_returnflag", "l_linestatus")


@query("SELECT p_partkey, p_retailprice * 1.8 + 32 AS p_retailprice FROM part")
def mutate_unit_change(spark, sf):
    return faults.unit_change(read(spark, sf, "part").select("p_partkey", "p_retailprice"), "p_retailprice", 1.8, 32.0)


@query("SELECT s_suppkey AS s_suppkey_renamed, NULL::VARCHAR AS extra FROM supplier")
def mutate_rename_and_drift(spark, sf):
    return faults.added_column(faults.renamed_key(read(spark, sf, "supplier").select("s_suppkey"), "s_suppkey"), "extra")


@query("SELECT count(*)::BIGINT AS n, round(count(*) * 0.3)::BIGINT AS n_null FROM customer")
def mutate_null_spike(spark, sf):
    c = read(spark, sf, "customer").select("c_custkey", F.lit(1.0).alias("v"))
    return faults.null_spike(c, "v", ["c_custkey"], 0.3, 7).agg(F.count("*").alias("n"), F.count_if(F.col("v").isNull()).alias("n_null"))


@query("SELECT (count(*) + round(count(*) * 0.2))::BIGINT AS n, count(*)::BIGINT AS n_keys FROM customer")
def mutate_duplicates(spark, sf):
    out = faults.duplicates(read(spark, sf, "customer").select("c_custkey"), ["c_custkey"], 0.2, 3)
    return out.agg(F.count("*").alias("n"), F.countDistinct("c_custkey").alias("n_keys"))


@query("SELECT user_id, array_to_string(list_sort(list(DISTINCT event_type)), '; ') AS kinds FROM events GROUP BY 1")
def sorted_set_text(spark, sf):
    return read(spark, sf, "events").groupBy("user_id").agg(F.array_join(F.array_sort(F.collect_set("event_type")), "; ").alias("kinds"))
