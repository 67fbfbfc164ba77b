"""State of the watch as set-based transitions: incidents, quarantine, measures, decisions, keyed writes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def upsert(stored: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Incoming rows replace stored rows of the same key; columns that one side lacks are null there."""
    return stored.join(incoming.select(*keys).distinct(), keys, "left_anti").unionByName(incoming, allowMissingColumns=True)


def replace_slice(stored: DataFrame, incoming: DataFrame, slice_keys: list[str]) -> DataFrame:
    return stored.join(incoming.select(*slice_keys).distinct(), slice_keys, "left_anti").unionByName(incoming)


def open_incidents(incidents: DataFrame, verdicts: DataFrame, now: Column) -> DataFrame:
    """New incidents: failing checks without an open one."""
    live = incidents.where("closed_at is null").select("source", "check_name").distinct()
    failing = verdicts.where("failed").dropDuplicates(["source", "check_name"])
    new = failing.join(live, ["source", "check_name"], "left_anti")
    return new.select(F.sha2(F.concat_ws("|", "source", "check_name", now.cast("string")), 256).alias("incident_id"), "source", "check_name", now.alias("opened_at"), F.lit(None).cast("timestamp").alias("closed_at"))


def settle(incidents: DataFrame, verdicts: DataFrame, now: Column) -> DataFrame:
    """Incidents after verdicts: failures open one where none is open, passes close all, no verdict changes nothing."""
    passing = verdicts.groupBy("source", "check_name").agg(F.bool_and(~F.col("failed")).alias("_passed"))
    after = incidents.join(passing, ["source", "check_name"], "left")
    after = after.withColumn("closed_at", F.when(F.col("closed_at").isNull() & F.coalesce("_passed", F.lit(False)), now).otherwise(F.col("closed_at"))).drop("_passed")
    return after.unionByName(open_incidents(incidents, verdicts, now), allowMissingColumns=True)


def quarantine(stored: DataFrame, candidates: DataFrame, order: str) -> DataFrame:
    """Candidates not yet stored, by obs_id; of several the first in order."""
    first = candidates.withColumn("_r", F.row_number().over(W.partitionBy("obs_id").orderBy(order))).where("_r = 1").drop("_r")
    return first.join(stored.select("obs_id"), "obs_id", "left_anti")


def open_items(quarantined: DataFrame, decisions: DataFrame) -> DataFrame:
    return quarantined.join(decisions.select("obs_id"), "obs_id", "left_anti")


def held_out(quarantined: DataFrame, decisions: DataFrame) -> DataFrame:
    """Ids that training leaves out: quarantined, and not confirmed by a decision."""
    joined = quarantined.select("obs_id").join(decisions.select("obs_id", "decision"), "obs_id", "left")
    return joined.where(F.coalesce("decision", F.lit("open")) != "confirmed").select("obs_id").distinct()


def gate(rows: DataFrame, obs_id: Column, held: DataFrame) -> DataFrame:
    return rows.withColumn("obs_id", obs_id).join(held, "obs_id", "left_anti")


DECISIONS = ("confirmed", "rejected")


def decide(quarantined: DataFrame, decisions: DataFrame, obs_id: str, decision: str, reason: str, now: Column, replace: bool = False) -> DataFrame:
    """decisions with one more; refused if unknown, without a reason, about nothing quarantined, or already made."""
    if decision not in DECISIONS:
        raise ValueError(f"unknown decision {decision!r}")
    if not reason.strip():
        raise ValueError("a decision needs a reason")
    if quarantined.where(F.col("obs_id") == obs_id).isEmpty():
        raise ValueError(f"{obs_id} isn't quarantined")
    if not replace and not decisions.where(F.col("obs_id") == obs_id).isEmpty():
        raise ValueError(f"{obs_id} is decided already")
    row = quarantined.sparkSession.range(1).select(F.lit(obs_id).alias("obs_id"), F.lit(decision).alias("decision"), F.lit(reason.strip()).alias("reason"), now.alias("decided_at"))
    return upsert(decisions, row, ["obs_id"])


def queue(quarantined: DataFrame, decisions: DataFrame, today: Column) -> DataFrame:
    """Every quarantined observation with its status and the days that it was or has been open."""
    d = decisions.select("obs_id", "decision", F.to_date("decided_at").alias("cleared_on"))
    out = quarantined.join(d, "obs_id", "left").withColumn("opened_on", F.to_date("opened_at"))
    return out.withColumn("status", F.coalesce("decision", F.lit("open"))).withColumn("days_open", F.datediff(F.coalesce("cleared_on", today), "opened_on"))


def summary(queue: DataFrame, keys: list[str], opened: str, status: str = "status") -> DataFrame:
    """Counts of open and cleared items, and the oldest open one, by keys."""
    is_open = F.col(status) == "open"
    return queue.groupBy(*keys).agg(F.count_if(is_open).alias("n_open"), F.min(F.when(is_open, F.col(opened))).alias("oldest_open"), F.count_if(~is_open).alias("n_cleared"))
