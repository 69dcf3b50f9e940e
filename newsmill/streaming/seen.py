"""Exact seen-state over a stream of appearances, batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsmill.operators.seen import LOOKBACK_DAYS, send_decisions
from newsmill.streaming.memory import Memory

OUTPUT = "id string, sent_date date, late boolean"


def send_batch(batch: DataFrame, earlier: DataFrame, lookback: int = LOOKBACK_DAYS) -> DataFrame:
    """``(id, sent_date, late)`` of a batch of included (id, run_date) appearances.

    Sends follow from the last stored send of each id, which is put in front of
    its new days; sends too old to matter for any of them are not read. A day
    before the last send of its id cannot be decided any more: it is listed with
    ``late`` true instead of being dropped.
    """
    days = batch.select("id", "run_date").distinct()
    oldest = days.agg(F.date_sub(F.min("run_date"), lookback).alias("oldest")).first().oldest
    known = earlier.filter(~F.col("late"))
    if oldest is not None:
        known = known.filter(F.col("sent_date") >= F.lit(oldest))
    last = known.groupBy("id").agg(F.max("sent_date").alias("last"))
    placed = days.join(last, "id", "left")
    late = placed.filter(F.col("run_date") < F.col("last"))
    new = placed.filter(F.coalesce(F.col("run_date") > F.col("last"), F.lit(True)))
    seeds = last.join(new.select("id").distinct(), "id").select("id", F.col("last").alias("run_date"), F.lit(1).cast("bigint").alias("seed"))
    visits = new.select("id", "run_date", F.lit(0).cast("bigint").alias("seed")).unionByName(seeds)
    decided = send_decisions(visits.withColumn("included", F.lit(True)), lookback, carry=["seed"])
    sent = decided.filter(F.col("sent") & (F.col("seed") == 0)).select("id", F.col("run_date").alias("sent_date"), F.lit(False).alias("late"))
    return sent.unionByName(late.select("id", F.col("run_date").alias("sent_date"), F.lit(True).alias("late")))


def send_remembered(batch: DataFrame, known: DataFrame, keep_days: int, lookback: int = LOOKBACK_DAYS) -> DataFrame:
    """``send_batch`` by what a ``Memory`` holds, which forgets sends ``keep_days`` behind the newest.

    A day whose look-back reaches into what may be forgotten cannot be decided: it is
    listed with ``late`` true. Otherwise the result is that of ``send_batch``.
    """
    if keep_days < lookback:
        raise ValueError("sends must be kept for the look-back at least")
    newest = Memory.newest(known)
    sends = known.select("id", F.col("at").alias("sent_date"), F.lit(False).alias("late"), "day")
    if newest is None:
        return send_batch(batch, sends.drop("day"), lookback)
    horizon = F.date_sub(F.lit(newest), keep_days - lookback)
    days = batch.select("id", "run_date").distinct()
    decidable = days.filter(F.col("run_date") >= horizon)
    oldest = decidable.agg(F.date_sub(F.min("run_date"), lookback).alias("day")).first().day
    if oldest is not None:
        sends = sends.filter(F.col("day") >= F.lit(oldest))
    forgotten = days.filter(F.col("run_date") < horizon)
    forgotten = forgotten.select("id", F.col("run_date").alias("sent_date"), F.lit(True).alias("late"))
    return send_batch(decidable, sends.drop("day"), lookback).unionByName(forgotten)


def send_dates(results: DataFrame) -> DataFrame:
    """What a ``Memory`` keeps of stored sends."""
    return results.filter(~F.col("late")).select("id", F.col("sent_date").alias("at"))
