"""Trajectories: sessions, sampling, gaps, headway, dead reckoning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import scalars as S

ORDER = ("ts", "event_id")


def _seconds(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp")) / 1e6


def sessions(points: DataFrame, gap_s: float = 10.0, order: Sequence[str] = ORDER) -> DataFrame:
    """Points with ``session`` (from 1 for each vehicle): a new one begins where more than ``gap_s`` seconds have passed."""
    w = Window.partitionBy("vehicle_id").orderBy(*order)
    fresh = F.coalesce((_seconds("ts") - F.lag(_seconds("ts")).over(w) > gap_s).cast("int"), F.lit(1))
    return points.withColumn("_new", fresh).withColumn("session", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def sampled(times: Column, step: float) -> Column:
    """Of a sorted array of numbers those that are at least ``step`` after the last one kept."""
    empty = F.array().cast("array<double>")
    return F.aggregate(times.cast("array<double>"), empty, lambda acc, x: F.when((F.size(acc) == 0) | (x - F.try_element_at(acc, F.lit(-1)) >= step), F.array_append(acc, x)).otherwise(acc))


def session_summaries(points: DataFrame, gap_s: float = 10.0, order: Sequence[str] = ORDER) -> DataFrame:
    """One row a session: key `start-plate-id`, first type, last time, number of points, and whether the table ends in it."""
    s = sessions(points, gap_s, order)
    o = F.struct(*order)
    end = F.max("last_ts").over(Window.partitionBy("vehicle_id"))
    return (
        s.groupBy("vehicle_id", "session")
        .agg(F.min("ts").alias("start_ts"), F.max("ts").alias("last_ts"), F.min_by("plate", o).alias("plate"), F.min_by("vehicle_type", o).alias("type"), F.count("*").alias("points"))
        .withColumn("key", S.trajectory_key(S.epoch_ms(F.col("start_ts")), F.col("plate"), F.col("vehicle_id")))
        .withColumn("is_open", F.col("last_ts") == end)
    )


def session_samples(points: DataFrame, gap_s: float, step_s: float, order: Sequence[str] = ORDER) -> DataFrame:
    """Number of points of each session, how many greedy down-sampling keeps, and the last kept second of it."""
    s = sessions(points, gap_s, order).groupBy("vehicle_id", "session").agg(F.sort_array(F.collect_list(_seconds("ts"))).alias("t"))
    return s.withColumn("kept", sampled(F.col("t"), step_s)).select("vehicle_id", "session", F.size("t").alias("points"), F.size("kept").alias("kept"), F.try_element_at("kept", F.lit(-1)).alias("last_kept"))


def trajectory_lists(points: DataFrame, gap_s: float, fields: Sequence[str], order: Sequence[str] = ORDER) -> DataFrame:
    """Each session with its points as one array in time order."""
    s = sessions(points, gap_s, order)
    return s.groupBy("vehicle_id", "session").agg(F.sort_array(F.collect_list(F.struct(*order, *fields))).alias("trajectory"))


def moving_speed(points: DataFrame, size: int = 20, order: Sequence[str] = ORDER) -> DataFrame:
    w = Window.partitionBy("vehicle_id").orderBy(*order).rowsBetween(1 - size, 0)
    return points.withColumn("mean_speed", F.avg("speed").over(w))


def headings(points: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    """Bearing from the position before; null for a vehicle's first point."""
    w = Window.partitionBy("vehicle_id").orderBy(*order)
    return points.withColumn("heading", S.bearing(F.lag("latitude").over(w), F.lag("longitude").over(w), F.col("latitude"), F.col("longitude")))


def missed_frames(points: DataFrame, frames: DataFrame) -> DataFrame:
    """How many frames passed between a vehicle's sightings. Frames are numbered by day totals and within days."""
    f = frames.select("frame", "day").distinct()
    base = f.groupBy("day").count().select("day", F.coalesce(F.sum("count").over(Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    rank = f.join(base, "day").select("frame", (F.col("_base") + F.row_number().over(Window.partitionBy("day").orderBy("frame"))).alias("rank"))
    seen = points.select("vehicle_id", "frame").distinct().join(rank, "frame")
    return seen.withColumn("missed", F.col("rank") - F.lag("rank").over(Window.partitionBy("vehicle_id").orderBy("rank")) - 1)


def before(rows: DataFrame, by: str, bucket: Column, order: Sequence[str], value: Column, name: str) -> DataFrame:
    """``rows`` with ``name``: the value of the row before within ``by``. ``bucket`` grows with the order: within a bucket
    it is a lag, and a bucket's first row gets the last value of the bucket before, so that a hot ``by`` spreads."""
    r = rows.withColumns({"_bucket": bucket, "_value": value})
    o = F.struct(*order)
    ends = r.groupBy(by, "_bucket").agg(F.max_by("_value", o).alias("_end"))
    carried = ends.select(F.col(by).alias("_by"), F.col("_bucket").alias("_b"), F.lag("_end").over(Window.partitionBy(by).orderBy("_bucket")).alias("_carried"))
    w = Window.partitionBy(by, "_bucket").orderBy(*order)
    r = r.withColumns({"_own": F.lag("_value").over(w), "_first": F.row_number().over(w) == 1})
    same = F.col(by).eqNullSafe(F.col("_by")) & F.col("_bucket").eqNullSafe(F.col("_b"))
    return r.join(carried, same).withColumn(name, F.when(F.col("_first"), F.col("_carried")).otherwise(F.col("_own"))).drop("_bucket", "_value", "_by", "_b", "_carried", "_own", "_first")


def message_gaps(messages: DataFrame, by: str, order: Sequence[str] = ORDER, bucket: Column | None = None) -> DataFrame:
    """Milliseconds since the message before; messages meet by source and hour, or the given ``bucket``."""
    ms = S.epoch_ms(F.col("ts"))
    b = before(messages, by, F.date_trunc("hour", "ts") if bucket is None else bucket, order, ms, "_before")
    return b.withColumn("gap_ms", ms - F.col("_before")).drop("_before")


def sequence_gaps(messages: DataFrame, by: str, sn: str, order: Sequence[str] = ORDER, bucket: Column | None = None) -> DataFrame:
    """Messages whose number isn't one more than that of the message before."""
    b = before(messages, by, F.date_trunc("hour", "ts") if bucket is None else bucket, order, F.col(sn), "before")
    return b.where(F.col(sn) != F.col("before") + 1)


def headway(points: DataFrame, least: int = 10) -> DataFrame:
    """Distance to the next vehicle ahead in the same frame, lane and direction, where it is under ``least`` metres."""
    w = Window.partitionBy("frame", "lane", "direction").orderBy("mileage", "event_id")
    return points.withColumn("ahead", F.lead("mileage").over(w) - F.col("mileage")).where(F.col("ahead") < least)


def snapshot(points: DataFrame, frames: int, order: Sequence[str] = ORDER) -> DataFrame:
    """Trajectories of all vehicles up to the n-th frame, open as they are."""
    first = points.select("frame").distinct().orderBy("frame").limit(frames)
    early = points.join(F.broadcast(first), "frame", "left_semi")  # ``frames`` rows at most
    return early.groupBy("vehicle_id").agg(F.count("*").alias("points"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(*order, "mileage"))), lambda x: x["mileage"].cast("string")), ",").alias("mileages"))


def last_road_code(points: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    """Last road code of each vehicle and plate."""
    return points.groupBy("vehicle_id", "plate").agg(F.max_by("road", F.struct(*order)).alias("road"))
