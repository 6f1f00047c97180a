"""Fusion: sensors with each other, and gantry reads with anonymous tracks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.sinks import staged
from . import flow


def aligned(ms: Column, phase: int, grid: int = 200) -> Column:
    """Time moved down to the grid of the first sensor."""
    return ms - F.pmod(ms - phase, F.lit(grid))


def merged_sensors(a: DataFrame, b: DataFrame, key: str, points: str) -> DataFrame:
    """Frames of two sensors at the same time, with both point lists one after the other (duplicates stay)."""
    other = b.select(key, F.col(points).alias("_other"))
    return a.join(other, key).withColumn(points, F.concat(points, "_other")).drop("_other")


def candidates(reads: DataFrame, points: DataFrame, seen_before: DataFrame | None, reach: int, wait_ms: int, step_ms: int) -> DataFrame:
    """Pairs of ``reads`` and ``points`` of the same direction, within ``reach`` metres, the point at most ``wait_ms`` after
    the read: with ``p_ms, p_mileage, p_lane, distance, tries`` (steps of ``step_ms`` waited) and ``known``. They meet by
    time and place cells."""
    slot = lambda c: F.floor(c / wait_ms)
    cell = lambda c: F.floor(c / reach)
    r = reads.withColumn("_slot", F.explode(F.array(slot(F.col("ms")), slot(F.col("ms")) + 1)))
    r = r.withColumn("_cell", F.explode(F.sequence(cell(F.col("mileage")) - 1, cell(F.col("mileage")) + 1)))
    p = points.select("vehicle_id", "direction", F.col("ms").alias("p_ms"), F.col("mileage").alias("p_mileage"), F.col("lane").alias("p_lane"), slot(F.col("ms")).alias("_slot"), cell(F.col("mileage")).alias("_cell"))
    away = F.abs(F.col("p_mileage") - F.col("mileage"))
    c = r.join(p, ["direction", "_slot", "_cell"]).where((F.col("p_ms") >= F.col("ms")) & (F.col("p_ms") <= F.col("ms") + wait_ms) & (away <= reach))
    c = c.withColumn("distance", away).withColumn("tries", F.floor((F.col("p_ms") - F.col("ms")) / step_ms)).drop("_slot", "_cell")
    if seen_before is None:
        return c.withColumn("known", F.lit(None).cast("int"))
    return c.join(seen_before.select("vehicle_id").distinct().withColumn("known", F.lit(1)), "vehicle_id", "left")


def passes() -> list[tuple[Column, list[Column]]]:
    """Condition and preference of each of the three passes over ``candidates``."""
    clear = F.coalesce(F.col("env") != "99", F.lit(True))
    same = F.col("p_lane") == F.col("lane")
    behind = F.when(F.col("direction") == 1, F.col("p_mileage") <= F.col("mileage")).otherwise(F.col("p_mileage") >= F.col("mileage"))
    side = (F.abs(F.col("p_lane") - F.col("lane")) <= 1) | (F.col("p_lane") == 5)
    return [
        (clear & same & behind, [F.col("tries"), F.col("distance")]),
        (clear & side, [F.col("tries"), -F.coalesce("known", F.lit(0)), (~same).cast("int"), F.col("distance")]),
        (~clear, [F.col("tries"), F.col("distance")]),
    ]


def reads_to_tracks(
    reads: DataFrame, points: DataFrame, seen_before: DataFrame | None = None, reach: int = 100, wait_ms: int = 6000, step_ms: int = 400, guard_ms: int = 15_000
) -> DataFrame:
    """``reads`` with ``vehicle_id, pass, distance, match_ms`` of the vehicle that each belongs to, null where none is found.

    ``reads(read_id, ms, direction, mileage, lane, env)`` meet ``points(vehicle_id, ms, direction, mileage, lane)`` of
    the same direction within ``reach`` metres and ``wait_ms`` after the read, at steps of ``step_ms``. Pass 1 wants the
    same lane and a vehicle that isn't past the gate, pass 2 a neighbouring lane or lane 5, vehicles known before and of
    the same lane first, pass 3 serves the reads of bad weather (99). In each pass a read takes its best candidate that
    isn't within ``guard_ms`` of a match of its vehicle in an earlier pass; of reads that want the same vehicle at times
    less than ``guard_ms`` apart the nearest wins (ties: the smaller read_id). So a vehicle passes gantry after gantry,
    and a read belongs to one vehicle at most. Candidates and winners of each pass are computed once.
    """
    c = staged(candidates(reads, points, seen_before, reach, wait_ms, step_ms), "candidates")
    matched: DataFrame | None = None
    for k, (fit, order) in enumerate(passes(), 1):
        left = c.where(fit)
        if matched is not None:
            left = left.join(matched.select("read_id"), "read_id", "left_anti")
            # Matches lie in cells of the guard's width: those within it are in the cell or beside it.
            cell = F.floor(F.col("p_ms") / guard_ms)
            busy = matched.select("vehicle_id", F.col("match_ms").alias("_busy"), F.explode(F.array(*[F.floor(F.col("match_ms") / guard_ms) + d for d in (-1, 0, 1)])).alias("_cell"))
            near = F.abs(F.col("_busy") - F.col("p_ms")) < guard_ms
            left = left.withColumn("_cell", cell)
            left = left.join(busy, (left["vehicle_id"] == busy["vehicle_id"]) & (left["_cell"] == busy["_cell"]) & near, "left_anti").drop("_cell")
        # The best candidate of each read by an aggregate: a task sends one a read.
        fields = [c for c in left.columns if c != "read_id"]
        best = left.groupBy("read_id").agg(F.min_by(F.struct(*fields), F.struct(*order, "vehicle_id", "p_ms")).alias("_c")).select("read_id", "_c.*")
        rival = F.min(F.struct("distance", "read_id")).over(Window.partitionBy("vehicle_id").orderBy("p_ms").rangeBetween(1 - guard_ms, guard_ms - 1))
        won = best.withColumn("_best", rival).where(F.col("_best") == F.struct("distance", "read_id"))
        won = staged(won.select("read_id", "vehicle_id", F.lit(k).alias("pass"), "distance", F.col("p_ms").alias("match_ms")), "matches")
        matched = won if matched is None else matched.unionByName(won)
    return reads.join(matched, "read_id", "left")


def fused_and_summed(reads: DataFrame, points: DataFrame, tick: Column, **options) -> tuple[DataFrame, DataFrame]:
    """The fused reads, and as a second output of the same run the summary of each tick (``flow.match_summary``)."""
    fused = staged(reads_to_tracks(reads, points, **options).withColumn("tick", tick), "fused")
    return fused.drop("tick"), flow.match_summary(fused)


def reads_to_images(reads: DataFrame, images: DataFrame, within_s: int = 20) -> DataFrame:
    """Reads with the image of the same plate and upload time that came within ``within_s`` seconds; null if none did."""
    i = images.select("plate", "upload", F.col("ts").alias("_ts"), "image_id")
    near = (F.col("r.plate") == F.col("i.plate")) & (F.col("r.upload") == F.col("i.upload")) & F.col("i._ts").between(F.col("r.ts"), F.col("r.ts") + F.expr(f"INTERVAL {within_s} SECONDS"))
    return reads.alias("r").join(i.alias("i"), near, "left").select("r.*", "i.image_id")
