"""Dead reckoning: predicted points of vehicles that aren't seen, in numpy over batches of gaps (Spark deals and explodes)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import scalars as S
from .roads import Roads, bearings

#: Ends of the road in metres; predicted rows that go into one Arrow batch.
LOW, HIGH, ROWS = 1016020, 1173790, 500_000
OUT = "vehicle_id long, direction int, plate string, frame long, mileage long, speed double, removed boolean"
WALKED = OUT + ", road string, longitude double, latitude double, heading double"


def forward(direction: Column, road: Column | None) -> Column:
    """Whether the mileage grows: on ramps always, on the mainline in direction 1."""
    up = direction == 1
    return up if road is None else up | (F.coalesce(road, F.lit("K")) != "K")


def predicted(
    frames: Iterator[pd.DataFrame], interval_ms: int, window: int, wait: int, removals: bool, roads: Roads | None = None, carry: bool = False
) -> Iterator[pd.DataFrame]:
    """Steps of all gaps of a batch side by side: the mean of the last ``window`` speeds, which each step joins. With
    ``roads`` they walk along road rows, else between the ends of the mainline, and ``carry`` keeps the sighting's road and
    coordinate. Steps up to a gap's ``done``, if there is one, were given before."""
    for pdf in frames:
        n = len(pdf)
        held = np.zeros((n, window))
        count = np.fromiter((len(v) for v in pdf["speeds"]), np.int64, n)
        for i, v in enumerate(pdf["speeds"]):
            held[i, : len(v)] = v
        at, gap, up = (pdf[c].to_numpy() for c in ("mileage", "gap", "up"))
        at, low, high = at.astype(np.int64), pdf["low"].to_numpy(), pdf["high"].to_numpy()
        done = pdf["done"].to_numpy() if "done" in pdf else np.zeros(n, np.int64)
        live = np.flatnonzero(count > 0)
        parts: list[tuple[np.ndarray, ...]] = []
        rows, k = 0, 0
        if roads:
            road = roads.index(pdf["road"])
            row, lon, lat = roads.row(road, at), pdf["longitude"].to_numpy(float, na_value=np.nan).copy(), pdf["latitude"].to_numpy(float, na_value=np.nan).copy()
            at = at.copy()

        def out() -> pd.DataFrame:
            which, step, mileage, speed, gone, *walk = (np.concatenate(c) for c in zip(*parts, strict=True))
            made = pd.DataFrame({
                "vehicle_id": pdf["vehicle_id"].to_numpy()[which], "direction": pdf["direction"].to_numpy()[which], "plate": pdf["plate"].to_numpy()[which],
                "frame": pdf["frame"].to_numpy()[which] + wait + step, "mileage": mileage, "speed": speed, "removed": gone,
            })
            if roads:
                return made.assign(road=pdf["road"].to_numpy()[which], longitude=walk[0], latitude=walk[1], heading=walk[2])
            if carry:
                made = made.assign(road=pdf["road"].to_numpy()[which], **{c: np.where(gone, 0.0, pdf[c].to_numpy(float, na_value=np.nan)[which]) for c in ("longitude", "latitude")}, heading=np.where(gone, 0.0, np.nan))
            return made

        while len(live):
            k += 1
            live = live[gap[live] >= k]
            if not len(live):
                break
            total = np.zeros(len(live))
            for j in range(window):  # oldest first, as a fold adds them
                total += np.where(j < count[live], held[live, j], 0.0)
            v = total / count[live]
            d = v * interval_ms / 3600
            if roads:
                on, ahead, new = roads.step(road[live], row[live], at[live], d, up[live])
                row[live[on]] = ahead[on]
            else:
                new = np.where(up[live], at[live] + d, at[live] - d)
                on = (new >= low[live]) & (new <= high[live])
            if removals and not on.all():
                off = live[~on]
                off = off[done[off] < k]
                nothing = np.zeros(len(off))
                parts.append((off, np.full(len(off), k), np.zeros(len(off), np.int64), nothing, np.ones(len(off), bool), *([nothing] * 3 if roads else [])))
                rows += len(off)
            live, v = live[on], v[on]
            at[live] = new[on].astype(np.int64)
            full = count[live] == window
            held[live[full], :-1] = held[live[full], 1:]
            held[live[full], -1] = v[full]
            held[live[~full], count[live[~full]]] = v[~full]
            count[live[~full]] += 1
            walk = []
            if roads:
                x, y = roads.place(road[live], row[live])
                walk = [x, y, bearings(lat[live], lon[live], y, x)]
                lon[live], lat[live] = x, y
            new = done[live] < k
            give = live[new]
            parts.append((give, np.full(len(give), k), at[give], v[new], np.zeros(len(give), bool), *(w[new] for w in walk)))
            rows += len(give)
            if rows >= ROWS:
                yield out()
                parts, rows = [], 0
        if parts:
            yield out()


def completed(
    points: DataFrame, interval_ms: int = 200, max_gap: int = 3000, low: int = LOW, high: int = HIGH, window: int = 20, by_road: bool = False, until: int | None = None,
    wait: int = 0, removals: bool = False, roads: Roads | None = None,
) -> DataFrame:
    """Predicted points of the frames in which a vehicle is missing after a sighting.

    ``points(vehicle_id, frame, mileage, direction, speed, plate)``, one a frame. The speed is the mean of the last
    ``window`` speeds since the vehicle (re)appeared, which each step joins; each step goes speed * interval metres up
    or down the road, truncated to whole metres. Prediction ends at the next sighting, after ``max_gap`` frames, or where
    it leaves the road; with ``removals`` that gives one last row (``removed``, fields zero). With ``by_road`` the
    points' ``road`` code picks the rule: on ramps (any code but K) the mileage always grows. With ``until`` a vehicle that
    isn't seen again is predicted up to that frame. With ``wait`` prediction starts so many frames later (a timeout).
    With ``roads`` the points (which also have ``longitude, latitude``) walk along the rows of their ``road``: predicted
    points have coordinate, heading (bearing from the place before) and a stake with the road's prefix, and each road
    ends where its rows do. A sighting without any speed known predicts nothing. One shuffle, by vehicle; speeds are gathered
    among the last ``window`` rows of a run alone. The steps of all gaps of a batch are taken side by side.
    """
    back = Window.partitionBy("vehicle_id").orderBy(F.desc("frame"))
    gap = F.lag("frame").over(back) - F.col("frame") - 1
    if until is not None:
        gap = F.coalesce(gap, F.lit(until) - F.col("frame"))
    # Backwards in time each run begins with its last sighting; only the rows that its mean needs go on.
    p = points.withColumns({"gap": gap, "_n": F.row_number().over(back)})
    begins = F.when((F.col("gap") > 0) | (F.col("_n") == 1), F.col("_n"))
    p = p.withColumn("_run", F.max(begins).over(back.rowsBetween(Window.unboundedPreceding, 0))).where(F.col("_n") - F.col("_run") < window)
    speeds = F.collect_list("speed").over(Window.partitionBy("vehicle_id", "_run").orderBy("frame").rowsBetween(1 - window, 0))
    p = p.withColumn("speeds", speeds).where("gap > 0").withColumn("gap", F.least("gap", F.lit(max_gap)) - wait).where("gap > 0")
    p = p.select(
        "vehicle_id", F.col("direction").cast("int").alias("direction"), "plate", F.col("frame").cast("long").alias("frame"), F.col("mileage").cast("long").alias("mileage"), F.col("speeds").cast("array<double>").alias("speeds"),
        F.col("gap").cast("long").alias("gap"), F.coalesce(forward(F.col("direction"), F.col("road") if by_road else None), F.lit(False)).alias("up"), F.lit(low).alias("low"), F.lit(high).alias("high"),
        *(["road", F.col("longitude").cast("double").alias("longitude"), F.col("latitude").cast("double").alias("latitude")] if roads else []),
    )
    out = p.mapInPandas(lambda frames: predicted(frames, interval_ms, window, wait, removals, roads), WALKED if roads else OUT)
    return labelled(out, roads is not None)


def labelled(out: DataFrame, by_road: bool) -> DataFrame:
    """Predicted points with their mark on the plate and a stake, with the road's prefix if ``by_road``."""
    stake = F.concat(F.col("road"), F.substring(S.metres_to_stake(F.col("mileage")), 2, 99)) if by_road else S.metres_to_stake(F.col("mileage"))
    kept = F.when(F.col("removed"), F.lit("0")).otherwise(S.mark_predicted(F.col("plate")))
    return out.withColumns({"plate": kept, "stake": F.when(~F.col("removed"), stake), "is_predicted": F.lit(True)})


def filled(points: DataFrame, stakes: DataFrame) -> DataFrame:
    """Received points with what they lack: a missing (null or empty) stake from the coordinate, a missing coordinate
    (null, 0 or -1) from the stake's mileage in the stake table, clamped to its ends; both stay missing if neither is there."""
    from . import lookup

    lacks = lambda c: F.col(c).isNull() | F.col(c).isin(0.0, -1.0)
    blind = lacks("latitude") | lacks("longitude")
    given = points.withColumns({"_given": F.when(F.length("stake") > 0, F.col("stake")), "latitude": F.when(~blind, F.col("latitude")), "longitude": F.when(~blind, F.col("longitude"))})
    named = lookup.coordinate_stake(given.drop("stake"), stakes).withColumn("stake", F.coalesce("_given", "stake")).drop("_given")
    placed = named.withColumns({"_lon": F.col("longitude"), "_lat": F.col("latitude"), "_at": F.col("mileage"), "mileage": S.stake_to_metres(F.col("stake"))}).drop("longitude", "latitude")
    found = lookup.clamped_coordinate(placed, stakes)
    return found.withColumns({"longitude": F.coalesce("_lon", "longitude"), "latitude": F.coalesce("_lat", "latitude"), "mileage": F.coalesce("_at", "mileage")}).drop("_lon", "_lat", "_at")


def station_points(frames: DataFrame, road: DataFrame, targets: str, key: str, fields: dict[str, str], prefix: str = "") -> DataFrame:
    """Targets of base-station or lidar frames as path points: the stake of the nearest road point (``prefix`` put before
    it), its mileage, the angle with two decimals. ``fields`` maps path fields to the target's fields."""
    t = frames.select(key, F.posexplode(targets).alias("pos", "t"))
    p = t.select(key, "pos", *[F.col(f"t.{v}").alias(k) for k, v in fields.items()])
    from . import lookup

    near = lookup.nearest_road_point(p, road).join(road.select("road_seq", F.col("stake").alias("_stake")), "road_seq", "left")
    return near.withColumns({
        "stakeId": F.concat(F.lit(prefix), F.col("_stake")), "mileage": S.stake_to_metres(F.col("_stake")), "carAngle": S.decimals(F.col("carAngle"), 2).cast("double"), "weight": F.lit(0.0),
    }).drop("road_seq", "l1", "_stake")


def station_path_frames(points: DataFrame, key: str) -> DataFrame:
    """Path frames of ``station_points``: the list of each frame in the targets' order, and its size. A frame is one
    message, so no list outgrows what came in."""
    fields = [c for c in points.columns if c not in (key, "pos")]
    lists = points.groupBy(key).agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", F.struct(*fields).alias("p")))), lambda x: x["p"]).alias("pathList"))
    return lists.withColumn("pathNum", F.size("pathList"))
