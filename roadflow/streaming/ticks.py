"""Fusion of gantry reads with tracks tick by tick: a read that finds no vehicle waits for the next tick."""

from __future__ import annotations

import itertools
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import flow, lookup
from ..sources import sinks
from .ordered import Ordered, ordered


class TickFusion(Ordered):
    """Reads and points near one gantry, one tick (a slice of ``step_ms``) after the other, each once the watermark has passed it.

    At a tick the waiting reads try its points in three passes: the same lane and not past the gate; a neighbouring
    lane or lane 5, vehicles known before and of the same lane first; and reads of bad weather (99) any lane. A read takes
    the nearest vehicle that isn't within ``guard_ms`` of its last match here; of reads that want the same vehicle the
    nearest wins (ties: the smaller read). Whoever has found one is settled, at its first fitting tick; the others are
    queued again until ``wait_ms`` after the read, and are anomalies at the tick that ends in.
    """

    fields = "us long, id long, is_read boolean, mileage long, lane int, env string, known boolean"
    memory = "waiting array<struct<read_id:bigint,ms:bigint,mileage:bigint,lane:int,env:string>>, matched array<struct<vehicle_id:bigint,ms:bigint>>"

    def __init__(self, wait_ms: int, step_ms: int, guard_ms: int):
        super().__init__(step_ms)
        self.wait, self.guard = wait_ms, guard_ms

    def load(self, remembered: tuple) -> tuple[dict, dict]:
        return {r[0]: tuple(r[1:]) for r in remembered[0]}, dict(tuple(r) for r in remembered[1])

    def save(self, s: tuple[dict, dict]) -> tuple:
        return [(read, *r) for read, r in s[0].items()], list(s[1].items())

    @staticmethod
    def _fits(number: int, mileage: int, lane: int | None, point: tuple, direction: int) -> tuple | None:
        """How well a point fits the reads of a place and lane in a pass (smaller is better); None if it doesn't."""
        _, _, place, own, known = point
        far = abs(place - mileage)
        if number == 1 and own == lane and (place <= mileage if direction == 1 else place >= mileage):
            return (far,)
        if number == 2 and own is not None and lane is not None and (abs(own - lane) <= 1 or own == 5):
            return (not known, own != lane, far)
        return (far,) if number == 3 else None

    def _give_up(self, tick: int, waiting: dict, out: list[tuple]) -> None:
        """Reads whose time has ended before the tick; they wait in order of time."""
        for read, r in list(itertools.takewhile(lambda x: (x[1][0] + self.wait) // self.slice_ms < tick, waiting.items())):
            del waiting[read]
            out.append((read, None, None, None, None, (r[0] + self.wait) // self.slice_ms))

    def take(self, key: tuple, rows: list[tuple], s: tuple[dict, dict] | None, out: list[tuple]) -> tuple[dict, dict]:
        waiting, matched = s or ({}, {})
        for tick, here in itertools.groupby(rows, lambda r: r[0] // (self.slice_ms * 1000)):
            self._give_up(tick, waiting, out)
            points = []
            for us, ident, is_read, mileage, lane, env, known in here:
                if is_read:
                    waiting[ident] = (us // 1000, mileage, lane, env)
                else:
                    points.append((us // 1000, ident, mileage, lane, bool(known)))
            if points:
                self._tick(key[0], points, waiting, matched, out)
        return waiting, matched

    def _tick(self, direction: int, points: list[tuple], waiting: dict, matched: dict, out: list[tuple]) -> None:
        alike: dict[tuple, list[int]] = {}  # reads that see the points alike, but for their times
        for read, (_, mileage, lane, env) in waiting.items():
            alike.setdefault((env == "99", mileage, lane), []).append(read)
        for number in (1, 2, 3):
            free = [p for p in points if p[1] not in matched or abs(p[0] - matched[p[1]]) >= self.guard]
            wanted: dict[int, tuple] = {}
            for (bad, mileage, lane), reads in alike.items():
                if bad != (number == 3):
                    continue
                fits = ((self._fits(number, mileage, lane, p, direction), p) for p in free)
                best = sorted((fit, p[1], p[0], abs(p[2] - mileage)) for fit, p in fits if fit is not None)
                for read in reads if best else ():
                    ms = waiting[read][0] if read in waiting else None
                    found = next((b for b in best if ms <= b[2] <= ms + self.wait), None) if ms is not None else None
                    if found:
                        _, vehicle, at, far = found
                        wanted[vehicle] = min(wanted.get(vehicle, (far, read, at)), (far, read, at))
            for vehicle, (far, read, at) in wanted.items():
                matched[vehicle] = at
                del waiting[read]
                out.append((read, vehicle, number, far, at, at // self.slice_ms))

    def passed(self, key: tuple, over_ms: int, s: tuple[dict, dict], out: list[tuple]) -> tuple[dict, dict] | None:
        waiting, matched = s
        self._give_up(over_ms // self.slice_ms, waiting, out)
        matched = {vehicle: ms for vehicle, ms in matched.items() if ms + self.guard >= over_ms}
        return (waiting, matched) if waiting or matched else None

    def due(self, s: tuple[dict, dict], over_ms: int) -> int:
        times = [((r[0] + self.wait) // self.slice_ms + 1) * self.slice_ms for r in itertools.islice(s[0].values(), 1)]
        return min([*times, *(ms + self.guard + 1 for ms in s[1].values())])

    def _frame(self, out: list[tuple]):
        return super()._frame(out).astype({"vehicle_id": "Int64", "pass": "Int32", "distance": "Int64", "match_ms": "Int64"})


def settled_by_tick(
    reads: DataFrame, points: DataFrame, gantries: DataFrame, reach: int = 100, wait_ms: int = 6000, step_ms: int = 400, guard_ms: int = 15_000, delay: str = "5 minutes"
) -> DataFrame:
    """``read_id, vehicle_id, pass, distance, match_ms, tick``: every read once, with the vehicle that it was settled with and the
    tick of that, or nulls and the tick at which it was given up. ``reads(read_id, ts, direction, mileage, lane, env)`` stand
    at gantries; ``points(vehicle_id, ts, direction, mileage, lane, known)`` go to the nearest gantry within ``reach``.
    State is kept by direction and gantry."""
    at = reads.join(gantries.select(F.col("id").alias("gantry_id"), "mileage", "direction"), ["mileage", "direction"])
    near = lookup.nearest_gantry(points, gantries, reach).where("gantry_id <> 0")
    one = lambda df, ident, is_read, env, known: df.select(
        F.col("direction").cast("int").alias("direction"), F.col("gantry_id").cast("long").alias("gantry_id"), F.col(ident).cast("long").alias("id"), F.lit(is_read).alias("is_read"),
        F.col("ts").cast("timestamp").alias("ts"), F.col("mileage").cast("long").alias("mileage"), F.col("lane").cast("int").alias("lane"), env.alias("env"), known.alias("known"),
    )
    both = one(at, "read_id", True, F.col("env"), F.lit(False)).unionByName(one(near, "vehicle_id", False, F.lit(None).cast("string"), F.coalesce("known", F.lit(False))))
    schema = "read_id long, vehicle_id long, pass int, distance long, match_ms long, tick long"
    return ordered(both, ["direction", "gantry_id"], TickFusion(wait_ms, step_ms, guard_ms), schema, delay)


def tick_writer(path: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function with two outputs of one run: the settled reads (``path/reads``), and the summary of each tick
    (``path/summary``: reads, anomalies, the list of those). All of a tick leaves the state with the same watermark, so in one
    batch; a batch that comes again replaces its own rows."""
    keep = lambda name, rows: lambda batch, number: sinks.overwrite_partitions(rows(batch).withColumn("batch", F.lit(number)), f"{path}/{name}", "batch")
    return sinks.fan_out(keep("reads", lambda batch: batch), keep("summary", flow.match_summary))
