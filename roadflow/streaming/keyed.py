"""Keyed state beside the sessions and dead reckoning: votes for plates, and segments that are flushed a while after their
key's first row."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from .ordered import Ordered, ordered


class PlateVotes(Ordered):
    """Votes for the plates of a vehicle, read by read in order of event time. The most frequent plate so far (ties: the one read
    first) is the best; when it reaches ``settle`` votes it is settled, and carried from then on whatever is read. Votes live
    ``votes_ms`` of event time after the last read, the settled plate ``settled_ms`` after it was settled."""

    fields = "us long, event_id long, plate string"
    memory = "votes array<struct<plate:string,votes:bigint,place:bigint>>, reads long, seen long, settled string, since long"

    def __init__(self, settle: int, votes_ms: int | None, settled_ms: int | None, slice_ms: int):
        super().__init__(slice_ms)
        self.settle, self.votes_ms, self.settled_ms = settle, votes_ms, settled_ms

    def load(self, remembered: tuple) -> list:
        return [{p: (n, place) for p, n, place in remembered[0]}, *remembered[1:]]

    def save(self, s: list) -> tuple:
        return ([(p, *v) for p, v in s[0].items()], *s[1:])

    def _expire(self, s: list, ms: int) -> None:
        if self.votes_ms is not None and s[2] is not None and ms - s[2] > self.votes_ms:
            s[:3] = [{}, 0, None]
        if self.settled_ms is not None and s[4] is not None and ms - s[4] > self.settled_ms:
            s[3:] = [None, None]

    def take(self, key: tuple, rows: list[tuple], s: list | None, out: list[tuple]) -> list:
        s = s or [{}, 0, None, None, None]
        rank = lambda p: (-s[0][p][0], s[0][p][1], p)
        best = min(s[0], key=rank, default=None)
        for us, event, plate in rows:
            ms = us // 1000
            self._expire(s, ms)
            if not s[0]:
                best = None
            if plate is not None:
                own = s[0].get(plate)
                s[0][plate] = (own[0] + 1, own[1]) if own else (1, s[1])
                best = plate if best is None else min(best, plate, key=rank)
            s[1:3] = [s[1] + 1, ms]
            votes = s[0][best][0] if s[0] else 0
            if votes >= self.settle and s[4] is None:
                s[3:] = [best, ms]
            out.append((key[0], event, us, best, votes, s[3] if s[4] is not None else best))
        return s

    def passed(self, key: tuple, over_ms: int, s: list, out: list[tuple]) -> list | None:
        self._expire(s, over_ms)
        return s if s[2] is not None or s[4] is not None else None

    def due(self, s: list, over_ms: int) -> int | None:
        lives = [t + life + self.slice_ms + 1 for t, life in ((s[2], self.votes_ms), (s[4], self.settled_ms)) if t is not None and life is not None]
        return min(lives, default=None)


def plate_votes(
    reads: DataFrame, settle: int = 10, votes_ms: int | None = 80_000, settled_ms: int | None = None, delay: str = "5 minutes", slice_ms: int = 60_000
) -> DataFrame:
    """``vehicle_id, event_id, ts, plate, votes, carried`` for each of ``reads(vehicle_id, event_id, ts, plate)``: the best plate so
    far with its votes, and the settled plate, else the best. A vehicle's last row is its vote."""
    processor = PlateVotes(settle, votes_ms, settled_ms, slice_ms)
    out = ordered(reads, ["vehicle_id"], processor, "vehicle_id long, event_id long, us long, plate string, votes long, carried string", delay)
    return out.select("vehicle_id", "event_id", F.timestamp_micros("us").alias("ts"), "plate", "votes", "carried")


SEGMENT = "vehicle_id long, speed_sum double, points long, plate string, direction int, lane int"


class FlushAfterFirst(Ordered):
    """Segments of a key's vehicles, given ``width_ms`` of event time after the first row: rows in order go to the open window
    or, when its time is over, open the next one."""

    fields = "us long, event_id long, vehicle_id long, speed double, plate string, direction int, lane int"
    memory = f"first long, segments array<struct<{SEGMENT.replace(', ', ',').replace(' ', ':')}>>"

    def __init__(self, width_ms: int, slice_ms: int):
        super().__init__(slice_ms)
        self.width = width_ms

    def load(self, remembered: tuple) -> tuple[int, dict]:
        return remembered[0], {v[0]: list(v[1:]) for v in remembered[1]}

    def save(self, s: tuple[int, dict]) -> tuple:
        return s[0], [(vehicle, *v) for vehicle, v in s[1].items()]

    @staticmethod
    def _flush(key: tuple, s: tuple[int, dict], out: list[tuple]) -> None:
        out += [(key[0], s[0], vehicle, *v) for vehicle, v in s[1].items()]

    def take(self, key: tuple, rows: list[tuple], s: tuple[int, dict] | None, out: list[tuple]) -> tuple[int, dict]:
        for us, _, vehicle, speed, plate, direction, lane in rows:
            if s is not None and us - s[0] >= self.width * 1000:
                self._flush(key, s, out)
                s = None
            if s is None:
                s = (us, {})
            own = s[1].get(vehicle)
            if own:
                own[0] += speed or 0.0
                own[1] += 1
            else:
                s[1][vehicle] = [speed or 0.0, 1, plate, direction, lane]
        return s

    def passed(self, key: tuple, over_ms: int, s: tuple[int, dict], out: list[tuple]) -> tuple[int, dict] | None:
        if s[0] + self.width * 1000 > over_ms * 1000:
            return s
        self._flush(key, s, out)
        return None

    def due(self, s: tuple[int, dict], over_ms: int) -> int:
        return (s[0] // 1000 + self.width) // self.slice_ms * self.slice_ms + self.slice_ms


class FlushAfterArrival(StatefulProcessor):
    """The same by the clock: a processing-time timer flushes a key so long after its first row has come, in the order of
    arrival."""

    def __init__(self, width_ms: int):
        self.width = width_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.first = handle.getValueState("first", "us long")
        self.segments = handle.getMapState("segments", "vehicle_id long", "speed_sum double, points long, plate string, direction int, lane int")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        for pdf in rows:
            for r in pdf.sort_values(["us", "event_id"]).itertuples():
                if not self.first.exists():
                    self.first.update((int(r.us),))
                    self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.width)
                own = self.segments.getValue((int(r.vehicle_id),))
                self.segments.updateValue((int(r.vehicle_id),), (own[0] + r.speed, own[1] + 1, *own[2:]) if own else (float(r.speed), 1, r.plate, int(r.direction), int(r.lane)))
        yield self._frame([])

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        start = self.first.get()[0]
        out = [(key[0], start, k[0], *v) for k, v in self.segments.iterator()]
        self.first.clear()
        self.segments.clear()
        yield self._frame(out)

    @staticmethod
    def _frame(out: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(out, columns=["km", "start_us", *[f.split()[0] for f in SEGMENT.split(", ")]])

    def close(self) -> None:
        pass


def flushed_segments(points: DataFrame, width_ms: int = 60_000, delay: str | None = "5 minutes", slice_ms: int = 1000) -> DataFrame:
    """``km, start_us, vehicle_id, speed_sum, points, plate, direction, lane``: segments of each kilometre's vehicles, flushed
    ``width_ms`` after the kilometre's first row, whose time is the start. Event time counts, so that the result doesn't depend
    on arrival; without ``delay`` the clock does, as rows come."""
    keyed = points.withColumn("km", F.floor(F.col("mileage") / 1000))
    schema = f"km long, start_us long, {SEGMENT}"
    if delay is not None:
        return ordered(keyed, ["km"], FlushAfterFirst(width_ms, slice_ms), schema, delay)
    rows = keyed.select("km", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"), "event_id", "vehicle_id", "speed", "plate", "direction", "lane")
    return rows.groupBy("km").transformWithStateInPandas(statefulProcessor=FlushAfterArrival(width_ms), outputStructType=schema, outputMode="Append", timeMode="ProcessingTime")
