"""Streaming forms of the operators. Each takes and returns DataFrames; the caller picks source, sink and trigger."""

from __future__ import annotations

import contextlib
import json
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators import completion, flow, lookup
from ..operators.roads import Roads
from ..sources import sinks
from .ordered import Ordered, ordered

OUT_OF_ORDER = "5 minutes"
#: State partitions for each core of the cluster, and at least so many: each costs a Python worker, a load and a commit a batch.
STORES_A_CORE, STORES = 2, 12


def hourly_section_flow(observations: DataFrame, delay: str = OUT_OF_ORDER) -> DataFrame:
    """Hourly flow per section over event time, late rows dropped; emitted when the watermark passes the hour (append)."""
    n = lambda d, c: F.count_if((F.col("direction") == d) & (F.col("class") == c))
    speed = lambda d: F.coalesce(F.avg(F.when(F.col("direction") == d, F.col("speed"))), F.lit(0.0))
    return (
        observations.withWatermark("ts", delay).groupBy(F.window("ts", "1 hour").alias("w"), "section")
        .agg(n(1, 0).alias("up_bus"), n(1, 1).alias("up_truck"), n(2, 0).alias("down_bus"), n(2, 1).alias("down_truck"), speed(1).alias("up_speed"), speed(2).alias("down_speed"))
        .select(F.col("w.start").alias("hour"), *["section", "up_bus", "up_truck", "down_bus", "down_truck", "up_speed", "down_speed"])
    )


def word_counts(lines: DataFrame, col: str = "text") -> DataFrame:
    """Running counts (update or complete mode)."""
    return flow.word_counts(lines, col)


def running_up_down(points: DataFrame, delay: str = OUT_OF_ORDER) -> DataFrame:
    """Hourly up and down counts that update with every trigger."""
    return points.withWatermark("ts", delay).groupBy(F.window("ts", "1 hour").alias("w")).agg(
        F.count_if(F.col("lane") % 2 == 1).alias("up"), F.count_if(F.col("lane") % 2 == 0).alias("down")
    ).select(F.col("w.start").alias("hour"), "up", "down")


def minute_km_plates(points: DataFrame, delay: str = OUT_OF_ORDER) -> DataFrame:
    """Distinct plates per minute and kilometre, once the minute is over in event time."""
    return points.withWatermark("ts", delay).groupBy(F.window("ts", "1 minute").alias("w"), F.floor(F.col("mileage") / 1000).alias("km")).agg(
        F.array_join(F.array_sort(F.collect_set("plate")), ",").alias("plates")
    ).select(F.col("w.start").alias("minute"), "km", "plates")


def sessions(points: DataFrame, gap: str = "10 seconds", delay: str = OUT_OF_ORDER) -> DataFrame:
    """Sessions of each vehicle by event time: start, last time, number of points."""
    return points.withWatermark("ts", delay).groupBy(F.session_window("ts", gap).alias("w"), "vehicle_id").agg(
        F.min("ts").alias("start_ts"), F.max("ts").alias("last_ts"), F.count("*").alias("points")
    ).select("vehicle_id", "start_ts", "last_ts", "points")


def merged_sensors(a: DataFrame, b: DataFrame, key: str, points: str = "points", within: str = "5 seconds", delay: str = "5 seconds") -> DataFrame:
    """``key, ts, points``: frames of two sensors with the same key and times at most ``within`` apart, their point lists one
    after the other. Both watermarks bound the state; lists are put together after the join, so each is kept once."""
    x, y = a.withWatermark("ts", delay).alias("a"), b.withWatermark("ts", delay).alias("b")
    near = (F.col(f"a.{key}") == F.col(f"b.{key}")) & F.col("b.ts").between(F.col("a.ts") - F.expr(f"INTERVAL {within}"), F.col("a.ts") + F.expr(f"INTERVAL {within}"))
    return x.join(y, near).select(F.col(f"a.{key}").alias(key), F.col("a.ts").alias("ts"), F.concat(f"a.{points}", f"b.{points}").alias(points))


def reads_to_images(reads: DataFrame, images: DataFrame, within_s: int = 20, delay: str = OUT_OF_ORDER) -> DataFrame:
    """``read_id, image_id``: reads with the image of the same plate and upload time that came within ``within_s`` seconds. A read
    without one is given (null) once both watermarks have passed that time, then its state ends."""
    r = reads.select("read_id", "plate", "upload", F.col("ts").cast("timestamp").alias("ts")).withWatermark("ts", delay).alias("r")
    i = images.select("image_id", "plate", "upload", F.col("ts").cast("timestamp").alias("ts")).withWatermark("ts", delay).alias("i")
    near = (F.col("r.plate") == F.col("i.plate")) & (F.col("r.upload") == F.col("i.upload")) & F.col("i.ts").between(F.col("r.ts"), F.col("r.ts") + F.expr(f"INTERVAL {within_s} SECONDS"))
    return r.join(i, near, "leftOuter").select("r.read_id", "i.image_id")


def late_splitter(path: str, delay_ms: int, ts: str = "ts") -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that drops no row: those behind the watermark of all batches before (their newest time less
    ``delay_ms``) go to quarantine, ``late=true`` in the table ``path/rows``, the others to ``late=false``, by batch. One
    write a batch; the newest time and the number of late rows are observed in it and kept in ``path/marks``. A batch that
    comes again sees the same marks and replaces its own rows."""

    def write(batch: DataFrame, number: int) -> None:
        marks = sinks.read_or_empty(batch.sparkSession, f"{path}/marks", "newest long, late_rows long, batch long").where(F.col("batch") < number)
        newest = marks.agg(F.max("newest")).head()[0]
        us = F.unix_micros(F.col(ts).cast("timestamp"))
        late = F.lit(False) if newest is None else F.coalesce(us <= (newest - delay_ms) * 1000, F.lit(False))
        seen = Observation()
        rows = batch.withColumns({"late": late, "batch": F.lit(number).cast("long")})
        rows = rows.observe(seen, F.max(F.floor(us / 1000)).alias("newest"), F.count_if("late").alias("late_rows"))
        sinks.overwrite_partitions(rows, f"{path}/rows", "late", "batch")
        mark = batch.sparkSession.createDataFrame([(seen.get["newest"], seen.get["late_rows"], number)], "newest long, late_rows long, batch long")
        sinks.overwrite_partitions(mark, f"{path}/marks", "batch")

    return write


def run_batches(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Everything that is there now through a foreachBatch function."""
    with state_partitions(stream.sparkSession):
        query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


class SectionArrivals(StatefulProcessor):
    """Rows at which a vehicle's section differs from the last one that has come within the hour, in the order of arrival;
    state ends ``keep_ms`` of processing time after its last change."""

    def __init__(self, keep_ms: int):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "hour long, section int, ts long", ttlDurationMs=self.keep_ms)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows)).sort_values(["ts", "event_id"])
        last = self.last.get() if self.last.exists() else (None, None, None)
        keep = []
        for ts, section in zip(pdf["ts"], pdf["section"], strict=True):
            hour = int(ts.timestamp() // 3600)
            keep.append((hour, int(section)) != tuple(last[:2]))
            last = (hour, int(section), int(ts.timestamp() * 1000))
        self.last.update(last)
        yield pdf[keep][["vehicle_id", "event_id", "ts", "section"]]

    def close(self) -> None:
        pass


class SectionChange(Ordered):
    """Rows at which a vehicle's section differs from its last one within the hour, in order of event time. The state ends
    an hour of event time after the last row: nothing after it can be in the same hour."""

    fields = "us long, event_id long, section int"
    memory = "hour long, last int, ms long"
    hour_ms = 3_600_000

    def take(self, key: tuple, rows: list[tuple], s: tuple | None, out: list[tuple]) -> tuple:
        last = s or (None, None, 0)
        for us, event, section in rows:
            hour = us // (self.hour_ms * 1000)
            if (hour, section) != last[:2]:
                out.append((key[0], event, us, section))
            last = (hour, section, us // 1000)
        return last

    def passed(self, key: tuple, over_ms: int, s: tuple, out: list[tuple]) -> tuple | None:
        return s if s[2] + self.hour_ms > over_ms else None

    def due(self, s: tuple, over_ms: int) -> int:
        return s[2] + self.hour_ms + self.slice_ms


def section_changes(observations: DataFrame, keep_ms: int | None = None, delay: str = OUT_OF_ORDER, slice_ms: int = 60_000) -> DataFrame:
    """Keyed state by vehicle (needs the RocksDB state store). Rows count in order of event time, once the watermark has
    passed their slice; with ``keep_ms`` in the order in which they come, by state that lives so long in processing time."""
    rows = observations.select("vehicle_id", "event_id", F.col("ts").cast("timestamp").alias("ts"), "section")
    schema = "vehicle_id long, event_id long, ts timestamp, section int"
    if keep_ms:
        return rows.groupBy("vehicle_id").transformWithStateInPandas(statefulProcessor=SectionArrivals(keep_ms), outputStructType=schema, outputMode="Append", timeMode="ProcessingTime")
    out = ordered(rows, ["vehicle_id"], SectionChange(slice_ms), "vehicle_id long, event_id long, us long, section int", delay)
    return out.select("vehicle_id", "event_id", F.timestamp_micros("us").alias("ts"), "section")


class Completion(Ordered):
    """Gaps of vehicles, in order of event time. As the watermark closes frames, an absent vehicle's gap is given as far as they
    are closed, until it appears again or has been away for ``max_gap`` frames: the sighting before it, the last speeds, the
    steps given before (``done``) and those to reach (``gap``). The state is the sighting and ``done``; a slice is one frame."""

    fields = "us long, frame long, mileage long, up boolean, speed double, plate string, direction int, road string, longitude double, latitude double"
    memory = "seen long, done long, speeds array<double>, mileage long, up boolean, plate string, direction int, road string, longitude double, latitude double"

    def __init__(self, frame_ms: int, max_gap: int, window: int, wait: int):
        super().__init__(frame_ms)
        self.max_gap, self.window, self.wait = max_gap, window, wait

    def _give(self, key: tuple, s: tuple, upto: int, out: list[tuple]) -> tuple:
        """The gap's steps until frame ``upto``; without any speed known there are none."""
        seen, done, speeds, *place = s
        most = min(upto - seen, self.max_gap) - self.wait
        if most <= done or not speeds:
            return s
        out.append((key[0], seen, done, most, speeds, *place))
        return (seen, most, speeds, *place)

    def take(self, key: tuple, rows: list[tuple], s: tuple | None, out: list[tuple]) -> tuple:
        for _, frame, mileage, up, speed, *place in rows:
            speeds = []
            if s is not None:
                if frame <= s[0]:
                    continue  # another row of the same frame
                self._give(key, s, frame - 1, out)
                speeds = s[2] if frame - s[0] == 1 else []
            s = (frame, 0, [*speeds, *([] if speed is None else [speed])][-self.window :], mileage, up, *place)
        return s

    def passed(self, key: tuple, over_ms: int, s: tuple, out: list[tuple]) -> tuple | None:
        closed = over_ms // self.slice_ms - 1
        s = self._give(key, s, closed, out)
        return s if closed - s[0] < self.max_gap else None  # expired: not seen for too long

    def due(self, s: tuple, over_ms: int) -> int:
        return (max(over_ms // self.slice_ms - 1, s[0]) + 2) * self.slice_ms


def completed(
    points: DataFrame, frame_ms: int = 200, interval_ms: int = 200, max_gap: int = 3000, low: int = completion.LOW, high: int = completion.HIGH, window: int = 20, by_road: bool = False,
    wait: int = 0, removals: bool = False, delay: str = OUT_OF_ORDER, roads: Roads | None = None,
) -> DataFrame:
    """The streaming form of ``completion.completed``: ``points`` also have ``ts``, frames last ``frame_ms`` of event time and
    predictions reach to the last frame that the watermark has closed, whatever the order in which rows come. A vehicle's
    state ends after ``max_gap`` frames without it. Keyed state gives the gaps, and the batch form's steps walk those of all
    vehicles side by side; a gap that is still open is walked again from its sighting, and gives the new steps only."""
    has = lambda c, kind: (F.col(c) if c in points.columns else F.lit(None)).cast(kind).alias(c)
    up = F.coalesce(completion.forward(F.col("direction"), F.col("road") if by_road or roads else None), F.lit(False)).alias("up")
    rows = points.select(
        "vehicle_id", "ts", F.col("frame").cast("long").alias("frame"), F.col("mileage").cast("long").alias("mileage"), up, F.col("speed").cast("double").alias("speed"), has("plate", "string"),
        has("direction", "int"), has("road", "string"), has("longitude", "double"), has("latitude", "double"),
    )
    place = "mileage long, up boolean, plate string, direction int, road string, longitude double, latitude double"
    gaps = ordered(rows, ["vehicle_id"], Completion(frame_ms, max_gap, window, wait), f"vehicle_id long, frame long, done long, gap long, speeds array<double>, {place}", delay)
    gaps = gaps.withColumns({"low": F.lit(low), "high": F.lit(high)})
    out = gaps.mapInPandas(lambda frames: completion.predicted(frames, interval_ms, window, wait, removals, roads, carry=True), completion.WALKED)
    return completion.labelled(out, roads is not None)


class SampledSessions(Ordered):
    """Sessions by vehicle with their greedily sampled points, in order of event time. A session closes when a later point
    is more than the gap away, or when the watermark says that the gap has passed."""

    fields = "us long, event_id long, ms long, plate string, vehicle_type int, longitude double, latitude double, lane int, direction int, speed double"
    memory = "start long, last long, kept long, plate string, type int, points long, samples array<struct<longitude:double,latitude:double,lane:int,direction:int,speed:double>>"

    def __init__(self, gap_ms: int, step_ms: int, slice_ms: int):
        super().__init__(slice_ms)
        self.gap, self.step = gap_ms, step_ms

    def load(self, remembered: tuple) -> tuple:
        return (*remembered[:6], [tuple(r) for r in remembered[6]])

    @staticmethod
    def _closed(key: tuple, s: tuple) -> tuple:
        fields = ("longitude", "latitude", "lane", "direction", "speed")
        path = json.dumps([dict(zip(fields, r, strict=True)) for r in s[6]], ensure_ascii=False)
        return (key[0], f"{s[0]}-{s[3]}-{key[0]}", s[4], s[0], s[1], s[5], len(s[6]), path)

    def take(self, key: tuple, rows: list[tuple], s: tuple | None, out: list[tuple]) -> tuple:
        for _, _, ms, plate, kind, *place in rows:
            if s is not None and ms - s[1] > self.gap:
                out.append(self._closed(key, s))
                s = None
            if s is None:
                s = (ms, ms, None, plate, kind, 0, [])
            kept = s[2]
            if kept is None or ms - kept >= self.step:
                s[6].append(tuple(place))
                kept = ms
            s = (s[0], ms, kept, *s[3:5], s[5] + 1, s[6])
        return s

    def passed(self, key: tuple, over_ms: int, s: tuple, out: list[tuple]) -> tuple | None:
        if over_ms - s[1] <= self.gap:
            return s
        out.append(self._closed(key, s))
        return None

    def due(self, s: tuple, over_ms: int) -> int:
        return (s[1] + self.gap) // self.slice_ms * self.slice_ms + self.slice_ms


def sampled_sessions(points: DataFrame, gap_ms: int = 10_000, step_ms: int = 5_000, delay: str = OUT_OF_ORDER, slice_ms: int = 1000) -> DataFrame:
    """Closed sessions with their sampled trajectory as JSON: state by vehicle holds the open session's samples, and the
    rows that the watermark hasn't passed."""
    schema = "vehicle_id long, key string, type int, start_ms long, last_ms long, points long, kept long, trajectory string"
    return ordered(points, ["vehicle_id"], SampledSessions(gap_ms, step_ms, slice_ms), schema, delay)


class Reorder(StatefulProcessor):
    """Rows of one slice of a source, held until the watermark has passed the slice's end, then given in order of time."""

    def __init__(self, slice_ms: int):
        self.slice_ms = slice_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", "ms long, event_id long")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        for pdf in rows:
            self.held.appendList([(int(m), int(e)) for m, e in zip(pdf["ms"], pdf["event_id"], strict=True)])
        self.handle.registerTimer((key[1] + 1) * self.slice_ms)
        yield self._rows([])

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        ready = sorted(tuple(r) for r in self.held.get()) if self.held.exists() else []
        self.held.clear()
        yield self._rows([(key[0], key[1], e, m, n) for n, (m, e) in enumerate(ready, 1)])

    @staticmethod
    def _rows(out: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(out, columns=["source", "slice", "event_id", "ms", "place"])

    def close(self) -> None:
        pass


def reordered(rows: DataFrame, source: str, delay: str = "3 seconds", slice_ms: int = 1000) -> DataFrame:
    """``source, slice, event_id, ms, place``: rows of ``source, event_id, ms, ts``, each held until event time is ``delay``
    ahead of its slice's end; later ones are dropped. State is keyed by source and slice, so that a hot source spreads and
    no list is longer than a slice; slices of a source come in order of time, and ``place`` is the order within one."""
    picked = rows.select(F.col(source).cast("long").alias("source"), F.floor(F.col("ms") / slice_ms).alias("slice"), "event_id", "ms", F.col("ts").cast("timestamp").alias("ts"))
    return picked.withWatermark("ts", delay).groupBy("source", "slice").transformWithStateInPandas(
        statefulProcessor=Reorder(slice_ms), outputStructType="source long, slice long, event_id long, ms long, place long", outputMode="Append", timeMode="EventTime"
    )


class Fusion(StatefulProcessor):
    """Reads and points near one gantry. A read waits for points until its time is over; then the passes of
    ``fusion.passes`` are tried in turn among the points not within the guard of their vehicle's last match."""

    def __init__(self, wait_ms: int, step_ms: int, guard_ms: int):
        self.wait, self.step, self.guard = wait_ms, step_ms, guard_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.reads = handle.getListState("reads", "ms long, read_id long, mileage long, lane int, env string")
        self.points = handle.getListState("points", "ms long, vehicle_id long, mileage long, lane int, known boolean")
        self.matched = handle.getMapState("matched", "vehicle_id long", "ms long")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows))
        r, p = pdf[pdf["is_read"]], pdf[~pdf["is_read"]]
        if len(r):
            self.reads.appendList([(int(x.ms), int(x.id), int(x.mileage), int(x.lane), x.env) for x in r.itertuples()])
        if len(p):
            self.points.appendList([(int(x.ms), int(x.id), int(x.mileage), int(x.lane), bool(x.known)) for x in p.itertuples()])
        self.handle.registerTimer(int(pdf["ms"].min()) + self.wait)
        yield self._rows([])

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs()
        every = sorted(tuple(r) for r in self.reads.get()) if self.reads.exists() else []
        over = [r for r in every if r[0] + self.wait <= mark]
        rest = [r for r in every if r[0] + self.wait > mark]
        points = [tuple(p) for p in self.points.get()] if self.points.exists() else []
        out, left = [], over
        for number in (1, 2, 3):
            wanted = []
            for ms, read, mileage, lane, env in left:
                found = []
                for at, vehicle, place, own, known in points:
                    before = self.matched.getValue((vehicle,))[0] if self.matched.containsKey((vehicle,)) else None
                    if not ms <= at <= ms + self.wait or before is not None and abs(at - before) < self.guard:
                        continue
                    bad, far, tries = env == "99", abs(place - mileage), (at - ms) // self.step
                    behind = place <= mileage if key[0] == 1 else place >= mileage
                    if number == 1 and not bad and own == lane and behind:
                        found.append(((tries, far), vehicle, at, far))
                    elif number == 2 and not bad and (abs(own - lane) <= 1 or own == 5):
                        found.append(((tries, not known, own != lane, far), vehicle, at, far))
                    elif number == 3 and bad:
                        found.append(((tries, far), vehicle, at, far))
                if found:
                    _, vehicle, at, far = min(found)
                    wanted.append((vehicle, at, far, read))
            won = [w for w in wanted if not any(x[0] == w[0] and abs(x[1] - w[1]) < self.guard and x[2:] < w[2:] for x in wanted)]
            for vehicle, at, far, read in won:
                self.matched.updateValue((vehicle,), (at,))
                out.append((read, vehicle, number, far, at))
            done = {w[3] for w in won}
            left = [r for r in left if r[1] not in done]
        out += [(r[1], None, None, None, None) for r in left]
        oldest = min([mark, *[r[0] for r in rest]])
        kept = [p for p in points if p[0] >= oldest]
        for state, value in ((self.reads, rest), (self.points, kept)):
            if value:
                state.put(value)
            else:
                state.clear()
        for vehicle, at in [(k[0], v[0]) for k, v in self.matched.iterator()]:
            if at + self.guard + self.wait < oldest:
                self.matched.removeKey((vehicle,))
        nexts = [r[0] for r in rest] + [p[0] for p in kept]
        if nexts:
            self.handle.registerTimer(max(min(nexts) + self.wait, mark + 1))
        yield self._rows(out)

    @staticmethod
    def _rows(out: list[tuple]) -> pd.DataFrame:
        rows = pd.DataFrame(out, columns=["read_id", "vehicle_id", "pass", "distance", "match_ms"])
        return rows.astype({"vehicle_id": "Int64", "pass": "Int32", "distance": "Int64", "match_ms": "Int64"})

    def close(self) -> None:
        pass


def reads_to_tracks(
    reads: DataFrame, points: DataFrame, gantries: DataFrame, reach: int = 100, wait_ms: int = 6000, step_ms: int = 400, guard_ms: int = 15_000, delay: str = OUT_OF_ORDER
) -> DataFrame:
    """The streaming form of ``fusion.reads_to_tracks``, by direction and gantry: ``read_id, vehicle_id, pass, distance,
    match_ms``, nulls for reads that found no vehicle in time. ``reads(read_id, ms, ts, direction, mileage, lane, env)``
    stand at gantries; ``points(vehicle_id, ms, ts, direction, mileage, lane, known)`` go to the nearest gantry within
    ``reach``. The guard is kept by gantry: gantries are farther apart than a vehicle goes in its time."""
    near = lookup.nearest_gantry(points, gantries, reach).where("gantry_id <> 0")
    at = reads.join(gantries.select(F.col("id").alias("gantry_id"), "mileage", "direction"), ["mileage", "direction"])
    one = lambda df, ident, is_read, env, known: df.select(
        F.col("direction").cast("int").alias("direction"), F.col("gantry_id").cast("long").alias("gantry_id"), F.col(ident).cast("long").alias("id"), F.lit(is_read).alias("is_read"), "ms",
        F.col("ts").cast("timestamp").alias("ts"), F.col("mileage").cast("long").alias("mileage"), F.col("lane").cast("int").alias("lane"), env.alias("env"), known.alias("known"),
    )
    both = one(at, "read_id", True, F.col("env"), F.lit(False)).unionByName(one(near, "vehicle_id", False, F.lit(None).cast("string"), F.coalesce("known", F.lit(False))))
    return both.withWatermark("ts", delay).groupBy("direction", "gantry_id").transformWithStateInPandas(
        statefulProcessor=Fusion(wait_ms, step_ms, guard_ms), outputStructType="read_id long, vehicle_id long, pass int, distance long, match_ms long", outputMode="Append", timeMode="EventTime"
    )


def use_rocksdb(spark: SparkSession) -> None:
    """The RocksDB state store; a batch commits its changes, not whole files of the store."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


@contextlib.contextmanager
def state_partitions(spark: SparkSession) -> Iterator[None]:
    """Streams started within keep their state in partitions by the cores there are, not by the size of batch shuffles. A
    stream takes the number when it first starts, and keeps it. Keys go to tasks bucket by bucket, so fewer partitions don't
    make what a task holds at a time larger."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, min(int(before), max(STORES, STORES_A_CORE * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def run_to_table(stream: DataFrame, path: str, mode: str = "append") -> DataFrame:
    """Everything that is there now through the stream into a Parquet table, which is returned; update and complete modes
    write each batch under its number, and the last one of every row counts."""
    checkpoint = f"{path}-checkpoint"
    with state_partitions(stream.sparkSession):
        if mode == "append":
            query = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start(path)
        else:
            write = lambda batch, number: batch.withColumn("batch", F.lit(number)).write.mode("append").parquet(path)
            query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.read.parquet(path)
